"""Main text of web pages, by the paths on which the pages of a host agree."""

from __future__ import annotations

import html
import re
from collections.abc import Collection, Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transhume.llm.text import SEED
from transhume.session import stage

#: A path wins on its host with at least this share of the votes; so at most ten can win.
WINNING_SHARE = 0.1

#: A block is furniture of its host if it stands on at least this share of its pages, and on two.
#: A page has some blocks, so a host has at most ten times the blocks of a page that are.
FURNITURE_SHARE = 0.1

# Kinds of HTML elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var".split()
)
#: Blocks of text: they end a block but are no containers.
TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre blockquote figcaption caption td th tr summary address".split())
#: Containers that are parts of an article.
PIECES = frozenset("ul ol dl table thead tbody tfoot colgroup section figure details".split())
#: Elements without text of the article.
SKIPPED = frozenset(
    "head title script style noscript template nav header footer aside form button select option textarea input "
    "fieldset dialog iframe object svg canvas menu".split()
)
RAW = frozenset("script style textarea title noscript template".split())
#: Words of classes and ids that mark such elements.
MARKED = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies "
    "consent gdpr notice notices alert comment comments reply replies respond disqus sidebar side nav navbar "
    "navigation menu breadcrumb breadcrumbs header masthead footer share sharing social related recommended "
    "newsletter subscribe subscription signup login popup modal overlay widget pagination pager toolbar tags "
    "copyright legal disclaimer skip".split()
)
#: Words that may stand beside a marked one in the same class or id.
PARTS = frozenset(
    "area articles bar block body bottom box button buttons container content entry feed footer form global group "
    "icons inner item items left level link links list main outer page post posts primary right secondary section site "
    "text thread title top wrap wrapper".split()
)
#: Marks of what may well be longer than the article.
FOREIGN = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored cookie cookies consent gdpr comment comments "
    "reply replies respond disqus popup modal overlay".split()
)
#: Skipped elements that may still hold the article, as marked ones may.
LIFTED = frozenset("nav header footer aside form fieldset dialog menu".split())
#: Roles that do the same.
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'=<>`]+)))?")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def general(tag: str, attributes: dict[str, str]) -> str:
    """Tag and classes without numbers: the same for all pages of a template."""
    classes = sorted({re.sub(r"\d+", "#", c.lower()) for c in attributes.get("class", "").split()})
    return ".".join([tag, *classes])


def _marks(attributes: dict[str, str]) -> set[str]:
    """Marked words of the classes and ids that consist of such words and their parts."""
    found: set[str] = set()
    for name in f"{attributes.get('class', '')} {attributes.get('id', '')}".split():
        own = set(re.findall(r"[a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", name).lower()))
        if own <= MARKED | PARTS:
            found |= own & MARKED
    return found


def _skips(tag: str, attributes: dict[str, str]) -> bool:
    """Whether an element is skipped whatever it holds."""
    if tag in SKIPPED - LIFTED or "hidden" in attributes:
        return True
    return attributes.get("aria-hidden", "").lower() == "true" or bool(_HIDDEN.search(attributes.get("style", "")))


class _Mark:
    """An element that is skipped unless it holds the article."""

    def __init__(self, tag: str, words: set[str], inside: bool):
        self.foreign = bool(words & FOREIGN)
        #: Headings of a site stand in such elements, too; those of an article within it.
        self.titled = inside or tag not in LIFTED - {"form", "fieldset"}
        self.holds = False
        self.plain = 0


def _mark(tag: str, attributes: dict[str, str], inside: bool) -> _Mark | None:
    found = set() if tag in ("html", "body", "main", "article") else _marks(attributes)
    if found or tag in LIFTED or attributes.get("role", "").lower() in ROLES:
        return _Mark(tag, found, inside)
    return None


def blocks(page: str | None) -> list[tuple[tuple[str, ...], str, int]]:
    """Blocks of text of a page in order: path of their containers, text, characters in links.

    Markup is read leniently: a block ends where any block starts or ends, an end tag closes
    what is open inside its element, an end tag without a start counts for nothing. A marked
    element is skipped unless it holds an ``article``, ``main`` or ``h1``, or, on a page without
    those elsewhere, most of the text outside links (all of it if its marks are of foreign text).
    """
    if not page:
        return []
    out: list[tuple[tuple[str, ...], str, int]] = []
    within: list[list[_Mark]] = []
    # Open elements: tag, step of the path (empty for what is no container), skipped, mark
    stack: list[tuple[str, str, bool, _Mark | None]] = []
    anchored = False
    held: list[str] = []
    linked = links = skipped = at = 0

    def flush() -> None:
        nonlocal linked
        if held:
            text = " ".join(html.unescape("".join(held)).split())
            if text:
                out.append((tuple(s for _, s, _, _ in stack if s), text, min(linked, len(text))))
                within.append([m for *_, m in stack if m])
            held.clear()
        linked = 0

    position = 0
    while True:
        m = _TOKEN.search(page, position)
        text = page[at : m.start() if m else len(page)]
        if text and not skipped:
            held.append(text)
            if links:
                linked += len(text)
        if m is None:
            break
        at = position = m.end()
        closing, tag = m[1], (m[2] or "").lower()
        if not tag:
            continue
        if tag == "br" or tag == "wbr":
            if tag == "br" and not skipped:
                held.append(" ")
            continue
        if tag == "a":
            links = 0 if closing else 1
        block = tag not in INLINE
        if closing:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
            if depth is not None:
                if block:
                    flush()
                skipped -= sum(s for _, _, s, _ in stack[depth:])
                del stack[depth:]
            elif block:
                flush()
            continue
        attributes = {k.lower(): html.unescape(a or b or c) for k, a, b, c in _ATTRIBUTE.findall(m[3])} if m[3].strip(" /\n\t") else {}
        if block:
            flush()
            links = 0
        if tag in VOID:
            continue
        inside = any(t in ("article", "main") for t, *_ in stack)
        mark = _mark(tag, attributes, inside)
        # A marked element within a line is skipped as it is.
        skips = _skips(tag, attributes) or (mark is not None and not block)
        if tag in RAW:  # their content is no markup
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, position)
            at = position = end.end() if end else len(page)
            continue
        if m[3].endswith("/") and tag not in ("p", "div", "a"):
            continue
        if not block and not skips:
            continue
        if tag in TEXT_BLOCKS and tag in _CLOSES:  # a paragraph closes an open one
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] in _CLOSES[tag] or stack[i][1]), None)
            if depth is not None and stack[depth][0] in _CLOSES[tag]:
                skipped -= sum(s for _, _, s, _ in stack[depth:])
                del stack[depth:]
        step = "" if tag in TEXT_BLOCKS or tag in INLINE else general(tag, attributes)
        if tag in ("article", "main", "h1") and not (skips or skipped) and not _marks(attributes):
            around = [m for *_, m in stack if m]
            anchored = anchored or not (around or mark)
            for m in around:
                m.holds |= tag != "h1" or m.titled
        stack.append((tag, step, skips, None if skips else mark))
        skipped += skips
    flush()
    total = 0
    for (_, text, links), marks in zip(out, within, strict=True):
        total += len(text) - links
        for m in marks:
            m.plain += len(text) - links
    for m in {m for marks in within for m in marks}:
        if not m.holds and not anchored:
            m.holds = m.plain > 0 and (m.plain == total if m.foreign else 2 * m.plain > total)
    return [b for b, marks in zip(out, within, strict=True) if all(m.holds for m in marks)]


_CLOSES = {t: {"p"} for t in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "pre", "blockquote")} | {
    "li": {"p", "li"}, "dt": {"p", "dt", "dd"}, "dd": {"p", "dt", "dd"}, "td": {"p", "td", "th"}, "th": {"p", "td", "th"}, "tr": {"p", "td", "th", "tr"}
}


def container_scores(found: list[tuple[tuple[str, ...], str, int]]) -> dict[str, float]:
    """Score of every container path: text outside links, halved with every level below it."""
    scores: dict[str, float] = {}
    for path, text, linked in found:
        value = max(0, len(text) - 2 * linked) * (1 + min(3, text.count(",") + text.count(". ")) / 3)
        for depth in range(len(path), 0, -1):
            key = "/".join(path[:depth])
            scores[key] = scores.get(key, 0) + value
            value /= 2
    return scores


def best_path(scores: dict[str, float]) -> str | None:
    return min(scores, key=lambda p: (-scores[p], p)) if scores else None


def under(found: list[tuple[tuple[str, ...], str, int]], path: str) -> list[int]:
    """Places of the blocks below a path."""
    steps = tuple(path.split("/"))
    return [i for i, (own, _, _) in enumerate(found) if own[: len(steps)] == steps]


def plain(found: list[tuple[tuple[str, ...], str, int]], places: Iterable[int]) -> int:
    """Characters of these blocks outside links."""
    return sum(len(found[i][1]) - found[i][2] for i in places)


def digest(text: str) -> int:
    """Digest of a block, the same whatever its numbers: days, prices and counts change on furniture."""
    return xxhash.xxh64_intdigest(re.sub(r"\d+", "#", text.lower()), SEED) - 2**63


def whole(found: list[tuple[tuple[str, ...], str, int]], path: str, furniture: Collection[int] = ()) -> list[int]:
    """Places of the blocks of the article around a container.

    All below the nearest ``article`` or ``main``. Without one, all below the container, and those
    blocks of the nearest container around it, the body included, that are neither links nor
    furniture of the host, if it has such blocks and is no part of a table, list or figure.
    """
    steps = path.split("/")
    for depth in range(len(steps), 0, -1):
        if _tag(steps[depth - 1]) in ("article", "main"):
            return under(found, "/".join(steps[:depth]))
    own = set(under(found, path))
    for depth in range(len(steps) - 1, 0, -1):
        around = [i for i in under(found, "/".join(steps[:depth])) if i not in own]
        more = [i for i in around if len(found[i][1]) > 2 * found[i][2] and digest(found[i][1]) not in furniture]
        if more and _tag(steps[depth - 1]) not in PIECES:
            links = [i for i in around if len(found[i][1]) <= 2 * found[i][2] and digest(found[i][1]) not in furniture]
            return sorted(own | {*more, *links})
    return sorted(own)


def _tag(step: str) -> str:
    return step.split(".")[0]


def chosen(
    found: list[tuple[tuple[str, ...], str, int]], winners: list[str], furniture: Collection[int] = ()
) -> list[int]:
    """Places of the blocks of the article.

    The first winner of the host takes the place of the page's own best container, be it around, within or beside that,
    if it holds at least a quarter as much text outside links; one around it must not hold more than twice
    as much. So an advert that outweighs a short article is passed over, and a page of another template is
    not. Without such a winner the own container stays.
    """
    path = best_path(container_scores(found))
    if path is None:
        return list(range(len(found)))
    weight = plain(found, under(found, path))
    for winner in winners:
        there = plain(found, under(found, winner))
        around = path.startswith(f"{winner}/")
        if there > 0 and 4 * there >= weight and (not around or 2 * weight >= there):
            path = winner
            break
    return whole(found, path, furniture)


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each page says of its host: its digest, the path that it votes for, and digests of its blocks."""
    for b in batches:
        hosts, said, paths, own = [], [], [], []
        for host, page in zip(b.column("host").to_pylist(), b.column("html"), strict=True):
            page = page.as_py()
            found = blocks(page)
            scores = container_scores(found)
            path = best_path(scores)
            if found:
                hosts.append(host)
                said.append(xxhash.xxh128_digest(page.encode(), SEED))
                paths.append(path if path is not None and scores[path] > 0 else None)
                own.append(sorted({digest(text) for _, text, _ in found}))
        yield pa.RecordBatch.from_arrays(
            [pa.array(hosts, pa.string()), pa.array(said, pa.binary()), pa.array(paths, pa.string()), pa.array(own, pa.list_(pa.int64()))],
            names=["host", "page", "path", "blocks"],
        )


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, tuple[list[str], frozenset[int]]] = {}
    for b in batches:
        texts = []
        for host, page, at in zip(b.column("_host").to_pylist(), b.column("_html"), range(b.num_rows), strict=True):
            if host not in held:
                if len(held) > 1000:
                    held.clear()
                furniture = b.column("_furniture")[at].as_py()
                held[host] = b.column("_winners")[at].as_py() or [], frozenset(furniture or ())
            found = blocks(page.as_py())
            texts.append("\n\n".join(found[i][1] for i in chosen(found, *held[host])))
        yield pa.RecordBatch.from_arrays([b.column("_row"), pa.array(texts, pa.string())], names=["_row", "_text"])


def host_of(url: Column) -> Column:
    """Host of a URL in lower case, without port and user; empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1))


def host_habits(
    pages: DataFrame, url_col: str = "url", html_col: str = "html", share: float = WINNING_SHARE, furniture: float = FURNITURE_SHARE
) -> DataFrame:
    """``host``, ``winners`` and ``furniture``, a row per host, stored.

    ``winners`` are the paths with at least that share of the votes of the host's pages, most votes first; each
    page votes for its best container. ``furniture`` are digests of the blocks that stand on at least two of the
    host's pages and that share of them. Equal pages of a host count once, so copies neither win a
    vote nor make an article furniture. Votes and blocks are counted within tasks before they are shuffled, so a
    host with many pages sends a row per path, or block, and task.
    """
    rows = pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("html"))
    said = rows.mapInArrow(_votes, "host string, page binary, path string, blocks array<long>")
    said = stage(said.groupBy("host", "page").agg(F.first("path").alias("path"), F.first("blocks").alias("blocks")), "pages_said")
    by_path = said.where("path IS NOT NULL").groupBy("host", "path").agg(F.count("*").alias("votes"))
    total = said.groupBy("host").agg(F.count("path").alias("all_votes"), F.count("*").alias("all_pages"))
    by_block = said.select("host", F.explode("blocks").alias("block")).groupBy("host", "block").agg(F.count("*").alias("n")).where("n > 1")
    strong = by_path.join(total, "host").where(F.col("votes") >= share * F.col("all_votes"))
    listed = F.array_sort(F.collect_list(F.struct((-F.col("votes")).alias("v"), "path")))
    winners = strong.groupBy("host").agg(F.transform(listed, lambda s: s["path"]).alias("winners"))
    common = by_block.join(total, "host").where(F.col("n") >= furniture * F.col("all_pages"))
    habits = winners.join(common.groupBy("host").agg(F.collect_list("block").alias("furniture")), "host", "full")
    return stage(habits, "host_habits")


def main_text(
    pages: DataFrame, url_col: str = "url", html_col: str = "html", out_col: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """Add the main text of every page in ``out_col`` (a column of that name is replaced).

    The page is read again with the habits of its host: the path that wins the vote takes the place of the
    page's own best container if it holds most of it (see ``chosen``), and text around that container
    is added unless it is furniture, text that stands on many pages of the host (see ``whole``). Blocks are joined
    by an empty line. Null and empty pages give the empty text; pages without a host vote and
    are read together as the host of the empty name. Rows that repeat stay. ``keep``: columns
    to return, all by default.

    The habits are stored before they meet the pages: where they are small, the pages stay in their place.
    """
    kept = [c for c in keep or pages.columns if c != out_col]
    rows = pages.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row"),
        F.col(html_col).alias("_html"),
        host_of(F.col(url_col)).alias("_host"),
    )
    habits = host_habits(pages, url_col, html_col).select(
        F.col("host").alias("_host"), F.col("winners").alias("_winners"), F.col("furniture").alias("_furniture")
    )
    met = rows.join(habits, "_host", "left").select("_row", "_html", "_host", "_winners", "_furniture")
    out = met.mapInArrow(_extract, T.StructType([rows.schema["_row"], T.StructField("_text", T.StringType())]))
    return out.select("_row.*", F.col("_text").alias(out_col))
