"""Main text of pages: the vote of the host, its furniture, and the query against plain Python."""

import re
from collections import Counter, defaultdict

import pytest

from transhume.llm import pages
from transhume.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"
SCHEMA = "page_id long, url string, html string"


def host_of(url):
    found = re.match(r"\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", url or "")
    return found[1].lower() if found else ""


def habits_of(rows):
    """Winners and furniture of every host, page by page."""
    votes, stands, count, seen = defaultdict(Counter), defaultdict(Counter), Counter(), set()
    for _, url, html in rows:
        found, host = pages.blocks(html), host_of(url)
        if not found or (host, html) in seen:
            continue
        seen.add((host, html))
        count[host] += 1
        scores = pages.container_scores(found)
        best = min(scores, key=lambda p: (-scores[p], p), default=None)
        if best is not None and scores[best] > 0:
            votes[host][best] += 1
        stands[host].update({pages.digest(t) for _, t, _ in found})
    return {
        h: (
            [p for p, n in sorted(votes[h].items(), key=lambda v: (-v[1], v[0])) if 10 * n >= votes[h].total()],
            {d for d, n in stands[h].items() if n > 1 and 10 * n >= count[h]},
        )
        for h in count
    }


def texts_of(rows):
    habits = habits_of(rows)
    out = {}
    for i, url, html in rows:
        found = pages.blocks(html)
        out[i] = "\n\n".join(found[k][1] for k in pages.chosen(found, *habits.get(host_of(url), ([], set()))))
    return out


def extracted(spark, rows):
    return {r.page_id: r.text for r in pages.main_text(spark.createDataFrame(rows, SCHEMA)).collect()}


def test_query_over_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").select("page_id", "url", "html").collect()]
    got = {r.page_id: (r.url, r.text, r.n_chars) for r in QUERIES["op7_html_text"](spark, SF_DIR).collect()}
    want = texts_of(rows)
    assert got == {i: (u, want[i], len(want[i])) for i, u, _ in rows}


def test_the_vote_mends_pages_whose_strangers_no_word_marks(spark, monkeypatch):
    rows = [tuple(r) for r in spark.read.parquet(SF_DIR.replace("0.01", "0.1") + "/pages.parquet").select("page_id", "url", "html").collect()]
    with_words = texts_of(rows)
    monkeypatch.setattr(pages, "MARKED", frozenset())
    monkeypatch.setattr(pages, "ROLES", frozenset())
    alone = {}
    for i, _, html in rows:
        found = pages.blocks(html)
        alone[i] = "\n\n".join(found[k][1] for k in pages.chosen(found, []))
    assert sum(alone[i] != with_words[i] for i in alone) > 10
    assert texts_of(rows) == with_words


def story(i, weather):
    text = "".join(f"<p>Paragraph {k} of story {i}, that is long enough. More of it.</p>" for k in range(6))
    around = f"<div class='strapline'><p>All that is new, every day.</p></div><div class='weather'><p>{weather}</p></div>"
    return f"<html><body>{around}<div class='story'><h1>Story {i}</h1>{text}</div><div class='imprint'><p>Printed by the printers, in a town.</p></div></body></html>"


def test_furniture_of_a_host_is_left_out(spark):
    rows = [(i, f"http://news.x/{i}", story(i, f"Today it is {i} degrees, and rainy.")) for i in range(10)]
    got = extracted(spark, rows)
    for i in range(10):
        assert got[i].split("\n\n") == [f"Story {i}", *(f"Paragraph {k} of story {i}, that is long enough. More of it." for k in range(6))]


def test_text_around_the_container_that_is_no_furniture_stays(spark):
    body = "".join(f"<p>Paragraph {k}, that is long enough. More.</p>" for k in range(6))
    page = "<body><div class='top'><p>The same on all.</p></div><div class='intro'><h1>Head {0}x{1}</h1><p>Lead of {1}.</p></div><div class='body'>{2}</div></body>"
    rows = [(i, "http://h.x/", page.format(i, "abcdefghij"[i], body.replace("Paragraph", "Paragraph " + "abcdefghij"[i]))) for i in range(10)]
    got = extracted(spark, rows)
    for i in range(10):
        assert got[i].startswith(f"Head {i}x") and f"Lead of {'abcdefghij'[i]}." in got[i] and "same on all" not in got[i]


def test_copies_of_a_page_make_no_furniture(spark):
    one = "<body><h1>Head</h1><p>Lead, of the article.</p><div class='body'>" + "".join(f"<p>Part {c}, long. More.</p>" for c in "abcdef") + "</div></body>"
    rows = [(i, "http://h.x/", one) for i in range(20)]
    assert set(extracted(spark, rows).values()) == {"\n\n".join(["Head", "Lead, of the article.", *(f"Part {c}, long. More." for c in "abcdef")])}


def test_a_winner_narrows_and_passes_an_advert_over(spark):
    long = "".join(f"<p>Part {c}, long. More of it.</p>" for c in "abcdef")
    rows = [(i, "http://h.x/", f"<body><article><h1>Story {'abcdefghij'[i]}</h1>{long.replace('Part', 'Part ' + 'abcdefghij'[i])}</article></body>") for i in range(9)]
    rows.append((9, "http://h.x/", "<body><div class='q'><p>Buy this, it is the best. It is long, too.</p></div><article><p>A short article. Done.</p></article></body>"))
    assert extracted(spark, rows)[9] == "A short article. Done."


def test_odd_rows(spark):
    rows = [(1, None, "<p>no url</p>"), (1, None, "<p>no url</p>"), (2, "http://a.b", None), (None, "http://a.b", ""), (3, "", "<p>x"), (4, "http://c.d", "<p>long</p>" * 20_000)]
    df = spark.createDataFrame([(*r, "v", [1], "p") for r in rows], SCHEMA + ", _row string, winners array<int>, text string")
    got = pages.main_text(df)
    assert got.columns == ["page_id", "url", "html", "_row", "winners", "text"]
    assert sorted((r.page_id or 0, r.text[:9]) for r in got.collect()) == [(0, ""), (1, "no url"), (1, "no url"), (2, ""), (3, "x"), (4, "long\n\nlon")]
    assert pages.main_text(df.limit(0)).count() == 0


@pytest.mark.parametrize("share", [0.1, 0.6])
def test_habits_are_bounded_and_small(spark, share):
    rows = [(i, "http://h.x/", f"<body><p>same, all over</p><p>of {chr(97 + i % 26)}{chr(97 + i // 26)}, its own text</p></body>") for i in range(50)]
    habits = pages.host_habits(spark.createDataFrame(rows, SCHEMA), furniture=share).collect()
    assert len(habits) == 1 and habits[0].furniture == [pages.digest("same, all over")] and habits[0].winners == ["body"]


def test_pages_are_not_shuffled(spark):
    rows = [(i, f"http://h{i}.x/", f"<p>text {i}</p>") for i in range(20)]
    plan = pages.main_text(spark.createDataFrame(rows, SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
