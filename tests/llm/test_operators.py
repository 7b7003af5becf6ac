"""The operators on small tables: nulls, empty and long texts, ties, repeats, clashing names, empty tables."""

import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from transhume.llm import chat, decontaminate, langid, lines, packing, pages, quality, rules, sharding, simhash
from transhume.llm.components import components
from transhume.llm.ranking import numbered

DOCS = "doc_id long, text string, _row string, node string, key string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "r", "n", "k") for i, t in rows], DOCS)


def some_text(seed, n=60):
    rng = np.random.default_rng(seed)
    return " ".join(f"w{k}" for k in rng.integers(0, 5000, n))


ODD = [(None, "a text without an id"), (1, None), (2, ""), (3, "   \n\t"), (4, "short"), (4, "short"), (5, some_text(1, 30_000)), (6, "Ünï çödé ✓ 日本")]


@pytest.mark.parametrize("rows", [[], ODD])
def test_every_operator_takes_odd_rows_and_keeps_columns(spark, rows):
    df = docs(spark, rows)
    n = len(rows)
    labels = spark.createDataFrame([(4, 1), (2, 0), (None, 1), (5, None)], "doc_id long, quality int")
    bench = spark.createDataFrame([(1, "short"), (2, None), (3, "")], "item_id long, text string")
    profiles = langid.learn(df.withColumn("lang", F.lit("xx")))
    assert langid.identify(df, profiles).columns == [*df.columns, "lang_pred", "score"]
    assert langid.identify(df, profiles).count() == n
    scored = quality.score_quality(df, quality.fit_quality(df, labels))
    assert scored.where("score BETWEEN 0 AND 1").count() == n
    assert simhash.fingerprint_components(df).count() == n
    assert simhash.drop_near_duplicates(df).columns == df.columns
    assert lines.dedup_lines(df).count() == n
    assert decontaminate.find_items(df, bench).count() == n
    assert rules.keep_good(df).columns == df.columns
    assert packing.pack(df, public_tokenizers.path("word_bpe_49k.json")).where("start = 0").count() == n
    assert sharding.shard(df, shards=4).count() == n
    page_rows = df.withColumnRenamed("text", "html").withColumn("url", F.lit(None).cast("string"))
    assert pages.main_text(page_rows).count() == n
    turns = df.withColumn("turn", F.lit(0)).withColumn("role", F.when(F.col("doc_id") != 4, "user"))
    assert chat.format_chats(turns, "doc_id").count() == len({i for i, _ in rows})


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 300), (300, 200), (7, 7)]
    got = dict(components(spark.createDataFrame(chain, "a long, b long")).collect())
    assert got == {i: 0 for i in range(41)} | {100: 100, 200: 100, 300: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_numbers_are_gapless_within_keys(spark):
    df = spark.range(1000, numPartitions=7).selectExpr("IF(id % 10 < 4, NULL, id % 10) AS k", "id")
    got = numbered(df, ["k"], "n", "t").toPandas()
    assert all(sorted(g.n) == list(range(len(g))) for _, g in got.groupby("k", dropna=False))


def test_language_by_ranks_and_und(spark):
    learn = spark.createDataFrame([("en", "the cat and the dog in the house"), ("de", "der hund und die katze im haus"), (None, "xyz")], "lang string, text string")
    p = langid.learn(learn)
    assert p.predict("the dog and the cat")[0] == "en" and p.predict("die katze und der hund")[0] == "de"
    assert p.predict("123 !?") == p.predict(None) == ("und", 0.0)


def test_bk_tree_finds_what_brute_force_finds():
    rng = np.random.default_rng(5)
    v = rng.integers(0, 1 << 63, 300, np.uint64)
    v = np.concatenate([v, v[:150] ^ (np.uint64(1) << rng.integers(0, 64, 150).astype(np.uint64)), v[:10]])
    got = {(a, b) for q, n in simhash.BKTree(v).search(v, 3) for a, b in zip(q.tolist(), n.tolist(), strict=True)}
    assert got == {(a, int(b)) for a in range(len(v)) for b in np.flatnonzero(np.bitwise_count(v ^ v[a]) <= 3)}


def test_near_copies_leave_one_row_even_in_shards_of_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 8)
    base = some_text(3, 400).split()
    near = [(i, " ".join([*base[:i], f"new{i}", *base[i + 1 :]])) for i in range(40)]
    rows = [*near, (50, near[0][1]), (50, near[0][1]), (60, some_text(4)), (61, some_text(6)), (None, some_text(6))]
    kept = simhash.drop_near_duplicates(docs(spark, rows)).toPandas()
    assert sorted(kept.doc_id) == [0, 60, 61]


def test_near_copies_far_apart_in_bits_are_found(spark):
    """A phrase repeated at length adds few shingles, and pairs at 0.8 may differ in more than 16 bits."""
    base = some_text(3, 400)
    rows = [(0, base), (1, f"{base} {' '.join([base[:60]] * 300)}")]
    assert sorted(simhash.drop_near_duplicates(docs(spark, rows)).toPandas().doc_id) == [0]

    def prints(text):
        hashes = np.unique(simhash.shingle_hashes(simhash.words(text), 5))
        return set(hashes.tolist()), int(simhash.fingerprint(hashes))

    for seed in range(2000):
        shared, ends = some_text(seed, 104), [some_text(seed + k, 12) for k in (10_000, 20_000)]
        pair = [f"{shared} {e}" for e in ends]
        (a, x), (b, y) = map(prints, pair)
        if len(a & b) >= 0.8 * len(a | b) and 16 < (x ^ y).bit_count() <= 22:
            break
    assert sorted(simhash.drop_near_duplicates(docs(spark, list(enumerate(pair)))).toPandas().doc_id) == [0]


def test_normal_lines_and_their_keys(spark):
    """Any white space counts as one space, and lines a word apart share a key."""
    texts = ["", "   ", "A", " a\tB  c\r", "x\x0b\x0cY\u00a0z \u3000 É", "one two", "no  Blank\tleft ", "\tHeld\x0b"]
    line = lines.normal_line(F.col("text"))
    rows = docs(spark, list(enumerate(texts))).select("text", line.alias("line"), lines.word_count(line).alias("n")).collect()
    for r in rows:
        split = [w for w in re.split(r"[\x20\x09-\x0D]+", r.text.lower()) if w]
        assert (r.line, r.n) == (" ".join(split), len(split))
    for n in (1, 2, 3, 8, 9):
        base = [f"w{i}" for i in range(n)]
        near = [base[:i] + ["x"] + base[i + 1 :] for i in range(n)] + [base[:i] + ["x"] + base[i:] for i in range(n + 1)]
        keyed = docs(spark, list(enumerate(map(" ".join, [base, *near, ["x"] * (n + 3)]))))
        keys = [set(r[0]) for r in keyed.orderBy("doc_id").select(lines.half_keys(F.col("text"), lines.word_count(F.col("text")))).collect()]
        assert all(keys[0] & k for k in keys[1:-1]) and not keys[0] & keys[-1]


def test_lines_one_word_apart_go_and_the_earliest_stays(spark):
    line = "one two three four five six seven eight nine ten"
    rows = [
        (2, line), (1, f"short line\n{line.replace('three', 'drei')}\nshort line\n***\n***\n日本語の長い行です"), (3, line + " eleven\nits own line of more than eight words in all"),
        (4, line.replace("one", "eins").replace("ten", "zehn")), (5, line.upper()), (6, None), (7, ""), (8, "Short  LINE\nshort lines\n日本語の長い行です\n日本語の長い行だ"),
    ]
    got = {r.doc_id: (r.text, r.lines_cut) for r in lines.dedup_lines(docs(spark, rows)).collect()}
    # An equal line goes however few its words; one that is a word apart stays if it has few; marks always stay.
    assert got[1] == ("\n".join(rows[1][1].split("\n")[:2] + ["***", "***", "日本語の長い行です"]), 1)
    assert got[8] == ("short lines\n日本語の長い行だ", 2)
    assert got[4][1] == 0 and got[6] == (None, 0) and got[7] == ("", 0)
    assert got[3] == ("its own line of more than eight words in all", 1)
    assert not {2, 5} & set(got)


def test_lines_of_repeated_rows_are_not_near_to_themselves(spark):
    """The first place of a line stays, though its row is there twice and another line shares a half with it."""
    line = "one two three four five six seven eight nine ten"
    other = "one two three four five zes zeven acht negen tien"
    rows = [(1, line), (1, line), (2, other), (None, "a " + other[::-1]), (None, "a " + other[::-1]), (3, "b c " + other[::-1]), (4, line)]
    got = sorted(((r.doc_id or 0, r.text, r.lines_cut) for r in lines.dedup_lines(docs(spark, rows)).collect()))
    assert got == sorted((i or 0, t, 0) for i, t in rows[:-1])


def test_one_edit_of_words():
    a = "a b c d".split()
    for b, want in (("a b c d", True), ("a x c d", True), ("a b d", True), ("a b c x d", True), ("b a c d", False), ("a b c d e f", False)):
        assert lines.within_one_edit(a, b.split()) == want


@pytest.mark.parametrize("block_words", [1_000_000, 5])
def test_items_are_found_in_any_number_of_blocks(spark, block_words):
    item = "Alpha beta, gamma delta epsilon zeta eta theta iota kappa lambda mu"
    bench = spark.createDataFrame([(7, item), (12, "tiny item"), (13, None), (7, "other words")], "item_id long, text string")
    rows = [(1, f"Before {item.lower()} after"), (2, "a TINY: item"), (3, "alpha beta gamma"), (4, None), (5, "other words")]
    got = {r[0].doc_id: r for r in decontaminate.find_items(docs(spark, rows), bench, block_words=block_words).collect()}
    assert {k: (r.n_words, r.n_hit, r["items"]) for k, r in got.items()} == {
        1: (14, 12, ["7"]), 2: (3, 2, ["12"]), 3: (3, 0, []), 4: (0, 0, []), 5: (2, 2, ["7"])
    }
    assert got[1].clean == "Before \n after"
    assert {r.doc_id for r in decontaminate.decontaminate(docs(spark, rows), bench).collect()} == {3, 4}


def test_additive_model_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 4))
    y = (x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)
    model = quality.fit_additive(x, y)
    assert ((model.scores(x) > 0.5) == y).mean() > 0.9 and (0, 1) in model.pairs


def test_article_without_what_stands_around_it(spark):
    body = "<main class='post-12'><h1>Title &amp; more</h1><p>First, a  paragraph<br>of text.<div class='comment-list'><p>No.</p></div><p>Second one, longer.</main>"
    page = f"<html><head><title>x</title><script>a='<p>';</script></head><body><nav><p>menu</p></nav>{body}<footer>f</footer></body></html>"
    rows = [(1, "http://a.b/1", page), (2, "http://a.b/2", page.replace("post-12", "post-7")), (3, None, None), (4, "http://c.d", "plain &lt;text"), (5, "x", "<p>broken <b")]
    got = {r.page_id: r.text for r in pages.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[1] == got[2] == "Title & more\n\nFirst, a paragraph of text.\n\nSecond one, longer."
    assert got[3] == "" and got[4] == "plain <text" and got[5].startswith("broken")


def main_texts(spark, *htmls):
    rows = [(i, f"http://h{i}.b/", h) for i, h in enumerate(htmls)]
    got = pages.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    return [r.text for r in sorted(got)]


def test_marked_wrappers_keep_the_article(spark):
    text = "<p>One, a paragraph of text.</p><p>Two, one more.</p>"
    wraps = ["class='content has-sidebar'", "class='layout-sidebar-right'", "class='page with-nav'", "class='post tag-legal'", "class='related-work'"]
    htmls = [f"<body><div {w}>{text}<div class='ad-box'>buy</div></div></body>" for w in wraps]
    htmls += [f"<form><div class='widget'><article>{text}</article></div><div class='comments'><article class='comment'>No, a long one.</article></div></form>"]
    htmls += [f"<div class='banner'>{'Buy, now. ' * 30}</div><article>{text}</article>"]
    assert main_texts(spark, *htmls) == ["One, a paragraph of text.\n\nTwo, one more."] * 7


def test_articles_of_several_containers_are_whole(spark):
    long = "".join(f"<p>Paragraph {i}, of the body. It is long.</p>" for i in range(9))
    parts = [f"<h1>Head</h1><p>Lead.</p><div class='body'>{long}</div>", f"<div class='intro'><h1>Head</h1><p>Lead.</p></div><div class='body'>{long}</div><div class='end'><p>End.</p></div>"]
    rows = "".join(f"<tr><td>Cell {i}, with text. More.</td></tr>" for i in range(20))
    parts += [f"<h1>Head</h1><p>Lead.</p><table><tbody>{rows}</tbody></table><p>End.</p>", f"<p>Lead.</p><ul>{rows.replace('td>', 'li>').replace('<tr>', '').replace('</tr>', '')}</ul>"]
    for outer in ("<article>{}</article>", "<div class='post'>{}</div><div class='x'><a href='/'>all posts</a></div>", "<body>{}</body>"):
        for got, part in zip(main_texts(spark, *map(outer.format, parts)), parts, strict=True):
            assert got.split("\n\n") == [t for t in re.split(r"(?:<[^>]*>)+", part) if t]


def test_a_page_of_another_template_is_not_read_by_the_host(spark):
    text = "".join(f"<p>Paragraph {i}, of the page. It is long.</p>" for i in range(9))
    common, other = f"<body><div class='a'>{text}</div></body>", f"<body><div class='a'><p>A short line.</p></div><div class='b'>{text}</div></body>"
    rows = [(i, "http://a.b/", common) for i in range(5)] + [(9, "http://a.b/", other)]
    got = pages.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert all("Paragraph 8" in r.text for r in got)


def test_patterns_fill_sequences_and_use_every_piece():
    rng = np.random.default_rng(2)
    demand = np.bincount(rng.integers(1, 513, 5000), minlength=513)
    plan = packing.plan_of(demand, 512)
    classes = np.repeat(np.arange(513), demand)
    ranks = np.concatenate([np.arange(n) for n in demand])
    load = np.bincount(plan.sequences(classes, ranks), classes)
    assert load.max() <= 512 and load.min() > 0 and len(load) <= 1.01 * classes.sum() / 512 + 1


def test_ids_are_those_of_the_tokenizer():
    path = public_tokenizers.path("word_bpe_49k.json")
    whole, encoder = Tokenizer.from_file(path), packing.Encoder(path, 2)
    for t in ["don't STOP 12ab '' !'s", "Ünï² ½x\t\r\nµ's ß", "日本 ΑΣ …", "<|endoftext|> x", "a­b ª ÿ", " "]:
        assert np.frombuffer(encoder.encode(t), "<u4").tolist() == [*whole.encode(t, add_special_tokens=False).ids, 2]
    assert encoder.encode(None) == encoder.encode("") == np.array([2], "<u4").tobytes()


def test_chats_are_read_back_as_they_were(spark):
    texts = ["", None, "\\", "\\\\<|end|>", "<|turn|>a<|text|>b<|end|>\n", "</s>[INST] ok [/INST]", "<<SYS>>\n<", "ü✓ <\\s>", "a\nb"]
    rows = [(i % 3, i, "assistant" if i % 2 else "user<s>", t) for i, t in enumerate(texts * 4)]
    formatted = chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = {r.conv_id: r for r in chat.read_back(formatted).collect()}
    plain = {r.conv_id: r.formatted for r in formatted.collect()}
    for c in range(3):
        own = [r for r in rows if r[0] == c]
        turns = "".join(f"{r}\n{t or ''}\n" for _, _, r, t in own)
        learned = "".join(t or "" for _, _, r, t in own if r == "assistant")
        want = (len(own), hashlib.sha256(turns.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest(), len(plain[c]))
        assert tuple(got[c])[1:] == want
        assert plain[c].count("<|turn|>") == len(own) and "[INST]" not in plain[c] and "</s>" not in plain[c]


def test_shards_are_even_and_cut_only_what_is_too_large(spark):
    rows = [(i, "hot text " * 20) for i in range(400)] + [(1000 + i, some_text(i, 20 + i % 50)) for i in range(800)] + [(2000, some_text(5, 25)), (2001, None)]
    got = sharding.shard(docs(spark, rows), shards=8).toPandas().merge(docs(spark, rows).toPandas()[["doc_id", "text"]], on="doc_id")
    size = got.groupby("shard")["size"].sum()
    assert len(size) == 8 and size.max() / size.min() < 1.02
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in got.groupby("shard"))
    assert list(got.groupby("text").shard.nunique().loc[lambda n: n > 1].index) == ["hot text " * 20]
    assert all(r.text_crc32 == zlib.crc32((r.text or "").encode()) for r in got.itertuples())
