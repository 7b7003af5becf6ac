"""Stages of the pipeline against plain Python on small tables."""

import re

import numpy as np
import pytest

import corpus_pipeline
from transhume.llm import quality
from transhume.llm.queries import GOOD, held_out
from transhume.session import stage

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _score double, _cut int, `a.b` string"
VOWELS = np.array(list("aeiou"))


def prose(seed, lines=6, words=14):
    rng = np.random.default_rng(seed)
    word = lambda: "".join(rng.choice(list("bcdfgklmnprst")) + rng.choice(VOWELS) for _ in range(rng.integers(1, 4)))
    return "\n".join(" ".join(word() for _ in range(words)).capitalize() + "." for _ in range(lines))


def fixture():
    rows = [(i, prose(i)) for i in range(30)]
    rows += [(100 + i, rows[i][1]) for i in range(5)]  # copies
    rows += [(200 + i, rows[10 + i][1] + "\n" + prose(900 + i, 1)) for i in range(4)]  # near copies
    shared = "A licence line that stands in many documents, word for word, as it is."
    rows += [(300 + i, prose(300 + i) + "\n" + shared + "\nOK") for i in range(4)]
    rows += [(400, prose(300)), (400, prose(300))]  # a repeated row
    rows += [(500, prose(500, 8) + "\n" + "one phrase again and again " * 40)]
    rows += [(600, None), (601, ""), (None, prose(700)), (602, prose(800) + " item of the benchmark that has ten words or more of them")]
    rows += [(700 + i, "$ % # @ ! " * 30 + str(i)) for i in range(12)]  # junk
    return [(i, t, "xx", "s", len(t or ""), 0.5, i and i % 7, "dotted") for i, t in rows]


@pytest.fixture
def sf_dir(spark, tmp_path):
    def write(rows):
        spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
        labels = [(r[0], int(not (r[1] or "").startswith("$"))) for r in rows if r[0] is not None]
        spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
        bench = [("x", "Item of the benchmark that has ten words or more of them"), ("y", None)]
        spark.createDataFrame(bench, "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
        return str(tmp_path)

    return write


def apart_by_a_word(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) <= 1
    a, b = sorted((a, b), key=len)
    return any(a == b[:k] + b[k + 1 :] for k in range(len(b)))


def cut_lines(docs, digest):
    """Rows after line dedup: every line against all lines before it."""
    place = lambda r: (r[0] is None, r[0] or 0, digest(r[1] or ""))
    seen, cuts = [], {}
    for r in sorted({(r[0], r[1]) for r in docs}, key=place):
        for k, line in enumerate((r[1] or "").split("\n") if r[1] is not None else []):
            words = line.lower().split()
            if len(" ".join(words)) < 8:
                continue
            if any(words == s or (min(len(words), len(s)) >= 8 and apart_by_a_word(words, s)) for s in seen):
                cuts.setdefault((r[0], r[1]), set()).add(k)
            seen.append(words)
    out = []
    for r in docs:
        cut = cuts.get((r[0], r[1]), ())
        text = r[1] if not cut else "\n".join(x for k, x in enumerate(r[1].split("\n")) if k not in cut)
        if not cut or text.strip():
            out.append((r[0], text))
    return out


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) or frozenset([tuple(w)] if w else [])


def near_classes(texts):
    label = list(range(len(texts)))
    sets = [shingles(t) for t in texts]

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            if sets[a] == sets[b] or len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                label[y] = x
    return [root(x) for x in range(len(texts))]


def test_stages_against_plain_python(spark, sf_dir):
    from hashlib import md5

    folder = sf_dir(fixture())
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = docs.columns
    key = lambda rows: sorted(((i is None, i or 0, t or "", t is None) for i, t in rows))
    # Quality: the model of this table, asked for every text.
    labels = spark.read.parquet(f"{folder}/labels.parquet").where(~held_out())
    model = quality.fit_quality(docs.where(~held_out()), labels)
    scores = {t: float(model.scores(quality.features(t)[None])[0]) for t in {r.text for r in docs.collect()}}
    good = stage(corpus_pipeline.good_documents(spark, docs, folder), "test_good")
    assert good.columns == names and {r["_score"] for r in good.collect()} == {0.5}
    assert key((r.doc_id, r.text) for r in good.collect()) == key((r.doc_id, r.text) for r in docs.collect() if scores[r.text] >= GOOD)
    assert not any(t.startswith("$") for t in (r.text or "" for r in good.collect()))
    # Lines: each against all lines before it.
    cut = stage(corpus_pipeline.unrepeated_lines(spark, good, folder), "test_cut")
    assert cut.columns == names and all(r.n_chars == len(r.text or "") for r in cut.collect() if r.text is not None)
    before = [(r.doc_id, r.text) for r in good.collect()]
    after = [(r.doc_id, r.text) for r in cut.collect()]
    assert key(after) == key(cut_lines(before, lambda t: md5(t.encode()).digest()))
    assert len(after) < len(before)
    # Near duplicates: all pairs of texts.
    one = stage(corpus_pipeline.distinct_documents(spark, cut, folder), "test_one")
    assert one.columns == names
    classes = near_classes([t for _, t in after])
    groups = {}
    for (i, t), c in zip(after, classes, strict=True):
        groups.setdefault(c, []).append((i is None, i or 0, md5((t or "").encode()).digest(), t))
    want = sorted((min(g)[0], min(g)[1], min(g)[3] or "") for g in groups.values())
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in one.collect()) == want
    # Benchmark: the item is in no text.
    clean = stage(corpus_pipeline.clean_documents(spark, one, folder), "test_clean")
    gone = {r.doc_id for r in one.collect()} - {r.doc_id for r in clean.collect()}
    assert gone == {602} and clean.columns == names
    # Packing: the documents that are left, whole.
    packed = corpus_pipeline.run(spark, folder).collect()
    assert sorted({r.doc_id for r in packed}, key=repr) == sorted({r.doc_id for r in clean.collect()}, key=repr)


def test_an_empty_table_goes_through(spark, sf_dir):
    assert corpus_pipeline.run(spark, sf_dir([])).count() == 0
