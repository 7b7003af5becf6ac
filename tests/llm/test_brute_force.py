"""Queries without SQL against plain Python over whole tables."""

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from transhume.llm import langid, quality, sharding
from transhume.llm.queries import GOOD, QUERIES, TOKENIZER

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text", "lang").collect()]


def quarter(i):
    return zlib.crc32(str(i).encode()) % 4


def grams(text):
    """n-grams of 1 to 3 letters of the words of a text, a blank at both edges of each word.

    A blank before a word is no part of a gram's number: such a gram counts as the one without it.
    """
    words = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
    out = Counter()
    joined = " " + " ".join(words) + " " if words else ""
    for n in (1, 2, 3):
        for k in range(len(joined) - n + 1):
            g = joined[k : k + n]
            if " " not in g[1:-1] and g.strip():
                out[g.lstrip()] += 1
    return out


def ranked(counts, size):
    # Ties are in the order of the numbers of the n-grams: shorter ones first, a blank counts as zero.
    number = lambda g: sum((0 if c == " " else ord(c)) << (21 * (len(g) - 1 - k)) for k, c in enumerate(g))
    return sorted(counts, key=lambda g: (-counts[g], number(g)))[:size]


def test_languages_by_ranks(spark, documents):
    profiles = {}
    for i, text, lang in documents:
        if lang is not None and quarter(i) != 2:
            profiles.setdefault(lang, Counter()).update(grams(text))
    ranks = {lang: {g: k for k, g in enumerate(ranked(c, langid.PROFILE))} for lang, c in profiles.items() if c}
    got = {r.doc_id: r for r in QUERIES["op1_language_id"](spark, SF_DIR).collect()}
    assert len(got) == len(documents)
    for i, text, _ in documents:
        top = ranked(grams(text), langid.PROFILE)
        if not top:
            want = ("und", 0.0)
        else:
            far = langid.PROFILE
            apart = {lang: sum(abs(k - r[g]) if g in r else far for k, g in enumerate(top)) for lang, r in ranks.items()}
            best = min(sorted(apart), key=apart.get)
            want = (best, 1 - apart[best] / (far * len(top)))
        assert (got[i].lang_pred, got[i].held_out) == (want[0], quarter(i) == 2) and abs(got[i].score - want[1]) < 1e-9


def test_quality_scores_are_sums_over_the_tables(spark, documents):
    """The model is fitted once more on its bounded sample; each score is added up entry by entry."""
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept = F.crc32(F.col("doc_id").cast("string")) % 4 != 2
    model = quality.fit_quality(docs.where(kept), labels.where(kept))
    got = {r.doc_id: r for r in QUERIES["op3_quality"](spark, SF_DIR).collect()}
    assert len(got) == len(documents)
    for i, text, _ in documents:
        x = quality.features(text)
        total = model.base
        for j, table in enumerate(model.tables):
            total += table[sum(x[j] >= c for c in model.cuts[j])]
        for (a, b), table in zip(model.pairs, model.pair_tables, strict=True):
            total += table[sum(x[a] >= c for c in model.pair_cuts[a]), sum(x[b] >= c for c in model.pair_cuts[b])]
        score = 1 / (1 + np.exp(-total))
        assert abs(got[i].score - score) < 1e-9 and got[i].predicted == int(got[i].score >= GOOD)
        assert got[i].held_out == (quarter(i) == 2)


def test_the_sample_is_bounded(spark):
    rows = [(i % 5, f"text number {k} " * 5) for k, i in enumerate(range(200))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(5)], "doc_id long, quality int")
    seen = []
    fit = quality.fit_additive
    try:
        quality.fit_additive = lambda x, y, **how: seen.append(len(x)) or fit(x, y, **how)
        quality.fit_quality(docs, labels, sample=30)
    finally:
        quality.fit_additive = fit
    assert seen == [30]


def test_pieces_hold_the_ids_of_the_tokenizer(spark, documents):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(TOKENIZER))
    got = {}
    for r in QUERIES["op8_packing"](spark, SF_DIR).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert set(got) == {i for i, _, _ in documents}
    fill = Counter()
    for i, text, _ in documents:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        at = 0
        for piece in sorted(got[i], key=lambda r: r.start):
            part = np.array(ids[piece.start : piece.start + piece.length], "<u4").tobytes()
            assert (piece.start, piece.ids_crc32, piece.doc_tokens) == (at, zlib.crc32(part), len(ids)) and piece.length > 0
            at += piece.length
            fill[piece.sequence_id] += piece.length
        assert at == len(ids)
    assert max(fill.values()) <= 4096 and sum(fill.values()) > 0.95 * 4096 * (len(fill) - 1)


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_shards_hold_every_document_once(spark, sf):
    sf_dir = SF_DIR.replace("0.001", sf)
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op10_sharding"](spark, sf_dir).collect()
    data = {i: (t or "").encode() for i, t in rows}
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in rows)
    size, slots, group = np.zeros(16), [[] for _ in range(16)], {}
    for r in got:
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data[r.doc_id]) + 1, zlib.crc32(data[r.doc_id]), "bytes", None)
        size[r.shard] += r.size
        slots[r.shard].append(r.slot)
        group.setdefault(data[r.doc_id], set()).add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots)
    assert size.max() - size.min() <= max(r.size for r in got)
    # All three are balanced: a row more or less, and a thousandth of bytes and tokens where documents are many.
    rows_of, words = np.zeros(16), np.zeros(16)
    for r in got:
        rows_of[r.shard] += 1
        words[r.shard] += len(data[r.doc_id].decode().split())
    if len(got) > 500:
        assert np.ptp(rows_of) <= 2
        assert np.ptp(size) < 0.001 * size.mean() and np.ptp(words) < 0.001 * words.mean()
    total = size.sum() / 16
    copies = Counter(data[r.doc_id] for r in got)
    assert all(len(s) == 1 for t, s in group.items() if copies[t] * (len(t) + 1) < total)


def test_groups_beyond_a_shard_are_cut(spark):
    rows = [(i, "the same text") for i in range(300)] + [(1000 + i, f"own text {i}") for i in range(300)]
    got = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string"), shards=4).collect()
    size = Counter()
    for r in got:
        size[r.shard] += r.size
    assert len(got) == 600 and len(size) == 4 and max(size.values()) - min(size.values()) <= 2 * 14
