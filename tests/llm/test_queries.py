"""The registered queries: against their SQL where there is one, else against brute force or labels."""

import os
import re

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from check import compare, connect
from transhume.llm.queries import ORACLES, QUERIES
from transhume.session import stage

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the test tables are not there")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, name):
    assert compare(spark, connect(SF_DIR), name, SF_DIR) == []


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet").toPandas().set_index("doc_id")


def test_languages(spark, documents):
    got = QUERIES["op1_language_id"](spark, SF_DIR).toPandas().set_index("doc_id").join(documents.lang)
    assert len(got) == len(documents) and (got.lang == got.lang_pred)[got.held_out].mean() > 0.95


def test_fingerprints_and_classes(spark, documents):
    got = QUERIES["op2_simhash"](spark, SF_DIR).toPandas().set_index("doc_id")
    prints = {}
    for i, t in documents.text.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t))
        runs = [" ".join(w[k : k + 3]) for k in range(len(w) - 2)] or [" ".join(w)] * bool(w)
        h = [xxhash.xxh64_intdigest(s, seed=42) for s in runs]
        prints[i] = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    label = {i: i for i in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            for b in prints:
                if (prints[a] ^ prints[b]).bit_count() <= 3 and label[b] < label[a]:
                    label[a], changed = label[b], True
    assert {i: int(r.fingerprint, 16) for i, r in got.iterrows()} == prints
    assert got.component_id.to_dict() == label


def test_quality_of_held_out_rows(spark):
    sf_dir = SF_DIR.replace("0.001", "0.01")
    got = QUERIES["op3_quality"](spark, sf_dir).toPandas().merge(spark.read.parquet(f"{sf_dir}/labels.parquet").toPandas(), on="doc_id")
    held = got[got.held_out]
    assert got.score.between(0, 1).all() and (held.predicted == held.quality).mean() > 0.95


def test_pieces_hold_all_ids_once(spark, documents):
    got = QUERIES["op8_packing"](spark, SF_DIR).toPandas().sort_values(["doc_id", "start"])
    for _, g in got.groupby("doc_id"):
        assert g.start.tolist() == (g.length.cumsum() - g.length).tolist() and g.length.sum() == g.doc_tokens.iloc[0]
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        assert g.offset.tolist() == (g.length.cumsum() - g.length).tolist() and g.length.sum() <= 4096
    assert set(got.doc_id) == set(documents.index)


def test_pipeline_stages_work_on_what_is_left(spark, documents):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, apply in corpus_pipeline.STAGES[:-1]:
        docs = stage(apply(spark, docs, SF_DIR), f"test_{name}")
        assert docs.columns == columns and 0 < docs.count() <= before
        before = docs.count()
    final = docs.toPandas()
    shingles = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in (t.lower().split() for t in final.text)]
    for a in range(len(shingles)):
        for b in range(a):
            assert len(shingles[a] & shingles[b]) < 0.8 * len(shingles[a] | shingles[b])
    bench = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").toPandas()
    assert not np.any([" ".join(t.lower().split()) in " ".join(d.lower().split()) for t in bench.text for d in final.text])
    assert set(corpus_pipeline.run(spark, SF_DIR).toPandas().doc_id) == set(final.doc_id)
