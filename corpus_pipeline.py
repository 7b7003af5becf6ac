"""A training corpus from raw documents: five stages, each written and read again by the next.

The stages take (spark, docs, sf_dir) and return a DataFrame; all but the last return the
columns of the documents. Nulls, empty texts, repeated rows and empty tables are handled as
the docstrings of the operators say. An empty result of a stage goes through all that follow.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from transhume.llm import decontaminate, lines, packing, quality, simhash
from transhume.llm.queries import GOOD, TOKENIZER, held_out, table
from transhume.session import stage


def free_name(docs: DataFrame, name: str) -> str:
    """A name that no column has."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def columns_of(docs: DataFrame) -> list[Column]:
    return [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model accepts."""
    labels = table(spark, sf_dir, "labels").where(~held_out())
    model = quality.fit_quality(docs.where(~held_out()), labels)
    score = free_name(docs, "_score")
    return quality.score_quality(docs, model, score_col=score).where(F.col(score) >= GOOD).select(*columns_of(docs))


def unrepeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier line repeats; those of which nothing is left go."""
    cut = lines.dedup_lines(docs, cut_col=free_name(docs, "_cut"))
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return cut.select(*columns_of(docs))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity 0.8."""
    return simhash.drop_near_duplicates(docs)


def clean_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 4096 tokens."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality", good_documents),
    ("line_dedup", unrepeated_lines),
    ("near_dedup", distinct_documents),
    ("decontamination", clean_documents),
    ("packing", packed),
]

#: A fitted model, shingle similarities and tokens are beyond SQL; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
