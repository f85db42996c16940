"""Corpus pipeline: toxicity, line dedup, SimHash near-dedup, benchmark
decontamination, mixing — each stage one operator of ``qsig.llm``.

All stages but the last return the columns of their input, whatever else than
``doc_id``, ``text`` and (mixing) ``source`` these are.  Decisions meet the
rows by doc_id and a hash of the text, null like null; rows that share both
are one document and decided alike.  An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qsig.llm import decontaminate, line_dedup, mixing, simhash, toxicity
from qsig.llm.queries import toxicity_model
from qsig.sources import io


def _decided(docs: DataFrame, decided: DataFrame, one: bool) -> DataFrame:
    """Rows of ``docs`` whose (doc_id, text hash) is in ``decided``, with the
    columns of ``docs``; with ``one``, of rows that share both the least by
    all columns (a task sends one of its own, however many there are)."""
    # written, so that rows of one id and text, however many, can be split in the join
    keys = io.stage(decided.select(F.col("doc_id").alias("__llm_id"), F.col("text_hash").alias("__llm_k")).distinct(),
                    "pipeline-keys")
    d = docs.withColumn("__llm_h", F.xxhash64("text"))
    out = d.join(keys.hint("merge"), d["doc_id"].eqNullSafe(keys["__llm_id"]) & (d["__llm_h"] == keys["__llm_k"]), "left_semi")
    cols = [F.col(f"`{c}`") for c in docs.columns]
    if one:
        row = F.struct(*[c.alias(f"c{i}") for i, c in enumerate(cols)])
        least = out.groupBy("doc_id", "__llm_h").agg(F.min(row).alias("row"))
        return least.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(docs.columns)])
    return out.select(*cols)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored under one half stay.  Null and empty texts are scored
    like any other text and stay; repeated rows stay or go together."""
    return _decided(docs, toxicity.score(docs, toxicity_model(spark, sf_dir)).where("score < 0.5"), one=False)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeated runs of lines leave the texts; every document stays, also
    with nothing left.  Null texts stay null; repeated rows lose the same."""
    return line_dedup.line_dedup(docs).select(*[F.col(f"`{c}`") for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays: the smallest doc_id, null ids
    last.  Texts without words are one group; of repeated rows one stays."""
    return _decided(docs, simhash.near_duplicates(docs, shingle=4, distance=4).where("keep"), one=True)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item stay; null and empty texts hold
    none, repeated rows stay or go together."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _decided(docs, decontaminate.decontaminate(docs, benchmark, min_item=1).where("not contaminated"), one=False)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed order of what is left; nothing goes.  A null source is one of
    its own, null ids are spread by their place, repeated rows take
    neighbouring places."""
    return mixing.mix(docs, exponent=0.5, block=16)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("simhash", near_dedup),
    ("decontaminate", drop_leaks),
    ("mixing", mix_sources),
]

#: toxicity is a trained model, SimHash and edit distance need functions that
#: DuckDB lacks: SQL cannot express the stages (see tests/llm/test_corpus.py)
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = io.stage(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
