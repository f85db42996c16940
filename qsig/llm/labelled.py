"""Bounded, documented samples of labelled documents for training."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(id_col: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts`` (null ids: null)."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % parts


@dataclass
class Sample:
    texts: list[str]
    labels: list[int]


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, train: Column,
                    per_class: tuple[int, int], max_chars: int) -> Sample:
    """At most ``per_class[y]`` documents of each label ``y`` (0 and 1), by hash
    order of the id, among label rows where ``train`` holds.

    The two bounds (``per_class`` rows, texts of at most ``max_chars``
    characters) hold whatever the size of the tables, so the sample fits the
    driver.  Labels other than 0 and 1, null ids and null or longer texts are
    not used for training.  Repeated label rows count once; an id labelled
    both ways is given as often as it has labels.
    """
    ids = (labels.where(train & F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
           .select(F.col("doc_id").alias("__id"), F.col(label).cast("int").alias("__y")).distinct())
    order = F.xxhash64("__id").asc(), F.col("__id").asc()
    picked = ids.where("__y = 0").orderBy(*order).limit(per_class[0]).unionByName(
        ids.where("__y = 1").orderBy(*order).limit(per_class[1]))
    rows = (docs.select("doc_id", "text").where(F.length("text") <= max_chars)
            .join(F.broadcast(picked), F.col("doc_id") == F.col("__id"))
            .groupBy("__id", "__y").agg(F.min("text").alias("text"))
            .orderBy("__y", "__id").select("text", "__y").toPandas())
    return Sample(rows["text"].tolist(), [int(y) for y in rows["__y"]])
