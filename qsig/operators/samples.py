"""Positive and seeded negative query pairs from graph paths.

Negatives: every distinct name draws ``k`` partners uniformly (with
replacement) from the dense index 0..N-1 and is paired with the name at that
index — an equi-join on the index, no pairs enumerated.  Draws are md5 of
(name, draw number, seed): reproducible for any partitioning and on retry.

Positives: consecutive names along a path.  Names are de-duplicated per path
(first position kept); paths are cut into slices of (path, position), so a very
long path is split over many tasks, and each name finds its successor within
its slice or as the first name of the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qsig.functions.hashing import draw_int
from qsig.operators import ordering
from qsig.sources.io import stage
from qsig.fixed import NEGATIVES_PER_NAME


def _valid(df: DataFrame, col: str = "name") -> DataFrame:
    c = F.col(col)
    return df.where(c.isNotNull() & (c != ""))


def distinct_names(df: DataFrame, col: str = "name") -> DataFrame:
    """Distinct non-null, non-empty names."""
    return _valid(df, col).select(col).distinct()


def dense_index(df: DataFrame, col: str = "name", name: str = "idx") -> DataFrame:
    """``(name, idx)`` with idx 0..N-1 over the distinct names."""
    return ordering.dense_index(_valid(df, col), col, name)


def name_count(df: DataFrame, col: str = "name") -> DataFrame:
    """One row ``count`` = number of distinct valid names."""
    return _valid(df, col).agg(F.count_distinct(col).alias("count"))


def _draws(names: DataFrame, k: int, seed: int, col: str) -> DataFrame:
    n = names.agg(F.count(F.lit(1))).scalar()
    j = F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("draw_no")
    return names.select(col, j).select(col, "draw_no", draw_int(n, [col, "draw_no"], seed).alias("draw"))


def random_draws(df: DataFrame, k: int = NEGATIVES_PER_NAME, seed: int = 0, col: str = "name") -> DataFrame:
    """``(name, draw_no, draw)``: k uniform draws in [0, N) per name."""
    return _draws(distinct_names(df, col), k, seed, col)


def negative_pairs(df: DataFrame, k: int = NEGATIVES_PER_NAME, seed: int = 0, drop_self: bool = False,
                   col: str = "name") -> DataFrame:
    """``(query_1, query_2, label=0)``: each name with its k drawn names.

    The distinct names (far fewer rows than the paths) are staged once and
    feed N, the draws and the dense index, so the path table is scanned
    once.  Self pairs and repeated pairs are kept unless ``drop_self``."""
    names = stage(distinct_names(df, col), "distinct_names")
    draws = _draws(names, k, seed, col)
    idx = ordering.index_of(names, col, "idx").select(F.col("idx").alias("draw"), F.col(col).alias("query_2"))
    out = draws.join(idx, "draw").select(F.col(col).alias("query_1"), "query_2",
                                         F.lit(0).alias("label"))
    return out.where(F.col("query_1") != F.col("query_2")) if drop_self else out


def _path_members(df: DataFrame, order_col: str | None) -> DataFrame:
    """(pathid, name, ord): one row per name of a path at its first position;
    without an order column names are ordered alphabetically."""
    v = _valid(df)
    if order_col is None:
        return v.select("pathid", "name").distinct().withColumn("ord", F.lit(0))
    return v.groupBy("pathid", "name").agg(F.min(order_col).alias("ord"))


def path_list(df: DataFrame, order_col: str | None = None) -> DataFrame:
    """Each path's distinct names in path order, as rows ``(pathid, pos, name)``
    with pos 1..n (D3).  The reference builds one ``&&``-joined string per
    path; the ordered long form carries the same list without collecting a
    path of unbounded length into one value, and a long path is numbered by
    the distributed ordinal."""
    m = _path_members(df, order_col)
    ranked = ordering.rank_within(m, ["pathid"], [ordering.asc("ord"), ordering.asc("name")], "pos")
    return ranked.select("pathid", "pos", "name")


def positive_pairs(df: DataFrame, order_col: str | None = None) -> DataFrame:
    """``(query_1, query_2, label=1)`` for consecutive names of a path.

    A path of any length is split over many tasks (``ordering.successors``)."""
    nexts = ordering.successors(_path_members(df, order_col), ["pathid"], [ordering.asc("ord"), ordering.asc("name")],
                                "name", "query_2")
    return nexts.where(F.col("query_2").isNotNull()).select(F.col("name").alias("query_1"), "query_2", F.lit(1).alias("label"))


def labelled_pairs(df: DataFrame, k: int = NEGATIVES_PER_NAME, seed: int = 0, order_col: str | None = None) -> DataFrame:
    """Negatives (label 0) and positives (label 1) in one table."""
    return negative_pairs(df, k, seed).unionByName(positive_pairs(df, order_col))
