"""Per-query score normalisation and exact order-statistic features.

Size, mean and standard deviation of every group are counted first, in one
table (partial aggregation; a hot query costs one row per map task), and joined
back with ``join_groups``: one scan of the rows and one join, in which a query
with any share of the rows is cut by salts, or dropped where it is read if its
size is out of range.  Groups outside [lo, hi] are gone *before* any list is
built, so every collected group holds at most ``hi`` (12,000) entries.

Semantics follow the reference: z = (x - mean) / population std; fractiles
are the values at 0-based positions floor(n/4), floor(n/2), floor(0.75 n) of
the scores sorted **descending** (not interpolated), raw and z.  Null scores
count in ``num`` but not in the statistics (D8); std 0 gives null z (D9).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qsig.fixed import FRACTILE_POINTS, MAX_GROUP, MIN_GROUP
from qsig.operators.skew import join_groups

POINTS = tuple(zip(("quarter", "half", "three_quarters"), FRACTILE_POINTS))


def collect_scores(df: DataFrame, by: str = "query", sku: str = "sku", score: str = "score") -> DataFrame:
    """F1 in long form: ``(query, num, sku, score)``, every row of every query
    with ``num`` = rows of its query.  Queries of any size are kept: the list
    stays rows, so none is built in one task."""
    rows = df.select(by, F.col(sku).alias("sku"), F.col(score).alias("score"))
    return join_groups(rows, group_sizes(df, by), [by], "num").select(by, "num", "sku", "score")


def group_sizes(df: DataFrame, by: str = "query") -> DataFrame:
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("num"))


def score_stats(df: DataFrame, by: str = "query", score: str = "score") -> DataFrame:
    """One row per group: ``num`` rows, ``mean`` and population ``std`` of the
    scores that are not null."""
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("num"), F.avg(score).alias("mean"),
                              F.stddev_pop(score).alias("std"))


def size_filter(df: DataFrame, lo: int = MIN_GROUP, hi: int = MAX_GROUP, by: str = "query") -> DataFrame:
    """rows of groups with ``lo <= num <= hi``, with ``num`` attached."""
    return join_groups(df, group_sizes(df, by), [by], "num", F.col("num").between(lo, hi))


def _z(x, stats_mean="mean", stats_std="std"):
    return F.try_divide(x - F.col(stats_mean), F.when(F.col(stats_std) != 0, F.col(stats_std)))


def _scored(df: DataFrame, by: str, score: str, out: str, sizes: tuple[int, int] | None) -> DataFrame:
    """``df`` with ``out``, the z-score, by one join with the table of groups;
    with ``sizes`` only groups of that many rows."""
    stats = score_stats(df, by, score).withColumnsRenamed({"mean": "__mean", "std": "__std", "num": "__num"})
    joined = join_groups(df, stats, [by], "__num", F.col("__num").between(*sizes) if sizes else None)
    return joined.withColumn(out, _z(F.col(score), "__mean", "__std")).drop("__mean", "__std", "__num")


def zscore(df: DataFrame, by: str = "query", score: str = "score", out: str = "z",
           sizes: tuple[int, int] | None = None) -> DataFrame:
    """adds ``out`` = (score - mean) / population std within ``by``; with
    ``sizes`` = (lo, hi) of the groups that F2 keeps, in the same join."""
    return _scored(df, by, score, out, sizes)


def fractiles(df: DataFrame, by: str = "query", score: str = "score", lo: int = MIN_GROUP,
              hi: int = MAX_GROUP) -> DataFrame:
    """``(query, quarter_n, quarter, half_n, half, three_quarters_n, three_quarters)``
    for groups with ``lo <= num <= hi``; the size is counted before any list is
    built, so the descending array holds at most ``hi`` doubles."""
    rows = size_filter(df, lo, hi, by)
    sorted_desc = F.sort_array(F.collect_list(score), asc=False)
    g = rows.groupBy(by).agg(sorted_desc.alias("v"), F.avg(score).alias("mean"),
                             F.stddev_pop(score).alias("std"))
    n = F.size("v")
    cols = [by]
    for name, p in POINTS:
        val = F.get(F.col("v"), F.floor(n * F.lit(p)).cast("int"))
        cols += [_z(val).alias(f"{name}_n"), val.alias(name)]
    return g.select(*cols)


def _lowest(z: DataFrame, by: str, sku: str, score: str) -> DataFrame:
    return z.where(F.col(score).isNotNull()).groupBy(by, sku).agg(F.min("z").alias("z"))


def score_map_long(df: DataFrame, by: str = "query", sku: str = "sku", score: str = "score",
                   sizes: tuple[int, int] | None = None) -> DataFrame:
    """F5 long form: ``(query, sku, z)``; a repeated sku keeps its lowest z."""
    return _lowest(_scored(df, by, score, "z", sizes), by, sku, score)


def score_map(df: DataFrame, by: str = "query", sku: str = "sku", score: str = "score", lo: int = MIN_GROUP,
              hi: int = MAX_GROUP) -> DataFrame:
    """``(query, sku_score_normal map<string,double>)`` for groups with
    ``lo <= num <= hi`` (so a map holds at most ``hi`` entries)."""
    longf = score_map_long(df, by, sku, score, (lo, hi)).where(F.col(sku).isNotNull())
    m = F.map_from_entries(F.collect_list(F.struct(F.col(sku), F.col("z"))))
    return longf.groupBy(by).agg(m.alias("sku_score_normal"))


def query_features(df: DataFrame, lo: int = MIN_GROUP, hi: int = MAX_GROUP, by: str = "query",
                   sku: str = "sku", score: str = "score") -> DataFrame:
    """the reference's 9-column row per query with lo <= num <= hi.

    Two passes over the input: group sizes (partial aggregate), then one scan
    and grouping of the kept queries that yields mean and population std
    (built-in aggregates), the descending scores and a bounded (sku, score)
    list; z values and the de-duplicated sku → z map are array expressions on
    that list — no further joins or shuffles.
    """
    x = F.col(score).cast("double")
    g = (size_filter(df, lo, hi, by).groupBy(by)
         .agg(F.first("num").alias("num"),
              F.sort_array(F.collect_list(x), asc=False).alias("v"),      # nulls are skipped
              F.avg(x).alias("mean"), F.stddev_pop(x).alias("std"),
              F.collect_list(F.when(x.isNotNull() & F.col(sku).isNotNull(),
                                    F.struct(F.col(sku).alias("k"), x.alias("s")))).alias("it")))
    zs = F.transform("it", lambda e: F.struct(e["k"].alias("k"), _z(e["s"]).alias("z")))
    g = g.withColumn("zs", F.array_sort(zs))   # by sku, then z: first of a sku holds its lowest z
    dedup = F.filter("zs", lambda e, i: (i == 0) | (e["k"] != F.get(F.col("zs"), i - 1)["k"]))
    cols = [by, F.col("num").cast("int").alias("num"), F.map_from_entries(dedup).alias("sku_score_normal")]
    for name, p in POINTS:
        val = F.get(F.col("v"), F.floor(F.size("v") * F.lit(p)).cast("int"))
        cols += [_z(val).alias(f"{name}_n"), val.alias(name)]
    return g.select(*cols)
