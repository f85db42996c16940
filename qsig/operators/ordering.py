"""Per-group ordinals that stay distributed when one group is huge.

``row_number() OVER (PARTITION BY key ORDER BY ...)`` sends every row of a
key to one task.  With a limit (top-k) that is harmless: Spark plans a
``WindowGroupLimit`` before the shuffle, so each map task forwards at most k
rows per key.  Without a limit a key holding a third of the rows would be
numbered by a single task, so (key, order) is cut into slices:

1. splitters between slices come from a bounded sample of the rows (those with
   the smallest hashes, so the same ones every time), read when the plan is
   built and part of it as one literal array;
2. a row's slice is the number of splitters up to it, by binary search: a
   function of the row alone, so every branch of the plan, and a task that runs
   again, sees the same slices, and no row is written in between;
3. rows are numbered inside each (slice, key) with a window, bounded by the
   slice; per (slice, key) counts form a table of at most #keys + #slices rows,
   whose running sum over slices gives each one's offset;
4. the offsets join back on (slice, key): the big side is already
   hash-partitioned on exactly those columns, so only the small table moves.

Where the sample has fewer than ``HOT_SAMPLE`` rows of every group, no group
is hot and the plain window numbers the rows: one shuffle, no counts, no join.

The result equals the single-window ``row_number`` whenever the order is a
total order (callers always pass full tie-breakers).  Key and order columns
must come out the same when they are computed again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qsig.sources.io import stage

PID = "__qsig_pid"
KEY = "__qsig_key"
SAMPLE_PER_SLICE = 20
HOT_SAMPLE = 4              # rows of a group in the sample from which it is hot: a fifth of a slice


@dataclass(frozen=True)
class Order:
    """One order column: ``sort`` for windows, ``key`` a value that ascends
    as the column is sorted."""

    sort: Column
    key: Column


def asc(col: str) -> Order:
    """Ascending, nulls first; any type."""
    return Order(F.col(col).asc_nulls_first(), F.col(col))


def desc(col: str) -> Order:
    """Descending, nulls last; numbers only.  NaN counts as the greatest."""
    c = F.col(col)
    nan = F.isnan(c.cast("double"))
    place = F.when(c.isNull(), 2).when(nan, 0).otherwise(1)
    return Order(c.desc_nulls_last(), F.struct(place.alias("place"), F.when(place == 1, -c).alias("value")))


def _place(splitters: Column, key: Column, most: int) -> Column:
    """How many of at most ``most`` sorted splitters are up to ``key``."""
    start = F.struct(F.lit(0).alias("lo"), F.size(splitters).alias("hi"))

    def step(at: Column, _: Column) -> Column:
        mid = ((at["lo"] + at["hi"]) / 2).cast("int")
        up = F.get(splitters, mid) <= key
        return (F.when(at["lo"] >= at["hi"], at)
                .when(up, F.struct((mid + 1).alias("lo"), at["hi"].alias("hi")))
                .otherwise(F.struct(at["lo"].alias("lo"), mid.alias("hi"))))

    steps = F.array(*[F.lit(i) for i in range(most.bit_length() + 1)])
    return F.aggregate(steps, start, step, lambda at: at["lo"])


def _place_of(by: list[str], order: list[Order]) -> Column:
    """A row's place: its group, then its order."""
    group = F.struct(*[F.col(c) for c in by]) if by else F.struct(F.lit(0).alias("all"))
    return F.struct(group.alias("by"), F.struct(*[o.key.alias(f"o{i}") for i, o in enumerate(order)]).alias("order"))


def _splitters(df: DataFrame, by: list[str], order: list[Order], slices: int) -> tuple[Column, bool]:
    """Splitters between slices from a bounded sample of the rows, and whether
    it has ``HOT_SAMPLE`` rows of one group: none that the sample has fewer of
    holds much more than a slice's share."""
    drawn = df.select(_place_of(by, order).alias("k")).select("k", F.xxhash64("k").alias("h"))
    some = drawn.orderBy("h", "k").limit(SAMPLE_PER_SLICE * slices).agg(F.sort_array(F.collect_list("k")).alias("k"))
    cuts = F.transform(F.sequence(F.lit(1), F.lit(max(1, slices - 1))),
                       lambda i: F.get(F.col("k"), (i * F.size("k") / slices).cast("int")))
    hot = F.exists(F.sequence(F.lit(0), F.size("k")),
                   lambda i: F.get(F.col("k"), i)["by"] == F.get(F.col("k"), i + F.lit(HOT_SAMPLE - 1))["by"])
    # not named k again: the lambdas would read the new column
    cuts = some.select(F.array_compact(F.array_distinct(cuts)).alias("cuts"), F.coalesce(hot, F.lit(False)).alias("hot"))
    text, hot = cuts.select(F.to_json("cuts"), "hot").first()
    return F.from_json(F.lit(text), cuts.schema["cuts"].dataType), hot


def _cut(df: DataFrame, by: list[str], order: list[Order], splitters: Column, slices: int) -> DataFrame:
    place = _place_of(by, order)
    return df.withColumn(PID, _place(splitters, place, slices)).withColumn(KEY, place["by"])


def _slices(df: DataFrame, slices: int | None) -> int:
    return slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def sliced(df: DataFrame, by: list[str], order: list[Order], slices: int | None = None) -> DataFrame:
    """``df`` with its slice number and its key: slices follow (by, order) and
    hold about as many rows each."""
    slices = _slices(df, slices)
    return _cut(df, by, order, _splitters(df, by, order, slices)[0], slices)


def _cut_if_hot(df: DataFrame, by: list[str], order: list[Order], slices: int | None) -> DataFrame | None:
    """``sliced``, or None where no group needs it."""
    slices = _slices(df, slices)
    splitters, hot = _splitters(df, by, order, slices)
    return _cut(df, by, order, splitters, slices) if hot else None


def rank_within(df: DataFrame, by: list[str], order: list, name: str = "rank", limit: int | None = None,
                slices: int | None = None) -> DataFrame:
    """``name`` = 1-based row number of each row within ``by`` by ``order``.

    With ``limit`` only rows with ordinal <= limit are returned (top-k per
    group, planned as ``WindowGroupLimit``); ``order`` may then be any sort
    columns.  Without a limit ``order`` is a list of ``asc`` and ``desc``, and
    the plan above numbers groups of any size; columns outside key and order
    are carried along."""
    sort = [o.sort if isinstance(o, Order) else o for o in order]
    if limit is not None:
        w = Window.partitionBy(*by).orderBy(*sort) if by else Window.orderBy(*sort)
        return df.withColumn(name, F.row_number().over(w).cast("bigint")).where(F.col(name) <= F.lit(limit))
    cols = [F.col(f"`{c}`") for c in df.columns]
    cut = _cut_if_hot(df, by, order, slices)
    if cut is None:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*sort)).cast("bigint"))
    local = cut.withColumn("__qsig_lpos", F.row_number().over(Window.partitionBy(PID, KEY).orderBy(*sort)))
    counts = cut.groupBy(PID, KEY).agg(F.count(F.lit(1)).alias("__qsig_cnt"))
    before = Window.partitionBy(KEY).orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(PID, KEY, F.coalesce(F.sum("__qsig_cnt").over(before), F.lit(0)).alias("__qsig_off"))
    joined = local.join(offsets, [PID, KEY], "inner")
    return joined.select(*cols, (F.col("__qsig_off") + F.col("__qsig_lpos")).cast("bigint").alias(name))


def successors(df: DataFrame, by: list[str], order: list[Order], col: str, name: str,
               slices: int | None = None) -> DataFrame:
    """``df`` with ``name`` = the value of ``col`` in the next row of the same
    group, null in its last.

    Within a slice that is ``lead``; the last row of a (slice, key) takes the
    first of the key's next slice, from a table of at most #keys + #slices
    rows."""
    cols = [F.col(f"`{c}`") for c in df.columns]
    cut = _cut_if_hot(df, by, order, slices)
    sort = [o.sort for o in order]
    if cut is None:
        return df.withColumn(name, F.lead(col).over(Window.partitionBy(*by).orderBy(*sort)))
    within = Window.partitionBy(PID, KEY).orderBy(*sort)
    local = cut.withColumn("__qsig_next", F.lead(F.struct(F.col(col).alias("v"))).over(within))
    place = F.struct(*[o.key.alias(f"o{i}") for i, o in enumerate(order)])
    firsts = cut.groupBy(PID, KEY).agg(F.min_by(F.struct(F.col(col).alias("v")), place).alias("__qsig_first"))
    after = firsts.select(PID, KEY, F.lead("__qsig_first").over(Window.partitionBy(KEY).orderBy(PID)).alias("__qsig_over"))
    joined = local.join(after, [PID, KEY], "inner")
    return joined.select(*cols, F.coalesce("__qsig_next", "__qsig_over")["v"].alias(name))


BUCKET_ROWS = 200_000       # values of a bucket of the dense index, on average at most


def dense_index(df: DataFrame, col: str, name: str = "idx", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """0-based global index over the distinct values of ``col``.

    Order is (md5(value), value): a pseudo-random but fixed permutation.  As
    many leading hex digits of the md5 as the number of values asks for name a
    bucket of at most ``bucket_rows`` on average (values are distinct, so no
    bucket can be hot); rows are numbered inside their bucket.  Offsets have
    two levels: buckets add up within the first ``_TOP_DIGITS`` digits, and
    those, at most 4,096, among each other.  The distinct values are written
    once and read for their number, the sizes and the rows."""
    vals = stage(df.select(F.col(col)).where(F.col(col).isNotNull()).distinct(), "index-values")
    return index_of(vals, col, name, bucket_rows)


_TOP_DIGITS = 3


def index_of(vals: DataFrame, col: str, name: str, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``dense_index`` of a written table of distinct values."""
    n = vals.agg(F.count(F.lit(1))).scalar()
    digits = F.least(F.lit(15), F.greatest(F.lit(1), F.ceil(F.log(16.0, F.greatest(n, F.lit(1)) / F.lit(bucket_rows))).cast("int")))
    h = F.md5(F.col(col).cast("string"))
    keyed = vals.select(col, h.alias("__qsig_h"), F.substring(h, F.lit(1), digits).alias("__qsig_b"))
    inner = keyed.withColumn("__qsig_r", F.row_number().over(
        Window.partitionBy("__qsig_b").orderBy("__qsig_h", col)))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    sizes = keyed.groupBy("__qsig_b").agg(F.count(F.lit(1)).alias("__qsig_n"))
    low = sizes.withColumn("__qsig_t", F.substring("__qsig_b", 1, _TOP_DIGITS)).withColumn(
        "__qsig_o", F.coalesce(F.sum("__qsig_n").over(before.partitionBy("__qsig_t").orderBy("__qsig_b")), F.lit(0)))
    tops = sizes.groupBy(F.substring("__qsig_b", 1, _TOP_DIGITS).alias("__qsig_t")).agg(F.sum("__qsig_n").alias("__qsig_n"))
    high = tops.select("__qsig_t", F.coalesce(F.sum("__qsig_n").over(before.orderBy("__qsig_t")), F.lit(0)).alias("__qsig_u"))
    offs = low.join(F.broadcast(high), "__qsig_t").select("__qsig_b", (F.col("__qsig_o") + F.col("__qsig_u")).alias("__qsig_o"))
    return inner.join(offs, "__qsig_b").select(col, (F.col("__qsig_o") + F.col("__qsig_r") - 1).cast("bigint").alias(name))
