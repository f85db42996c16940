"""Connected components of an edge table, by alternating large-star and
small-star rounds (Kiveris et al., "Connected Components in MapReduce and
Beyond"), each round written to the shared staging folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qsig.llm.support import join_counted
from qsig.sources import io


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star round over directed pairs (a, b) with a > b."""
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges
    both = io.stage(both, "cc-both") if large else both
    mins = io.stage(both.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n"))
                    .withColumn("m", F.least("m", "a")), "cc-min")
    linked = join_counted(both, mins, ["a"], "n")
    if large:
        # neighbours above the centre move to the centre's minimum
        out = linked.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        # neighbours below the centre, and the centre, move to the minimum
        out = (linked.where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
               .unionByName(mins.select("a", F.col("m").alias("b"))))
    return out.where(F.col("a") > F.col("b")).distinct()


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b: bigint), root
    being the smallest node reachable.

    Self-loops and repeated edges are allowed; an empty table gives an empty
    result.  The number of rounds is logarithmic in the size of a component;
    a component not settled after ``max_rounds`` raises.
    """
    cur = io.stage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .where(F.col("a") > F.col("b")).distinct(), "cc-edges")
    before = None
    for _ in range(max_rounds):
        row = cur.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % F.lit(1 << 31))).first()
        if tuple(row) == before or row[0] == 0:
            return cur.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                cur.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        before = tuple(row)
        cur = io.stage(_star(_star(cur, True), False), "cc-edges")
    raise RuntimeError(f"components not settled after {max_rounds} rounds")
