"""Mixing sources to target weights by Pfair scheduling.

Each source's documents are cut into blocks of equal size.  Block ``j``
(from 1) of a source with target weight ``w`` is released at slot
``floor((j-1)/w)`` and due by slot ``ceil(j/w)``; the released block with the
earliest deadline takes each slot.  With weights that sum to one every
deadline is met, so after any number ``t`` of slots each source has had more
than ``w*t - 1`` and fewer than ``w*t + 1`` blocks.

Target weights are taken exactly, as integers over their sum.  The schedule
depends on the number of blocks of each source alone: the driver runs through
it with a state of one count a source and keeps that state every
``CHUNK`` blocks; tasks schedule the chunks from there, and documents meet
their slot by source and block number.  A source that has run out is
scheduled no more, so the work grows with the blocks, not with the slots.

With a ``resolution``, weights are rounded to whole shares of a period of so
many slots instead, and the schedule repeats with the period: the bound then
holds for the shares, and the distance to the weights grows by the period.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qsig.sources import io

MAX_SOURCES = 10_000    # more sources raise: the schedule's state is a count per source
CHUNK = 1 << 16         # blocks that one task schedules, at least
ORDER_BITS = 10         # a source's documents are numbered in 2**10 hash ranges


def shares(weights: dict[str, float], resolution: int) -> dict[str, int]:
    """Whole shares of ``resolution`` slots, by largest remainder; every
    positive weight gets at least one slot."""
    live = {k: float(v) for k, v in weights.items() if v > 0}
    if not live:
        return {}
    if len(live) > resolution:
        raise ValueError(f"{len(live)} sources need a period of as many slots; it has {resolution}")
    total = math.fsum(live.values())
    exact = {k: v / total * (resolution - len(live)) for k, v in live.items()}
    out = {k: 1 + int(v) for k, v in exact.items()}
    rest = resolution - sum(out.values())
    for k in sorted(live, key=lambda k: (int(exact[k]) - exact[k], k))[:rest]:
        out[k] += 1
    return out


def period(share: dict[str, int]) -> dict[str, list[int]]:
    """Slots of each source's blocks in one period: earliest deadline first
    among released blocks, ties by name."""
    slots = sum(share.values())
    release = sorted(((j * slots) // a, -(-(j + 1) * slots // a), k) for k, a in share.items() for j in range(a))
    out: dict[str, list[int]] = {k: [] for k in share}
    ready: list[tuple[int, str]] = []
    at = 0
    for t in range(slots):
        while at < len(release) and release[at][0] <= t:
            heapq.heappush(ready, release[at][1:])
            at += 1
        due, k = heapq.heappop(ready)
        assert due > t, "a block missed its deadline"
        out[k].append(t)
    return out


def whole_weights(weights: dict[str, float]) -> dict[str, int]:
    """Integers in exactly the proportions of the positive weights."""
    live = {k: Fraction(v) for k, v in weights.items() if v > 0}
    scale = math.lcm(*(v.denominator for v in live.values()))
    out = {k: int(v * scale) for k, v in live.items()}
    common = math.gcd(*out.values())
    return {k: v // common for k, v in out.items()}


class Schedule:
    """Earliest deadline first among released blocks, ties by place in the
    list, of sources with integer weights and a number of blocks each; goes
    on from any state (``at``: the next slot, ``done``: blocks placed)."""

    def __init__(self, weight: list[int], blocks: list[int], at: int = 0, done: list[int] | None = None):
        self.weight, self.blocks, self.total = weight, blocks, sum(weight)
        self.at, self.done = at, list(done) if done is not None else [0] * len(weight)
        self.ready: list[tuple[int, int]] = []
        self.wait: list[tuple[int, int, int]] = []
        for k in range(len(weight)):
            self._next(k)

    def _next(self, k: int) -> None:
        j, w = self.done[k], self.weight[k]
        if j < self.blocks[k]:
            release, due = j * self.total // w, -(-(j + 1) * self.total // w)
            if release <= self.at:
                heapq.heappush(self.ready, (due, k))
            else:
                heapq.heappush(self.wait, (release, due, k))

    def step(self) -> tuple[int, int, int] | None:
        """(source, block from 0, slot) of the next block, None at the end."""
        if not self.ready and self.wait:
            self.at = self.wait[0][0]
        while self.wait and self.wait[0][0] <= self.at:
            heapq.heappush(self.ready, heapq.heappop(self.wait)[1:])
        if not self.ready:
            return None
        due, k = heapq.heappop(self.ready)
        assert due > self.at, "a block missed its deadline"
        out = (k, self.done[k], self.at)
        self.done[k] += 1
        self.at += 1
        self._next(k)
        return out


def block_slots(docs: DataFrame, weights: dict[str, float], blocks: dict[str, int]) -> DataFrame:
    """(key, block, slot, last) of every block of the sources with a positive
    weight, by their exact weights."""
    spark = docs.sparkSession
    whole = whole_weights(weights)
    names = sorted(whole)
    weight, number = [whole[k] for k in names], [blocks[k] for k in names]
    size, total = max(CHUNK, 16 * len(names)), sum(number)
    run = Schedule(weight, number)
    starts = [(run.at, list(run.done))]
    for _ in range((total - 1) // size):
        for _ in range(size):
            run.step()
        starts.append((run.at, list(run.done)))
    held = spark.sparkContext.broadcast((names, weight, number))

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, weight, number = held.value
        for pdf in batches:
            for at, done in zip(pdf["at"], pdf["done"]):
                part = Schedule(weight, number, int(at), [int(x) for x in done])
                rows = [r for _ in range(size) if (r := part.step()) is not None]
                k, block, slot = np.array(rows, dtype=np.int64).reshape(-1, 3).T
                yield pd.DataFrame({"key": np.array(names, dtype=object)[k], "block": block, "slot": slot,
                                    "last": block + 1 == np.array(number, dtype=np.int64)[k]})

    states = spark.createDataFrame(starts if total else [], "at bigint, done array<bigint>")
    return states.repartition(max(1, len(starts))).mapInPandas(
        fill, "key string, block bigint, slot bigint, last boolean")


def source_key(col: str = "source") -> Column:
    """Source as a non-null key; null is a source of its own."""
    return F.when(F.col(col).isNull(), F.lit("null")).otherwise(F.concat(F.lit("="), F.col(col)))


def mix(docs: DataFrame, weights: dict[str | None, float] | None = None, exponent: float = 0.5, block: int = 16,
        resolution: int | None = None, seed: int = 13) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, block (from 0, within the
    source), slot, mix_rank and balanced.

    Sorting by ``mix_rank`` (slot, then place in the block) gives the mixed
    order.  Nothing is dropped: a source that runs out leaves its later slots
    empty.  ``balanced`` marks the slots before the first that any source
    could not fill with a whole block: there the target weights hold.

    ``weights``: target weight by source; sources not named, or of weight
    zero, come after all others in no schedule (slot, mix_rank null, balanced
    false).  Default: proportional to the number of documents to the power
    ``exponent``, which lifts small sources.  ``resolution``: rounds them to
    shares of a period of so many slots; by default they hold exactly.  Documents of a source are taken
    in a seeded hash order; rows repeated in full tie and take neighbouring
    places.  Null ids, which may be many, are spread by their place in the
    table, a null source is a source of its own, an empty table gives an empty
    result, other columns are not read.  A ``resolution`` below the number of
    sources raises.
    """
    tag = "x"
    src = docs.select(F.col("doc_id"), F.col("source"), source_key().alias("key"),
                      F.when(F.col("doc_id").isNull(), F.xxhash64(F.lit(seed), F.monotonically_increasing_id()))
                      .otherwise(F.xxhash64(F.lit(seed), F.col("doc_id"))).alias(tag))
    src = io.stage(src.withColumn("range", F.shiftright(tag, 64 - ORDER_BITS)), "mix-src")
    sizes = io.stage(src.groupBy("key", "range").agg(F.count(F.lit(1)).alias("n")), "mix-sizes")
    counts = {r.key: r.n for r in sizes.groupBy("key").agg(F.sum("n").alias("n")).limit(MAX_SOURCES + 1).collect()}
    if len(counts) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    if weights is None:
        target = {k: n ** exponent for k, n in counts.items()}
    else:
        named = {"null" if k is None else f"={k}": w for k, w in weights.items()}
        target = {k: named.get(k, 0.0) for k in counts}
    before = Window.partitionBy("key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    start = sizes.select("key", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("key", "range").orderBy(tag, "doc_id")
    placed = (src.withColumn("r", F.row_number().over(inside) - 1).join(start, ["key", "range"])
              .withColumn("place", F.col("r") + F.col("start"))
              .withColumn("block", F.expr(f"place div {block}")))
    if resolution is None:
        # the last block of a source is the first that is not whole; it may hold no document
        plan = io.stage(block_slots(docs, target, {k: n // block + 1 for k, n in counts.items()}), "mix-slots")
        horizon = plan.where("last").agg(F.min("slot")).first()[0] or 0
        slotted, slot = placed.join(plan.drop("last"), ["key", "block"], "left"), F.col("slot")
    else:
        slotted, slot, horizon = _by_period(placed, counts, shares(target, resolution), block)
    return slotted.select(
        "doc_id", "source", F.col("block").cast("bigint"), slot.cast("bigint").alias("slot"),
        (slot * block + F.col("place") % block).cast("bigint").alias("mix_rank"),
        F.coalesce(slot < horizon, F.lit(False)).alias("balanced"))


def _by_period(placed: DataFrame, counts: dict[str, int], share: dict[str, int], block: int) -> tuple[DataFrame, Column, int]:
    """``placed`` with what its slot needs, the slot, and the first slot whose
    block is not whole, by whole shares of a period."""
    plan = period(share)
    slots = sum(share.values())
    horizon = min(((counts[k] // block) // a * slots + plan[k][(counts[k] // block) % a] for k, a in share.items()),
                  default=0)
    table = placed.sparkSession.createDataFrame(
        [(k, a, i, s) for k, a in share.items() for i, s in enumerate(plan[k])],
        "key string, share bigint, i bigint, in_period bigint")
    per = F.broadcast(table.select("key", "share").distinct())
    slotted = (placed.join(per, "key", "left").withColumn("i", F.col("block") % F.col("share"))
               .join(F.broadcast(table.drop("share")), ["key", "i"], "left"))
    return slotted, F.expr(f"block div share * {slots} + in_period"), horizon
