"""Interaction audit of document filters that are applied one after another.

Every document gets a mask, one bit per filter that it fails.  What a filter
removes in any order, alone, after others, or on average over all orders
(Shapley value), depends on nothing but the counts of masks, and those add up:
a few rows per part say it all.

Four filters look at one text and are column expressions.  The fifth, an exact
repeat of a smaller doc_id's text, needs the whole table, but most texts occur
once.  A counting Bloom sketch finds those first: every text hash adds one to
``PROBES`` cells, counted within each task and merged by the shuffle.  A cell
that ends below two holds a single text, so a text with such a cell is unique
for certain.  The cells with two or more become a bitset that the tasks
consult while they read the texts again: only possible repeats are shuffled,
by their full text, for the smallest id.  What repeats then joins the masks by
hash and digest, and moves its counts from mask m to m with the repeat bit.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qsig.llm.support import join_counted
from qsig.sources import io

FILTERS = "ABCDE"
REPEAT = FILTERS.index("E")
SPACES = r"[\x20\x09-\x0D]+"
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_UPPER_PERCENT = 3
SYMBOLS = r"[#$%&*|]"

PROBES = 3
CELLS_PER_ROW = 16
LEAST_CELLS = 1 << 16
MOST_CELLS = 1 << 28        # the bitset that is broadcast has one bit a cell: 32 MB at most
PIECE_CELLS = 1 << 17       # cells of one row of the bitset on its way to the driver


def text_mask(text: Column) -> Column:
    """Bits of the failed filters that look at one text alone."""
    words = F.array_remove(F.split(text, SPACES), "")
    upper = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    fails = {
        "A": F.size(words) < MIN_WORDS,
        "B": F.lit(100) * F.size(F.array_distinct(words)) < F.lit(MIN_DISTINCT_PERCENT) * F.size(words),
        "C": F.lit(100).cast("bigint") * upper > F.lit(MAX_UPPER_PERCENT).cast("bigint") * F.length(text),
        "D": text.rlike(SYMBOLS),
    }
    mask = F.lit(0)
    for f, bad in fails.items():
        mask = mask + F.when(bad, F.lit(1 << FILTERS.index(f))).otherwise(F.lit(0))
    return mask


def _hash(text: Column) -> Column:
    return F.xxhash64(text)


def facts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, part, mask of A to D, good, toxic, and
    hash and digest of the text, which itself is left behind."""
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = docs.select("doc_id", F.coalesce(F.col("lang"), F.lit("")).alias("part"), text_mask(text).alias("mask"),
                         _hash(text).alias("h"), F.unhex(F.md5(text)).alias("digest"))
    told = (labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("__llm_id"))
            .agg(F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
                 F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
            .where("good = 1 or toxic = 1"))
    return (narrow.join(told, F.col("doc_id") == F.col("__llm_id"), "left").drop("__llm_id")
            .withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in ("good", "toxic")}))


def cell_count(rows: int) -> int:
    """Cells of the sketch: a power of two, some per row, within bounds."""
    return min(MOST_CELLS, max(LEAST_CELLS, 1 << (CELLS_PER_ROW * max(1, rows) - 1).bit_length()))


def _cells(h: np.ndarray, cells: int) -> list[np.ndarray]:
    h = h.view(np.uint64)
    low, high = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    return [(low + np.uint64(k) * high) & np.uint64(cells - 1) for k in range(PROBES)]


def sketch(hashes: DataFrame, cells: int) -> DataFrame:
    """(cell, n): the counting Bloom sketch of a column ``h``.  Every task
    counts the cells of its own rows, a cell once per text; the shuffle adds
    the tasks' sketches up."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            own, times = np.unique(pdf["h"].to_numpy(np.int64), return_counts=True)
            probed = np.sort(np.stack(_cells(own, cells), axis=1).astype(np.int64), axis=1)
            fresh = np.ones(probed.shape, bool)
            fresh[:, 1:] = probed[:, 1:] != probed[:, :-1]
            cell, where = np.unique(probed[fresh], return_inverse=True)
            n = np.bincount(where, weights=np.repeat(times, PROBES).reshape(probed.shape)[fresh]).astype(np.int64)
            yield pd.DataFrame({"cell": cell, "n": np.minimum(n, 2)})

    return hashes.select("h").mapInPandas(count, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))


def crowded(hashes: DataFrame, cells: int) -> np.ndarray:
    """Bitset of the cells that count two or more, ``cells`` / 8 bytes."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts: dict[int, np.ndarray] = {}
        for pdf in batches:
            for piece, of in pdf.groupby("piece")["cell"]:
                bits = parts.setdefault(piece, np.zeros(PIECE_CELLS, bool))
                bits[of.to_numpy() % PIECE_CELLS] = True
            if len(parts) > 1:                          # sorted: all but the last are complete
                last = max(parts)
                yield pd.DataFrame([(p, np.packbits(parts.pop(p)).tobytes()) for p in sorted(parts) if p != last],
                                   columns=["piece", "bits"])
        yield pd.DataFrame([(p, np.packbits(b).tobytes()) for p, b in parts.items()], columns=["piece", "bits"])

    full = sketch(hashes, cells).where("n > 1").select((F.col("cell") / PIECE_CELLS).cast("int").alias("piece"), "cell")
    rows = full.repartition("piece").sortWithinPartitions("piece").mapInPandas(pack, "piece int, bits binary")
    out = np.zeros(max(1, cells // PIECE_CELLS) * (PIECE_CELLS // 8), np.uint8)
    for piece, bits in rows.toLocalIterator():
        out[piece * (PIECE_CELLS // 8):(piece + 1) * (PIECE_CELLS // 8)] = np.frombuffer(bits, np.uint8)
    return out


def possible_repeats(docs: DataFrame, bits: np.ndarray, cells: int) -> DataFrame:
    """(doc_id, h, text) of the documents whose cells all count two or more."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    @F.pandas_udf("boolean")
    def repeats(h: pd.Series) -> pd.Series:
        told = np.ones(len(h), bool)
        for cell in _cells(h.to_numpy(np.int64), cells):
            told &= (shared.value[(cell >> np.uint64(3)).astype(np.int64)] >> (np.uint8(7) - (cell & np.uint64(7)).astype(np.uint8)) & 1) == 1
        return pd.Series(told)

    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return rows.select("doc_id", _hash(F.col("text")).alias("h"), "text").where(repeats("h")).where("doc_id is not null")


def repeated_texts(docs: DataFrame, bits: np.ndarray, cells: int) -> DataFrame:
    """(h, digest, first, n): texts that several ids have, their smallest id
    and number of documents.  Grouped by the full text; a task sends a text
    once, however many documents of its rows have it."""
    return (possible_repeats(docs, bits, cells).groupBy("h", "text")
            .agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.count(F.lit(1)).alias("n"))
            .where("last > first").select("h", F.unhex(F.md5("text")).alias("digest"), "first", "n"))


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents per part and set of failed
    filters, and how many of them are labelled good and toxic.

    Null texts are empty, null langs the empty part.  A null doc_id is no
    smaller id and has none: it neither repeats nor is repeated, and no label
    is its own.  Rows that share id and text do not repeat each other.  Of
    several labels of an id, any that is 1 counts."""
    told = io.stage(facts(docs, labels), "audit-facts")
    cells = cell_count(told.count())
    firsts = io.stage(repeated_texts(docs, crowded(told, cells), cells), "audit-repeats")
    key = ["part", "mask"]
    sums = [F.count(F.lit(1)).alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic")]
    base = told.groupBy(*key).agg(*sums)
    again = join_counted(told, firsts, ["h", "digest"], "n").where(F.col("doc_id") > F.col("first")).groupBy(*key).agg(*sums)
    again = io.stage(again, "audit-again")
    counts = ["n", "good", "toxic"]
    out = again.select(*key, *[(-F.col(c)).alias(c) for c in counts])
    into = again.withColumn("mask", F.col("mask") + F.lit(1 << REPEAT))
    return (base.unionByName(out).unionByName(into).groupBy(*key)
            .agg(*[F.sum(c).alias(c) for c in counts]).where("n > 0"))


def interactions(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """Per part, order of the filters and step: what the step's filter removes
    and leaves, from the counts of masks.  Every part has all its rows."""
    steps = [("".join(order), k + 1, 1 << filters.index(f), sum(1 << filters.index(x) for x in order[:k]))
             for order in itertools.permutations(filters) for k, f in enumerate(order)]
    table = F.array(*[F.struct(F.lit(o).alias("filter_order"), F.lit(k).alias("step"), F.lit(b).alias("own"),
                               F.lit(p).alias("before")) for o, k, b, p in steps])
    share = F.expr(f"{len(steps) // len(filters)} div greatest(bit_count(mask), 1)")
    spread = counts.select("*", F.explode(table).alias("s")).select("part", "mask", "n", "good", "toxic", "s.*")
    fails = F.expr("mask & own") != 0
    removed = fails & (F.expr("mask & before") == 0)

    def total(what: Column, when: Column) -> Column:
        return F.sum(F.when(when, what).otherwise(F.lit(0))).cast("bigint")

    return spread.groupBy("part", "filter_order", "step").agg(
        total(F.col("n"), F.expr("mask & (before | own)") == 0).alias("kept"),
        total(F.col("n"), removed).alias("removed"),
        total(F.col("n"), fails & ~removed).alias("redundant"),
        total(F.col("n"), F.col("mask") == F.col("own")).alias("unique_fails"),
        total(F.col("good"), removed).alias("good_lost"),
        total(F.col("toxic"), removed).alias("toxic_lost"),
        # of all orders, the failed filters share the first place evenly
        total(F.col("n") * share, fails).alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``interactions`` of all filters over the whole table ``docs``; see
    ``mask_counts`` for nulls, ties and repeated rows.  An empty table has no
    parts and gives an empty result; other columns are not read."""
    return interactions(mask_counts(docs, labels))
