"""SimHash near-duplicates by deletion-variant signatures.

Two 64-bit fingerprints at most ``d`` bits apart are cut into ``d // 2 + 1``
segments; by the pigeonhole principle one segment differs by at most one bit.
Each segment is indexed under its one-wildcard variants (the segment with one
bit deleted), so two fingerprints that meet the bound share a variant of some
segment.  Buckets of equal variants are verified by the distance of the whole
fingerprints and joined into components.

Scale: the index holds 64 rows per *distinct* fingerprint, however many
documents carry it.  A bucket is compared by numpy in one task and forwards at
most one link per member, never its pairs.  Buckets whose segment values are
very frequent are split into blocks of at most ``block`` members and every
pair of blocks meets in a bucket of its own, so no task holds a hot bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qsig.llm.components import connected_components
from qsig.llm.support import join_counted, partitions
from qsig.sources import io

BITS = 64
# a segment value is looked at as possibly hot only above one part in this
# many: bounds the broadcast table to this many rows per segment
SEGMENT_PARTS = 20_000


def fingerprint(text: str | None, shingle: int) -> int:
    """Signed 64-bit SimHash of one text; 0 when it has no words.

    Words are runs of bytes other than space and 09-0D, A-Z lower-cased;
    a shingle is ``shingle`` words joined by one space (fewer words: all of
    them) and is hashed by XXH64 with seed 42.  A bit is set when it is set in
    more than half of the shingles, repeats counted.
    """
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words))
    n = len(words) - k + 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts[:n].tolist(), ends[k - 1:].tolist())),
                         dtype=np.uint64, count=n)
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, n, 65536):
        part = np.ascontiguousarray(hashes[at:at + 65536]).view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > n, bitorder="little")
    return int(bits.view(np.int64)[0])


def fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, fp) per row of ``docs``; null texts have no words."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf["fp"] = np.array([fingerprint(t, shingle) for t in pdf.pop("text")], dtype=np.int64)
            yield pdf

    src = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_hash"),
                      F.col(text_col).cast("string").alias("text"))
    return src.mapInPandas(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, text_hash bigint, fp bigint")


def segments(distance: int) -> list[tuple[int, int]]:
    """(low bit, width) of the ``distance // 2 + 1`` segments."""
    m = distance // 2 + 1
    edges = [BITS * i // m for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _segment(fp: np.ndarray, low: int, width: int) -> np.ndarray:
    return (fp.view(np.uint64) >> np.uint64(low)) & np.uint64((1 << width) - 1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(31)
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def index_entries(fp: np.ndarray, distance: int, hot: dict, block: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket, fingerprint) arrays of every one-wildcard variant.

    ``hot`` maps (segment number, value) to its count.  A bucket joins the
    fingerprints of two segment values; when their counts exceed ``block`` its
    members are dealt into blocks by hash, and each goes to the buckets of all
    pairs with its own block.
    """
    one = np.uint64(1)
    for s, (low, width) in enumerate(segments(distance)):
        seg = _segment(fp, low, width)
        values = {v for (i, v) in hot if i == s}
        for bit in range(width):
            gone = seg & ~(one << np.uint64(bit))
            bucket = _mix((gone << np.uint64(12)) | np.uint64((s << 6) | bit))
            if not values:
                yield bucket, fp
                continue
            pairs = np.fromiter(
                (hot.get((s, v), 0) + hot.get((s, v ^ (1 << bit)), 0) if v in values or v ^ (1 << bit) in values else 0
                 for v in seg.tolist()), dtype=np.int64, count=len(seg))
            cold = pairs <= block
            yield bucket[cold], fp[cold]
            for n in np.unique(pairs[~cold]).tolist():
                at = pairs == n
                blocks = -(-n // block)
                mine = (_mix(fp[at].view(np.uint64)) % np.uint64(blocks)).astype(np.int64)
                for other in range(blocks):
                    cell = np.minimum(mine, other) * blocks + np.maximum(mine, other) + 1
                    yield _mix(bucket[at] + cell.astype(np.uint64)), fp[at]


def bucket_links(bucket: np.ndarray, fp: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, smallest node of its local group) inside sorted buckets.

    Every pair of one bucket is compared, in rounds of equal offset; the pairs
    found are merged at once, so the result is at most one link per distinct
    fingerprint."""
    nodes, at = np.unique(fp, return_inverse=True)
    label = np.arange(len(nodes))
    left = np.arange(max(0, len(fp) - 1))
    raw, step = fp.view(np.uint64), 1
    while len(left):
        left = left[left + step < len(fp)]
        left = left[bucket[left + step] == bucket[left]]
        near = left[np.bitwise_count(raw[left] ^ raw[left + step]) <= distance]
        a, b = label[at[near]], label[at[near + step]]
        if (a != b).any():
            for x, y in set(zip(a[a != b].tolist(), b[a != b].tolist())):
                while label[x] != x:
                    x = label[x]
                while label[y] != y:
                    y = label[y]
                label[max(x, y)] = min(x, y)
            while (label[label] != label).any():
                label = label[label]
        step += 1
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def links(fps: DataFrame, distance: int = 4, block: int = 4096) -> DataFrame:
    """(a, b) links between distinct fingerprints (column fp) at most
    ``distance`` bits apart: not all pairs, but enough to connect every pair
    that meets the bound.  ``fps`` has one row per fingerprint and should be a
    written table."""
    spark = fps.sparkSession
    segs = segments(distance)
    value = F.explode(F.array(*[
        F.struct(F.lit(s).alias("s"), F.shiftrightunsigned("fp", low).bitwiseAND(F.lit((1 << w) - 1)).alias("v"))
        for s, (low, w) in enumerate(segs)])).alias("x")
    floor = F.greatest(F.lit(block // 2), F.lit(fps.count() // SEGMENT_PARTS))
    # at most SEGMENT_PARTS rows per segment, as each holds over 1/SEGMENT_PARTS of the fingerprints
    hot = {(r.s, r.v): r.n for r in fps.select(value).groupBy("x.s", "x.v").agg(F.count(F.lit(1)).alias("n"))
           .where(F.col("n") > floor).collect()}
    shared = spark.sparkContext.broadcast(hot)

    def entries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            fp = pdf["fp"].to_numpy(dtype=np.int64)
            for bucket, members in index_entries(fp, distance, shared.value, block):
                if len(members):
                    yield pd.DataFrame({"bucket": bucket.view(np.int64), "fp": members})

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, val = np.empty(0, np.int64), np.empty(0, np.int64)
        for pdf in batches:
            key = np.concatenate((key, pdf["bucket"].to_numpy(dtype=np.int64)))
            val = np.concatenate((val, pdf["fp"].to_numpy(dtype=np.int64)))
            done = int(np.searchsorted(key, key[-1], "left")) if len(key) else 0
            a, b = bucket_links(key[:done], val[:done], distance)
            if len(a):
                yield pd.DataFrame({"a": a, "b": b})
            key, val = key[done:], val[done:]
        a, b = bucket_links(key, val, distance)
        if len(a):
            yield pd.DataFrame({"a": a, "b": b})

    index = fps.select("fp").mapInPandas(entries, "bucket bigint, fp bigint")
    return (index.repartition(partitions(fps), "bucket").sortWithinPartitions("bucket")
            .mapInPandas(verify, "a bigint, b bigint"))


def near_duplicates(docs: DataFrame, shingle: int = 4, distance: int = 4,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, text_hash (of the text, to tell
    rows with one id apart), fingerprint (16 lower-case hex digits),
    component_id (smallest doc_id reachable over links of at most
    ``distance`` bits, itself included) and keep (true on the rows equal to
    the component's representative).

    Null and empty texts have fingerprint zero and link like any other.  Null
    ids are never a component_id unless a component has no other; the
    representative is the smallest (doc_id, text_hash), null ids last.
    Repeated rows are one node.  An empty table gives an empty result; other
    columns of ``docs`` are not read.
    """
    fps = io.stage(fingerprints(docs, shingle, id_col, text_col), "simhash-fp")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("no"), F.col("doc_id").alias("id"),
                          F.col("text_hash").alias("th"))).alias("best")
    nodes = io.stage(fps.groupBy("fp").agg(best, F.count(F.lit(1)).alias("n")), "simhash-nodes")
    roots = io.stage(connected_components(links(nodes, distance)), "simhash-roots")
    placed = io.stage(nodes.join(roots, nodes["fp"] == roots["node"], "left")
                      .select("fp", "best", "n", F.coalesce("root", "fp").alias("root"),
                              F.col("root").isNotNull().alias("linked")), "simhash-placed")
    tops = io.stage(placed.where("linked").groupBy("root").agg(F.min("best").alias("top"), F.count(F.lit(1)).alias("m")),
                    "simhash-tops")
    linked = join_counted(placed.where("linked"), tops, ["root"], "m").select("fp", "n", "top")
    alone = placed.where(~F.col("linked")).select("fp", "n", F.col("best").alias("top"))
    of_fp = io.stage(linked.unionByName(alone), "simhash-class")
    return join_counted(fps, of_fp, ["fp"], "n").select(
        "doc_id", "text_hash", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("top.id").alias("component_id"),
        (F.col("doc_id").eqNullSafe(F.col("top.id")) & (F.col("text_hash") == F.col("top.th"))).alias("keep"))
