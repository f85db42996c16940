"""Benchmark decontamination by q-gram lemma filtering.

Every ``PROBE`` bytes of a benchmark item, from any byte on, are a probe.  A
document holds a probe when some stretch of it is within the probe's edit
budget.  By the q-gram
lemma such a stretch shares at least ``m + 1 - q * (e + 1)`` character q-grams
with a probe of ``m`` characters and budget ``e``, all within ``e`` diagonals
of each other; so shared q-grams of whole items are listed in overlapping
diagonal bands, stretches of an item that reach the bound in a band are kept,
and the probes there are verified by banded alignment.
Items of fewer bytes than a q-gram are found where they stand word for word.

The q-gram index of the benchmark is broadcast in blocks of at most
``BLOCK_BYTES`` of text, one pass over the documents each: a block bounds what
an executor holds, however large the benchmark.  Documents are never
shuffled.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Q = 12
PROBE = 80              # bytes of a probe; items that are shorter are one probe
STRIDE = 1              # probes start at every byte, so a passage of PROBE bytes is one
ERROR = 0.05            # edit budget as a share of the probe
MIN_ITEM = Q            # bytes of the shortest items searched, unless the caller asks for shorter ones
BAND = 16               # diagonals of a band, besides the overlap
BLOCK_BYTES = 8 << 20
VERIFY = 4096           # probes aligned at once


def normal(text: str | None) -> bytes:
    """Lower case, white space as single spaces."""
    return " ".join((text or "").lower().split()).encode("utf-8", "surrogatepass")


def budget(m: int) -> int:
    """Edits allowed for a probe of ``m`` bytes: its share, as far as the
    lemma's bound stays positive."""
    return max(0, min(int(ERROR * m), m // Q - 1))


def gram_hashes(raw: bytes) -> np.ndarray:
    n = len(raw)
    if n < Q:
        return np.empty(0, np.uint64)
    a = np.ndarray((n - Q + 1,), "<u8", raw, 0, (1,)) * np.uint64(0x9E3779B97F4A7C15)
    b = np.ndarray((n - Q + 1,), "<u4", raw, 8, (1,)).astype(np.uint64)
    a ^= a >> np.uint64(32)
    a += b * np.uint64(0xC2B2AE3D27D4EB4F)
    a *= np.uint64(0xBF58476D1CE4E5B9)
    return a ^ (a >> np.uint64(29))


# scripts written without spaces, where every character may begin a word
UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\u312f\u3190-\u9fff\uf900-\ufaff\uff66-\uff9f"
                      "\U00020000-\U0003ffff]")


def _inner(c: str) -> bool:
    """Whether a character can stand inside a word of a script with spaces."""
    return bool(c) and (c.isalnum() or c == "_" or unicodedata.category(c)[0] == "M") and not UNSPACED.match(c)


def word_edge(raw: bytes, at: int) -> bool:
    """True unless byte ``at`` is inside a word."""
    before = raw[max(0, at - 4):at].decode("utf-8", "ignore")[-1:]
    return not (_inner(before) and _inner(raw[at:at + 4].decode("utf-8", "ignore")[:1]))


@dataclass
class Index:
    """Items of one block and the postings of their q-grams."""

    items: list[tuple[int, bytes]]

    def __post_init__(self):
        self.texts: list[bytes] = []
        ids, hashes, place, offset = [], [], [], []
        short: dict[int, dict[bytes, set[int]]] = {}
        for item, text in self.items:
            if len(text) < Q:
                if text:
                    short.setdefault(len(text), {}).setdefault(text, set()).add(item)
                continue
            h = gram_hashes(text)
            hashes.append(h)
            place.append(np.full(len(h), len(self.texts)))
            offset.append(np.arange(len(h)))
            ids.append(item)
            self.texts.append(text)
        # short items by length: their first eight bytes as a number, sorted, and their owners
        self.short = [(n, np.unique(np.array([int.from_bytes(t[:8], "little") for t in held], np.uint64)), held)
                      for n, held in short.items()]
        self.ids = np.array(ids, dtype=np.int64)
        h = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        order = np.argsort(h, kind="stable")
        self.gram, at = np.unique(h[order], return_index=True)
        self.first = np.append(at, len(h))
        self.place = (np.concatenate(place) if place else np.empty(0, np.int64))[order].astype(np.int64)
        self.offset = (np.concatenate(offset) if offset else np.empty(0, np.int64))[order].astype(np.int64)
        self.maybe = np.zeros(1 << 22, bool)
        self.maybe[(self.gram & np.uint64((1 << 22) - 1)).astype(np.int64)] = True
        # of each item: its bytes, the bytes of its probes, their budget and bound
        self.length = np.array([len(t) for t in self.texts], dtype=np.int64)
        self.size = np.minimum(self.length, PROBE)
        self.edits = np.array([budget(m) for m in self.size.tolist()], dtype=np.int64)
        self.need = self.size + 1 - Q * (self.edits + 1)

    @property
    def probes(self) -> list[bytes]:
        return [t[s:s + m] for t, m in zip(self.texts, self.size.tolist()) for s in range(0, len(t) - m + 1, STRIDE)]

    @property
    def owner(self) -> np.ndarray:
        """Item ids of ``probes``."""
        return np.repeat(self.ids, (self.length - self.size) // STRIDE + 1)

    def candidates(self, raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(item, start, band, shared q-grams) of probes that reach the
        lemma's bound in a band; items by their place in ``texts``."""
        none = (np.empty(0, np.int64),) * 4
        h = gram_hashes(raw)
        at = np.flatnonzero(self.maybe[(h & np.uint64((1 << 22) - 1)).astype(np.int64)]) if len(h) else np.empty(0, np.int64)
        if not len(at) or not len(self.gram):
            return none
        g = np.minimum(np.searchsorted(self.gram, h[at]), len(self.gram) - 1)
        real = self.gram[g] == h[at]
        at, g = at[real], g[real]
        count = self.first[g + 1] - self.first[g]
        post = np.repeat(self.first[g] - np.cumsum(count) + count, count) + np.arange(int(count.sum()))
        item, offset = self.place[post], self.offset[post]
        diag = np.repeat(at, count) - offset
        band = diag // BAND
        low = diag % BAND < self.edits[item]            # also in the overlap of the band below
        item, offset = np.concatenate((item, item[low])), np.concatenate((offset, offset[low]))
        band = np.concatenate((band, band[low] - 1))
        longest = int(self.length.max())
        span = (len(raw) + longest) // BAND + 2
        bands, key = np.unique(item * (2 * span) + band + span, return_inverse=True)
        line = np.sort(key * (2 * longest) + offset)    # bands one after the other, by offset
        key = line // (2 * longest)
        item = bands[key] // (2 * span)
        last = np.arange(len(line)) + self.need[item] - 1
        fits = last < len(line)
        line_end = line[np.minimum(last, len(line) - 1)]
        k = np.flatnonzero(fits & (line_end // (2 * longest) == key) & (line_end - line <= self.size[item] - Q))
        if not len(k):
            return none
        key, item = key[k], item[k]
        reach = self.size[item] - Q                     # from the first q-gram of a probe to its last
        low = np.maximum(line_end[k] - key * (2 * longest) - reach, 0)
        high = np.minimum(line[k] - key * (2 * longest), self.length[item] - self.size[item])
        # starts low..high of one hit after the other, each start of a band once
        new = np.append(True, key[1:] != key[:-1])
        low = np.where(new, low, np.maximum(low, np.append(0, high[:-1] + 1)))
        n = np.maximum(high - low + 1, 0)
        start = np.repeat(low - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
        key, item, reach = np.repeat(key, n), np.repeat(item, n), np.repeat(reach, n)
        head = key * (2 * longest) + start
        shared = np.searchsorted(line, head + reach, "right") - np.searchsorted(line, head, "left")
        return item, start, bands[key] % (2 * span) - span, shared

    def verify(self, raw: bytes, item: np.ndarray, start: np.ndarray, band: np.ndarray) -> np.ndarray:
        """True where the probe is within its budget inside the band."""
        out = np.zeros(len(item), bool)
        text = np.frombuffer(raw, np.uint8)
        for m in np.unique(self.size[item]).tolist():
            at = np.flatnonzero(self.size[item] == m)
            e = budget(m)
            d = np.arange(BAND + 3 * e + 1)
            base = (band[at] * BAND - e + start[at])[:, None] + d       # diagonal: place in text minus place in probe
            pat = np.frombuffer(b"".join(self.texts[i][s:s + m] for i, s in zip(item[at].tolist(), start[at].tolist())),
                                np.uint8).reshape(len(at), m)
            big = m + len(d) + 1
            cost = np.where((base >= 0) & (base <= len(text)), 0, big)
            for i in range(m):
                j = base + i                                    # text byte that stands against probe byte i
                inside = (j >= 0) & (j < len(text))
                miss = np.where(inside, text[np.clip(j, 0, len(text) - 1)] != pat[:, i:i + 1], 1)
                step = np.where(inside, cost + miss, big)
                step[:, :-1] = np.minimum(step[:, :-1], cost[:, 1:] + 1)        # probe byte left out
                step = np.where(j + 1 >= 0, step, big)
                cost = np.minimum.accumulate(step - d, axis=1) + d              # text bytes put in
                cost = np.where(j + 1 <= len(text), cost, big)
            out[at] = cost.min(axis=1) <= e
        return out

    def held(self, raw: bytes) -> set[int]:
        """Places of the items of which the text holds a probe: first the probe
        of each item that shares most, then the others of items not yet found."""
        item, start, band, shared = self.candidates(raw)
        order = np.lexsort((-shared, item))
        best = np.append(True, item[order][1:] != item[order][:-1]) if len(order) else np.empty(0, bool)
        found: set[int] = set()
        for todo in (order[best], order[~best]):
            while len(todo):
                now, todo = todo[:VERIFY], todo[VERIFY:]
                now = now[~np.isin(item[now], list(found))]
                if len(now):
                    found.update(item[now[self.verify(raw, item[now], start[now], band[now])]].tolist())
        return found

    def exact(self, raw: bytes) -> set[int]:
        """Short items that stand in the text between word boundaries."""
        out: set[int] = set()
        for n, first, held in self.short:
            if len(raw) < n:
                continue
            head = np.ndarray((len(raw) - n + 1,), "<u8", raw + bytes(8), 0, (1,)) & np.uint64((1 << 8 * min(n, 8)) - 1)
            for at in np.flatnonzero(first[np.minimum(np.searchsorted(first, head), len(first) - 1)] == head).tolist():
                items = held.get(raw[at:at + n])
                if items and not items <= out and word_edge(raw, at) and word_edge(raw, at + n):
                    out |= items
        return out

    def search(self, raw: bytes) -> list[int]:
        """Items of which the text holds a probe, and short items it holds."""
        out = self.exact(raw)
        out.update(self.ids[list(self.held(raw))].tolist())
        return sorted(out)


def leaks(docs: DataFrame, benchmark: DataFrame, min_item: int = MIN_ITEM) -> DataFrame:
    """(doc_id, text_hash, item_id): items that a document holds, distinct."""
    spark = docs.sparkSession
    items = benchmark.select("item_id", "text").where(F.col("item_id").isNotNull() & F.col("text").isNotNull())
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-total // BLOCK_BYTES)
    src = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").where(F.length("text") > 0)
    out = None
    for b in range(max(1, blocks)):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, blocks))) == b).collect()
        held = spark.sparkContext.broadcast(
            [(r.item_id, t) for r in part if len(t := normal(r.text)) >= max(1, min_item)])

        def run(batches: Iterator[pd.DataFrame], held=held) -> Iterator[pd.DataFrame]:
            index = Index(held.value)
            for pdf in batches:
                rows = [(i, h, item) for i, h, t in zip(pdf["doc_id"], pdf["text_hash"], pdf["text"])
                        for item in index.search(normal(t))]
                if rows:
                    got = pd.DataFrame(rows, columns=["doc_id", "text_hash", "item_id"])
                    got["doc_id"] = got["doc_id"].astype("Int64")
                    yield got

        found = src.mapInPandas(run, "doc_id bigint, text_hash bigint, item_id bigint")
        out = found if out is None else out.unionByName(found)
    return out.distinct()


def decontaminate(docs: DataFrame, benchmark: DataFrame, min_item: int = MIN_ITEM) -> DataFrame:
    """Per row of ``docs``: doc_id, text_hash, contaminated, n_items, items
    (sorted ids of the benchmark items it holds).

    Case and runs of white space do not matter.  Null and empty texts hold
    nothing.  Items with null id or text, without text, or under ``min_item``
    bytes are not searched; with ``min_item`` 1 all items with text are.  Repeated rows judge alike; an empty table or an empty
    benchmark marks nothing; other columns are not read."""
    per = leaks(docs, benchmark, min_item).groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    per = per.select(F.col("doc_id").alias("i"), F.col("text_hash").alias("h"), "items")
    ids = docs.select("doc_id", F.xxhash64("text").alias("text_hash"))
    joined = ids.join(per, F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("text_hash") == F.col("h")), "left")
    none = F.array().cast("array<bigint>")
    return joined.select("doc_id", "text_hash", F.col("items").isNotNull().alias("contaminated"),
                         F.coalesce(F.size("items"), F.lit(0)).alias("n_items"), F.coalesce("items", none).alias("items"))
