"""Periodic runs in the words of a text, by string synchronising sets.

A run is a longest stretch of words with smallest period q, at least
``MIN_WORDS`` words and ``MIN_TURNS`` periods long.

At a scale t every position has a hash of the t words from it on.  Position i
is in the synchronising set where the smallest hash of positions i .. i + t is
that of i or of i + t; whether it is depends on the words i .. i + 2t - 1
alone, so equal places of a text are selected alike.  Positions whose t words
have a period of at most t/4 do not compete, or long stretches of one short
period would fill the set.  Those stretches are known already: periods up to
``DIRECT`` are looked for one by one, others come from the scales below.

A run of period q above t/4 and up to 11t/4 - 1 has a selected position among
its first t.  Its context of c words (2t <= c, q <= c <= 2q - t + 1) is found
again q words on, and not before: c + d >= q + d words with periods q and
d < q would have a shorter one.  So each selected position and the next one
with an equal context propose their distance, and extending the match both
ways gives the run or refutes it.  Two contexts a scale, scales 2^k and 3*2^k,
leave no period out.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qsig.sources import io

MIN_WORDS = 24
MIN_TURNS = 3
DIRECT = 8                  # periods looked for one by one
_FIRST = 4                  # the smallest scale: its periods start below DIRECT + 1
_WORD = re.compile("[^\x20\x09-\x0D]+")
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _mix(a * np.uint64(0x9E3779B97F4A7C15) + _mix(b + np.uint64(0xD6E8FEB86659FD93)))


class Names:
    """Hashes of the stretches of 2^k words from every position on; the levels
    below the last three asked for are dropped."""

    def __init__(self, words: np.ndarray):
        self.level = {0: _mix(words.astype(np.int64).view(np.uint64) + np.uint64(0x2545F4914F6CDD1D))}

    def __getitem__(self, k: int) -> np.ndarray:
        while k not in self.level:
            top = max(self.level)
            low = self.level[top]
            self.level[top + 1] = _pair(low[:-(1 << top)], low[1 << top:])
            self.level.pop(top - 3, None)
        return self.level[k]

    def of(self, size: int, at: np.ndarray | None = None) -> np.ndarray:
        """Hashes of ``size`` words, from every position on or those given."""
        k = size.bit_length() - 1
        row, over = self[k], size - (1 << k)
        if at is not None:
            return _pair(row[at], row[at + over]) if over else row[at]
        return _pair(row[:len(row) - over], row[over:]) if over else row


def _blocks(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of True."""
    edge = np.flatnonzero(np.diff(np.concatenate(([False], same, [False]))))
    return edge[::2], edge[1::2]


def _extend(words: np.ndarray, at: int, period: int) -> tuple[int, int]:
    """The longest stretch around ``at`` in which words ``period`` apart are
    equal, given that those at ``at`` are."""
    n, size = len(words), 64
    right = at
    while right + period < n:
        a, b = words[right:min(right + size, n - period)], words[right + period:min(right + size, n - period) + period]
        off = np.flatnonzero(a != b)
        if len(off):
            right += int(off[0])
            break
        right, size = right + len(a), 2 * size
    left, size = at, 64
    while left > 0:
        low = max(0, left - size)
        off = np.flatnonzero(words[low:left] != words[low + period:left + period])
        if len(off):
            left = low + int(off[-1]) + 1
            break
        left, size = low, 2 * size
    return left, right + period


def _primes(n: int) -> list[int]:
    out, p = [], 2
    while p * p <= n:
        if n % p == 0:
            out.append(p)
            while n % p == 0:
                n //= p
        p += 1
    return out + [n] * (n > 1)


def _smallest(words: np.ndarray, start: int, period: int) -> bool:
    """Whether a stretch of at least two periods has no smaller one (which
    would divide it)."""
    return not any(np.array_equal(words[start:start + period], words[start + d:start + d + period])
                   for d in (period // p for p in _primes(period)))


def proposals(names: Names, n: int, scale: int, short: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """(position, distance) of neighbouring equal contexts of one scale;
    ``short`` are the stretches (start, end, period) known so far."""
    name = names.of(scale).copy()
    for start, end, period in short:
        if 4 * period <= scale <= end - start:
            name[start:end - scale + 1] = _NONE
    width = scale + 1
    low, span = name, 1
    while span * 2 <= width:
        low, span = np.minimum(low[:-span], low[span:]), span * 2
    count = n - 2 * scale + 1
    low = np.minimum(low[:count], low[width - span:width - span + count])
    chosen = np.flatnonzero(((low == name[:count]) | (low == name[scale:scale + count])) & (low != _NONE))
    for size in (2 * scale, 11 * scale // 4 - 1):
        at = chosen[:np.searchsorted(chosen, n - size, "right")]
        if len(at) < 2:
            continue
        context = names.of(size, at)
        order = np.argsort(context, kind="stable")
        near = np.flatnonzero(context[order[1:]] == context[order[:-1]])
        first, gap = at[order[near]], at[order[near + 1]] - at[order[near]]
        ok = (gap <= size) & (2 * gap >= scale - 1 + size)
        yield from zip(first[ok].tolist(), gap[ok].tolist())


def runs(words: np.ndarray, min_words: int = MIN_WORDS, turns: int = MIN_TURNS) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of an array of word numbers, by
    start, then period."""
    n = len(words)
    found: set[tuple[int, int, int]] = set()
    short: list[tuple[int, int, int]] = []
    for period in range(1, min(DIRECT, n // turns) + 1):
        for a, b in zip(*_blocks(words[:-period] == words[period:])):
            a, b = int(a), int(b) + period
            if b - a >= min(4 * period, max(min_words, turns * period)) and _smallest(words, a, period):
                short.append((a, b, period))
                if b - a >= max(min_words, turns * period):
                    found.add((a, b - a, period))
    names = Names(words)
    scales = sorted(s << k for k in range(n.bit_length()) for s in (_FIRST, 3 * _FIRST // 2))
    for scale in scales:
        if turns * ((3 * scale) // 2) > n:
            break
        tried: dict[int, list[int]] = {}                # period: ends and starts of the stretches seen, in order
        fresh = []
        for at, period in sorted(set(proposals(names, n, scale, short)), key=lambda x: (x[1], x[0])):
            ends = tried.setdefault(period, [])
            if ends and at < ends[-1]:
                continue
            a, b = _extend(words, at, period)
            ends.append(b - period)
            if b - a >= max(min_words, turns * period) and period > DIRECT and (a, b - a, period) not in found \
                    and _smallest(words, a, period):
                found.add((a, b - a, period))
                fresh.append((a, b, period))
        short += fresh
    return sorted(found, key=lambda r: (r[0], r[2]))


def _maybe(words: list[str]) -> bool:
    """Whether some stretch of 16 words occurs twice, as in every run: at
    least max(24 - q, 2q) of its words are found again q words on."""
    if len(words) < MIN_WORDS:
        return False
    name = np.sort(Names(np.fromiter(map(hash, words), np.int64, len(words)))[4])
    return bool((name[1:] == name[:-1]).any())


def collapse(words: list[str], found: list[tuple[int, int, int]]) -> str:
    """The text without the words of a run behind its first period."""
    keep = np.ones(len(words), bool)
    for start, length, period in found:
        keep[start + period:start + length] = False
    return " ".join(w for w, k in zip(words, keep.tolist()) if k)


def periodic_runs(docs: DataFrame, min_words: int = MIN_WORDS, turns: int = MIN_TURNS) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, ``runs`` (array of start, length
    and period in words, by start, then period) and ``collapsed``, the words
    left when every run keeps its first period, joined by blanks.

    Words are runs of characters other than space and 09-0D.  Null and empty
    texts have no words, no runs and an empty ``collapsed``.  Rows are judged
    one by one, so repeated rows get equal results and null ids stay null.  An
    empty table gives an empty result; other columns are not read.  Time and
    memory of a text grow with its words (time also with their logarithm)."""
    if turns < 3 or min_words < MIN_WORDS:
        raise ValueError("runs have at least 3 turns and 24 words")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows, size = [], 0
            for doc, text in zip(pdf["doc_id"], pdf["text"]):
                words, found = _WORD.findall(text), []
                if _maybe(words):
                    found = runs(pd.factorize(np.array(words, object))[0], min_words, turns)
                rows.append((doc, len(words), [{"start": s, "length": k, "period": p} for s, k, p in found],
                             collapse(words, found) if found else " ".join(words)))
                size += len(text)
                if size > 8 << 20:
                    yield pd.DataFrame(rows, columns=["id", "n_words", "runs", "collapsed"])
                    rows, size = [], 0
            yield pd.DataFrame(rows, columns=["id", "n_words", "runs", "collapsed"])

    src = io.ensure_parallelism(docs.select(F.col("doc_id").cast("string").alias("doc_id"),
                                            F.coalesce(F.col("text"), F.lit("")).alias("text")))
    out = src.mapInPandas(run, "id string, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>,"
                               " collapsed string")
    return out.select(F.col("id").cast("bigint").alias("doc_id"), "n_words", "runs", "collapsed")
