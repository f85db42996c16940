"""Best-fit packing of tokenised documents into fixed-length sequences.

Bounded-space online best fit.  A task walks its documents in order with a
fixed number of open bins.  A bitset, one bit per amount of free space, tells
which amounts some open bin has; the lowest set bit from the piece's length
upwards is the fullest bin that the piece fits.  Where none fits a bin is
opened, and if all are open already the fullest one closes first.  Pieces
arrive through a short buffer that passes the longest on first: the short ones
then fill what the long ones leave.

Bins still open when a task ends would be lost space in every task, so their
pieces (no text, a few numbers each) are written without a sequence and packed
once more by the same rule, many tasks' leftovers to one task.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qsig.sources import io

LENGTH = 1024
END = 2                     # id behind every document
OPEN_BINS = 2048
AHEAD = 4096                # pieces put in order of size before they are placed
LEFT_PIECES = 200_000       # pieces of the second round in one task
CACHED_WORDS = 1_000_000    # segments whose ids a task remembers
BLOCK_CHARS = 1 << 20       # characters of a text tokenised at once

# Unicode white space, as the byte-level pre-tokenizer sees it, and Latin letters
_WHITE = r"\t-\r \x85\xa0  -     　"
_LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
# a run of letters before something in ASCII that is none; other words whole; white space
_SEGMENT = re.compile(rf" ?[{_LETTER}]+(?=[!-@\[-`{{-~]|[ \n]|$)| ?[^{_WHITE}]+|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]+")


class OpenBins:
    """A fixed number of open bins; closed ones are handed to ``close``."""

    def __init__(self, length: int, most: int, close):
        self.length, self.most, self.close = length, most, close
        self.bits = 0                                   # bit f: some open bin has f free
        self.free: list[list[list]] = [[] for _ in range(length + 1)]
        self.n = 0

    def _take(self, free: int) -> list:
        stack = self.free[free]
        bin_ = stack.pop()
        if not stack:
            self.bits &= ~(1 << free)
        self.n -= 1
        return bin_

    def put(self, size: int, item) -> None:
        fits = self.bits >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            bin_ = self._take(free)
        else:
            if self.n == self.most:
                self.close(self._take((self.bits & -self.bits).bit_length() - 1))
            free, bin_ = self.length, []
        bin_.append((self.length - free, item))
        left = free - size
        if left == 0:
            self.close(bin_)
            return
        self.free[left].append(bin_)
        self.bits |= 1 << left
        self.n += 1

    def rest(self) -> Iterator[list]:
        """The bins still open, fullest first."""
        for stack in self.free:
            yield from stack


class _Numbers(dict):
    """Numbers of segments in order of appearance; ``new`` has those that
    appeared since it was last emptied."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, segment: str) -> int:
        n = self[segment] = len(self)
        self.new.append(segment)
        return n


class WordIds:
    """Token ids of texts; the ids of a segment (white space, or a word with
    the blank before it, cut behind its letters) do not depend on its
    neighbours, so a segment is tokenised once and remembered, the first
    ``most`` of them for good."""

    def __init__(self, tokenizer: str, most: int = CACHED_WORDS):
        from tokenizers import Tokenizer

        self.encoder, self.most = Tokenizer.from_file(tokenizer), most
        self.known = _Numbers()
        self.flat = np.zeros(1 << 16, np.uint32)
        self.at = np.zeros(1 << 12, np.int64)           # at[i]:at[i + 1] are the ids of segment i

    def _learn(self, new: list[str]) -> None:
        got = self.encoder.encode(new, is_pretokenized=True, add_special_tokens=False)
        size = np.bincount(np.array(got.word_ids, np.int64), minlength=len(new))
        n = len(self.known) - len(new)
        ends = self.at[n] + np.cumsum(size)
        while len(self.at) < n + len(new) + 1:
            self.at = np.concatenate((self.at, np.zeros_like(self.at)))
        while len(self.flat) < ends[-1]:
            self.flat = np.concatenate((self.flat, np.zeros_like(self.flat)))
        self.flat[self.at[n]:ends[-1]] = got.ids
        self.at[n + 1:n + 1 + len(new)] = ends

    def _ids(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all segments, and behind how many ids each of them ends."""
        which = np.fromiter(map(self.known.__getitem__, segments), np.int64, len(segments))
        new = self.known.new
        if new:
            self._learn(new)
        first, size = self.at[which], self.at[which + 1] - self.at[which]
        ends = np.cumsum(size)
        ids = self.flat[np.repeat(first - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]
        if len(self.known) > self.most:
            for s in new:                               # the last ones learnt, so the tables stay dense
                del self.known[s]
        self.known.new = []
        return ids, ends

    def texts(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Ids of every text, many short ones at once, long ones by blocks."""
        segments: list[str] = []
        stops: list[int] = []
        chars = 0

        def ready() -> Iterator[np.ndarray]:
            ids, ends = self._ids(segments)
            at = np.append(0, ends)[[0, *stops]]
            yield from (ids[a:b] for a, b in zip(at[:-1], at[1:]))
            segments.clear()
            stops.clear()

        for text in texts:
            if len(text) > BLOCK_CHARS:
                yield from ready()
                yield self._long(text)
                chars = 0
                continue
            segments += _SEGMENT.findall(text)
            stops.append(len(segments))
            chars += len(text)
            if chars > BLOCK_CHARS // 4:
                yield from ready()
                chars = 0
        yield from ready()

    def _long(self, text: str) -> np.ndarray:
        out, block, chars = [], [], 0
        for m in _SEGMENT.finditer(text):
            block.append(m.group())
            chars += len(block[-1])
            if chars > BLOCK_CHARS:
                out.append(self._ids(block)[0])
                block, chars = [], 0
        return np.concatenate([*out, self._ids(block)[0]])


def _kept_words(tokenizer: str, most: int = CACHED_WORDS) -> WordIds:
    """The ``WordIds`` of the worker process: it serves many tasks, and the
    next one finds the words of those before."""
    import sys
    import types

    kept = sys.modules.setdefault("_qsig_kept", types.ModuleType("_qsig_kept"))
    if getattr(kept, "key", None) != (tokenizer, most):
        kept.key, kept.words = (tokenizer, most), WordIds(tokenizer, most)
    return kept.words


def cuts(n: int, length: int) -> list[tuple[int, int]]:
    """(start, end) of the pieces of ``n`` ids: only the first may be shorter
    than ``length``."""
    head = (n - 1) % length + 1
    return [(0, head)] + [(a, a + length) for a in range(head, n, length)]


# doc_id goes through pandas as text: numbers beside a null would become floating point
_PIECE = "doc_id string, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"
_NAMES = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
OPEN = -1                   # sequence_id of a piece that has none yet


class _Sequences:
    """Rows of closed bins; a bin's number tells its task and round."""

    def __init__(self, length: int, most: int, round_: int):
        from pyspark import TaskContext

        self.rows: list[tuple] = []
        self.next = (round_ << 62) | (TaskContext.get().partitionId() << 36)
        self.bins = OpenBins(length, most, self.close)
        self.ahead: list[tuple] = []

    def close(self, bin_: list) -> None:
        self.rows += [(*item, self.next, offset) for offset, item in bin_]
        self.next += 1

    def put(self, item: tuple) -> None:
        """Pieces are placed by the buffer, the longest first."""
        if item[3] == self.bins.length:
            self.close([(0, item)])
            return
        self.ahead.append(item)
        if len(self.ahead) == AHEAD:
            self.place()

    def place(self) -> None:
        self.ahead.sort(key=lambda item: -item[3])
        for item in self.ahead:
            self.bins.put(item[3], item)
        self.ahead.clear()

    def drain(self, least: int) -> Iterator[pd.DataFrame]:
        if len(self.rows) > least:
            yield pd.DataFrame(self.rows, columns=_NAMES)
            self.rows = []


def pieces(docs: DataFrame, tokenizer: str, length: int = LENGTH, end: int = END, open_bins: int = OPEN_BINS) -> DataFrame:
    """First round: the pieces of every document, packed within each task;
    pieces of bins open at its end have no sequence yet."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, seq = _kept_words(tokenizer), _Sequences(length, open_bins, 0)
        for pdf in batches:
            for doc, ids in zip(pdf["doc_id"], words.texts(pdf["text"].tolist())):
                ids = np.append(ids, np.uint32(end)).astype("<u4")
                for k, (a, b) in enumerate(cuts(len(ids), length)):
                    seq.put((doc, k, a, b - a, zlib.crc32(ids[a:b].tobytes())))
            yield from seq.drain(20_000)
        seq.place()
        seq.rows += [(*item, OPEN, 0) for bin_ in seq.bins.rest() for _, item in bin_]
        yield from seq.drain(0)

    src = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return src.mapInPandas(run, _PIECE)


def _packed(left: DataFrame, tasks: int, length: int, open_bins: int) -> DataFrame:
    """Second round: pieces without a sequence, in an order drawn by hash."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seq = _Sequences(length, open_bins, 1)
        for pdf in batches:
            for row in zip(*(pdf[c].tolist() for c in _NAMES[:5])):
                seq.put(row)
            yield from seq.drain(20_000)
        seq.place()
        for bin_ in seq.bins.rest():
            seq.close(bin_)
        yield from seq.drain(0)

    draw = F.xxhash64("doc_id", "piece", "length", "ids_crc32")
    dealt = left.select(*_NAMES[:5], draw.alias("draw"), F.pmod(draw, F.lit(tasks)).cast("int").alias("task"))
    sorted_ = dealt.repartitionById(tasks, F.col("task")).sortWithinPartitions("draw", "doc_id", "piece", "start")
    return sorted_.drop("draw", "task").mapInPandas(run, _PIECE)


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH, end: int = END, open_bins: int = OPEN_BINS) -> DataFrame:
    """Per piece of every row of ``docs``: doc_id, piece, start, length,
    ids_crc32, sequence_id, offset.

    ``tokenizer`` is the path of a tokenizer file that every executor has.
    A document is its ids and ``end``; null and empty texts are ``end`` alone.
    Only documents above ``length`` ids are cut: full pieces from the end on,
    the first piece takes the rest.  Texts of any length are tokenised block
    by block.  Null doc_ids stay null; rows that share id and text are
    documents of their own.  An empty table gives an empty result; other
    columns are not read.  A sequence is packed by one task attempt and
    written before it is read, so a lost executor cannot mix two packings."""
    if not 1 <= open_bins or not 1 <= length < 1 << 20:
        raise ValueError("open_bins and length must be positive")
    first = io.stage(pieces(io.ensure_parallelism(docs.select("doc_id", "text")), tokenizer, length, end, open_bins),
                     "packing-pieces")
    left = first.where(F.col("sequence_id") == OPEN)
    tasks = left.count() // LEFT_PIECES + 1
    out = first.where(F.col("sequence_id") != OPEN).unionByName(_packed(left, tasks, length, open_bins))
    return out.withColumn("doc_id", F.col("doc_id").cast("bigint"))
