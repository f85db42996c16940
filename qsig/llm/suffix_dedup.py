"""Exact substring dedup by a distributed, sparse suffix sort.

A byte is removed when it lies in a ``length``-byte string that also starts
earlier (smaller document, or earlier in the same document).

Sorting the suffixes of every byte would move each text a hundred times over.
Two facts make the sort sparse without losing a match:

* Every ``length``-byte window names its smallest ``K``-byte gram (by hash).
  Equal windows name equal grams, so only windows with one gram can be equal.
  Neighbouring windows mostly name the same gram; such a run of windows (its
  bytes are the run's context) becomes one row.
* If an equal context starts earlier, all windows of the run are repeats.
  Only the first copy of each distinct context, and only where its gram occurs
  in another context too, has to be compared window by window.

Both rounds are suffix sorts.  Rows are range-partitioned by their leading
token (eight bytes from the gram on, then gram and context) with splitters
from a bounded sample; each bucket is sorted by multikey quicksort, and
repeats are found between neighbours.  Splitters go down to the document, so a
passage with any number of copies is cut into even buckets; the groups at the
two ends of a bucket are compared once more across boundaries.

In the second round the windows themselves are sorted by all their bytes.  The
windows of a group that is cut go across boundaries in pieces: those with the
gram at about the same offset (``STEP`` offsets) share a core, the bytes that
all windows with the gram there have.  Pieces whose windows all have an equal
one in their bucket stay, equal pieces go once, and only where a core is in
two buckets are its pieces compared window by window.  So one gram in any
number of different contexts costs a few short rows for each.

A removal in the second round rests on equal bytes.  In the first it rests on
eight literal bytes and two 64-bit hashes, of the gram and of the context, that
mix the same eight-byte words by different sums.  They are not independent;
counting on one alone, a false repeat among n contexts has a chance of about
n^2 / 2^65 for a gram's n contexts, as only those are compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from qsig.llm.support import join_counted, partitions
from qsig.sources import io

LENGTH = 100
K = 24
LONGEST_RUN = 4096          # a run of more windows (periodic text) is cut
SAMPLE_DOCS = 3000          # documents whose suffixes give the splitters
SAMPLE_RUNS = 64            # suffixes taken from each of them
BUCKET_ROWS = 250_000       # rows of a bucket the splitters aim at
BUCKET_WINDOWS = 400_000    # windows of a bucket in the second round
STEP = 10                   # offsets of the gram in a piece that goes across boundaries
_ODD = np.uint64(0xD6E8FEB86659FD93)
_TOP = np.uint64(1 << 63)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


class _Powers:
    """Powers of an odd number and of its inverse modulo 2**64."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            step = np.full(size, _ODD, np.uint64)
            back = np.full(size, np.uint64(pow(int(_ODD), -1, 1 << 64)), np.uint64)
            step[0] = back[0] = 1
            self.up, self.down = np.multiply.accumulate(step), np.multiply.accumulate(back)
        return self.up[:n], self.down[:n]


def _grams(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Mixed eight-byte words from every byte on, and hashes of the K-byte
    grams."""
    words = _mix(np.ndarray((len(raw) - 7,), "<u8", raw, 0, (1,)))
    m = len(raw) - K + 1
    h = words[:m].copy()
    for j in range(8, K, 8):
        h = h * _ODD + words[j:j + m]
    return words, _mix(h)


def runs(raw: bytes, powers: _Powers, length: int = LENGTH) -> dict[str, np.ndarray]:
    """Runs of windows of one text: ``lead`` (first eight bytes from the gram
    on), ``gram``, ``context`` (hashes), ``start`` (first window), ``last``
    (last window) and ``inner`` (the gram occurs twice in the context, so the
    run may repeat a window of its own)."""
    n = len(raw)
    if n < length:
        return {}
    grams, h = _grams(raw)
    m, w = n - K + 1, length - K + 1
    low, span = h, 1
    while span * 2 <= w:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if span < w:
        low = np.minimum(low[:m - w + 1], low[w - span:])
    head = np.concatenate(([True], low[1:] != low[:-1]))
    start = np.flatnonzero(head)
    if len(low) > LONGEST_RUN:
        at = np.arange(len(low)) - np.repeat(start, np.diff(np.append(start, len(low))))
        start = np.flatnonzero(at % LONGEST_RUN == 0)
    last = np.append(start[1:], len(low)) - 1
    gram = low[start]
    # places of the named grams, by (gram, place)
    named = np.zeros(1 << 16, bool)
    named[(gram & np.uint64(0xFFFF)).astype(np.int64)] = True
    place = np.flatnonzero(named[(h & np.uint64(0xFFFF)).astype(np.int64)])
    order = np.lexsort((place, h[place]))
    place, value = place[order], h[place][order]
    kinds, kind = np.unique(value, return_inverse=True)
    key = kind.astype(np.int64) * (n + 1) + place
    mine = np.searchsorted(kinds, gram).astype(np.int64) * (n + 1)
    first = np.searchsorted(key, mine + start)
    inner = np.searchsorted(key, mine + last + w) - first > 1
    up, down = powers.upto(n)
    total = np.zeros(n - 6, np.uint64)
    np.cumsum(grams * up[:n - 7], out=total[1:])
    size = (last + length - 7 - start).astype(np.uint64)
    context = _mix((total[last + length - 7] - total[start]) * down[start] + size * np.uint64(0x9E3779B97F4A7C15))
    at = place[first]
    lead = np.ndarray((n - 7,), ">u8", raw, 0, (1,))[at].astype(np.uint64)
    return {"lead": lead, "gram": gram, "context": context, "start": start, "last": last, "inner": inner}


def multikey_quicksort(keys: list[np.ndarray], whole: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Order of rows by several keys: sort by the first, then only the rows
    still tied by the next, and so on.  Also, for each row in that order,
    whether it equals the row before in the first ``whole`` keys."""
    n = len(keys[0])
    order = np.argsort(keys[0], kind="stable")
    tied = np.zeros(n, bool)
    tied[1:] = keys[0][order[1:]] == keys[0][order[:-1]]
    equal = tied.copy()
    at = np.flatnonzero(tied | np.append(tied[1:], False))          # rows of runs that are still tied
    for number, k in enumerate(keys[1:], 2):
        if len(at):
            group = np.cumsum(~tied[at])
            order[at] = order[at][np.lexsort((k[order[at]], group))]
            here = k[order[at]]
            same = np.zeros(len(at), bool)
            same[1:] = here[1:] == here[:-1]
            tied[at] &= same
            at = at[tied[at] | np.append(tied[at[1:]], False)]
        if number == whole:
            equal = tied.copy()
    return order, equal


def _heads(keys: list[np.ndarray]) -> np.ndarray:
    """True where a row of sorted keys differs from the row before."""
    out = np.zeros(len(keys[0]), bool)
    out[:1] = True
    for k in keys:
        out[1:] |= k[1:] != k[:-1]
    return out


def _packed(keys: list[np.ndarray]) -> np.ndarray:
    flat = np.ascontiguousarray(np.stack(keys, axis=1).astype(">u8"))
    return flat.reshape(-1).view(f"S{8 * len(keys)}")


def _splitters(sample: np.ndarray, buckets: int) -> np.ndarray:
    sample = np.sort(sample)
    at = (np.arange(1, buckets) * len(sample)) // buckets
    return np.unique(sample[at]) if len(sample) else sample


def _unsigned(x: pd.Series) -> np.ndarray:
    return x.to_numpy(dtype=np.int64).view(np.uint64) ^ _TOP


def _signed(x: np.ndarray) -> np.ndarray:
    return (x ^ _TOP).view(np.int64)


def _source(docs: DataFrame) -> DataFrame:
    """(doc_id, doc, tie, text): a 63-bit hash of the text tells documents of
    one id apart; null ids have the least ``doc`` and a negative ``tie``, so
    they come first, also before a document of that id."""
    own = F.shiftrightunsigned(F.xxhash64("text"), 1)
    return docs.select("doc_id", F.coalesce(F.col("doc_id"), F.lit(-(1 << 63))).alias("doc"),
                       F.when(F.col("doc_id").isNull(), F.bitwise_not(own)).otherwise(own).alias("tie"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text"))


_RUNS = "lead bigint, gram bigint, context bigint, doc bigint, tie bigint, start int, span int, inner boolean"


def _run_rows(src: DataFrame, splitters, most: int | None, length: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        powers = _Powers()
        cut = splitters.value if splitters else None

        def out(parts: list[pd.DataFrame]) -> pd.DataFrame:
            pdf = pd.concat(parts, ignore_index=True)
            if cut is not None:
                keys = [_unsigned(pdf[c]) for c in ("lead", "gram", "context", "doc")]
                pdf["bucket"] = np.searchsorted(cut, _packed(keys), "right").astype(np.int32) if len(cut) else np.int32(0)
            return pdf

        for pdf in batches:
            parts, rows = [], 0
            for doc, tie, text in zip(pdf["doc"], pdf["tie"], pdf["text"]):
                r = runs(text.encode("utf-8", "surrogatepass"), powers, length)
                if not r:
                    continue
                at = slice(None)
                if most and len(r["start"]) > most:
                    at = slice(0, None, -(-len(r["start"]) // most))
                got = pd.DataFrame({
                    "lead": _signed(r["lead"][at]), "gram": _signed(r["gram"][at]), "context": _signed(r["context"][at]),
                    "doc": np.int64(doc), "tie": np.int64(tie), "start": r["start"][at].astype(np.int32),
                    "span": (r["last"] - r["start"])[at].astype(np.int32), "inner": r["inner"][at]})
                parts.append(got)
                rows += len(got)
                if rows > 200_000:
                    yield out(parts)
                    parts, rows = [], 0
            if parts:
                yield out(parts)

    return src.mapInPandas(run, _RUNS + ", bucket int" * bool(splitters))


def _first_round(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One bucket of runs: kind 0 repeats an earlier context, kind 1 is the
    first of its context in a gram of several, kind 2 is a first that the
    neighbouring buckets may know."""
    parts = [p for p in batches if len(p)]
    if not parts:
        return
    pdf = pd.concat(parts, ignore_index=True)
    keys = [_unsigned(pdf["lead"]), _unsigned(pdf["gram"]), _unsigned(pdf["context"])]
    where = [_unsigned(pdf["doc"]), pdf["tie"].to_numpy(), pdf["start"].to_numpy()]
    order, _ = multikey_quicksort(keys + where)
    pdf = pdf.iloc[order]
    keys, where = [k[order] for k in keys], [k[order] for k in where]
    gram_head, class_head = _heads(keys[:2]), _heads(keys)
    top = np.maximum.accumulate(np.where(class_head, np.arange(len(order)), 0))
    same_row = np.logical_and.reduce([k == k[top] for k in where])      # a repeated input row is no earlier place
    gram_no = np.cumsum(gram_head) - 1
    several = np.bincount(gram_no, weights=class_head)[gram_no] > 1
    edge = (gram_no == 0) | (gram_no == gram_no[-1])
    kind = np.where(~same_row, 0, np.where(edge, 2, np.where(several | pdf["inner"].to_numpy(), 1, 9)))
    pdf = pdf.assign(kind=kind.astype(np.int32))[kind < 9]
    yield pdf.drop(columns=["bucket", "inner"])


_FOUND = "lead bigint, gram bigint, context bigint, doc bigint, tie bigint, start int, span int, kind int"


def _windows(raws: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """All windows of the contexts: (context, offset in it, big-endian
    eight-byte tokens), contexts of one size at a time."""
    size = np.array([len(r) for r in raws])
    width = -(-length // 8) * 8
    row, offset, tokens = [], [], []
    for n in np.unique(size).tolist():
        mine = np.flatnonzero(size == n)
        flat = np.frombuffer(b"".join([raws[k] for k in mine.tolist()]), np.uint8).reshape(len(mine), n)
        view = np.lib.stride_tricks.sliding_window_view(flat, length, axis=1)
        out = np.zeros((len(mine) * (n - length + 1), width), np.uint8)
        out[:, :length] = view.reshape(-1, length)
        tokens.append(out.view(">u8"))
        row.append(np.repeat(mine, n - length + 1))
        offset.append(np.tile(np.arange(n - length + 1), len(mine)))
    whole = np.concatenate(tokens)
    return np.concatenate(row), np.concatenate(offset), [whole[:, k].astype(np.uint64) for k in range(width // 8)]


def _pieces(raw: bytes, gram: np.uint64, length: int) -> list[tuple[int, int, bytes]]:
    """(first window, last window, core) of the pieces of a context.  Windows
    go by the offset of the first gram in them: equal windows have it at one
    offset, so they are in pieces of one core."""
    w, span, low, out = length - K + 1, len(raw) - length, 0, []
    for g in np.flatnonzero(_grams(raw)[1] == gram).tolist():
        a, b = max(low, g - w + 1), min(g, span)
        low = g + 1
        for j in range((g - b) // STEP, (g - a) // STEP + 1) if a <= b else ():
            core = raw[g - j * STEP:g - min((j + 1) * STEP, w) + 1 + length]
            out.append((max(a, g - (j + 1) * STEP + 1), min(b, g - j * STEP), bytes([j % 256]) + core))
    return out


_WINDOWS = "doc bigint, tie bigint, start int, span int, bucket int, core binary, raw binary"


def _second_round(length: int):
    """One bucket of contexts: repeated windows as (doc, tie, start, span)
    without a core; of the groups at the bucket's ends the pieces that hold a
    first window, with core and bytes, to be compared across boundaries."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [p for p in batches if len(p)]
        if not parts:
            return
        pdf = pd.concat(parts, ignore_index=True).drop_duplicates(["doc", "tie", "start"], ignore_index=True)
        lead, gram = _unsigned(pdf["lead"]), _unsigned(pdf["gram"])
        order, _ = multikey_quicksort([lead, gram])
        pdf, gram, group = pdf.iloc[order], gram[order], np.cumsum(_heads([lead[order], gram[order]]))
        raws, bucket = list(pdf["raw"]), np.int32(pdf["bucket"].iloc[0])
        row, offset, tokens = _windows(raws, length)
        whose, from_ = _unsigned(pdf["doc"]), pdf["start"].to_numpy()
        doc, tie, start = whose[row], pdf["tie"].to_numpy()[row], from_[row] + offset
        order, equal = multikey_quicksort(tokens + [doc, tie, start], len(tokens))
        head = ~equal                                                   # common prefix with the row before is shorter
        top = np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))
        at = np.flatnonzero(equal)
        hit, first = order[at], order[top[at]]
        hit = hit[(doc[hit] != doc[first]) | (tie[hit] != tie[first]) | (start[hit] != start[first])]
        hit = hit[np.lexsort((start[hit], tie[hit], doc[hit]))]
        if len(hit):
            d, t, s = doc[hit], tie[hit], start[hit]
            new = _heads([d, t]) | np.concatenate(([True], s[1:] > s[:-1] + 1))
            at = np.flatnonzero(new)
            end = np.append(at[1:], len(hit)) - 1
            yield pd.DataFrame({"doc": _signed(d[at]), "tie": t[at], "start": s[at].astype(np.int32),
                                "span": (s[end] - s[at]).astype(np.int32), "bucket": bucket, "core": None, "raw": None})
        # heads of each context of the groups at the ends
        at_end = (group == 1) | (group == group[-1])
        heads = order[head & at_end[row[order]]]
        heads = heads[np.lexsort((offset[heads], row[heads]))]
        cut = np.flatnonzero(_heads([row[heads]])) if len(heads) else np.empty(0, np.int64)
        rows, known = [], set()
        for own in np.split(heads, cut[1:]) if len(heads) else ():
            k = int(row[own[0]])
            for s1, s2, core in _pieces(raws[k], gram[k], length):
                piece = raws[k][s1:s2 + length]
                if np.searchsorted(offset[own], s1) < np.searchsorted(offset[own], s2, "right") and (core, piece) not in known:
                    known.add((core, piece))
                    rows.append((_signed(whose[k:k + 1])[0], pdf["tie"].iloc[k], from_[k] + s1, s2 - s1, bucket, core, piece))
            if len(rows) > 20_000:
                yield pd.DataFrame(rows, columns=["doc", "tie", "start", "span", "bucket", "core", "raw"])
                rows = []
        yield pd.DataFrame(rows, columns=["doc", "tie", "start", "span", "bucket", "core", "raw"])

    return run


def _across(pieces: DataFrame, length: int) -> DataFrame:
    """Repeated windows (doc, tie, start, span) among the pieces whose core is
    in two buckets."""
    shared = io.stage(pieces.groupBy("core").agg(F.min("bucket").alias("least"), F.max("bucket").alias("most"),
                                                 F.count(F.lit(1)).alias("n"))
                      .where("least < most").select("core", "n"), "suffix-cores")

    def expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), 2_000):
                some = pdf.iloc[at:at + 2_000]
                row, offset, tokens = _windows(list(some["raw"]), length)
                keys = np.ascontiguousarray(np.stack(tokens, axis=1).astype(">u8")).view(np.uint8)[:, :length]
                yield pd.DataFrame({"doc": some["doc"].to_numpy()[row], "tie": some["tie"].to_numpy()[row],
                                    "start": (some["start"].to_numpy()[row] + offset).astype(np.int32), "span": np.int32(0),
                                    "bytes": [k.tobytes() for k in keys]})

    windows = join_counted(pieces, shared, ["core"], "n").select("doc", "tie", "start", "raw").mapInPandas(
        expand, "doc bigint, tie bigint, start int, span int, bytes binary")
    order = Window.partitionBy("bytes").orderBy("doc", "tie", "start")
    return windows.withColumn("r", F.rank().over(order)).where("r > 1").select("doc", "tie", "start", "span")


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc, tie, start, span): the windows start .. start + span of a
    document (see ``_source``) are repeats of earlier ones.  Spans may
    overlap."""
    spark = docs.sparkSession
    src = _source(docs)
    rows = docs.count()
    share = min(1.0, SAMPLE_DOCS / max(1, rows))
    some = _run_rows(src.where(F.pmod(F.xxhash64("doc", "tie"), F.lit(1 << 20)) < max(1, int(share * (1 << 20)))), None,
                     None, length).select("lead", "gram", "context", "doc")
    seen = some.count()
    keep = min(1.0, SAMPLE_DOCS * SAMPLE_RUNS / max(1, seen))
    some = some.where(F.pmod(F.xxhash64("context", "doc"), F.lit(1 << 20)) < max(1, int(keep * (1 << 20)))).toPandas()
    cut = _splitters(_packed([_unsigned(some[c]) for c in ("lead", "gram", "context", "doc")]),
                     max(partitions(docs), int(seen / share / BUCKET_ROWS) + 1))
    shared = spark.sparkContext.broadcast(cut)
    found = io.stage(_run_rows(src, shared, None, length).repartitionById(len(cut) + 1, F.col("bucket"))
                     .mapInPandas(_first_round, _FOUND), "suffix-found")

    at = Window.partitionBy("lead", "gram", "context").orderBy("doc", "tie", "start")
    edges = found.where("kind = 2").withColumn("r", F.rank().over(at))
    where = ["doc", "tie", "start", "span"]
    repeats = found.where("kind = 0").select(*where).unionByName(edges.where("r > 1").select(*where))
    cols = ["lead", "gram", *where]
    open_ = io.stage(found.where("kind = 1").select(*cols).unionByName(edges.where("r = 1").select(*cols)), "suffix-open")

    size = open_.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("span") + 1).alias("w")).first()
    keep = min(1.0, SAMPLE_DOCS * SAMPLE_RUNS / max(1, size["n"]))
    some = open_.where(F.pmod(F.xxhash64("gram", "doc", "start"), F.lit(1 << 20)) < max(1, int(keep * (1 << 20)))).select(
        "lead", "gram", "doc").toPandas()
    cut2 = _splitters(_packed([_unsigned(some[c]) for c in ("lead", "gram", "doc")]),
                      max(partitions(docs), int((size["w"] or 0) / BUCKET_WINDOWS) + 1))
    shared2 = spark.sparkContext.broadcast(cut2)
    lists = open_.groupBy("doc", "tie").agg(F.collect_set(F.struct("lead", "gram", "start", "span")).alias("runs"))
    joined = lists.join(src, ["doc", "tie"]).select("doc", "tie", "runs", F.encode("text", "utf-8").alias("raw"))
    one = joined.select("doc", "tie", "raw", F.explode("runs").alias("x")).select(
        "doc", "tie", "x.lead", "x.gram", "x.start",
        F.substring("raw", F.col("x.start") + 1, F.col("x.span") + F.lit(length)).alias("raw"))

    def bucket(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keys = _packed([_unsigned(pdf[c]) for c in ("lead", "gram", "doc")])
            pdf["bucket"] = np.searchsorted(shared2.value, keys, "right").astype(np.int32) if len(shared2.value) else np.int32(0)
            yield pdf

    contexts = one.mapInPandas(bucket, "doc bigint, tie bigint, lead bigint, gram bigint, start int, raw binary, bucket int")
    windows = io.stage(contexts.repartitionById(len(cut2) + 1, F.col("bucket")).mapInPandas(
        _second_round(length), _WINDOWS), "suffix-windows")
    return (repeats.unionByName(windows.where("core is null").select(*where))
            .unionByName(_across(windows.where("core is not null"), length)))


def suffix_dedup(docs: DataFrame, length: int = LENGTH, texts: bool = False) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256
    (and ``kept``, the bytes left, with ``texts``).

    Null texts are empty.  Null ids come before all others.  Documents that
    share an id are ordered by a hash of their text; rows that share id and
    text are one document and get one result each.  Texts below ``length``
    bytes lose nothing.  An empty table gives an empty result; other columns
    are not read."""
    if length < K + 8:
        raise ValueError(f"length must be at least {K + 8}")
    # written, so that rows of one id and text, however many, can be split in the join
    spans = io.stage(repeated_spans(docs, length).groupBy("doc", "tie")
                     .agg(F.collect_set(F.struct("start", "span")).alias("cut")), "suffix-cuts")
    joined = _source(docs).join(spans, ["doc", "tie"], "left").select(
        F.col("doc_id").cast("string").alias("id"), "text", F.transform("cut", lambda x: x["start"]).alias("start"),
        F.transform("cut", lambda x: x["start"] + x["span"] + F.lit(length)).alias("end"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for text, start, end in zip(pdf["text"], pdf["start"], pdf["end"]):
                raw = text.encode("utf-8", "surrogatepass")
                kept, gone, spans_, at = [], 0, 0, 0
                if start is not None and len(start):
                    order = np.argsort(start, kind="stable")
                    a, b = np.asarray(start)[order].astype(np.int64), np.maximum.accumulate(np.asarray(end)[order].astype(np.int64))
                    new = np.concatenate(([True], a[1:] > b[:-1]))
                    tops = np.append(np.flatnonzero(new)[1:], len(a)) - 1
                    for x, y in zip(a[new].tolist(), b[tops].tolist()):
                        kept.append(raw[at:x])
                        gone, spans_, at = gone + y - x, spans_ + 1, y
                kept.append(raw[at:])
                left = b"".join(kept)
                rows.append((len(raw), gone, spans_, hashlib.sha256(left).hexdigest(), *([left] if texts else [])))
            out = pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * texts)
            out.insert(0, "id", pdf["id"].to_numpy())
            yield out

    out = joined.mapInPandas(run, "id string, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
                             + ", kept binary" * texts)
    return out.select(F.col("id").cast("bigint").alias("doc_id"), *out.columns[1:])
