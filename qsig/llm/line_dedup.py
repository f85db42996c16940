"""Line dedup by winnowing over line hashes.

A run is a stretch of consecutive lines (blank ones are skipped) with at least
``min_lines`` lines or ``min_words`` words; words and blanks go by the
characters 20 and 09-0D.  Lines are deleted that lie in a run which also starts
earlier (smaller document, or earlier in the same document), however the run
goes on there: all repeats are judged on the input, and the later one goes
whole.

Windows are the shortest runs, one from each line on.  Every window selects its
smallest line hash (the last one of equal ones) as fingerprint; neighbouring
windows mostly select the same line, so about half of the lines are selected.
A run that occurs twice holds a whole window, and both copies select the same
line of it: a match shares a fingerprint for certain, and lines whose
fingerprint was selected once go no further.

Positions of repeated fingerprints are joined by the hash of their window and
extended line by line.  Backwards that is the window of the line before, which
is one of the joined ones if it matches; forwards the lines behind a window up
to the end of the next one, so each position also carries the hashes of its
window with one or more of them.  The earliest position of each hash keeps its
lines; wherever else it occurs they go, and overlapping matches merge into the
longest equal run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qsig.llm.support import join_counted
from qsig.sources import io

MIN_LINES = 3
MIN_WORDS = 50
BLANK = " \t\n\x0b\x0c\r"

_PRINT = ("doc string, tie bigint, print bigint, "
          "runs array<struct<first: int, last: int, run1: bigint, run2: bigint>>")


def windows(words: list[int], min_lines: int, min_words: int) -> list[int]:
    """Last line of the shortest run from each line on, as far as there is one;
    ``words`` are the words of each line."""
    ends, end, count = [], 0, 0
    for at in range(len(words)):
        end = max(end, at)
        while end < len(words) and end - at < min_lines and (end == at or count < min_words):
            count += words[end]
            end += 1
        if end - at < min_lines and count < min_words:
            break
        ends.append(end - 1)
        count -= words[at]
    return ends


def fingerprints(text: str | None, min_lines: int, min_words: int) -> list[tuple[int, list[tuple[int, int, int, int]]]]:
    """Selected lines of one text: (line hash, runs), where the runs (first
    line, last line, two halves of their hash) are the windows that select the
    line, each also with the lines behind it up to the end of the next window.
    Lines count from 0, blank ones included."""
    import xxhash

    lines = [(i, s) for i, s in enumerate((text or "").encode("utf-8", "surrogatepass").split(b"\n")) if s.strip()]
    raw = [s for _, s in lines]
    ends = windows([len(s.split()) for s in raw], min_lines, min_words)
    value = [xxhash.xxh64_intdigest(r) for r in raw]
    out, chosen = [], -1
    for at, end in enumerate(ends):
        least = min(value[at:end + 1])
        pick = max(k for k in range(at, end + 1) if value[k] == least)
        if pick != chosen:
            chosen = pick
            out.append((least - (1 << 63), []))
        beyond = ends[at + 1] if at + 1 < len(ends) else len(raw)
        for last in range(end, max(end + 1, beyond)):
            run = xxhash.xxh3_128_intdigest(b"\n".join(raw[at:last + 1]))
            out[-1][1].append((lines[at][0], lines[last][0], (run >> 64) - (1 << 63), (run & ((1 << 64) - 1)) - (1 << 63)))
    return out


def selected(docs: DataFrame, min_lines: int, min_words: int) -> DataFrame:
    """(doc, tie, print, runs) of every selected line; doc is text, as numbers
    beside a null would not come back from pandas as they were."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [fingerprints(t, min_lines, min_words) for t in pdf["text"]]
            at = np.repeat(np.arange(len(pdf)), [len(f) for f in found])
            flat = [x for f in found for x in f]
            yield pd.DataFrame({"doc": pdf["doc"].to_numpy(object)[at], "tie": pdf["tie"].to_numpy()[at],
                                "print": np.array([x[0] for x in flat], np.int64),
                                "runs": pd.Series([[dict(zip(("first", "last", "run1", "run2"), r)) for r in x[1]] for x in flat],
                                                  dtype=object)})

    src = docs.select(F.col("doc_id").cast("string").alias("doc"), F.xxhash64("text").alias("tie"), "text")
    return src.mapInPandas(run, _PRINT).withColumn("doc", F.col("doc").cast("bigint"))


def later_runs(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc, tie, first, last) of every joined run that also starts earlier."""
    prints = io.stage(selected(docs, min_lines, min_words), "line-prints")
    repeated = io.stage(prints.groupBy("print").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "line-repeated")
    runs = io.stage(join_counted(prints, repeated, ["print"], "n").select("doc", "tie", F.explode("runs").alias("r"))
                    .select("doc", "tie", "r.*"), "line-runs")
    key = ["run1", "run2"]
    here = F.struct("doc", "tie", "first")
    earliest = io.stage(runs.groupBy(*key).agg(F.min(here).alias("earliest"), F.count(F.lit(1)).alias("n"))
                        .where("n > 1"), "line-earliest")
    return (join_counted(runs, earliest, key, "n")
            .where(here > F.col("earliest")).select("doc", "tie", "first", "last"))


def line_dedup(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with later repeated runs of lines deleted from ``text``, and
    ``n_lines_removed``; ``n_chars``, if there, is the new length where lines
    were deleted.  All rows and all other columns stay.

    Lines end at \\n; white-space lines are no part of a run and stay.  Null
    and empty texts stay as they are.  Null ids come before all others.
    Documents that share an id are ordered by a hash of their text; rows that
    share id and text are one document and lose the same lines.  An empty
    table gives an empty result.  Columns of other names, also those used
    here, are kept (the count is named ``n_lines_removed`` and replaces a
    column of that name)."""
    # written, so that rows of one id and text, however many, can be split in
    # the join, which is a merge join whatever the number of cuts
    cuts = io.stage(later_runs(docs, min_lines, min_words).groupBy("doc", "tie")
                    .agg(F.collect_set(F.struct("first", "last")).alias("cut"))
                    .select(F.col("doc").alias("__llm_doc"), F.col("tie").alias("__llm_tie"),
                            F.transform("cut", lambda x: x["first"]).alias("__llm_a"),
                            F.transform("cut", lambda x: x["last"]).alias("__llm_b")), "line-cuts")

    @F.pandas_udf("struct<text: string, gone: int>")
    def rebuild(text: pd.Series, first: pd.Series, last: pd.Series) -> pd.DataFrame:
        out = []
        for t, a, b in zip(text, first, last):
            if t is None or a is None:
                out.append((None, 0))
                continue
            lines = t.split("\n")
            edge = np.zeros(len(lines) + 1, dtype=np.int64)
            np.add.at(edge, np.asarray(a), 1)
            np.add.at(edge, np.asarray(b) + 1, -1)
            inside = np.cumsum(edge[:-1]) > 0
            kept = [s for s, g in zip(lines, inside.tolist()) if not g or not s.strip(BLANK)]
            out.append(("\n".join(kept), len(lines) - len(kept)))
        return pd.DataFrame(out, columns=["text", "gone"])

    cut = F.col("__llm_a").isNotNull()
    joined = docs.join(cuts.hint("merge"), docs["doc_id"].eqNullSafe(F.col("__llm_doc")) & (F.xxhash64(docs["text"]) == F.col("__llm_tie")), "left")
    new = joined.withColumn("__llm_new", rebuild(F.when(cut, F.col("text")), F.col("__llm_a"), F.col("__llm_b")))
    cols = []
    for c in docs.columns:
        if c == "text":
            cols.append(F.when(cut, F.col("__llm_new.text")).otherwise(F.col("text")).alias("text"))
        elif c == "n_chars":
            cols.append(F.when(cut, F.length("__llm_new.text").cast(docs.schema[c].dataType))
                        .otherwise(F.col("n_chars")).alias("n_chars"))
        elif c != "n_lines_removed":
            cols.append(F.col(f"`{c}`"))
    return new.select(*cols, F.when(cut, F.col("__llm_new.gone")).otherwise(F.lit(0)).cast("int").alias("n_lines_removed"))
