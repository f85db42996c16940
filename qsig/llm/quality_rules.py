"""Quality rules: a threshold table compiled into one Spark projection.

Only built-in column functions are used: no user functions, no shuffle, one
pass over the text.  Words are runs of characters other than space and 09-0D.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8      # words in a repetition window

#: common function words of the corpus languages
STOP_WORDS = ("the and of to in is that it for with "
              "der die und das nicht ein ist mit von zu "
              "le la et les des un une que est en "
              "el los de y las se por su para del").split()


@dataclass(frozen=True)
class Rule:
    """``low <= top / bottom <= high``; without anything to divide by it passes."""

    name: str
    top: str
    bottom: str
    low: float | None = None
    high: float | None = None


#: top and bottom may be n_words, word_chars, n_symbols, n_dup_lines, n_lines, n_stop, n_upper
RULES = (
    Rule("word_length", "word_chars", "n_words", 2.0, 15.0),
    Rule("symbols_per_word", "n_symbols", "n_words", high=0.10),
    Rule("stop_words_per_word", "n_stop", "n_words", low=0.005),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", high=0.50),
    Rule("upper_case", "n_upper", "word_chars", high=0.30),
)
BASE_MIN_WORDS = 20
BASE_MAX_REPEAT_PERCENT = 30


def compile_rules(rules: tuple[Rule, ...]) -> Column:
    """Array of the names of failed rules, as one column expression."""
    failed = []
    for r in rules:
        bad = None
        ratio = F.try_divide(F.col(r.top), F.col(r.bottom))
        for c in ([ratio < r.low] if r.low is not None else []) + ([ratio > r.high] if r.high is not None else []):
            c = F.coalesce(c, F.lit(False))
            bad = c if bad is None else bad | c
        if bad is not None:
            failed.append(F.when(bad, F.lit(r.name)))
    return F.array_compact(F.array(*failed)) if failed else F.array().cast("array<string>")


def _repeat_words(windows: str, ranked: str) -> Column:
    """Words covered by windows found at least twice: ``ranked`` holds the
    (hash, place) pairs in order, where equal neighbours mark such windows."""
    def twice(x: Column, i: Column) -> Column:
        before = F.get(F.col(ranked), i - 1)["h"] == x["h"]
        after = F.get(F.col(ranked), i + 1)["h"] == x["h"]
        return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

    places = F.sort_array(F.transform(F.filter(F.col(ranked), twice), lambda x: x["i"]))
    start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n"))
    return F.aggregate(
        places, start,
        lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(WINDOW), p - a["last"])).alias("n")),
        lambda a: a["n"])


def measures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """doc_id and the counts that rules read, one row per row of ``docs``."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    stop = r"(?<![\p{L}\p{N}])(?:" + "|".join(STOP_WORDS) + r")(?![\p{L}\p{N}])"
    base = docs.select(
        "doc_id",
        F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "").alias("words"),
        F.length(F.translate(text, SPACES, "")).cast("bigint").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        F.filter(F.split(text, "\n"), lambda s: s.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        F.regexp_count(F.lower(text), F.lit(stop)).alias("n_stop"),
        F.regexp_count(text, F.lit(r"\p{Lu}")).alias("n_upper"))
    n = F.size("words")
    hashes = F.when(n >= WINDOW, F.transform(
        F.sequence(F.lit(1), F.greatest(n - (WINDOW - 1), F.lit(1))),
        lambda i: F.xxhash64(F.slice(F.col("words"), i, WINDOW)))).otherwise(F.array().cast("array<bigint>"))
    hashed = base.select("doc_id", "word_chars", "n_symbols", "n_stop", "n_upper",
                         n.cast("bigint").alias("n_words"), F.size("lines").cast("bigint").alias("n_lines"),
                         (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
                         hashes.alias("windows"))
    # most texts repeat no window: only the others are ranked
    again = F.size(F.array_distinct("windows")) < F.size("windows")
    pairs = F.transform(F.col("windows"), lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    ranked = hashed.withColumn("ranked", F.when(again, F.sort_array(pairs)).otherwise(none))
    return ranked.withColumn("n_repeat_words", _repeat_words("windows", "ranked").cast("bigint")).drop("windows", "ranked")


def quality_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, failed_rules.

    Base: at least 20 words, and at most 30 in 100 of them in an 8-word window
    that the text has twice.  ``kept`` needs the base and every rule.  Null
    and empty texts have no words and fail the base.  Windows are told apart
    by a 64-bit hash within one text.  Rows are judged one by one, so repeats
    judge alike; an empty table gives an empty result; other columns are not
    read."""
    m = measures(docs, text_col)
    base = F.expr(f"n_words < {BASE_MIN_WORDS} or 100 * n_repeat_words > {BASE_MAX_REPEAT_PERCENT} * n_words")
    judged = m.withColumn("base_failed", base).withColumn("failed_rules", compile_rules(rules))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         (~F.col("base_failed") & (F.size("failed_rules") == 0)).alias("kept"), "failed_rules")
