"""Term statistics per product category: TF-IDF and per-category ranking.

Plan shape (no data passes through the driver):

    term rows ─► counts (cid3, cid3_name, term)      partial+final HashAggregate,
                                                    staged once as a table
                   ├─► totals per cid3      (roll-up of counts, not a rescan)
                   ├─► df per term          (distinct (term, cid3) roll-up of counts)
                   └─► N = count(distinct cid3)   scalar subquery, evaluated once
    tf  = counts ⋈ totals on cid3   (left: a null cid3 keeps its row with tf null)
    tfidf = tf · ln(N / df)          (left join on term; no smoothing)
    rank  = row_number per cid3 by tfidf desc, term, cid3_name
            (top-k: WindowGroupLimit; full rank: two-level, for groups of any size,
            one category is too big for a task)

Counts are a roll-up of the raw term rows, so everything after the first
aggregate works on the vocabulary per category, not on the raw text; a hot
category or term is combined map-side before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qsig.fixed import TERM_SEP
from qsig.operators.ordering import asc, desc, rank_within
from qsig.sources.io import stage

KEYS = ("cid3", "cid3_name")


def explode_terms(df: DataFrame, keep=KEYS, col: str = "sku_term", sep: str = TERM_SEP,
                  out: str = "term") -> DataFrame:
    """One row per term.  ``col`` is a ``sep``-joined string or an array.

    Repeats are kept, an empty string is a term, a null list drops the row.
    """
    c = F.col(col)
    dtype = df.schema[col].dataType
    arr = c if isinstance(dtype, T.ArrayType) else F.split(c, "\\Q" + sep + "\\E")
    # posexplode_outer + "pos is not null" keeps exactly explode's rows; a plain
    # explode makes Catalyst infer size(arr) > 0 and push that filter — and the
    # whole tokenising expression — below any exchange spreading the input
    rows = df.select(*keep, F.posexplode_outer(arr).alias("__pos", out))
    return rows.where(F.col("__pos").isNotNull()).drop("__pos")


def term_counts(terms: DataFrame) -> DataFrame:
    """``nums`` = term rows per (cid3, cid3_name, term)."""
    return terms.groupBy("cid3", "cid3_name", "term").agg(F.count(F.lit(1)).alias("nums"))


def category_totals(terms_or_counts: DataFrame) -> DataFrame:
    """``allnums`` = term rows per cid3 (accepts term rows or T3 counts)."""
    if "nums" in terms_or_counts.columns:
        return terms_or_counts.groupBy("cid3").agg(F.sum("nums").alias("allnums"))
    return terms_or_counts.groupBy("cid3").agg(F.count(F.lit(1)).alias("allnums"))


def term_frequency(terms: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """T4: ``tf = nums / allnums``; denominator per cid3, numerator per
    (cid3, cid3_name, term).  A null cid3 matches no total, so its tf is null."""
    counts = term_counts(terms) if counts is None else counts
    totals = category_totals(counts)
    return (counts.join(totals, "cid3", "left")
            .select("cid3", "cid3_name", "term", "nums",
                    F.try_divide(F.col("nums").cast("double"), F.col("allnums")).alias("tf")))


def category_count(tf: DataFrame) -> DataFrame:
    """T5: number of distinct non-null cid3 (a one-row DataFrame ``num``)."""
    return tf.agg(F.count_distinct("cid3").alias("num"))


def document_frequency(terms_or_counts: DataFrame) -> DataFrame:
    """Number of distinct non-null cid3 a term occurs in (``nums``)."""
    pairs = terms_or_counts.select("term", "cid3").where(F.col("cid3").isNotNull()).distinct()
    counted = pairs.groupBy("term").agg(F.count(F.lit(1)).alias("nums"))
    # a term seen only under a null cid3 has df 0
    all_terms = terms_or_counts.select("term").distinct()
    return all_terms.join(counted, "term", "left").select(
        "term", F.coalesce("nums", F.lit(0)).cast("bigint").alias("nums"))


def _df_counts(terms_or_counts: DataFrame) -> DataFrame:
    pairs = terms_or_counts.select("term", "cid3").where(F.col("cid3").isNotNull()).distinct()
    return pairs.groupBy("term").agg(F.count(F.lit(1)).alias("nums"))


def _tfidf_and_counts(terms: DataFrame, materialise: bool = True) -> tuple[DataFrame, DataFrame]:
    counts = stage(term_counts(terms), "term_counts") if materialise else term_counts(terms)
    tf = term_frequency(terms, counts)
    n_cat = category_count(counts).scalar()  # same cid3 set as tf, read from the small table
    dfreq = _df_counts(counts).withColumnRenamed("nums", "df")
    idf = F.ln(F.try_divide(n_cat.cast("double"), F.col("df")))
    scored = (tf.join(dfreq, "term", "left")
              .select("cid3", "cid3_name", "term", (F.col("tf") * idf).alias("tfidf")))
    return scored, counts


def tfidf(terms: DataFrame, materialise: bool = True) -> DataFrame:
    """``tfidf = tf * ln(N / df)`` per (cid3, cid3_name, term).

    No smoothing: a term present in every category scores 0.  Division by a
    zero df or an unknown tf gives null rather than failing.

    The term counts feed three roll-ups (totals, df, N); with ``materialise``
    they are computed once and staged as a table (vocabulary-sized, far
    smaller than the raw text) instead of re-tokenising the text per branch.
    """
    return _tfidf_and_counts(terms, materialise)[0]


def rank_terms(scored: DataFrame, limit: int | None = None) -> DataFrame:
    """``rank`` = row_number within cid3 by tfidf desc (nulls last),
    ties broken by term then cid3_name.  ``limit`` keeps rank <= limit."""
    return rank_within(scored, ["cid3"], [desc("tfidf"), asc("term"), asc("cid3_name")], "rank", limit=limit)


def tfidf_ranked(terms: DataFrame, limit: int | None = None, categories=None) -> DataFrame:
    """T1-T8 composed: (cid3, cid3_name, term, tfidf, rank).

    ``categories`` (a list of cid3) keeps only those categories; the filter
    is applied before ranking, which is exact because ranks are per cid3,
    while N and df still count every category."""
    scored, _ = _tfidf_and_counts(terms)
    if categories is not None:
        scored = scored.where(F.col("cid3").isin(list(dict.fromkeys(categories))))
    return rank_terms(scored, limit=limit)
