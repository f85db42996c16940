"""Keyword lists and sliding keyword windows per product.

    clicks ─► filter (dim, non-blank, dt range) ─► pv per (sku, key_word)   partial+final agg
          ─► top-n per sku (row_number, WindowGroupLimit before the shuffle)
          ─► ordered keyword array per sku (≤ n entries)
          ─► sliding windows of 3 consecutive keywords (array expressions)

A sku with a huge click history costs one partial aggregate per map task and
at most n rows per map task after the group limit, so no task ever holds a
hot sku's raw rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qsig.operators.ordering import rank_within
from qsig.sources.io import since as _since
from qsig.fixed import CLICK_DIM, LOOKBACK_DAYS, TOP_KEYWORDS, WINDOW_SEP, WINDOW_SIZE


def keyword_pv(df: DataFrame, dim: str = CLICK_DIM, dt: str | None = None,
               lookback_days: int = LOOKBACK_DAYS) -> DataFrame:
    """Clicks with ``dim_type == dim`` and a non-blank keyword (and, if
    ``dt`` is given, ``dt > dt - lookback``) counted per (sku, key_word).
    The raw (untrimmed) keyword is the group key."""
    kw = F.col("key_word")
    rows = df.where((F.col("dim_type") == F.lit(dim)) & kw.isNotNull() & (F.trim(kw) != ""))
    if dt is not None:
        rows = _since(rows, dt, lookback_days)
    return rows.groupBy("sku", "key_word").agg(F.count(F.lit(1)).alias("pv"))


def top_keywords(pv: DataFrame, n: int = TOP_KEYWORDS) -> DataFrame:
    """The ``n`` most clicked keywords per sku (pv desc, then keyword)."""
    return rank_within(pv, ["sku"], [F.col("pv").desc(), F.col("key_word").asc()], "rank", limit=n)


def keyword_list(top: DataFrame) -> DataFrame:
    """``(sku, keywords array<string>)`` in rank order (bounded by n)."""
    items = F.array_sort(F.collect_list(F.struct("rank", "key_word")))
    return top.groupBy("sku").agg(F.transform(items, lambda x: x["key_word"]).alias("keywords"))


def keyword_windows(lists: DataFrame, size: int = WINDOW_SIZE, col: str = "keywords", sep: str = WINDOW_SEP,
                    key: str = "sku", out: str = "query") -> DataFrame:
    """Every run of ``size`` consecutive keywords joined by ``sep``;
    a list of at most ``size - 1`` keywords gives one row with all of them."""
    ks = F.col(col)
    n = F.size(ks)
    windows = F.transform(F.sequence(F.lit(1), n - size + 1),
                          lambda i: F.array_join(F.slice(ks, i, size), sep))
    rows = F.when(n > size - 1, windows).otherwise(F.array(F.array_join(ks, sep)))
    return lists.select(key, F.explode(rows).alias(out))


def keyword_triples(clicks: DataFrame, dim: str = CLICK_DIM, dt: str | None = None,
                    lookback_days: int = LOOKBACK_DAYS, n: int = TOP_KEYWORDS) -> DataFrame:
    """P1-P4 composed: the reference's ``(sku, query)`` output."""
    top = top_keywords(keyword_pv(clicks, dim, dt, lookback_days), n)
    return keyword_windows(keyword_list(top))
