"""Template-based keyword augmentation per category.

    ranked terms ─► whitelist (semi join / IN) ─► top-200 per (cid3, cid3_name)
                 ─► one array row per category (≤ 200 entries)
                 ─► per row: 500 draws × 5 rank bands, each a seeded md5 draw
                 ─► three templates per draw ─► (keyword, cid3, cid3_name)

After the single grouping into arrays every step is a per-row array
expression, so the draws and templates cost no shuffle; a category's work is
bounded by draws × bands.  Draws are md5 of (cid3, cid3_name, draw, band,
seed): reproducible on any partitioning and on retry.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qsig.functions.hashing import draw_int, uniform
from qsig.fixed import BAND_EDGES, DRAWS_PER_CATEGORY, TOP_TERMS

EDGES = BAND_EDGES
N_DRAWS = DRAWS_PER_CATEGORY
TOP_N = TOP_TERMS

GROUP = ("cid3", "cid3_name")


def in_categories(df: DataFrame, whitelist, col: str = "cid3") -> DataFrame:
    """A1: rows whose ``col`` is in the whitelist (a list, or a DataFrame whose
    first column holds the ids — then a semi join)."""
    if isinstance(whitelist, DataFrame):
        wl = whitelist.select(F.col(whitelist.columns[0]).alias(col)).distinct()
        return df.join(wl, col, "left_semi")
    return df.where(F.col(col).isin(list(dict.fromkeys(whitelist))))


def term_lists(ranked: DataFrame, n: int = TOP_N) -> DataFrame:
    """A2: ``(cid3, cid3_name, terms, ranks, tfidfs)`` of rank <= n, in rank order."""
    items = F.array_sort(F.collect_list(F.struct("rank", "term", "tfidf")))
    return ranked.where(F.col("rank") <= n).groupBy(*GROUP).agg(items.alias("items")).select(
        *GROUP, F.transform("items", lambda x: x["term"]).alias("terms"),
        F.transform("items", lambda x: x["rank"]).alias("ranks"),
        F.transform("items", lambda x: x["tfidf"]).alias("tfidfs"))


def _band_of(pos: Column, edges=EDGES) -> Column:
    expr = None
    for b in range(len(edges) - 1):
        cond = (pos >= edges[b]) & (pos < edges[b + 1])
        expr = F.when(cond, F.lit(b)) if expr is None else expr.when(cond, F.lit(b))
    return expr


def bands(lists: DataFrame, edges=EDGES) -> DataFrame:
    """A3: ``(cid3, cid3_name, pos, term, tfidf, band)`` — 0-based list
    position and its band [0,5) [5,20) [20,50) [50,100) [100,200)."""
    rows = lists.select(*GROUP, F.posexplode(F.arrays_zip("terms", "tfidfs")).alias("pos", "t"))
    return rows.select(*GROUP, "pos", F.col("t.terms").alias("term"), F.col("t.tfidfs").alias("tfidf"),
                       _band_of(F.col("pos"), edges).alias("band")).where(F.col("band").isNotNull())


def _band_info(weighted: bool, edges=EDGES) -> Column:
    """Per list: the non-empty bands as (band, lo, size[, cum]) structs."""
    nt = F.size("terms")
    lit_bands = F.array(*[F.struct(F.lit(b).alias("band"), F.lit(edges[b]).alias("lo"),
                                   F.lit(edges[b + 1]).alias("hi")) for b in range(len(edges) - 1)])
    present = F.filter(lit_bands, lambda x: x["lo"] < nt)

    def info(x):
        size = F.least(x["hi"], nt) - x["lo"]
        fields = [x["band"].alias("band"), x["lo"].alias("lo"), size.alias("size")]
        if weighted:
            w = F.slice("tfidfs", x["lo"] + 1, size)
            w = F.transform(w, lambda v: F.coalesce(v.cast("double"), F.lit(0.0)))
            total = F.aggregate(w, F.lit(0.0), lambda a, v: a + v)
            cum = F.transform(w, lambda v, i: F.try_divide(
                F.aggregate(F.slice(w, 1, i + 1), F.lit(0.0), lambda a, y: a + y), total))
            fields += [total.alias("total"), cum.alias("cum")]
        return F.struct(*fields)
    return F.transform(present, info)


def _pick(b: Column, draw: Column, seed: int, weighted: bool) -> Column:
    parts = [F.col("cid3"), F.col("cid3_name"), draw, b["band"]]
    flat = b["lo"] + draw_int(b["size"], parts, seed)
    if not weighted:
        return flat
    u = uniform(parts, seed)
    by_weight = b["lo"] + F.size(F.filter(b["cum"], lambda c: c <= u))
    return F.when(b["total"] > 0, by_weight).otherwise(flat)  # D19: all-zero band → uniform


def draws(lists: DataFrame, n: int = N_DRAWS, seed: int = 0, weighted: bool = False,
          edges=EDGES) -> DataFrame:
    """A4/A5: ``(cid3, cid3_name, draw, band, pos, term)``: per category ``n``
    draws, one term per non-empty band — uniform within the band, or with
    probability proportional to tf-idf (``weighted``)."""
    base = lists.select(*GROUP, "terms", "tfidfs", _band_info(weighted, edges).alias("bi"))
    rows = base.select(*GROUP, "terms", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("draw"), "bi")
    rows = rows.select(*GROUP, "terms", "draw", F.explode("bi").alias("b"))
    pos = _pick(F.col("b"), F.col("draw"), seed, weighted)
    out = rows.select(*GROUP, "terms", "draw", F.col("b.band").alias("band"), pos.alias("pos"))
    return out.select(*GROUP, "draw", "band", "pos", F.get(F.col("terms"), F.col("pos")).alias("term"))


def template_array(t: Column) -> Column:
    """The three keywords of one draw's terms t0..t(n-1), mid = n // 2:
    all joined; t0 + join(t[mid..n-2]); join(t[0..mid]).  No separator."""
    n = F.size(t)
    mid = (n / 2).cast("int")
    return F.array(F.array_join(t, ""),
                   F.concat(F.get(t, 0), F.array_join(F.slice(t, mid + 1, n - 1 - mid), "")),
                   F.array_join(F.slice(t, 1, mid + 1), ""))


def drawn_terms(lists: DataFrame, n: int = N_DRAWS, seed: int = 0, weighted: bool = False,
                edges=EDGES) -> DataFrame:
    """Per (category, draw) the drawn terms in band order, as one array."""
    base = lists.select(*GROUP, "terms", "tfidfs", _band_info(weighted, edges).alias("bi"))
    rows = base.select(*GROUP, "terms", "bi", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("draw"))
    t = F.transform("bi", lambda b: F.get(F.col("terms"), _pick(b, F.col("draw"), seed, weighted)))
    return rows.select(*GROUP, "draw", t.alias("t"))


def templates(drawn: DataFrame) -> DataFrame:
    """A6 rows: ``(cid3, cid3_name, draw, tpl, keyword)`` (3 per draw)."""
    return drawn.select(*GROUP, "draw", F.posexplode(template_array(F.col("t"))).alias("tpl", "keyword"))


def corpus(ranked: DataFrame, whitelist, n: int = N_DRAWS, seed: int = 0, weighted: bool = False,
           top_n: int = TOP_N) -> DataFrame:
    """``(keyword, cid3, cid3_name)``, 3·n rows per category, repeats kept."""
    lists = term_lists(in_categories(ranked, whitelist), top_n)
    t = templates(drawn_terms(lists, n, seed, weighted))
    return t.select("keyword", *GROUP)
