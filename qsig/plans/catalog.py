"""Registered queries: one per operator of SURVEY §2 that has a query key.

Every query reads the driver's test tables through ``plans.adapters`` and
returns scalar columns only (arrays are rendered as text or long form) so the
oracle can compare values.  Doubles are rounded to 6 places on both sides
(``+ 0.0`` folds a negative zero); counts and ranks are BIGINT on both sides.
``ORACLE`` holds the DuckDB text of each query.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from qsig.plans import adapters as A
from qsig.operators import terms

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def r6(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double"), 6) + F.lit(0.0)


def s6(expr: str) -> str:
    return f"(round(CAST({expr} AS DOUBLE), 6) + 0.0)"


def dec6_text(c) -> Column:
    """A double as fixed 6-decimal text (identical on both engines)."""
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("decimal(18,6)").cast("string")


def sql_dec6_text(expr: str) -> str:
    return f"CAST(CAST({expr} AS DECIMAL(18,6)) AS VARCHAR)"


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


# =================================================================== T: tf-idf

def _terms(spark, d):
    return terms.explode_terms(A.category_terms(spark, d), col="terms")


@register("term_explode", with_(A.SQL_CATEGORY_TERMS) + " SELECT cid3, cid3_name, term FROM t")
def q_term_explode(spark, d):
    return _terms(spark, d)


@register("category_totals", with_(A.SQL_CATEGORY_TERMS)
          + " SELECT cid3, count(*) AS allnums FROM t GROUP BY cid3")
def q_category_totals(spark, d):
    return terms.category_totals(_terms(spark, d)).select("cid3", F.col("allnums").cast("bigint"))


@register("term_counts", with_(A.SQL_CATEGORY_TERMS)
          + " SELECT cid3, cid3_name, term, count(*) AS nums FROM t GROUP BY cid3, cid3_name, term")
def q_term_counts(spark, d):
    return terms.term_counts(_terms(spark, d))


SQL_TF = """
  per_term AS (SELECT cid3, cid3_name, term, count(*) AS uses FROM t GROUP BY ALL),
  tf AS (SELECT cid3, cid3_name, term,
                CASE WHEN cid3 IS NOT NULL THEN CAST(uses AS DOUBLE) / sum(uses) OVER (PARTITION BY cid3) END AS tf
         FROM per_term)"""


@register("term_frequency", with_(A.SQL_CATEGORY_TERMS, SQL_TF)
          + f" SELECT cid3, cid3_name, term, {s6('tf')} AS tf FROM tf")
def q_term_frequency(spark, d):
    return terms.term_frequency(_terms(spark, d)).select("cid3", "cid3_name", "term", r6("tf").alias("tf"))


@register("category_count", with_(A.SQL_CATEGORY_TERMS, SQL_TF)
          + " SELECT count(DISTINCT cid3) AS num FROM tf")
def q_category_count(spark, d):
    return terms.category_count(terms.term_frequency(_terms(spark, d)))


@register("document_frequency", with_(A.SQL_CATEGORY_TERMS)
          + " SELECT term, count(DISTINCT cid3) AS nums FROM t GROUP BY term")
def q_document_frequency(spark, d):
    return terms.document_frequency(_terms(spark, d))


SQL_TFIDF = """
  spread AS (SELECT term, count(DISTINCT cid3) AS cats FROM per_term GROUP BY term),
  tfidf AS (SELECT cid3, cid3_name, term,
                   tf * ln((SELECT count(DISTINCT cid3) FROM per_term) / nullif(CAST(cats AS DOUBLE), 0)) AS tfidf
            FROM tf JOIN spread USING (term))"""


@register("tfidf", with_(A.SQL_CATEGORY_TERMS, SQL_TF, SQL_TFIDF)
          + f" SELECT cid3, cid3_name, term, {s6('tfidf')} AS tfidf FROM tfidf")
def q_tfidf(spark, d):
    return terms.tfidf(_terms(spark, d)).select("cid3", "cid3_name", "term", r6("tfidf").alias("tfidf"))


SQL_RANKED = """
  ranked AS (SELECT cid3, cid3_name, term, tfidf,
                    row_number() OVER (PARTITION BY cid3 ORDER BY tfidf DESC NULLS LAST, term, cid3_name) AS rank
             FROM tfidf)"""


@register("tfidf_ranked", with_(A.SQL_CATEGORY_TERMS, SQL_TF, SQL_TFIDF, SQL_RANKED)
          + f" SELECT cid3, cid3_name, term, {s6('tfidf')} AS tfidf, rank FROM ranked")
def q_tfidf_ranked(spark, d):
    out = terms.tfidf_ranked(_terms(spark, d))
    return out.select("cid3", "cid3_name", "term", r6("tfidf").alias("tfidf"), "rank")


def flagship(spark: SparkSession, d: str, limit: int = 10) -> DataFrame:
    """Top terms per category (rank <= limit), the ``entry()`` query."""
    out = terms.tfidf_ranked(_terms(spark, d), limit=limit)
    return out.select("cid3", "cid3_name", "term", r6("tfidf").alias("tfidf"), "rank")


# ============================================================ P: keyword pairs

from qsig.operators import pairs  # noqa: E402
from qsig.sources import io  # noqa: E402

CUTOFF = io.cutoff_date(A.CLICK_DT, A.CLICK_LOOKBACK)
SQL_PV = f"""
  pv AS (SELECT sku, key_word, count(*) AS pv FROM click
         WHERE dim_type = '{A.CLICK_DIM}' AND key_word IS NOT NULL AND trim(key_word) <> ''
           AND dt > '{CUTOFF}' GROUP BY sku, key_word),
  top AS (SELECT sku, key_word, pv, row_number() OVER (PARTITION BY sku ORDER BY pv DESC, key_word) AS rank
          FROM pv QUALIFY rank <= 50),
  kl AS (SELECT sku, list(key_word ORDER BY rank) AS ks FROM top GROUP BY sku)"""


def _pv(spark, d):
    return pairs.keyword_pv(A.click_log(spark, d), dim=A.CLICK_DIM, dt=A.CLICK_DT,
                            lookback_days=A.CLICK_LOOKBACK)


@register("scan_since", with_(A.SQL_CLICK_LOG)
          + f" SELECT sku, key_word, dim_type, dt FROM click WHERE dt > '{CUTOFF}'")
def q_scan_since(spark, d):
    return io.since(A.click_log(spark, d), A.CLICK_DT, A.CLICK_LOOKBACK)


@register("keyword_pv", with_(A.SQL_CLICK_LOG, SQL_PV) + " SELECT sku, key_word, pv FROM pv")
def q_keyword_pv(spark, d):
    return _pv(spark, d)


@register("top_keywords", with_(A.SQL_CLICK_LOG, SQL_PV) + " SELECT sku, key_word, pv, rank FROM top")
def q_top_keywords(spark, d):
    return pairs.top_keywords(_pv(spark, d), 50)


@register("keyword_list", with_(A.SQL_CLICK_LOG, SQL_PV)
          + " SELECT sku, array_to_string(ks, '&&') AS keywords FROM kl")
def q_keyword_list(spark, d):
    kl = pairs.keyword_list(pairs.top_keywords(_pv(spark, d), 50))
    return kl.select("sku", F.array_join("keywords", "&&").alias("keywords"))


@register("keyword_triples", with_(A.SQL_CLICK_LOG, SQL_PV) + """
  SELECT sku, unnest(CASE WHEN len(ks) > 2
                          THEN list_transform(range(1, len(ks) - 1), lambda i: array_to_string(ks[i:i + 2], ' '))
                          ELSE [array_to_string(ks, ' ')] END) AS query
  FROM kl""")
def q_keyword_triples(spark, d):
    return pairs.keyword_triples(A.click_log(spark, d), dim=A.CLICK_DIM, dt=A.CLICK_DT,
                                 lookback_days=A.CLICK_LOOKBACK)


# ============================================================== N: sample pairs

from qsig.functions.hashing import sql_draw_int  # noqa: E402
from qsig.operators import samples  # noqa: E402

SEED = 7
K_NEG = 5
SQL_NAMES = f"""
  names AS (SELECT DISTINCT name FROM gp WHERE name IS NOT NULL AND name <> ''),
  idx AS (SELECT name, row_number() OVER (ORDER BY md5(name), name) - 1 AS idx FROM names),
  ncount AS (SELECT count(*) AS n FROM names),
  draws AS (SELECT name, CAST(j AS INTEGER) AS draw_no,
                   {sql_draw_int('(SELECT n FROM ncount)', ['name', 'j'], SEED)} AS draw
            FROM names, range(0, {K_NEG}) r(j)),
  neg AS (SELECT d.name AS query_1, i.name AS query_2, 0 AS label FROM draws d JOIN idx i ON d.draw = i.idx),
  mem AS (SELECT pathid, name, min(ord) AS ord FROM gp WHERE name IS NOT NULL AND name <> ''
          GROUP BY pathid, name),
  rk AS (SELECT *, row_number() OVER (PARTITION BY pathid ORDER BY ord, name) AS pos FROM mem),
  pos AS (SELECT a.name AS query_1, b.name AS query_2, 1 AS label
          FROM rk a JOIN rk b ON a.pathid = b.pathid AND b.pos = a.pos + 1)"""


def _gp(spark, d):
    return A.graph_path(spark, d)


@register("distinct_names", with_(A.SQL_GRAPH_PATH, SQL_NAMES) + " SELECT name FROM names")
def q_distinct_names(spark, d):
    return samples.distinct_names(_gp(spark, d))


@register("dense_index", with_(A.SQL_GRAPH_PATH, SQL_NAMES) + " SELECT name, idx FROM idx")
def q_dense_index(spark, d):
    return samples.dense_index(_gp(spark, d))


@register("name_count", with_(A.SQL_GRAPH_PATH, SQL_NAMES) + ' SELECT n AS "count" FROM ncount')
def q_name_count(spark, d):
    return samples.name_count(_gp(spark, d))


@register("random_draws", with_(A.SQL_GRAPH_PATH, SQL_NAMES) + " SELECT name, draw_no, draw FROM draws")
def q_random_draws(spark, d):
    return samples.random_draws(_gp(spark, d), K_NEG, SEED)


@register("negative_pairs", with_(A.SQL_GRAPH_PATH, SQL_NAMES) + " SELECT * FROM neg")
def q_negative_pairs(spark, d):
    return samples.negative_pairs(_gp(spark, d), K_NEG, SEED)


@register("path_list", with_(A.SQL_GRAPH_PATH, SQL_NAMES) + " SELECT pathid, pos, name FROM rk")
def q_path_list(spark, d):
    return samples.path_list(_gp(spark, d), order_col="ord")


@register("positive_pairs", with_(A.SQL_GRAPH_PATH, SQL_NAMES) + " SELECT * FROM pos")
def q_positive_pairs(spark, d):
    return samples.positive_pairs(_gp(spark, d), order_col="ord")


@register("labelled_pairs", with_(A.SQL_GRAPH_PATH, SQL_NAMES)
          + " SELECT * FROM neg UNION ALL SELECT * FROM pos")
def q_labelled_pairs(spark, d):
    return samples.labelled_pairs(_gp(spark, d), K_NEG, SEED, order_col="ord")


# ========================================================= F: score features

from qsig.operators import features  # noqa: E402

SQL_KEPT = """
  sizes AS (SELECT query, count(*) AS num FROM qs GROUP BY query),
  kept AS (SELECT qs.*, num FROM qs JOIN sizes USING (query) WHERE num BETWEEN 20 AND 12000),
  stats AS (SELECT query, avg(score) AS mean, stddev_pop(score) AS std FROM kept GROUP BY query),
  z AS (SELECT kept.query, sku, score, (score - mean) / nullif(std, 0) AS z
        FROM kept JOIN stats USING (query)),
  zmin AS (SELECT query, sku, min(z) AS z FROM z WHERE score IS NOT NULL GROUP BY query, sku),
  g AS (SELECT query, list_sort(list(score) FILTER (WHERE score IS NOT NULL), 'DESC') AS v,
               avg(score) AS mean, stddev_pop(score) AS std FROM kept GROUP BY query),
  fr AS (SELECT query,
           (v[CAST(floor(len(v) * 0.25) AS BIGINT) + 1] - mean) / nullif(std, 0) AS quarter_n,
           v[CAST(floor(len(v) * 0.25) AS BIGINT) + 1] AS quarter,
           (v[CAST(floor(len(v) * 0.5) AS BIGINT) + 1] - mean) / nullif(std, 0) AS half_n,
           v[CAST(floor(len(v) * 0.5) AS BIGINT) + 1] AS half,
           (v[CAST(floor(len(v) * 0.75) AS BIGINT) + 1] - mean) / nullif(std, 0) AS three_quarters_n,
           v[CAST(floor(len(v) * 0.75) AS BIGINT) + 1] AS three_quarters
         FROM g)"""

FRACTILE_COLS = ["quarter_n", "quarter", "half_n", "half", "three_quarters_n", "three_quarters"]
SQL_FRACTILE_SELECT = ", ".join(f"{s6(c)} AS {c}" for c in FRACTILE_COLS)


def _qs(spark, d):
    return A.query_scores(spark, d)


@register("collect_scores", with_(A.SQL_QUERY_SCORES) + f"""
  SELECT query, count(*) OVER (PARTITION BY query) AS num, sku, {s6('score')} AS score FROM qs""")
def q_collect_scores(spark, d):
    return features.collect_scores(_qs(spark, d)).select("query", "num", "sku", r6("score").alias("score"))


@register("size_filter", with_(A.SQL_QUERY_SCORES, SQL_KEPT) + " SELECT DISTINCT query, num FROM kept")
def q_size_filter(spark, d):
    return features.size_filter(_qs(spark, d)).select("query", "num").distinct()


@register("score_zscore", with_(A.SQL_QUERY_SCORES, SQL_KEPT)
          + f" SELECT query, sku, {s6('score')} AS score, {s6('z')} AS z FROM z")
def q_score_zscore(spark, d):
    z = features.zscore(_qs(spark, d), sizes=(features.MIN_GROUP, features.MAX_GROUP))
    return z.select("query", "sku", r6("score").alias("score"), r6("z").alias("z"))


@register("score_fractiles", with_(A.SQL_QUERY_SCORES, SQL_KEPT)
          + f" SELECT query, {SQL_FRACTILE_SELECT} FROM fr")
def q_score_fractiles(spark, d):
    fr = features.fractiles(_qs(spark, d))
    return fr.select("query", *[r6(c).alias(c) for c in FRACTILE_COLS])


@register("score_map_long", with_(A.SQL_QUERY_SCORES, SQL_KEPT)
          + f" SELECT query, sku, {s6('z')} AS z FROM zmin")
def q_score_map_long(spark, d):
    m = features.score_map_long(_qs(spark, d), sizes=(features.MIN_GROUP, features.MAX_GROUP))
    return m.select("query", "sku", r6("z").alias("z"))


def _map_text(m: str) -> Column:
    return F.array_join(F.array_sort(F.transform(F.map_entries(m), lambda e: F.concat(
        e["key"], F.lit(":"), F.coalesce(dec6_text(e["value"]), F.lit("null"))))), ",")


SQL_MAP_TEXT = f"array_to_string(list_sort(list(zmin.sku || ':' || coalesce({sql_dec6_text('zmin.z')}, 'null'))), ',')"


@register("score_map", with_(A.SQL_QUERY_SCORES, SQL_KEPT)
          + f" SELECT query, {SQL_MAP_TEXT} AS sku_score_normal FROM zmin GROUP BY query")
def q_score_map(spark, d):
    """F5 in map form, the map as text."""
    return features.score_map(_qs(spark, d)).select("query", _map_text("sku_score_normal").alias("sku_score_normal"))


@register("query_features", with_(A.SQL_QUERY_SCORES, SQL_KEPT) + f"""
  SELECT s.query, CAST(s.num AS INTEGER) AS num, {SQL_FRACTILE_SELECT},
         {SQL_MAP_TEXT} AS sku_score_normal
  FROM (SELECT DISTINCT query, num FROM kept) s JOIN fr USING (query) JOIN zmin USING (query)
  GROUP BY ALL""")
def q_query_features(spark, d):
    qf = features.query_features(_qs(spark, d))
    return qf.select("query", "num", *[r6(c).alias(c) for c in FRACTILE_COLS], _map_text("sku_score_normal").alias("sku_score_normal"))


# ===================================================== C: cosine similarity

from qsig.operators import similarity  # noqa: E402

TOPK = 200

SQL_UNIT = """
  nn AS (SELECT id, vec, sqrt(list_sum(list_transform(vec, lambda y: y * y))) AS nrm FROM vecs),
  u AS (SELECT id, nrm, list_transform(vec, lambda x: coalesce(x / nullif(nrm, 0), 0.0)) AS unit FROM nn)"""


def sql_cosine_topk(src: str, k: int) -> str:
    """DuckDB: top-k by (score rounded to 12 places desc, neighbour) over all pairs of ``src``."""
    return f"""
  {src}_pairs AS (SELECT a.id, b.id AS neighbour, list_dot_product(a.unit, b.unit) AS score
                  FROM {src} a, {src} b),
  {src}_topk AS (SELECT id, neighbour, score,
                        row_number() OVER (PARTITION BY id ORDER BY round(score, 12) DESC, neighbour) AS rank
                 FROM {src}_pairs QUALIFY rank <= {k})"""


@register("unit_vectors", with_(A.SQL_VECTORS, SQL_UNIT) + f"""
  SELECT id, {s6('nrm')} AS norm, unnest(range(0, len(unit))) AS pos, {s6('unnest(unit)')} AS x FROM u""")
def q_unit_vectors(spark, d):
    u = similarity.normalise(A.vectors(spark, d))
    return u.select("id", r6("norm").alias("norm"), F.posexplode("unit").alias("pos", "x")).select(
        "id", "norm", F.col("pos").cast("bigint").alias("pos"), r6("x").alias("x"))


@register("cosine_topk", with_(A.SQL_VECTORS, SQL_UNIT, sql_cosine_topk("u", TOPK))
          + f" SELECT id, neighbour, {s6('score')} AS score, rank FROM u_topk")
def q_cosine_topk(spark, d):
    t = similarity.cosine_topk(A.vectors(spark, d), k=TOPK)
    return t.select("id", "neighbour", r6("score").alias("score"), "rank")


# ========================================================= Q: weighted scoring

from qsig.operators import scoring  # noqa: E402


def _sim(spark, d, sales=None):
    t = similarity.cosine_topk(A.brand_vectors(spark, d, sales), k=A.SIM_TOPK)
    return t.select(F.col("id").alias("cid3"), "neighbour", "score")


def _scored(spark, d):
    sales = A.sales(spark, d)
    return scoring.scored_table(A.query_sku_cate(spark, d, sales), _sim(spark, d, sales))


SQL_SIM = ("""
  bnn AS (SELECT id, vec, sqrt(list_sum(list_transform(vec, lambda y: y * y))) AS nrm FROM bvec),
  bu AS (SELECT id, list_transform(vec, lambda x: coalesce(x / nullif(nrm, 0), 0.0)) AS unit FROM bnn),"""
           + sql_cosine_topk("bu", A.SIM_TOPK) + """,
  sim AS (SELECT id AS cid3, neighbour, score FROM bu_topk)""")

SQL_SCORE = """
  rows_ AS (SELECT *, row_number() OVER () AS rid FROM qsc
            WHERE query_cate IS NOT NULL AND sku_cate IS NOT NULL),
  qi AS (SELECT rid, unnest(query_cate[1:least(len(query_cate), len(query_cate_weight))]) AS qc,
                unnest(query_cate_weight[1:least(len(query_cate), len(query_cate_weight))]) AS qw,
                list_sum(list_transform(query_cate_weight, lambda x: coalesce(x, 0.0))) AS qsum
         FROM rows_),
  si AS (SELECT rid, unnest(sku_cate[1:least(len(sku_cate), len(sku_cate_weight))]) AS sc,
                unnest(sku_cate_weight[1:least(len(sku_cate), len(sku_cate_weight))]) AS sw,
                list_sum(list_transform(sku_cate_weight, lambda x: coalesce(x, 0.0))) AS ssum
         FROM rows_),
  terms_ AS (SELECT qi.rid, coalesce(coalesce(qw, 0.0) / nullif(qsum, 0), 0.0)
                          * coalesce(coalesce(sw, 0.0) / nullif(ssum, 0), 0.0)
                          * coalesce(sim.score, 0.0) AS t
             FROM qi JOIN si ON qi.rid = si.rid LEFT JOIN sim ON sim.cid3 = qi.qc AND sim.neighbour = si.sc),
  scored AS (SELECT rows_.*, coalesce((SELECT sum(t) FROM terms_ WHERE terms_.rid = rows_.rid), 0.0)
                             AS query_sku_score FROM rows_)"""


def _arr_text(c: str) -> Column:
    return F.array_join(F.transform(c, lambda x: F.coalesce(dec6_text(x), F.lit("null"))), ",")


def _sql_arr_text(c: str) -> str:
    return f"array_to_string(list_transform({c}, lambda x: coalesce({sql_dec6_text('x')}, 'null')), ',')"


@register("score_valid_rows", with_(A.SQL_QUERY_SKU_CATE)
          + " SELECT query, sku, search_count FROM qsc WHERE query_cate IS NOT NULL AND sku_cate IS NOT NULL")
def q_score_valid_rows(spark, d):
    return scoring.valid_rows(A.query_sku_cate(spark, d)).select("query", "sku", "search_count")


@register("normalised_weights", with_(A.SQL_QUERY_SKU_CATE) + f"""
  SELECT query, sku,
    {_sql_arr_text("list_transform(query_cate_weight, lambda x: coalesce(x, 0.0) / nullif(list_sum(list_transform(query_cate_weight, lambda y: coalesce(y, 0.0))), 0))")} AS qw,
    {_sql_arr_text("list_transform(sku_cate_weight, lambda x: coalesce(x, 0.0) / nullif(list_sum(list_transform(sku_cate_weight, lambda y: coalesce(y, 0.0))), 0))")} AS sw
  FROM qsc""")
def q_normalised_weights(spark, d):
    w = scoring.normalise_weights(A.query_sku_cate(spark, d))
    return w.select("query", "sku", _arr_text(scoring.QW + "_norm").alias("qw"),
                    _arr_text(scoring.SW + "_norm").alias("sw"))


@register("query_sku_score", with_(A.SQL_QUERY_SKU_CATE, A.SQL_BRAND_VECTORS, SQL_SIM, SQL_SCORE)
          + f" SELECT query, sku, {s6('query_sku_score')} AS query_sku_score FROM scored")
def q_query_sku_score(spark, d):
    return _scored(spark, d).select("query", "sku", r6("query_sku_score").alias("query_sku_score"))


@register("scored_table", with_(A.SQL_QUERY_SKU_CATE, A.SQL_BRAND_VECTORS, SQL_SIM, SQL_SCORE) + f"""
  SELECT query, sku, sku_name, {s6('query_sku_score')} AS query_sku_score,
         array_to_string(query_cate, ',') AS query_cate, {_sql_arr_text('query_cate_weight')} AS query_cate_weight,
         array_to_string(sku_cate, ',') AS sku_cate, {_sql_arr_text('sku_cate_weight')} AS sku_cate_weight,
         sku_org_cate, search_count FROM scored""")
def q_scored_table(spark, d):
    s = _scored(spark, d)
    return s.select("query", "sku", "sku_name", r6("query_sku_score").alias("query_sku_score"),
                    F.array_join(scoring.QC, ",").alias(scoring.QC), _arr_text(scoring.QW).alias(scoring.QW),
                    F.array_join(scoring.SC, ",").alias(scoring.SC), _arr_text(scoring.SW).alias(scoring.SW),
                    "sku_org_cate", "search_count")


@register("encode_neighbours", with_(A.SQL_BRAND_VECTORS, SQL_SIM) + f"""
  SELECT id AS cid3, string_agg(neighbour || ':' || {sql_dec6_text('score')}, ',' ORDER BY rank) AS score_top200
  FROM bu_topk GROUP BY id""")
def q_encode_neighbours(spark, d):
    """Lists as they are written hold whole doubles, which two engines may
    differ on in the last digit: scores go in at six places here."""
    t = similarity.cosine_topk(A.brand_vectors(spark, d), k=A.SIM_TOPK).withColumnRenamed("id", "cid3")
    return io.encode_neighbours(t.withColumn("score", dec6_text("score")), as_text=True)


@register("decode_neighbours", with_(A.SQL_BRAND_VECTORS, SQL_SIM)
          + f" SELECT cid3, neighbour, {s6('score')} AS score FROM sim")
def q_decode_neighbours(spark, d):
    t = similarity.cosine_topk(A.brand_vectors(spark, d), k=A.SIM_TOPK).withColumnRenamed("id", "cid3")
    return io.decode_neighbours(io.encode_neighbours(t)).select("cid3", "neighbour", r6("score").alias("score"))


@register("category_similarity_table", with_(A.SQL_BRAND_VECTORS, SQL_SIM)
          + f" SELECT cid3, neighbour, {s6('score')} AS score FROM sim")
def q_category_similarity_table(spark, d):
    """The similarity job from text to text: names and vectors are written as
    files and read back (S3, S5), ranked (C3), written as lists (S9) and
    decoded from the table (S6)."""
    from qsig.plans import jobs

    vectors, names = A.vector_files(spark, d)
    path = _table_dir(spark, "cid-score")
    jobs.category_similarity_job(spark, vectors, names, path, k=A.SIM_TOPK)
    rows = io.read_tsv_partition(spark, path, jobs.CID_SCORE, dt="active")
    return io.decode_neighbours(rows).select("cid3", "neighbour", r6("score").alias("score"))


# ==================================================================== K: Lloyd

from qsig.functions.hashing import sql_uniform  # noqa: E402
from qsig.operators import kmeans, mlkmeans  # noqa: E402

K_CLUSTERS = 8
K_SEED = 11
K_TOL = 0.01
K_ORACLE_STEPS = 24       # steps written out in the SQL; it gives no rows if they are too few


def _pts(spark, d):
    return A.query_points(spark, d)


def _init(spark, d):
    return kmeans.init_in_bounds(_pts(spark, d), K_CLUSTERS, K_SEED)


def _vec_text(c) -> Column:
    return F.array_join(F.transform(c, lambda x: dec6_text(x)), " ")


def _sql_vec_text(c: str) -> str:
    return f"array_to_string(list_transform({c}, lambda x: {sql_dec6_text('x')}), ' ')"


SQL_K_INIT = f"""
  kb AS (SELECT pos, min(x) AS lo, max(x) AS hi
         FROM (SELECT unnest(range(0, len(feature))) AS pos, unnest(feature) AS x FROM pts) GROUP BY pos),
  c0 AS (SELECT CAST(c AS INTEGER) AS category,
                list(lo + {sql_uniform(['c', 'pos'], K_SEED)} * (hi - lo) ORDER BY pos) AS centroid
         FROM range(0, {K_CLUSTERS}) r(c), kb GROUP BY c)"""


def sql_assign(c: str, out: str) -> str:
    return f"""
  {out} AS (SELECT query, feature, category FROM (
      SELECT p.query, p.feature, c.category,
             row_number() OVER (PARTITION BY p.query
                                ORDER BY list_distance(p.feature, c.centroid), c.category) AS rn
      FROM pts p, {c} c) WHERE rn = 1)"""


def sql_update(a: str, c: str, out: str) -> str:
    return f"""
  {out}_m AS (SELECT category, pos, avg(x) AS x
              FROM (SELECT category, unnest(range(0, len(feature))) AS pos, unnest(feature) AS x FROM {a})
              GROUP BY category, pos),
  {out}_n AS (SELECT category, list(x ORDER BY pos) AS new FROM {out}_m GROUP BY category),
  {out} AS (SELECT c.category, coalesce(n.new, c.centroid) AS centroid
            FROM {c} c LEFT JOIN {out}_n n USING (category))"""


def sql_shift(old: str, new: str) -> str:
    return (f"(SELECT avg(list_distance(o.centroid, n.centroid)) FROM {old} o "
            f"JOIN {new} n USING (category))")


@register("kmeans_init", with_(A.SQL_QUERY_POINTS, SQL_K_INIT) + f"""
  SELECT category, unnest(range(0, len(centroid))) AS pos, {s6('unnest(centroid)')} AS x FROM c0""")
def q_kmeans_init(spark, d):
    c = _init(spark, d)
    return c.select("category", F.posexplode("centroid").alias("pos", "x")).select(
        "category", F.col("pos").cast("bigint").alias("pos"), r6("x").alias("x"))


@register("kmeans_assign", with_(A.SQL_QUERY_POINTS, SQL_K_INIT, sql_assign("c0", "a1"))
          + " SELECT query, category FROM a1")
def q_kmeans_assign(spark, d):
    return kmeans.assign(_pts(spark, d), _init(spark, d)).select("query", "category")


@register("kmeans_update", with_(A.SQL_QUERY_POINTS, SQL_K_INIT, sql_assign("c0", "a1"),
                                 sql_update("a1", "c0", "c1")) + f"""
  SELECT category, unnest(range(0, len(centroid))) AS pos, {s6('unnest(centroid)')} AS x FROM c1""")
def q_kmeans_update(spark, d):
    pts, init = _pts(spark, d), _init(spark, d)
    new = kmeans.update(kmeans.assign(pts, init), init)
    return new.select("category", F.posexplode("centroid").alias("pos", "x")).select(
        "category", F.col("pos").cast("bigint").alias("pos"), r6("x").alias("x"))


@register("kmeans_shift", with_(A.SQL_QUERY_POINTS, SQL_K_INIT, sql_assign("c0", "a1"),
                                sql_update("a1", "c0", "c1")) + f"""
  SELECT category, {s6('list_distance(c0.centroid, c1.centroid)')} AS shift
  FROM c0 JOIN c1 USING (category)""")
def q_kmeans_shift(spark, d):
    pts, init = _pts(spark, d), _init(spark, d)
    new = kmeans.update(kmeans.assign(pts, init), init)
    return kmeans.shift(init, new).select("category", r6("shift").alias("shift"))


def _sql_lloyd() -> str:
    ctes = [A.SQL_QUERY_POINTS, SQL_K_INIT]
    pick, res = [], []
    for i in range(1, K_ORACLE_STEPS + 1):
        ctes += [sql_assign(f"c{i - 1}", f"a{i}").replace(f" a{i} AS (", f" a{i} AS MATERIALIZED ("),
                 sql_update(f"a{i}", f"c{i - 1}", f"c{i}").replace(f"  c{i} AS (", f"  c{i} AS MATERIALIZED (")]
        pick.append(f"WHEN {sql_shift(f'c{i - 1}', f'c{i}')} < {K_TOL} THEN {i}")
        res.append(f"SELECT {i} AS step, a.category, a.query, c.centroid FROM a{i} a JOIN c{i} c USING (category)")
    ctes.append(f"\n  pick AS (SELECT CASE {' '.join(pick)} END AS step),\n  res AS ({' UNION ALL '.join(res)})")
    return (with_(*ctes) + f""" SELECT category, query, {_sql_vec_text('centroid')} AS cate_feature
           FROM res WHERE step = (SELECT step FROM pick)""")


@register("kmeans_lloyd", _sql_lloyd())
def q_kmeans_lloyd(spark, d):
    out = kmeans.lloyd(_pts(spark, d), K_CLUSTERS, init=_init(spark, d), tol=K_TOL)
    return out.select("category", "query", _vec_text("cate_feature").alias("cate_feature"))


# ======================================================= M: library k-means

ML_K = 10
ML_SEED = 1


def _ml_input(spark, d):
    return mlkmeans.features(A.word_vectors(spark, d))


SQL_WORD_VECTORS = """
  wv AS (SELECT CAST(vec_id AS VARCHAR) AS word,
                array_to_string(list_transform(embedding,
                    lambda x: CAST(CAST(floor(CAST(x AS DOUBLE) * 1000000.0) AS BIGINT) AS VARCHAR)), ' ') AS emb
         FROM embeddings),
  pv_ AS (SELECT word, list_transform(string_split_regex(trim(emb), '\\s+'), lambda t: TRY_CAST(t AS DOUBLE)) AS v
          FROM wv)"""


@register("ml_features", with_(SQL_WORD_VECTORS) + " SELECT word, array_to_string(list_transform(v, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), ' ') AS features FROM pv_")
def q_ml_features(spark, d):
    from pyspark.ml.functions import vector_to_array

    f = _ml_input(spark, d)
    whole = F.transform(vector_to_array("features"), lambda x: x.cast("bigint").cast("string"))
    return f.select("word", F.array_join(whole, " ").alias("features"))


def _ml_model(spark, d):
    f = io.stage(_ml_input(spark, d), "ml-points")
    return f, mlkmeans.fit(f, k=ML_K, seed=ML_SEED)


@register("ml_kmeans_assign", with_(SQL_WORD_VECTORS)
          + " SELECT word, true AS in_range, true AS nearest FROM pv_")
def q_ml_kmeans_assign(spark, d):
    """Every word once, its cluster one of the k, and no centre nearer than
    its own (the library's iteration itself is not SQL)."""
    f, model = _ml_model(spark, d)
    table = F.array(*[F.array(*[F.lit(x) for x in r.axis]) for r in mlkmeans.centers(model, spark).orderBy("cluster_id").collect()])
    far = F.transform(table, lambda m: F.aggregate(F.zip_with(m, F.col("emb"), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x))
    near = mlkmeans.predict(model, f).select("word", F.col("cluster_id").alias("c"), far.alias("d")).select(
        "word", F.col("c").between(0, ML_K - 1).alias("in_range"),
        (F.get("d", F.col("c")) <= F.array_min("d") * (1 + 1e-5) + 1e-5).alias("nearest"))      # centres are floats
    return near


@register("ml_kmeans_centers", with_(SQL_WORD_VECTORS) + f"""
  SELECT CAST(c AS INTEGER) AS category, (SELECT max(len(v)) FROM pv_) AS dims, true AS inside FROM range(0, {ML_K}) r(c)""")
def q_ml_kmeans_centers(spark, d):
    """One row per centre: its id, its length, and whether it lies within the
    bounds of the points."""
    from pyspark.ml.functions import vector_to_array

    f, model = _ml_model(spark, d)
    box = f.select(F.posexplode(vector_to_array("features")).alias("p", "x")).groupBy("p").agg(
        F.min("x").alias("lo"), F.max("x").alias("hi"))
    centres = mlkmeans.centers(model, spark).select(F.col("cluster_id").alias("category"), F.col("axis").alias("c"))
    return (centres.select("category", F.posexplode("c").alias("p", "x")).join(box, "p").groupBy("category")
            .agg(F.count(F.lit(1)).alias("dims"), F.min(F.col("x").between(F.col("lo") - 1, F.col("hi") + 1)).alias("inside")))


# ============================================================ A: augmentation

from qsig.functions.hashing import sql_draw_int as _sdi  # noqa: E402
from qsig.operators import augment  # noqa: E402

AUG_SEED = 5
WL_SQL = ", ".join(f"'{c}'" for c in A.WHITELIST)
SQL_BANDS = ", ".join(f"({b}, {augment.EDGES[b]}, {augment.EDGES[b + 1]})" for b in range(len(augment.EDGES) - 1))
_PARTS = ["cid3", "cid3_name", "draw", "band"]

SQL_AUG = f"""
  wl AS (SELECT * FROM ranked WHERE cid3 IN ({WL_SQL})),
  lists AS (SELECT cid3, cid3_name, list(term ORDER BY rank) AS terms, list(tfidf ORDER BY rank) AS tfidfs
            FROM ranked WHERE rank <= {augment.TOP_N} GROUP BY cid3, cid3_name),
  bands AS (SELECT * FROM (VALUES {SQL_BANDS}) v(band, lo, hi)),
  dr AS (SELECT l.cid3, l.cid3_name, r.i AS draw, b.band, b.lo, least(b.hi, len(l.terms)) - b.lo AS sz,
                l.terms, l.tfidfs
         FROM lists l, range(0, {augment.N_DRAWS}) r(i), bands b WHERE b.lo < len(l.terms)),
  du AS (SELECT cid3, cid3_name, draw, band, lo + {_sdi('sz', _PARTS, AUG_SEED)} AS pos, terms FROM dr),
  wt AS (SELECT dr.*, {sql_uniform(_PARTS, AUG_SEED)} AS u,
                list_sum(list_transform(tfidfs[lo + 1:lo + sz], lambda v: coalesce(v, 0.0))) AS tot FROM dr),
  dw AS (SELECT cid3, cid3_name, draw, band, terms,
                CASE WHEN tot > 0 THEN lo + len(list_filter(
                       list_transform(range(1, sz + 1),
                                      lambda j: list_sum(list_transform(tfidfs[lo + 1:lo + j], lambda v: coalesce(v, 0.0))) / tot),
                       lambda c: c <= u))
                     ELSE lo + {_sdi('sz', _PARTS, AUG_SEED)} END AS pos FROM wt),
  tl AS (SELECT cid3, cid3_name, draw, list(terms[pos + 1] ORDER BY band) AS t FROM du GROUP BY ALL),
  tpl AS (SELECT cid3, cid3_name, draw, unnest([0, 1, 2]) AS tpl,
                 unnest([array_to_string(t, ''),
                         t[1] || array_to_string(t[len(t) // 2 + 1:len(t) - 1], ''),
                         array_to_string(t[1:len(t) // 2 + 1], '')]) AS keyword FROM tl),
  tlw AS (SELECT cid3, cid3_name, draw, list(terms[pos + 1] ORDER BY band) AS t FROM dw GROUP BY ALL),
  tplw AS (SELECT cid3, cid3_name, draw, unnest([0, 1, 2]) AS tpl,
                  unnest([array_to_string(t, ''),
                          t[1] || array_to_string(t[len(t) // 2 + 1:len(t) - 1], ''),
                          array_to_string(t[1:len(t) // 2 + 1], '')]) AS keyword FROM tlw)"""

SQL_AUG_ALL = with_(A.SQL_CATEGORY_TERMS, SQL_TF, SQL_TFIDF, SQL_RANKED, SQL_AUG)


def _ranked(spark, d, limit=augment.TOP_N):
    """Ranked terms of all categories."""
    return terms.tfidf_ranked(_terms(spark, d), limit=limit)


def _whitelist(spark):
    """The whitelist as the job gets it: read from a text file."""
    return io.read_whitelist(spark, A.whitelist_file(spark))


def _lists(spark, d):
    return augment.term_lists(_ranked(spark, d))


@register("whitelisted_terms", SQL_AUG_ALL
          + f" SELECT cid3, cid3_name, term, {s6('tfidf')} AS tfidf, rank FROM wl")
def q_whitelisted_terms(spark, d):
    w = augment.in_categories(_ranked(spark, d, limit=None), _whitelist(spark))
    return w.select("cid3", "cid3_name", "term", r6("tfidf").alias("tfidf"), "rank")


@register("term_lists", SQL_AUG_ALL
          + " SELECT cid3, cid3_name, array_to_string(terms, ',') AS terms, len(terms) AS n FROM lists")
def q_term_lists(spark, d):
    lst = _lists(spark, d)
    return lst.select("cid3", "cid3_name", F.array_join("terms", ",").alias("terms"),
                      F.size("terms").cast("bigint").alias("n"))


@register("term_bands", SQL_AUG_ALL + """
  SELECT cid3, cid3_name, CAST(p.pos AS BIGINT) AS pos, terms[p.pos + 1] AS term, b.band
  FROM lists, range(0, len(terms)) p(pos), bands b WHERE p.pos >= b.lo AND p.pos < b.hi""")
def q_term_bands(spark, d):
    b = augment.bands(_lists(spark, d))
    return b.select("cid3", "cid3_name", F.col("pos").cast("bigint").alias("pos"), "term", "band")


@register("augment_draws", SQL_AUG_ALL
          + " SELECT cid3, cid3_name, draw, band, pos, terms[pos + 1] AS term FROM du")
def q_augment_draws(spark, d):
    dr = augment.draws(_lists(spark, d), seed=AUG_SEED)
    return dr.select("cid3", "cid3_name", F.col("draw").cast("bigint").alias("draw"), "band",
                     F.col("pos").cast("bigint").alias("pos"), "term")


@register("augment_draws_weighted", SQL_AUG_ALL
          + " SELECT cid3, cid3_name, draw, band, pos, terms[pos + 1] AS term FROM dw")
def q_augment_draws_weighted(spark, d):
    dr = augment.draws(_lists(spark, d), seed=AUG_SEED, weighted=True)
    return dr.select("cid3", "cid3_name", F.col("draw").cast("bigint").alias("draw"), "band",
                     F.col("pos").cast("bigint").alias("pos"), "term")


@register("augment_templates", SQL_AUG_ALL + " SELECT cid3, cid3_name, draw, tpl, keyword FROM tpl")
def q_augment_templates(spark, d):
    t = augment.templates(augment.drawn_terms(_lists(spark, d), seed=AUG_SEED))
    return t.select("cid3", "cid3_name", F.col("draw").cast("bigint").alias("draw"),
                    F.col("tpl").cast("integer").alias("tpl"), "keyword")


@register("augment_templates_weighted", SQL_AUG_ALL + " SELECT cid3, cid3_name, draw, tpl, keyword FROM tplw")
def q_augment_templates_weighted(spark, d):
    """Templates over draws in proportion to tf-idf."""
    t = augment.templates(augment.drawn_terms(_lists(spark, d), seed=AUG_SEED, weighted=True))
    return t.select("cid3", "cid3_name", F.col("draw").cast("bigint").alias("draw"),
                    F.col("tpl").cast("integer").alias("tpl"), "keyword")


@register("augmented_corpus", SQL_AUG_ALL + f" SELECT keyword, cid3, cid3_name FROM tpl WHERE cid3 IN ({WL_SQL})")
def q_augmented_corpus(spark, d):
    return augment.corpus(_ranked(spark, d), _whitelist(spark), seed=AUG_SEED)


# ============================================================ S5: vector text

from qsig.functions.vectors import parse_vector  # noqa: E402

@register("parse_vectors", with_(SQL_WORD_VECTORS)
          + f" SELECT word, unnest(range(0, len(v))) AS pos, {s6('unnest(v)')} AS x FROM pv_")
def q_parse_vectors(spark, d):
    w = A.word_vectors(spark, d).select("word", parse_vector("emb").alias("v"))
    return w.select("word", F.posexplode("v").alias("pos", "x")).select(
        "word", F.col("pos").cast("bigint").alias("pos"), r6("x").alias("x"))


# ============================================ S1/S7/S8/S10: partitioned round trips

import uuid  # noqa: E402

from pyspark.sql import types as T  # noqa: E402

PAIRS_SCHEMA = T.StructType([T.StructField("query_1", T.StringType()), T.StructField("query_2", T.StringType()),
                             T.StructField("label", T.IntegerType())])
TRIPLES_SCHEMA = T.StructType([T.StructField("sku", T.StringType()), T.StructField("query", T.StringType())])


def _table_dir(spark, name):
    path = f"{io.staging_dir(spark)}/qsig-tables/{name}-{uuid.uuid4().hex}"
    io.drop_at_exit(spark, path)
    return path


@register("labelled_pairs_table", with_(A.SQL_GRAPH_PATH, SQL_NAMES)
          + " SELECT * FROM neg UNION ALL SELECT * FROM pos")
def q_labelled_pairs_table(spark, d):
    """The sample job's sink pattern: negatives overwrite (S7) the (dt, version)
    partition, positives are appended (S8), another partition is written
    beside it, and the partition is read back by name (S1, S10)."""
    path = _table_dir(spark, "pairs")
    gp = io.stage(_gp(spark, d), "graph-path")          # read by three samples
    io.overwrite_partition(samples.positive_pairs(gp, "ord"), path, PAIRS_SCHEMA, dt="2020-05-24", version="v")
    io.overwrite_partition(samples.negative_pairs(gp, K_NEG, SEED), path, PAIRS_SCHEMA, dt="2020-05-25", version="v")
    io.append_partition(samples.positive_pairs(gp, "ord"), path, PAIRS_SCHEMA, dt="2020-05-25", version="v")
    return io.read_partition(spark, path, PAIRS_SCHEMA, "orc", dt="2020-05-25", version="v").select(
        "query_1", "query_2", "label")


CLICK_SCHEMA = T.StructType([T.StructField("sku", T.StringType()), T.StructField("key_word", T.StringType()),
                             T.StructField("dim_type", T.StringType())])


@register("scan_since_table", with_(A.SQL_CLICK_LOG) + f"""
  SELECT sku, key_word, dim_type, dt FROM (SELECT * REPLACE (substr(dt, 1, 7) || '-01' AS dt) FROM click) WHERE dt > '{CUTOFF}'""")
def q_scan_since_table(spark, d):
    """S2 on a table partitioned by dt (first days of months): the predicate
    prunes its folders."""
    path = _table_dir(spark, "clicks")
    clicks = A.click_log(spark, d).withColumn("dt", F.concat(F.substring("dt", 1, 7), F.lit("-01")))
    clicks.repartition("dt").write.partitionBy("dt").format("orc").save(path)
    return io.read_since(spark, path, CLICK_SCHEMA, A.CLICK_DT, A.CLICK_LOOKBACK).select("sku", "key_word", "dim_type", "dt")


@register("keyword_triples_table", with_(A.SQL_CLICK_LOG, SQL_PV) + """
  SELECT sku, unnest(CASE WHEN len(ks) > 2
                          THEN list_transform(range(1, len(ks) - 1), lambda i: array_to_string(ks[i:i + 2], ' '))
                          ELSE [array_to_string(ks, ' ')] END) AS query
  FROM kl""")
def q_keyword_triples_table(spark, d):
    """Keyword triples written twice to the same dt partition (idempotent
    overwrite, S7) and read back (S1)."""
    path = _table_dir(spark, "triples")
    for _ in range(2):
        io.overwrite_partition(q_keyword_triples(spark, d), path, TRIPLES_SCHEMA, dt=A.CLICK_DT)
    return io.read_partition(spark, path, TRIPLES_SCHEMA, "orc", dt=A.CLICK_DT).select("sku", "query")


@register("ml_silhouette", f"SELECT CAST({ML_K} AS INTEGER) AS k, true AS in_range, true AS better_than_shuffled")
def q_ml_silhouette(spark, d):
    """M5: the silhouette of the library clustering lies in [-1, 1] and above
    that of the same clusters dealt to the words anew by hash."""
    f, model = _ml_model(spark, d)
    got = model.transform(f).persist()
    value = float(mlkmeans.silhouette(got))
    dealt = float(mlkmeans.silhouette(got.withColumn("prediction", F.pmod(F.xxhash64("word"), F.lit(ML_K)).cast("int"))))
    return spark.createDataFrame([(ML_K, -1 <= value <= 1, value > dealt)], "k int, in_range boolean, better_than_shuffled boolean")
