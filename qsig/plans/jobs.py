"""Composed jobs: source → operators → sink, one function per reference job.

Each job reads partitioned tables (S1/S2), runs the operators as one lazy
plan and writes exactly one partition (S7/S8/S9) with the declared output
schema (S10, by name).  Tables are directories; ``fmt`` is ``orc`` by
default as in the reference's tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qsig.operators import augment, features, kmeans, mlkmeans, pairs, samples, scoring, similarity, terms
from qsig.sources import io
from qsig import fixed as fx

S = T.StringType()

# ------------------------------------------------------------ declared schemas

TERM_SEGS = T.StructType([T.StructField("cid3", S), T.StructField("cid3_name", S), T.StructField("sku_term", S)])
TERM_TFIDF = T.StructType([T.StructField("cid3", S), T.StructField("cid3_name", S), T.StructField("term", S),
                           T.StructField("tfidf", T.FloatType()), T.StructField("rank", T.IntegerType())])
CLICK_LOG = T.StructType([T.StructField("sku", S), T.StructField("key_word", S), T.StructField("dim_type", S)])
SIMILAR_QUERY = T.StructType([T.StructField("sku", S), T.StructField("query", S)])
GRAPH_PATH = T.StructType([T.StructField("pathid", S), T.StructField("name", S)])
SAMPLE_PAIRS = T.StructType([T.StructField("query_1", S), T.StructField("query_2", S),
                             T.StructField("label", T.IntegerType())])
QUERY_SCORES = T.StructType([T.StructField("query", S), T.StructField("sku", S),
                             T.StructField("score", T.DoubleType())])
QUERY_FEATURE = T.StructType([T.StructField("query", S), T.StructField("num", T.IntegerType()),
                              T.StructField("sku_score_normal", T.MapType(S, T.FloatType()))]
                             + [T.StructField(c, T.FloatType()) for c in
                                ("quarter_n", "quarter", "half_n", "half", "three_quarters_n", "three_quarters")])
FRACTILE_20 = T.StructType([T.StructField("query", S), T.StructField("query_feature_20", T.ArrayType(T.FloatType()))])
KMEANS_QUERY = T.StructType([T.StructField("category", T.IntegerType()), T.StructField("query", S),
                             T.StructField("feature", T.ArrayType(T.FloatType())),
                             T.StructField("cate_feature", T.ArrayType(T.FloatType()))])
WORD_EMB = T.StructType([T.StructField("word", S), T.StructField("emb", S)])
WORD_CLUSTER = T.StructType([T.StructField("word", S), T.StructField("cluster_id", T.IntegerType()),
                             T.StructField("emb", T.ArrayType(T.FloatType()))])
CLUSTER_AXIS = T.StructType([T.StructField("cluster_id", T.IntegerType()),
                             T.StructField("axis", T.ArrayType(T.FloatType()))])
CID_SCORE = T.StructType([T.StructField("cid3", S), T.StructField("score_top200", S)])
QUERY_SKU_CATE = T.StructType([
    T.StructField("query", S), T.StructField("sku", S), T.StructField("sku_name", S),
    T.StructField("query_cate", T.ArrayType(S)), T.StructField("query_cate_weight", T.ArrayType(T.FloatType())),
    T.StructField("sku_cate", T.ArrayType(S)), T.StructField("sku_cate_weight", T.ArrayType(T.FloatType())),
    T.StructField("sku_org_cate", S), T.StructField("search_count", T.IntegerType())])
QUERY_SKU_SCORE = T.StructType(
    QUERY_SKU_CATE.fields[:3] + [T.StructField("query_sku_score", T.FloatType())] + QUERY_SKU_CATE.fields[3:])
AUGMENTED = T.StructType([T.StructField("keyword", S), T.StructField("cid3", S), T.StructField("cid3_name", S)])


# ------------------------------------------------------------------- jobs

def tfidf_job(spark: SparkSession, src: str, dst: str, dt: str, src_dt: str = "active", fmt: str = "orc") -> None:
    """Category term TF-IDF and rank → ``dst/dt=<dt>``."""
    with io.staging(spark):
        segs = io.read_partition(spark, src, TERM_SEGS, fmt, dt=src_dt)
        out = terms.tfidf_ranked(terms.explode_terms(segs, col="sku_term"))
        io.overwrite_partition(out, dst, TERM_TFIDF, fmt, dt=dt)


def keyword_triples_job(spark: SparkSession, src: str, dst: str, dt: str, lookback_days: int = fx.LOOKBACK_DAYS,
                        dim: str = fx.CLICK_DIM, n: int = fx.TOP_KEYWORDS, fmt: str = "orc") -> None:
    """Sliding keyword triples per sku from the last ``lookback_days`` of clicks."""
    with io.staging(spark):
        clicks = io.read_since(spark, src, CLICK_LOG, dt, lookback_days, fmt)
        io.overwrite_partition(pairs.keyword_triples(clicks, dim=dim, n=n), dst, SIMILAR_QUERY, fmt, dt=dt)


def sample_pairs_job(spark: SparkSession, src: str, dst: str, dt: str, version: str, k: int = fx.NEGATIVES_PER_NAME,
                     seed: int = 0, order_col: str | None = None, fmt: str = "orc") -> None:
    """Negatives (overwrite) then positives (append) into one (dt, version) partition."""
    with io.staging(spark):
        schema = GRAPH_PATH if order_col is None else T.StructType(
            GRAPH_PATH.fields + [T.StructField(order_col, T.IntegerType())])
        paths = io.read_partition(spark, src, schema, fmt, dt=dt, version=version)
        io.overwrite_partition(samples.negative_pairs(paths, k, seed), dst, SAMPLE_PAIRS, fmt, dt=dt, version=version)
        io.append_partition(samples.positive_pairs(paths, order_col), dst, SAMPLE_PAIRS, fmt, dt=dt, version=version)


def query_feature_job(spark: SparkSession, src: str, dst: str, src_dt: str, dt: str, dp: str,
                      lo: int = fx.MIN_GROUP, hi: int = fx.MAX_GROUP, fmt: str = "orc") -> None:
    """Per-query normalised score map and descending fractiles."""
    with io.staging(spark):
        rows = io.read_partition(spark, src, QUERY_SCORES, fmt, dt=src_dt)
        io.overwrite_partition(features.query_features(rows, lo, hi), dst, QUERY_FEATURE, fmt, dt=dt, dp=dp)


def kmeans_job(spark: SparkSession, src: str, dst: str, src_dt: str, src_dp: str, dt: str, dp: str,
               k: int, seed: int = 0, tol: float = fx.LLOYD_TOL, max_iter: int = 1000, fmt: str = "orc") -> None:
    """Lloyd k-means over 20-dim fractile features, uniform [0, 1) init."""
    with io.staging(spark):
        pts = io.read_partition(spark, src, FRACTILE_20, fmt, dt=src_dt, dp=src_dp).select(
            "query", F.transform("query_feature_20", lambda x: x.cast("double")).alias("feature"))
        dims = pts.select(F.max(F.size("feature"))).first()[0] or 0
        init = kmeans.init_uniform(spark, k, dims, seed)
        out = kmeans.lloyd(pts, k, init=init, tol=tol, max_iter=max_iter)
        io.overwrite_partition(out, dst, KMEANS_QUERY, fmt, dt=dt, dp=dp)


def ml_kmeans_job(spark: SparkSession, src: str, words_dst: str, centers_dst: str, src_dt: str, dt: str,
                  dp: str, k: int = fx.LIBRARY_K, seed: int = fx.LIBRARY_SEED, fmt: str = "orc") -> None:
    """Library k-means over embedding text; writes word clusters and centers."""
    with io.staging(spark):
        feats = mlkmeans.features(io.read_partition(spark, src, WORD_EMB, fmt, dt=src_dt)).persist()
        try:
            model = mlkmeans.fit(feats, k=k, seed=seed)
            io.overwrite_partition(mlkmeans.centers(model, spark), centers_dst, CLUSTER_AXIS, fmt, dt=dt, dp=dp)
            io.overwrite_partition(mlkmeans.predict(model, feats), words_dst, WORD_CLUSTER, fmt, dt=dt, dp=dp)
        finally:
            feats.unpersist()


def category_similarity_job(spark: SparkSession, vectors_path: str, names_path: str, dst: str,
                            k: int = fx.TOP_NEIGHBOURS, dt: str = "active") -> None:
    """Cosine top-k between category vectors, written as ``cid\\tc:s,...`` text.

    Row and neighbour labels both come from the names dictionary (D25); one
    line per category, also where two share a name.  A vector without a name
    raises."""
    with io.staging(spark):
        io.write_tsv_partition(category_similarity(spark, vectors_path, names_path, k), dst, dt=dt)


def category_similarity(spark: SparkSession, vectors_path: str, names_path: str, k: int) -> DataFrame:
    """(cid3, score_top200) per category of the two text sources."""
    names = io.stage(io.read_index_names(spark, names_path), "category-names")
    vecs = io.stage(io.read_vectors(spark, vectors_path), "category-vectors")
    lost = vecs.join(names, vecs["id"] == names["idx"], "left_anti").count()
    if lost:
        raise ValueError(f"{lost} vectors have no name in {names_path}")
    top = similarity.cosine_topk(vecs, k=k)
    nb = names.select(F.col("idx").alias("neighbour"), F.col("name").alias("nname"))
    lists = io.encode_neighbours(top.join(nb, "neighbour").select("id", F.col("nname").alias("neighbour"), "score", "rank"),
                                 key="id")
    return lists.join(names, lists["id"] == names["idx"]).select(F.col("name").alias("cid3"), "score_top200")


def query_sku_score_job(spark: SparkSession, src: str, sim_path: str, dst: str, src_dt: str, src_dp: str,
                        dt: str, dp: str, fmt: str = "orc") -> None:
    """Weighted query–sku category score with the neighbour-list table."""
    with io.staging(spark):
        rows = io.read_partition(spark, src, QUERY_SKU_CATE, fmt, dt=src_dt, dp=src_dp)
        sim = io.decode_neighbours(io.read_tsv_partition(spark, sim_path, CID_SCORE, dt="active"))
        io.overwrite_partition(scoring.scored_table(rows, sim), dst, QUERY_SKU_SCORE, fmt, dt=dt, dp=dp)


def augmentation_job(spark: SparkSession, src: str, whitelist_path: str, dst: str, src_dt: str = "active",
                     n: int = augment.N_DRAWS, seed: int = 0, weighted: bool = False, fmt: str = "orc") -> None:
    """Template keywords from the top-200 terms of whitelisted categories."""
    with io.staging(spark):
        ranked = io.read_partition(spark, src, TERM_TFIDF, fmt, dt=src_dt)
        out = augment.corpus(ranked, io.read_whitelist(spark, whitelist_path), n=n, seed=seed, weighted=weighted)
        io.overwrite_partition(out, dst, AUGMENTED, fmt, dt="active")

