"""Library k-means through ``pyspark.ml`` (M1-M5).

The reference splits a 100-number string into 100 columns and assembles
them with ``VectorAssembler``.  Here the string is parsed straight into an
``array<double>`` and converted with ``array_to_vector`` — one column, no
wide rows — and ``KMeans`` (k-means‖ init, iterations in the JVM) does the
rest.  Cluster centers are k×d and held by the model, as in Spark ML.
"""

from __future__ import annotations

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qsig.functions.vectors import parse_vector
from qsig.fixed import LIBRARY_K, LIBRARY_SEED


def features(df: DataFrame, col: str = "emb", out: str = "features", check: bool = True) -> DataFrame:
    """M1: parse the blank-separated vector text into an ML vector column.

    Rows whose text is null/blank or holds a non-number are dropped; with
    ``check`` mixed vector lengths raise (the reference fails on anything
    but exactly its configured length)."""
    arr = parse_vector(col)
    parsed = df.withColumn("__v", arr).where(
        F.col("__v").isNotNull() & F.forall("__v", lambda x: x.isNotNull()))
    if check:
        lens = parsed.agg(F.min(F.size("__v")).alias("a"), F.max(F.size("__v")).alias("b")).first()
        if lens["a"] is not None and lens["a"] != lens["b"]:
            raise ValueError(f"vectors of different lengths ({lens['a']}..{lens['b']})")
    return parsed.withColumn(out, array_to_vector("__v")).drop("__v")


def fit(df: DataFrame, k: int = LIBRARY_K, seed: int = LIBRARY_SEED, features_col: str = "features", **params) -> KMeansModel:
    """M2: ``KMeans`` with the library defaults (k-means‖, maxIter 20, tol 1e-4)."""
    return KMeans(featuresCol=features_col, k=k, seed=seed, **params).fit(df)


def predict(model: KMeansModel, df: DataFrame, word: str = "word", emb: str = "emb") -> DataFrame:
    """M3: (word, cluster_id, emb array<float>)."""
    pred = model.transform(df)
    return pred.select(word, F.col("prediction").cast("int").alias("cluster_id"),
                       F.transform(parse_vector(emb), lambda x: x.cast("float")).alias("emb"))


def centers(model: KMeansModel, spark: SparkSession) -> DataFrame:
    """M4: (cluster_id, axis array<float>) from the fitted model's k centers."""
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    return spark.createDataFrame(rows, "cluster_id int, axis array<double>").select(
        "cluster_id", F.transform("axis", lambda x: x.cast("float")).alias("axis"))


def silhouette(predictions: DataFrame, features_col: str = "features") -> float:
    """M5: silhouette with squared Euclidean distance."""
    return ClusteringEvaluator(featuresCol=features_col).evaluate(predictions)
