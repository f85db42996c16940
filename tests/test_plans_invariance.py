"""Plan-shape assertions and partition-count invariance."""

import pytest
from pyspark.sql import types as T

import __spark_entry__ as E
from qsig.sources import io

SF = "/root/testdata/sf0.001"
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonMapInArrow")
PYTHON_ALLOWED = {"cosine_topk", "encode_neighbours", "decode_neighbours", "query_sku_score", "scored_table",
                  "kmeans_assign", "kmeans_update", "kmeans_shift", "kmeans_lloyd", "category_similarity_table"}
SKIP = {"ml_features", "ml_kmeans_assign", "ml_kmeans_centers", "ml_silhouette"}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_cartesian_and_python_only_where_documented(spark):
    from qsig.plans.catalog import QUERIES

    for name, q in QUERIES.items():
        if name in SKIP:
            continue
        plan = _plan(q(spark, SF))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
        assert "BatchEvalPython" not in plan, name  # never a row-at-a-time UDF
        if name not in PYTHON_ALLOWED:
            assert not any(p in plan for p in PYTHON_NODES), name


def test_scan_prunes_columns(spark):
    plan = _plan(E.queries()["term_counts"](spark, SF))
    schemas = [s for s in plan.split("ReadSchema: ")[1:]]
    assert schemas and all("n_chars" not in s.split("\n")[0] for s in schemas)


def test_partition_pruning(spark, scratch):
    schema = T.StructType([T.StructField("sku", T.StringType()), T.StructField("key_word", T.StringType()),
                           T.StructField("dim_type", T.StringType())])
    df = spark.createDataFrame([("1", "k", "app")], schema)
    for dt in ("2020-01-01", "2020-02-01"):
        io.overwrite_partition(df, f"{scratch}/t", schema, dt=dt)
    plan = _plan(io.read_since(spark, f"{scratch}/t", schema, "2020-02-10", 30))
    assert "PartitionFilters: [isnotnull(dt" in plan and "2020-01-11" in plan


@pytest.mark.parametrize("name", ["tfidf_ranked", "keyword_triples", "labelled_pairs", "query_features",
                                  "cosine_topk", "query_sku_score", "kmeans_lloyd", "augmented_corpus"])
def test_same_result_for_1_and_64_shuffle_partitions(spark, name):
    q = E.queries()[name]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        results = []
        for n in ("1", "64"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            df = q(spark, SF)
            results.append(sorted(tuple(str(v) for v in r) for r in df.collect()))
        assert results[0] == results[1]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
