from pyspark.sql import functions as F

from qsig.operators import pairs, samples


def test_keyword_windows_counts(spark):
    lists = spark.createDataFrame([("s1", ["a"]), ("s2", ["a", "b"]), ("s3", ["a", "b", "c"]),
                                   ("s5", ["a", "b", "c", "d", "e"])], "sku string, keywords array<string>")
    got = {}
    for r in pairs.keyword_windows(lists).collect():
        got.setdefault(r.sku, []).append(r.query)
    assert {k: len(v) for k, v in got.items()} == {"s1": 1, "s2": 1, "s3": 1, "s5": 3}
    assert sorted(got["s5"]) == ["a b c", "b c d", "c d e"] and got["s2"] == ["a b"]


def test_keyword_pv_filters(spark):
    rows = [("1", "k", "app", "2020-05-02"), ("1", "  ", "app", "2020-05-02"), ("1", None, "app", "2020-05-02"),
            ("1", "k", "web", "2020-05-02"), ("1", "k", "app", "2020-05-01"), ("1", "k ", "app", "2020-06-01")]
    df = spark.createDataFrame(rows, "sku string, key_word string, dim_type string, dt string")
    got = sorted(tuple(r) for r in pairs.keyword_pv(df, "app", "2020-05-31", 30).collect())
    assert got == [("1", "k", 1), ("1", "k ", 1)]


def test_top_keywords_order_and_cap(spark):
    rows = [("s", f"w{i:02d}") for i in range(60) for _ in range(1 + i % 4)]
    df = spark.createDataFrame(rows, "sku string, key_word string").withColumn("dim_type", F.lit("app"))
    top = pairs.top_keywords(pairs.keyword_pv(df, "app"), 50)
    assert top.count() == 50
    kl = pairs.keyword_list(top).first().keywords
    assert kl[:3] == ["w03", "w07", "w11"]  # pv 4, ties by keyword


def _paths(spark, rows):
    return spark.createDataFrame(rows, "pathid string, name string, ord int")


def test_negative_pairs_k_per_name(spark):
    df = _paths(spark, [("p", "a", 1), ("p", "b", 2), ("q", "c", 1), ("q", None, 2), ("q", "", 3)])
    neg = samples.negative_pairs(df, k=5, seed=3).collect()
    assert len(neg) == 15
    assert {r.query_2 for r in neg} <= {"a", "b", "c"} and {r.label for r in neg} == {0}
    per = {}
    for r in neg:
        per[r.query_1] = per.get(r.query_1, 0) + 1
    assert per == {"a": 5, "b": 5, "c": 5}
    # seeded: same result for a different partitioning
    again = samples.negative_pairs(df.repartition(3), k=5, seed=3).collect()
    assert sorted(map(tuple, neg)) == sorted(map(tuple, again))


def test_dense_index_is_a_bijection(spark):
    df = spark.range(3000).select((F.col("id") % 1000).cast("string").alias("name"))
    idx = samples.dense_index(df).collect()
    assert sorted(r.idx for r in idx) == list(range(1000)) and len({r.name for r in idx}) == 1000


def test_positive_pairs_edges(spark):
    df = _paths(spark, [("one", "a", 1),
                        ("two", "a", 1), ("two", "b", 2),
                        ("four", "d", 4), ("four", "a", 1), ("four", "c", 3), ("four", "b", 2), ("four", "a", 5)])
    got = sorted((r.query_1, r.query_2) for r in samples.positive_pairs(df, order_col="ord").collect())
    assert got == [("a", "b"), ("a", "b"), ("b", "c"), ("c", "d")]
    lst = sorted((r.pos, r.name) for r in samples.path_list(df, order_col="ord").collect() if r.pathid == "four")
    assert lst == [(1, "a"), (2, "b"), (3, "c"), (4, "d")]
    # without an order column names are taken alphabetically
    assert samples.positive_pairs(_paths(spark, [("x", "b", 1), ("x", "a", 2)])).first()[:2] == ("a", "b")


def test_labelled_pairs_union(spark):
    df = _paths(spark, [("p", "a", 1), ("p", "b", 2)])
    lab = samples.labelled_pairs(df, k=2, seed=1, order_col="ord").collect()
    assert sum(r.label == 0 for r in lab) == 4 and sum(r.label == 1 for r in lab) == 1
