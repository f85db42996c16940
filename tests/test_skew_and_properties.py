"""Skew paths of real operators and randomized properties of array operators."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from qsig.operators import augment, pairs, samples, terms


def test_two_level_path_in_operators(spark):
    docs = [(f"c{i % 2}", f"n{i % 3}", ",".join(f"w{(i * j) % 17}" for j in range(1, 12))) for i in range(60)]
    df = spark.createDataFrame(docs, "cid3 string, cid3_name string, sku_term string")
    scored = terms.tfidf(terms.explode_terms(df)).withColumn("extra", F.lit("payload"))
    order = [F.col("tfidf").desc_nulls_last(), F.col("term").asc(), F.col("cid3_name").asc()]
    one = scored.withColumn("rank", F.row_number().over(Window.partitionBy("cid3").orderBy(*order)).cast("bigint"))
    assert sorted(map(tuple, terms.rank_terms(scored).collect())) == sorted(map(tuple, one.collect()))
    path = spark.createDataFrame([("p", f"n{i}", i) for i in range(300)] + [("q", "a", 1), ("q", "b", 2)],
                                 "pathid string, name string, ord int")
    got = samples.positive_pairs(path, "ord").collect()
    assert len(got) == 300 and ("n7", "n8") in {(r.query_1, r.query_2) for r in got}


def _hot_rows(spark):
    return spark.range(0, 300_000, 1, 12).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 2000).cast("string")).alias("query"),
        F.col("id").cast("string").alias("sku"), (F.col("id") % 1009).cast("double").alias("score"))


def test_hot_query_is_split(spark):
    """One query with a third of the rows: the join with a group table deals
    its rows over all tasks by salts."""
    from qsig.operators import features, skew

    df = _hot_rows(spark)
    sizes = features.group_sizes(df)
    joined = skew.join_groups(df, sizes, ["query"], "num")
    assert joined.count() == 300_000
    assert joined.where("query = 'hot'").select("num").distinct().collect()[0][0] == 100_000
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions",
                                          "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        for k, v in zip(old, ("-1", "8", "false")):
            spark.conf.set(k, v)
        tasks = [r[1] for r in skew.join_groups(df, sizes, ["query"], "num")
                 .groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert len(tasks) == 8 and max(tasks) <= 2 * 300_000 / 8
    kept = features.size_filter(df)
    assert kept.where("query = 'hot'").count() == 0 and kept.count() == 200_000
    z = features.zscore(df).where("query = 'hot'").agg(F.avg("z"), F.stddev_pop("z")).first()
    assert abs(z[0]) < 1e-9 and abs(z[1] - 1) < 1e-9
    every = features.collect_scores(df)
    assert every.count() == 300_000 and every.where("query = 'hot'").count() == 100_000


def test_features_scan_their_input_once(spark, scratch):
    """Besides the count of group sizes, which is staged, the input is scanned
    once, and rows of a hot query whose size is out of range are dropped
    before the shuffle."""
    from qsig.operators import features

    _hot_rows(spark).write.parquet(f"{scratch}/scores")
    df = spark.read.parquet(f"{scratch}/scores")
    for f in (features.collect_scores, features.size_filter, features.zscore, features.fractiles,
              features.score_map_long, features.score_map, features.query_features):
        plan = f(df)._jdf.queryExecution().executedPlan().toString()
        assert plan.count(f"{scratch}/scores") == 1, (f.__name__, plan)
        assert "Cartesian" not in plan and "NestedLoop" not in plan
    size = features.size_filter(df)._jdf.queryExecution().executedPlan().toString()
    assert "coalesce(__h_kept" in size


def test_join_groups_matches_null_groups_and_repeats(spark):
    from qsig.operators import skew

    rows = spark.createDataFrame([(None, 1, 5), (None, 1, 5), ("a", 2, 6), ("b", 3, 7)], "k string, v int, n int")
    old = skew.HOT_FLOOR
    try:
        skew.HOT_FLOOR = 1                              # every repeated key is hot
        groups = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
        got = skew.join_groups(rows, groups, ["k"], "n")
        assert got.columns == ["k", "v", "n"]
        assert sorted(map(tuple, got.collect()), key=repr) == sorted([(None, 1, 2)] * 2 + [("a", 2, 1), ("b", 3, 1)], key=repr)
        one = skew.join_groups(rows, groups, ["k"], "n", F.col("n") < 2)
        assert sorted(r.k for r in one.collect()) == ["a", "b"]
    finally:
        skew.HOT_FLOOR = old
    assert skew.join_groups(rows.limit(0), groups.limit(0), ["k"], "n").count() == 0


def test_score_map_form(spark):
    """F5 as a map holds the long form's values, for sizes in range only."""
    from qsig.operators import features

    rows = [("q", f"s{i % 15}", float(i)) for i in range(30)] + [("q", "none", None)] + [("small", "s", 1.0)]
    df = spark.createDataFrame(rows, "query string, sku string, score double")
    got = {r["query"]: r.sku_score_normal for r in features.score_map(df).collect()}
    want = {r.sku: r.z for r in features.score_map_long(df).where("query = 'q'").collect()}
    assert got == {"q": want} and len(want) == 15


def _windows_py(ks, size=3):
    if len(ks) > size - 1:
        return [" ".join(ks[i:i + size]) for i in range(len(ks) - size + 1)]
    return [" ".join(ks)]


def _templates_py(t):
    mid = len(t) // 2
    return ("".join(t), t[0] + "".join(t[mid:-1]), "".join(t[:mid + 1]))


def test_windows_and_templates_match_python(spark):
    rng = random.Random(11)
    lists = [[f"k{rng.randrange(30)}" for _ in range(rng.randint(1, 9))] for _ in range(80)]
    df = spark.createDataFrame([(str(i), ks) for i, ks in enumerate(lists)], "sku string, keywords array<string>")
    got = {}
    for r in pairs.keyword_windows(df).collect():
        got.setdefault(r.sku, []).append(r.query)
    for i, ks in enumerate(lists):
        assert sorted(got[str(i)]) == sorted(_windows_py(ks))
    short = [ks[:5] for ks in lists]
    tdf = spark.createDataFrame([(i, ks) for i, ks in enumerate(short)], "i int, t array<string>")
    for r in tdf.select("i", augment.template_array(F.col("t")).alias("k")).collect():
        assert tuple(r.k) == _templates_py(short[r.i])


def test_draws_stay_in_bands_and_are_reproducible(spark):
    rng = random.Random(5)
    rows = [(f"c{i}", "n", [f"t{j}" for j in range(n)], list(range(1, n + 1)),
             [rng.random() for _ in range(n)]) for i, n in enumerate([1, 4, 5, 19, 20, 49, 50, 120, 200])]
    lists = spark.createDataFrame(rows, "cid3 string, cid3_name string, terms array<string>, "
                                        "ranks array<int>, tfidfs array<double>")
    for weighted in (False, True):
        a = sorted(map(tuple, augment.draws(lists, n=40, seed=9, weighted=weighted).collect()))
        b = sorted(map(tuple, augment.draws(lists.repartition(3), n=40, seed=9, weighted=weighted).collect()))
        assert a == b
        sizes = {r[0]: len(r[2]) for r in rows}
        for cid3, _, draw, band, pos, term in a:
            lo, hi = augment.EDGES[band], min(augment.EDGES[band + 1], sizes[cid3])
            assert lo <= pos < hi and term == f"t{pos}"


def test_seeded_draws_agree_with_duckdb(spark):
    import duckdb

    from qsig.functions import hashing as H

    rng = random.Random(3)
    alphabet = "abcxyzéüß语#:, 0123456789"
    names = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 12))) for _ in range(300)]
    rows = [(s, i % 7) for i, s in enumerate(names)]
    df = spark.createDataFrame(rows, "name string, j int")
    got = {(r.name, r.j): (r.d, r.u) for r in df.select(
        "name", "j", H.draw_int(97, ["name", "j"], 11).alias("d"), H.uniform(["name", "j"], 11).alias("u")).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE t(name VARCHAR, j INTEGER)")
    con.executemany("INSERT INTO t VALUES (?, ?)", rows)
    sql = (f"SELECT name, j, {H.sql_draw_int('97', ['name', 'j'], 11)} AS d, "
           f"{H.sql_uniform(['name', 'j'], 11)} AS u FROM t")
    for name, j, d, u in con.sql(sql).fetchall():
        assert got[(name, j)] == (d, u)
        assert 0 <= d < 97 and 0.0 <= u < 1.0
