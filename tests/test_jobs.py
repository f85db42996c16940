from pyspark.sql import functions as F
from pyspark.sql import types as T

from qsig.plans import adapters as A
from qsig.plans import jobs
from qsig.sources import io

SF = "/root/testdata/sf0.001"


def test_tfidf_then_augmentation(spark, scratch):
    segs = A.category_terms(spark, SF).select("cid3", "cid3_name", F.array_join("terms", ",").alias("sku_term"))
    io.overwrite_partition(segs, f"{scratch}/segs", jobs.TERM_SEGS, dt="active")
    jobs.tfidf_job(spark, f"{scratch}/segs", f"{scratch}/tfidf", dt="active")
    out = io.read_partition(spark, f"{scratch}/tfidf", jobs.TERM_TFIDF, dt="active")
    assert out.count() > 0 and dict(out.dtypes)["tfidf"] == "float"
    with open(f"{scratch}/wl.txt", "w") as f:
        f.write("src1\tx\nsrc2\n")
    jobs.augmentation_job(spark, f"{scratch}/tfidf", f"{scratch}/wl.txt", f"{scratch}/aug", n=10, seed=1)
    aug = io.read_partition(spark, f"{scratch}/aug", jobs.AUGMENTED, dt="active")
    groups = out.where(F.col("cid3").isin("src1", "src2") & (F.col("rank") <= 200)).select("cid3", "cid3_name").distinct().count()
    assert aug.count() == 3 * 10 * groups


def test_pairs_and_samples_jobs(spark, scratch):
    clicks = A.click_log(spark, SF).withColumn("dim_type", F.when(F.col("dim_type") == "A", "app").otherwise("x"))
    for dt in ["1996-01-01", "1996-01-15"]:
        io.overwrite_partition(clicks.where(F.col("dt") <= dt).drop("dt"), f"{scratch}/clicks", jobs.CLICK_LOG, dt=dt)
    jobs.keyword_triples_job(spark, f"{scratch}/clicks", f"{scratch}/triples", dt="1996-01-20")
    assert io.read_partition(spark, f"{scratch}/triples", jobs.SIMILAR_QUERY, dt="1996-01-20").count() > 0
    paths = A.graph_path(spark, SF)
    schema = T.StructType(jobs.GRAPH_PATH.fields + [T.StructField("ord", T.IntegerType())])
    io.overwrite_partition(paths, f"{scratch}/paths", schema, dt="d", version="v")
    jobs.sample_pairs_job(spark, f"{scratch}/paths", f"{scratch}/pairs", "d", "v", k=5, seed=2, order_col="ord")
    lab = io.read_partition(spark, f"{scratch}/pairs", jobs.SAMPLE_PAIRS, dt="d", version="v")
    n_names = paths.select("name").distinct().count()
    assert lab.where("label = 0").count() == 5 * n_names and lab.where("label = 1").count() > 0


def test_feature_kmeans_similarity_scoring_jobs(spark, scratch):
    io.overwrite_partition(A.query_scores(spark, SF), f"{scratch}/qs", jobs.QUERY_SCORES, dt="x")
    jobs.query_feature_job(spark, f"{scratch}/qs", f"{scratch}/qf", "x", "d", "v1", lo=3)
    qf = io.read_partition(spark, f"{scratch}/qf", jobs.QUERY_FEATURE, dt="d", dp="v1")
    assert qf.count() > 0 and dict(qf.dtypes)["sku_score_normal"] == "map<string,float>"

    pts = A.query_points(spark, SF).withColumnRenamed("feature", "query_feature_20")
    io.overwrite_partition(pts, f"{scratch}/f20", jobs.FRACTILE_20, dt="a", dp="b")
    jobs.kmeans_job(spark, f"{scratch}/f20", f"{scratch}/km", "a", "b", "d", "p", k=4, seed=1)
    km = io.read_partition(spark, f"{scratch}/km", jobs.KMEANS_QUERY, dt="d", dp="p")
    assert km.count() == pts.count()

    io.overwrite_partition(A.word_vectors(spark, SF), f"{scratch}/emb", jobs.WORD_EMB, dt="e")
    jobs.ml_kmeans_job(spark, f"{scratch}/emb", f"{scratch}/words", f"{scratch}/centers", "e", "d", "p", k=5)
    assert io.read_partition(spark, f"{scratch}/centers", jobs.CLUSTER_AXIS, dt="d", dp="p").count() == 5

    brands = A.brand_vectors(spark, SF).orderBy("id").collect()
    with open(f"{scratch}/names.txt", "w") as f:
        f.writelines(f"{i + 1}\t{r.id}\n" for i, r in enumerate(brands))
    with open(f"{scratch}/vec.txt", "w") as f:
        f.writelines(" ".join(str(x) for x in r.vec) + "\n" for r in brands)
    jobs.category_similarity_job(spark, f"{scratch}/vec.txt", f"{scratch}/names.txt", f"{scratch}/sim", k=10)
    sim = io.read_tsv_partition(spark, f"{scratch}/sim", jobs.CID_SCORE)
    assert sim.count() == len(brands)

    io.overwrite_partition(A.query_sku_cate(spark, SF), f"{scratch}/qsc", jobs.QUERY_SKU_CATE, dt="s", dp="t")
    jobs.query_sku_score_job(spark, f"{scratch}/qsc", f"{scratch}/sim", f"{scratch}/score", "s", "t", "d", "p")
    sc = io.read_partition(spark, f"{scratch}/score", jobs.QUERY_SKU_SCORE, dt="d", dp="p")
    assert sc.count() == A.query_sku_cate(spark, SF).count()
    assert sc.where("query_sku_score > 0").count() > 0


def test_job_releases_staged_tables(spark, scratch):
    from qsig.sources.io import _staged

    segs = A.category_terms(spark, SF).select("cid3", "cid3_name", F.array_join("terms", ",").alias("sku_term"))
    io.overwrite_partition(segs, f"{scratch}/segs2", jobs.TERM_SEGS, dt="active")
    before = len(_staged())
    jobs.tfidf_job(spark, f"{scratch}/segs2", f"{scratch}/tfidf2", dt="d")
    assert len(_staged()) == before
    assert io.read_partition(spark, f"{scratch}/tfidf2", jobs.TERM_TFIDF, dt="d").count() > 0


def test_equal_names_keep_a_line_each_and_missing_names_raise(spark, scratch):
    import pytest

    with open(f"{scratch}/names", "w") as f:
        f.write("1\ta\n2\ta\n3\tb\n")
    with open(f"{scratch}/vecs", "w") as f:
        f.write("1 0\n0 1\n1 1\n")
    jobs.category_similarity_job(spark, f"{scratch}/vecs", f"{scratch}/names", f"{scratch}/out", k=2)
    rows = sorted((r.cid3, r.score_top200.count(":")) for r in io.read_tsv_partition(spark, f"{scratch}/out", jobs.CID_SCORE).collect())
    assert rows == [("a", 2), ("a", 2), ("b", 2)]
    with open(f"{scratch}/vecs", "a") as f:
        f.write("2 2\n")
    with pytest.raises(ValueError):
        jobs.category_similarity_job(spark, f"{scratch}/vecs", f"{scratch}/names", f"{scratch}/out", k=2)


def _trade(spark, scratch, lines=900, customers=60, suppliers=12, brands=9):
    """Small tables with keys that repeat, are null or meet nothing."""
    import random

    rng = random.Random(5)
    tables = {
        "lineitem": ("l_orderkey long, l_partkey long, l_suppkey long", [
            (rng.choice([None, *range(150)]), rng.choice([None, *range(40)]), rng.choice([None, *range(suppliers + 1)])) for _ in range(lines)]),
        "orders": ("o_orderkey long, o_custkey long", [(i, rng.choice([None, *range(customers)])) for i in range(150)]),
        "part": ("p_partkey long, p_brand string", [(i, None if i == 7 else f"b{i % brands}") for i in range(40)]),
        "customer": ("c_custkey long, c_nationkey int", [(i, i % 3) for i in range(customers - 5)]),
        "supplier": ("s_suppkey long, s_name string", [(i, f"s{i}") for i in range(suppliers)] + [(3, "other"), (4, None), (None, "none"), (99, "idle")]),
        "nation": ("n_nationkey int", [(0,), (1,), (2,)])}
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{scratch}/{name}.parquet")
    return {k: v for k, (_, v) in tables.items()}


def _pairs_of(t):
    """query_sku_cate by plain loops."""
    from collections import Counter, defaultdict

    orders, parts = dict(t["orders"]), dict(t["part"])
    lines = [(orders[o], s, parts[p]) for o, p, s in t["lineitem"] if o in orders and p in parts]

    def lists(at):
        per = defaultdict(Counter)
        for x in lines:
            per[x[at]][x[2]] += 1
        return {k: list(zip(*sorted(v.items(), key=lambda x: (-x[1], x[0] is not None, x[0] or "")))) for k, v in per.items()}

    of_c, of_s = lists(0), lists(1)
    return sorted((str(c), str(s), str(name), list(of_c[c][0]), list(map(float, of_c[c][1])), list(of_s[s][0]), list(map(float, of_s[s][1])), of_s[s][0][0], n)
                  for (c, s), n in Counter((c, s) for c, s, _ in lines).items() if c is not None
                  for key, name in t["supplier"] if s is not None and key == s)


def test_pairs_meet_their_lists_without_a_shuffle_of_lists_per_row(spark, scratch, monkeypatch):
    """Lists go to blocks of customers and suppliers, not to every row, and rows
    that carry lists are neither joined nor shuffled; the rows are the same for any cut."""
    want = _pairs_of(_trade(spark, scratch))
    assert len(want) > 400
    for cut in ((25_000, 1_000_000), (1, 20)):
        monkeypatch.setattr(A, "LINES_PER_TASK", cut, raising=False)
        df = A.query_sku_cate(spark, scratch)
        got = sorted(((r.query, r.sku, str(r.sku_name), r.query_cate, r.query_cate_weight, r.sku_cate, r.sku_cate_weight, r.sku_org_cate, r.search_count)
                      for r in df.collect()))
        assert got == want
    plan = df._jdf.queryExecution().sparkPlan().toString()
    above = plan[:plan.index("Union")]          # from the result down to where pairs and lists are put together
    assert "Join" not in above and above.count("Exchange") == 1 and above.rindex("Exchange") > above.rindex("Window")


def test_blocks_keep_copies_and_rows_per_task_bounded():
    for lines, customers, suppliers, tasks in ((10, 3, 2, 200), (600_000, 15_000, 1000, 200), (36_000_000, 900_000, 60_000, 200), (216_000_000, 5_400_000, 360_000, 8), (10**9, 10, 10**7, 200)):
        tall, across = A._blocks(lines, customers, suppliers, tasks)
        assert lines / (tall * across) <= 1_000_000 and tall * across <= 2 * max(tasks, lines / 1_000_000 + 1)
        assert customers * across + suppliers * tall <= max(lines, 60) or customers < tasks
