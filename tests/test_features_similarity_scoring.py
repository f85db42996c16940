
import numpy as np
import pytest
from pyspark.sql import functions as F

from qsig.operators import features, scoring, similarity


def test_size_filter_bounds(spark):
    sizes = {"q19": 19, "q20": 20, "q12000": 12000, "q12001": 12001}
    df = None
    for q, n in sizes.items():
        part = spark.range(n).select(F.lit(q).alias("query"), F.col("id").cast("string").alias("sku"),
                                     F.col("id").cast("double").alias("score"))
        df = part if df is None else df.unionByName(part)
    kept = {r.query: r.num for r in features.query_features(df).select("query", "num").collect()}
    assert kept == {"q20": 20, "q12000": 12000}


def test_descending_fractiles(spark):
    df = spark.range(1, 21).select(F.lit("q").alias("query"), F.col("id").cast("string").alias("sku"),
                                   F.col("id").cast("double").alias("score"))
    r = features.query_features(df).first()
    assert (r.quarter, r.half, r.three_quarters) == (15.0, 10.0, 5.0)
    mean, std = 10.5, float(np.std(np.arange(1, 21)))
    assert r.quarter_n == pytest.approx((15 - mean) / std)
    z = {k: v for k, v in r.sku_score_normal.items()}
    assert np.mean(list(z.values())) == pytest.approx(0.0, abs=1e-12)
    assert np.std(list(z.values())) == pytest.approx(1.0)


def test_equal_scores_null_z(spark):
    df = spark.range(20).select(F.lit("q").alias("query"), F.col("id").cast("string").alias("sku"),
                                F.lit(3.0).alias("score"))
    r = features.query_features(df).first()
    assert r.quarter == 3.0 and r.quarter_n is None and r.half_n is None


def test_repeated_sku_keeps_lowest_z(spark):
    rows = [("q", "dup", 1.0), ("q", "dup", 30.0)] + [("q", f"s{i}", float(i)) for i in range(18)]
    df = spark.createDataFrame(rows, "query string, sku string, score double")
    m = features.query_features(df).first().sku_score_normal
    z = features.score_map_long(df).where("sku = 'dup'").first().z
    assert m["dup"] == pytest.approx(z) and z < 0


def test_cosine_topk_zero_vector_and_small_n(spark):
    df = spark.createDataFrame([(0, [0.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 1.0]), (3, [0.0, 2.0])],
                               "id long, vec array<double>")
    out = similarity.cosine_topk(df, k=10).collect()
    zero = sorted((r.rank, r.neighbour, r.score) for r in out if r.id == 0)
    assert [n for _, n, _ in zero] == [0, 1, 2, 3] and all(s == 0.0 for *_, s in zero)
    assert len(out) == 16
    one = sorted((r.rank, r.neighbour) for r in out if r.id == 1)
    assert one[0] == (1, 1) and one[1] == (2, 2)


def test_cosine_blocked_equals_brute_force(spark):
    rng = np.random.default_rng(4)
    m = rng.normal(size=(300, 8))
    m[7] = m[3]  # exact duplicate: tie broken by neighbour id
    df = spark.createDataFrame([(int(i), [float(x) for x in row]) for i, row in enumerate(m)],
                               "id long, vec array<double>")
    got = {(r.id, r.rank): r.neighbour for r in similarity.cosine_topk(df, k=5, block_rows=40).collect()}
    u = m / np.linalg.norm(m, axis=1, keepdims=True)
    s = np.round(u @ u.T, 12)
    for i in range(300):
        order = sorted(range(300), key=lambda j: (-s[i, j], j))[:5]
        assert [got[(i, r)] for r in range(1, 6)] == order
    assert got[(3, 1)] == 3 and got[(3, 2)] == 7 and got[(7, 1)] == 3


def _qsc(spark, rows):
    return spark.createDataFrame(rows, "query string, sku string, sku_name string, query_cate array<string>, "
                                       "query_cate_weight array<double>, sku_cate array<string>, "
                                       "sku_cate_weight array<double>, sku_org_cate string, search_count int")


def test_weighted_score_examples(spark):
    sim = spark.createDataFrame([("a", "c", 0.4)], "cid3 string, neighbour string, score double")
    rows = [("q1", "s", "n", ["a", "b"], [1.0, 3.0], ["c"], [2.0], "c", 1),
            ("q2", "s", "n", [], [], ["c"], [2.0], "c", 1),
            ("q3", "s", "n", None, None, ["c"], [2.0], "c", 1),
            ("q4", "s", "n", ["a"], [0.0], ["c"], [2.0], "c", 1),
            ("q5", "s", "n", ["a", "b"], [1.0, 1.0, 2.0], ["c"], [2.0], "c", 1),
            ("q6", "s", "n", ["a"], [None], ["c"], [1.0], "c", 1),
            ("q7", "s", "n", ["a"], [], ["c"], [1.0], "c", 1),
            ("q1", "s", "n", ["a", "b"], [1.0, 3.0], ["c"], [2.0], "c", 1)]
    out = scoring.scored_table(_qsc(spark, rows), sim).collect()
    assert len(out) == 7  # q3 dropped, the duplicated q1 row kept twice
    got = {r.query: r.query_sku_score for r in out}
    assert got["q7"] == 0.0
    assert got["q1"] == pytest.approx(0.1)
    assert got["q2"] == 0.0 and "q3" not in got and got["q4"] == 0.0
    assert got["q5"] == pytest.approx(0.25 * 0.4)   # third weight only in the sum
    assert got["q6"] == 0.0


def test_score_is_linear_in_similarity(spark):
    rows = [("q", "s", "n", ["a", "b"], [1.0, 2.0], ["c", "d"], [3.0, 1.0], "c", 1)]
    s1 = spark.createDataFrame([("a", "c", 0.2), ("b", "d", 0.6)], "cid3 string, neighbour string, score double")
    s2 = s1.withColumn("score", F.col("score") * 2)
    v1 = scoring.scored_table(_qsc(spark, rows), s1).first().query_sku_score
    v2 = scoring.scored_table(_qsc(spark, rows), s2).first().query_sku_score
    assert v2 == pytest.approx(2 * v1)


def test_all_null_scores_group(spark):
    df = spark.range(20).select(F.lit("q").alias("query"), F.col("id").cast("string").alias("sku"),
                                F.lit(None).cast("double").alias("score"))
    r = features.query_features(df).first()
    assert r.num == 20 and r.quarter is None and r.sku_score_normal == {}


def test_collect_scores_keeps_groups_of_any_size(spark):
    big = spark.range(13_000).select(F.lit("big").alias("query"), F.col("id").cast("string").alias("sku"),
                                     F.col("id").cast("double").alias("score"))
    small = spark.createDataFrame([("s", "a", 1.0), (None, "b", None)], "query string, sku string, score double")
    got = features.collect_scores(big.unionByName(small))
    assert got.columns == ["query", "num", "sku", "score"]
    assert got.where("query = 'big'").agg(F.count("*"), F.min("num"), F.max("num")).first()[:] == (13_000, 13_000, 13_000)
    assert sorted(tuple(r) for r in got.where("query is null or query = 's'").collect() if r.query) == [("s", 1, "a", 1.0)]
    assert got.where("query is null").collect()[0][1:] == (1, "b", None)
    assert features.fractiles(big.unionByName(small), lo=20, hi=12_999).collect() == []


def test_cosine_candidates_are_bounded(spark):
    """At most k candidates per row and round leave the tasks; ties go by id."""
    rng = np.random.default_rng(2)
    vecs = rng.integers(-2, 3, (900, 3)).astype(float)
    df = spark.createDataFrame([(f"n{i:04d}", [float(x) for x in v]) for i, v in enumerate(vecs)], "id string, vec array<double>")
    unit = similarity.normalise(df).select("id", "unit").cache()
    n, k, want = 900, 7, None
    for block_rows in (4096, 200):
        assert similarity.cosine_candidates(unit, k, block_rows).count() <= 2 * n * k
        got = sorted((r.id, r.rank, r.neighbour) for r in similarity.cosine_topk(df, k, block_rows=block_rows).collect())
        assert want is None or got == want
        want = got
    u = vecs / np.where(np.linalg.norm(vecs, axis=1) == 0, 1, np.linalg.norm(vecs, axis=1))[:, None]
    s = np.round(u @ u.T, 12)
    brute = sorted((f"n{i:04d}", r + 1, f"n{j:04d}") for i in range(n)
                   for r, j in enumerate(sorted(range(n), key=lambda j: (-s[i, j], j))[:k]))
    assert want == brute


def test_hot_copies_spread_and_restored(spark):
    sim = spark.createDataFrame([("a", "c", 0.5)], "cid3 string, neighbour string, score double")
    row = ("q", "s", "n", ["a"], [1.0], ["c"], [1.0], "c", 1)
    df = _qsc(spark, [row] * 300 + [("r", "s", "n", ["b"], [1.0], ["c"], [1.0], "c", 1)]).repartition(6)
    out = scoring.scored_table(df, sim).collect()
    assert sum(r.query == "q" for r in out) == 300 and all(r.query_sku_score == 0.5 for r in out if r.query == "q")
    assert [r.query_sku_score for r in out if r.query == "r"] == [0.0]


def test_float_weights_keep_exact_values(spark):
    sim = spark.createDataFrame([("a", "c", 0.5)], "cid3 string, neighbour string, score double")
    rows = [("q", "s", "n", ["a", "x"], [0.1, 0.7], ["c"], [0.3], "c", 1)]
    schema = ("query string, sku string, sku_name string, query_cate array<string>, "
              "query_cate_weight array<float>, sku_cate array<string>, sku_cate_weight array<float>, "
              "sku_org_cate string, search_count int")
    out = scoring.scored_table(spark.createDataFrame(rows, schema), sim).first()
    q = np.array([0.1, 0.7], dtype=np.float32).astype(np.float64)
    assert out.query_sku_score == pytest.approx(q[0] / q.sum() * 0.5, rel=1e-15)
    assert out.query_cate_weight == [pytest.approx(0.1, rel=1e-7), pytest.approx(0.7, rel=1e-7)]


def _clustered(rng, clusters, size, dims, spread):
    centres = rng.normal(size=(clusters, dims))
    return np.vstack([c + spread * rng.normal(size=(size, dims)) for c in centres])


def _topk(m, k):
    length = np.linalg.norm(m, axis=1)
    u = m / np.where(length == 0, 1, length)[:, None]
    s = np.round(u @ u.T, 12)
    return [sorted(range(len(m)), key=lambda j: (-s[i, j], j))[:k] for i in range(len(m))]


@pytest.mark.parametrize("spread,share", [(0.02, 0.35), (5.0, 1.0)])
def test_far_blocks_are_left_out(spark, spread, share):
    """Clustered vectors: few blocks meet, and the result is that of all pairs;
    without clusters all may meet, with the same result."""
    rng = np.random.default_rng(6)
    m = _clustered(rng, 24, 100, 12, spread)
    m[5] = 0
    m[77] = m[78] = m[1500]
    m = m[rng.permutation(len(m))]
    df = spark.createDataFrame([(int(i), [float(x) for x in v]) for i, v in enumerate(m)], "id long, vec array<double>")
    unit = similarity.normalise(df).select("id", "unit").cache()
    k, block_rows = 8, 150
    pivots = similarity._stack([r.unit for r in unit.orderBy(F.xxhash64("id"), "id").limit(48).select("unit").collect()])
    located = similarity._located(unit, pivots, block_rows)
    first = similarity.first_round(located, pivots, k, 8).cache()
    blocks = located.select("block").distinct().count()
    assert blocks >= 9 and similarity.needed_blocks(first, located).distinct().count() <= share * blocks * blocks
    got = {(r.id, r.rank): r.neighbour for r in similarity.cosine_topk(df, k, block_rows=block_rows).collect()}
    for i, want in enumerate(_topk(m, k)):
        assert [got[(i, r)] for r in range(1, k + 1)] == want, i


def test_second_round_leaves_out_batches(monkeypatch):
    """Batches whose angles keep them from every open row are not multiplied,
    and what is found is what all batches give."""
    import pandas as pd

    monkeypatch.setattr(similarity, "BATCH_COLS", 50)
    rng = np.random.default_rng(7)
    m = _clustered(rng, 10, 200, 8, 0.05)
    u = m / np.linalg.norm(m, axis=1, keepdims=True)
    pivots = u[::200]
    angle = similarity._angles(u, pivots)
    near = angle.argmin(axis=1)
    cols = pd.DataFrame({"block": 1, "role": 1, "from": near, "id": np.arange(2000), "unit": list(u), "pivot": near,
                         "angle": angle[np.arange(2000), near], "score": 0.0}).sort_values(["pivot", "id"])
    s = np.round(u[:30] @ u.T, 12)
    floor = np.sort(s, axis=1)[:, -60]                  # a k-th score that leaves 60 candidates
    rows = pd.DataFrame({"block": 1, "role": 0, "from": 0, "id": np.arange(30), "unit": list(u[:30]), "pivot": -1, "angle": 0.0, "score": floor})
    counts = {}
    out = pd.concat(similarity._second_round(5, pivots, counts)(iter([rows, cols.iloc[:700], cols.iloc[700:]])))
    assert counts["skipped"] >= 25 and counts["made"] >= 1 and counts["skipped"] + counts["made"] >= 40
    for i, some in out.groupby("id"):
        assert some["neighbour"].tolist() == sorted(range(2000), key=lambda j: (-s[i, j], j))[:5]
    assert out["id"].nunique() == 30


def test_score_matches_plain_sums(spark):
    """Random lists with repeats, nulls and unequal lengths against the sums
    of the definition; equal lists of many rows; hot lists cut by salts."""
    import random

    from qsig.operators import skew

    rng = random.Random(8)
    cates = [f"c{i}" for i in range(12)] + [None]
    sim = [(a, b, rng.uniform(-1, 1)) for a in cates[:10] for b in cates[:12] if rng.random() < .5]
    rows = []
    for i in range(300):
        one = [[rng.choice(cates) for _ in range(rng.randint(0, 6))] for _ in range(2)]
        w = [[rng.choice([None, 0.0, 1.0, 2.5]) for _ in range(max(0, len(c) + rng.choice([-1, 0, 0, 1])))] for c in one]
        rows.append((f"q{i}", f"s{i}", "n", one[0], w[0], one[1], w[1], "o", i))
    rows += [("hot", f"h{i}", "n", ["c1", "c2"], [1.0, 1.0], ["c3"], [1.0], "o", i) for i in range(200)]
    table = {(a, b): v for a, b, v in sim}

    def plain(qc, qw, sc, sw):
        total = [sum(x or 0.0 for x in w) for w in (qw, sw)]
        return sum((a or 0.0) / total[0] * (b or 0.0) / total[1] * table.get((x, y), 0.0)
                   for x, a in zip(qc, qw) for y, b in zip(sc, sw) if total[0] and total[1])

    old = skew.HOT_FLOOR
    try:
        skew.HOT_FLOOR = 20
        out = scoring.scored_table(_qsc(spark, rows), spark.createDataFrame(sim, "cid3 string, neighbour string, score double"))
        got = {r.sku: r.query_sku_score for r in out.collect()}
    finally:
        skew.HOT_FLOOR = old
    assert len(got) == len(rows)
    for r in rows:
        assert got[r[1]] == pytest.approx(plain(*r[3:7]), abs=1e-12)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and out.columns == scoring.OUT_COLS


def test_running_topk_sorts_only_what_counts(monkeypatch):
    """After the first batches a product costs a comparison: only entries that
    reach a row's k-th score are sorted, with copies going by id."""
    calls = []
    whole = similarity._batch_topk
    monkeypatch.setattr(similarity, "_batch_topk", lambda s, k: calls.append(s.shape) or whole(s, k))
    rng = np.random.default_rng(9)
    m = rng.normal(size=(3000, 6))
    m[1000:1400] = m[0]                                 # more copies than k
    u = m / np.linalg.norm(m, axis=1, keepdims=True)
    for names in (np.arange(3000), np.array([f"n{i:04d}" for i in range(3000)], object)):
        calls.clear()
        best = similarity._Best(u[:150], 20)
        for at in rng.permutation(60):
            best.add(u[at * 50:at * 50 + 50], names[at * 50:at * 50 + 50])
        assert best.made == 60 and len(calls) < 30
        row, name, score = best.found()
        for i, want in enumerate(_topk(m, 20)[:150]):
            assert name[row == i].tolist() == [names[j] for j in want]
        assert np.allclose(score, np.sum(u[row] * u[[int(str(x).lstrip("n")) for x in name]], axis=1))


def test_few_vectors_meet_by_a_key(spark):
    """Too few vectors for pivots: blocks still meet in an equality join."""
    df = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(30)], "id long, vec array<double>")
    plan = similarity.cosine_topk(df, 3, block_rows=10)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_small_similarity_table_needs_no_shuffle(spark, monkeypatch):
    """Rows are scored from their own lists where the categories fit a matrix,
    without a shuffle or a written row, with the same scores as by lists."""
    import random

    rng = random.Random(11)
    cates = [f"c{i}" for i in range(9)] + [None]
    sim = [(a, b, rng.uniform(-1, 1)) for a in cates[:8] for b in cates[:9] if rng.random() < .5] + [("c1", "c2", .25), ("c1", None, 1.0)]
    rows = [(f"q{i}", f"s{i}", "n", *[x for _ in range(2) for x in (
        [rng.choice(cates) for _ in range(rng.randint(0, 5))], [rng.choice([None, 0.0, 1.0, 2.5]) for _ in range(rng.randint(0, 5))])], "o", i)
        for i in range(400)] + [("nan", "t0", "n", ["c8"], [float("nan")], ["c1"], [1.0], "o", 1), ("none", "t1", "n", None, [1.0], ["c1"], [1.0], "o", 1)]
    df, table = _qsc(spark, rows), spark.createDataFrame(sim, "cid3 string, neighbour string, score double")
    monkeypatch.setattr(scoring, "TABLE_CELLS", 300)
    out = scoring.scored_table(df, table)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Exchange" not in plan and "Join" not in plan
    got = {r.sku: r.query_sku_score for r in out.collect()}
    monkeypatch.setattr(scoring, "TABLE_CATES", 3)
    lists = scoring.scored_table(df, table)
    assert "Join" in lists._jdf.queryExecution().executedPlan().toString()
    want = {r.sku: r.query_sku_score for r in lists.collect()}
    assert len(got) == 401 and got.keys() == want.keys() and got["t0"] == want["t0"] == 0.0
    assert all(got[k] == pytest.approx(want[k], abs=1e-12) for k in want)
    empty = scoring.scored_table(df, table.limit(0))
    assert {r.query_sku_score for r in empty.collect()} == {0.0}


def test_weights_are_summed_once_per_list(spark):
    """The sum of a list is worked out once, not again for each of its weights."""
    rows = [(0, [1.0, 3.0, None], [2.0]), (1, [0.0, None], []), (2, None, [None]), (3, [float(i) for i in range(1, 4001)], [-1.0, 2.0])]
    df = spark.createDataFrame(rows, "id long, query_cate_weight array<float>, sku_cate_weight array<double>")
    out = scoring.normalise_weights(df)
    got = {r.id: (r.query_cate_weight_norm, r.sku_cate_weight_norm) for r in out.collect()}
    assert got[0] == ([0.25, 0.75, 0.0], [1.0]) and got[1] == ([None, None], []) and got[2] == (None, [None])
    assert got[3][0] == [i / 8002000.0 for i in range(1, 4001)] and got[3][1] == [-1.0, 2.0]
    assert out.columns == ["id", "query_cate_weight", "sku_cate_weight", "query_cate_weight_norm", "sku_cate_weight_norm"]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("aggregate(") == plan.count("array_repeat(aggregate(") == 2


def test_norm_is_worked_out_once_per_vector(spark):
    """Also where the norm itself is not read."""
    df = spark.createDataFrame([(0, [3.0, 4.0]), (1, [0.0, 0.0]), (2, None), (3, []), (4, [None, 2.0])], "id long, vec array<double>")
    unit = similarity.normalise(df).select("id", "unit")
    assert {r.id: r.unit for r in unit.collect()} == {0: [0.6, 0.8], 1: [0.0, 0.0], 2: None, 3: [], 4: [0.0, 1.0]}
    plan = unit._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("aggregate(") == plan.count("array_repeat(SQRT(aggregate(") == 1, plan


def test_open_rows_of_several_blocks_share_a_task(spark):
    """The second round holds the open rows of several blocks, so that a vector
    goes to few tasks; each top-k ends in one task and is not ranked again."""
    rng = np.random.default_rng(12)
    m = rng.normal(size=(1600, 10))
    m[9] = m[1500] = m[4]
    df = spark.createDataFrame([(int(i), [float(x) for x in v]) for i, v in enumerate(m)], "id long, vec array<double>")
    unit = similarity.normalise(df).select("id", "unit").cache()
    pivots = similarity._stack([r.unit for r in unit.orderBy(F.xxhash64("id"), "id").limit(6).select("unit").collect()])
    first = similarity.first_round(similarity._located(unit, pivots, 50), pivots, 6, 8).cache()
    left, blocks = first.where("kind = 1").count(), first.where("kind = 1").select("block").distinct().count()
    groups = similarity._groups(first, 400).collect()
    assert left > 1500 and blocks > 25 and len(groups) == blocks and {r.group for r in groups} == set(range(-(-left // 400)))
    assert first.where("kind = 0").select("id").union(first.where("kind = 1").select("id")).distinct().count() == 1600
    out = similarity.cosine_topk(df, 6, block_rows=50)
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()
    got = {(r.id, r.rank): r.neighbour for r in out.collect()}
    assert len(got) == 1600 * 6
    for i, want in enumerate(_topk(m, 6)):
        assert [got[(i, r)] for r in range(1, 7)] == want, i


def test_rows_of_one_id_share_a_list(spark):
    rng = np.random.default_rng(13)
    m = rng.normal(size=(40, 4))
    ids = [i // 2 if i < 20 else i for i in range(40)]
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in zip(ids, m)], "id long, vec array<double>")
    u = m / np.linalg.norm(m, axis=1, keepdims=True)
    s = np.round(u @ u.T, 12)
    got = {}
    for r in similarity.cosine_topk(df, 5, block_rows=15).orderBy("id", "rank").collect():
        got.setdefault(r.id, []).append((r.neighbour, round(r.score, 9)))
    for i in set(ids):
        both = sorted((-s[a, b], ids[b]) for a in range(40) if ids[a] == i for b in range(40))[:5]
        assert got[i] == [(n, pytest.approx(-x, abs=1e-9)) for x, n in both]


def test_single_precision_leaves_nothing_out():
    """Scores that differ by less than single precision tells apart rank as in
    double precision, and what is found is what all products give."""
    rng = np.random.default_rng(14)
    base = rng.normal(size=64)
    m = np.vstack([base + 1e-5 * rng.normal(size=(1500, 64)), rng.normal(size=(1500, 64))])
    u = m / np.linalg.norm(m, axis=1, keepdims=True)
    best = similarity._Best(u[:60], 25)
    for at in rng.permutation(60):
        best.add(u[at * 50:at * 50 + 50], np.arange(at * 50, at * 50 + 50))
    row, name, score = best.found()
    place = similarity._place(row)
    for i in range(60):
        s = np.round(np.einsum("j,ij->i", u[i], u), 12)
        mine = name[row == i]
        assert len(mine) == 25 and place[row == i].tolist() == list(range(1, 26))
        assert np.allclose(np.sort(s)[::-1][:25], s[mine], rtol=0, atol=2e-12) and np.allclose(score[row == i], s[mine], rtol=0, atol=2e-12)
    for names in (rng.integers(0, 90, 4000), np.array([f"n{i}" for i in rng.integers(0, 90, 4000)], object)):
        row, key = rng.integers(0, 30, 4000), np.round(rng.uniform(-1, 1, 4000), 2)
        for scale in (1.0, 3.0):                        # beyond 1 the scores do not pack
            order = similarity._ranked(row, key * scale, names)
            assert [*zip(row[order], -key[order], names[order])] == sorted(zip(row, -key, names))
