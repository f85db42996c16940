import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert rows and df.columns == ["cid3", "cid3_name", "term", "tfidf", "rank"]
    assert max(r.rank for r in rows) <= 10


def test_oracle_keys_subset_of_queries():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 50
    from qsig.plans.catalog import ORACLE, QUERIES
    assert set(QUERIES) == set(ORACLE)


def test_sample_of_queries_match_duckdb_at_sf0001(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    for name in ["tfidf_ranked", "keyword_triples", "negative_pairs", "query_features", "cosine_topk",
                 "query_sku_score", "kmeans_lloyd", "augmented_corpus"]:
        sdf = E.queries()[name](spark, SF)
        cols = sorted(sdf.columns)
        srows = sorted(tuple(str(r[c]) for c in cols) for r in sdf.collect())
        rel = con.sql(E.oracle_sql()[name])
        idx = [rel.columns.index(c) for c in cols]
        drows = sorted(tuple(str(r[i]) for i in idx) for r in rel.fetchall())
        assert srows == drows, name


def test_kernels_run_when_started_outside_the_repo(tmp_path):
    """Executors import nothing from the package: its task functions are
    shipped by value, so a driver started elsewhere still works."""
    import os
    import subprocess
    import sys

    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        "import sys; sys.path.insert(0, %r)\n"
        "from pyspark.sql import SparkSession\n"
        "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "import __spark_entry__ as E\n"
        "print(E.queries()['cosine_topk'](s, %r).count(), E.queries()['kmeans_assign'](s, %r).count())\n"
    ) % (repo, SF, SF)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True,
                         timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    n_vec = duckdb.sql(f"SELECT count(*) FROM read_parquet('{SF}/embeddings.parquet')").fetchall()[0][0]
    assert out.stdout.split()[-2:] == [str(n_vec * min(n_vec, 200)), str(n_vec)]


def test_bench_prints_one_json_line(tmp_path):
    import json
    import os
    import subprocess
    import sys

    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = dict(os.environ, BENCH_SF_DIR=SF, BENCH_WARM_DIR=SF, BENCH_CPUS="2")
    out = subprocess.run([sys.executable, os.path.join(repo, "bench.py"), "keyword_triples"], cwd=tmp_path,
                         env=env, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    rec = json.loads(lines[0])
    assert rec["unit"] == "sec" and rec["sf"] == 0.001 and set(rec["queries"]) == {"keyword_triples"}
    assert rec["value"] == pytest.approx(sum(rec["queries"].values()), abs=1e-3)
