from pyspark.sql import functions as F
from pyspark.sql import types as T

from qsig.sources import io

SCHEMA = T.StructType([T.StructField("sku", T.StringType()), T.StructField("query", T.StringType())])


def test_overwrite_partition_is_idempotent_and_isolated(spark, scratch):
    path = f"{scratch}/tbl"
    a = spark.createDataFrame([("1", "x"), ("2", "y")], SCHEMA)
    b = spark.createDataFrame([("9", "z")], SCHEMA)
    io.overwrite_partition(b, path, SCHEMA, dt="2020-01-01")
    io.overwrite_partition(a, path, SCHEMA, dt="2020-01-02")
    io.overwrite_partition(a, path, SCHEMA, dt="2020-01-02")
    got = io.read_partition(spark, path, SCHEMA, dt="2020-01-02")
    assert sorted(map(tuple, got.select("sku", "query").collect())) == [("1", "x"), ("2", "y")]
    other = io.read_partition(spark, path, SCHEMA, dt="2020-01-01")
    assert [tuple(r) for r in other.select("sku", "query").collect()] == [("9", "z")]
    # partition keys stay strings
    assert dict(got.dtypes)["dt"] == "string"


def test_empty_overwrite_empties_the_partition(spark, scratch):
    path = f"{scratch}/emptied"
    a = spark.createDataFrame([("1", "x")], SCHEMA)
    for dt in ("2020-01-01", "a=b/c d"):
        io.overwrite_partition(a, path, SCHEMA, dt=dt, dp="p")
    io.overwrite_partition(a.limit(0), path, SCHEMA, dt="2020-01-01", dp="p")
    assert io.read_partition(spark, path, SCHEMA, dt="2020-01-01", dp="p").count() == 0
    assert io.read_partition(spark, path, SCHEMA, dt="a=b/c d", dp="p").count() == 1


def failing(df):
    """``df`` with a last row whose computation raises in its task."""
    bad = df.limit(1).withColumn("query", F.when(F.lit(True), F.raise_error(F.lit("broken row")).cast("string")))
    return df.unionByName(bad)


def test_failed_overwrite_keeps_the_old_rows(spark, scratch):
    import os

    import pytest

    path = f"{scratch}/kept"
    old = spark.createDataFrame([("1", "x"), ("2", "y")], SCHEMA)
    io.overwrite_partition(old, path, SCHEMA, dt="d", version="v/1")
    for _ in range(2):
        with pytest.raises(Exception, match="broken row"):
            io.overwrite_partition(failing(old), path, SCHEMA, dt="d", version="v/1")
        got = io.read_partition(spark, path, SCHEMA, dt="d", version="v/1").select("sku", "query")
        assert sorted(map(tuple, got.collect())) == [("1", "x"), ("2", "y")]
    with pytest.raises(Exception, match="broken row"):
        io.overwrite_partition(failing(old), path, SCHEMA, dt="new", version="v/1")
    assert io.read_partition(spark, path, SCHEMA, dt="new", version="v/1").count() == 0
    tsv = old.withColumnsRenamed({"sku": "cid3", "query": "score_top200"})
    schema = T.StructType([T.StructField("cid3", T.StringType()), T.StructField("score_top200", T.StringType())])
    io.write_tsv_partition(tsv, f"{scratch}/keptsv")
    with pytest.raises(Exception, match="broken row"):
        io.write_tsv_partition(failing(old), f"{scratch}/keptsv")
    assert io.read_tsv_partition(spark, f"{scratch}/keptsv", schema).count() == 2
    for folder in (path, f"{scratch}/keptsv"):              # nothing is left beside the partitions
        assert not [f for f in os.listdir(folder) if f.startswith("_new")]


def test_overwrite_may_read_its_own_partition(spark, scratch):
    path = f"{scratch}/own"
    io.overwrite_partition(spark.createDataFrame([("1", "x"), ("2", "y")], SCHEMA), path, SCHEMA, dt="d")
    for _ in range(2):
        rows = io.read_partition(spark, path, SCHEMA, dt="d").select((F.col("sku") + 1).cast("string").alias("sku"), "query")
        io.overwrite_partition(rows, path, SCHEMA, dt="d")
    got = io.read_partition(spark, path, SCHEMA, dt="d").select("sku", "query")
    assert sorted(map(tuple, got.collect())) == [("3", "x"), ("4", "y")]


def test_replacement_broken_off_between_its_moves_is_undone(spark, scratch):
    """The driver ended with the old rows moved aside: the next replacement
    starts from them; one that ended before clearing away changes nothing."""
    import os

    import pytest

    path = f"{scratch}/undone"
    io.overwrite_partition(spark.createDataFrame([("1", "x")], SCHEMA), path, SCHEMA, dt="d", dp="p")
    os.makedirs(f"{path}/_kept/dt=d")
    os.rename(f"{path}/dt=d/dp=p", f"{path}/_kept/dt=d/dp=p")
    assert io.read_partition(spark, path, SCHEMA, dt="d", dp="p").count() == 0
    with pytest.raises(ValueError):
        with io.replacing(spark, path, dt="d", dp="p"):
            raise ValueError
    assert io.read_partition(spark, path, SCHEMA, dt="d", dp="p").count() == 1
    os.makedirs(f"{path}/_kept/dt=d/dp=p")
    io.overwrite_partition(spark.createDataFrame([("8", "y"), ("9", "z")], SCHEMA), path, SCHEMA, dt="d", dp="p")
    assert io.read_partition(spark, path, SCHEMA, dt="d", dp="p").count() == 2
    assert not os.path.exists(f"{path}/_kept/dt=d/dp=p")


def test_append_partition_doubles(spark, scratch):
    path = f"{scratch}/app"
    a = spark.createDataFrame([("1", "x")], SCHEMA)
    io.overwrite_partition(a, path, SCHEMA, dt="d", version="v")
    io.append_partition(a, path, SCHEMA, dt="d", version="v")
    assert io.read_partition(spark, path, SCHEMA, dt="d", version="v").count() == 2


def test_read_since_is_exclusive_and_open_ended(spark, scratch):
    path = f"{scratch}/clicks"
    df = spark.createDataFrame([("1", "a")], SCHEMA)
    for d in ["2020-04-30", "2020-05-01", "2020-05-31", "2020-07-01"]:
        io.overwrite_partition(df, path, SCHEMA, dt=d)
    got = io.read_since(spark, path, SCHEMA, "2020-05-31", 30)
    assert sorted(r.dt for r in got.collect()) == ["2020-05-31", "2020-07-01"]


def test_read_index_names_first_occurrence_wins(spark, scratch):
    p = f"{scratch}/names.txt"
    with open(p, "w") as f:
        f.write("1\talpha\n2\tbeta\n1\tgamma\n\n3\tdelta\n")
    got = {r.idx: r.name for r in io.read_index_names(spark, p).collect()}
    assert got == {0: "alpha", 1: "beta", 2: "delta"}


def test_read_whitelist(spark, scratch):
    p = f"{scratch}/wl.txt"
    with open(p, "w") as f:
        f.write("  c1\tx\nc2\nc1\ty\n\n")
    assert sorted(r.cid3 for r in io.read_whitelist(spark, p).collect()) == ["c1", "c2"]


def test_read_vectors_and_parse(spark, scratch):
    p = f"{scratch}/vec.txt"
    with open(p, "w") as f:
        f.write("1 2  3\n\n 0.5 x 1e2 \n")
    got = sorted((r.id, r.vec) for r in io.read_vectors(spark, p).collect())
    assert got == [(0, [1.0, 2.0, 3.0]), (1, [0.5, None, 100.0])]


def test_vector_folder_numbers_lines_through_all_files(spark, scratch):
    import os

    os.makedirs(f"{scratch}/vecs")
    for name, text in (("a.txt", "1 0\n\n2 0\n"), ("b.txt", "3 0\r\n4 0"), ("c.txt", "")):
        with open(f"{scratch}/vecs/{name}", "w", newline="") as f:
            f.write(text)
    assert sorted((r.id, r.vec[0]) for r in io.read_vectors(spark, f"{scratch}/vecs").collect()) == [
        (0, 1.0), (1, 2.0), (2, 3.0), (3, 4.0)]


def test_large_file_is_numbered_over_splits(spark, scratch):
    with open(f"{scratch}/big.txt", "w") as f:
        f.writelines(f"{i} 0\n" for i in range(20_000))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        rows = io.read_vectors(spark, f"{scratch}/big.txt")
        assert rows.where(F.col("id") != F.get("vec", F.lit(0)).cast("bigint")).count() == 0 and rows.count() == 20_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_decode_neighbours_edges(spark):
    df = spark.createDataFrame([("k", "a:1.0,b:0.5,a:0.2"), ("m", "x:y:0.3,bad,z:nan?")], ["cid3", "score_top200"])
    got = sorted(tuple(r) for r in io.decode_neighbours(df).collect())
    assert got == [("k", "a", 1.0), ("k", "b", 0.5), ("m", "x:y", 0.3)]


def test_encode_decode_round_trip(spark, scratch):
    rows = [("c1", "c1", 1.0, 1), ("c1", "c2", 0.000627, 2), ("c2", "c2", 1.0, 1)]
    df = spark.createDataFrame(rows, "cid3 string, neighbour string, score double, rank int")
    enc = io.encode_neighbours(df)
    texts = {r.cid3: r.score_top200 for r in enc.collect()}
    assert texts["c1"] == "c1:1.0,c2:6.27E-4"
    path = f"{scratch}/sim"
    io.write_tsv_partition(enc, path, dt="active")
    schema = T.StructType([T.StructField("cid3", T.StringType()), T.StructField("score_top200", T.StringType())])
    back = io.decode_neighbours(io.read_tsv_partition(spark, path, schema, dt="active"))
    assert sorted(tuple(r) for r in back.collect()) == [("c1", "c1", 1.0), ("c1", "c2", 0.000627), ("c2", "c2", 1.0)]


def test_conform_by_name(spark):
    df = spark.createDataFrame([("q", 1.5, "extra")], ["query", "score", "junk"])
    schema = T.StructType([T.StructField("score", T.FloatType()), T.StructField("query", T.StringType()),
                           T.StructField("missing", T.IntegerType())])
    out = io.conform(df, schema)
    assert out.dtypes == [("score", "float"), ("query", "string"), ("missing", "int")]
    assert tuple(out.first()) == (1.5, "q", None)


def test_ensure_parallelism(spark):
    one = spark.range(100).coalesce(1)
    assert io.ensure_parallelism(one, "id").rdd.getNumPartitions() >= 2
    many = spark.range(100).repartition(8)
    assert io.ensure_parallelism(many, "id", min_partitions=4).rdd.getNumPartitions() == 8


def test_parse_vector_whitespace(spark):
    from qsig.functions.vectors import parse_vector

    df = spark.createDataFrame([("\t1 2\t3 \n",), ("  ",), (None,)], "s string")
    got = [r.v for r in df.select(parse_vector("s").alias("v")).collect()]
    assert got == [[1.0, 2.0, 3.0], None, None]
