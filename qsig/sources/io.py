"""Sources and sinks.

Partitioned tables are directories written with ``partitionBy`` (Hive
layout, ``dt=.../dp=...``).  Partition keys are always strings: the schema is
passed explicitly so ``dt=3`` is never inferred as an integer and equality on
a key prunes directories before any file is opened.
"""

from __future__ import annotations

import atexit
import datetime as _dt
import threading

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from qsig.fixed import LOOKBACK_DAYS, NEIGHBOUR_ITEM_SEP, NEIGHBOUR_SCORE_SEP

# ---------------------------------------------------------------- helpers

# an entry "name<sep>score", split at the last separator
_ITEM_RE = "^(.*)" + NEIGHBOUR_SCORE_SEP + "([^" + NEIGHBOUR_SCORE_SEP + "]*)$"


def _with_keys(schema: T.StructType, keys) -> T.StructType:
    names = {f.name for f in schema.fields}
    fields = list(schema.fields) + [T.StructField(k, T.StringType(), True) for k in keys if k not in names]
    return T.StructType(fields)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select ``schema``'s columns **by name** with their declared types.

    Columns absent from ``df`` become typed nulls; extra columns are dropped.
    (The reference renames by position and casts by position at insert.)
    """
    present = set(df.columns)
    cols = [
        (F.col(f.name).cast(f.dataType) if f.name in present else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ]
    return df.select(*cols)


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


# ---------------------------------------------------------------- sources


def ensure_parallelism(df: DataFrame, *keys: str, min_partitions: int | None = None) -> DataFrame:
    """Hash-spread an under-split input on ``keys`` before CPU-heavy row work.

    A large file written as one row group is scanned by one task; when the
    scan has fewer partitions than the cluster's default parallelism the rows
    are redistributed by a hash of ``keys`` (deterministic on retry).  With
    many input splits — the normal case at scale — this is a no-op.
    """
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target, *keys) if keys else df.repartition(target)



def read_partition(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "orc",
                   **keys: str) -> DataFrame:
    """Scan one partition of a partitioned table (equality on each key)."""
    df = spark.read.schema(_with_keys(schema, keys)).format(fmt).load(path)
    for k, v in keys.items():
        df = df.where(F.col(k) == F.lit(str(v)))
    return df


def cutoff_date(dt: str, lookback_days: int = LOOKBACK_DAYS, fmt: str = "%Y-%m-%d") -> str:
    """The exclusive lower bound ``dt - lookback_days`` as a string."""
    day = _dt.datetime.strptime(dt, fmt).date() - _dt.timedelta(days=lookback_days)
    return day.strftime(fmt)


def since(df: DataFrame, dt: str, lookback_days: int = LOOKBACK_DAYS, col: str = "dt") -> DataFrame:
    """S2 on a DataFrame: ``col > dt - lookback`` (string compare, no upper bound)."""
    return df.where(F.col(col) > F.lit(cutoff_date(dt, lookback_days)))


def read_since(spark: SparkSession, path: str, schema: T.StructType, dt: str,
               lookback_days: int = LOOKBACK_DAYS, fmt: str = "orc") -> DataFrame:
    """Open-ended date-range scan; the predicate prunes ``dt=`` directories."""
    df = spark.read.schema(_with_keys(schema, ["dt"])).format(fmt).load(path)
    return since(df, dt, lookback_days)


def _numbered_lines(spark: SparkSession, path: str, skip_blank: bool) -> DataFrame:
    """(line bigint 0-based, text) of a text file or a folder of them, numbered
    through all files in name order.

    Lines are numbered inside their input split, and split counts (a row per
    split) give the offsets, so a file of any size is read by many tasks."""
    raw = spark.read.text(path)
    if skip_blank:
        raw = raw.where(F.trim("value") != "")
    at = raw.select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"),
                    F.monotonically_increasing_id().alias("m"), F.col("value").alias("text"))
    at = stage(at, "numbered-lines")
    sizes = at.groupBy("f", "b").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("f", "b").rowsBetween(Window.unboundedPreceding, -1)
    start = sizes.select("f", "b", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = F.row_number().over(Window.partitionBy("f", "b").orderBy("m")) - 1
    return (at.withColumn("r", inside).join(start, ["f", "b"])
            .select((F.col("r") + F.col("start")).cast("bigint").alias("line"), "text"))


def read_index_names(spark: SparkSession, path: str) -> DataFrame:
    """S3: TSV ``index<TAB>name`` with 1-based index → ``(idx, name)``, 0-based.

    When an index repeats, its first line wins.
    """
    parts = F.split(F.trim(F.col("text")), "\t")
    rows = (_numbered_lines(spark, path, skip_blank=True)
            .select("line", (parts.getItem(0).try_cast("int") - 1).alias("idx"),
                    F.get(parts, 1).alias("name"))
            .where(F.col("idx").isNotNull()))
    return rows.groupBy("idx").agg(F.min_by("name", "line").alias("name"))


def read_whitelist(spark: SparkSession, path: str) -> DataFrame:
    """First TSV column of each non-blank line, as a distinct set ``(cid3)``."""
    first = F.split(F.regexp_replace("value", r"^\s+|\s+$", ""), "\t").getItem(0)
    return (spark.read.text(path).select(first.alias("cid3"))
            .where(F.col("cid3") != "").distinct())


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    """S5 file form: one vector per non-blank line → ``(id, vec array<double>)``;
    line i (0-based, blank lines skipped) has id i, matching S3's 0-based idx."""
    from qsig.functions.vectors import parse_vector

    return _numbered_lines(spark, path, skip_blank=True).select(
        F.col("line").alias("id"), parse_vector("text").alias("vec"))


def decode_neighbours(df: DataFrame, key: str = "cid3", value: str = "score_top200",
                      neighbour: str = "neighbour", score: str = "score") -> DataFrame:
    """``"c:s,c:s,..."`` → rows ``(key, neighbour, score)``.

    Each entry is split at its **last** ``:`` so a name may contain ``:``;
    entries without ``:`` or with a non-numeric score are skipped.  Within one
    list the first occurrence of a neighbour wins; when several rows share a
    key, the highest score per (key, neighbour) is kept.
    """
    entries = F.transform(
        F.split(F.col(value), "\\Q" + NEIGHBOUR_ITEM_SEP + "\\E"),
        lambda e: F.struct(
            F.regexp_extract(e, _ITEM_RE, 1).alias("n"),
            F.regexp_extract(e, _ITEM_RE, 2).try_cast("double").alias("s"),
            e.contains(NEIGHBOUR_SCORE_SEP).alias("ok"),
        ),
    )
    names = F.transform(entries, lambda x: x["n"])
    firsts = F.filter(entries, lambda x, i: x["ok"] & (F.array_position(names, x["n"]) == i + 1)
                      & x["s"].isNotNull())
    exploded = df.select(F.col(key).alias(key), F.explode(firsts).alias("e"))
    return (exploded.groupBy(key, F.col("e.n").alias(neighbour))
            .agg(F.max("e.s").alias(score)))


# ------------------------------------------------------------------ sinks


def _partitioned(df: DataFrame, schema: T.StructType | None, keys: dict) -> DataFrame:
    out = conform(df, schema) if schema is not None else df
    for k, v in keys.items():
        out = out.withColumn(k, F.lit(str(v)))
    return out


def partition_path(spark: SparkSession, path: str, **keys: str) -> str:
    """Folder of one partition, key values escaped as Spark escapes them."""
    esc = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    return "/".join([path.rstrip("/"), *[f"{esc(k)}={esc(str(v))}" for k, v in keys.items()]])


def _hadoop(spark: SparkSession, path: str):
    """(file system of ``path``, function from text to a path of it)."""
    jvm = spark.sparkContext._jvm
    fs = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, jvm.org.apache.hadoop.fs.Path


def _move(fs, src, dst) -> None:
    fs.mkdirs(dst.getParent())
    if not fs.rename(src, dst):
        raise OSError(f"cannot move {src} to {dst}")


class replacing:
    """Context manager that replaces one partition after a write succeeded.

        with replacing(spark, path, dt=dt) as folder:
            df.write.orc(folder)

    The new rows are written to a folder beside the partitions, whose name
    readers of the table skip.  Only when that is complete do the old rows
    move aside, the new ones into place, and the old ones go: two renames, for
    whose time the partition is not there.  A write that fails leaves the old
    rows as they were.  If the driver ends between the renames, the old rows
    wait under ``_kept`` and the next replacement of the partition puts them
    back first.  On a store whose renames copy, the moves take as long as
    copying.  A partition has one writer at a time."""

    def __init__(self, spark: SparkSession, path: str, **keys: str):
        import uuid

        self.fs, make = _hadoop(spark, path)
        root, target = path.rstrip("/"), partition_path(spark, path, **keys)
        self.target = make(target)
        self.kept = make(root + "/_kept" + target[len(root):])
        self.work = make(f"{root}/_new-{uuid.uuid4().hex}")
        self.folder = make(f"{self.work}/rows")

    def __enter__(self) -> str:
        if self.fs.exists(self.kept):
            if self.fs.exists(self.target):
                self.fs.delete(self.kept, True)         # replaced, but not cleared away
            else:
                _move(self.fs, self.kept, self.target)
        return str(self.folder)

    def __exit__(self, kind, error, trace) -> bool:
        try:
            if kind is None:
                self._swap()
        finally:
            self.fs.delete(self.work, True)
        return False

    def _swap(self) -> None:
        old = self.fs.exists(self.target)
        if old:
            _move(self.fs, self.target, self.kept)
        try:
            _move(self.fs, self.folder, self.target)
        except Exception:
            if old:
                _move(self.fs, self.kept, self.target)
            raise
        if old:
            self.fs.delete(self.kept, True)


def overwrite_partition(df: DataFrame, path: str, schema: T.StructType | None = None,
                        fmt: str = "orc", **keys: str) -> None:
    """Replace exactly the ``keys`` partition of the table at ``path``.

    Creates the table directory if absent; other partitions are untouched.
    The old rows stay readable until the new ones are written, and stay for
    good if that fails; ``df`` may read the partition it replaces.  An empty
    result empties the partition.  Rerunning gives the same partition.
    """
    out = (conform(df, schema) if schema is not None else df).drop(*keys)
    with replacing(df.sparkSession, path, **keys) as folder:
        out.write.option("compression", "snappy").format(fmt).save(folder)


def append_partition(df: DataFrame, path: str, schema: T.StructType | None = None,
                     fmt: str = "orc", **keys: str) -> None:
    """Add rows to the ``keys`` partition (``insert into``)."""
    (_partitioned(df, schema, keys).write.mode("append").option("compression", "snappy")
     .partitionBy(*keys).format(fmt).save(path))


def score_text(score) -> Column:
    """Text form of a score: the shortest that reads back as the same double."""
    s = F.col(score) if isinstance(score, str) else score
    return s.cast("double").cast("string")


def encode_neighbours(df: DataFrame, key: str = "cid3", neighbour: str = "neighbour",
                      score: str = "score", rank: str = "rank",
                      out: str = "score_top200", as_text: bool = False) -> DataFrame:
    """S9 (encode): rows → one ``"c:s,c:s"`` string per key, in rank order;
    with ``as_text`` the scores are text already.

    Lists are top-k lists, so each group holds at most k entries.
    """
    items = F.array_sort(F.collect_list(F.struct(F.col(rank).alias("r"), F.col(neighbour).alias("n"),
                                                 F.col(score).alias("s"))))
    text = F.array_join(F.transform(items, lambda x: F.concat(
        x["n"], F.lit(NEIGHBOUR_SCORE_SEP), x["s"] if as_text else score_text(x["s"]))),
                        NEIGHBOUR_ITEM_SEP)
    return df.groupBy(key).agg(text.alias(out))


def write_tsv_partition(df: DataFrame, path: str, dt: str = "active") -> None:
    """S9 (load): tab-separated text as the partition ``dt``; no quoting.  The
    partition is replaced as in ``overwrite_partition``."""
    with replacing(df.sparkSession, path, dt=dt) as folder:
        df.write.option("sep", "\t").option("quote", "").option("escape", "").option("emptyValue", "").csv(folder)


def read_tsv_partition(spark: SparkSession, path: str, schema: T.StructType, dt: str = "active") -> DataFrame:
    df = spark.read.schema(_with_keys(schema, ["dt"])).option("sep", "\t").option("quote", "").csv(path)
    return df.where(F.col("dt") == F.lit(dt))


# ------------------------------------------------------------ staging


def staging_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: the session's checkpoint
    directory (``spark.checkpoint.dir`` on a cluster; a scratch folder is
    created only when none is configured, as in local tests)."""
    from qsig.session import ensure_checkpoint_dir

    return ensure_checkpoint_dir(spark).rstrip("/")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as parquet under the staging folder and read it back.

    Used where several branches of one plan consume the same expensive
    intermediate (Catalyst cannot reuse an exchange whose branches pruned
    different columns): the source is scanned and aggregated once, the
    lineage is cut, and the written table survives executor loss.
    """
    import uuid

    path = f"{staging_dir(df.sparkSession)}/qsig-stage/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    _staged().append(path)
    drop_at_exit(df.sparkSession, path)
    return df.sparkSession.read.parquet(path)


_ALL: list[tuple] = []


def drop_at_exit(spark: SparkSession, path: str) -> None:
    """Mark a scratch folder to be deleted when the driver ends."""
    _ALL.append((spark.sparkContext._jvm, path))


@atexit.register
def _drop_all_staged() -> None:
    """What queries staged outside a job goes when the driver ends: until then
    their lazy results may still be read."""
    for jvm, p in _ALL:
        try:
            hp = jvm.org.apache.hadoop.fs.Path(p)
            hp.getFileSystem(jvm.org.apache.hadoop.conf.Configuration()).delete(hp, True)
        except Exception:  # noqa: BLE001 - the JVM may be gone: then the folder's owner cleans up
            return


_LOCAL = threading.local()


def _staged() -> list[str]:
    """Staged paths of the calling thread (jobs may run in parallel threads)."""
    if not hasattr(_LOCAL, "paths"):
        _LOCAL.paths = []
    return _LOCAL.paths


class staging:
    """Context manager for a job: staged tables written inside the block are
    deleted when it exits (after the job's sinks have written).

        with io.staging(spark):
            io.overwrite_partition(terms.tfidf_ranked(...), path, schema, dt=dt)
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def __enter__(self):
        self.mark = len(_staged())
        return self

    def __exit__(self, *exc):
        staged = _staged()
        paths, staged[self.mark:] = staged[self.mark:], []
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for p in paths:
            hp = jvm.org.apache.hadoop.fs.Path(p)
            hp.getFileSystem(conf).delete(hp, True)
        return False
