"""Adapters from the driver's test tables to the reference's input shapes.

Each adapter reads whole tables (no id subsets or row caps) and returns the
columns the operators expect; ``sql`` holds the DuckDB text of the same
derivation so the oracle queries start from identical inputs.  The mapping is
documented in FIXTURES.md §2.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from qsig.sources.io import drop_at_exit, ensure_parallelism, stage, staging_dir

# Fixed test parameters (shared by the Spark queries and the oracle SQL).
TOKEN_PATTERN = "[^a-zà-ÿ]+"            # split of lower-cased text into terms
CLICK_DIM = "A"                          # l_returnflag value standing in for 'app'
CLICK_DT = "1995-07-30"                  # job date; the scan keeps dt > 1995-06-30
CLICK_LOOKBACK = 30
WHITELIST = ["src1", "src4", "src7", "src12", "src19"]   # the categories that the whitelist file names
SIM_TOPK = 10                            # neighbours kept per brand


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ------------------------------------------------------------ category_terms

def category_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(cid3 = source, cid3_name = lang, terms array<string>) from documents."""
    d = ensure_parallelism(table(spark, sf_dir, "documents"), "doc_id")
    return d.select(F.col("source").alias("cid3"), F.col("lang").alias("cid3_name"),
                    F.split(F.lower("text"), TOKEN_PATTERN).alias("terms"))


SQL_CATEGORY_TERMS = f"""
  ct AS (SELECT source AS cid3, lang AS cid3_name,
                regexp_split_to_array(lower(text), '{TOKEN_PATTERN}') AS terms FROM documents),
  t AS (SELECT cid3, cid3_name, unnest(terms) AS term FROM ct)"""


# ------------------------------------------------------------------ click_log

def click_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sku, key_word, dim_type, dt) from lineitem ⋈ part."""
    li = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag", "l_shipdate")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return li.join(p, li.l_partkey == p.p_partkey).select(
        F.col("l_suppkey").cast("string").alias("sku"), F.col("p_name").alias("key_word"),
        F.col("l_returnflag").alias("dim_type"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("dt"))


SQL_CLICK_LOG = """
  click AS (SELECT CAST(l_suppkey AS VARCHAR) AS sku, p_name AS key_word, l_returnflag AS dim_type,
                   strftime(l_shipdate, '%Y-%m-%d') AS dt
            FROM lineitem JOIN part ON l_partkey = p_partkey)"""


# ----------------------------------------------------------------- graph_path

def graph_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(pathid, name, ord) from lineitem ⋈ part: an order's parts (name and
    key) by line number."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return li.join(p, li.l_partkey == p.p_partkey).select(
        F.col("l_orderkey").cast("string").alias("pathid"),
        F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string")).alias("name"),
        F.col("l_linenumber").alias("ord"))


SQL_GRAPH_PATH = """
  gp AS (SELECT CAST(l_orderkey AS VARCHAR) AS pathid, concat_ws(' ', p_name, CAST(p_partkey AS VARCHAR)) AS name,
                l_linenumber AS ord
         FROM lineitem JOIN part ON l_partkey = p_partkey)"""


# --------------------------------------------------------------- query_scores

def query_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(query = partkey, sku = suppkey, score = extendedprice) from lineitem."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_partkey").cast("string").alias("query"),
                     F.col("l_suppkey").cast("string").alias("sku"),
                     F.col("l_extendedprice").alias("score"))


SQL_QUERY_SCORES = """
  qs AS (SELECT CAST(l_partkey AS VARCHAR) AS query, CAST(l_suppkey AS VARCHAR) AS sku,
                l_extendedprice AS score FROM lineitem)"""


# ------------------------------------------------------------------- vectors

def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, vec array<double>) from embeddings."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("id"),
                    F.transform("embedding", lambda x: x.cast("double")).alias("vec"))


SQL_VECTORS = """
  vecs AS (SELECT vec_id AS id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS vec FROM embeddings)"""


def query_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(query, feature array<double>) from embeddings, every dimension."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").cast("string").alias("query"),
                    F.transform("embedding", lambda x: x.cast("double")).alias("feature"))


SQL_QUERY_POINTS = """
  pts AS (SELECT CAST(vec_id AS VARCHAR) AS query,
                 list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS feature FROM embeddings)"""


def word_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(word, emb string): blank-separated integer micro-units of each dim.

    Integers print identically on every engine, so the text is a stable input
    for the vector parser.
    """
    e = table(spark, sf_dir, "embeddings")
    txt = F.array_join(F.transform("embedding", lambda x: F.floor(x.cast("double") * F.lit(1e6)).cast("string")), " ")
    return e.select(F.col("vec_id").cast("string").alias("word"), txt.alias("emb"))


# ------------------------------------------------------------- query_sku_cate

def _cates(sales: DataFrame, who: str) -> DataFrame:
    """All brands of each ``who`` (``cates``), most lines first, and their line
    counts (``weights``); a list is at most as long as the list of brands."""
    counts = sales.groupBy(who, "p_brand").agg(F.count(F.lit(1)).alias("cnt"))
    items = F.array_sort(F.collect_list(F.struct((-F.col("cnt")).alias("o"), "p_brand", F.col("cnt").cast("double").alias("cnt"))))
    return counts.groupBy(who).agg(items.alias("items")).select(
        who, F.col("items.p_brand").alias("cates"), F.col("items.cnt").alias("weights"))


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(c = customer, s = supplier, p_brand, nation = customer nation) per line,
    staged once: the query–sku table and the brand vectors both roll it up."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    joined = (li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey)
              .join(c, F.col("o_custkey") == c.c_custkey, "left"))
    return stage(joined.select(F.col("o_custkey").alias("c"), F.col("l_suppkey").alias("s"), "p_brand",
                               F.col("c_nationkey").alias("nation")), "sales")


LINES_PER_TASK = (25_000, 1_000_000)     # lines of a task that meets lists: at least where tasks are few, and at most, about


def _blocks(lines: int, customers: int, suppliers: int, tasks: int) -> tuple[int, int]:
    """(blocks of customers, blocks of suppliers), a cell for each of about
    ``tasks``: a customer's list is copied once for every block of suppliers
    and the other way round, and the product is cut so that the two have about
    as many copies."""
    least, most = LINES_PER_TASK
    tasks = max(1, min(tasks, math.ceil(lines / least)), math.ceil(lines / most))
    across = min(tasks, max(1, round(math.sqrt(tasks * suppliers / max(1, customers)))))
    return math.ceil(tasks / across), across


def query_sku_cate(spark: SparkSession, sf_dir: str, sales_df: DataFrame | None = None) -> DataFrame:
    """One row per (customer, supplier) pair that traded.

    query = customer key, sku = supplier key, cates = all brands by line
    count (ties by brand) with the counts as weights, sku_org_cate = the
    supplier's first brand, search_count = lines of the pair.

    Customers and suppliers are cut into blocks.  The lines of two blocks and
    a copy of the lists of both go to one task (cell), where pairs meet their
    lists by sorting: rows that carry lists are not shuffled.  A supplier of
    several rows carries all its names.
    """
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    sl = (sales_df if sales_df is not None else sales(spark, sf_dir)).select("c", "s", "p_brand")
    tall, wide = _blocks(sl.count(), table(spark, sf_dir, "customer").count(), s.count(), int(spark.conf.get("spark.sql.shuffle.partitions")))
    block_c, block_s = F.pmod(F.xxhash64("c"), F.lit(tall)), F.pmod(F.xxhash64("s"), F.lit(wide))

    def cell(row: Column, col: Column) -> Column:
        return (row * wide + col).cast("int").alias("cell")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("block")

    names = s.groupBy(F.col("s_suppkey").alias("s")).agg(F.collect_list(F.struct("s_name")).alias("names"))
    qc = _cates(sl.where("c is not null"), "c").select("c", F.struct("cates", "weights").alias("q"))
    sc = _cates(sl, "s").join(names, "s").select("s", F.struct("cates", "weights", "names").alias("k"))
    pairs = sl.where("c is not null and s is not null").groupBy("c", "s").agg(F.count(F.lit(1)).alias("search_count"))
    met = (pairs.select(cell(block_c, block_s), "c", "s", "search_count")
           .unionByName(qc.select("c", "q", every(wide)).select(cell(block_c, F.col("block")), "c", "q"), True)
           .unionByName(sc.select("s", "k", every(tall)).select(cell(F.col("block"), block_s), "s", "k"), True)
           .repartitionById(tall * wide, "cell").withColumn("alone", F.when(F.col("c").isNull(), F.col("s"))))
    met = (met.withColumn("q", F.first("q", ignorenulls=True).over(Window.partitionBy("cell", "c", "alone"))).where("s is not null")
           .withColumn("k", F.first("k", ignorenulls=True).over(Window.partitionBy("cell", "s"))).where("c is not null and k is not null"))
    return (met.select("*", F.explode("k.names").alias("name"))
            .select(F.col("c").cast("string").alias("query"), F.col("s").cast("string").alias("sku"), F.col("name.s_name").alias("sku_name"),
                    F.col("q.cates").alias("query_cate"), F.col("q.weights").alias("query_cate_weight"),
                    F.col("k.cates").alias("sku_cate"), F.col("k.weights").alias("sku_cate_weight"),
                    F.col("k.cates")[0].alias("sku_org_cate"), F.col("search_count").cast("int").alias("search_count")))


SQL_QUERY_SKU_CATE = """
  sales AS (SELECT o_custkey AS c, l_suppkey AS s, p_brand
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey),
  qcnt AS (SELECT c, p_brand, count(*) AS cnt FROM sales GROUP BY c, p_brand),
  qtop AS (SELECT c, list(p_brand ORDER BY r) AS qc, list(CAST(cnt AS DOUBLE) ORDER BY r) AS qw
           FROM (SELECT *, row_number() OVER (PARTITION BY c ORDER BY cnt DESC, p_brand) AS r FROM qcnt) GROUP BY c),
  scnt AS (SELECT s, p_brand, count(*) AS cnt FROM sales GROUP BY s, p_brand),
  stop AS (SELECT s, list(p_brand ORDER BY r) AS sc, list(CAST(cnt AS DOUBLE) ORDER BY r) AS sw
           FROM (SELECT *, row_number() OVER (PARTITION BY s ORDER BY cnt DESC, p_brand) AS r FROM scnt) GROUP BY s),
  pairs AS (SELECT c, s, count(*) AS search_count FROM sales GROUP BY c, s),
  qsc AS (SELECT CAST(pairs.c AS VARCHAR) AS query, CAST(pairs.s AS VARCHAR) AS sku, s_name AS sku_name,
                 qc AS query_cate, qw AS query_cate_weight, sc AS sku_cate, sw AS sku_cate_weight,
                 sc[1] AS sku_org_cate, CAST(search_count AS INTEGER) AS search_count
          FROM pairs JOIN qtop ON pairs.c = qtop.c JOIN stop ON pairs.s = stop.s
          JOIN supplier ON pairs.s = s_suppkey)"""


def brand_vectors(spark: SparkSession, sf_dir: str, sales_df: DataFrame | None = None) -> DataFrame:
    """(id = brand, vec): lines of each brand per customer nation, a dimension
    for every key of ``nation`` in key order."""
    sl = sales_df if sales_df is not None else sales(spark, sf_dir)
    keys = table(spark, sf_dir, "nation").agg(F.array_sort(F.collect_set("n_nationkey"))).scalar()
    counts = (sl.where(F.col("nation").isNotNull()).groupBy("p_brand", "nation")
              .agg(F.count(F.lit(1)).alias("cnt")))
    m = F.map_from_entries(F.collect_list(F.struct("nation", "cnt")))
    per = counts.groupBy("p_brand").agg(m.alias("m")).withColumn("keys", keys)
    return per.select(F.col("p_brand").alias("id"), F.transform(
        "keys", lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0)).cast("double")).alias("vec"))


SQL_BRAND_VECTORS = """
  bcnt AS (SELECT p_brand, c_nationkey, count(*) AS cnt
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
           JOIN customer ON o_custkey = c_custkey GROUP BY p_brand, c_nationkey),
  bvec AS (SELECT b.p_brand AS id,
                  list(CAST(coalesce(bcnt.cnt, 0) AS DOUBLE) ORDER BY g.n_nationkey) AS vec
           FROM (SELECT DISTINCT p_brand FROM bcnt WHERE c_nationkey IS NOT NULL) b
           CROSS JOIN (SELECT DISTINCT n_nationkey FROM nation) g
           LEFT JOIN bcnt ON bcnt.p_brand = b.p_brand AND bcnt.c_nationkey = g.n_nationkey
           GROUP BY b.p_brand)"""


# --------------------------------------------------------------- text sources

def whitelist_file(spark: SparkSession) -> str:
    """Folder of a whitelist text file (category, tab, a note), under staging."""
    import uuid

    path = f"{staging_dir(spark)}/qsig-tables/whitelist-{uuid.uuid4().hex}"
    drop_at_exit(spark, path)
    spark.createDataFrame([(f"{c}\tnote",) for c in WHITELIST] + [("",), (" ",)], "value string").write.text(path)
    return path


def vector_files(spark: SparkSession, sf_dir: str, sales_df: DataFrame | None = None) -> tuple[str, str]:
    """Folders of the text sources of the category similarity job: one brand
    vector per line, and ``index<TAB>name`` with the 1-based line of each."""
    import uuid

    base = f"{staging_dir(spark)}/qsig-tables/categories-{uuid.uuid4().hex}"
    drop_at_exit(spark, base)
    b = stage(brand_vectors(spark, sf_dir, sales_df), "brand-vectors").withColumn("n", F.row_number().over(Window.orderBy("id")))
    b = stage(b, "brand-lines")
    line = F.array_join(F.transform("vec", lambda x: x.cast("string")), " ")
    b.repartitionByRange(3, "n").sortWithinPartitions("n").select(line.alias("value")).write.text(f"{base}/vectors")
    b.select(F.concat_ws("\t", F.col("n").cast("string"), "id").alias("value")).write.text(f"{base}/names")
    return f"{base}/vectors", f"{base}/names"
