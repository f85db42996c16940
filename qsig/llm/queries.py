"""Registered queries of the numbered operators and their DuckDB texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents: 4-word shingles, 4 bits."""
    from qsig.llm.simhash import near_duplicates

    return near_duplicates(_read(spark, sf_dir, "documents"), shingle=4, distance=4).select(
        "doc_id", "fingerprint", "component_id")


# bounded training samples: documents of label 0 and 1, characters of a document
TOXIC_SAMPLE, QUALITY_SAMPLE, SAMPLE_CHARS = (3000, 1200), (1000, 1000), 10_000


def toxicity_model(spark: SparkSession, sf_dir: str):
    """SVM fitted on label rows outside the held-out fold (remainder 0 of 5)."""
    from qsig.llm import toxicity
    from qsig.llm.labelled import fold, labelled_sample

    return toxicity.train(labelled_sample(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"), "toxic",
                                          fold("doc_id", 5) != 0, TOXIC_SAMPLE, SAMPLE_CHARS))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of all documents."""
    from qsig.llm import toxicity
    from qsig.llm.labelled import fold

    scored = toxicity.score(_read(spark, sf_dir, "documents"), toxicity_model(spark, sf_dir))
    return scored.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mixed order of all documents, sources weighted by the square root of
    their size taken exactly, blocks of 16 documents."""
    from qsig.llm.mixing import mix

    return mix(_read(spark, sf_dir, "documents"), exponent=0.5, block=16)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to Zstandard WARC archives and read back."""
    from qsig.llm.warc import archive_round_trip

    return archive_round_trip(_read(spark, sf_dir, "pages"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of all documents by subword embeddings fitted on label
    rows outside the held-out fold (remainder 2 of 4)."""
    from qsig.llm import quality_classifier
    from qsig.llm.labelled import fold, labelled_sample

    docs = _read(spark, sf_dir, "documents")
    sample = labelled_sample(docs, _read(spark, sf_dir, "labels"), "quality", fold("doc_id", 4) != 2,
                             QUALITY_SAMPLE, SAMPLE_CHARS)
    return quality_classifier.score(docs, quality_classifier.train(sample)).select(
        "doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items, however short, that each document holds."""
    from qsig.llm.decontaminate import decontaminate

    out = decontaminate(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"), min_item=1)
    return out.select("doc_id", "contaminated", "n_items", "items")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality rules over all documents, default threshold table."""
    from qsig.llm.quality_rules import quality_rules

    return quality_rules(_read(spark, sf_dir, "documents")).drop("failed_rules")


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of all documents that lie in an earlier 100-byte string."""
    from qsig.llm.suffix_dedup import suffix_dedup

    return suffix_dedup(_read(spark, sf_dir, "documents"), length=100)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with later repeated line runs deleted: lines removed and
    a digest of the text left."""
    from qsig.llm.line_dedup import line_dedup

    return line_dedup(_read(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines_removed", F.md5("text").alias("kept_md5"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page URL."""
    from qsig.llm.url_filter import filter_urls

    return filter_urls(_read(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op11_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token ids, packed into sequences of 1024."""
    import public_tokenizers

    from qsig.llm.best_fit import pack

    return pack(_read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), length=1024, end=2)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interaction of five filters over all documents, all 120 orders."""
    from qsig.llm.filter_audit import audit

    return audit(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """Documents of every tenth id hash with the words from a place drawn by
    the hash on replaced by repeats of the first of them."""
    words = F.array_remove(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), "")
    h = F.crc32(F.col("doc_id").cast("string"))
    n, g = "size(words)", "(h div 10)"
    drawn = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, words).alias("words"))
    placed = drawn.withColumn("a", F.expr(f"case when {n} > 0 then {g} % {n} end")).withColumn(
        "p", F.expr(f"1 + ({n} - a) div (3 + {g} % 8)"))
    repeated = F.expr(f"transform(sequence(0, {n} - 1), i -> words[cast(if(i < a, i, a + (i - a) % p) as int)])")
    return placed.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of all documents, every tenth with planted ones: their
    number, the one with most turns, digests of all and of the rest."""
    from qsig.llm.periodic_runs import periodic_runs

    found = periodic_runs(with_planted_runs(_read(spark, sf_dir, "documents")))
    best = F.expr("""aggregate(slice(runs, 2, greatest(size(runs) - 1, 0)), get(runs, 0),
        (m, r) -> if(r.length * m.period > m.length * r.period, r, m))""")
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(F.lit("")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_toxicity": op2_toxicity,
    "op3_mixing": op3_mixing,
    "op4_warc": op4_warc,
    "op5_quality": op5_quality,
    "op6_decontaminate": op6_decontaminate,
    "op7_quality_rules": op7_quality_rules,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_line_dedup": op9_line_dedup,
    "op10_url_filter": op10_url_filter,
    "op11_best_fit": op11_best_fit,
    "op12_filter_audit": op12_filter_audit,
    "op13_periodic_runs": op13_periodic_runs,
}


def _op4_sql() -> str:
    return """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, octet_length(encode(body)) AS n, unhex(sha1(body))::BIT::VARCHAR AS bits FROM p),
r AS (SELECT page_id, n, array_to_string(list_transform(range(32), lambda i:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               list_sum(list_transform(range(5), lambda k: (substr(bits, (5 * i + k + 1)::INT, 1)::INT) << (4 - k)::INT))::INT + 1,
               1)), '') AS digest FROM d)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id = min(page_id) OVER w THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = min(page_id) OVER w THEN NULL ELSE min(page_id) OVER w END AS refers_to
FROM r WINDOW w AS (PARTITION BY digest)"""


def _op7_sql() -> str:
    from qsig.llm import quality_rules as q

    stop = "|".join(q.STOP_WORDS)
    bad = []
    for r in q.RULES:
        metric = f"({r.top}::DOUBLE / nullif({r.bottom}, 0))"
        bad += [f"coalesce({metric} {op} {float(bound)!r}, false)" for bound, op in ((r.low, "<"), (r.high, ">"))
                if bound is not None]
    return rf"""
WITH t AS (SELECT doc_id, row_number() OVER () AS rid, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM t),
g AS (SELECT rid, i, array_to_string(list_slice(words, i, i + {q.WINDOW - 1}), ' ') AS win
      FROM (SELECT rid, words, unnest(range(1, len(words) - {q.WINDOW - 2})) AS i FROM w WHERE len(words) >= {q.WINDOW})),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, win) AS c FROM g) WHERE c > 1),
cover AS (SELECT rid, sum(least({q.WINDOW}, i - prev)) AS n FROM
          (SELECT rid, i, lag(i, 1, i - {q.WINDOW}) OVER (PARTITION BY rid ORDER BY i) AS prev FROM twice) GROUP BY rid),
m AS (SELECT w.doc_id, len(words) AS n_words, len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
             coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS word_chars,
             length(text) - length(translate(text, '{q.SYMBOLS}', '')) AS n_symbols,
             len(regexp_extract_all(regexp_replace(lower(text), '([^\pL\pN]+)', '  ', 'g'),
                                    '(?:^|[^\pL\pN])(?:{stop})(?:$|[^\pL\pN])')) AS n_stop,
             len(regexp_extract_all(text, '\p{{Lu}}')) AS n_upper, coalesce(cover.n, 0) AS n_repeat_words
      FROM w LEFT JOIN cover USING (rid)),
j AS (SELECT *, n_words < {q.BASE_MIN_WORDS} OR 100 * n_repeat_words > {q.BASE_MAX_REPEAT_PERCENT} * n_words AS base_failed FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND NOT ({' OR '.join(bad)}) AS kept FROM j"""


def _op8_sql(table: str = "documents") -> str:
    return f"""
WITH t AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM {table}),
s AS (SELECT doc_id, i, substr(h, 2 * i + 1, 200) AS win
      FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 99)) AS i FROM t WHERE len(h) >= 200)),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) AS r FROM s) WHERE r > 1),
islands AS (SELECT doc_id, min(i) AS a, max(i) + 100 AS b FROM
   (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM
     (SELECT doc_id, i, CASE WHEN i > coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i), -1000) + 100 THEN 1 ELSE 0 END AS new
      FROM again)) GROUP BY doc_id, g),
gaps AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM islands),
per AS (SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS tail,
               list(struct_pack(x := before, y := a) ORDER BY a) AS kept FROM gaps GROUP BY doc_id)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(array_to_string(list_transform(kept, lambda k: substr(h, (2 * k.x + 1)::INT, (2 * (k.y - k.x))::INT)), ''), '')
                    || substr(h, (2 * coalesce(tail, 0) + 1)::INT))) AS kept_sha256
FROM t LEFT JOIN per USING (doc_id)"""


def _op9_sql(table: str = "documents") -> str:
    """Runs from each line on: the shortest one and those with one or two more
    lines (longer ones hold the shortest run of a later line)."""
    from qsig.llm.line_dedup import MIN_LINES, MIN_WORDS

    assert MIN_LINES == 3
    return rf"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS s, unnest(range(len(string_split(text, chr(10))))) AS i
           FROM {table} WHERE text IS NOT NULL),
f AS (SELECT doc_id, i, s, len(regexp_extract_all(s, '[^\x20\x09-\x0D]+')) AS w FROM l WHERE regexp_matches(s, '[^\x20\x09-\x0D]')),
n AS (SELECT doc_id, [s, lead(s) OVER o, lead(s, 2) OVER o, lead(s, 3) OVER o, lead(s, 4) OVER o] AS ss,
             [i, lead(i) OVER o, lead(i, 2) OVER o, lead(i, 3) OVER o, lead(i, 4) OVER o] AS ii,
             CASE WHEN w >= {MIN_WORDS} THEN 1 WHEN w + lead(w) OVER o >= {MIN_WORDS} THEN 2
                  WHEN lead(s, 2) OVER o IS NOT NULL THEN 3 END AS least
      FROM f WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
r AS (SELECT doc_id, ii[1] AS a, ii[k] AS b, array_to_string(ss[1:k], chr(10)) AS run
      FROM (SELECT *, unnest(range(least, least + 3)) AS k FROM n WHERE least IS NOT NULL) WHERE ss[k] IS NOT NULL),
later AS (SELECT doc_id, a, b FROM (SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, a) AS k FROM r) WHERE k > 1),
gone AS (SELECT DISTINCT f.doc_id, f.i FROM f JOIN later ON f.doc_id = later.doc_id AND f.i BETWEEN later.a AND later.b),
left_ AS (SELECT l.doc_id, string_agg(l.s, chr(10) ORDER BY l.i) FILTER (WHERE gone.i IS NULL) AS text, count(gone.i) AS n
          FROM l LEFT JOIN gone ON l.doc_id = gone.doc_id AND l.i = gone.i GROUP BY l.doc_id)
SELECT d.doc_id, coalesce(n, 0)::INT AS n_lines_removed,
       CASE WHEN d.text IS NOT NULL THEN md5(coalesce(left_.text, '')) END AS kept_md5
FROM {table} d LEFT JOIN left_ ON d.doc_id = left_.doc_id"""


def _op12_sql(table: str = "documents", labels: str = "labels") -> str:
    return rf"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
                  list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM {table}),
f AS (SELECT doc_id, part,
             (len(words) < 200)::INT + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::INT
             + 4 * (100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 3 * length(text))::INT
             + 8 * regexp_matches(text, '[#$%&*|]')::INT
             + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)::INT AS mask FROM d),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM {labels} GROUP BY doc_id),
m AS (SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
      FROM f LEFT JOIN l ON f.doc_id = l.doc_id GROUP BY part, mask),
c AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 4, 8, 16]) AS b),
o AS (SELECT a.x || b.x || c3.x || c4.x || c5.x AS filter_order, [a.b, b.b, c3.b, c4.b, c5.b] AS bits
      FROM c a, c b, c c3, c c4, c c5 WHERE a.b + b.b + c3.b + c4.b + c5.b = 31 AND a.b | b.b | c3.b | c4.b | c5.b = 31),
s AS (SELECT filter_order, step, bits[step] AS own, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before
      FROM o, (SELECT unnest(range(1, 6))::INT AS step))
SELECT part, filter_order, step,
       coalesce(sum(n) FILTER (mask & (before | own) = 0), 0)::BIGINT AS kept,
       coalesce(sum(n) FILTER (mask & own <> 0 AND mask & before = 0), 0)::BIGINT AS removed,
       coalesce(sum(n) FILTER (mask & own <> 0 AND mask & before <> 0), 0)::BIGINT AS redundant,
       coalesce(sum(n) FILTER (mask = own), 0)::BIGINT AS unique_fails,
       coalesce(sum(good) FILTER (mask & own <> 0 AND mask & before = 0), 0)::BIGINT AS good_lost,
       coalesce(sum(toxic) FILTER (mask & own <> 0 AND mask & before = 0), 0)::BIGINT AS toxic_lost,
       coalesce(sum(n * (120 // greatest(bit_count(mask::INT), 1))) FILTER (mask & own <> 0), 0)::BIGINT AS shapley
FROM m, s GROUP BY part, filter_order, step"""


def _op13_sql(table: str = "documents") -> str:
    """Distances of neighbouring equal stretches of 2^k words, found for every
    place by doubling, are tried as periods: a run of period q has a place
    whose next equal stretch of q to 2q words (16 at least) is q words on."""
    levels = [1 << k for k in range(15)]
    doubled, last = [], "x"
    for size in levels[1:]:
        half = size // 2
        doubled.append(f"""h{size} AS (SELECT rid, i, n, CASE WHEN i + {size} <= n THEN hash(v, lead(v, {half}) OVER
      (PARTITION BY rid ORDER BY i)) END AS v FROM {last} WHERE n >= {size})""")
        last = f"h{size}"
    near = " UNION ".join(
        f"""SELECT rid, d FROM (SELECT rid, n, lead(i) OVER (PARTITION BY rid, v ORDER BY i) - i AS d FROM h{size} WHERE v IS NOT NULL)
      WHERE d <= {size} AND d > {size // 2 if size > 16 else 0} AND 3 * d <= n""" for size in levels[4:])
    return rf"""
WITH b AS (SELECT row_number() OVER () AS rid, doc_id,
           list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w0,
           CASE WHEN doc_id IS NOT NULL THEN xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
             list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
             lambda c, y: list_reduce(list_prepend(xor(c, y), range(8)), lambda z, k: xor(z >> 1, (z & 1) * 3988292384)))) END AS h
           FROM {table}),
q AS (SELECT *, CASE WHEN h % 10 = 0 AND len(w0) > 0 THEN (h // 10) % len(w0) END AS a FROM b),
t AS (SELECT rid, doc_id, len(w0) AS n, CASE WHEN a IS NULL THEN w0 ELSE list_transform(range(len(w0)), lambda i:
             w0[(CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (len(w0) - a) // (3 + (h // 10) % 8)) END + 1)::INT]) END AS w FROM q),
y AS (SELECT rid, n, unnest(w) AS word, unnest(range(n)) AS i FROM t),
x AS (SELECT rid, i, n, hash(word) AS v FROM y WHERE n >= 24),
{", ".join(doubled)},
cand AS ({near}),
same AS (SELECT c.rid, c.d, p.i, p.i - row_number() OVER (PARTITION BY c.rid, c.d ORDER BY p.i) AS g
         FROM cand c JOIN y p ON p.rid = c.rid JOIN y r ON r.rid = c.rid AND r.i = p.i + c.d AND r.word = p.word),
long AS (SELECT rid, min(i) AS start, count(*) + d AS length, d AS period FROM same GROUP BY rid, d, g
         HAVING count(*) + d >= greatest(24, 3 * d)),
runs AS (SELECT * FROM long l WHERE NOT EXISTS (SELECT 1 FROM long k WHERE k.rid = l.rid AND k.period < l.period
         AND l.period % k.period = 0 AND k.start <= l.start AND k.start + k.length >= l.start + l.length)),
per AS (SELECT rid, count(*) AS n_runs, string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS txt,
        first({{'s': start, 'l': length, 'p': period}} ORDER BY length / period DESC, start, period) AS best FROM runs GROUP BY rid),
gone AS (SELECT DISTINCT y.rid, y.i FROM y JOIN runs u ON u.rid = y.rid AND y.i >= u.start + u.period AND y.i < u.start + u.length),
rest AS (SELECT y.rid, string_agg(word, ' ' ORDER BY y.i) AS txt FROM y LEFT JOIN gone ON gone.rid = y.rid AND gone.i = y.i
         WHERE gone.i IS NULL GROUP BY y.rid)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, best.s::BIGINT AS start, best.l::BIGINT AS length, best.p::BIGINT AS period,
       (1000 * best.l // best.p)::BIGINT AS exponent_milli, sha256(coalesce(per.txt, '')) AS runs_sha256,
       sha256(coalesce(rest.txt, '')) AS collapsed_sha256
FROM t LEFT JOIN per USING (rid) LEFT JOIN rest USING (rid)"""


ORACLE: dict[str, str] = {
    "op4_warc": _op4_sql(),
    "op7_quality_rules": _op7_sql(),
    "op8_suffix_dedup": _op8_sql(),
    "op9_line_dedup": _op9_sql(),
    "op12_filter_audit": _op12_sql(),
    "op13_periodic_runs": _op13_sql(),
}
