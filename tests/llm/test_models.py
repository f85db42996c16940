"""Toxicity, quality classifier, URL filter: held-out figures and contracts."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from qsig.llm import quality_classifier as Q
from qsig.llm import toxicity as T
from qsig.llm import url_filter as U
from qsig.llm.labelled import Sample, fold, labelled_sample

CLEAN = "river stone green lamp walks under bridge seven quiet morning bread garden window paper letter north".split()
BAD = ["idiot", "moron", "scumbag"]


def docs(rng, n, toxic):
    out = []
    for _ in range(n):
        words = [rng.choice(CLEAN) + rng.choice(["", "s", ".", ","]) for _ in range(rng.randrange(5, 60))]
        if toxic:
            for _ in range(2):
                words.insert(rng.randrange(len(words)), rng.choice(BAD))
        out.append(" ".join(words))
    return out


@pytest.fixture(scope="module")
def toxic_model():
    rng = random.Random(1)
    bad, good = docs(rng, 60, True), docs(rng, 150, False)
    return T.train(Sample(good + bad, [0] * len(good) + [1] * len(bad)), landmarks=60)


def test_kernel_equals_explicit_sum():
    """The self kernel by dynamic programming is the norm of the features."""
    for w in ("idiot", "i.d.i.o.t", "aaa", "ab", "émile"):
        c = T._codes([w], len(w), T._code_table())
        raw = np.zeros(T.ALPHABET ** 3)
        n = c.shape[1]
        for i in range(n):
            for j in range(i + 1, n):
                for k in range(j + 1, n):
                    if c[0, i] and c[0, j] and c[0, k]:
                        raw[(c[0, i] * T.ALPHABET + c[0, j]) * T.ALPHABET + c[0, k]] += 0.5 ** (k - i + 1)
        assert T._self_kernel(c, 0.5)[0] == pytest.approx((raw ** 2).sum())


def test_toxicity_catches_gapped_and_inserted_letters(spark, frame, toxic_model):
    rows = [(1, "river stone idiot walks"), (2, "river stone walks under green lamp"), (3, "you i.d.i.o.t of the garden"),
            (4, "you i d i o t of the garden"), (5, "a m-o-r-o-n"), (6, "an 1d1ot, quiet"), (7, None), (8, ""),
            (9, " ".join(docs(random.Random(4), 300, False))), (10, "x" * 50_000), (None, "moron"), (11, "an idxiot here")]
    df = frame(rows).withColumn("score", F.lit("clash")).withColumn("text_hash", F.lit(0))
    out = {r.doc_id: r.score for r in T.score(df, toxic_model).collect()}
    assert all(0 <= s <= 1 for s in out.values()) and len(out) == len(rows)
    assert min(out[k] for k in (1, 3, 4, 5, 6, None)) >= 0.5
    assert max(out[k] for k in (2, 7, 8, 9, 10)) < 0.5
    assert out[11] > out[2]
    assert T.score(df.limit(0), toxic_model).count() == 0


def test_toxicity_without_one_label(spark, frame):
    for labels, want in (([], 0.0), ([0, 0], 0.0), ([1, 1], 1.0)):
        m = T.train(Sample(["a b c", "d e f"][:len(labels)], labels))
        assert T.score(frame([(1, "anything"), (2, None)]), m).agg(F.max("score"), F.min("score")).first()[0] == pytest.approx(want)


def test_toxicity_held_out_documents(spark):
    from qsig.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    out = QUERIES["op2_toxicity"](spark, sf)
    assert out.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = out.collect()
    assert len(rows) == 1000
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    score = {0: [], 1: []}
    for r in rows:
        if r.held_out and r.doc_id in labels:
            score[labels[r.doc_id]].append(r.score)
    assert len(held) > 50
    pairs = [(a > b) + 0.5 * (a == b) for a in score[1] for b in score[0]]
    assert np.mean(pairs) > 0.75            # forty toxic documents to learn from


def test_fold_is_crc32_of_the_id(spark):
    import zlib

    got = spark.range(50).select("id", fold("id", 5).alias("f")).collect()
    assert all(r.f == zlib.crc32(str(r.id).encode()) % 5 for r in got)


def test_sample_is_bounded(spark, frame):
    d = frame([(i, "t" * (i + 1)) for i in range(40)] + [(3, "tttt"), (None, "x")])
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(3, 1), (5, None), (None, 1), (7, 9)], "doc_id bigint, y int")
    s = labelled_sample(d, labels, "y", F.lit(True), (4, 6), 30)
    assert s.labels.count(0) <= 4 and s.labels.count(1) <= 6 and max(map(len, s.texts)) <= 30


def test_quality_classifier_tells_junk(spark, frame):
    rng = random.Random(2)
    good = docs(rng, 80, False)
    junk = [" | ".join(d.split()) for d in docs(rng, 30, False)] + [" ".join(w for w in d.split()[:6] for _ in range(9)) for d in docs(rng, 30, False)]
    m = Q.train(Sample(good + junk, [1] * len(good) + [0] * len(junk)))
    test = docs(rng, 30, False)
    rows = [(i, t) for i, t in enumerate(test)] + [(100 + i, " | ".join(t.split())) for i, t in enumerate(test)]
    rows += [(200, "bread " * 400), (300, None), (301, ""), (302, "z" * 40_000), (None, test[0])]
    df = frame(rows).withColumn("score", F.lit("clash"))
    out = {r.doc_id: r.score for r in Q.score(df, m).collect()}
    assert all(0 <= s <= 1 for s in out.values()) and len(out) == len(rows)
    assert np.mean([out[i] >= 0.7 for i in range(30)]) > 0.95 and np.mean([out[100 + i] < 0.7 for i in range(30)]) > 0.95
    assert out[200] < 0.5 and out[None] == out[0] and out[300] == out[301]
    assert Q.score(df.limit(0), m).count() == 0
    assert Q.train(Sample([], [])).bias == 0 and Q.train(Sample(["a"], [1])).bias > 0 > Q.train(Sample(["a"], [0])).bias


def test_quality_held_out_documents(spark):
    from qsig.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = QUERIES["op5_quality"](spark, sf).collect()
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert len(rows) == 1000 and np.mean([p == y for p, y in held]) > 0.9


def brute_url(url):
    if url is None or "://" not in url:
        return "", "", None
    tail = url.split("://", 1)[1]
    cut = min([tail.find(c) for c in "/?#" if c in tail], default=len(tail))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in tail[:cut])
    rest = tail[cut:]
    path = rest[:min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    fit = [(len(h + p), h + p) for _, h, p in U.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fit)[1] if fit else None


def test_url_filter(spark):
    urls = [None, "", "nonsense", "http://", "HTTP://WWW.Example.COM/en/x?q#f", "http://example.com/en/1", "http://example.com/EN/1",
            "https://a.example.com/en/", "http://example.com", "http://notexample.com/en/", "http://com/", "http://com", "http://x.net/es/1",
            "http://x.net/fr/?a://b/c", "http://x.net/fr", "http://x.net/esx/", "ftp://h.org#frag/en/", "http://h.org?x=/p", "a://b://c/d",
            "http://casino-win.example.org/en/3", "http://ads-track.example.net/de/8", "http://theron.example.org/en/7",
            "http://É.com/é", "http://evil.com\n/x", "http://h/p\nq"]
    rows = [(i, u) for i, u in enumerate(urls)] + [(None, urls[5]), (5, urls[5])]
    df = spark.createDataFrame(rows, "page_id bigint, url string")
    for c in ("host", "path", "rule", "verdict", "score"):
        df = df.withColumn(c, F.lit("clash"))
    out = U.filter_urls(df).collect()
    assert len(out) == len(rows)
    verdicts = {h + p: v for v, h, p in U.RULES}
    for r in out:
        u = urls[r.page_id if r.page_id is not None else 5]
        assert (r.host, r.path, r.rule) == brute_url(u), u
        assert (r.host, r.path) == U.split(u)
        assert r.verdict == (verdicts[r.rule] if r.rule else "block" if r.score >= 0.5 else "allow")
    by = {r.page_id: r.verdict for r in out if r.rule is None}
    assert [by[k] for k in (0, 1, 2, 19, 20, 21)] == ["allow", "allow", "allow", "block", "block", "allow"]
    assert U.filter_urls(df.limit(0)).count() == 0
    assert U.train(()).score("h", "/p") == 0.5


def test_url_model_separates_its_table():
    m = U.train()
    assert all((m.score(*U.split(u)) >= 0.5) == bool(y) for y, u in U.LABELLED)


UNSEEN = [(1, u) for u in """http://grand-casino.example.org/en/9 https://casino-palace.test/slots http://bets-today.example.net/odds
https://m.ads-server.example.org/en/4 http://tracker-ads.test/p https://spammy-farm.example.net/de/7 http://buy-pills.test/order
https://cheap-pills-shop.example.org/fr/2 http://adult-video.test/watch https://www.xxx-adult.example.net/en/1 http://free-jackpot.test/win
https://online-bets.example.org/en/11""".split()] + [(0, u) for u in """http://bakery.example.org/en/8 https://www.mountain.example.net/de/4/
http://blog.theatre.example.org/fr/31 https://m.question.example.net/en/88?page=2 http://history.test/rome/forum https://physics.test/lectures/waves
http://choir.example.net/es/5 https://translation.example.org/en/6#top http://bridges.test/city/map https://novels.test/library/shelf
http://therapist.example.net/en/10 https://gardeners.example.org/de/3.html""".split()]


def test_url_model_on_hosts_it_has_not_seen():
    """Held-out URLs, and the URLs of each name by a model without that name."""
    model = U.train()
    hosts = {U.split(u)[0] for _, u in U.LABELLED}
    assert not hosts & {U.split(u)[0] for _, u in UNSEEN}
    right = sum((model.score(*U.split(u)) >= 0.5) == bool(y) for y, u in UNSEEN)
    assert right >= 22, [(y, u, model.score(*U.split(u))) for y, u in UNSEEN if (model.score(*U.split(u)) >= 0.5) != bool(y)]
    right = 0
    for k in range(10):
        part = U.train(tuple(x for i, x in enumerate(U.LABELLED) if i // 2 % 10 != k))
        right += sum((part.score(*U.split(u)) >= 0.5) == bool(y) for i, (y, u) in enumerate(U.LABELLED) if i // 2 % 10 == k)
    assert right >= 0.8 * len(U.LABELLED)


def test_url_table_has_no_host_of_the_pages(spark):
    hosts = {U.split(u)[0] for _, u in U.LABELLED}
    for sf in ("sf0.001", "sf0.01", "sf0.1"):
        pages = spark.read.parquet(f"/root/testdata/{sf}/pages.parquet")
        found = {r[0] for r in pages.select(U.host_of(F.col("url"))).distinct().collect()}
        assert not found & hosts


def test_url_of_great_length(spark):
    url = "http://bakery.example.org/" + "bread/" * 200_000
    row = U.filter_urls(spark.createDataFrame([(1, url)], "page_id bigint, url string")).first()
    assert row.host == "bakery.example.org" and len(row.path) == len(url) - len("http://bakery.example.org") and row.verdict == "allow"
