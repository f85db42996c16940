"""SimHash near-duplicates against a brute-force all-pairs version."""

import numpy as np
import xxhash
from pyspark.sql import functions as F

from qsig.llm import simhash


def brute_fp(text, k=4):
    words = [w for w in (text or "").translate({c: c + 32 for c in range(65, 91)})
             .replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    sh = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps, d):
    fps = list(fps)
    label = {f: f for f in fps}
    changed = True
    near = {f: [g for g in fps if bin(f ^ g).count("1") <= d] for f in fps}
    while changed:
        changed = False
        for f in fps:
            m = min(label[g] for g in near[f])
            if m < label[f]:
                label[f], changed = m, True
    return label


def check(rows, out, d=4):
    by = {}
    want_fp = [brute_fp(t) for _, t in rows]
    label = brute_components(set(want_fp), d)
    for (i, _), f in zip(rows, want_fp):
        by.setdefault(label[f], []).append(i)
    want = sorted((i, f"{f:016x}", min((x for x in by[label[f]] if x is not None), default=None))
                  for (i, _), f in zip(rows, want_fp) if i is not None)
    got = sorted((r.doc_id, r.fingerprint, r.component_id) for r in out if r.doc_id is not None)
    assert got == want
    assert len(out) == len(rows)


def test_documents_match_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    check(rows, simhash.near_duplicates(docs).collect())


def test_nulls_empty_repeats_and_clashing_columns(spark, frame):
    rows = [(3, None), (1, ""), (2, " \t\n"), (7, "One two"), (7, "one TWO"), (8, "a b c d e"), (None, "a b c d e"),
            (None, "x y z"), (9, "É é"), (9, "É é")]
    df = frame(rows)
    for c in ("fp", "fingerprint", "text_hash", "n", "root", "bucket", "best", "component_id"):
        df = df.withColumn(c, F.lit("clash"))
    out = simhash.near_duplicates(df).collect()
    check(rows, out)
    assert {r.component_id for r in out if r.doc_id in (1, 2, 3)} == {1}
    assert [r.component_id for r in out if r.doc_id is None and r.fingerprint == f"{brute_fp('x y z'):016x}"] == [None]
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_links_connect_every_near_pair_also_in_split_buckets(spark):
    rng = np.random.default_rng(3)
    centres = rng.integers(0, 2**64, 40, dtype=np.uint64)
    fps = set(centres.tolist())
    for c in centres.tolist():
        for _ in range(25):
            x = c
            for b in rng.choice(64, rng.integers(1, 5), replace=False).tolist():
                x ^= 1 << b
            fps.add(x)
    label = brute_components(fps, 4)
    signed = {f: int(np.uint64(f).astype(np.int64)) for f in fps}
    src = spark.createDataFrame([(signed[f],) for f in fps], "fp bigint").cache()
    for block in (4096, 4):
        found = simhash.links(src, 4, block=block).collect()
        back = {v: k for k, v in signed.items()}
        parent = {f: f for f in fps}

        def root(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for r in found:
            a, b = root(back[r.a]), root(back[r.b])
            parent[max(a, b)] = min(a, b)
        got = {f: root(f) for f in fps}
        assert len(set(got.values())) == len(set(label.values()))
        assert all(got[f] == got[label[f]] for f in fps)
