"""Periodic runs against brute force and SQL."""

import hashlib
import random
import zlib
from fractions import Fraction

import duckdb
import numpy as np
import pytest

from qsig.llm import periodic_runs as P
from qsig.llm.queries import _op13_sql, op13_periodic_runs


def brute(w):
    n, out = len(w), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i < n - q:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(24, 3 * q) and not any(all(w[x] == w[x + d] for x in range(i, j + q - d)) for d in range(1, q)):
                out.append((i, j + q - i, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def text_with_runs(rng, n):
    size = rng.choice([2, 3, 5, 20, 200])
    w = [rng.randrange(size) for _ in range(n)]
    for _ in range(rng.randint(0, 4) if n > 4 else 0):
        a = rng.randrange(n)
        p = rng.randint(1, max(1, (n - a) // 3))
        unit = w[a:a + p]
        if rng.random() < .4 and p > 6:                 # a run inside the period, with a flaw
            z = rng.randint(1, p // 3)
            unit = [unit[i % z] for i in range(len(unit))]
            unit[rng.randrange(len(unit))] = rng.randrange(size)
        for i in range(min(rng.randint(2 * p, 8 * p), n - a)):
            w[a + i] = unit[i % len(unit)]
    return w


@pytest.mark.parametrize("seed", range(4))
def test_runs_match_brute_force(seed):
    rng, total = random.Random(seed), 0
    for _ in range(150):
        w = text_with_runs(rng, rng.randint(0, 260))
        want = brute(w)
        total += len(want)
        assert P.runs(np.array(w, np.int64)) == want, w
        assert P._maybe([str(x) for x in w]) or not want
    assert total > 50


def test_every_period_is_found():
    """One run of each period at its least length, between other words."""
    for q in [*range(1, 70), 97, 128, 200, 255, 256, 257, 341, 511, 600]:
        for extra in (0, 1, q // 2):
            size = max(24, 3 * q) + extra
            w = [-1 - i for i in range(40)] + [i % q for i in range(size)] + [-100 - i for i in range(40)]
            assert P.runs(np.array(w)) == [(40, size, q)]
        short = [-1 - i for i in range(5)] + [i % q for i in range(max(24, 3 * q) - 1)] + [-50]
        assert P.runs(np.array(short)) == []


def test_scales_leave_no_period_out():
    """Periods above DIRECT: some context of some scale covers each."""
    scales = sorted(s << k for k in range(20) for s in (P._FIRST, 3 * P._FIRST // 2))
    for q in range(P.DIRECT + 1, 100_000):
        assert any(2 * t <= c and q <= c <= 2 * q - t + 1 and 4 * q > t and q <= 11 * t // 4 - 1
                   for t in scales for c in (2 * t, 11 * t // 4 - 1)), q


def test_synchronising_sets_are_sparse_and_consistent():
    rng = random.Random(5)
    w = [rng.randrange(50) for _ in range(3000)]
    w = np.array(w + [7] * 3000 + w)                    # copies around a highly periodic region
    short = [(3000, 6000, 1)]
    for scale in (16, 32, 64):
        got = list(P.proposals(P.Names(w), len(w), scale, short))
        assert not [x for x in got if 3000 <= x[0] < 6000 - scale]
    assert P.runs(w) == [(3000, 3000, 1)]


def digests(doc, text):
    """The query's row by definition."""
    w = P._WORD.findall(text or "")
    n, h = len(w), zlib.crc32(str(doc).encode()) if doc is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = brute(w)
    best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    gone = {i for s, k, q in found for i in range(s + q, s + k)}
    return (doc, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256("".join(f"{s},{k},{q}\n" for s, k, q in found).encode()).hexdigest(),
            hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest())


COLS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    out = [(i, " ".join(f"w{x}" for x in text_with_runs(rng, rng.randint(0, 160)))) for i in range(150)]
    tens = [i for i in range(200, 2000) if zlib.crc32(str(i).encode()) % 10 == 0][:20]
    out += [(i, "\t".join(f"é{x}" for x in range(rng.randint(0, 300)))) for i in tens]
    out += [(150, None), (151, ""), (152, " \n\t "), (None, "a " * 50), (None, None), (3, out[3][1]), (3, out[3][1]), (-17, "b c " * 30),
            (tens[0], None), (153, "x " * 24 + "y"), (154, "x " * 23 + "y"), (155, "line one\nline two\n" * 9), (156, "A a " * 12)]
    return out


def test_query_matches_brute_force_and_sql(spark, rows, tmp_path):
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 AS runs", "2 AS a", "3 AS h", "'x' AS words")
    df.repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r[c] for c in COLS) for r in op13_periodic_runs(spark, str(tmp_path)).collect()), key=repr)
    assert got == sorted((digests(*r) for r in rows), key=repr)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    assert sorted(con.execute(f"SELECT {', '.join(COLS)} FROM ({_op13_sql()})").fetchall(), key=repr) == got


def test_very_long_text(spark, frame):
    rng = random.Random(1)
    unit = [f"u{rng.randrange(9)}" for _ in range(40_000)]
    w = [str(i) for i in range(1000)] + unit * 3 + ["end"]
    row = P.periodic_runs(frame([(1, " ".join(w))])).first()
    assert (1000, 120_000, 40_000) in [tuple(r) for r in row.runs]
    assert row.n_words == len(w)


def test_empty_table(spark, frame):
    out = P.periodic_runs(frame([]))
    assert out.columns == ["doc_id", "n_words", "runs", "collapsed"] and out.count() == 0
