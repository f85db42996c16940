"""Suffix dedup, line dedup and quality rules against brute force and SQL."""

import hashlib
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from qsig.llm import line_dedup as L
from qsig.llm import quality_rules as R
from qsig.llm import suffix_dedup as S
from qsig.llm.queries import ORACLE, _op8_sql, _op9_sql

WORDS = "the of stone river walks under seven green lamps quietly and then é ß never again turns blue".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(50)) for _ in range(n))


def sql(text, rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    rel = con.sql(text)
    return sorted(dict(zip(rel.columns, r)).items() for r in rel.fetchall())


def shaped(df):
    return sorted(sorted(r.asDict().items()) for r in df.collect())


def brute_suffix(rows, length=100):
    """rows: distinct (id, text) in order; removed byte positions of each."""
    seen, out = set(), []
    for _, t in rows:
        raw = (t or "").encode()
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - length + 1):
            w = raw[i:i + length]
            if w in seen:
                gone[i:i + length] = True
            seen.add(w)
        left = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out.append((len(raw), int(gone.sum()), spans, hashlib.sha256(left).hexdigest()))
    return out


def test_suffix_dedup_matches_brute_force(spark, frame):
    rng = random.Random(5)
    passage, loop = prose(rng, 40), "In. " * 200
    rows = [(i, prose(rng, rng.randrange(5, 60))) for i in range(40)]
    rows += [(100, prose(rng, 10) + passage + prose(rng, 10)), (101, passage), (102, passage[3:] + " tail"),
             (103, "x" * 9000), (104, "x" * 120 + passage[:60]), (105, loop), (106, "y" + loop + passage[20:200] + "z"),
             (107, "ab" * 3000), (108, None), (109, ""), (110, "é" * 80), (111, "ß" + "é" * 70), (112, rows[3][1]),
             (113, prose(rng, 4000)), (-5, passage[50:300])]
    rows += [(120 + i, f"{i} " + passage + f" {i * 7}") for i in range(30)]
    df = frame(rows)
    for c in ("doc", "tie", "start", "bucket", "lead"):
        df = df.withColumn(c, F.lit("clash"))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in S.suffix_dedup(df).collect()}
    rows.sort(key=lambda r: r[0])
    want = dict(zip([r[0] for r in rows], brute_suffix(rows)))
    assert got == want
    assert sum(w[1] > 0 for w in want.values()) > 30


def test_suffix_dedup_null_and_repeated_ids(spark, frame):
    rng = random.Random(6)
    a, b = prose(rng, 60), prose(rng, 60)
    rows = [(None, a), (1, a), (1, a), (2, b), (2, b + "!"), (3, b[:150])]
    out = S.suffix_dedup(frame(rows), texts=True).collect()
    assert len(out) == len(rows)
    by = {}
    for r in out:
        by.setdefault(r.doc_id, []).append((r.n_removed, bytes(r.kept)))
    assert by[None] == [(0, a.encode())]                     # null ids come first
    assert by[1] == [(len(a.encode()), b"")] * 2             # one document, given twice
    assert sorted(x[0] for x in by[2])[0] == 0 and by[3] == [(150, b"")] or by[3][0][0] == len(b[:150].encode())
    assert S.suffix_dedup(frame(rows).limit(0)).count() == 0


def test_suffix_dedup_across_many_buckets(spark, frame, monkeypatch):
    """Buckets of a few rows: every group of copies straddles boundaries."""
    monkeypatch.setattr(S, "BUCKET_ROWS", 3)
    monkeypatch.setattr(S, "BUCKET_WINDOWS", 40)
    rng = random.Random(7)
    passage = prose(rng, 30)
    rows = [(i, prose(rng, 8) + passage[i % 5:] + prose(rng, 8)) for i in range(25)]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in S.suffix_dedup(frame(rows)).collect()}
    assert got == dict(zip([r[0] for r in rows], brute_suffix(rows)))


def test_multikey_quicksort_equals_lexsort():
    rng = np.random.default_rng(1)
    keys = [rng.integers(0, 3, 500).astype(np.uint64) for _ in range(5)]
    order, equal = S.multikey_quicksort(keys, 3)
    assert (order == np.lexsort(keys[::-1])).all()
    sorted_ = np.stack([k[order] for k in keys[:3]])
    assert (equal[1:] == (sorted_[:, 1:] == sorted_[:, :-1]).all(axis=0)).all() and not equal[0]
    assert len(S.multikey_quicksort([np.empty(0, np.uint64)] * 2)[0]) == 0


def test_one_gram_in_thousands_of_contexts(spark, frame, monkeypatch):
    """A common passage between other texts in 3,000 documents: its grams meet
    a different context in each, over many buckets; the windows that repeat
    are found across all boundaries, and what crosses them stays short."""
    monkeypatch.setattr(S, "BUCKET_ROWS", 200)
    monkeypatch.setattr(S, "BUCKET_WINDOWS", 5_000)
    rng = random.Random(12)
    passage = prose(rng, 25)
    rows = [(i, f"{rng.random()} {prose(rng, 2)} {passage[rng.choice([0, 0, 0, 5]):]} {rng.choice(WORDS)} {rng.random()} {rng.random()}") for i in range(3000)]
    crossed = []
    across = S._across
    monkeypatch.setattr(S, "_across", lambda pieces, length: crossed.append(
        (pieces.count(), pieces.select("bucket").distinct().count())) or across(pieces, length))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in S.suffix_dedup(frame(rows).repartition(9)).collect()}
    for (i, _), want in zip(rows, brute_suffix(rows)):
        assert got[i] == want, i
    n, buckets = crossed[0]
    assert buckets > 20 and n < 12 * len(rows), (n, buckets)


def test_null_and_least_ids_are_apart(spark, frame):
    rng = random.Random(13)
    a, b = prose(rng, 40), prose(rng, 40)
    rows = [(-(1 << 63), a), (None, a + b), (-(1 << 63) + 1, b), ((1 << 62) + 1, a), ((1 << 62) + 3, "short")]
    got = {r.doc_id: (r.n_bytes, r.n_removed) for r in S.suffix_dedup(frame(rows)).collect()}
    want = dict(zip([None, -(1 << 63), -(1 << 63) + 1, (1 << 62) + 1, (1 << 62) + 3],
                    [x[:2] for x in brute_suffix([(0, a + b), (1, a), (2, b), (3, a), (4, "short")])]))
    assert got == want


def test_pieces_hold_every_window_once():
    rng = random.Random(14)
    for _ in range(200):
        raw = bytes(rng.choice(b"abc") for _ in range(rng.randint(100, 400))) if rng.random() < .7 else b"ab" * rng.randint(50, 150)
        r = S.runs(raw, S._Powers())
        for gram, start, last in zip(r["gram"], r["start"], r["last"]):
            context = raw[start:last + 100]
            got = S._pieces(context, gram, 100)
            assert sorted(w for a, b, _ in got for w in range(a, b + 1)) == list(range(last - start + 1))
            assert all(core[1:] in context[w:w + 100] for a, b, core in got for w in range(a, b + 1))


def test_suffix_sql_matches_brute_force():
    rng = random.Random(8)
    p = prose(rng, 30)
    rows = [(1, p), (2, "q" + p + "r"), (3, "x" * 300), (4, None), (5, "short")]
    got = [dict(r) for r in sql(_op8_sql(), rows)]
    want = brute_suffix(rows)
    assert [(r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
            for r in sorted(got, key=lambda r: r["doc_id"])] == want


LINES = ["alpha beta", "gamma", "delta epsilon zeta", " ", "eta", "theta iota", "kappa", "", "w " * 60, "v " * 30]


def test_line_dedup_matches_sql(spark, frame):
    rng = random.Random(9)
    rows = [(i, "\n".join(rng.choice(LINES) for _ in range(rng.randrange(1, 14)))) for i in range(80)]
    rows += [(200, None), (201, ""), (202, "\n\n"), (203, "a\x85b\nc\nd"), (204, "a\x85b\nc\nd")]
    df = frame(rows)
    for c in ("doc", "tie", "print", "first", "n_lines_removed", "with space", "dot.ted"):
        df = df.withColumn(c, F.lit("clash"))
    out = L.line_dedup(df)
    assert out.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"] and "dot.ted" in out.columns
    got = shaped(out.select("doc_id", "n_lines_removed", F.md5("text").alias("kept_md5")))
    assert got == sorted(sorted(r) for r in sql(_op9_sql(), rows))
    for r in out.collect():
        assert r.n_chars == (None if r.text is None else len(r.text))


def test_line_dedup_ties_and_empty(spark, frame):
    text = "one\ntwo\nthree"
    out = L.line_dedup(frame([(1, text), (1, text), (None, text), (2, "x\n" + text)])).collect()
    assert sorted((r.doc_id or 0, r.text) for r in out) == [(0, text), (1, ""), (1, ""), (2, "x")]
    assert L.line_dedup(frame([(1, text)]).limit(0)).count() == 0


def brute_lines(rows):
    """rows: distinct (id, text) in order.  By definition: every stretch of
    lines that is a run and was seen at an earlier start goes whole."""
    seen, out = set(), []
    for _, text in rows:
        lines = (text or "").split("\n")
        full = [i for i, s in enumerate(lines) if re.search(r"[^\x20\x09-\x0D]", s)]
        words = [len(re.findall(r"[^\x20\x09-\x0D]+", lines[i])) for i in full]
        gone = set()
        for a in range(len(full)):
            for b in range(a, len(full)):
                if b - a >= 2 or sum(words[a:b + 1]) >= 50:
                    run = tuple(lines[i] for i in full[a:b + 1])
                    if run in seen:
                        gone |= set(full[a:b + 1])
                    seen.add(run)
        out.append(None if text is None else "\n".join(s for i, s in enumerate(lines) if i not in gone))
    return out


def test_line_dedup_matches_brute_force(spark, frame):
    rng = random.Random(19)
    rows = [(i, "\n".join(rng.choice(LINES) for _ in range(rng.randrange(1, 14)))) for i in range(150)]
    rows += [(i, "\n".join(f"line {rng.randrange(40)} " + "w " * rng.choice([0, 3, 20, 45, 60]) for _ in range(rng.randrange(1, 40))))
             for i in range(200, 230)]
    rows += [(300, None), (301, ""), (302, "long line\n" * 30), (-9, "alpha beta\ngamma\nkappa"), (-(1 << 63), "alpha beta\ngamma\neta")]
    rows.sort()
    got = {r.doc_id: r.text for r in L.line_dedup(frame(rows).repartition(7)).collect()}
    for (i, _), want in zip(rows, brute_lines(rows)):
        assert got[i] == want, i


def test_runs_are_extended_to_their_end(spark, frame):
    """60 + 20 + 20 words copied with another next line: all three lines go,
    though the last two are in no repeated window; also where an earlier copy
    ends after the first of them."""
    one, two, three = "a " * 60, "b " * 20, "c " * 20
    rows = [(1, f"{one}\nx"), (2, f"p\n{one}\n{two}\n{three}\nq"), (3, f"r\n{one}\n{two}\n{three}\ns"), (4, f"{two}\n{three}\nt")]
    got = {r.doc_id: (r.n_lines_removed, r.text) for r in L.line_dedup(frame(rows)).collect()}
    assert got[1][0] == 0 and got[2] == (1, f"p\n{two}\n{three}\nq") and got[3] == (3, "r\ns") and got[4][0] == 0


def test_line_dedup_of_texts_without_runs(spark, frame):
    rows = [(1, "one line"), (2, None), (3, ""), (4, "two\nlines")]
    got = {r.doc_id: (r.text, r.n_lines_removed) for r in L.line_dedup(frame(rows)).collect()}
    assert got == {i: (t, 0) for i, t in rows}


def test_winnowing_guarantees_a_shared_fingerprint():
    rng = random.Random(3)
    for _ in range(300):
        run = [f"{rng.choice('abcd')} " * rng.choice([1, 10, 30, 50]) for _ in range(rng.randint(1, 6))]
        if len(run) < 3 and sum(len(s.split()) for s in run) < 50:
            continue
        texts = ["\n".join([f"u{rng.random()}" for _ in range(rng.randint(0, 3))] + run + [f"v{rng.random()}" for _ in range(rng.randint(0, 3))])
                 for _ in range(2)]
        a, b = ({p for p, _ in L.fingerprints(t, 3, 50)} for t in texts)
        assert a & b


def test_winnowing_selects_few_lines():
    lines = [f"line number {i}" for i in range(4000)]
    found = L.fingerprints("\n".join(lines), 3, 50)
    assert 0.45 * len(lines) < len(found) < 0.55 * len(lines)
    assert sorted(r[0] for _, runs in found for r in runs) == list(range(len(lines) - 2))


def test_line_dedup_of_a_very_long_text(spark, frame):
    text = "\n".join(f"line {i % 70_000}" for i in range(140_000))
    row = L.line_dedup(frame([(1, text)])).first()
    assert row.n_lines_removed == 70_000 and row.text == "\n".join(f"line {i}" for i in range(70_000))


def brute_rules(text):
    t = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", t) if w]
    wins = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    hit = set()
    for i, w in enumerate(wins):
        if wins.count(w) > 1:
            hit |= set(range(i, i + 8))
    lines = [s for s in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", s)]
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(hit),
            n < 20 or 100 * len(hit) > 30 * n)


def test_quality_rules_match_brute_force(spark, frame):
    rng = random.Random(10)
    rows = [(i, " ".join(rng.choice(WORDS[:rng.randrange(2, 16)]) for _ in range(rng.randrange(0, 80)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "\x0b\n \t"), (103, "the\u00a0of " * 30), (104, "😀 #*$%&|<> the of and to " * 6),
             (105, "in. " * 5000), (106, prose(rng, 300) + "\n" + prose(rng, 5) + "\n\n"), (None, "the of " * 20),
             (107, "the of stone\n" * 12)]
    df = frame(rows)
    for c in ("words", "lines", "n_words", "kept", "ranked", "windows"):
        df = df.withColumn(c, F.lit(1))
    out = R.quality_rules(df).collect()
    got = sorted((r.doc_id or -1, (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed))
                 for r in out)
    assert got == sorted((i or -1, brute_rules(t)) for i, t in rows)
    assert all(r.kept == (not r.base_failed and not r.failed_rules) for r in out)
    assert R.quality_rules(df.limit(0)).count() == 0


def test_quality_rules_stay_native(spark, frame):
    plan = R.quality_rules(frame([(1, "a b")]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


@pytest.mark.parametrize("name", ["op4_warc", "op7_quality_rules", "op8_suffix_dedup", "op9_line_dedup"])
def test_queries_match_sql(spark, name):
    from qsig.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    rel = con.sql(ORACLE[name])
    want = sorted(str(sorted(dict(zip(rel.columns, r)).items())) for r in rel.fetchall())
    assert sorted(str(sorted(r.asDict().items())) for r in QUERIES[name](spark, sf).collect()) == want
