"""Mixing, WARC archives, decontamination, components and the pipeline."""

import random
import struct

import pytest
import zstandard
from pyspark.sql import functions as F

from qsig.llm import decontaminate as D
from qsig.llm import mixing as M
from qsig.llm import warc as W
from qsig.llm.components import connected_components

from .test_models import docs as prose_docs


# ------------------------------------------------------------------ mixing

def brute_schedule(share, slots):
    """Earliest deadline first, slot by slot, without using the period."""
    total = sum(share.values())
    done = dict.fromkeys(share, 0)
    out = []
    for t in range(slots):
        ready = [(-(-(done[k] + 1) * total // a), k) for k, a in share.items() if done[k] * total // a <= t]
        due, k = min(ready)
        assert due > t
        done[k] += 1
        out.append(k)
    return out


def test_period_is_pfair_and_repeats():
    rng = random.Random(1)
    for _ in range(20):
        weights = {f"s{i}": rng.random() ** 3 + 1e-6 for i in range(rng.randrange(1, 12))}
        share = M.shares(weights, 97)
        assert sum(share.values()) == 97 and min(share.values()) >= 1
        plan = M.period(share)
        whole = brute_schedule(share, 3 * 97)
        for k, a in share.items():
            assert [t for t, s in enumerate(whole) if s == k] == [97 * p + t for p in range(3) for t in plan[k]]
        for k, a in share.items():
            got = 0
            for t, s in enumerate(whole, 1):
                got += s == k
                assert abs(got - t * a / 97) < 1
    with pytest.raises(ValueError):
        M.shares({"a": 1, "b": 1}, 1)


def test_mix_places_every_row(spark, frame):
    rng = random.Random(2)
    rows = [(i, f"t{i}", rng.choice(["a"] * 6 + ["b", "b", "c"])) for i in range(700)]
    rows += [(900, "x", None), (901, None, None), (None, "y", "b"), (5, "t5", "a"), (5, "t5", "a")]
    df = frame(rows)
    for c in ("key", "slot", "range", "n", "share", "i", "block"):
        df = df.withColumn(c, F.lit("clash"))
    out = M.mix(df, block=4, resolution=50).collect()
    assert len(out) == len(rows)
    assert len({r.mix_rank for r in out}) == len(rows)          # every row has a place of its own
    per = {}
    for r in out:
        per.setdefault(r.source, []).append(r)
    share = M.shares({k: len(v) ** 0.5 for k, v in {("null" if s is None else f"={s}"): v for s, v in per.items()}.items()}, 50)
    plan = M.period(share)
    for s, mine in per.items():
        k = "null" if s is None else f"={s}"
        mine.sort(key=lambda r: r.mix_rank)
        for place, r in enumerate(mine):
            b = place // 4
            assert r.block == b and r.slot == b // share[k] * 50 + plan[k][b % share[k]]
    limit = max(r.slot for r in out if r.balanced) + 1
    for s, mine in per.items():
        k = "null" if s is None else f"={s}"
        for t in range(1, limit + 1):
            blocks = len({r.slot for r in mine if r.slot < t})
            assert abs(blocks - t * share[k] / 50) < 1
    assert M.mix(df.limit(0)).count() == 0


def test_mix_given_weights(spark, frame):
    rows = [(i, "t", "ab"[i % 2]) for i in range(40)] + [(100 + i, "t", "c") for i in range(5)]
    out = M.mix(frame(rows), weights={"a": 3, "b": 1, "gone": 4}, block=2, resolution=8).collect()
    assert all((r.slot is None) == (r.source == "c") and not (r.source == "c" and r.balanced) for r in out)
    first = sorted((r for r in out if r.slot is not None and r.slot < 8), key=lambda r: r.mix_rank)
    assert sum(r.source == "a" for r in first) == 12 and sum(r.source == "b" for r in first) == 4


def deviation(order, weights):
    """Largest distance in blocks to the target weights after any number of slots."""
    total, got, worst = sum(weights), [0] * len(weights), 0
    for t, k in enumerate(order, 1):
        got[k] += 1
        worst = max([worst, *(abs(g * total - t * w) for g, w in zip(got, weights))])
    return worst / total


@pytest.mark.parametrize("n", [20, 500, 1200])
def test_schedule_keeps_target_weights(n):
    """A source with a third of the weight, few and more than 1000 sources:
    below one block off after any number of slots, also from a kept state."""
    weights = {f"{i:04}": 1.0 for i in range(n - 1)} | {"hot": (n - 1) / 2}
    whole = M.whole_weights(weights)
    names, slots = sorted(whole), 6 * n
    assert [whole[k] / sum(whole.values()) for k in names] == [weights[k] / sum(weights.values()) for k in names]
    run = M.Schedule([whole[k] for k in names], [slots] * n)
    first = [run.step() for _ in range(slots // 2)]
    again = M.Schedule(run.weight, run.blocks, run.at, run.done)
    rows = first + [run.step() for _ in range(slots // 2)]
    assert rows[slots // 2:] == [again.step() for _ in range(slots // 2)]
    assert [r[2] for r in rows] == list(range(slots))
    assert deviation([r[0] for r in rows], run.weight) < 1


def test_mix_holds_exact_weights(spark, frame, monkeypatch):
    monkeypatch.setattr(M, "CHUNK", 50)
    weights = {"hot": 1 / 3} | {f"s{i}": 2 / 57 for i in range(19)}
    rows = [(i, "t", "hot") for i in range(2405)] + [(5000 + i, "t", f"s{i % 19}") for i in range(19 * 220)]
    out = M.mix(frame(rows), weights=weights, block=2).collect()
    assert len({r.mix_rank for r in out}) == len(rows) == len(out)
    held = {r.slot: r.source for r in out if r.balanced}
    assert sorted(held) == list(range(len(held))) and len(held) > 3000
    names = sorted(weights)
    assert deviation([names.index(held[t]) for t in range(len(held))], [weights[k] for k in names]) < 1
    for k in names:
        mine = sorted((r for r in out if r.source == k), key=lambda r: r.mix_rank)
        assert [r.block for r in mine] == [i // 2 for i in range(len(mine))]


def test_many_null_ids_are_spread(spark, frame):
    rows = [(None, "t", "a")] * 5000 + [(i, "t", "a") for i in range(5000)]
    out = M.mix(frame(rows).repartition(4), block=10).collect()
    assert sorted(r.mix_rank for r in out) == list(range(10_000))
    blocks = {r.block for r in out if r.doc_id is None}
    assert len(blocks) > 900                            # of 1,000: not one range of the order
    with pytest.raises(ValueError):
        M.mix(frame([(1, "t", "a"), (2, "t", "b")]), resolution=1).collect()


# -------------------------------------------------------------------- warc

def test_round_trip_gives_payloads_back(spark, scratch):
    html = ["<p>one</p>", "<p>one</p>", "", None, "é" * 10, "x\r\n\r\ny", "long " * 90_000] + [f"<i>{i}</i>" * 40 for i in range(60)]
    rows = [(i, f"http://h/{i}\r\nX: y é", h) for i, h in enumerate(html)] + [(None, None, "<p>one</p>"), (3, "u", None), (None, None, "only")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    for c in ("sha", "first", "n", "record_type", "path"):
        df = df.withColumn(c, F.lit("clash"))
    manifest = W.write_archives(df.repartition(3), f"{scratch}/arc", archive_bytes=4000)
    assert manifest.count() > 3
    out = W.read_archives(manifest, payloads=True).collect()
    assert len(out) == len(rows)
    first = {}
    for i, _, h in rows:
        key = (h or "").encode()
        if i is not None:
            first[key] = min(first.get(key, i), i)
    want = sorted((i is None, i or 0, len((h or "").encode()), W.digest((h or "").encode()),
                   "response" if i == first.get((h or "").encode()) else "revisit",
                   None if i == first.get((h or "").encode()) else first.get((h or "").encode())) for i, _, h in rows)
    got = sorted((r.page_id is None, r.page_id or 0, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in out)
    assert got == want
    by = {i: (h or "").encode() for i, _, h in rows}
    assert all(bytes(r.payload) == by[r.page_id] for r in out if r.record_type == "response")
    assert all(r.payload is None for r in out if r.record_type == "revisit")
    assert W.archive_round_trip(df.limit(0)).count() == 0


def archive(raws, words=b""):
    given = {"dict_data": zstandard.ZstdCompressionDict(words)} if words else {}
    press = zstandard.ZstdCompressor(**given)
    return W.dictionary_frame(words) + b"".join(press.compress(r) for r in raws)


def test_archive_uses_its_dictionary_and_one_frame_per_record():
    payloads = [f"<html><body>{i} some text that repeats in pages {i % 7}</body></html>".encode() for i in range(300)]
    words = zstandard.train_dictionary(1024, payloads).as_bytes()
    raws = [W.record(str(i), "http://h", p, W.digest(p), len(p), None) for i, p in enumerate(payloads)]
    data = archive(raws, words)
    assert list(W.records(data)) == raws
    with pytest.raises(Exception):
        list(W.records(W.dictionary_frame(b"") + data[8 + len(words):]))    # frames need the dictionary


def test_reader_rejects_damage():
    p = b"<p>x</p>"
    good = W.record("1", "http://h", p, W.digest(p), len(p), None)
    assert W.parse(good)["payload"] == p
    again = W.record("2", None, None, W.digest(p), len(p), "1")
    assert W.parse(again) == {"page_id": 2, "payload_bytes": 8, "payload_digest": W.digest(p), "record_type": "revisit",
                              "refers_to": 1, "payload": None}
    bad = [good.replace(b"WARC/1.1", b"WARC/9"), good.replace(b"<p>x", b"<p>y"), good[:-1], good + b"z",
           good.replace(b"WARC-Date", b"Date"), good.replace(b"X-Payload-Length: 8", b"X-Payload-Length: 9"),
           good.replace(b"Content-Length: ", b"Content-Length: 1"), again.replace(b"revisit\r", b"other\r"),
           again.replace(b"identical", b"other"), good.replace(b"urn:page:", b"urn:x:")]
    for raw in bad:
        with pytest.raises(ValueError):
            W.parse(raw)
    data = archive([good, again])
    for cut in (data[4:], data[:-3], struct.pack("<II", W.SKIPPABLE, 10**6) + data[8:], data + b"tail"):
        with pytest.raises(ValueError):
            list(W.records(cut))


def foreign(kind, block, *headers, version="WARC/1.0", rid="<urn:uuid:12345678-0000-4000-8000-0123456789ab>"):
    lines = [version, f"WARC-Type: {kind}", f"WARC-Record-ID: {rid}", "WARC-Date: 2020-02-02T02:02:02Z", *headers,
             f"Content-Length: {len(block)}"]
    return "\r\n".join([*lines, "", ""]).encode() + block + b"\r\n\r\n"


HTTP = b"HTTP/1.1 200 OK\r\nX: y\r\n\r\n"


def test_reader_takes_records_from_elsewhere():
    info = W.read_record(foreign("warcinfo", b"software: x\r\n", "content-type: application/warc-fields", version="WARC/1.1"))
    assert (info["record_type"], info["payload"], info["record_id"]) == ("warcinfo", b"software: x\r\n", "urn:uuid:12345678-0000-4000-8000-0123456789ab")
    body = b"<p>a\r\n\r\nb</p>"
    got = W.read_record(foreign("response", HTTP + body, "CONTENT-TYPE: application/http; msgtype=response", "Warc-Target-Uri:http://h/ a",
                                f"WARC-Payload-Digest: SHA1:{W.digest(body).lower()}", "WARC-Concurrent-To: <urn:uuid:a>",
                                "WARC-Concurrent-To: <urn:uuid:b>", "X-Folded: one\r\n\t two", rid="<http://x/1>"))
    assert got["payload"] == body and got["payload_digest"] == W.digest(body) and got["payload_bytes"] == len(body)
    assert got["uri"] == "http://h/ a" and ("X-Folded", "one two") in got["headers"] and got["record_id"] == "http://x/1"
    assert [v for n, v in got["headers"] if n == "WARC-Concurrent-To"] == ["<urn:uuid:a>", "<urn:uuid:b>"]
    again = W.read_record(foreign("revisit", HTTP, "WARC-Profile: http://netpreserve.org/warc/1.0/revisit/server-not-modified",
                                  "WARC-Refers-To: <urn:uuid:z>"))
    assert (again["payload"], again["payload_bytes"], again["payload_digest"], again["refers_to"]) == (None, None, None, "urn:uuid:z")
    for kind in ("request", "metadata", "resource", "conversion", "continuation", "x-own"):
        assert W.read_record(foreign(kind, b"abc"))["payload"] == b"abc"
    import hashlib
    assert W.read_record(foreign("resource", b"abc", f"WARC-Block-Digest: sha256:{hashlib.sha256(b'abc').hexdigest()}",
                                 "WARC-Payload-Digest: blake3:unknown"))["payload"] == b"abc"
    good = foreign("resource", b"abc")
    for bad in (good[:-1], good + b"x", good.replace(b"WARC/1.0", b"WARC/2.0"), good.replace(b"Content-Length: 3", b"Content-Length: 4"),
                good.replace(b"Content-Length: 3", b"Content-Length: x"), good.replace(b"WARC-Date", b"Other"), b"", b"WARC/1.0\r\n",
                good.replace(b"WARC-Date:", b"WARC-Date"), foreign("resource", b"abc", "WARC-Type: request"),
                foreign("resource", b"abc", f"WARC-Block-Digest: sha1:{W.digest(b'abd')}"), foreign("revisit", b""),
                foreign("resource", b"abc", f"WARC-Payload-Digest: sha1:{W.digest(b'abd')}"), good.replace(b"resource", b"\xff\xfe")):
        with pytest.raises(ValueError):
            W.read_record(bad)


@pytest.mark.parametrize("form", ["none", "raw", "trained", "compressed", "empty", "between"])
def test_reader_takes_any_dictionary(spark, scratch, form):
    bodies = [f"<html><body>{i} some text that repeats in pages {i % 7}</body></html>".encode() for i in range(300)]
    raws = [foreign("response", HTTP + b, "Content-Type: application/http", rid=f"<urn:uuid:{i}>") for i, b in enumerate(bodies)]
    words = {"raw": b"some text that repeats in pages " * 9}.get(form) or zstandard.train_dictionary(1024, bodies).as_bytes()
    press = zstandard.ZstdCompressor(**({} if form in ("none", "empty", "between") else {"dict_data": zstandard.ZstdCompressionDict(words)}))
    frames = [press.compress(r) for r in raws]
    lead = {"none": b"", "empty": W.dictionary_frame(b""), "between": b"",
            "compressed": W.dictionary_frame(zstandard.ZstdCompressor().compress(words))}.get(form, W.dictionary_frame(words))
    skipped = struct.pack("<II", 0x184D2A53, 3) + b"abc"
    data = lead + (skipped.join(frames) if form == "between" else b"".join(frames))
    assert list(W.records(data)) == raws
    for name in ("a", "b"):
        with open(f"{scratch}/{name}.warc.zst", "wb") as f:
            f.write(data)
    paths = spark.createDataFrame([(f"{scratch}/a.warc.zst", 1), (f"file:{scratch}/b.warc.zst", 2), (None, 3)], "path string, record int")
    rows = W.read_warc(paths, payloads=True).collect()
    assert len(rows) == 600 and all(bytes(r.payload) == bodies[r.record] and r.record_id == f"urn:uuid:{r.record}" for r in rows)
    assert W.read_warc(paths.limit(0)).count() == 0
    with open(f"{scratch}/none.warc.zst", "wb") as f:
        f.write(lead)
    assert W.read_warc(spark.createDataFrame([(f"{scratch}/none.warc.zst",)], "path string")).count() == 0


def test_reader_streams_an_archive(monkeypatch):
    """Frames and dictionaries cut anywhere by what a read returns."""
    rng = random.Random(4)
    monkeypatch.setattr(W, "READ_BYTES", 7)
    raws = [foreign("resource", bytes(rng.randrange(256) for _ in range(rng.randrange(200)))) for _ in range(40)]
    assert list(W.records(archive(raws, b"urn:uuid:12345678 WARC-Record-ID " * 8))) == raws


# ---------------------------------------------------------- decontamination

def brute_holds(text, probe, e):
    """Smallest edit distance of probe to any stretch of text is <= e."""
    prev = [0] * (len(text) + 1)
    for i, c in enumerate(probe, 1):
        cur = [i]
        for j, d in enumerate(text, 1):
            cur.append(min(prev[j - 1] + (c != d), prev[j] + 1, cur[-1] + 1))
        prev = cur
    return min(prev) <= e


def edited(rng, s, n):
    s = list(s)
    for _ in range(n):
        at = rng.randrange(len(s))
        kind = rng.randrange(3)
        if kind == 0:
            s[at] = rng.choice("qxz")
        elif kind == 1:
            del s[at]
        else:
            s.insert(at, rng.choice("qxz"))
    return "".join(s)


def test_search_equals_full_alignment():
    rng = random.Random(3)
    items = [(i, D.normal(" ".join(prose_docs(rng, 2, False))[:rng.randrange(60, 260)])) for i in range(6)]
    index = D.Index(items)
    for _ in range(60):
        item, raw = rng.choice(items)
        a = rng.randrange(max(1, len(raw) - 99))
        piece = edited(rng, raw[a:a + rng.randrange(60, 140)].decode(), rng.randrange(0, 9))
        text = D.normal(" ".join(prose_docs(rng, 1, False)) + " " + piece + " " + " ".join(prose_docs(rng, 1, False)))
        want = sorted({int(o) for p, o in zip(index.probes, index.owner) if brute_holds(text, p, D.budget(len(p)))})
        assert index.search(text) == want


def test_candidates_keep_every_probe_within_budget():
    """The filter alone loses nothing: probes at exactly the budget pass."""
    rng = random.Random(4)
    raw = D.normal(" ".join(prose_docs(rng, 3, False)))[:D.PROBE]
    index = D.Index([(1, raw)])
    for _ in range(200):
        piece = edited(rng, raw.decode(), D.budget(D.PROBE)).encode()
        text = b"z" * rng.randrange(0, 200) + piece + b"z" * rng.randrange(0, 50)
        assert index.search(text) == [1]


def test_passages_of_an_item_are_found():
    """Any stretch of PROBE + STRIDE - 1 bytes holds a whole probe."""
    rng = random.Random(14)
    raw = D.normal(" ".join(prose_docs(rng, 9, False)))[:400]
    index = D.Index([(1, raw)])
    size = D.PROBE + D.STRIDE - 1
    for a in range(len(raw) - size + 1):
        assert index.search(b"q" * (a % 7) + raw[a:a + size] + b"q") == [1]


def test_decontaminate_rows(spark, frame, monkeypatch):
    rng = random.Random(5)
    bench = [(i, " ".join(prose_docs(rng, 3, False))[:240]) for i in range(9)] + [(90, None), (None, "x" * 80), (91, "short one")]
    b = spark.createDataFrame(bench, "item_id bigint, text string").withColumn("items", F.lit(1))
    rows = [(1, "Before.\n" + bench[2][1].upper().replace(" ", "\n ") + " after"), (2, " ".join(prose_docs(rng, 2, False))), (3, None), (4, ""),
            (5, bench[0][1] + " and " + bench[7][1]), (5, "other"), (5, "other"), (None, bench[3][1]), (6, "short one"),
            (7, "w " * 30_000 + bench[4][1])]
    df = frame(rows)
    for c in ("items", "i", "h", "text_hash", "contaminated"):
        df = df.withColumn(c, F.lit("clash"))
    want = sorted([(1, [2]), (2, []), (3, []), (4, []), (5, [0, 7]), (5, []), (5, []), (-1, [3]), (6, []), (7, [4])])
    for block in (8 << 20, 500):                 # one block, and several
        monkeypatch.setattr(D, "BLOCK_BYTES", block)
        out = D.decontaminate(df, b).collect()
        assert sorted((-1 if r.doc_id is None else r.doc_id, r["items"]) for r in out) == want
        assert all(r.contaminated == (r.n_items > 0) for r in out)
    assert D.decontaminate(df, b.limit(0)).where("contaminated").count() == 0
    assert D.decontaminate(df.limit(0), b).count() == 0


def test_passages_of_a_probe_are_found():
    """Any stretch of PROBE bytes is found, also with edits within its budget."""
    rng = random.Random(24)
    raw = D.normal(" ".join(prose_docs(rng, 9, False)))[:300]
    index = D.Index([(1, raw), (2, raw[:60])])
    for a in range(len(raw) - D.PROBE + 1):
        piece = raw[a:a + D.PROBE]
        assert 1 in index.search(b"q" * (a % 7) + piece + b"q")
        assert 1 in index.search(b"z" * (a % 40) + edited(rng, piece.decode(), D.budget(D.PROBE)).encode() + b"z" * 9)
        assert index.search(piece[:50]) == []


def test_short_items_are_searched(spark, frame, scratch):
    """Items of 12 to 39 bytes by the lemma, shorter ones word for word; by
    the registered query and the pipeline's stage all of them."""
    import corpus_pipeline as P
    from qsig.llm.queries import QUERIES

    bench = [(1, "Which river is the longest one"), (2, "prime number"), (3, "Cat's"), (4, "什么是"), (5, " \n"), (6, "née")]
    rows = [(1, "Quiz: which  river is the longest ONE? Say so."), (2, "quiz: which river is the longestt one"),
            (3, "a prime number."), (4, "a prime numver."), (5, "the (cat's) bowl"), (6, "the bobcat's bowl, cat's_"), (7, "你好什么是爱"),
            (8, "Cat's"), (9, "journée"), (10, "NÉE Smith"), (11, ""), (12, None)]
    want = {1: [1], 2: [1], 3: [2], 5: [3], 7: [4], 8: [3], 10: [6]}
    df, b = frame(rows), spark.createDataFrame(bench, "item_id bigint, text string")
    assert {r.doc_id: r["items"] for r in D.decontaminate(df, b, min_item=1).collect()} == {i: want.get(i, []) for i, _ in rows}
    assert {r.doc_id for r in D.decontaminate(df, b).where("contaminated").collect()} == {1, 2, 3}
    df.write.parquet(f"{scratch}/documents.parquet")
    b.write.parquet(f"{scratch}/benchmark.parquet")
    assert {r.doc_id for r in QUERIES["op6_decontaminate"](spark, scratch).where("contaminated").collect()} == set(want)
    assert {r.doc_id for r in P.drop_leaks(spark, df, scratch).collect()} == {i for i, _ in rows} - set(want)


def test_short_documents_of_long_characters_are_searched(spark, frame):
    """14 characters, 42 bytes; 5 characters, 15 bytes; 8 bytes that grow in lower case."""
    texts = ["世界上最长的河流是哪一条江？", "最长的河流", "İİİİ", "x"]
    b = spark.createDataFrame(list(enumerate(texts)), "item_id bigint, text string")
    out = D.decontaminate(frame(list(enumerate(texts))), b)
    assert {r.doc_id: r["items"] for r in out.collect()} == {0: [0, 1], 1: [1], 2: [2], 3: []}


# ------------------------------------------------------- components, pipeline

def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(6)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 560)] + [(7, 7), (8, 9), (9, 8), (8, 9)]
    edges += [(rng.randrange(1000, 1060), rng.randrange(1000, 1060)) for _ in range(45)]
    rng.shuffle(edges)
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = root(a), root(b)
        parent[max(ra, rb)] = min(ra, rb)
    want = {x: root(x) for x in parent if x != 7}
    alone = {x for x in want if all(a == b for a, b in edges if x in (a, b))}
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {k: v for k, v in want.items() if k not in alone}
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_pipeline_stages(spark):
    import corpus_pipeline as P
    from qsig.llm.line_dedup import line_dedup
    from qsig.sources import io

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [n for n, _ in P.STAGES] == ["toxicity", "line_dedup", "simhash", "decontaminate", "mixing"]
    before = docs
    for name, stage in P.STAGES:
        after = io.stage(stage(spark, before, sf), name)
        ids = {r.doc_id for r in before.select("doc_id").collect()}
        kept = [r.doc_id for r in after.select("doc_id").collect()]
        assert len(kept) == len(set(kept)) and set(kept) <= ids, name
        if name != "mixing":
            assert after.columns == docs.columns
        if name == "line_dedup":
            want = {r.doc_id: r.text for r in line_dedup(before).collect()}
            assert {r.doc_id: r.text for r in after.collect()} == want
        elif name == "simhash":
            from qsig.llm.simhash import near_duplicates
            assert set(kept) == {r.component_id for r in near_duplicates(before).collect()}
        elif name == "decontaminate":
            index = D.Index([(r.item_id, D.normal(r.text)) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()])
            assert set(kept) == {r.doc_id for r in before.collect() if not index.search(D.normal(r.text))}
        elif name == "mixing":
            assert set(kept) == ids
        before = after
    assert before.count() > 100


def test_pipeline_filters_handle_odd_rows(spark, frame):
    import corpus_pipeline as P

    rows = [(1, None), (2, ""), (None, "a b c d e"), (4, "a b c d e"), (4, "a b c d e"), (5, "one two three four five six"), (5, "other text here")]
    df = frame(rows).withColumn("extra", F.lit(1)).withColumn("__llm_x", F.lit(2))
    kept = P.near_dedup(spark, df, "")
    assert kept.columns == df.columns
    assert sorted((r.doc_id, r.text or "") for r in kept.collect()) == [
        (1, ""), (4, "a b c d e"), (5, "one two three four five six"), (5, "other text here")]
    lines = P.dedup_lines(spark, df, "")
    assert lines.columns == df.columns and lines.count() == len(rows)
    leaks = P.drop_leaks(spark, df, "/root/testdata/sf0.001")
    assert leaks.columns == df.columns and leaks.count() == len(rows)
    assert P.mix_sources(spark, df, "").count() == len(rows)
    none = df.limit(0)
    for stage in (P.near_dedup, P.dedup_lines, P.mix_sources):
        assert stage(spark, none, "").count() == 0
    assert P.drop_leaks(spark, none, "/root/testdata/sf0.001").count() == 0


def test_pipeline_drops_toxic_and_leaking_rows_of_any_form(spark, frame):
    """Nulls, repeated rows, clashing columns and an empty table in the two
    stages that drop documents by their text."""
    import corpus_pipeline as P

    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    toxic = [r.doc_id for r in spark.read.parquet(f"{sf}/labels.parquet").where("toxic = 1").collect()]
    kept = {r.doc_id for r in P.drop_toxic(spark, docs, sf).select("doc_id").collect()}
    bad = [i for i in toxic if i not in kept][0]
    text = docs.where(F.col("doc_id") == bad).first().text
    item = spark.read.parquet(f"{sf}/benchmark.parquet").orderBy("item_id").first().text
    rows = [(None, None), (1, None), (2, ""), (3, text), (3, text), (None, text), (4, "A quiet walk along the river."),
            (4, "A quiet walk along the river."), (5, f"before {item} after"), (None, f"x {item}")]
    df = frame(rows)
    for c in ("score", "text_hash", "contaminated", "items", "segment", "with space"):
        df = df.withColumn(c, F.lit("clash"))
    calm = P.drop_toxic(spark, df, sf)
    assert calm.columns == df.columns
    assert sorted(map(str, ((r.doc_id, r.text) for r in calm.collect()))) == sorted(map(str, (x for x in rows if x[1] != text)))
    clean = P.drop_leaks(spark, df, sf)
    assert clean.columns == df.columns
    assert sorted(map(str, ((r.doc_id, r.text) for r in clean.collect()))) == sorted(map(str, (x for x in rows if item not in (x[1] or ""))))
    assert P.drop_toxic(spark, df.limit(0), sf).count() == 0


def test_near_dedup_picks_by_all_columns(spark, frame):
    """Rows of one id and text that differ elsewhere: always the same one
    stays, also without the usual columns."""
    import corpus_pipeline as P

    rows = [(1, "a b c d e", i % 3, f"x{i}") for i in range(30)]
    for k in (1, 4):
        df = spark.createDataFrame(rows, "doc_id bigint, text string, other int, `dot.ted` string").repartition(k)
        assert [tuple(r) for r in P.near_dedup(spark, df, "").collect()] == [(1, "a b c d e", 0, "x0")]
