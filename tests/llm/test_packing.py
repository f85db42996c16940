"""Best-fit packing against the tokenizer itself and a plain best fit."""

import math
import random
import zlib

import numpy as np
import pytest

from qsig.llm import best_fit as B
from qsig.llm.queries import op11_best_fit

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def encoder():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def expected(encoder, docs, length, end=2):
    """Pieces by definition: (doc_id, piece, start, length, crc), sorted."""
    out = []
    for doc, text in docs:
        ids = encoder.encode(text or "", add_special_tokens=False).ids + [end]
        head = len(ids) - (math.ceil(len(ids) / length) - 1) * length
        at = [0, *range(head, len(ids) + 1, length)]
        for k, (a, b) in enumerate(zip(at, at[1:])):
            out.append((doc, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    return sorted(out, key=repr)


def check(rows, encoder, docs, length):
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows]
    assert sorted(got, key=repr) == expected(encoder, docs, length)
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= length
    return len(bins), math.ceil(sum(r.length for r in rows) / length)


def plain_best_fit(sizes, length, most):
    """Bins by search through all open ones."""
    open_, closed = [], 0
    for size in sizes:
        fits = [f for f in open_ if f >= size]
        if fits:
            free = min(fits)
            open_.remove(free)
        else:
            if len(open_) == most:
                open_.remove(min(open_))
                closed += 1
            free = length
        if free == size:
            closed += 1
        else:
            open_.append(free - size)
    return closed, sorted(open_)


@pytest.mark.parametrize("most", [1, 2, 7, 1000])
def test_bitset_finds_the_fullest_bin(most):
    rng = random.Random(most)
    sizes = [rng.randint(1, 64) for _ in range(2000)]
    closed = []
    bins = B.OpenBins(64, most, closed.append)
    for s in sizes:
        bins.put(s, s)
        assert bins.n <= most
    assert all(sum(item for _, item in b) <= 64 for b in closed)
    free = sorted(64 - sum(item for _, item in b) for b in bins.rest())
    assert (len(closed), free) == plain_best_fit(sizes, 64, most)


ODD = ["", None, " ", "  a  b ", "a\n\nb", "<|endoftext|> a b<|endoftext|>", "a\x85b\x1cc \x1d", "don't we'll 's don'th 'store, x'se",
       "日本 語　x", "​ a᠎b", "é́ ﷺ 🤦🏼‍♂️ z", "café, naïveº ªb Ωx ñ1 a1b2 x_y", "x" * 5000, "a " * 5000]


def test_ids_of_segments_are_the_texts_ids(encoder):
    words = B.WordIds(PATH, most=50)
    parts = ["a", "B", " ", "  ", "'", "s", "t", "\n", "\t", ",", "1", "é", "日", "\xa0", "-", "ll", "re", "́", "_", "\x1c", "ß"]
    rng = random.Random(3)
    texts = [t or "" for t in ODD] + ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    for text, ids in zip(texts, words.texts(texts), strict=True):
        assert ids.tolist() == encoder.encode(text, add_special_tokens=False).ids, text


def test_long_texts_are_tokenised_in_blocks(encoder, monkeypatch):
    monkeypatch.setattr(B, "BLOCK_CHARS", 100)
    rng = random.Random(4)
    texts = ["".join(rng.choice(["word", " ", "\n", " of ", ", ", "x1", "é"]) for _ in range(n)) for n in (4, 4000, 0, 9, 30, 500, 1)]
    for text, ids in zip(texts, B.WordIds(PATH).texts(texts), strict=True):
        assert ids.tolist() == encoder.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("length,open_bins", [(16, 4), (64, 1), (1024, 2048)])
def test_packing_of_odd_rows(spark, frame, encoder, length, open_bins):
    rng = random.Random(7)
    docs = [(i, t) for i, t in enumerate(ODD)] + [(None, "no id"), (None, None), (3, "again"), (3, "again"), (-(1 << 63), "least")]
    docs += [(1000 + i, "word " * rng.randint(0, 60)) for i in range(300)] + [((1 << 62) + 1, "large id")]
    clash = frame(docs).selectExpr("*", "1 AS piece", "'x' AS sequence_id", "2 AS offset", "3 AS length").repartition(5)
    rows = B.pack(clash, PATH, length, open_bins=open_bins).collect()
    check(rows, encoder, docs, length)


def test_leftovers_of_tasks_meet_once_more(spark, frame, encoder):
    docs = [(i, "word " * 8) for i in range(640)]                   # nine ids each
    few, least = check(B.pack(frame(docs).repartition(64), PATH, 1024).collect(), encoder, docs, 1024)
    assert few == least                                             # alone, 64 tasks would leave 64 sequences


def test_packing_is_tight_on_the_table(spark, encoder):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    n, least = check(op11_best_fit(spark, sf).collect(), encoder, docs, 1024)
    assert n <= least * 1.02 + 1


def test_empty_table(spark, frame):
    out = B.pack(frame([]), PATH)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and out.count() == 0
