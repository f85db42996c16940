"""Quality classifier: supervised subword embeddings.

Every token has a hashed vector for the whole word and for each of its
character n-grams; its vector is their mean, a document's vector the mean over
its tokens, and a softmax over two classes reads it.  A token that repeats the
one before it is replaced by one shared token (the hashed word bigram of a
repeated word), so that loops show whatever word they repeat.  Vectors and
output weights are learned together by numpy stochastic gradient descent on a
bounded sample of labelled documents.

The output is linear in the mean, so a fitted model needs one number per
distinct token; each task keeps a bounded memo of them.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qsig.llm.labelled import Sample

BUCKETS = 1 << 16
GRAMS = (2, 3, 4)
REPEAT = "\x00same"
LONGEST = 64            # a longer token is read in pieces of this many characters
MEMO = 400_000          # tokens remembered by a task
CHUNK_WORDS = 200_000   # tokens of the documents scored together


def tokens(text: str | None) -> list[str]:
    """Whitespace tokens of the whole text, repeats of the token before them
    replaced; tokens over ``LONGEST`` characters in pieces."""
    words = (text or "").split()
    if any(len(w) > LONGEST for w in words):
        words = [w[i:i + LONGEST] for w in words for i in range(0, len(w), LONGEST)]
    return words[:1] + [b if b != a else REPEAT for a, b in zip(words, words[1:])]


def _mix(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def buckets(words: list[str]) -> Iterator[tuple[list[int], np.ndarray]]:
    """(places in ``words``, hash buckets) for the words of each length: the
    whole word, then its character n-grams, word ends marked."""
    by: dict[int, list[int]] = {}
    for k, w in enumerate(words):
        by.setdefault(len(w), []).append(k)
    for length, where in by.items():
        for at in range(0, len(where), 8192):
            idx = where[at:at + 8192]
            cps = np.array([words[k] for k in idx], dtype=f"<U{length}").view(np.uint32).reshape(len(idx), length)
            framed = np.zeros((len(idx), length + 2), np.uint64)
            framed[:, 0], framed[:, -1] = 1 << 21, 1 << 22
            framed[:, 1:-1] = cps
            whole = np.zeros(len(idx), np.uint64)
            for j in range(length + 2):
                whole = _mix(whole + framed[:, j])
            found = [whole[:, None]]
            for n in GRAMS:
                if n <= length + 2:
                    h = np.full((len(idx), length + 3 - n), n, np.uint64)
                    for j in range(n):
                        h = _mix(h + framed[:, j:j + length + 3 - n])
                    found.append(h)
            yield idx, (np.hstack(found) % np.uint64(BUCKETS)).astype(np.int64)


@dataclass
class Model:
    weight: np.ndarray      # per bucket: embedding times (output of class 1 - output of class 0)
    bias: float

    def tokens(self, words: list[str]) -> list[float]:
        out = np.zeros(len(words))
        for idx, ids in buckets(words):
            out[idx] = self.weight[ids].mean(axis=1)
        return out.tolist()


def train(sample: Sample, dim: int = 16, epochs: int = 6, rate: float = 0.25, prior: float | None = None,
          seed: int = 7) -> Model:
    """Fit embeddings and softmax; ``prior`` is the share of label 1 that the
    scores are meant for (default: that of the sample).  With one label only,
    or none, every text scores that label (1 and 0) or one half."""
    y = np.array(sample.labels)
    if len(set(sample.labels)) < 2:
        return Model(np.zeros(BUCKETS), 0.0 if not len(y) else 50.0 * (2 * int(y[0]) - 1))
    rng = np.random.default_rng(seed)
    table = rng.uniform(-1 / dim, 1 / dim, (BUCKETS, dim))
    out = np.zeros((2, dim))
    bags = []
    for text in sample.texts:
        words = tokens(text)
        count = Counter(words)
        kinds, ids, share = list(count), [], []
        for idx, rows in buckets(kinds):
            ids.append(rows.reshape(-1))
            share.append(np.repeat([count[kinds[k]] / len(words) / rows.shape[1] for k in idx], rows.shape[1]))
        if not ids:
            bags.append((np.empty(0, np.int64), np.empty(0)))
            continue
        flat, at = np.unique(np.concatenate(ids), return_inverse=True)
        bags.append((flat, np.bincount(at, weights=np.concatenate(share))))
    balance = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    total, done = epochs * len(bags), 0
    for _ in range(epochs):
        for k in rng.permutation(len(bags)).tolist():
            ids, share = bags[k]
            step = rate * (1 - done / total)
            done += 1
            if not len(ids):
                continue
            hidden = share @ table[ids]
            z = out @ hidden
            p = np.exp(z - z.max())
            p /= p.sum()
            err = p.copy()
            err[y[k]] -= 1
            err *= balance[k]
            back = err @ out
            out -= step * np.outer(err, hidden)
            # the usual word-vector update: every row moves with its share, scaled up to full steps
            table[ids] -= step * len(ids) ** 0.5 * share[:, None] * back
    weight = table @ (out[1] - out[0])
    margin = np.array([s @ weight[i] if len(i) else 0.0 for i, s in bags])
    # logistic calibration of the margin at the wanted prior
    want = float(y.mean()) if prior is None else prior
    mass = np.where(y == 1, want / max(1, (y == 1).sum()), (1 - want) / max(1, (y == 0).sum()))
    z = np.stack([margin, np.ones(len(y))], axis=1)
    w = np.zeros(2)
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -50, 50)))
        hess = (z * (mass * p * (1 - p))[:, None]).T @ z + 1e-4 * np.eye(2)
        move = np.linalg.solve(hess, z.T @ (mass * (p - y)) + 1e-4 * w)
        w -= np.clip(move, -5, 5)
        if np.abs(move).max() < 1e-9:
            break
    return Model(weight * w[0], float(w[1]))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) per row of ``docs``: probability of label 1, over all
    tokens of the whole text.

    Null and empty texts score the bias alone (the prior).  Repeated rows
    score alike; an empty table gives an empty result; other columns are not
    read."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m, memo = shared.value, {}

        def margins(parts: list[list[str]]) -> list[float]:
            fresh = set().union(*parts)
            if len(memo) > MEMO:
                memo.clear()
            new = list(fresh.difference(memo))
            memo.update(zip(new, m.tokens(new)))
            return [m.bias + (sum(map(memo.__getitem__, words)) / len(words) if words else 0.0) for words in parts]

        for pdf in batches:
            margin, parts, size = [], [], 0
            for text in pdf.pop("text"):
                parts.append(tokens(text))
                size += len(parts[-1])
                if size > CHUNK_WORDS:
                    margin += margins(parts)
                    parts, size = [], 0
            margin += margins(parts)
            pdf["score"] = 1 / (1 + np.exp(-np.clip(np.array(margin, dtype=float), -50, 50)))
            yield pdf

    src = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return src.mapInPandas(run, "doc_id bigint, score double")
