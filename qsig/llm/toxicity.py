"""Toxicity by a subsequence string-kernel SVM with Nystroem landmarks.

A sentence is judged by its segments: its tokens (long ones in overlapping
windows) and runs of single characters written apart.  Two segments are
compared by the gap-weighted subsequence kernel of length three: every
subsequence of three letters they share counts ``decay ** span``, so letters
pushed apart or inserted between the others lower the kernel without
destroying it.  Characters that are no letters only widen the span; digits and
signs that stand in for letters count as those.  The start of a segment counts
as a letter of its own.

Training (on a bounded sample, on the driver) is multiple-instance: all
segments of clean documents are negative; of toxic documents those are
positive that several of them have and no clean one, and, from the second
round on, the one of each that the SVM finds most toxic.  Landmark segments give
the Nystroem features, a linear SVM is fitted to them with the clean segments
nearest to the wrong side added in each round, and the margin is turned into a
probability on whole documents; the round that separates these best is kept.

Scoring: the landmark kernels of a fitted SVM sum into one weight per
three-letter subsequence, which is the same function and makes the cost per
segment independent of the number of landmarks.  Each task keeps a bounded
memo of segments already scored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qsig.llm.labelled import Sample

ALPHABET = 40           # 1-26 letters, 27 the start, 28-39 other letters and digits by code point; 0: no letter
WINDOW = 16             # longest segment; longer tokens are cut into windows overlapping by half
MEMO = 300_000          # segments remembered by a task
LOOKALIKE = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}
SPACED = re.compile(r"(?<!\S)\S(?:\s+\S){2,}(?!\S)")


def segments(text: str | None) -> set[str]:
    """Distinct segments of a text (null: none)."""
    low = (text or "").lower()
    out = set(low.split())
    for w in [w for w in out if len(w) > WINDOW]:
        out.discard(w)
        out.update(w[i:i + WINDOW] for i in range(0, len(w) - WINDOW // 2, WINDOW // 2))
    for run in SPACED.findall(low):
        run = "".join(run.split())
        out.update(run[i:i + WINDOW] for i in range(0, max(1, len(run) - WINDOW // 2), WINDOW // 2))
    return out


def _code_table() -> np.ndarray:
    table = np.zeros(0x250, dtype=np.int64)
    for cp in range(0x250):
        ch = chr(cp)
        ch = LOOKALIKE.get(ch, ch)
        if "a" <= ch <= "z":
            table[cp] = ord(ch) - 96
        elif ch.isalnum():
            table[cp] = 28 + cp % 12
    return table


def _codes(words: list[str], length: int, table: np.ndarray) -> np.ndarray:
    cps = np.array(words, dtype=f"<U{length}").view(np.uint32).reshape(len(words), length).astype(np.int64)
    wide = cps >= len(table)
    body = np.where(wide, 28 + cps % 12, table[np.where(wide, 0, cps)])
    return np.hstack([np.full((len(words), 1), 27), body])


def _self_kernel(c: np.ndarray, decay: float, n: int = 3) -> np.ndarray:
    """Gap-weighted subsequence kernel of each row with itself."""
    size, length = c.shape
    prior = np.ones((length + 1, length + 1, size))
    for _ in range(n - 1):
        cur = np.zeros((length + 1, length + 1, size))
        for i in range(1, length + 1):
            run = np.zeros(size)
            for j in range(1, length + 1):
                same = (c[:, i - 1] == c[:, j - 1]) & (c[:, i - 1] > 0)
                run = decay * run + decay * decay * same * prior[i - 1, j - 1]
                cur[i, j] = decay * cur[i - 1, j] + run
        prior = cur
    out = np.zeros(size)
    for i in range(1, length + 1):
        for j in range(1, length + 1):
            same = (c[:, i - 1] == c[:, j - 1]) & (c[:, i - 1] > 0)
            out += decay * decay * same * prior[i - 1, j - 1]
    return out


def apply_weights(words: list[str], weights: np.ndarray, decay: float, rows: np.ndarray | None = None) -> np.ndarray:
    """``<weights, phi(w)> / |phi(w)|`` for each word, phi being the explicit
    feature vector of the kernel.  ``weights`` has one column per function and
    a row per feature, or the rows that ``rows`` names for each feature;
    words without two letters give 0."""
    table = _code_table()
    out = np.zeros((len(words), weights.shape[1]), dtype=np.float64)
    by: dict[int, list[int]] = {}
    for k, w in enumerate(words):
        if len(w) >= 2:
            by.setdefault(len(w), []).append(k)
    for length, where in by.items():
        for at in range(0, len(where), 4096):
            idx = where[at:at + 4096]
            c = _codes([words[k] for k in idx], length, table)
            got = np.zeros((len(idx), weights.shape[1]))
            for i, j, k in combinations(range(length + 1), 3):
                f = (c[:, i] * ALPHABET + c[:, j]) * ALPHABET + c[:, k]
                real = ((c[:, i] > 0) & (c[:, j] > 0) & (c[:, k] > 0)) * decay ** (k - i + 1)
                got += weights[f if rows is None else rows[f]] * real[:, None]
            norm = np.sqrt(_self_kernel(c, decay))
            out[idx] = np.where(norm[:, None] > 0, got / np.maximum(norm, 1e-12)[:, None], 0.0)
    return out


def features(word: str, decay: float) -> tuple[np.ndarray, np.ndarray]:
    """Explicit, normalised feature vector of one segment: (features, values)."""
    if len(word) < 2:
        return np.empty(0, np.int64), np.empty(0)
    c = _codes([word], len(word), _code_table())[0]
    i, j, k = np.array(list(combinations(range(len(c)), 3))).T
    real = (c[i] > 0) & (c[j] > 0) & (c[k] > 0)
    which, at = np.unique(((c[i] * ALPHABET + c[j]) * ALPHABET + c[k])[real], return_inverse=True)
    value = np.bincount(at, weights=(decay ** (k - i + 1.0))[real], minlength=len(which))
    return which, value / max(np.linalg.norm(value), 1e-12)


@dataclass
class Model:
    weights: np.ndarray = field(repr=False)
    bias: float
    slope: float
    offset: float
    decay: float
    landmarks: list[str]

    def margins(self, words: list[str]) -> np.ndarray:
        return apply_weights(words, self.weights, self.decay)[:, 0] + self.bias

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -50, 50)))


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, reg: float = 1e-4, rounds: int = 40) -> np.ndarray:
    """Linear SVM with squared hinge loss by Newton steps on the rows inside
    the margin; last entry: bias."""
    x = np.hstack([x, np.ones((len(x), 1))])
    ridge = reg * np.eye(x.shape[1])
    ridge[-1, -1] = 1e-9
    w, before = np.zeros(x.shape[1]), None
    for _ in range(rounds):
        hit = y * (x @ w) < 1
        if before is not None and (hit == before).all():
            break
        before, xa = hit, x[hit] * weight[hit][:, None]
        w = np.linalg.solve(ridge + x[hit].T @ xa, xa.T @ y[hit])
    return w


def _unlike(parts: list[np.ndarray], rank: np.ndarray, keep: int = 8, shared: int = 4) -> list[np.ndarray]:
    """Documents without near copies of earlier ones: those that share
    ``shared`` of their ``keep`` segments of smallest hash (``rank``) go, so
    that a text copied often doesn't count its rare words often."""
    owners: dict[int, list[int]] = {}
    out = []
    for s in parts:
        low = s[np.argsort(rank[s], kind="stable")[:keep]].tolist()
        seen = Counter(o for h in low for o in owners.get(h, ()))
        if seen and max(seen.values()) >= min(shared, len(low)):
            continue
        for h in low:
            owners.setdefault(h, []).append(len(out))
        out.append(s)
    return out


def train(sample: Sample, landmarks: int = 320, decay: float = 0.5, rounds: int = 6, negatives: int = 8_000) -> Model:
    """Fit on labelled documents.  Without documents of both labels the model
    knows nothing and scores every text 0 (no toxic ones) or 1 (no clean ones)."""
    import zlib

    ids: dict[str, int] = {}                                # segments by number
    parts = [np.array(sorted(ids.setdefault(u, len(ids)) for u in sorted(segments(t))), dtype=np.int64)
             for t in sample.texts]
    names = list(ids)
    del ids
    rank = np.array([zlib.crc32(u.encode("utf-8", "surrogatepass")) for u in names], dtype=np.int64)
    toxic = _unlike([s for s, y in zip(parts, sample.labels) if y == 1], rank)
    clean = [s for s, y in zip(parts, sample.labels) if y == 0]
    nothing = np.zeros((ALPHABET ** 3, 1))
    if not toxic or not clean:
        return Model(nothing, 0.0, 1.0, 50.0 if toxic else -50.0, decay, [])
    in_clean, in_toxic = (np.bincount(np.concatenate(d), minlength=len(names)) for d in (clean, toxic))
    long_ = np.array([len(w) >= 2 for w in names])

    def best_first(at: np.ndarray, by: np.ndarray) -> list[int]:
        return sorted(at.tolist(), key=lambda u: (-by[u], names[u]))

    # first witnesses: segments of several toxic documents that no clean one has
    telling = (in_clean == 0) & (in_toxic > 0) & long_
    ordered = best_first(np.flatnonzero(telling), in_toxic)
    enough = max(2, len(toxic) // 100)
    seeds = {u: int(in_toxic[u]) for u in ordered if in_toxic[u] >= enough} or dict.fromkeys(ordered[:8], 1)
    common = best_first(np.flatnonzero((in_clean > 0) & long_), in_clean)
    if not seeds or not common:
        return Model(nothing, 0.0, 1.0, 0.0, decay, [])
    neg = list(dict.fromkeys(common[:negatives // 2] + common[negatives // 2::max(1, 2 * len(common) // negatives)]))
    truth = np.append(np.ones(len(toxic)), np.zeros(len(clean)))
    witnesses = [s[telling[s]] for s in toxic]
    pos, near, hard, best = dict(seeds), {}, [], None
    for _ in range(rounds):
        ranked = sorted(pos, key=lambda u: (-pos[u], names[u]))
        marks = list(dict.fromkeys(ranked[:landmarks // 2] + hard[:landmarks // 4] + common))[:landmarks]
        vectors = [features(names[u], decay) for u in marks]
        used = np.unique(np.concatenate([f for f, _ in vectors]))
        phi = np.zeros((len(used) + 1, len(marks)), np.float32)     # a row per feature of a landmark, and one for the rest
        for k, (f, v) in enumerate(vectors):
            phi[np.searchsorted(used, f), k] = v
        rows = np.full(ALPHABET ** 3, len(used), np.int32)
        rows[used] = np.arange(len(used))
        value, vector = np.linalg.eigh((phi.T @ phi).astype(np.float64))
        good = value > 1e-5
        half = vector[:, good] / np.sqrt(value[good])       # K_mm ** -1/2: the Nystroem map
        x = apply_weights([names[u] for u in ranked + neg], phi @ half.astype(np.float32), decay, rows)
        y = np.append(np.ones(len(ranked)), -np.ones(len(neg)))
        often = np.sqrt(in_clean[neg])
        closest = np.array([u in near for u in neg]) / max(1, len(near))
        weight = np.append(np.array([pos[u] for u in ranked]) / sum(pos.values()), often / often.sum() + closest)
        w = _svm(x, y, weight)
        del x
        model = Model(np.append(phi @ (half @ w[:-1]).astype(np.float32), 0)[np.minimum(rows, len(used) + 1)][:, None].astype(
            np.float64), float(w[-1]), 1.0, 0.0, decay, [names[u] for u in marks])
        margin = model.margins(names)
        top = np.array([margin[s].max() if len(s) else model.bias for s in toxic + clean])
        a, b = _logistic(top, truth)
        p = np.clip(1 / (1 + np.exp(-np.clip(a * top + b, -50, 50))), 1e-9, 1 - 1e-9)
        loss = -float(np.log(p[truth == 1]).mean() + np.log(1 - p[truth == 0]).mean())
        if best is None or loss < best[0]:
            best = loss, Model(model.weights, model.bias, a, b, decay, model.landmarks)
        # the clean segments nearest to the wrong side are negatives from now on
        hard = best_first(np.array(common), margin)[:negatives // 8]
        near.update(dict.fromkeys(hard))
        neg = list(dict.fromkeys(neg + hard))
        # of each toxic document, the most toxic of the segments that no clean one has is positive
        witness = Counter(int(s[margin[s].argmax()]) for s in witnesses if len(s))
        pos = {u: max(n, seeds.get(u, 0)) for u, n in (Counter(seeds) | witness).items() if n >= 2 or u in seeds}
    return best[1]


def _logistic(x: np.ndarray, y: np.ndarray, reg: float = 1e-3) -> tuple[float, float]:
    """One-variable logistic fit by Newton steps."""
    z = np.stack([x, np.ones(len(x))], axis=1)
    share = np.full(len(y), 1 / len(y))
    w = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -50, 50)))
        grad = z.T @ (share * (p - y)) + reg * w
        hess = (z * (share * p * (1 - p))[:, None]).T @ z + reg * np.eye(2)
        step = np.linalg.solve(hess, grad)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, text_hash, score) per row of ``docs``, over whole texts.

    The score of a document is that of its most toxic segment.  Null, empty
    and very short texts have the score of a segment without features.
    Repeated rows score alike; an empty table gives an empty result; other
    columns are not read."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m, memo = shared.value, {}
        for pdf in batches:
            texts = pdf.pop("text")
            out = np.empty(len(texts))
            for at in range(0, len(texts), 256):
                parts = [segments(t) for t in texts.iloc[at:at + 256]]
                if len(memo) > MEMO:
                    memo.clear()
                new = list(set().union(*parts).difference(memo))
                memo.update(zip(new, m.margins(new).tolist()))
                out[at:at + 256] = [max(map(memo.__getitem__, s), default=m.bias) for s in parts]
            pdf["score"] = m.probability(out)
            yield pdf

    src = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.col("text").cast("string").alias("text"))
    return src.mapInPandas(run, "doc_id bigint, text_hash bigint, score double")
