"""Hand-rolled Lloyd k-means with the reference's stop rule (K1-K7).

Per iteration one Spark job over the persisted points:

* assign (K2): ``mapInPandas`` with the k×d centroid matrix broadcast
  (size checked against ``MAX_CENTROID_VALUES``); squared distances come
  from one BLAS product per Arrow batch, near-ties are re-checked with direct
  differences, and ``argmin`` keeps the lowest index on ties;
* update (K3/K4): every Arrow batch gives one (cluster, sum vector, count) row
  per cluster, added up by an aggregate, so points are never exploded; in the
  Lloyd loop the pass that assigns them does; a cluster with no points keeps
  its old centroid;
* only the new k×d centroids return to the driver, where the mean shift
  (K5) decides whether to stop (K6).

With few centroids each step starts from the persisted points and a fresh
broadcast, so lineage does not grow.  From ``BOUNDED_FROM`` centroids on, the
distances cost more than carrying numbers with the points, so every point
keeps its centroid, an upper bound of the distance to it and a lower bound of
the distance to any other (Hamerly).  Centroid moves widen the bounds; only
where they meet are distances computed again, first the one to the own
centroid, then all.  Bounds allow for rounding, and a point whose bounds are
apart has one nearest centroid, so the labels are those of computing all.
Every ``WRITE_EVERY`` steps the state is written, which cuts its lineage.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qsig.functions.hashing import uniform
from qsig.functions.vectors import distance  # noqa: F401  (re-exported column helper, K5)
from qsig.fixed import LLOYD_TOL
from qsig.sources.io import stage

MAX_CENTROID_VALUES = 50_000_000  # k·d doubles allowed in one broadcast (400 MB)
CHUNK_VALUES = 8_000_000          # doubles of a distance matrix held at once
BOUNDED_FROM = 128                # centroids from which points carry bounds
WRITE_EVERY = 10                  # steps between written states
SLACK = 1e-9                      # relative room for rounding where bounds move


def init_uniform(spark: SparkSession, k: int, dims: int, seed: int = 0, lo=0.0, hi=1.0) -> DataFrame:
    """K1: k centroids with each coordinate uniform in [lo, hi) (seeded md5 draws).

    ``lo``/``hi`` may be floats or per-dimension lists (e.g. the data's
    bounding box, see :func:`init_in_bounds`)."""
    los = lo if isinstance(lo, (list, tuple)) else [lo] * dims
    his = hi if isinstance(hi, (list, tuple)) else [hi] * dims
    lo_arr = F.array(*[F.lit(float(x)) for x in los])
    hi_arr = F.array(*[F.lit(float(x)) for x in his])
    coords = F.transform(F.sequence(F.lit(0), F.lit(dims - 1)), lambda j: F.get(lo_arr, j) + uniform(
        [F.col("id"), j], seed) * (F.get(hi_arr, j) - F.get(lo_arr, j)))
    return spark.range(k).select(F.col("id").cast("int").alias("category"), coords.alias("centroid"))


def bounds(points: DataFrame, col: str = "feature") -> DataFrame:
    """Per-dimension (pos, lo, hi) of the points (d rows; partial aggregate)."""
    return (points.select(F.posexplode(col).alias("pos", "x")).groupBy("pos")
            .agg(F.min("x").alias("lo"), F.max("x").alias("hi")))


def init_in_bounds(points: DataFrame, k: int, seed: int = 0, col: str = "feature") -> DataFrame:
    """K1 over the data's bounding box; the d-row bounds table is the only
    thing that reaches the driver."""
    b = sorted(bounds(points, col).collect(), key=lambda r: r["pos"])
    return init_uniform(points.sparkSession, k, len(b), seed, [r["lo"] for r in b], [r["hi"] for r in b])


def _matrix(centroids: DataFrame) -> np.ndarray:
    rows = centroids.select("category", "centroid").collect()
    k = max(r["category"] for r in rows) + 1 if rows else 0
    d = len(rows[0]["centroid"]) if rows else 0
    if k * d > MAX_CENTROID_VALUES:
        raise ValueError(f"{k}x{d} centroids exceed the broadcast bound {MAX_CENTROID_VALUES}")
    m = np.full((k, d), np.nan)
    for r in rows:
        m[r["category"]] = np.asarray(r["centroid"], dtype=np.float64)
    return m


def _nearest(p: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Index of the nearest row of ``c`` for each row of ``p`` (lowest index on ties).

    Squared distances come from one BLAS product (|p|² − 2 p·c + |c|²); a
    point whose best and second-best values are closer than that formula's
    rounding error bound is recomputed with direct differences, so the
    result equals the direct computation."""
    return _nearest_two(p, c)[0]


def _nearest_two(p: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``_nearest``, no less than the distance to it, and no more than the
    distance to any other."""
    near, upper, lower = np.empty(len(p), np.int32), np.empty(len(p)), np.empty(len(p))
    rows = max(1, CHUNK_VALUES // max(1, len(c)))
    for s in range(0, len(p), rows):
        near[s:s + rows], upper[s:s + rows], lower[s:s + rows] = _nearest_chunk(p[s:s + rows], c)
    return near, upper, lower


def _room(pn: np.ndarray, cn: float, d: int) -> np.ndarray:
    """Bound of the rounding error of a squared distance from norms."""
    return 8.0 * (d + 2) * np.finfo(np.float64).eps * (np.sqrt(pn) + np.sqrt(cn)) ** 2


def _nearest_chunk(p: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    k, d = c.shape
    cn = np.einsum("ij,ij->i", c, c)
    pn = np.einsum("ij,ij->i", p, p)
    d2 = pn[:, None] - 2.0 * (p @ c.T) + cn[None, :]
    d2[np.isnan(d2)] = np.inf
    best = np.argmin(d2, axis=1)
    lowest = d2[np.arange(len(p)), best]
    room = _room(pn, np.nanmax(cn), d)
    upper = np.sqrt(np.maximum(lowest, 0.0) + room)
    if k == 1:
        return best.astype(np.int32), upper, np.full(len(p), np.inf)
    d2[np.arange(len(p)), best] = np.inf
    second = d2.min(axis=1)
    unsure = np.nonzero(second - lowest <= room)[0]
    step = max(1, CHUNK_VALUES // max(1, k * d))
    for s in range(0, len(unsure), step):
        rows = unsure[s:s + step]
        exact = ((p[rows][:, None, :] - c[None, :, :]) ** 2).sum(axis=2)
        best[rows] = np.argmin(np.where(np.isnan(exact), np.inf, exact), axis=1)
    # where two are as near as rounding can tell, the bounds say nothing
    upper[unsure] = np.sqrt(np.maximum(second[unsure], 0.0) + 2 * room[unsure])
    return best.astype(np.int32), upper, np.sqrt(np.maximum(second - 2 * room, 0.0))


def _assign_fn(bc, col: str):
    def fn(it):
        c = bc.value
        for pdf in it:
            if pdf.empty:
                yield pdf.assign(category=pd.Series(dtype="int32"))
                continue
            p = np.vstack(pdf[col].to_numpy()).astype(np.float64)
            m = min(p.shape[1], c.shape[1])  # unequal lengths compare the common prefix, as zip does
            yield pdf.assign(category=_nearest(p[:, :m], c[:, :m]))
    return fn


def assign(points: DataFrame, centroids, col: str = "feature") -> DataFrame:
    """K2: adds ``category`` = index of the nearest centroid (Euclidean; lowest
    index wins ties).  ``centroids`` is a (category, centroid) DataFrame or a
    k×d numpy array."""
    m = centroids if isinstance(centroids, np.ndarray) else _matrix(centroids)
    if m.size > MAX_CENTROID_VALUES:
        raise ValueError("centroid matrix exceeds the broadcast bound")
    bc = points.sparkSession.sparkContext.broadcast(m)
    schema = T.StructType(points.schema.fields + [T.StructField("category", T.IntegerType(), False)])
    return points.mapInPandas(_assign_fn(bc, col), schema)


def _sums(batches, col: str, d: int):
    """(category, sum vector, count) per cluster of each batch of assigned
    points."""
    for pdf in batches:
        if pdf.empty:
            continue
        p, near = np.vstack(pdf[col].to_numpy()).astype(np.float64)[:, :d], pdf["category"].to_numpy()
        if p.shape[1] < d:
            raise ValueError(f"vectors shorter than the centroids ({p.shape[1]} of {d})")
        at, place = np.unique(near, return_inverse=True)
        sums = np.zeros((len(at), d))
        np.add.at(sums, place, p)
        yield pd.DataFrame({"category": at.astype(np.int32), "s": list(sums), "n": np.bincount(place)})


_PARTS = "category int, s array<double>, n bigint"


def _added(parts: DataFrame, d: int) -> DataFrame:
    """(category, n, s0 .. s(d-1)) of all batches."""
    return parts.groupBy("category").agg(F.sum("n").alias("n"), *[F.sum(F.get("s", F.lit(j))).alias(f"s{j}") for j in range(d)])


def update(assigned: DataFrame, centroids: DataFrame, col: str = "feature") -> DataFrame:
    """K3/K4: per-dimension mean of each cluster's members; a cluster without
    members keeps its previous centroid.  Returns (category, centroid).  Null
    vectors are no members; vectors shorter than the centroids raise."""
    d = centroids.agg(F.max(F.size("centroid"))).first()[0] or 0
    parts = assigned.where(F.col(col).isNotNull()).select("category", col).mapInPandas(lambda it: _sums(it, col, d), _PARTS)
    new = _added(parts, d).select("category", F.array(*[F.col(f"s{j}") / F.col("n") for j in range(d)]).cast("array<double>").alias("new"))
    return (centroids.join(new, "category", "left")
            .select("category", F.coalesce("new", "centroid").alias("centroid")))


def shift(old: DataFrame, new: DataFrame) -> DataFrame:
    """K5 per centroid: (category, shift) = Euclidean distance old → new."""
    o = old.select("category", F.col("centroid").alias("o"))
    n = new.select("category", F.col("centroid").alias("n"))
    return o.join(n, "category").select("category", distance("o", "n").alias("shift"))


def _means(added, old: np.ndarray) -> np.ndarray:
    new = old.copy()
    for r in added:
        new[r["category"]] = np.array(r[2:2 + old.shape[1]], dtype=np.float64) / r["n"]
    return new


def _step(points: DataFrame, old: np.ndarray, col: str) -> np.ndarray:
    """New k×d centroids after one pass over the points; k rows of sums reach
    the driver.  Clusters without points keep ``old``."""
    bc, d = points.sparkSession.sparkContext.broadcast(old), old.shape[1]

    def partial(it):
        yield from _sums(_assign_fn(bc, col)(it), col, d)

    return _means(_added(points.select(col).mapInPandas(partial, _PARTS), d).collect(), old)


class _Bounded:
    """Points with their centroid and bounds, from step to step."""

    def __init__(self, points: DataFrame, col: str, dims: int):
        self.col, self.dims, self.used, self.steps = col, dims, None, 0
        self.distances: list[int] = []                  # computed in each step
        self.state = points.select(col, F.lit(-1).alias("category"), F.lit(0.0).alias("upper"), F.lit(0.0).alias("lower"))
        self.held: DataFrame | None = None

    def step(self, c: np.ndarray) -> np.ndarray:
        moved = np.zeros(len(c)) if self.used is None else np.sqrt(((c - self.used) ** 2).sum(axis=1))
        bc = self.state.sparkSession.sparkContext.broadcast((c, moved, _half_gaps(c)))
        schema = T.StructType([*self.state.schema.fields[:4], T.StructField("made", T.LongType())])
        out = self.state.select(*self.state.columns[:4]).mapInPandas(_bound_fn(bc, self.col), schema)
        self.used, self.steps = c.copy(), self.steps + 1
        if self.steps % WRITE_EVERY == 0:
            out = stage(out, "kmeans-state")
            self.release()
        else:
            before, out = self.held, out.persist(StorageLevel.MEMORY_AND_DISK)
        sums = [F.sum(F.get(self.col, F.lit(j))).alias(f"s{j}") for j in range(self.dims)]
        rows = out.groupBy("category").agg(F.count(F.lit(1)).alias("n"), *sums, F.sum("made").alias("made")).collect()
        self.distances.append(sum(r["made"] for r in rows))
        if self.steps % WRITE_EVERY:
            if before is not None:
                before.unpersist()
            self.held = out
        self.state = out
        return _means(rows, c)

    def release(self) -> None:
        if self.held is not None:
            self.held.unpersist()
            self.held = None


def _half_gaps(c: np.ndarray) -> np.ndarray:
    """Half the distance from each centroid to the closest other one, no more
    than it is."""
    out = np.full(len(c), np.inf)
    step = max(1, CHUNK_VALUES // max(1, len(c)))
    norms = np.einsum("ij,ij->i", c, c)
    for s in range(0, len(c), step):
        d2 = norms[s:s + step, None] - 2.0 * (c[s:s + step] @ c.T) + norms[None, :]
        d2[np.arange(len(d2)), np.arange(s, s + len(d2))] = np.inf
        d2[np.isnan(d2)] = np.inf
        out[s:s + step] = np.sqrt(np.maximum(d2.min(axis=1) - _room(norms[s:s + step], np.nanmax(norms), c.shape[1]), 0.0)) / 2
    return out


def _bound_fn(bc, col: str):
    """Assigns a batch: a point stays where its bounds are apart; else the
    distance to its centroid is computed, and only where that is not enough
    all of them.  ``made`` counts the distances."""
    def fn(it):
        c, moved, half = bc.value
        most = np.argsort(-moved)[:2]
        for pdf in it:
            if pdf.empty:
                yield pdf.assign(made=pd.Series(dtype="int64"))
                continue
            p = np.vstack(pdf[col].to_numpy()).astype(np.float64)
            near, made = pdf["category"].to_numpy().copy(), np.zeros(len(p), np.int64)
            upper, lower = pdf["upper"].to_numpy().copy(), pdf["lower"].to_numpy().copy()
            known = near >= 0
            own = np.where(known, near, 0)
            upper = (upper + moved[own]) * (1 + SLACK)
            lower = (lower - np.where(own == most[0], moved[most[-1]], moved[most[0]])) * (1 - SLACK)
            apart = np.maximum(lower, half[own])
            test = np.flatnonzero(known & ~(upper < apart))
            if len(test):
                at, to = p[test], c[own[test]]
                room = _room(np.einsum("ij,ij->i", at, at), np.nanmax(np.einsum("ij,ij->i", c, c)), c.shape[1])
                upper[test] = np.sqrt(((at - to) ** 2).sum(axis=1) + room)
                made[test] += 1
            full = np.flatnonzero(~known | ~(upper < apart))
            if len(full):
                near[full], upper[full], lower[full] = _nearest_two(p[full], c)
                made[full] += len(c)
            yield pdf.assign(category=near.astype(np.int32), upper=upper, lower=lower, made=made)
    return fn


def lloyd(points: DataFrame, k: int, init: DataFrame | None = None, tol: float = LLOYD_TOL,
          max_iter: int = 1000, seed: int = 0, col: str = "feature", id_col: str = "query") -> DataFrame:
    """K6/K7: iterate until the mean centroid shift < ``tol``.

    Returns one row per point: (category, query, feature, cate_feature) where
    ``category`` is the last assignment (made with the centroids before the
    last update) and ``cate_feature`` that category's updated centroid — the
    reference's pairing.  Null vectors are dropped; mixed lengths raise, and
    so does a run that has not met ``tol`` after ``max_iter`` steps.
    """
    pts = points.where(F.col(col).isNotNull()).select(id_col, col)
    lens = pts.agg(F.min(F.size(col)).alias("a"), F.max(F.size(col)).alias("b")).first()
    if lens["a"] is not None and lens["a"] != lens["b"]:
        raise ValueError(f"vectors of different lengths ({lens['a']}..{lens['b']})")
    pts = pts.persist(StorageLevel.MEMORY_AND_DISK)
    bounded = None
    try:
        c = _matrix(init if init is not None else init_in_bounds(pts, k, seed, col))
        if lens["a"] is not None:
            c = c[:, :lens["a"]]
        if len(c) >= BOUNDED_FROM:
            bounded = _Bounded(pts, col, c.shape[1])
        for _ in range(max_iter):
            used, c = c, bounded.step(c) if bounded else _step(pts, c, col)
            if float(np.mean(np.sqrt(((c - used) ** 2).sum(axis=1)))) < tol:
                break
        else:
            raise RuntimeError(f"centroids still move by {tol} or more after {max_iter} steps")
        cdf = points.sparkSession.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(c)],
                                                  "category int, cate_feature array<double>")
        # lazy: after the points are released the result recomputes from the
        # source scan with the last broadcast centroids — same rows
        return assign(pts, used, col).join(F.broadcast(cdf), "category").select("category", id_col, col, "cate_feature")
    finally:
        if bounded:
            bounded.release()
        pts.unpersist()
