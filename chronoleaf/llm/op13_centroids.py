"""Exact centroid clustering (Lloyd's rounds over integer vectors) with Ptolemaic pivots.

A few vectors of the start are the pivots.  Every vector's distances to them
are computed once and written beside it.  In a round, the driver holds the
centroids and their distances to the pivots only (clusters x dimensions
numbers).  For a vector x, a centroid c and a pivot pair (p, s), Ptolemy's
inequality gives

    d(x, c) >= | d(x, p) d(c, s) - d(x, s) d(c, p) | / d(p, s) ;

the greatest bound over the fixed pairs counts (with the triangle inequality's
| d(x, p) - d(c, p) |, which needs one pivot only).  The bound is rounded down
by more than floats can err, so a centroid is left out only if it is surely
farther than the best one found.  The centroid of the least bound is measured
first; the survivors are then measured in 64-bit integers (in Python's where
those might not hold the numbers), ties going to the smaller number.

A round is one job over the written vectors: each task assigns its rows and
hands on one row for each cluster (count, exact componentwise sums as decimals);
Spark adds them up, and the driver reads one row for each cluster.  Nothing
else is gathered, no vector is shuffled, and a lost task reads its file again.

Defined results: vectors that are null, of another length than ``dim``, or
with a null or non-finite component are left out; rows with one id are vectors
each; a null id takes part but comes last as a start; equal starting hashes go
by the vectors' components; fewer kept vectors than clusters give as many
centroids as vectors; an empty table gives no rows; components beyond the long
range saturate; a squared distance beyond it raises; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from decimal import Decimal
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoleaf.llm.common import table
from chronoleaf.session import materialize

DIM, CLUSTERS, ROUNDS = 64, 8, 10
SCALE, SEED = 1024.0, 3
PIVOTS = 6
_SLACK = 2.0 ** -44       # of a bound's terms: far above the error of the few float steps behind it


def kept_vectors(df: DataFrame, id_col: str, vec_col: str, dim: int, scale: float) -> DataFrame:
    """id and v (array<bigint>, floor(scale * x)) of the vectors that take part."""
    whole = F.forall(F.col(vec_col), lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                     & (F.abs(x.cast("double")) < float("inf")))
    v = F.transform(F.col(vec_col), lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))
    return (df.where(F.col(vec_col).isNotNull() & (F.size(vec_col) == dim)).where(whole)
            .select(F.col(id_col).cast("long").alias("id"), v.alias("v")))


def _size(x: np.ndarray) -> int:
    return max(int(x.max()), -int(x.min())) if x.size else 0


def exact_squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of ``x`` to ``c`` (one vector, or one for each row), exactly."""
    high = _size(x) + _size(c)
    if high * high * max(1, x.shape[1]) >= 2 ** 62:
        away = x.astype(object) - c.astype(object)
        return (away * away).sum(axis=1)
    away = x - c
    return np.einsum("ij,ij->i", away, away)


def distances(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Distances to each of ``points`` as floats; the square root is the only rounded step but for giant numbers."""
    return np.stack([np.sqrt(exact_squares(x, p).astype(float)) for p in points], axis=1)


def lower_bounds(near: np.ndarray, far: np.ndarray, between: np.ndarray) -> np.ndarray:
    """(rows, centroids): lower bounds of the distances, never above the true ones.
    ``near``: rows x pivots, ``far``: centroids x pivots, ``between``: pivots x pivots."""
    low = np.zeros((len(near), len(far)))
    for p in range(near.shape[1]):
        a, b = near[:, p, None], far[None, :, p]
        np.maximum(low, np.abs(a - b) - _SLACK * (a + b), out=low)
    for p, s in combinations(range(near.shape[1]), 2):
        if between[p, s] > 0:
            a, b = near[:, p, None] * far[None, :, s], near[:, s, None] * far[None, :, p]
            np.maximum(low, (np.abs(a - b) - _SLACK * (a + b)) / between[p, s] * (1 - _SLACK), out=low)
    return low


def nearest(x: np.ndarray, near: np.ndarray, centroids: np.ndarray, far: np.ndarray,
            between: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The nearest centroid of every row (ties: the smaller number), its squared distance, and how many were measured."""
    low = lower_bounds(near, far, between)
    low *= low * (1 - _SLACK)
    own = low.argmin(axis=1)
    best = exact_squares(x, centroids[own])
    measured = len(x)
    limit = best.astype(float) * (1 + _SLACK)
    open_ = low <= limit[:, None]
    open_[np.arange(len(x)), own] = False
    for c in range(len(centroids)):
        rows = np.flatnonzero(open_[:, c] & (low[:, c] <= limit))     # others may have come nearer meanwhile
        if not len(rows):
            continue
        d = exact_squares(x[rows], centroids[c])
        measured += len(rows)
        nearer = (d < best[rows]) | ((d == best[rows]) & (c < own[rows]))
        to = rows[nearer]
        best = best.astype(object) if d.dtype == object else best
        best[to], own[to] = d[nearer], c
        limit[to] = best[to].astype(float) * (1 + _SLACK)
    return own, best, measured


def _rows(col: pd.Series, kind: str, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(col), kind).reshape(-1, width)


class _Centroids:
    """What a task needs to know of one round: a few numbers for each cluster."""

    def __init__(self, centroids: np.ndarray, pivots: np.ndarray):
        self.at = centroids
        self.far = distances(centroids, pivots)
        self.between = distances(pivots, pivots)
        self.dim, self.pivots = centroids.shape[1], len(pivots)

    def assign(self, pdf: pd.DataFrame):
        x = _rows(pdf["x"], "<i8", self.dim)
        return x, *nearest(x, _rows(pdf["near"], "<f8", self.pivots), self.at, self.far, self.between)


def _starts(vectors: DataFrame, clusters: int, seed: int) -> np.ndarray:
    """The ``clusters`` vectors with the least hashes of their ids; Spark keeps that many rows of each task."""
    ranked = vectors.withColumn("hash", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256))
    first = ranked.orderBy(F.col("hash").asc_nulls_last(), "v").limit(clusters).select("v").collect()
    return np.array([r.v for r in first], np.int64)


def _with_pivots(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """id, x (packed long), near (packed double: distances to the pivots), written once."""

    def measure(batches):
        for pdf in batches:
            if len(pdf):
                x = np.array(pdf["v"].tolist(), np.int64)
                near = distances(x, pivots)
                yield pd.DataFrame({"id": pdf["id"], "x": [r.tobytes() for r in x], "near": [r.tobytes() for r in near]})

    return materialize(vectors.mapInPandas(measure, "id long, x binary, near binary"), "centroid-pivots")


def _moved(vectors: DataFrame, now: _Centroids) -> np.ndarray:
    """The next centroids: floor(sum / count) of each cluster's vectors; an empty one stays."""

    def assign(batches):
        count, total = np.zeros(len(now.at), np.int64), np.zeros(now.at.shape, object)
        for pdf in batches:
            if not len(pdf):
                continue
            x, own, _, _ = now.assign(pdf)
            count += np.bincount(own, minlength=len(count))
            wide = _size(x) * len(x) >= 2 ** 62
            for c in np.unique(own):
                total[c] += (x[own == c].astype(object) if wide else x[own == c]).sum(axis=0).astype(object)
        hit = np.flatnonzero(count)
        yield pd.DataFrame({"cluster": hit.astype(np.int32), "n": count[hit],
                            "total": [[Decimal(int(v)) for v in total[c]] for c in hit]})

    parts = vectors.mapInPandas(assign, "cluster int, n long, total array<decimal(38,0)>")
    sums = parts.groupBy("cluster").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.col("total")[i]) for i in range(now.dim)]).alias("total"))
    after = now.at.copy()
    for r in sums.collect():                              # one row for each cluster
        after[r.cluster] = [int(t) // r.n for t in r.total]
    return after


def cluster(vectors: DataFrame, clusters: int, rounds: int, seed: int, pivots: int = PIVOTS) -> tuple[DataFrame, np.ndarray]:
    """(id, cluster, distance of every row of ``vectors``, written; the final centroids).
    ``vectors``: id long, v array<bigint>, all of one length (see kept_vectors())."""
    start = _starts(vectors, clusters, seed)
    if not len(start):
        return vectors.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")).limit(0), start
    fixed = start[:pivots]
    placed = _with_pivots(vectors, fixed)
    at = start
    for _ in range(rounds):
        after = _moved(placed, _Centroids(at, fixed))
        if (after == at).all():                           # a fixed point: further rounds change nothing
            break
        at = after
    last = _Centroids(at, fixed)

    def assign(batches):
        for pdf in batches:
            if len(pdf):
                _, own, best, _ = last.assign(pdf)
                yield pd.DataFrame({"id": pdf["id"], "cluster": own.astype(np.int32), "distance": best.astype(np.int64)})

    return materialize(placed.mapInPandas(assign, "id long, cluster int, distance long"), "centroid-members"), at


def with_inertia(members: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Adds cluster_inertia, inertia and centroid_sha256; the joined side has a row for each cluster."""
    spark = members.sparkSession
    per = members.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).collect()   # one row a cluster
    digest = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    facts = spark.createDataFrame(
        [(r.cluster, r.cluster_inertia, sum(p.cluster_inertia for p in per), digest[r.cluster]) for r in per],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return members.join(F.broadcast(facts), "cluster")


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = kept_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", DIM, SCALE)
    members, centroids = cluster(vectors, CLUSTERS, ROUNDS, SEED)
    return with_inertia(members, centroids).select(
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _sql() -> str:
    """The rounds written out one after the other: a step of assignment, a step of means."""
    near = """a{0} AS MATERIALIZED (
  SELECT row, vec_id, v, arg_min(c, d) AS c, min(d.s) AS distance FROM (
    SELECT v.row, v.vec_id, v.v, m.c, {{'s': CAST(list_sum([(v.v[i] - m.v[i]) * (v.v[i] - m.v[i]) for i in range(1, 65)]) AS BIGINT), 'c': m.c}} AS d
    FROM v, m{0} m) GROUP BY row, vec_id, v)"""
    mean = """m{1} AS MATERIALIZED (
  SELECT m.c, coalesce(n.v, m.v) AS v FROM m{0} m LEFT JOIN (
    SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS v FROM (
      SELECT c, i, sum(CAST(v[i] AS HUGEINT)) AS s, CAST(count(*) AS HUGEINT) AS n
      FROM a{0}, (SELECT unnest(range(1, 65)) AS i) GROUP BY c, i) GROUP BY c) n USING (c))"""
    steps = [part for r in range(ROUNDS) for part in (near.format(r), mean.format(r, r + 1))]
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) = 64
    AND len([x for x in embedding if x IS NULL OR isnan(x) OR isinf(x)]) = 0
), m0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY sha256('{SEED}:' || CAST(vec_id AS VARCHAR)) NULLS LAST, v) - 1 AS INTEGER) AS c, v
  FROM v QUALIFY c < {CLUSTERS}
), {", ".join([*steps, near.format(ROUNDS)])}
SELECT a.vec_id, a.c AS cluster, a.distance,
  CAST(sum(a.distance) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(a.distance) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(m.v, ',')) AS centroid_sha256
FROM a{ROUNDS} a JOIN m{ROUNDS} m USING (c)
"""


OP13_SQL = _sql()
