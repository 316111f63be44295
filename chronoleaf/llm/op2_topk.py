"""Exact top-k inner-product search: a ball tree per shard, searched by branch and bound.

Candidates are dealt into shards of a bounded number of rows by a hash of their
id; each shard's vectors become one ball tree (one row of the tree table).
Queries are dealt into blocks of a bounded size.  A task searches one block
over a bounded run of shards: trees, and the two children of a node, are taken
in the order of their upper bound  q.c + |q| r , and a branch is cut when its
bound cannot reach the query's current k-th score.  That score is shared: it is
carried from shard to shard inside a task, and a first round over each block's
home shards hands its k-th score to the tasks of the second round, which search
all other shards.

Scores are integers, computed exactly; bounds are floats with a margin.

Defined results: vectors that are null, or hold a null or non-finite
component, and rows with null id take no part; of rows with one id the least
vector (by components) stays; vectors are compared with those of the same
length only; ties go to the smaller id; fewer than k candidates give fewer
rows; components beyond the long range saturate, and a score beyond the long
range raises.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoleaf.llm.common import shuffle_partitions, table
from chronoleaf.session import materialize

SHARD_ROWS = 4096      # vectors in one ball tree
RUN_SHARDS = 4         # trees that one search task reads
BLOCK_QUERIES = 2048   # queries in one block; trees are sent once for each block
LEAF_ROWS = 512
_NONE = np.iinfo(np.int64).min


class BallTree:
    """Balls over integer vectors.  Node i: centre, radius, children (-1: leaf) and the rows [lo, hi) it holds."""

    PARTS = {"ids": "<i8", "x": "<i8", "centre": "<f8", "radius": "<f8", "child": "<i4", "rows": "<i4"}

    def __init__(self, **parts: np.ndarray):
        self.__dict__.update(parts)
        self.high = _largest(self.x)
        self.xf = self.x.astype(float)

    @classmethod
    def grown(cls, ids: np.ndarray, x: np.ndarray) -> BallTree:
        order = np.argsort(ids, kind="stable")
        centre, radius, child, rows = [], [], [], []

        def grow(lo: int, hi: int) -> int:
            pts = x[order[lo:hi]].astype(float)
            mid = pts.mean(axis=0)
            away = np.sqrt(((pts - mid) ** 2).sum(axis=1))
            at = len(centre)
            centre.append(mid)
            radius.append(away.max())
            child.append((-1, -1))
            rows.append((lo, hi))
            if hi - lo > LEAF_ROWS and away.max() > 0:
                a = pts[away.argmax()]                   # two far points give the direction of the cut
                b = pts[((pts - a) ** 2).sum(axis=1).argmax()]
                half = (hi - lo) // 2
                order[lo:hi] = order[lo:hi][np.argpartition(pts @ (b - a), half)]
                child[at] = (grow(lo, lo + half), grow(lo + half, hi))
            return at

        grow(0, len(ids))
        return cls(ids=ids[order], x=x[order], centre=np.array(centre), radius=np.array(radius),
                   child=np.array(child), rows=np.array(rows))

    def packed(self) -> dict[str, bytes]:
        return {k: np.ascontiguousarray(getattr(self, k), t).tobytes() for k, t in self.PARTS.items()}

    @classmethod
    def unpacked(cls, dim: int, row) -> BallTree:
        parts = {k: np.frombuffer(getattr(row, k), t) for k, t in cls.PARTS.items()}
        n, m = len(parts["ids"]), len(parts["radius"])
        return cls(**parts | {"x": parts["x"].reshape(n, dim), "centre": parts["centre"].reshape(m, dim),
                              "child": parts["child"].reshape(m, 2), "rows": parts["rows"].reshape(m, 2)})


class TopK:
    """The best k scores of a block of queries, ties to smaller ids."""

    def __init__(self, ids: np.ndarray, q: np.ndarray, k: int, floor: np.ndarray):
        self.qid, self.q, self.k = ids, q, k
        self.qf, self.high = q.astype(float), _largest(q)
        self.norm = np.sqrt((self.qf ** 2).sum(axis=1))
        self.floor = floor                               # shared k-th scores known so far
        self.score = np.full((len(ids), k), _NONE, np.int64)
        self.id = np.full((len(ids), k), np.iinfo(np.int64).max, np.int64)

    def bound(self, tree: BallTree, at: int, who: np.ndarray) -> np.ndarray:
        up = self.qf[who] @ tree.centre[at] + self.norm[who] * tree.radius[at]
        size = np.abs(tree.centre[at]).sum() + tree.radius[at]
        return up + self.norm[who] * size * 1e-9 + 0.5   # no rounding of floats may cut a branch

    def search(self, tree: BallTree, at: int, who: np.ndarray) -> None:
        who = who[self.bound(tree, at, who) >= np.maximum(self.floor[who], self.score[who, -1])]
        if not len(who):
            return
        left, right = tree.child[at]
        if left < 0:
            return self._leaf(tree, slice(*tree.rows[at]), who)
        first = self.bound(tree, left, who) >= self.bound(tree, right, who)
        for a, b, own in ((left, right, who[first]), (right, left, who[~first])):
            if len(own):
                self.search(tree, a, own)
                self.search(tree, b, own)

    def _leaf(self, tree: BallTree, rows: slice, who: np.ndarray) -> None:
        s = self._products(tree, rows, who)
        ids, k = tree.ids[rows], self.k
        s[ids[None, :] == self.qid[who][:, None]] = _NONE
        least = np.maximum(self.score[who, -1], self.floor[who])        # what a score must reach
        if s.shape[1] > k:
            least = np.maximum(least, np.partition(s, -k, axis=1)[:, -k])
        good = (s >= least[:, None]) & (s > _NONE)
        hit = np.flatnonzero(good.any(axis=1))
        if not len(hit):
            return
        row, col = np.nonzero(good[hit])                                # about k of a row, and ties
        who, s = who[hit], s[hit]
        row = np.concatenate([row, np.repeat(np.arange(len(hit)), k)])
        score = np.concatenate([s[row[:len(col)], col], self.score[who].ravel()])
        ids = np.concatenate([ids[col], self.id[who].ravel()])
        order = np.lexsort((ids, ~score, row))                          # ~score falls as score rises, without overflow
        row = row[order]
        best = order[np.arange(len(row)) - np.searchsorted(row, row) < k]
        self.score[who] = score[best].reshape(-1, k)
        self.id[who] = ids[best].reshape(-1, k)

    def _products(self, tree: BallTree, rows: slice, who: np.ndarray) -> np.ndarray:
        """Exact inner products; Python integers where 64 bits might not hold them."""
        q = self.q[who]
        high = self.high * tree.high * max(1, q.shape[1])
        if high < 2 ** 52:
            return np.rint(self.qf[who] @ tree.xf[rows].T).astype(np.int64)
        x = tree.x[rows]
        return (q.astype(object) @ x.T.astype(object)).astype(np.int64) if high >= 2 ** 62 else q @ x.T


def _largest(x: np.ndarray) -> int:
    return max(int(x.max()), -int(x.min())) if x.size else 0


def quantized(df: DataFrame, id_col: str, vec_col: str, scale: float) -> DataFrame:
    """id, v (array<bigint>, floor(scale * x)) and dim of the rows that take part."""
    v = F.transform(F.col(vec_col), lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))
    whole = F.forall(F.col(vec_col), lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                     & (F.abs(x.cast("double")) < float("inf")))
    return (df.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull()).where(whole)
            .select(F.col(id_col).cast("long").alias("id"), v.alias("v"))
            .groupBy("id").agg(F.min("v").alias("v"))
            .select("id", "v", F.size("v").alias("dim")))


def _matrix(col: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, np.int64) for v in col]) if len(col) else np.zeros((0, 0), np.int64)


_TREE = "dim int, shard int, " + ", ".join(f"{k} binary" for k in BallTree.PARTS)
_FOUND = "query_id long, vec_id long, score long"


def _plant(pdf: pd.DataFrame) -> pd.DataFrame:
    """One shard's vectors as one row: its ball tree."""
    tree = BallTree.grown(pdf["id"].to_numpy(np.int64), _matrix(pdf["v"]))
    return pd.DataFrame([{"dim": int(pdf["dim"].iloc[0]), "shard": int(pdf["shard"].iloc[0])} | tree.packed()])


def _search(k: int):
    def search(queries: pd.DataFrame, shards: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(shards):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        best = TopK(queries["id"].to_numpy(np.int64), _matrix(queries["v"]), k, queries["floor"].to_numpy(float))
        everyone = np.arange(len(queries))
        trees = [BallTree.unpacked(int(s.dim), s) for s in shards.itertuples()]
        trees.sort(key=lambda t: -best.bound(t, 0, everyone).mean())
        for t in trees:
            best.search(t, 0, everyone)
        ok = (best.score > _NONE) & (best.score >= best.floor[:, None])
        return pd.DataFrame({"query_id": np.broadcast_to(best.qid[:, None], ok.shape)[ok],
                             "vec_id": best.id[ok], "score": best.score[ok]})

    return search


def top_k(spark: SparkSession, queries: DataFrame, candidates: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of ``candidates`` for every row of ``queries``.
    Both hold id, v, dim (see quantized()); a query never meets a candidate of its own id."""
    candidates, queries = materialize(candidates, "topk-candidates"), materialize(queries, "topk-queries")
    n_shards = max(1, math.ceil(candidates.count() / SHARD_ROWS))
    n_blocks = max(1, math.ceil(queries.count() / BLOCK_QUERIES))
    n_runs = math.ceil(n_shards / RUN_SHARDS)
    tasks = max(shuffle_partitions(spark), 1)
    shards = materialize(
        candidates.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(n_shards)).cast("int"))
        .groupBy("dim", "shard").applyInPandas(_plant, _TREE), "topk-trees")
    shards = shards.withColumn("run", F.pmod(F.col("shard"), F.lit(n_runs)))
    blocks = queries.withColumn("block", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(n_blocks)).cast("int"))

    def search(own: DataFrame, runs_of, blocks_of) -> DataFrame:
        keys = ["dim", "block", "run"]
        a = own.withColumn("run", F.explode(runs_of)).repartition(tasks, *keys)
        b = shards.withColumn("block", F.explode(blocks_of)).repartition(tasks, *keys)
        return a.groupBy(*keys).cogroup(b.groupBy(*keys)).applyInPandas(_search(k), _FOUND)

    home = F.pmod(F.col("block"), F.lit(n_runs))
    near = materialize(search(
        blocks.withColumn("floor", F.lit(float("-inf"))), F.array(home),
        F.filter(F.sequence(F.lit(0), F.lit(n_blocks - 1)), lambda b: F.pmod(b, F.lit(n_runs)) == F.col("run"))),
        "topk-near")
    found = near
    if n_runs > 1:
        kth = near.groupBy("query_id").agg(
            F.when(F.count("*") >= k, F.min("score").cast("double")).otherwise(F.lit(float("-inf"))).alias("floor"))
        rest = blocks.join(kth.withColumnRenamed("query_id", "id"), "id", "left").fillna(float("-inf"), ["floor"])
        found = near.unionByName(search(
            rest, F.filter(F.sequence(F.lit(0), F.lit(n_runs - 1)), lambda r: r != home),
            F.filter(F.sequence(F.lit(0), F.lit(n_blocks - 1)), lambda b: F.pmod(b, F.lit(n_runs)) != F.col("run"))))
    order = F.struct((-F.col("score")).alias("s"), F.col("vec_id").alias("vec_id"), F.col("score").alias("score"))
    return (found.groupBy("query_id").agg(F.slice(F.sort_array(F.collect_list(order)), 1, k).alias("best"))
            .select("query_id", F.posexplode("best").alias("pos", "b"))
            .select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), "b.vec_id", "b.score"))


def op2_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quantized(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 1024.0)
    return top_k(spark, rows.where(F.col("id") % 100 == 0), rows, 10)


OP2_SQL = """
WITH v AS (
  SELECT vec_id AS id, min([CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding]) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x for x in embedding if x IS NULL OR isnan(x) OR isinf(x)]) = 0
  GROUP BY vec_id
), s AS (
  SELECT q.id AS query_id, c.id AS vec_id,
    CAST(coalesce(list_sum([q.v[i] * c.v[i] for i in range(1, len(q.v) + 1)]), 0) AS BIGINT) AS score
  FROM v q JOIN v c ON q.id <> c.id AND len(q.v) = len(c.v) WHERE q.id % 100 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""
