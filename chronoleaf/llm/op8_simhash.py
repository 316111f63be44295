"""SimHash near-dedup with pivot distance tables.

Fingerprints: 64 bits; a bit is 1 if it is set in over half the hashes (XXH64,
seed 42) of a text's word shingles, repeats included.

Pivots: the Hamming distances from each fingerprint to many reference
fingerprints are computed once, block by block (four blocks of 16 bits; the
distance to a pivot is the sum over blocks).  By the triangle inequality, two
fingerprints at most d bits apart differ by at most d in every coordinate of
this table, so a pair whose largest coordinate difference exceeds d is
discarded, and only the survivors are compared bit by bit.

Where candidates meet: d flipped bits touch at most d blocks, so at least 4 - d
blocks (2 for d = 2) keep all their pivot distances.  Each fingerprint is dealt
out once for each choice of those blocks, keyed by the blocks' distances to all
pivots; a linked pair shares at least one key.  (Cells over whole-width
distances would need a copy for every neighbouring cell, about 2.3 to the power
of the number of pivots used.)

Skew: only distinct fingerprints are dealt, so groups of copies count once.
Within a key, fingerprints are sorted by their distance to the first pivot and
compared in tiles of bounded size with those at most d away; of the links
found, a spanning forest goes on.  Groups over SPLIT_ROWS are dealt once more,
by cells of further pivot distances.  Components come from alternating
large-star and small-star steps over written tables.

Defined results: null or empty text has fingerprint zero, linked like any
other; component_id is the least doc_id of the component (null ids do not
count; null if it has no other); repeated rows give repeated result rows; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoleaf.llm.common import shuffle_partitions, small_batches, table
from chronoleaf.session import materialize

SHINGLE = 3
MAX_BITS = 2
SEED = 42
BLOCKS, BLOCK_BITS = 4, 16
SPLIT_ROWS = 8192       # larger groups are dealt once more
TILE = 1024
#: reference fingerprints: 24 fixed pseudo-random words
PIVOTS = np.array([xxhash.xxh64_intdigest(b"pivot %d" % i, 0) for i in range(24)], np.uint64)


def shingle_hashes(text: bytes, width: int) -> list[int]:
    ws, h, join = text.lower().split(), xxhash.xxh64_intdigest, b" ".join
    if len(ws) < width:
        return [h(join(ws), SEED)] if ws else []
    return [h(join(s), SEED) for s in zip(*(ws[i:] for i in range(width)))]


def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    hashes = shingle_hashes((text or "").encode("utf-8", "replace"), width)
    if not hashes:
        return 0
    total = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 4096):
        part = np.array(hashes[i:i + 4096], "<u8")
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = SHINGLE, text_col: str = "text", to: str = "fp") -> DataFrame:
    """Adds the fingerprint as a (signed) long."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("long")
    def fp(col: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, width) for t in col], np.uint64).view(np.int64))

    return docs.withColumn(to, fp(F.coalesce(F.col(text_col), F.lit(""))))


def pivot_table(fp: np.ndarray) -> np.ndarray:
    """(rows, pivots, blocks): Hamming distance to each pivot within each block."""
    out = np.empty((len(fp), len(PIVOTS), BLOCKS), np.uint8)
    for j, p in enumerate(PIVOTS):
        out[:, j] = np.bitwise_count((fp ^ p).view("<u2").reshape(-1, BLOCKS))
    return out


def _keys(fp: np.ndarray, bits: int) -> list[np.ndarray]:
    """For each choice of untouched blocks, a key from the choice and the blocks' distances to all pivots."""
    blocks = pivot_table(fp)
    keys = []
    for c, kept in enumerate(combinations(range(BLOCKS), BLOCKS - bits)):
        rows = np.ascontiguousarray(blocks[:, :, kept]).reshape(len(fp), -1)
        keys.append(np.array([xxhash.xxh64_intdigest(r, c) for r in rows], np.uint64).view(np.int64))
    return keys


def _close_pairs(fp: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs at most ``bits`` apart: pivot filter first, then the bits."""
    d = pivot_table(fp).sum(axis=2, dtype=np.int16)
    order = np.argsort(d[:, 0], kind="stable")
    fp, d = fp[order], d[order]
    left, right = [], []
    for lo in range(0, len(fp), TILE):
        hi = min(lo + TILE, len(fp))
        stop = int(np.searchsorted(d[:, 0], d[hi - 1, 0] + bits, "right"))
        for at in range(lo, stop, TILE):
            a, b = np.nonzero(np.abs(d[lo:hi, 0][:, None] - d[at:min(at + TILE, stop), 0][None, :]) <= bits)
            a, b = a + lo, b + at
            a, b = a[a < b], b[a < b]
            for j in range(1, d.shape[1]):                 # discard by the coordinate differences
                near = np.abs(d[a, j] - d[b, j]) <= bits
                a, b = a[near], b[near]
            linked = np.bitwise_count(fp[a] ^ fp[b]) <= bits  # verify the survivors
            left.append(order[a[linked]])
            right.append(order[b[linked]])
    return (np.concatenate(left), np.concatenate(right)) if left else (np.zeros(0, int), np.zeros(0, int))


def _forest(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Least index of each item's component."""
    root = list(range(n))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a, b in zip(left.tolist(), right.tolist()):
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)
    return np.array([find(i) for i in range(n)], int)


def _deal(bits: int):
    def deal(batches):
        for pdf in batches:
            fp = pdf["fp"].to_numpy(np.int64)
            for key in _keys(fp.view(np.uint64), bits):
                yield pd.DataFrame({"key": key, "fp": fp})
    return deal


def _star(fp: np.ndarray, bits: int) -> pd.DataFrame:
    root = _forest(len(fp), *_close_pairs(fp.view(np.uint64), bits))
    own = np.flatnonzero(root != np.arange(len(fp)))
    return pd.DataFrame({"a": fp[own], "b": fp[root[own]], "again": False})


def _split(key: int, fp: np.ndarray, bits: int) -> pd.DataFrame:
    """A large group dealt by cells of its distances to two pivots; cells overlap by ``bits``."""
    d = pivot_table(fp.view(np.uint64)).sum(axis=2, dtype=np.int64)
    cells, rows = np.zeros(len(fp), np.int64), np.arange(len(fp))
    for j in (1, 2):
        cell, room = d[rows, j] // 4, d[rows, j] % 4 < bits     # near the lower edge: in the cell below as well
        cells = np.concatenate([cells * 32 + cell, (cells * 32 + cell - 1)[room]])
        rows = np.concatenate([rows, rows[room]])
    return pd.DataFrame({"a": _cell_key(key, cells), "b": fp[rows], "again": True})


def _cell_key(key: int, cells: np.ndarray) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(b"%d %d" % (key, c), 1) for c in cells], np.uint64).view(np.int64)


def _group(bits: int, split: int | None):
    """Rows sorted by key: links within each key, or the rows of too large a group dealt again."""
    def group(batches):
        held_k, held_f = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def done(k, f):
            cut = np.flatnonzero(k[1:] != k[:-1]) + 1
            lo, hi = np.append(0, cut), np.append(cut, len(k))
            out = []
            for a, b in zip(lo[hi - lo > 1].tolist(), hi[hi - lo > 1].tolist()):
                own = np.unique(f[a:b])
                out.append(_split(int(k[a]), own, bits) if split and len(own) > split else _star(own, bits))
            return pd.concat(out) if out else pd.DataFrame({"a": [], "b": [], "again": []}).astype(
                {"a": "int64", "b": "int64", "again": bool})

        for pdf in batches:
            k = np.concatenate([held_k, pdf["key"].to_numpy(np.int64)])
            f = np.concatenate([held_f, pdf["fp"].to_numpy(np.int64)])
            last = int(np.searchsorted(k, k[-1])) if len(k) else 0
            held_k, held_f = k[last:], f[last:]
            if last:
                yield done(k[:last], f[:last])
        if len(held_k):
            yield done(held_k, held_f)
    return group


def links(distinct: DataFrame, bits: int = MAX_BITS) -> DataFrame:
    """Pairs (a > b) of fingerprints whose components are those of all links of at most ``bits`` bits."""
    if not 0 <= bits < BLOCKS:
        raise ValueError(f"0 to {BLOCKS - 1} bits: one block at least must be untouched")
    n = shuffle_partitions(distinct.sparkSession)
    found = "a long, b long, again boolean"
    dealt = distinct.select("fp").mapInPandas(_deal(bits), "key long, fp long")
    first = materialize(dealt.repartition(n, "key").sortWithinPartitions("key")
                        .mapInPandas(_group(bits, SPLIT_ROWS), found), "simhash-links")
    again = (first.where("again").select(F.col("a").alias("key"), F.col("b").alias("fp")).repartition(n, "key")
             .sortWithinPartitions("key").mapInPandas(_group(bits, None), found))
    pairs = first.where("not again").unionByName(again)
    return pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()


def components(pairs: DataFrame) -> DataFrame:
    """node, root (least node of its component) for the nodes of ``pairs`` (a > b), by star contraction."""
    edges, before = materialize(pairs, "simhash-edges"), None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(low.select("a", F.col("m").alias("b"))).where("a <> b").distinct())
        edges = materialize(small, "simhash-edges")
        after = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if after == before:                                # stars only: nothing moves any more
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = after


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE,
                    bits: int = MAX_BITS, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, fp (long), component_id for every row of ``docs``; with ``carry``, then those columns and root, the least
    fingerprint of the component, which is known where component_id is null."""
    ids = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *carry)
    fps = materialize(fingerprints(ids, width).select("doc_id", "fp", *carry), "simhash-fingerprints")
    classes = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(classes.select("fp"), bits))
    rooted = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    more = (*carry, "root") if carry else ()
    return fps.join(rooted.join(least, "root").select("fp", "component_id", "root"), "fp").select(
        "doc_id", "fp", "component_id", *more)


def op8_simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
