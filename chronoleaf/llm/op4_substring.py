"""Substring dedup with prefix-partitioned suffix trees over words.

A window is 20 consecutive words of one document.  Every window starts a
suffix, cut to 20 words.  The trees run over words, so a node of depth 20 with
two or more leaves is a repeated window; the earliest leaf stays and the others
are repeats.

Groups.  The suffixes are split by a variable-length prefix: from the suffix's
start to the end of its anchor, the run of ANCHOR words with the least hash
among those that the window holds.  Equal windows have equal prefixes and so
meet in one group, and since neighbouring suffixes mostly share their anchor, a
task ships one stretch of text for all of them (about three words a suffix, not
twenty).  Groups are dealt into as many buckets as keep one bucket's text near
BUCKET_BYTES.

Frequent runs.  Every place of an anchor ships one stretch at most, so a group
outgrows a bucket only if its run of ANCHOR words occurs that often.  Such runs
are counted first (in a sample of the text, with partial aggregation; it only
decides where windows meet) and are taken as anchors last: a window around a
common phrase goes by a run of the differing text beside it, which makes its
prefix longer.  Windows of frequent runs alone have all their words as prefix:
they are shipped one by one and dealt by the hash of the whole window.

Pre-aggregation.  Within one chunk of a scan task, stretches with equal words
are shipped once; the later ones are repeats already.  So a passage that a third
of all documents share costs one stretch per chunk.

Trees.  A bucket's tree is built top-down and level by level: the suffixes of a
node part by their next words, children with one leaf are dropped, and at depth
20 the internal nodes that are left are the repeats.  Labels are 64-bit hashes
of the words; each repeat is compared with the earliest leaf byte by byte, so a
clash of hashes removes nothing.

Rows.  Where a doc_id (or null) stands on several rows, the stretches also carry
a hash of the row's text, and the repeats are joined back by both; doc_id alone
gives the order.

Defined results: null text has no words; a null doc_id counts as the smallest;
rows repeated with their doc_id are one document (neither copy is earlier); of
rows with one doc_id and different texts, windows at the same place are not
earlier than each other either; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoleaf.llm import words as W
from chronoleaf.llm.common import shuffle_partitions, small_batches, table

WINDOW = 20
ANCHOR = 4                      # words in an anchor
CHUNK_BYTES = 6 << 20           # text handled at once in a scan task
BUCKET_BYTES = 14 << 20         # text of one bucket
SHIPPED = 3.5                   # shipped text per input text before pre-aggregation, about
WORD_BYTES = 8                  # of a word and the space after it, at most about
SAMPLED = 256                   # places in the sample of a run that fills a bucket
BLOCK = 8192                    # characters that are sampled together
_IDX = np.uint64((1 << 32) - 1)
_NULL_ID = np.iinfo(np.int64).min


def _normal(text: str | None) -> bytes:
    return b" ".join((text or "").encode("utf-8", "replace").split())


def _among(x: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(x), bool)
    return ordered[np.minimum(np.searchsorted(ordered, x), len(ordered) - 1)] == x


def _anchors(h: np.ndarray, width: int, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor position for every window start; the hash of the run at every position, and whether it is frequent."""
    gram = W.run_hashes(h, ANCHOR)
    often = _among(gram, frequent)
    rank = (gram >> np.uint64(33)) | (often.astype(np.uint64) << np.uint64(31))
    low = (rank << np.uint64(32)) | np.arange(len(gram), dtype=np.uint64)   # frequent last, least hash, then leftmost
    have, n = low, 1                                               # minimum over n neighbours, by doubling
    while 2 * n <= width:
        have = np.minimum(have[:-n], have[n:])
        n *= 2
    rest = width - n
    best = np.minimum(have[:len(have) - rest], have[rest:]) if rest else have
    return (best & _IDX).astype(np.int64), gram, often


def _count_runs(batches):
    """Runs of ANCHOR words inside one text, by hash, and how often each occurs in a batch."""
    for pdf in batches:
        texts = [_normal(t) for t in pdf["text"]]
        buf = b"\n".join(texts)
        start, end = W.spans(buf)
        doc = W.owners(np.array([len(t) for t in texts]), start)
        gram = W.run_hashes(W.word_hashes(buf, start, end), ANCHOR)
        gram, n = np.unique(gram[doc[:len(gram)] == doc[ANCHOR - 1:]] if len(gram) else gram, return_counts=True)
        yield pd.DataFrame({"run": gram.view(np.int64), "n": n.astype(np.int64)})


def frequent_runs(docs: DataFrame, window: int = WINDOW) -> np.ndarray:
    """Sorted hashes of the runs of ANCHOR words whose stretches may fill half a bucket or more."""
    most = max(1, BUCKET_BYTES // (WORD_BYTES * (2 * window - ANCHOR)))      # places that fill a bucket
    rate = min(1.0, SAMPLED / most)
    text = F.coalesce("text", F.lit(""))
    numbered = docs.select(text.alias("text"), F.monotonically_increasing_id().alias("row"))
    picked = F.filter(F.sequence(F.lit(0), F.floor(F.char_length("text") / BLOCK).cast("int")),
                      lambda b: F.pmod(F.xxhash64("row", b), F.lit(1 << 20)) < int(rate * (1 << 20)))
    blocks = numbered.select(F.explode(F.transform(
        picked, lambda b: F.substr("text", b * BLOCK + 1, F.lit(BLOCK)))).alias("text"))
    rows = (blocks.mapInPandas(_count_runs, "run long, n long").groupBy("run").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= math.ceil(most * rate / 2)).select("run").collect())
    return np.sort(np.array([r.run for r in rows], np.int64).view(np.uint64))


def _ranges(start: np.ndarray, n: np.ndarray) -> bytes:
    return np.stack([start, n]).astype("<u4").tobytes()


def _split(ids: list[int], texts: list[bytes], buckets: int, window: int,
           frequent: np.ndarray = np.zeros(0, np.uint64), keys: list[int] | None = None) -> Iterator[tuple]:
    """Rows (bucket, found, doc_id, payload) of a chunk: stretches for a bucket, or (found) repeats of a document.
    With ``keys`` (of the rows), doc_id is (doc_id, key)."""
    order = sorted(range(len(ids)), key=ids.__getitem__)
    row = np.array(keys if keys is not None else [0] * len(ids), np.int64)[order]
    ids, texts = np.array(ids, np.int64)[order], [texts[i] for i in order]
    buf = b"\n".join(texts)
    start, end = W.spans(buf)
    if len(start) < window:
        return
    doc = W.owners(np.array([len(t) for t in texts]), start)
    first_word = np.searchsorted(doc, np.arange(len(texts)))       # of each document
    h = W.word_hashes(buf, start, end)
    anchor, gram, often = _anchors(h, window - ANCHOR + 1, frequent)
    at = np.flatnonzero(doc[:len(start) - window + 1] == doc[window - 1:])
    if not len(at):
        return
    anchor = anchor[at]
    new = np.ones(len(at), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1) | (doc[at[1:]] != doc[at[:-1]])
    new |= often[anchor]                                           # dealt one by one
    head = np.flatnonzero(new)
    n = np.diff(np.append(head, len(at)))                          # windows of each stretch
    left = at[head]
    offset = np.arange(len(at)) - np.repeat(head, n)
    windows = W.run_hashes(h, window)[at]
    whole = windows * W.mix(offset.astype(np.uint64) + np.uint64(1))
    label = W.mix(np.add.reduceat(whole, head) + n.astype(np.uint64))
    lo, hi = start[left], end[left + n + window - 2]
    _, first, same = np.unique(label, return_index=True, return_inverse=True)
    first = first[same]                                            # the earliest stretch of equal label
    again = np.flatnonzero(first != np.arange(len(first)))
    if len(again):
        f = first[again]
        equal = hi[again] - lo[again] == hi[f] - lo[f]
        equal[equal] = W.same_bytes(W.lanes(buf), lo[again[equal]], lo[f[equal]], (hi - lo)[again[equal]])
        # rows of one document may repeat: the same place is not earlier than itself
        equal &= (ids[doc[left[again]]] != ids[doc[left[f]]]) | (
            left[again] - first_word[doc[left[again]]] > left[f] - first_word[doc[left[f]]])
        again = again[equal]
        owner = doc[left[again]]
        for d, own in zip(*_groups(owner, again)):
            yield int(ids[d]) % buckets, True, int(ids[d]) if keys is None else (int(ids[d]), int(row[d])), _ranges(left[own] - first_word[d], n[own])
    ship = np.setdiff1d(np.arange(len(left)), again, assume_unique=True)
    prefix = anchor[head[ship]]
    prefix = np.where(often[prefix], windows[head[ship]], gram[prefix])
    bucket = ((prefix >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
    by = np.argsort(bucket, kind="stable")
    ship, bucket = ship[by], bucket[by]
    packer = zstandard.ZstdCompressor(level=3)
    owner = doc[left]
    for b, own in zip(*_groups(bucket, ship)):
        fixed = (ids[owner[own]].astype("<i8"), row[owner[own]].astype("<i8"), (left[own] - first_word[owner[own]]).astype("<u4"), n[own].astype("<u1"))
        text = b"\n".join(buf[x:y] for x, y in zip(lo[own].tolist(), hi[own].tolist()))
        yield int(b), False, 0 if keys is None else (0, 0), packer.compress(struct.pack("<I", len(own)) + b"".join(x.tobytes() for x in fixed) + text)


def _groups(key: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Distinct keys of sorted ``key`` and the ``rows`` of each."""
    if not len(key):
        return key, []
    cut = np.flatnonzero(key[1:] != key[:-1]) + 1
    return key[np.append(0, cut)], np.split(rows, cut)


def _splitter(buckets: int, window: int, frequent: np.ndarray):
    def split(batches):
        ids, keys, texts, size = [], [], [], 0

        def rows():
            found = [(b, known, *d, p) for b, known, d, p in _split(ids, texts, buckets, window, frequent, keys)]
            return pd.DataFrame(found, columns=["bucket", "found", "doc_id", "row", "payload"])

        for pdf in batches:
            for i, k, t in zip(pdf["doc_id"].tolist(), pdf["row"].tolist(), pdf["text"]):
                ids.append(i)
                keys.append(k)
                texts.append(_normal(t))
                size += len(texts[-1])
                if size >= CHUNK_BYTES:
                    yield rows()
                    ids, keys, texts, size = [], [], [], 0
        yield rows()

    return split


def deep_nodes(h: np.ndarray, at: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Leaves (positions in ``at``) under internal nodes of ``depth`` words, and the node of each.
    Top-down: each level parts a node's leaves by their next words and drops children with one leaf."""
    leaf, node, d = np.arange(len(at)), np.zeros(len(at), np.int64), 0
    while d < depth and len(leaf):
        edge = min(4 if d < 8 else 8, depth - d)
        label = W.run_hashes(h, edge)[at[leaf] + d]
        _, child, size = np.unique(W.pair(W.mix(node.astype(np.uint64)), label), return_inverse=True, return_counts=True)
        keep = size[child] > 1
        leaf, node, d = leaf[keep], child[keep], d + edge
    return leaf, node


def _repeats(payloads: list[bytes], window: int, keyed: bool = False) -> Iterator[tuple]:
    """(doc_id, ranges) of every window of one bucket that starts earlier elsewhere; ``keyed``: doc_id is (doc_id, key)."""
    ids, keys, begin, n, texts = [], [], [], [], []
    for p in payloads:
        raw = zstandard.ZstdDecompressor().decompress(p)
        m = struct.unpack_from("<I", raw)[0]
        ids.append(np.frombuffer(raw, "<i8", m, 4))
        keys.append(np.frombuffer(raw, "<i8", m, 4 + 8 * m))
        begin.append(np.frombuffer(raw, "<u4", m, 4 + 16 * m))
        n.append(np.frombuffer(raw, "<u1", m, 4 + 20 * m))
        texts.append(raw[4 + 21 * m:])
    keys = np.concatenate(keys)
    ids, begin, n = np.concatenate(ids), np.concatenate(begin).astype(np.int64), np.concatenate(n).astype(np.int64)
    buf = b"\n".join(texts)
    del texts
    start, end = W.spans(buf)
    h = W.word_hashes(buf, start, end)
    offset = np.cumsum(n + window - 1) - (n + window - 1)          # first word of each stretch
    stretch = np.repeat(np.arange(len(n)), n)
    step = np.arange(len(stretch)) - np.repeat(np.cumsum(n) - n, n)
    at = offset[stretch] + step
    leaf, node = deep_nodes(h, at, window)
    if not len(leaf):
        return
    doc, key, pos, at = ids[stretch[leaf]], keys[stretch[leaf]], (begin[stretch] + step)[leaf], at[leaf]
    order = np.lexsort((pos, doc, node))
    node, doc, key, pos, at = node[order], doc[order], key[order], pos[order], at[order]
    first = np.searchsorted(node, node)                            # the earliest leaf of the same node
    later = (doc != doc[first]) | (pos != pos[first])
    lo, size = start[at], end[at + window - 1] - start[at]
    equal = size == size[first]
    equal[equal] = W.same_bytes(W.lanes(buf), lo[equal], lo[first[equal]], size[equal])
    for i in np.unique(node[~equal]):                              # hashes clashed: part the node by its bytes
        earliest: dict[bytes, int] = {}
        for j in np.flatnonzero(node == i):
            k = earliest.setdefault(buf[lo[j]:lo[j] + size[j]], j)
            later[j] = (doc[j], pos[j]) != (doc[k], pos[k])
    doc, key, pos = doc[later], key[later], pos[later]
    order = np.lexsort((pos, key, doc))
    doc, key, pos = doc[order], key[order], pos[order]
    if len(doc):
        other = (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])      # the next row
        run = np.flatnonzero(np.append(True, other | (pos[1:] > pos[:-1] + 1)))
        length = pos[np.append(run[1:], len(pos)) - 1] - pos[run] + 1
        row = np.cumsum(np.append(0, other))
        for _, own in zip(*_groups(row[run], np.arange(len(run)))):
            d, k = int(doc[run[own[0]]]), int(key[run[own[0]]])
            yield (d, k) if keyed else d, _ranges(pos[run[own]], length[own])


def _finder(window: int):
    def find(batches):
        bucket, held = None, []

        def rows(found):
            return pd.DataFrame([(*d, r) for d, r in found], columns=["doc_id", "row", "ranges"])

        for pdf in batches:                                        # sorted by bucket
            known = pdf["found"]
            if known.any():                                        # repeats found before the shuffle
                yield rows(zip(zip(pdf["doc_id"][known], pdf["row"][known]), pdf["payload"][known]))
            for b, p in zip(pdf["bucket"][~known], pdf["payload"][~known]):
                if b != bucket and held:
                    yield rows(_repeats(held, window, True))
                    held = []
                bucket = b
                held.append(p)
        if held:
            yield rows(_repeats(held, window, True))

    return find


def repeated_windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, row, ranges: packed (first word, number of windows) pairs of the repeated windows, several rows a document.
    ``docs`` holds doc_id, row (neither null; row parts texts of one doc_id) and text."""
    if not ANCHOR <= window <= 255:
        raise ValueError(f"a window has {ANCHOR} to 255 words")
    spark = docs.sparkSession
    small_batches(spark)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(shuffle_partitions(spark), math.ceil(size * SHIPPED / BUCKET_BYTES))
    frequent = frequent_runs(docs, window) if size * SHIPPED > BUCKET_BYTES else np.zeros(0, np.uint64)
    shipped = docs.select("doc_id", "row", "text").mapInPandas(
        _splitter(buckets, window, frequent), "bucket int, found boolean, doc_id long, row long, payload binary")
    return (shipped.repartition(buckets, "bucket").sortWithinPartitions("bucket")
            .mapInPandas(_finder(window), "doc_id long, row long, ranges binary"))


def _cut(window: int):
    def cut(batches):
        for pdf in batches:
            out = []
            for d, text, ranges in zip(pdf["doc_id"], pdf["text"], pdf["ranges"]):
                ws = _normal(text).split()
                gone = np.zeros(len(ws) + 1, np.int64)
                for r in ranges if ranges is not None else ():
                    s, n = np.frombuffer(r, "<u4").reshape(2, -1).astype(np.int64)
                    np.add.at(gone, np.minimum(s, len(ws)), 1)
                    np.add.at(gone, np.minimum(s + n + window - 1, len(ws)), -1)
                stay = np.cumsum(gone)[:-1] == 0
                kept = b" ".join(w for w, k in zip(ws, stay.tolist()) if k)
                out.append((d, kept.decode(), len(ws), len(ws) - int(stay.sum())))
            yield pd.DataFrame(out, columns=["doc_id", "kept", "n_words", "n_removed"]).astype(
                {"doc_id": "int64", "n_words": "int64", "n_removed": "int64"})

    return cut


def drop_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, kept (text less its repeated windows, words joined by one space), n_words, n_removed."""
    known = docs.select(F.coalesce("doc_id", F.lit(int(_NULL_ID))).alias("doc_id"), "text")
    shared = known.groupBy("doc_id").count().where("count > 1").limit(1).count() > 0
    known = known.withColumn("row", F.xxhash64("text") if shared else F.lit(0).cast("long"))   # unique ids need none
    found = repeated_windows(known, window).groupBy("doc_id", "row").agg(F.collect_list("ranges").alias("ranges"))
    cut = known.join(found, ["doc_id", "row"], "left").mapInPandas(
        _cut(window), "doc_id long, kept string, n_words long, n_removed long")
    return cut.withColumn("doc_id", F.nullif("doc_id", F.lit(int(_NULL_ID))))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = drop_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def brute_force(rows: list[tuple[int, str | None]], window: int = WINDOW) -> list[tuple[int, int, int, str]]:
    """The contract, literally; for tests."""
    docs = [(d, _normal(t).split()) for d, t in rows]
    first: dict[tuple, tuple] = {}
    for d, ws in docs:
        for i in range(len(ws) - window + 1):
            key = tuple(ws[i:i + window])
            first[key] = min(first.get(key, (d, i)), (d, i))
    out = []
    for d, ws in docs:
        gone = set()
        for i in range(len(ws) - window + 1):
            if first[tuple(ws[i:i + window])] < (d, i):
                gone.update(range(i, i + window))
        kept = b" ".join(w for i, w in enumerate(ws) if i not in gone)
        out.append((d, len(ws), len(gone), hashlib.sha256(kept).hexdigest()))
    return out
