"""The pipeline as a whole against a brute-force version over small tables."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from chronoleaf.llm import op6_toxicity, op10_mixing
from chronoleaf.session import scratch_dir
from tests.llm import brute

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    """Clean and toxic documents, exact and near copies, nulls and empties, over listed and other sources."""
    rng = random.Random(12)
    mild, rude = [f"calm{i}" for i in range(40)], [f"vile{i}" for i in range(8)]
    texts = []
    for i in range(240):
        ws = rng.choices(mild, k=rng.randrange(30, 60))
        if i % 4 == 0:
            ws[::3] = rng.choices(rude, k=len(ws[::3]))
        texts.append((" ".join(ws), int(i % 4 == 0)))
    for i in range(40):
        text, toxic = rng.choice(texts[:240])
        texts.append((text if i % 2 else text.replace(" ", " \n", 3), toxic))
    base = " ".join(rng.choices(mild, k=400))
    texts += [(base.replace(" calm7 ", " changed ", 1), 0), (base, 0), (None, 0), ("", 0), (" \t", 0)]
    rng.shuffle(texts)
    sources = ["src0", "src0", "src1", "src2", "other", None]
    docs = [(i, t, "en", rng.choice(sources), len(t or "")) for i, (t, _) in enumerate(texts)]
    return docs, [(i, y) for i, (_, y) in enumerate(texts)]


def poisson(mean: float, doc_id: int) -> int:
    u = int(hashlib.md5(f"{op10_mixing.SEED}:0:{doc_id}".encode()).hexdigest()[:13], 16) / 2 ** 52
    k, p, total = 0, math.exp(-mean), 0.0
    while True:
        total += p
        if u < total:
            return k
        k += 1
        p *= mean / k


def by_brute_force(spark, docs, labels):
    order = {r.doc_id: r.h for r in spark.createDataFrame([(d[0],) for d in docs], "doc_id long")
             .select("doc_id", F.xxhash64("doc_id", F.lit(6)).alias("h")).collect()}
    text = {d[0]: d[1] for d in docs}
    known = sorted((order[i], i, y) for i, y in labels if zlib.crc32(str(i).encode()) % 5)
    w = op6_toxicity.train((y, text[i]) for _, i, y in known)
    clean = [d for d in docs if w[op6_toxicity.features(d[1])].sum() < 0]
    first = {}
    for d in sorted(clean):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", d[1] or ""), d)
    single = list(first.values())
    stay = {d for d, _, c in brute.components8([d[:2] for d in single]) if d == c}
    single = [d for d in single if d[0] in stay]
    share = op10_mixing.SHARES
    pool = [d[3] if d[3] in share else None for d in single]
    whole = sum((share | {None: op10_mixing.POOL})[s] for s in set(pool))
    out = []
    for d, s in zip(single, pool):
        mean = (share | {None: op10_mixing.POOL})[s] / whole * len(single) / pool.count(s)
        out += [d] * poisson(mean, d[0])
    coded = brute.codec9([d[:2] for d in out])
    return sorted(((d[0], d[3], n, ids, back) for d, (_, n, ids, back) in zip(out, coded)), key=str), clean, single


def saved(spark, docs, labels):
    sf = scratch_dir(spark, "pipeline-test")
    spark.createDataFrame(docs, DOCS).repartition(3).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{sf}/labels.parquet")
    return sf


def test_pipeline_equals_brute_force(spark):
    docs, labels = corpus()
    want, clean, single = by_brute_force(spark, docs, labels)
    out = corpus_pipeline.run(spark, saved(spark, docs, labels))
    mine = out.select("doc_id", "source", "n_tokens", F.sha2("ids", 256), "decoded_sha256").collect()
    assert sorted((tuple(r) for r in mine), key=str) == want
    assert 100 < len(single) < len(clean) < len(docs) - 40       # every stage had something to do
    assert {y for i, y in labels if i in {d[0] for d in clean}} == {0}


def test_pipeline_empty(spark):
    out = corpus_pipeline.run(spark, saved(spark, [], []))
    assert out.columns == ["doc_id", "source", "n_tokens", "ids", "decoded_sha256"] and out.count() == 0


def test_near_dedup_goes_by_row(spark):
    one, two, three = (" ".join(f"{w}{i}" for i in range(400)) for w in "abc")
    near = lambda t: t + " "                                                   # noqa: E731  same shingles
    docs = [(1, one), (2, near(one)), (2, two), (None, three), (None, near(three)), (None, near(one)), (4, "x"), (4, "x ")]
    sf = saved(spark, [(d, t, "en", "src0", len(t)) for d, t in docs], [])
    for table in (spark.read.parquet(f"{sf}/documents.parquet"), spark.createDataFrame([(*d, "en", "s", 1) for d in docs], DOCS)):
        out = corpus_pipeline.simhash_dedup(spark, table, sf).collect()
        assert sorted(((r.doc_id, r.text.strip()) for r in out), key=str) == sorted(
            [(1, one), (2, two), (None, three), (4, "x")], key=str)
