"""The corpus pipeline: toxicity, exact dedup, SimHash near-dedup, mixing, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's ``docs``.  All but the last
return the columns of ``documents``.  The stages are the library's operators
with their production parameters; a stage works on all that the one before kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoleaf.llm import common, op5_exact, op6_toxicity, op8_simhash, op9_bpe, op10_mixing
from chronoleaf.session import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls toxic go.  It learns from the labelled documents among ``docs``."""
    weights = op6_toxicity.fit(docs, common.table(spark, sf_dir, "labels"))
    return op6_toxicity.score_texts(docs, weights).where("predicted = 0").select(*COLUMNS)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest doc_id stays."""
    return op5_exact.exact_dedup(docs).where("kept").select(*COLUMNS)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group stays: the one with the smallest doc_id (null after all others), of several
    the first by its place.  Rows go by their place, so others with the same doc_id or without one are not touched."""
    placed = common.placed(docs.select(*COLUMNS), "place", "simhash-rows")
    found = op8_simhash.near_duplicates(placed, width=op8_simhash.SHINGLE, bits=op8_simhash.MAX_BITS, carry=("place",))
    rank = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "place")
    groups = found.groupBy("root").agg(F.min(rank).alias("first"), F.count("*").alias("n")).where("n > 1")
    gone = found.join(groups, "root").where(F.col("place") != F.col("first.place")).select("place")
    return placed.join(gone, "place", "left_anti").select(*COLUMNS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources repeated to their target shares, in global random order."""
    return op10_mixing.mix_sources(docs, op10_mixing.SHARES, op10_mixing.POOL).select(*COLUMNS)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, packed, with their number and the digest of the bytes they decode to."""
    path, pattern = op9_bpe.RANKS, op9_bpe.PATTERN
    coded = op9_bpe.decode_ids(op9_bpe.encode_texts(docs.select("doc_id", "source", "text"), path, pattern), path, pattern)
    return coded.select("doc_id", "source", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids",
                        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("toxicity", toxicity), ("exact_dedup", exact_dedup), ("simhash_dedup", simhash_dedup),
          ("mixing", mixing), ("bpe", bpe)]

#: a fitted classifier and a tokenizer cannot be written in SQL; the tests hold run() against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
