"""Exact dedup by a stateful stream.

The rows' digests run as a stream through keyed state without expiry, kept on
disk (RocksDB) and in the stream's checkpoint.  For each digest the state holds
the stable identifier of the row that stays, its content locator (file and row
in it), and how many rows came.  After the stream has drained, the state is
read back as a table.  On a hit (a digest with several rows) the full texts are
compared: every row against the text at the kept locator.  Rows whose bytes
differ (a clash of digests) are grouped again by their text.

Texts are equal when identical after each run of ASCII white space has become
one space.  The row with the smallest id stays.  Everything is built-in
functions; only rows of digests with hits carry texts into the comparison, and
a hot digest is combined before each shuffle and split by the skew join.

Defined results: null text counts as empty; a null id orders after all others;
of rows with equal id and text the first by locator stays, so each group keeps
exactly one row; an empty table gives no rows.  Columns named like the result's
are replaced in ``exact_dedup``'s output; all other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoleaf.llm.common import col, placed, table, without
from chronoleaf.session import materialize, scratch_dir

BYTES_PER_TRIGGER = 64 << 30   # digests that one micro-batch takes
#: state on disk; no file space taken in advance, which many small stores would waste
_STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false"}


def normalized(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def _streamed_state(spark: SparkSession, rows: DataFrame, bytes_per_trigger: int) -> DataFrame:
    """digest, keep (least struct(no id, id, place)) and n, from the state of a drained stream over ``rows``."""
    path, checkpoint = scratch_dir(spark, "dedup-digests"), scratch_dir(spark, "dedup-state")
    rows.write.parquet(path)
    before = {k: spark.conf.get(k, None) for k in _STATE_CONF}
    for k, v in _STATE_CONF.items():
        spark.conf.set(k, v)
    try:
        stream = (spark.readStream.schema(rows.schema).option("maxBytesPerTrigger", str(bytes_per_trigger)).parquet(path)
                  .groupBy("digest")
                  .agg(F.min(F.struct(F.col("id").isNull().alias("unknown"), "id", "at")).alias("keep"),
                       F.count(F.lit(1)).alias("n")))
        query = (stream.writeStream.format("noop").outputMode("update").option("checkpointLocation", checkpoint)
                 .trigger(availableNow=True).start())
        query.awaitTermination()
        if rows.sparkSession.read.parquet(path).isEmpty():   # a stream without rows leaves no state
            return spark.createDataFrame([], "digest string, keep struct<unknown boolean, id long, at struct<file string, row long>>, n long")
        state = spark.read.format("statestore").load(checkpoint)
        # written once: later joins must not open the state stores again
        return materialize(state.select("key.digest", F.col("value.min").alias("keep"), F.col("value.count").alias("n")),
                           "dedup-groups")
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest=sha256,
                bytes_per_trigger: int = BYTES_PER_TRIGGER) -> DataFrame:
    """Adds keep_id, group_size, kept and text_digest to every row of ``docs``."""
    spark = docs.sparkSession
    docs = placed(without(docs, "keep_id", "group_size", "kept", "text_digest"), "__at", "dedup-input")
    text = normalized(col(text_col))
    groups = _streamed_state(
        spark, docs.select(digest(text).alias("digest"), col(id_col).cast("long").alias("id"), F.col("__at").alias("at")),
        bytes_per_trigger)
    rows = docs.withColumn("__digest", digest(text))
    hits = groups.where("n > 1")
    # texts of rows whose digest came again; one row of each group is the one at the kept place
    texts = (rows.select("__digest", "__at", col(id_col).cast("long").alias("__id"), text.alias("__text"))
             .join(hits.select(F.col("digest").alias("__digest"), F.col("keep.at").alias("__keep_at")), "__digest"))
    texts = materialize(texts, "dedup-hits")
    stay = texts.where(F.col("__at") == F.col("__keep_at")).select("__digest", F.col("__text").alias("__stays"))
    differ = materialize(
        texts.join(stay, "__digest").where(F.col("__text") != F.col("__stays"))
        .select("__digest", "__at", "__id", "__text"), "dedup-clashes")
    if not differ.isEmpty():
        groups = _parted(groups, differ)
        rows = (rows.join(differ.select("__at", F.col("__text").alias("__other")), "__at", "left")
                .withColumn("__class", F.coalesce("__other", F.lit(""))).drop("__other"))
    else:
        groups, rows = groups.withColumn("class", F.lit("")), rows.withColumn("__class", F.lit(""))
    groups = groups.select(F.col("digest").alias("__digest"), F.col("class").alias("__class"), "keep", "n")
    found = rows.join(groups, ["__digest", "__class"])
    return found.select(
        *[col(c) for c in docs.columns if c != "__at"], F.col("keep.id").alias("keep_id"),
        F.col("n").alias("group_size"), (F.col("__at") == F.col("keep.at")).alias("kept"),
        F.col("__digest").alias("text_digest"))


def _parted(groups: DataFrame, differ: DataFrame) -> DataFrame:
    """Groups with the rows whose bytes differ taken out, and one group for each text of those."""
    own = differ.groupBy(F.col("__digest").alias("digest"), F.col("__text").alias("class")).agg(
        F.min(F.struct(F.col("__id").isNull().alias("unknown"), F.col("__id").alias("id"),
                       F.col("__at").alias("at"))).alias("keep"), F.count(F.lit(1)).alias("n"))
    fewer = own.groupBy("digest").agg(F.sum("n").alias("less"))
    same = (groups.join(fewer, "digest", "left").withColumn("n", F.col("n") - F.coalesce("less", F.lit(0)))
            .select("digest", F.lit("").alias("class"), "keep", "n"))
    return same.unionByName(own)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_dedup(docs).select(
        "doc_id", "keep_id", "group_size", "kept", F.col("text_digest").alias("text_sha256"))


OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""
