"""Small helpers shared by the operators: table access and column selection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from chronoleaf.session import materialize


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def col(name: str):
    """A column by its exact name (dots and spaces included)."""
    return F.col(f"`{name}`")


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` less the named columns: a result column replaces an input column of its name."""
    low = {n.lower() for n in names}
    return df.select(*[col(c) for c in df.columns if c.lower() not in low])


def placed(docs: DataFrame, name: str, purpose: str) -> DataFrame:
    """``docs`` with the column ``name``: the place of each row, its file and row number there.  Places tell rows apart
    only in a plain scan of one path: exploded or joined rows share one, and a path given twice is read twice.  All
    other input is written first."""
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    if _plain_scan(docs):
        try:
            return docs.withColumn(name, place)
        except AnalysisException:                          # a format without row numbers
            pass
    return materialize(docs, purpose).withColumn(name, place)


def _plain_scan(df: DataFrame) -> bool:
    plan = df._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() in ("Project", "Filter"):
        plan = plan.child()
    return (plan.nodeName().startswith("LogicalRelation")
            and plan.relation().getClass().getSimpleName() == "HadoopFsRelation"
            and plan.relation().location().rootPaths().size() == 1)


BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Hand texts to Python in batches of bounded rows and bytes (a lower limit of the session stays).
    Only memory depends on it, never a result."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS),
                      ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = spark.conf.get(key).lower().removesuffix("b")
        if not (now.isdigit() and 0 < int(now) <= most):
            spark.conf.set(key, str(most))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
