"""Row splits: time cut-off (P5) and a stable hash split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoleaf.functions._util import as_col


def time_split(df: DataFrame, ts, cutoff: str) -> tuple[DataFrame, DataFrame]:
    """(rows with ts < cutoff, rows with ts >= cutoff); NULL ts is in neither.

    Plain comparisons, so both halves push down to the parquet scan.
    """
    t = as_col(ts)
    kind = "timestamp"
    if isinstance(ts, str) and df.schema[ts].dataType.typeName() == "timestamp_ntz":
        kind = "timestamp_ntz"  # compare in the column's own type so the filter pushes down
    bound = F.lit(cutoff).cast(kind)
    return df.where(t < bound), df.where(t >= bound)


def hash_bucket(row_id, seed: int = 123, buckets: int = 4) -> Column:
    """Deterministic bucket in [0, buckets) from md5(seed:id): independent of
    partitioning and re-execution, so lost executors re-create the same split."""
    key = F.concat(F.lit(f"{seed}:"), as_col(row_id).cast("string"))
    hex8 = F.substring(F.md5(key), 1, 8)
    return (F.conv(hex8, 16, 10).cast("long") % F.lit(buckets)).cast("int")


def hash_split(df: DataFrame, row_id, train_fraction_quarters: int = 3, seed: int = 123,
               buckets: int = 4) -> tuple[DataFrame, DataFrame]:
    """(train, test): bucket < ``train_fraction_quarters`` goes to train (75/25 by default)."""
    b = hash_bucket(row_id, seed, buckets)
    return df.where(b < train_fraction_quarters), df.where(b >= train_fraction_quarters)
