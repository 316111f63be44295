"""Statistics: exact median (A1), median fill (F6/J8), accuracy (A2), key uniqueness (A4).

Exact median without one task holding a column
----------------------------------------------
``percentile``/``median`` merge every distinct value of the column into a
single final task.  That is fine below a proven bound, so columns with at most
``local_limit`` non-NULL values use ``F.median`` directly (one job for all
columns).  Larger columns are selected by radix: the values become 64-bit
integers of the same order (sign, exponent and mantissa), written once for all
columns; four passes then count the next 16 bits of the keys that share what is
already known of a wanted rank.  Every pass serves all columns and both middle
ranks together, and hands the driver at most 65,536 counts for each of them,
whatever the input; tasks combine before the shuffle.  Interpolation follows
Spark's ``percentile``: position (n - 1) * 0.5 between the two middle ranks.
"""

from __future__ import annotations

import math
import struct
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoleaf.functions._util import as_col
from chronoleaf.session import materialize

LOCAL_LIMIT = 1_000_000   # values one task may hold for F.median (~80 MB of map entries)
DIGIT, DIGITS = 16, 4


def ordered_key(v: Column) -> Column:
    """A double as a long of the same order: its exponent and mantissa, negated for negative values.  Every step is exact:
    powers of two, quotients by them, and a logarithm that is corrected by comparison.  Both zeros give 0, NaN comes last."""
    size = F.abs(v)
    guess = F.floor(F.log2(size))
    power = guess + F.when(size >= F.pow(F.lit(2.0), guess + 1), 1).when(size < F.pow(F.lit(2.0), guess), -1).otherwise(0)
    scale = F.pow(F.lit(2.0), power)
    normal = (power + 1023) * F.lit(1 << 52) + ((size / scale - 1) * F.lit(2.0 ** 52)).cast("long")
    bits = (F.when(size == float("inf"), F.lit(2047 << 52))
            .when(size < 2.0 ** -1022, (size / F.lit(math.ldexp(1.0, -1074))).cast("long")).otherwise(normal))
    return F.when(F.isnan(v), F.lit((1 << 63) - 1)).when(v == 0, F.lit(0).cast("long")).when(v < 0, -bits).otherwise(bits)


def key_value(key: int) -> float:
    """The double of an ordered key."""
    if key == (1 << 63) - 1:
        return float("nan")
    size = struct.unpack("<d", struct.pack("<q", abs(key)))[0]
    return -size if key < 0 else size


def exact_medians(df: DataFrame, cols, *, local_limit: int = LOCAL_LIMIT) -> dict[str, float | None]:
    cols = [cols] if isinstance(cols, str) else list(cols)
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in cols]).first().asDict()
    small = [c for c in cols if counts[c] <= local_limit]
    out: dict[str, float | None] = {}
    if small:
        row = df.agg(*[F.median(F.col(c).cast("double")).alias(c) for c in small]).first()
        out.update({c: row[c] for c in small})
    large = [c for c in cols if c not in out]
    if large:
        found = _by_radix(df, large, counts)
        for c in large:
            lo, hi = found[c]
            out[c] = lo if lo == hi or math.isnan(lo) else 0.5 * lo + 0.5 * hi
    return out


def _by_radix(df: DataFrame, cols: list[str], counts: dict[str, int]) -> dict[str, tuple[float, float]]:
    """The values of the two middle ranks of each column."""
    # one row for each value before the keys: the key of one column is code that the JVM compiles, that of all columns is not
    values = F.explode(F.array(*[F.struct(F.lit(i).alias("c"), F.col(c).cast("double").alias("v")) for i, c in enumerate(cols)]))
    pairs = materialize(df.select(values.alias("p")).select("p.*").where(F.col("v").isNotNull())
                        .select("c", ordered_key(F.col("v")).alias("k")), "median-keys")
    # (column, which middle) -> (known leading digits, rank among the keys that share them)
    want = {(i, r): (None, rank) for i, c in enumerate(cols) for r, rank in enumerate(((counts[c] - 1) // 2, counts[c] // 2))}
    for done in range(DIGITS):
        shift = 64 - DIGIT * (done + 1)
        if done:
            lead = F.shiftright("k", shift + DIGIT)
            known = [(F.col("c") == i) & (lead == at) for i, at in sorted({(i, w[0]) for (i, _), w in want.items()})]
            part = pairs.where(reduce(Column.__or__, known))
        else:
            part = pairs
        seen: dict[tuple, list] = {}
        for r in part.groupBy("c", F.shiftright("k", shift).alias("lead")).count().collect():
            seen.setdefault((r.c, r.lead >> DIGIT if done else None), []).append((r.lead, r["count"]))
        for name, (lead, rank) in want.items():
            for at, n in sorted(seen[name[0], lead]):
                if rank < n:
                    want[name] = (at, rank)
                    break
                rank -= n
    return {c: (key_value(want[i, 0][0]), key_value(want[i, 1][0])) for i, c in enumerate(cols)}


def fill_with(df: DataFrame, values: dict[str, float | None]) -> DataFrame:
    """coalesce(col, constant) for each column: the one-row statistics applied to
    every row as literals (no cross join)."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType))
                           for c, v in values.items()})


def fill_median(df: DataFrame, cols, **kw) -> DataFrame:
    return fill_with(df, exact_medians(df, cols, **kw))


def accuracy_col(label, prediction) -> Column:
    """Aggregate: share of rows whose label equals the prediction (NULL = miss)."""
    hit = (as_col(label) == as_col(prediction)).cast("double")
    return F.avg(F.coalesce(hit, F.lit(0.0)))


def accuracy(df: DataFrame, label, prediction) -> DataFrame:
    """One row: ``accuracy``."""
    return df.agg(accuracy_col(label, prediction).alias("accuracy"))


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Key tuples occurring more than once, with their count."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
