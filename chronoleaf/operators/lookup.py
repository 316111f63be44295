"""Equality lookups without time: static dimension (J4) and latest snapshot.

A left join that keeps every left row once (the right side is unique on its
keys).  The right side is broadcast only when it is proven to have at most
``broadcast_max_rows`` rows and at most ``broadcast_max_bytes`` bytes
(fixed-width columns by type, strings and nested values by their actual
length); otherwise the join is left to Spark (sort-merge or, with AQE, a
runtime broadcast/skew split).  A plain scan whose files are plainly too large
is turned away by their size, unread; anything else is counted with partial
aggregation, so each task hands on one row.

In a shuffled lookup all left rows of one key meet in one task, and a side that
is read bucketed cannot be split by the skew join.  So the left keys are
sampled first: rows of *hot* keys (and of a hot NULL) stay where they are and
meet a small table of just those keys' right rows; the others are shuffled as
before.  The sample only decides which way a row goes: both ways give the same
result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoleaf.session import materialize

HOT_KEY_ROWS = 1_000_000   # left rows that one task of a shuffled lookup may well hold
HOT_SAMPLE_ROWS = 10_000   # sampled rows of a key right at that number
BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 256 * 1024 * 1024
ROW_OVERHEAD_BYTES = 16  # per row in the broadcast hash relation (header, pointers)

_FIXED = {T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.DateType: 4,
          T.FloatType: 4, T.LongType: 8, T.DoubleType: 8, T.TimestampType: 8,
          T.TimestampNTZType: 8, T.NullType: 0}


def _byte_terms(df: DataFrame):
    """(fixed bytes per row, columns giving the variable bytes of each row)."""
    fixed, var = ROW_OVERHEAD_BYTES, []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        width = _FIXED.get(type(f.dataType))
        if width is not None:
            fixed += width + 1  # value + null flag
        elif isinstance(f.dataType, T.DecimalType):
            fixed += 8 if f.dataType.precision <= 18 else 16
        elif isinstance(f.dataType, (T.StringType, T.BinaryType)):
            fixed += 8
            var.append(F.coalesce(F.octet_length(c), F.lit(0)))
        else:  # nested: its JSON text is an upper bound of the binary form
            fixed += 8
            var.append(F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)))
    return fixed, var


def scanned_bytes(df: DataFrame) -> int | None:
    """Size of the files behind ``df`` if its optimised plan is a bare scan with projections, else None."""
    plan = df._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() == "Project":
        plan = plan.child()
    return int(str(plan.stats().sizeInBytes())) if plan.nodeName().startswith("LogicalRelation") else None


def broadcast_size(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes) of ``df``: one pass, one partial row from each task."""
    fixed, var = _byte_terms(df)
    total = F.lit(0).cast("long")
    for v in var:
        total = total + v.cast("long")
    row = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(total), F.lit(0)).alias("b")).first()
    return int(row["n"]), int(row["n"]) * fixed + int(row["b"])


def checked_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS,
                      max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """``broadcast(df)`` if it has at most ``max_rows`` rows and ``max_bytes`` bytes,
    else ``df`` unchanged (Spark then picks a shuffled join).

    A scan whose files alone pass the byte bound is not read.
    """
    files = scanned_bytes(df)
    if files is not None and files > max_bytes:
        return df
    n, size = broadcast_size(df)
    return F.broadcast(df) if n <= max_rows and size <= max_bytes else df


def hot_keys(df: DataFrame, keys, rows: int = HOT_KEY_ROWS) -> DataFrame | None:
    """The keys of more than about ``rows`` rows by a Bernoulli sample (NULL counts as a key), or None.
    Partial aggregation: a hot key costs one row a task."""
    fraction = min(1.0, HOT_SAMPLE_ROWS / rows)
    part = df.select(*keys)
    if fraction < 1.0:
        part = part.sample(fraction=fraction, seed=7)
    found = part.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > rows * fraction)
    if found.isEmpty():
        return None
    return materialize(found.select(*keys), "hot-keys")   # drawn once: both ways read the same keys


def _equal(a: DataFrame, a_keys, b: DataFrame, b_keys, null_safe: bool = False):
    cond = None
    for x, y in zip(a_keys, b_keys):
        c = a[x].eqNullSafe(b[y]) if null_safe else a[x] == b[y]
        cond = c if cond is None else cond & c
    return cond


def _shuffled_lookup(left: DataFrame, right: DataFrame, left_keys, right_keys, names, hot_rows: int) -> DataFrame:
    """Left join by a shuffle; rows of hot left keys stay where they are."""
    hot = None if left.isStreaming else hot_keys(left, left_keys, hot_rows)
    rest = left
    if hot is not None:
        as_hot = [f"__h{i}" for i in range(len(left_keys))]
        hot = hot.toDF(*as_hot)
        few = checked_broadcast(hot)
        held = right.join(few, _equal(right, right_keys, few, as_hot)).select(*as_hot, *names)
        # one written row for each hot key, with NULL features where the right side lacks it
        held = materialize(held, "hot-rows").toDF(*[f"__r{i}" for i in range(len(left_keys))], *names)
        served = checked_broadcast(materialize(
            hot.join(held, _equal(hot, as_hot, held, held.columns[:len(as_hot)]), "left").select(*as_hot, *names),
            "hot-rows"))
        rest = left.join(few, _equal(left, left_keys, few, as_hot, null_safe=True), "left_anti")
    found = rest.join(right, _equal(rest, left_keys, right, right_keys), "left").select(*left.columns, *names)
    if hot is None:
        return found
    return found.unionByName(left.join(served, _equal(left, left_keys, served, as_hot, null_safe=True))
                             .select(*left.columns, *names))


def key_lookup(left: DataFrame, right: DataFrame, left_keys, right_keys, features=None, *,
               rename: dict | None = None, broadcast: bool | None = None,
               broadcast_max_rows: int = BROADCAST_MAX_ROWS,
               broadcast_max_bytes: int = BROADCAST_MAX_BYTES, hot_rows: int = HOT_KEY_ROWS) -> DataFrame:
    left_keys = [left_keys] if isinstance(left_keys, str) else list(left_keys)
    right_keys = [right_keys] if isinstance(right_keys, str) else list(right_keys)
    if features is None:
        features = [c for c in right.columns if c not in right_keys]
    features = [features] if isinstance(features, str) else list(features)
    rename = dict(rename or {})
    out_names = [rename.get(c, c) for c in features]
    clash = set(out_names) & set(left.columns)
    if clash:
        raise ValueError(f"lookup output collides with label columns {sorted(clash)}; pass rename=")
    tmp_keys = [f"__k{i}" for i in range(len(left_keys))]
    r = right.select(*[F.col(rk).alias(t) for rk, t in zip(right_keys, tmp_keys)],
                     *[F.col(c).alias(n) for c, n in zip(features, out_names)])
    small = r
    if broadcast is None:
        small = checked_broadcast(r, broadcast_max_rows, broadcast_max_bytes)
    elif broadcast:
        small = F.broadcast(r)
    if small is r:
        return _shuffled_lookup(left, r, left_keys, tmp_keys, out_names, hot_rows)
    return left.join(small, _equal(left, left_keys, small, tmp_keys), "left").select(*left.columns, *out_names)


def static_lookup(left, right, left_keys, right_keys, features=None, **kw) -> DataFrame:
    """Dimension lookup (the dimension is small: broadcast after the size check)."""
    return key_lookup(left, right, left_keys, right_keys, features, **kw)


def online_lookup(requests: DataFrame, snapshot: DataFrame, request_keys, snapshot_keys,
                  features=None, **kw) -> DataFrame:
    """Request rows x latest-value snapshot (one row per key)."""
    return key_lookup(requests, snapshot, request_keys, snapshot_keys, features, **kw)
