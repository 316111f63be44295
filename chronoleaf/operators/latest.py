"""Latest row per key (A3) and merge-log resolution.

Both are a (sort-based) aggregate with ``max_by``: partial aggregation combines a hot
key map-side, so skew costs one partial row per map task, never one task
holding the key's rows.  Ties on the ordering columns are broken by the whole
row, so the result is deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoleaf.operators.lookup import BROADCAST_MAX_BYTES, broadcast_size


def orderable(dt) -> bool:
    """Spark can sort by this type (maps cannot be compared)."""
    if isinstance(dt, T.MapType):
        return False
    if isinstance(dt, T.StructType):
        return all(orderable(f.dataType) for f in dt.fields)
    if isinstance(dt, T.ArrayType):
        return orderable(dt.elementType)
    return True


def latest_per_key(df: DataFrame, keys, order_by, columns=None) -> DataFrame:
    """One row per ``keys``: the row with the greatest ``order_by`` tuple
    (NULLs oldest), other columns as tie-break (maps by their JSON text)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    order_by = [order_by] if isinstance(order_by, str) else list(order_by)
    columns = [c for c in (columns or df.columns) if c not in keys]
    ordering = F.struct(*[F.col(c) for c in order_by],
                        *[F.col(c) if orderable(df.schema[c].dataType) else F.to_json(F.struct(c))
                          for c in columns if c not in order_by])
    return (df.groupBy(*keys)
            .agg(F.max_by(F.struct(*[F.col(c) for c in columns]), ordering).alias("__r"))
            .select(*keys, *[F.col(f"__r.{c}").alias(c) for c in columns]))


def resolve_merge_log(log: DataFrame, keys, ingest_col: str = "_ingest_ts") -> DataFrame:
    """Upsert semantics over an append-only log: the last write per key wins."""
    cols = [c for c in log.columns if c != ingest_col]
    keys = [keys] if isinstance(keys, str) else list(keys)
    resolved = latest_per_key(log, keys, [ingest_col], columns=cols + [ingest_col])
    return resolved.select(*cols)


FOLD_MAX_KEYS = 2_000_000


def fold_recent(snapshot: DataFrame, recent: DataFrame, keys, order_by, columns,
                max_keys: int = FOLD_MAX_KEYS) -> DataFrame:
    """``latest_per_key(snapshot ∪ recent)`` for a snapshot that already holds one
    row per key, without shuffling the snapshot when few keys changed.

    The keys touched by ``recent`` are counted (rows and bytes, one bounded pass);
    at most ``max_keys`` of them, within the broadcast byte bound, are
    broadcast: untouched snapshot rows pass through an anti join, touched ones
    are re-resolved together with the recent rows.  Beyond the bound, or when
    nothing changed, the plain plans are used.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    columns = [c for c in columns if c not in keys]
    changed = recent.select(*keys).distinct()
    n, size = broadcast_size(changed)
    if n == 0:
        return snapshot.select(*keys, *columns)
    if n > max_keys or size > BROADCAST_MAX_BYTES:
        return latest_per_key(snapshot.select(*keys, *columns).unionByName(
            recent.select(*keys, *columns)), keys, order_by, columns)
    tmp = [f"__ck{i}" for i in range(len(keys))]
    b = F.broadcast(changed.select(*[F.col(k).alias(t) for k, t in zip(keys, tmp)]))
    cond = None
    for k, t in zip(keys, tmp):
        c = snapshot[k].eqNullSafe(b[t])
        cond = c if cond is None else cond & c
    untouched = snapshot.join(b, cond, "left_anti").select(*keys, *columns)
    touched = latest_per_key(
        snapshot.join(b, cond, "left_semi").select(*keys, *columns)
        .unionByName(recent.select(*keys, *columns)), keys, order_by, columns)
    return untouched.unionByName(touched)
