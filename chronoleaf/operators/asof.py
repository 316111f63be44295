"""Point-in-time (as-of) left lookups (J1-J3), one or several in one pass.

For every left (label) row: the newest right (feature) row with equal keys and
feature time <= label time (inclusive, full timestamp precision).  The whole
newest row is returned: a NULL feature in it stays NULL (no per-column
back-fill).  Exactly one output row per left row; misses, NULL keys and NULL
times give NULL features.  Right rows with a NULL key or time never match.

Plan (``strategy="buckets"``, default): no range join and no pairs.  Left and
right rows are unioned, shuffled once by (key, time bucket), sorted by time
(right before left at equal time; right rows tied on time in payload order, so
a retried task picks the same row) and a running ``last(payload, ignorenulls)``
hands each left row the newest preceding right row.  Ordinary keys have one
bucket; hot keys are split into time buckets (see
:mod:`chronoleaf.operators.skew`) and the newest right row *before* a bucket
starts is supplied by one carry row per (key, bucket) - a ``max_by``
pre-aggregate over key x bucket followed by a running ``last`` over buckets.
``strategy="window"`` is the same without buckets.

Several lookups (:func:`asof_lookups`) whose keys start with the same label
column and which use the same label time travel together: all their feature
rows, tagged by table, and the label rows form one union, which is shuffled
once by the key columns that all of them share.  Tables with equal keys share
the sort and the window (one running ``last`` each); a table with further key
columns is sorted again in place, as the partitioning by fewer columns serves
it too.  So the label rows, the widest part, cross the network once per leading
key and not once per lookup.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronoleaf.operators.latest import orderable
from chronoleaf.operators.skew import (NULL_BUCKETS, TARGET_BUCKET_ROWS, Bucketing, attach_width, bucket_expr,
                                       plan_buckets)

MISS_BUCKETS = 1 << 20  # buckets of label rows that cannot match, in passes after the first
RESERVED = ("__o", "__time", "__b", "__p", "__s", "__w", "__u", "__l", "__t")


@dataclass(frozen=True)
class AsOf:
    """One lookup of :func:`asof_lookups`: ``features`` (default: all but keys and time) of ``right``."""
    right: DataFrame
    left_keys: list
    right_keys: list
    left_ts: str
    right_ts: str
    features: list | None = None
    rename: dict = field(default_factory=dict)

    def resolved(self) -> AsOf:
        """With lists for single names and the features spelled out."""
        left_keys, right_keys = (
            [k] if isinstance(k, str) else list(k) for k in (self.left_keys, self.right_keys))
        if len(left_keys) != len(right_keys):
            raise ValueError("left and right key lists differ in length")
        features = self.features
        if features is None:
            features = [c for c in self.right.columns if c not in right_keys and c != self.right_ts]
        features = [features] if isinstance(features, str) else list(features)
        missing = [c for c in features if c not in self.right.columns]
        if missing:
            raise ValueError(f"features not in the feature table: {missing}")
        return AsOf(self.right, left_keys, right_keys, self.left_ts, self.right_ts, features,
                    dict(self.rename or {}))

    @property
    def out_names(self) -> list:
        return [self.rename.get(c, c) for c in self.features]


def asof_join(left: DataFrame, right: DataFrame, left_keys, right_keys, left_ts: str,
              right_ts: str, features=None, *, rename: dict | None = None,
              strategy: str = "buckets", bucket_seconds: int | None = None,
              target_rows: int = TARGET_BUCKET_ROWS,
              left_key_source: DataFrame | None = None) -> DataFrame:
    """Point-in-time left lookup of ``features`` from ``right`` onto ``left``.

    ``left_key_source``: a DataFrame with the same left key and time columns
    whose key statistics stand for ``left`` (e.g. the original label rows when
    ``left`` is the output of earlier lookups), so the statistics pass does
    not recompute earlier joins.  ``bucket_seconds`` forces uniform buckets.
    """
    return asof_lookups(left, [AsOf(right, left_keys, right_keys, left_ts, right_ts, features, rename)],
                        strategy=strategy, bucket_seconds=bucket_seconds, target_rows=target_rows,
                        left_key_source=left_key_source)


def asof_lookups(left: DataFrame, lookups: list[AsOf], *, strategy: str = "buckets",
                 bucket_seconds: int | None = None, target_rows: int = TARGET_BUCKET_ROWS,
                 left_key_source: DataFrame | None = None) -> DataFrame:
    """All ``lookups`` onto ``left``, one pass per leading key; features in the order of the lookups."""
    if strategy not in ("buckets", "window"):
        raise ValueError(f"unknown strategy {strategy!r}")
    lookups = [lk.resolved() for lk in lookups]
    names = list(left.columns)
    for lk in lookups:
        clash = set(lk.out_names) & set(names)
        if clash:
            raise ValueError(f"lookup output collides with label columns {sorted(clash)}; pass rename=")
        names += lk.out_names
    internal = {*RESERVED, *[f"{p}{i}" for p in ("__p", "__k") for i in range(len(names))]}
    if internal & set(left.columns):
        raise ValueError(f"label columns may not use reserved names {sorted(internal & set(left.columns))}")
    source = left if left_key_source is None else left_key_source
    out = left
    for i, group in enumerate(_groups(left, lookups)):
        out = _one_pass(out, source, group, strategy, bucket_seconds, target_rows, first=i == 0)
    return out.select(*names)


def _groups(left: DataFrame, lookups: list[AsOf]) -> list[list[AsOf]]:
    """Lookups that share the leading label key, the label time and the types they meet in."""
    groups: dict[tuple, list[AsOf]] = {}
    for lk in lookups:
        types = _meeting_types(left, lk)
        shared = (lk.left_ts, _time_type(left, lk), lk.left_keys[0], types[lk.left_keys[0]])
        same = [g for g in groups if g[:4] == shared and
                all(types.get(k, t) == t for k, t in dict(g[4]).items())]
        if same:
            members = groups.pop(same[0])
            groups[(*shared, tuple((dict(same[0][4]) | types).items()))] = [*members, lk]
        else:
            groups[(*shared, tuple(types.items()))] = [lk]
    return list(groups.values())


def _meeting_types(left: DataFrame, lk: AsOf) -> dict:
    """The type in which each label key meets its feature key: the wider of the two."""
    return {k: _common_type(left, left.schema[k].dataType, lk.right.schema[r].dataType)
            for k, r in zip(lk.left_keys, lk.right_keys)}


def _time_type(left: DataFrame, lk: AsOf) -> str:
    lt, rt = left.schema[lk.left_ts].dataType, lk.right.schema[lk.right_ts].dataType
    return lt.simpleString() if lt == rt else "timestamp"


def _one_pass(left: DataFrame, source: DataFrame, group: list[AsOf], strategy: str,
              bucket_seconds: int | None, target_rows: int, first: bool) -> DataFrame:
    """``left`` with the features of all lookups of a group, through one shuffle."""
    label_cols, left_ts, time_type = list(left.columns), group[0].left_ts, _time_type(left, group[0])
    types = {}
    for lk in group:
        types |= _meeting_types(left, lk)
    # a key that meets in a wider type gets a column of its own; the label's column stays as it is
    named = {k: k if left.schema[k].dataType == t else f"__k{i}" for i, (k, t) in enumerate(types.items())}
    on = [[named[k] for k in lk.left_keys] for lk in group]
    lead = _common_prefix(on)

    def seconds(c):
        return F.unix_seconds(F.col(c).cast("timestamp"))

    widened = [F.col(k).cast(types[k]).alias(n) for k, n in named.items() if n != k]
    lrows = left.select(*label_cols, *widened, F.col(left_ts).cast(time_type).alias("__time"),
                        F.lit(2).alias("__o"))
    # label rows with a NULL key or time can never match (such feature rows are
    # dropped): they go straight to the result and take no part in the shuffle.
    # In a later pass that would run the earlier ones twice: there they are dealt
    # into buckets of their own
    can_match = _all_not_null([*lead, "__time"])
    misses = lrows.where(~can_match) if first else None
    lrows = (lrows.where(can_match) if first else lrows).withColumn("__s", seconds("__time"))
    tables = []
    for i, lk in enumerate(group):
        payload = F.struct(*[F.col(c).alias(n) for c, n in zip(lk.features, lk.out_names)])
        tables.append(
            lk.right.where(_all_not_null(lk.right_keys + [lk.right_ts]))
            .select(*[F.col(r).cast(types[k]).alias(named[k]) for k, r in zip(lk.left_keys, lk.right_keys)],
                    F.col(lk.right_ts).cast(time_type).alias("__time"), F.lit(1).alias("__o"),
                    F.lit(i).alias("__t"), payload.alias(f"__p{i}"))
            .withColumn("__s", seconds("__time")))

    if strategy == "window":
        plan = Bucketing("none")
    elif bucket_seconds:
        plan = Bucketing("uniform", width=int(bucket_seconds))
    else:
        keys = {n: F.col(k).cast(types[k]).alias(n) for k, n in named.items() if n in lead}
        plan = plan_buckets([source.select(*keys.values(), seconds(left_ts).alias("__s"))
                             .where(_all_not_null([*lead, "__s"])),
                             *[t.select(*lead, "__s") for t in tables]], lead, "__s",
                            target_rows=target_rows)

    def bucketed(df: DataFrame) -> DataFrame:
        return attach_width(df, plan, lead).withColumn("__b", bucket_expr(plan, "__s"))

    lrows, tables = bucketed(lrows), [bucketed(t) for t in tables]
    if not first:
        mix = F.xxhash64(*[c for c in label_cols if orderable(left.schema[c].dataType)])
        lrows = lrows.withColumn("__b", F.when(can_match, F.col("__b")).otherwise(
            F.lit(NULL_BUCKETS) + F.pmod(mix, F.lit(MISS_BUCKETS))))
    u = lrows
    for t in tables:
        u = u.unionByName(t, allowMissingColumns=True)
    if plan.mode != "none":
        for i, t in enumerate(tables):
            u = u.unionByName(_carry(lrows, t, on[i], i), allowMissingColumns=True)

    # fewest key columns first: its partitioning serves the others as well
    key_sets = sorted({tuple(k) for k in on}, key=len)
    if list(key_sets[0]) != lead:
        u = u.repartition(*lead, "__b")
    for at, keys in enumerate(key_sets):
        here = [i for i, k in enumerate(on) if tuple(k) == keys]
        # right rows tied on (key, time): the greatest payload is "newest" (deterministic)
        ties = [F.col(f"__p{i}").asc_nulls_first() for i in here if orderable(u.schema[f"__p{i}"].dataType)]
        w = (Window.partitionBy(*keys, "__b")
             .orderBy(F.col("__time").asc_nulls_first(), "__o", *ties)
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        u = u.withColumns({f"__p{i}": F.last(f"__p{i}", ignorenulls=True).over(w) for i in here})
        later = [i for i, k in enumerate(on) if tuple(k) in key_sets[at + 1:]]
        wanted = F.col("__o") == 2
        u = u.where(wanted | F.col("__t").isin(later) if later else wanted)

    found = u.select(*label_cols, *[F.col(f"__p{i}").getField(n).alias(n)
                                    for i, lk in enumerate(group) for n in lk.out_names])
    if misses is None:
        return found
    return found.unionByName(misses.select(*label_cols, *[
        F.lit(None).cast(lk.right.schema[c].dataType).alias(n)
        for lk in group for c, n in zip(lk.features, lk.out_names)]))


def _carry(lrows: DataFrame, rrows: DataFrame, keys: list, i: int) -> DataFrame:
    """The newest right row before each label bucket of a split key starts."""
    payload, p = rrows.schema[f"__p{i}"].dataType, f"__p{i}"
    newest = F.struct("__time", p) if orderable(payload) else F.col("__time")
    per_bucket = (
        rrows.where(F.col("__w").isNotNull())
        .select(*keys, "__b", "__time", p, F.lit(False).alias("__l"))
        .unionByName(lrows.where(F.col("__w").isNotNull() & _all_not_null([*keys, "__time"]))
                     .select(*keys, "__b",
                             F.lit(None).cast(rrows.schema["__time"].dataType).alias("__time"),
                             F.lit(None).cast(payload).alias(p), F.lit(True).alias("__l")))
        .groupBy(*keys, "__b").agg(F.max_by(p, newest).alias(p), F.max("__l").alias("__l")))
    before = (Window.partitionBy(*keys).orderBy("__b")
              .rowsBetween(Window.unboundedPreceding, -1))
    return (per_bucket.select(*keys, "__b", "__l", F.last(p, ignorenulls=True).over(before).alias(p))
            .where(F.col("__l") & F.col(p).isNotNull())
            .select(*keys, "__b", F.lit(0).alias("__o"), F.lit(i).alias("__t"), p))


def _common_prefix(lists: list[list]) -> list:
    shared = []
    for column in zip(*lists):
        if len(set(column)) > 1:
            break
        shared.append(column[0])
    return shared


def _common_type(left: DataFrame, lt, rt):
    """The wider type of two key columns, by Spark's own rules."""
    if lt == rt:
        return lt
    both = [f"CAST(NULL AS {t.simpleString()})" for t in (lt, rt)]
    return left.sparkSession.sql(f"SELECT coalesce({', '.join(both)}) AS k").schema["k"].dataType


def _all_not_null(cols):
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond
