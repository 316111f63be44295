"""Time buckets that split hot keys (shared by the rolling and as-of operators).

A per-key pre-aggregate (partial aggregation, so a hot key costs one row per
map task) finds the *heavy* keys: more than ``target_rows`` rows.  It reads a
Bernoulli sample holding about ``sample_rows`` rows of a key at the threshold
(1 % for the default 1M; exact below ``sample_rows``).  Each heavy key gets cut
points at the sampled quantiles of its own times, so that a sale day or a
backfill fills many buckets and an idle year few; rows of one second stay
together.  Its NULL-time rows, which meet only each other, are dealt into as
many salted buckets as they need.  Every other key keeps one bucket and needs
no carry rows.

The sample only decides how the work is split: results are exact for any
bucketing, because all sides of an operator take their cuts from one written
table and the carry rows bridge every bucket boundary.  There are at most
``total_rows / target_rows`` heavy keys and about as many cut points.  The table
is broadcast if it is proven small, else joined by the keys (its side is unique,
and the skew join splits the other).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoleaf.operators.lookup import checked_broadcast
from chronoleaf.session import materialize

TARGET_BUCKET_ROWS = 1_000_000
SAMPLE_ROWS = 10_000  # sampled rows of a key right at the threshold
SAMPLE_SEED = 7
MOST_CUTS = 1 << 16   # quantiles of one key
NULL_BUCKETS = -(1 << 62)   # buckets of NULL times start here
FIRST_BUCKET = -(1 << 61)   # bucket before the first cut; all NULL-time buckets are smaller


@dataclass(frozen=True)
class Bucketing:
    mode: str  # "none" | "heavy" | "uniform"
    heavy: DataFrame | None = None   # keys, __w (groups of cut points), __u (buckets for NULL times)
    width: int | None = None


def plan_buckets(sources: list[DataFrame], keys: list[str], secs_col: str = "__s", *,
                 target_rows: int = TARGET_BUCKET_ROWS, sample_rows: int | None = None) -> Bucketing:
    """``sources``: DataFrames with the key columns and whole seconds in ``secs_col``."""
    if target_rows <= 0:
        raise ValueError("target_rows must be positive")
    u = None
    for s in sources:
        part = s.select(*keys, secs_col)
        u = part if u is None else u.unionByName(part)
    fraction = min(1.0, (sample_rows or SAMPLE_ROWS) / target_rows)
    if fraction < 1.0:
        u = u.sample(fraction=fraction, seed=SAMPLE_SEED)
    cut = target_rows * fraction  # sampled rows of a key right at the threshold
    stats = (u.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), F.count(secs_col).alias("__timed"))
             .where(F.col("__n") > F.lit(cut)))
    if stats.isEmpty():
        return Bucketing("none")  # the usual case: one job, nothing written
    # drawn once: every use reads the same cuts from one written table
    stats = materialize(stats, "heavy-keys")
    most = stats.agg(F.max("__timed")).first()[0]
    if most is None:
        return Bucketing("none")
    # twice as many quantiles as needed: sampling noise stays inside the target
    q = min(MOST_CUTS, max(2, 2 * math.ceil(most / cut)))
    quantiles = (_on_keys(u.where(F.col(secs_col).isNotNull()), stats, keys, [])
                 .groupBy(*keys).agg(F.percentile_approx(secs_col, [i / q for i in range(q)], max(10_000, 10 * q))
                                     .alias("__q")))
    wanted = F.greatest(F.lit(1), F.floor(F.lit(q * cut / 2) / F.greatest("__timed", F.lit(1))))  # every how manieth
    cuts = F.array_distinct(F.filter("__q", lambda c, i: i % F.col("__step") == 0))
    # groups of about the square root of their number: a row is placed by two short searches
    size = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size("__c"))).cast("int"))
    groups = F.when(F.size("__c") > 0, F.transform(
        F.sequence(F.lit(0), F.floor((F.size("__c") - 1) / F.col("__size")).cast("int")),
        lambda i: F.slice("__c", i * F.col("__size") + 1, F.col("__size")))).otherwise(
            F.array(F.array(F.lit(FIRST_BUCKET))))
    heavy = (_on_keys(stats, quantiles, keys, ["__q"], how="left")
             .withColumn("__step", wanted.cast("int"))
             .withColumn("__c", F.coalesce(cuts, F.array().cast("array<bigint>"))).withColumn("__size", size)
             .select(*keys, groups.alias("__w"),
                     F.greatest(F.lit(1), F.ceil((F.col("__n") - F.col("__timed")) / F.lit(cut))).cast("long").alias("__u")))
    return Bucketing("heavy", heavy=materialize(heavy, "heavy-cuts"))


def _on_keys(df: DataFrame, other: DataFrame, keys: list[str], take: list[str], how: str = "inner") -> DataFrame:
    """``df`` with the columns ``take`` of ``other`` (unique on the keys; NULL keys match)."""
    tmp = [f"__hk{i}" for i in range(len(keys))]
    h = checked_broadcast(other.select(*[F.col(k).alias(t) for k, t in zip(keys, tmp)], *take))
    cond = None
    for k, t in zip(keys, tmp):
        c = df[k].eqNullSafe(h[t])
        cond = c if cond is None else cond & c
    return df.join(h, cond, how).select(*[df[c] for c in df.columns], *take)


def attach_width(df: DataFrame, b: Bucketing, keys: list[str]) -> DataFrame:
    """Append ``__w`` (how the key is cut, NULL for a one-bucket key) and ``__u`` (its NULL-time buckets)."""
    if b.mode == "heavy":
        return _on_keys(df, b.heavy, keys, ["__w", "__u"], how="left")
    width = F.lit(b.width) if b.mode == "uniform" else F.lit(None)
    return df.withColumns({"__w": width.cast("long"), "__u": F.lit(None).cast("long")})


def bucket_expr(b: Bucketing, secs_col: str = "__s", salt: Column | None = None) -> Column:
    """Bucket of a row from its seconds and ``__w``.  NULL times: NULL, or one of the
    salted buckets of a split key (``salt``: a number that rows with equal keys differ in)."""
    s, w = F.col(secs_col), F.col("__w")
    if b.mode != "heavy":
        return (F.when(s.isNull(), F.lit(None).cast("long")).when(w.isNull(), F.lit(0).cast("long"))
                .otherwise(F.floor(s / w)))
    group = F.try_element_at(F.filter(w, lambda g: F.get(g, F.lit(0)) <= s), F.lit(-1))
    timed = F.coalesce(F.array_max(F.filter(group, lambda c: c <= s)), F.lit(FIRST_BUCKET))
    untimed = F.lit(None).cast("long") if salt is None else F.lit(NULL_BUCKETS) + F.pmod(salt, F.col("__u"))
    return (F.when(w.isNull(), F.when(s.isNotNull(), F.lit(0).cast("long")))
            .when(s.isNull(), untimed).otherwise(timed))


def add_bucket(df: DataFrame, b: Bucketing, keys: list[str], secs_col: str = "__s", salt: Column | None = None) -> DataFrame:
    """Append ``__b`` (bucket) and ``__heavy`` (the key needs carry rows)."""
    out = attach_width(df, b, keys)
    return out.withColumns({"__b": bucket_expr(b, secs_col, salt), "__heavy": F.col("__w").isNotNull()}) \
        .drop("__w", "__u")
