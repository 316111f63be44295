"""Mixing sources to target weights by Poisson replication.

Each listed source has a target share of the output; all other sources (null
too) share the rest as one pool.  A source's mean repetition rate is its share
times the target size over the number of its rows.  Each document draws a
uniform number from a hash of the seed and its id, and the inverse of the
Poisson distribution with that mean gives its count; the document is repeated
so often (not at all for 0), and the copies are put into one global order by a
hash.  Draws depend on nothing else, so a retried task repeats them and adding
documents leaves the draws of others as they are.

Rates above PART are split into equal parts with a draw each (a sum of Poisson
numbers is one), which keeps the tables of the inverse short.

Rates need one small aggregate: only the listed sources and the pool come to
the driver.  The only shuffle is the global order itself.

Defined results: shares of sources without rows are spread over the rest; rows
with equal ids draw equally; a null id draws like an empty one; columns named
``copy`` or ``shuffle_key`` are replaced; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoleaf.llm.common import col, table, without

SEED = "mix-1"
PART = 24.0                      # largest mean that one draw covers
#: share of the output for listed sources; the pool of all others has POOL
SHARES = {"src0": 0.2, "src1": 0.1, "src2": 0.1}
POOL = 0.6


def poisson_cdf(mean: float) -> list[float]:
    """P(X <= k) for k = 0, 1, ... until the tail is below a uniform number's last bit."""
    out, p, total, k = [], math.exp(-mean), 0.0, 0
    while True:
        total += p
        out.append(min(total, 1.0))
        if k > mean and p < 2.0 ** -60:
            return out
        k += 1
        p *= mean / k


def _uniform(seed: str, id_: Column, part: Column) -> Column:
    """52 bits of a hash as a number in [0, 1)."""
    text = F.concat_ws(":", F.lit(seed), part.cast("string"), F.coalesce(id_.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(2.0 ** 52)


def repetitions(mean: float, seed: str, id_: Column) -> Column:
    """The Poisson number of a document."""
    parts = max(1, math.ceil(mean / PART))
    cdf = F.array(*[F.lit(c) for c in poisson_cdf(mean / parts)])
    draws = F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda i: _uniform(seed, id_, i))
    return F.aggregate(draws, F.lit(0), lambda n, u: n + F.size(F.filter(cdf, lambda c: u >= c)))


def rates(docs: DataFrame, shares: dict[str, float], pool: float, size: float | None = None,
          source_col: str = "source") -> dict[str | None, float]:
    """Mean repetition rate of each listed source, and of the pool (None)."""
    if min([pool, *shares.values()]) < 0:
        raise ValueError("shares are not negative")
    listed = F.when(col(source_col).isin(*shares), col(source_col)) if shares else F.lit(None).cast("string")
    counts = {r.s: r.n for r in docs.groupBy(listed.alias("s")).agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(counts.values())
    wanted = {s: w for s, w in [*shares.items(), (None, pool)] if counts.get(s)}
    whole = sum(wanted.values())
    return {s: w / whole * (total if size is None else size) / counts[s] if whole else 0.0 for s, w in wanted.items()}


def mix_sources(docs: DataFrame, shares: dict[str, float], pool: float, seed: str = SEED, size: float | None = None,
                id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """``docs`` repeated to the target shares, in global random order, with copy (from 0) and shuffle_key."""
    mean = rates(docs, shares, pool, size, source_col)
    docs = without(docs, "copy", "shuffle_key")
    n = F.lit(0) if None not in mean else repetitions(mean[None], seed, col(id_col))
    for s in mean:
        if s is not None:
            n = F.when(col(source_col) == s, repetitions(mean[s], seed, col(id_col))).otherwise(n)
    copies = docs.withColumn("__n", n).where("__n > 0").withColumn(
        "copy", F.explode(F.sequence(F.lit(0), F.col("__n") - 1))).drop("__n")
    key = F.md5(F.concat_ws(":", F.lit(f"{seed}-order"), F.coalesce(col(id_col).cast("string"), F.lit("")),
                            F.col("copy").cast("string")))
    return copies.withColumn("shuffle_key", key).orderBy("shuffle_key")


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"), SHARES, POOL)


OP10_SQL = f"""
WITH tagged AS (
  SELECT *, CASE WHEN source IN ({", ".join(f"'{s}'" for s in SHARES)}) THEN source ELSE '' END AS s FROM documents
), counted AS (SELECT s, count(*) AS n FROM tagged GROUP BY s
), share(s, w) AS (VALUES {", ".join(f"('{s}', {w}::DOUBLE)" for s, w in [*SHARES.items(), ("", POOL)])}
), rate AS (
  SELECT s, w / (SELECT sum(w) FROM share JOIN counted USING (s)) * (SELECT count(*) FROM tagged) / n AS mean
  FROM share JOIN counted USING (s)
), pmf AS (
  SELECT s, k, exp(k * ln(mean) - mean - lgamma(k + 1)) AS p FROM rate, range(0, 101) AS r(k)
), cdf AS (
  SELECT s, k, sum(p) OVER (PARTITION BY s ORDER BY k) AS c FROM pmf
), drawn AS (
  SELECT doc_id, text, lang, source, n_chars, s,
    CAST('0x' || substr(md5('{SEED}:0:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) / 4503599627370496.0 AS u
  FROM tagged
)
SELECT doc_id, text, lang, source, n_chars, CAST(k AS INTEGER) AS "copy",
  md5('{SEED}-order:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || CAST(k AS VARCHAR)) AS shuffle_key
FROM drawn JOIN cdf USING (s) WHERE u >= c
"""
