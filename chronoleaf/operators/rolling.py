"""Rolling time-range aggregates.

Semantics (identical for both strategies): for every input row, aggregate the
rows with the same key whose whole-second time lies in ``[t - seconds, t]``
(both ends inclusive, same-second rows are peers, the row itself is inside
unless ``exclude_current`` is set; then its same-second peers stay).
Rows with a NULL time see only the NULL-time rows of their key.  NULL keys form
one group.  One output row per input row; the input columns are kept.

Strategies
----------
``"events"`` (default, scales):
    Spark's sliding RANGE frame re-aggregates its whole frame buffer for every
    row and keeps that buffer in memory, so a dense key costs O(rows x window)
    and one hot key runs in one task.  Instead every row becomes an *entry*
    event (+value at t) and one *exit* event per window length (-value at
    t + seconds + 1).  A running sum over the events ordered by time then equals
    the window aggregate.  Hot keys are split into time buckets (see
    :mod:`chronoleaf.operators.skew`); the sum of all earlier buckets of such a
    key arrives as one *carry* row per bucket (a small aggregate over
    key x bucket), unioned in, not joined.  Cost: one scan for the per-key
    statistics, one wide shuffle of ~(1 + #lengths) narrow events per row,
    linear running windows; a hot key spreads over its buckets.
    Sums of doubles run in 64-bit integer digits (see ``Limbs``), laid over the
    range of the data, so nothing of the input is rounded away and no error
    builds up; a column of short decimals is summed as decimals; keys whose values lie too far apart for a few digits run beside the
    others with as many as they need (70 hold every double).  Rows with a
    NULL time of a hot key are dealt into salted buckets; each bucket's carry row
    holds the total of the others.

``"window"``:
    the plain built-in ``rangeBetween`` window (one shuffle by key).  Kept as the
    reference implementation for tests and small inputs.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoleaf.functions._util import as_col
from chronoleaf.functions.time import epoch_seconds
from chronoleaf.operators.lookup import checked_broadcast
from chronoleaf.operators.skew import (FIRST_BUCKET, TARGET_BUCKET_ROWS, Bucketing, attach_width,
                                       bucket_expr, plan_buckets)
from chronoleaf.session import materialize


@dataclass(frozen=True)
class Rolling:
    """One rolling aggregate: ``sum`` of ``value`` or ``count`` of rows/non-NULL values."""

    name: str
    seconds: int
    kind: str = "sum"
    value: object = None  # column name or Column; None with kind="count" -> count(*)
    exclude_current: bool = False  # leave the row itself out (rows of the same second stay in)

    def __post_init__(self):
        if self.kind not in ("sum", "count"):
            raise ValueError(f"unsupported rolling aggregate {self.kind!r}")
        if self.kind == "sum" and self.value is None:
            raise ValueError("a rolling sum needs a value")
        if self.seconds < 0:
            raise ValueError("window length must be >= 0 seconds")


def rolling_sum(name: str, value, seconds: int, *, exclude_current: bool = False) -> Rolling:
    return Rolling(name, int(seconds), "sum", value, exclude_current)


def rolling_count(name: str, seconds: int, value=None, *, exclude_current: bool = False) -> Rolling:
    return Rolling(name, int(seconds), "count", value, exclude_current)


DIGIT_BITS = 30      # of a limb: a 64-bit slot adds up 2^33 of them
CORE_LIMBS = 6       # more are used only for the keys that need them
CORE_LOW = -90       # finest place of the core limbs where the data's range passes them
PLACES = (0, 2, 4, 6)  # decimal places of columns summed as decimals
_FLOATS = (T.FloatType, T.DoubleType)


@dataclass(frozen=True)
class Limbs:
    """Exact sums of doubles: a value is cut into digits of 30 bits, the first at 2^low; each digit is summed in a
    64-bit integer slot, so adding and subtracting lose nothing.  A column whose values are all decimals of at most
    ``places`` places (money) is summed as these decimals: the digits are those of the value times 10^places.
    ``odd``: NaN and infinities are counted too; ``nulls``: the values that are there are counted too."""

    low: int
    count: int
    odd: bool = True
    nulls: bool = True
    places: int | None = None

    @property
    def weights(self) -> list[float]:
        return [math.ldexp(1.0, self.low + DIGIT_BITS * k) for k in range(self.count)]

    @classmethod
    def over(cls, least: float | None, most: float | None, odd: bool, nulls: bool) -> Limbs:
        """For values whose sizes lie between ``least`` and ``most`` (None: no value but zeros)."""
        if least is None:
            return cls(0, 1, odd, nulls)
        low = max(math.frexp(least)[1] - 53, -1074)            # the lowest bit that any of them can have
        return cls(low, (math.frexp(most)[1] - 1 - low) // DIGIT_BITS + 1, odd, nulls)

    @classmethod
    def of_decimals(cls, most: float | None, odd: bool, nulls: bool, places: int) -> Limbs:
        return cls(0, 1 if (most or 0.0) * 10 ** places < 1 << DIGIT_BITS else 2, odd, nulls, places)

    def digits(self, v):
        """The signed digits of a double, lowest first.  Remainders and quotients by powers of two are exact."""
        size, w = F.abs(v), self.weights
        known = v.isNotNull() & ~F.isnan(v) & (size < float("inf"))
        if self.places is not None:
            size = F.rint(size * F.lit(10.0 ** self.places))
        out = []
        for k in range(self.count):
            rest = size % F.lit(w[k + 1]) if k + 1 < self.count else size
            digit = F.floor(rest / F.lit(w[k]))
            out.append(F.when(known, F.when(v < 0, -digit).otherwise(digit)).otherwise(F.lit(0)).cast("long"))
        if self.odd:
            out += [F.when(c, F.lit(1)).otherwise(F.lit(0)).cast("long")
                    for c in (F.isnan(v), v == float("inf"), v == float("-inf"))]
        return out

    def normal(self, slots: list) -> list:
        """The same total with what each digit holds beyond 30 bits moved one digit up: of a total of fewer than 2^33
        rows, every digit but the last is then below 2^34."""
        mask, out = F.lit((1 << DIGIT_BITS) - 1), []
        for k in range(self.count):
            own = slots[k].bitwiseAND(mask) if k + 1 < self.count else slots[k]
            out.append(own + F.shiftright(slots[k - 1], DIGIT_BITS) if k else own)
        return out + list(slots[self.count:])

    def value(self, *slots):
        """The double that the summed digits stand for: the sign first, then digits of that sign from the lowest up,
        so nothing cancels and the result is within one place of the exact sum; decimals are rounded once."""
        zero, mask = F.lit(0).cast("long"), F.lit((1 << DIGIT_BITS) - 1)
        limbs = [F.coalesce(s, zero) for s in slots[:self.count]]

        def moved(x, carry):
            return F.shiftright(x if carry is None else x + carry, DIGIT_BITS)

        if self.places is not None:
            high = moved(limbs[0], None) + (limbs[1] if self.count > 1 else zero)
            low, unit = limbs[0].bitwiseAND(mask), 1 << DIGIT_BITS
            scale = F.lit(Decimal(10 ** self.places)).cast("decimal(7,0)")
            out = (F.when((high >= -(1 << 22)) & (high < 1 << 22), (high * unit + low).cast("double") / F.lit(10.0 ** self.places))
                   .otherwise(((high.cast("decimal(20,0)") * F.lit(unit).cast("decimal(10,0)") + low.cast("decimal(10,0)"))
                               / scale).cast("double")))
        elif self.count <= CORE_LIMBS:                      # spelled out, which Spark compiles
            carry = reduce(lambda c, x: moved(x, c), limbs, None)
            sign = F.when(carry < 0, F.lit(-1)).otherwise(F.lit(1)).cast("long")
            carry, total = None, F.lit(0.0)
            for x, w in zip(limbs, self.weights):
                t = x * sign if carry is None else x * sign + carry
                total = total + t.bitwiseAND(mask).cast("double") * F.lit(w)
                carry = F.shiftright(t, DIGIT_BITS)
        else:
            sign = F.when(F.aggregate(F.array(*limbs), zero, lambda c, x: moved(x, c)) < 0, F.lit(-1)).otherwise(F.lit(1)).cast("long")

            def add(acc, term):
                t = term["x"] + acc["c"]
                return F.struct(F.shiftright(t, DIGIT_BITS).alias("c"),
                                (acc["v"] + t.bitwiseAND(mask).cast("double") * term["w"]).alias("v"))

            terms = F.array(*[F.struct((x * sign).alias("x"), F.lit(w).alias("w")) for x, w in zip(limbs, self.weights)])
            end = F.aggregate(terms, F.struct(zero.alias("c"), F.lit(0.0).alias("v")), add)
            carry, total = end["c"], end["v"]
        if self.places is None:
            top = carry.cast("double") * F.lit(float(1 << DIGIT_BITS)) * F.lit(self.weights[-1])
            out = (total + top) * sign.cast("double")
        if not self.odd:
            return out
        nan, up, down = slots[self.count:]
        return (F.when((nan > 0) | ((up > 0) & (down > 0)), F.lit(float("nan")))
                .when(up > 0, F.lit(float("inf"))).when(down > 0, F.lit(float("-inf"))).otherwise(out))


def _double_sums(df: DataFrame, aggs: list[Rolling]) -> dict[int, object]:
    """The double columns that are summed, by the aggregate's place."""
    sums = [(i, as_col(a.value)) for i, a in enumerate(aggs) if a.kind == "sum"]
    if not sums:
        return {}
    schema = df.select(*[c.alias(f"__c{i}") for i, c in sums]).schema
    return {i: c.cast("double") for i, c in sums if isinstance(schema[f"__c{i}"].dataType, _FLOATS)}


def _ranges(df: DataFrame, aggs: list[Rolling]) -> dict[int, Limbs]:
    """Limbs laid over the range of each summed double column: one aggregate over these columns alone."""
    doubles = _double_sums(df, aggs)
    if not doubles:
        return {}
    terms = []
    for i, v in doubles.items():
        finite = F.when(~F.isnan(v) & (F.abs(v) < float("inf")) & (v != 0), F.abs(v))
        terms += [F.min(finite).alias(f"__least{i}"), F.max(finite).alias(f"__most{i}"),
                  F.count_if(F.isnan(v) | (F.abs(v) == float("inf"))).alias(f"__odd{i}"),
                  F.count_if(v.isNull()).alias(f"__null{i}")]
        for p in PLACES:
            whole = F.rint(finite * F.lit(10.0 ** p))
            fits = (whole < 2.0 ** 53) & (whole / F.lit(10.0 ** p) == finite)
            terms.append(F.count_if(~fits).alias(f"__more{p}_{i}"))
    r = df.agg(*terms).first()

    def limbs(i):
        least, most, odd, nulls = r[f"__least{i}"], r[f"__most{i}"], r[f"__odd{i}"] > 0, r[f"__null{i}"] > 0
        places = next((p for p in PLACES if not r[f"__more{p}_{i}"]), None)
        return Limbs.over(least, most, odd, nulls) if places is None else Limbs.of_decimals(most, odd, nulls, places)

    return {i: limbs(i) for i in doubles}


def _prepared_values(df: DataFrame, aggs: list[Rolling], limbs: dict[int, Limbs]):
    """Per aggregate: (parts: [(column, type)], nullable, function of the summed parts)."""
    out = []
    probe_cols = [as_col(a.value).alias(f"__probe{i}") for i, a in enumerate(aggs)
                  if a.value is not None]
    probe_schema = df.select(*probe_cols).schema if probe_cols else None
    j = 0
    for i, a in enumerate(aggs):
        field = None
        if a.value is not None:
            field = probe_schema[j]
            j += 1
        if a.kind == "count":
            v = F.lit(1) if a.value is None else F.when(as_col(a.value).isNotNull(), 1).otherwise(0)
            out.append(([(v.cast("long"), T.LongType())], False, lambda c: F.coalesce(c, F.lit(0).cast("long"))))
            continue
        dt = field.dataType
        if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            out.append(([(as_col(a.value).cast("long"), T.LongType())], field.nullable, lambda c: c))
        elif isinstance(dt, T.DecimalType):
            wide = T.DecimalType(min(38, dt.precision + 10), dt.scale)   # the type of Spark's own sums
            out.append(([(as_col(a.value).cast(wide), wide)], field.nullable, lambda c, wide=wide: c.cast(wide)))
        elif isinstance(dt, _FLOATS):
            digits = limbs[i].digits(as_col(a.value).cast("double"))
            out.append(([(d, T.LongType()) for d in digits], field.nullable and limbs[i].nulls, limbs[i].value))
        else:
            raise TypeError(f"cannot sum column of type {dt.simpleString()}")
    return out


def _slots(aggs, prepared):
    """(slot name, aggregate index, column, type) of every running sum; a nullable sum has a counter too."""
    slots = []
    for i, (a, (parts, nullable, _)) in enumerate(zip(aggs, prepared)):
        slots += [(f"__v{i}_{k}", i, v, dt) for k, (v, dt) in enumerate(parts)]
        if a.kind == "sum" and (nullable or a.exclude_current):   # without the row itself a frame can be empty
            known = as_col(a.value).isNotNull()
            slots.append((f"__n{i}", i, F.when(known, F.lit(1)).otherwise(F.lit(0)).cast("long"), T.LongType()))
    return slots


def _running(slot, agg, window):
    """The slot's sum over the frame; less the row's own part, which integer and decimal slots give back exactly."""
    total = F.sum(slot).over(window)
    return (total - F.coalesce(F.col(slot), F.lit(0)) if agg.exclude_current else total).alias(slot)


def _results(aggs, prepared, slots):
    names = {s[0] for s in slots}
    outs = []
    for i, (a, (parts, _nullable, join)) in enumerate(zip(aggs, prepared)):
        c = join(*[F.col(f"__v{i}_{k}") for k in range(len(parts))])
        if f"__n{i}" in names:
            c = F.when(F.col(f"__n{i}") > 0, c)
        outs.append(c.alias(a.name))
    return outs


def rolling_aggregate(df: DataFrame, keys, ts, aggs: list[Rolling], *, strategy: str = "events",
                      bucket_seconds: int | None = None,
                      target_rows: int = TARGET_BUCKET_ROWS) -> DataFrame:
    """Append one column per :class:`Rolling` to ``df``.

    ``bucket_seconds`` forces one uniform bucket width for all keys; by default
    hot keys (more than ``target_rows`` rows) are split, see :mod:`.skew`.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    aggs = list(aggs)
    if len({a.name for a in aggs}) != len(aggs):
        raise ValueError("duplicate aggregate names")
    clash = {a.name for a in aggs} & set(df.columns)
    if clash:
        raise ValueError(f"output columns already exist: {sorted(clash)}")
    own = [c for c in [*df.columns, *(a.name for a in aggs)] if c.startswith("__")]
    if own:
        raise ValueError(f"column names starting with two underscores are reserved: {own}")
    if strategy not in ("window", "events"):
        raise ValueError(f"unknown strategy {strategy!r}")
    limbs = _ranges(df, aggs)
    if strategy == "window":
        return _by_window(df, keys, ts, aggs, limbs)
    if all(x.count <= CORE_LIMBS for x in limbs.values()):
        return _by_events(df, keys, ts, aggs, limbs, bucket_seconds, target_rows)
    # a few keys with values far apart must not widen the sums of all others
    core = {i: Limbs(CORE_LOW, CORE_LIMBS, x.odd, x.nulls) if x.count > CORE_LIMBS else x for i, x in limbs.items()}
    wide, rest = _parted(df, keys, aggs, core)
    return (_by_events(rest, keys, ts, aggs, core, bucket_seconds, target_rows)
            .unionByName(_by_events(wide, keys, ts, aggs, limbs, bucket_seconds, target_rows)))


def _parted(df, keys, aggs, core):
    """Rows of the keys that hold a value outside the core limbs, and all other rows."""
    outside = F.lit(False)
    for i, v in _double_sums(df, aggs).items():
        size, x = F.abs(v), core[i]
        fits = (size >= math.ldexp(1.0, x.low + 52)) & (size < math.ldexp(1.0, x.low + DIGIT_BITS * x.count))
        outside = outside | F.coalesce(~F.isnan(v) & (size < float("inf")) & (v != 0) & ~fits, F.lit(False))
    named = [F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(keys)]
    odd = checked_broadcast(materialize(df.where(outside).select(*named).distinct(), "rolling-wide-keys"))
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & df[f"`{k}`"].eqNullSafe(odd[f"__k{i}"])
    return df.join(odd, same, "left_semi"), df.join(odd, same, "left_anti")


def _by_window(df, keys, ts, aggs, limbs):
    prepared = _prepared_values(df, aggs, limbs)
    slots = _slots(aggs, prepared)
    out = df.withColumn("__t", epoch_seconds(ts)).withColumns({n: v for n, _, v, _ in slots})
    by_len = {a.seconds: Window.partitionBy(*keys).orderBy("__t").rangeBetween(-a.seconds, 0) for a in aggs}
    summed = out.select(*df.columns, *[_running(n, aggs[i], by_len[aggs[i].seconds]) for n, i, _, _ in slots])
    return summed.select(*df.columns, *_results(aggs, prepared, slots))


def _by_events(df, keys, ts, aggs, limbs, bucket_seconds, target_rows):
    prepared = _prepared_values(df, aggs, limbs)
    lengths = sorted({a.seconds for a in aggs})
    # keys travel as top-level columns (the partitioning); the entry payload holds the rest
    payload_cols = [c for c in df.columns if c not in keys]
    base = df.withColumn("__t", epoch_seconds(ts))
    if bucket_seconds:
        if bucket_seconds <= 0:
            raise ValueError("bucket_seconds must be positive")
        plan = Bucketing("uniform", width=int(bucket_seconds))
    else:
        plan = plan_buckets([base], keys, "__t", target_rows=target_rows)
    base = attach_width(base, plan, keys)
    base = base.withColumn("__salt", _row_hash(df, payload_cols) if plan.mode == "heavy" else F.lit(0).cast("long"))
    slots = _slots(aggs, prepared)

    def slot_value(slot, sign, length):
        name, i, v, dt = slot
        if length is not None and aggs[i].seconds != length:
            return F.lit(None).cast(dt).alias(name)
        return (v if sign > 0 else -v).cast(dt).alias(name)

    payload = F.struct(*([F.col(f"`{c}`") for c in payload_cols] or [F.lit(True).alias("__x")]))
    payload_type = base.select(payload.alias("p")).schema["p"].dataType
    entry = F.struct(F.col("__t").alias("__at"), F.lit(True).alias("__entry"),
                     *[slot_value(s, +1, None) for s in slots], payload.alias("__p"))
    exits = [F.struct((F.col("__t") + F.lit(n + 1)).alias("__at"), F.lit(False).alias("__entry"),
                      *[slot_value(s, -1, n) for s in slots],
                      F.lit(None).cast(payload_type).alias("__p"))
             for n in lengths]
    events = (
        base.select(*keys, "__w", "__u", "__salt", F.explode(F.array(entry, *exits)).alias("__e"))
        .where(F.col("__e.__entry") | F.col("__e.__at").isNotNull())
        .select(*keys, "__w", "__u", "__salt", "__e.*")
        .withColumn("__b", bucket_expr(plan, "__at", F.col("__salt")))
        .drop("__u", "__salt")
    )
    slot_names = [s[0] for s in slots]

    if plan.mode != "none":
        # carry rows, only for keys split into several buckets: the total of all
        # earlier buckets of the key, or for NULL times of all its other buckets
        totals = (events.where(F.col("__w").isNotNull() & F.col("__b").isNotNull())
                  .groupBy(*keys, "__b").agg(*[F.sum(s).alias(s) for s in slot_names])
                  .withColumn("__z", F.col("__b") < F.lit(FIRST_BUCKET)))
        totals = totals.withColumns({name: c for i, x in limbs.items() for name, c in _normal(x, i, prepared)})
        every = Window.partitionBy(*keys, "__z")
        earlier = every.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)

        def carried(s):
            others = F.coalesce(F.sum(s).over(every), F.lit(0)) - F.coalesce(F.col(s), F.lit(0))
            return F.when(F.col("__z"), others).otherwise(F.sum(s).over(earlier)).cast(events.schema[s].dataType).alias(s)

        one = F.lit(1)
        carry = (totals.select(*keys, "__b", F.when(F.col("__z"), F.count(one).over(every) - 1)
                               .otherwise(F.count(one).over(earlier)).alias("__k"), *[carried(s) for s in slot_names])
                 .where(F.col("__k") > 0)
                 .select(*keys, F.lit(None).cast(events.schema["__w"].dataType).alias("__w"),
                         F.lit(None).cast("long").alias("__at"), F.lit(False).alias("__entry"),
                         *slot_names, F.lit(None).cast(payload_type).alias("__p"), "__b"))
        events = events.unionByName(carry)

    running = (Window.partitionBy(*keys, "__b").orderBy(F.col("__at").asc_nulls_first())
               .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    summed = events.select(*keys, "__entry", "__p",
                           *[_running(n, aggs[i], running) for n, i, _, _ in slots])
    return summed.where("__entry").select(
        *[F.col(f"`{c}`") if c in keys else F.col(f"__p.`{c}`").alias(c) for c in df.columns],
        *_results(aggs, prepared, slots))


def _normal(limbs, i, prepared):
    """A bucket's total in small digits, so that totals of any number of buckets add up in 64 bits."""
    names = [f"__v{i}_{k}" for k in range(len(prepared[i][0]))]
    return zip(names, limbs.normal([F.coalesce(F.col(n), F.lit(0).cast("long")) for n in names]))


def _row_hash(df, columns):
    """Deals equal-key rows without a time; rows equal in every column share a bucket."""
    usable = [F.col(f"`{c}`") for c in columns if "map<" not in df.schema[c].dataType.simpleString()]
    return F.xxhash64(*usable) if usable else F.lit(0).cast("long")
