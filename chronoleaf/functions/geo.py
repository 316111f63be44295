"""Distance between two (latitude, longitude) points in miles.

Everything is plain SQL, so it runs without a Python worker and the same text
can be handed to a ``SQLTransformer``.

* ``geodesic``: the shortest line on the WGS-84 ellipsoid, right for every pair
  of points.  Most rows take a few rounds of the longitude iteration, each a few
  projections (compiled code).  Rows that have not settled by then (nearly
  antipodal points) are solved for the azimuth at one end by bisection, which
  always converges: with the end of the greater latitude first and moved to the
  south, the longitude reached rises with the azimuth.
* ``haversine``: great circle on a sphere of the mean Earth radius.

Equal points give 0, antipodal ones the shortest way over a pole; longitudes
are taken modulo 360 degrees; NULL inputs give NULL.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# WGS-84 semi-major axis (m) and flattening, mean Earth radius (m),
# metres per international mile.
WGS84_A = 6378137.0
WGS84_F = 1.0 / 298.257223563
MEAN_RADIUS_M = 6371008.8
METRES_PER_MILE = 1609.344


def _num(x: float) -> str:
    return f"{x:.17e}"


def _central_angle_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    h = (f"(power(sin(({lat2} - {lat1}) / 2), 2) + "
         f"cos({lat1}) * cos({lat2}) * power(sin(({lon2} - {lon1}) / 2), 2))")
    return f"(2 * atan2(sqrt(least(1.0, {h})), sqrt(greatest(0.0, 1.0 - {h}))))"


def haversine_miles_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    r = [f"radians({c})" for c in (lat1, lon1, lat2, lon2)]
    return f"({_num(MEAN_RADIUS_M)} * {_central_angle_sql(*r)} / {_num(METRES_PER_MILE)})"


ROUNDS, SETTLED = 3, 1e-7       # longitude rounds, and the last step (radians) that counts as settled
HALVINGS = 60


def _let(fields: dict[str, str], name: str, body: str) -> str:
    """``body`` with ``name`` standing for a struct of ``fields``, each computed once."""
    inner = ", ".join(f"'{k}', {v}" for k, v in fields.items())
    return f"element_at(transform(array(named_struct({inner})), {name} -> {body}), 1)"


def _third(c2: str) -> str:
    """The series' parameter; c2: squared cosine of the line's azimuth at the equator."""
    root = f"sqrt(1 + {_num(1 / (1 - WGS84_F) ** 2 - 1)} * {c2})"
    return f"(({root} - 1) / ({root} + 1))"


def _series(k: str, sigma: str, ss: str, cs: str, cm: str) -> str:
    """Metres along the line from the arc on the auxiliary sphere."""
    grow = f"({k} * (1 - 3 * {k} * {k} / 8))"
    bend = (f"({grow} * {ss} * ({cm} + {grow} / 4 * ({cs} * (2 * {cm} * {cm} - 1)"
            f" - {grow} / 6 * {cm} * (4 * {ss} * {ss} - 3) * (4 * {cm} * {cm} - 3))))")
    return f"({_num(WGS84_A * (1 - WGS84_F))} * (1 + {k} * {k} / 4) / (1 - {k}) * ({sigma} - {bend}))"


def _flat(c2: str) -> str:
    return f"({_num(WGS84_F / 16)} * {c2} * (4 + {_num(WGS84_F)} * (4 - 3 * {c2})))"


def _lag(c: str, sa: str, sigma: str, ss: str, cs: str, cm: str) -> str:
    """How far the longitude on the auxiliary sphere runs ahead of the true one."""
    return f"((1 - {c}) * {_num(WGS84_F)} * {sa} * ({sigma} + {c} * {ss} * ({cm} + {c} * {cs} * (2 * {cm} * {cm} - 1))))"


def _reduced(lat: str) -> str:
    return f"atan({_num(1 - WGS84_F)} * tan(radians({lat})))"


def _longitude_gap(lon1: str, lon2: str) -> str:
    turn = f"((CAST({lon2} AS DOUBLE) - CAST({lon1} AS DOUBLE)) / 360)"
    return f"abs(radians(360 * ({turn} - rint({turn}))))"


def _by_azimuth(b1: str, b2: str, gap: str) -> str:
    """Metres, from the azimuth at the first end found by bisection (one Spark SQL expression)."""
    def line(body: str) -> str:
        """``body`` over e.w (longitude), e.sa, e.c2, e.s (arc), e.cm; ``m``: the azimuth at the first end less a right
        angle, which keeps its digits where lines near the equator turn."""
        ends = {"s1": "atan2(p.sin1, d.x)", "s2": "atan2(p.sin2, d.y)", "w1": "atan2(d.sa * p.sin1, d.x)",
                "w2": "atan2(d.sa * p.sin2, d.y)", "sa": "d.sa"}
        arc = {"s": "g.s2 - g.s1", "cm": "cos(g.s1 + g.s2)", "w": "g.w2 - g.w1", "sa": "g.sa", "c2": "1 - g.sa * g.sa"}
        return _let({"x": "-sin(m) * p.cos1", "sa": "cos(m) * p.cos1",
                     "y": "sqrt(greatest(0.0, power(sin(m) * p.cos1, 2) + (p.cos2 - p.cos1) * (p.cos2 + p.cos1)))"}, "d",
                    _let(ends, "g", _let(arc, "e", body)))

    reached = line(f"e.w - {_lag(_flat('e.c2'), 'e.sa', 'e.s', 'sin(e.s)', 'cos(e.s)', 'e.cm')}")
    step = ("element_at(transform(array((r.lo + r.hi) / 2), m -> "
            f"if({reached} < p.gap, named_struct('lo', m, 'hi', r.hi), named_struct('lo', r.lo, 'hi', m))), 1)")
    found = (f"aggregate(sequence(1, {HALVINGS}), named_struct('lo', -{_num(math.pi / 2)}D, 'hi', {_num(math.pi / 2)}D), (r, i) -> {step},"
             " r -> (r.lo + r.hi) / 2)")
    metres = line(_let({"k": _third("e.c2")}, "h", _series("h.k", "e.s", "sin(e.s)", "cos(e.s)", "e.cm")))
    body = f"element_at(transform(array({found}), m -> {metres}), 1)"
    first = f"if(abs({b1}) >= abs({b2}), {b1}, {b2})"
    side = f"if({first} > 0, -1, 1)"
    other = f"if(abs({b1}) >= abs({b2}), {b2}, {b1})"
    along = f"p.sin2 = 0 AND p.sin1 > -1e-200 AND p.gap <= {_num(math.pi * (1 - WGS84_F))}"    # the equator itself
    return _let({"u1": f"least({side} * {first}, -1e-300)", "u2": f"{side} * {other}", "gap": gap}, "q", _let(
        {"sin1": "sin(q.u1)", "cos1": "cos(q.u1)", "sin2": "sin(q.u2)", "cos2": "cos(q.u2)", "gap": "q.gap"}, "p",
        f"if({along}, {_num(WGS84_A)} * p.gap, {body})"))


def geodesic_miles_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    """One Spark SQL expression; the staged form is the fast one."""
    same = f"({_reduced(lat1)} = {_reduced(lat2)} AND {_longitude_gap(lon1, lon2)} = 0)"
    metres = _by_azimuth(_reduced(lat1), _reduced(lat2), _longitude_gap(lon1, lon2))
    return f"(CASE WHEN {same} THEN 0.0D WHEN NOT {same} THEN {metres} / {_num(METRES_PER_MILE)} END)"


# ---- staged form: every intermediate is computed once --------------------------
def distance_stages(lat1: str, lon1: str, lat2: str, lon2: str, out: str,
                    method: str = "geodesic") -> list[dict[str, str]]:
    """Successive projections (name -> SQL) ending in ``out``; intermediates are
    named ``__g_*``.  Same value as the one-expression form."""
    if method == "haversine":
        rl1, rl2 = f"radians({lat1})", f"radians({lat2})"
        dl = f"(radians({lon2}) - radians({lon1}))"
        h = f"(power(sin(({rl2} - {rl1}) / 2), 2) + cos({rl1}) * cos({rl2}) * power(sin({dl} / 2), 2))"
        return [{"__g_h": h},
                {"__g_s": "(2 * atan2(sqrt(least(1.0, __g_h)), sqrt(greatest(0.0, 1.0 - __g_h))))"},
                {out: f"({_num(MEAN_RADIUS_M)} * __g_s / {_num(METRES_PER_MILE)})"}]
    if method != "geodesic":
        raise ValueError(f"unknown distance method {method!r}")
    # NULL travels as NaN, so the compiled code needs no null checks and stays small enough for the JVM's compiler
    ends = {k: f"coalesce(CAST({v} AS DOUBLE), double('NaN'))" for k, v in zip("abcd", (lat1, lon1, lat2, lon2))}
    stages = [
        {"__g_b1": _reduced(ends["a"]), "__g_b2": _reduced(ends["c"]), "__g_l0": _longitude_gap(ends["b"], ends["d"])},
        {"__g_p": "sin(__g_b1) * sin(__g_b2)", "__g_q": "cos(__g_b1) * cos(__g_b2)",
         "__g_x": "cos(__g_b1) * sin(__g_b2)", "__g_y": "sin(__g_b1) * cos(__g_b2)", "__g_z": "cos(__g_b2)"}]
    at = "__g_l0"
    for i in range(ROUNDS):
        ss, cs, sg, sa, c2, cm, to = (f"__g_{n}{i}" for n in ("ss", "cs", "sg", "sa", "cc", "cm", "to"))
        stages += [
            {ss: f"hypot(__g_z * sin({at}), __g_x - __g_y * cos({at}))", cs: f"(__g_p + __g_q * cos({at}))"},
            {sg: f"atan2({ss}, {cs})", sa: f"coalesce(__g_q * sin({at}) / nullif({ss}, 0.0D), 0.0D)"},
            {c2: f"greatest(0.0D, 1.0D - {sa} * {sa})"},
            {cm: f"coalesce({cs} - 2.0D * __g_p / nullif({c2}, 0.0D), 0.0D)"},
            {to: f"(__g_l0 + {_lag(_flat(c2), sa, sg, ss, cs, cm)})"}]
        before, at = at, to
        if i == 1:      # the steps shrink by an even factor: go on to where they end
            stages.append({"__g_r": "coalesce((__g_to1 - __g_to0) / nullif(__g_to0 - __g_l0, 0.0D), 0.0D)"})
            stages.append({"__g_far": "(CASE WHEN abs(__g_r) < 0.5D THEN __g_to1 + (__g_to1 - __g_to0) * __g_r * (1.0D + __g_r"
                                      " * (1.0D + __g_r * (1.0D + __g_r))) ELSE __g_to1 END)"})
            at = "__g_far"
    i = ROUNDS - 1
    known = " OR ".join(f"{x} IS NULL" for x in (lat1, lon1, lat2, lon2))
    settled = f"(abs({at} - {before}) < {SETTLED} AND {at} <= {_num(math.pi)})"
    stages.append({"__g_k": _third(f"__g_cc{i}")})
    # the line found ends short of the point by what the last step still moved; its length follows at the rate a sin(azimuth)
    metres = (_series("__g_k", f"__g_sg{i}", f"__g_ss{i}", f"__g_cs{i}", f"__g_cm{i}")
              + f" + {_num(WGS84_A)} * __g_sa{i} * ({at} - {before})")
    stages.append({out: (f"(CASE WHEN {known} THEN NULL WHEN {settled} THEN {metres}"
                         f" ELSE {_by_azimuth('__g_b1', '__g_b2', '__g_l0')} END / {_num(METRES_PER_MILE)})")})
    return stages


def _temp_names(stages) -> list[str]:
    return [k for st in stages for k in st if k.startswith("__g_")]


def _last_stage(stage: dict[str, str]) -> str:
    """The result as a generator of one row: a later filter on it stops here, instead of being rewritten in terms of all
    stages below, which would repeat each of them many times over."""
    return "inline(array(named_struct(" + ", ".join(f"'{k}', {v}" for k, v in stage.items()) + ")))"


def with_distance(df, lat1: str, lon1: str, lat2: str, lon2: str, out: str = "distance",
                  method: str = "geodesic"):
    """``df`` plus a distance column in miles, computed in stages (fast codegen)."""
    *stages, last = distance_stages(lat1, lon1, lat2, lon2, out, method)
    df = df.drop(out)
    for st in stages:
        df = df.withColumns({k: F.expr(v) for k, v in st.items()})
    return df.select("*", F.expr(_last_stage(last))).drop(*_temp_names(stages))


def distance_select_sql(lat1: str, lon1: str, lat2: str, lon2: str, out: str,
                        method: str = "geodesic", source: str = "__THIS__") -> str:
    """Nested SELECTs adding ``out`` (and ``__g_*`` helpers) to every row of ``source``."""
    sql = source
    *stages, last = distance_stages(lat1, lon1, lat2, lon2, out, method)
    for st in stages:
        cols = ", ".join(f"{v} AS {k}" for k, v in st.items())
        sql = f"(SELECT *, {cols} FROM {sql})"
    return f"SELECT *, {_last_stage(last)} FROM {sql}"


def geodesic_miles(lat1: str, lon1: str, lat2: str, lon2: str) -> Column:
    return F.expr(geodesic_miles_sql(lat1, lon1, lat2, lon2))


def haversine_miles(lat1: str, lon1: str, lat2: str, lon2: str) -> Column:
    return F.expr(haversine_miles_sql(lat1, lon1, lat2, lon2))


def distance_miles(lat1: str, lon1: str, lat2: str, lon2: str, method: str = "geodesic") -> Column:
    if method == "geodesic":
        return geodesic_miles(lat1, lon1, lat2, lon2)
    if method == "haversine":
        return haversine_miles(lat1, lon1, lat2, lon2)
    raise ValueError(f"unknown distance method {method!r}")
