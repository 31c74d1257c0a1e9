"""What the registered queries share: the derived views once more, as SQL."""

from __future__ import annotations

from ..sources.views import _SHAPES

X = "(-93.35e0 + CAST({k}*7919 % 3001 AS DOUBLE)/1e4)"
Y = "(44.35e0 + CAST(({k}*{k}*104729 + {k}*31) % 1999 AS DOUBLE)/1e4)"

_C, _S, _P, _L = ({"x": X.format(k=k), "y": Y.format(k=k)} for k in ("c_custkey", "s_suppkey", "p_partkey", "l_orderkey"))

PT = f"pt AS (SELECT c_custkey AS id, {_C['x']} AS x, {_C['y']} AS y, c_name AS name, c_mktsegment AS kind, c_nationkey AS nation FROM customer)"
POLY = f"""shape(s, ring, seq, e, n) AS (VALUES {", ".join(map(str, _SHAPES))}),
poly AS (SELECT s_suppkey AS id, s_nationkey % 2 AS tier, s_name AS name, ring, seq, {_S['x']} + 0.00003e0 + e/1e3 AS x, {_S['y']} + 0.00003e0 + n/1e3 AS y
         FROM supplier JOIN shape ON s = s_suppkey % 3),
pseg AS (SELECT * FROM (SELECT id AS fid, tier, name, ring, seq, x AS x0, y AS y0, lead(x) OVER w AS x1, lead(y) OVER w AS y1 FROM poly WINDOW w AS (PARTITION BY id, ring ORDER BY seq)) WHERE x1 IS NOT NULL)"""
LINE = f"""lv AS (SELECT l_orderkey AS line, seq, {_L['x']} + CAST(seq*37 + l_partkey % 41 AS DOUBLE)/1e5 AS x, {_L['y']} + CAST(l_suppkey % 23 AS DOUBLE)/1e5 AS y
       FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) - 1 AS seq FROM lineitem)),
lseg AS (SELECT * FROM (SELECT line, seq, x AS x0, y AS y0, lead(x) OVER w AS x1, lead(y) OVER w AS y1 FROM lv WINDOW w AS (PARTITION BY line ORDER BY seq)) WHERE x1 IS NOT NULL)"""
SNAP = f"""bef AS (SELECT p_partkey AS id, p_name AS name, p_type AS type, p_brand AS brand, p_size AS size, {_P['x']} AS x, {_P['y']} AS y FROM part WHERE p_partkey % 10 <> 0),
aft AS (SELECT CASE WHEN p_partkey % 13 = 0 THEN p_partkey + 1000000 ELSE p_partkey END AS id, CASE WHEN p_partkey % 7 = 0 THEN p_name || ' new' ELSE p_name END AS name, p_type AS type, p_brand AS brand, p_size AS size,
        {_P['x']} + CASE WHEN p_partkey % 17 = 0 THEN 0.0001e0 ELSE 0e0 END AS x, {_P['y']} AS y FROM part WHERE p_partkey % 11 <> 0)"""
CTX = """cb AS (SELECT l_returnflag || l_linestatus AS slug, l_partkey % 200 AS shape FROM lineitem WHERE l_linenumber <= 4),
ca AS (SELECT l_returnflag || l_linestatus AS slug, l_partkey % 200 AS shape FROM lineitem WHERE l_linenumber >= 3)"""


def rounded(x: str) -> str:
    """x to 7 places, ties of its exact binary value to even: the product with 1e7 as a sum of two doubles without loss."""
    high = f"(({x})*134217729e0 - (({x})*134217729e0 - ({x})))"
    a, b = f"({high}*1e7)", f"((({x}) - {high})*1e7)"
    whole, near = f"({a} + {b})", f"round_even({a} + {b}, 0)"
    rest, off = f"({b} - ({whole} - {a}))", f"({whole} - {near})"
    up, down = f"(({off} - 0.5e0) + {rest})", f"(({off} + 0.5e0) + {rest})"
    return f"(CASE WHEN {up} > 0 OR ({up} = 0 AND {near} % 2 <> 0) THEN {near} + 1 WHEN {down} < 0 OR ({down} = 0 AND {near} % 2 <> 0) THEN {near} - 1 ELSE {near} END / 1e7)"


def metres(a: str, b: str) -> str:
    """Flat metres between (a_x, a_y), the centre, and (b_x, b_y); a, b are prefixes such as "a."."""
    return f"sqrt(power(({b}x - {a}x)*cos(radians({a}y))*111320e0, 2) + power(({b}y - {a}y)*110540e0, 2))"


def to_segment(p: str, s: str) -> str:
    """Flat metres from point p to segment s (x0, y0, x1, y1), as a scalar subquery over p and s."""
    ux, uy = f"(({s}x0 - {p}x)*cos(radians({p}y))*111320e0)", f"(({s}y0 - {p}y)*110540e0)"
    dx, dy = f"(({s}x1 - {s}x0)*cos(radians({p}y))*111320e0)", f"(({s}y1 - {s}y0)*110540e0)"
    long = f"({dx}*{dx} + {dy}*{dy})"
    t = f"(CASE WHEN {long} = 0 THEN 0e0 ELSE greatest(0e0, least(1e0, -({ux}*{dx} + {uy}*{dy})/{long})) END)"
    return f"sqrt(power({ux} + {t}*{dx}, 2) + power({uy} + {t}*{dy}, 2))"


def crosses(p: str, s: str) -> str:
    return f"(CASE WHEN ({s}y0 > {p}y) <> ({s}y1 > {p}y) AND {s}x0 + ({p}y - {s}y0)/({s}y1 - {s}y0)*({s}x1 - {s}x0) > {p}x THEN 1 ELSE 0 END)"


#: Every point and area within reach, by brute force: near(id, fid, m), 0 inside.
def near(reach: float, points: str = "pt") -> str:
    return f"""ring_d AS (SELECT p.id, s.fid, s.ring, min({to_segment('p.', 's.')}) AS edge, sum({crosses('p.', 's.')}) % 2 AS odd FROM {points} p, pseg s GROUP BY ALL),
near AS (SELECT id, fid, m FROM (SELECT id, fid, CASE WHEN max(CASE WHEN ring = 0 THEN odd ELSE 0 END) = 1 AND max(CASE WHEN ring > 0 THEN odd ELSE 0 END) = 0 THEN 0e0 ELSE min(edge) END AS m FROM ring_d GROUP BY ALL) WHERE m <= {reach})"""
