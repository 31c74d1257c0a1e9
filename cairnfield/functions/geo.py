"""Column functions on coordinates (degrees) and metres."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Metres per degree of the point-centred metric, and the earth's radius of the haversine.
LON_M, LAT_M, RADIUS_M = 111_320.0, 110_540.0, 6_371_008.8
# The flat metric of the network, at one latitude.
NET_LAT, NET_LAT_M = 44.46, 111_132.0


#: The steps of rounding, each from those before: c times the power of ten is taken as a sum of two doubles without
#: loss, as the power has at most 24 significant bits and its products with the two halves of c are exact.
_ROUNDING = [
    ("split", lambda v, p: v("c") * F.lit(134217729.0)),
    ("high", lambda v, p: v("split") - (v("split") - v("c"))),
    ("a", lambda v, p: v("high") * p),
    ("b", lambda v, p: (v("c") - v("high")) * p),
    ("whole", lambda v, p: v("a") + v("b")),
    ("rest", lambda v, p: v("b") - (v("whole") - v("a"))),
    ("near", lambda v, p: F.rint(v("whole"))),
    ("up", lambda v, p: (v("whole") - v("near") - 0.5) + v("rest")),
    ("down", lambda v, p: (v("whole") - v("near") + 0.5) + v("rest")),
]


def _settled(v, p: Column) -> Column:
    odd = v("near") % 2 != 0
    value = F.when((v("up") > 0) | ((v("up") == 0) & odd), v("near") + 1).when((v("down") < 0) | ((v("down") == 0) & odd), v("near") - 1).otherwise(v("near")) / p
    # beyond that a double has no further places
    return F.when(F.abs(v("c")) < 1e8, value).otherwise(v("c"))


def with_rounded(df: DataFrame, columns: dict[str, Column], places: int = 7) -> DataFrame:
    """df with columns rounded to `places` decimals (7 at most): the double nearest to the decimal, ties of the exact binary value to even.

    A step is a projection of its own, so that what is used twice is worked out once.
    """
    power, own = F.lit(float(10**places)), df.columns
    df = df.withColumns({f"_{n}_c": c for n, c in columns.items()})
    for name, step in _ROUNDING:
        df = df.withColumns({f"_{n}_{name}": step(lambda k, n=n: F.col(f"_{n}_{k}"), power) for n in columns})
    df = df.withColumns({n: _settled(lambda k, n=n: F.col(f"_{n}_{k}"), power) for n in columns})
    return df.select(*own, *[n for n in columns if n not in own])


#: The steps of rounding that an array takes at a time, and what is still wanted after them: elements of arrays are interpreted, so each struct that is spared counts.
_AT_ONCE = [(("split",), ("c",)), (("high",), ("c",)), (("a", "b"), ("c",)), (("whole",), ("c", "a", "b")), (("rest", "near"), ("c", "whole")), (("up", "down"), ("c", "near"))]


def _with_steps(names: tuple[str, ...], held: tuple[str, ...], power: Column):
    steps = dict(_ROUNDING)
    return lambda r: F.struct(*[r[h].alias(h) for h in held], *[steps[n](lambda k: r[k], power).alias(n) for n in names])


def rounded_each(values: Column, places: int = 7) -> Column:
    """An array of doubles, each rounded as by with_rounded()."""
    power = F.lit(float(10**places))
    rows = F.transform(values, lambda c: F.struct(c.alias("c")))
    for names, held in _AT_ONCE:
        rows = F.transform(rows, _with_steps(names, held, power))
    return F.transform(rows, lambda r: _settled(lambda k: r[k], power))


def scale_x(lat: Column) -> Column:
    return F.cos(F.radians(lat)) * F.lit(LON_M)


def metres(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Flat distance with the first point as centre."""
    return F.hypot((x1 - x0) * scale_x(y0), (y1 - y0) * F.lit(LAT_M))


def net_metres(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Flat distance with one scale everywhere."""
    return F.hypot((x1 - x0) * F.cos(F.radians(F.lit(NET_LAT))) * F.lit(LON_M), (y1 - y0) * F.lit(NET_LAT_M))


def to_segment(px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column, sx: Column | None = None) -> Column:
    """Metres from a point, which is the centre, to a segment. sx: scale_x(py), where that is at hand: a filter would work it out for every place where it stands."""
    sx = scale_x(py) if sx is None else sx
    ux, uy, vx, vy = (ax - px) * sx, (ay - py) * F.lit(LAT_M), (bx - px) * sx, (by - py) * F.lit(LAT_M)
    dx, dy = vx - ux, vy - uy
    long = dx * dx + dy * dy
    t = F.when(long == 0, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), -(ux * dx + uy * dy) / F.when(long == 0, 1.0).otherwise(long))))
    return F.hypot(ux + t * dx, uy + t * dy)


def to_segments(px: Column, py: Column, segments: Column, sx: Column) -> Column:
    """to_segment() for an array of segments (x0, y0, x1, y1): what is used twice is worked out once, as nothing else spares it inside an array."""
    sy = F.lit(LAT_M)

    def ends(s: Column) -> Column:
        return F.struct(((s["x0"] - px) * sx).alias("ux"), ((s["y0"] - py) * sy).alias("uy"), ((s["x1"] - px) * sx).alias("vx"), ((s["y1"] - py) * sy).alias("vy"))

    def ways(r: Column) -> Column:
        return F.struct(r["ux"].alias("ux"), r["uy"].alias("uy"), (r["vx"] - r["ux"]).alias("dx"), (r["vy"] - r["uy"]).alias("dy"))

    def metres_of(r: Column) -> Column:
        long = r["dx"] * r["dx"] + r["dy"] * r["dy"]
        # try_divide is null for a segment without length
        t = F.coalesce(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.try_divide(-(r["ux"] * r["dx"] + r["uy"] * r["dy"]), long))), F.lit(0.0))
        return F.hypot(r["ux"] + t * r["dx"], r["uy"] + t * r["dy"])

    return F.transform(F.transform(F.transform(segments, ends), ways), metres_of)


def nearest_on(px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column, sx: Column | None = None) -> Column:
    """(m, x, y): metres from a point, which is the centre, to a segment, and the nearest place on it. sx as for to_segment()."""
    sx, sy = scale_x(py) if sx is None else sx, F.lit(LAT_M)
    dx, dy = (bx - ax) * sx, (by - ay) * sy
    long = dx * dx + dy * dy
    t = F.when(long == 0, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((px - ax) * sx * dx + (py - ay) * sy * dy) / F.when(long == 0, 1.0).otherwise(long))))
    x, y = ax + t * (bx - ax), ay + t * (by - ay)
    return F.struct(F.hypot((x - px) * sx, (y - py) * sy).alias("m"), x.alias("x"), y.alias("y"))


def crosses(px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """1 if the ray from the point towards larger x crosses the segment."""
    at = ax + (py - ay) / F.when(by == ay, 1.0).otherwise(by - ay) * (bx - ax)
    return F.when(((ay > py) != (by > py)) & (at > px), 1).otherwise(0)


def haversine(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    a, b = F.radians(y0), F.radians(y1)
    h = F.pow(F.sin((b - a) / 2), 2) + F.cos(a) * F.cos(b) * F.pow(F.sin(F.radians(x1 - x0) / 2), 2)
    return 2 * F.lit(RADIUS_M) * F.asin(F.sqrt(h))


def tile_x(lon: Column, zoom: Column) -> Column:
    return F.floor((lon + 180.0) / 360.0 * F.pow(F.lit(2.0), zoom)).cast("int")


def tile_y(lat: Column, zoom: Column) -> Column:
    r = F.radians(lat)
    return F.floor((1.0 - F.ln(F.tan(r) + 1.0 / F.cos(r)) / F.lit(3.141592653589793)) / 2.0 * F.pow(F.lit(2.0), zoom)).cast("int")
