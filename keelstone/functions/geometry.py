"""Planar geometry: WKT and WKB, point in polygon, simplification that keeps lines simple."""

from __future__ import annotations

import math
import re
import struct

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .udf import vectorised


def ordinate(x: Column) -> Column:
    """Seven decimals without trailing zeros, never -0."""
    text = F.regexp_replace(F.regexp_replace(F.format_string("%.7f", x), r"0+\z", ""), r"\.\z", "")
    return F.when(text == "-0", "0").otherwise(text)


def point_wkt(lon: Column, lat: Column) -> Column:
    return F.concat(F.lit("POINT ("), ordinate(lon), F.lit(" "), ordinate(lat), F.lit(")"))


def line_wkt(points: Column) -> Column:
    """Of an array of structs with lon and lat; a single point is a POINT."""
    pairs = F.transform(points, lambda p: F.concat(ordinate(p["lon"]), F.lit(" "), ordinate(p["lat"])))
    return F.when(F.size(points) == 1, F.concat(F.lit("POINT ("), F.array_join(pairs, ""), F.lit(")"))).otherwise(F.concat(F.lit("LINESTRING ("), F.array_join(pairs, ", "), F.lit(")")))


_NUMBER = r"[-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?"
#: Geometry types and how deep their coordinates are nested.
DEPTH = {"POINT": 0, "LINESTRING": 1, "POLYGON": 2, "MULTIPOLYGON": 3}
CODE = {"POINT": 1, "LINESTRING": 2, "POLYGON": 3, "MULTIPOLYGON": 6}


def parse_wkt(text: str) -> tuple[str, list]:
    """Type and nested coordinates; ValueError for anything else."""
    head = re.fullmatch(r"\s*([A-Za-z]+)\s*(\(.*\))\s*", text, re.S)
    kind = head[1].upper() if head else ""
    if kind not in DEPTH:
        raise ValueError("not a known geometry")
    tokens = re.findall(rf"\(|\)|,|{_NUMBER}|\S", head[2])
    at = 0

    def take(t: str) -> None:
        nonlocal at
        if at >= len(tokens) or tokens[at] != t:
            raise ValueError(f"{t} expected")
        at += 1

    def position():
        nonlocal at
        pair = [float(t) for t in tokens[at : at + 2]]
        if len(pair) != 2 or not all(map(math.isfinite, pair)):
            raise ValueError("two finite numbers expected")
        at += 2
        return tuple(pair)

    def group(depth: int):
        nonlocal at
        take("(")
        out = [position() if depth <= 1 else group(depth - 1)]
        while depth and at < len(tokens) and tokens[at] == ",":
            at += 1
            out.append(position() if depth <= 1 else group(depth - 1))
        take(")")
        return out

    made = group(DEPTH[kind])
    if at != len(tokens):
        raise ValueError("text after the geometry")
    rings = made if kind == "POLYGON" else [r for p in made for r in p] if kind == "MULTIPOLYGON" else []
    if any(len(r) < 4 or r[0] != r[-1] for r in rings) or (kind == "LINESTRING" and len(made) < 2):
        raise ValueError("ring isn't closed or line is too short")
    return kind, made[0] if kind == "POINT" else made


def wkb(kind: str, coordinates) -> bytes:
    """Little-endian well-known binary."""
    head = struct.pack("<BI", 1, CODE[kind])
    pair = lambda p: struct.pack("<dd", *p)
    line = lambda ps: struct.pack("<I", len(ps)) + b"".join(map(pair, ps))
    if kind == "POINT":
        return head + pair(coordinates)
    if kind == "LINESTRING":
        return head + line(coordinates)
    body = map(line, coordinates) if kind == "POLYGON" else (wkb("POLYGON", p) for p in coordinates)
    return head + struct.pack("<I", len(coordinates)) + b"".join(body)


def positions(kind: str, coordinates):
    if kind == "POINT":
        yield coordinates
    elif kind == "LINESTRING":
        yield from coordinates
    else:
        for part in coordinates:
            yield from positions("LINESTRING" if kind == "POLYGON" else "POLYGON", part)


@vectorised("struct<wkb: binary, kind: string, min_x: double, min_y: double, max_x: double, max_y: double, fault: string>")
def wkt_to_wkb(texts: pd.Series) -> pd.DataFrame:
    def one(t):
        try:
            kind, c = parse_wkt(t)
            xs, ys = zip(*positions(kind, c), strict=True)
            return wkb(kind, c), kind, min(xs), min(ys), max(xs), max(ys), None
        except (ValueError, TypeError) as e:
            return (None,) * 6 + (str(e),)

    return pd.DataFrame([one(t) for t in texts], columns=["wkb", "kind", "min_x", "min_y", "max_x", "max_y", "fault"])


TOUCHES = 1e-12


def validate_geofence(geometry: dict) -> list[list[list[tuple[float, float]]]]:
    """Polygons (rings of positions, the outer first) of a GeoJSON Polygon or MultiPolygon; ValueError if it is neither."""
    kind, coordinates = geometry.get("type"), geometry.get("coordinates")
    polygons = [coordinates] if kind == "Polygon" else coordinates if kind == "MultiPolygon" else None
    if not isinstance(polygons, list) or not polygons:
        raise ValueError("a geofence is a Polygon or a MultiPolygon")
    out = []
    for rings in polygons:
        if not isinstance(rings, list) or not rings:
            raise ValueError("a polygon has to have a ring")
        made = []
        for ring in rings:
            ps = [(float(p[0]), float(p[1])) for p in ring]
            if len(ps) < 4 or ps[0] != ps[-1]:
                raise ValueError("a ring is closed and has four positions at least")
            if not all(-180 <= x <= 180 and -90 <= y <= 90 for x, y in ps):
                raise ValueError("position out of range")
            made.append(ps)
        out.append(made)
    return out


def in_ring(ring: Column, x: Column, y: Column) -> Column:
    """Even-odd rule, edges included. ring: array of struct x, y, closed."""
    edges = F.zip_with(F.slice(ring, F.lit(1), F.size(ring) - 1), F.slice(ring, F.lit(2), F.size(ring) - 1), lambda a, b: F.struct(a["x"].alias("ax"), a["y"].alias("ay"), b["x"].alias("bx"), b["y"].alias("by")))

    def on(e):
        cross = (e["bx"] - e["ax"]) * (y - e["ay"]) - (e["by"] - e["ay"]) * (x - e["ax"])
        box = (x >= F.least(e["ax"], e["bx"]) - TOUCHES) & (x <= F.greatest(e["ax"], e["bx"]) + TOUCHES) & (y >= F.least(e["ay"], e["by"]) - TOUCHES) & (y <= F.greatest(e["ay"], e["by"]) + TOUCHES)
        return (F.abs(cross) <= TOUCHES) & box

    def crossed(e):
        spans = (e["ay"] > y) != (e["by"] > y)
        at = e["ax"] + (y - e["ay"]) * (e["bx"] - e["ax"]) / F.when(spans, e["by"] - e["ay"])
        return spans & (x < at)

    odd = F.size(F.filter(edges, lambda e: F.coalesce(crossed(e), F.lit(False)))) % 2 == 1
    return F.exists(edges, on) | odd


def in_polygons(polygons: Column, x: Column, y: Column) -> Column:
    """Inside the outer ring of a polygon and in none of its holes; a hole's edge counts as the hole."""
    return F.exists(polygons, lambda rings: in_ring(rings[0], x, y) & ~F.exists(F.slice(rings, F.lit(2), F.greatest(F.size(rings) - 1, F.lit(0))), lambda hole: in_ring(hole, x, y)))


def _distance(p, a, b) -> float:
    dx, dy = b[0] - a[0], b[1] - a[1]
    length = math.hypot(dx, dy)
    return math.dist(p, a) if length == 0 else abs(dx * (p[1] - a[1]) - dy * (p[0] - a[0])) / length


def simplify(points: list, tolerance: float) -> list:
    """Ramer-Douglas-Peucker by a stack of intervals; the ends stay."""
    keep, todo = {0, len(points) - 1}, [(0, len(points) - 1)]
    while todo:
        a, b = todo.pop()
        far, at = max(((_distance(points[k], points[a], points[b]), -k) for k in range(a + 1, b)), default=(0.0, 0))
        if far > tolerance:
            keep.add(-at)
            todo += [(a, -at), (-at, b)]
    return [points[k] for k in sorted(keep)]


def _side(a, b, c) -> int:
    v = (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])
    return (v > 0) - (v < 0)


def _meet(a, b, c, d) -> bool:
    within = lambda p, q, r: min(p[0], q[0]) <= r[0] <= max(p[0], q[0]) and min(p[1], q[1]) <= r[1] <= max(p[1], q[1])
    s = _side(a, b, c), _side(a, b, d), _side(c, d, a), _side(c, d, b)
    if s[0] != s[1] and s[2] != s[3]:
        return True
    return any(x == 0 and within(*t) for x, t in zip(s, ((a, b, c), (a, b, d), (c, d, a), (c, d, b)), strict=True))


def is_simple(points: list) -> bool:
    """No two edges that aren't neighbours meet. Edges are swept by x, so only those that overlap there are compared."""
    edges = sorted((min(a[0], b[0]), max(a[0], b[0]), k) for k, (a, b) in enumerate(zip(points, points[1:], strict=False)))
    active: list[tuple[float, int]] = []
    for low, high, k in edges:
        active = [(h, j) for h, j in active if h >= low]
        if any(abs(j - k) > 1 and _meet(points[j], points[j + 1], points[k], points[k + 1]) for _, j in active):
            return False
        active.append((high, k))
    return True


def simplify_simple(points: list, tolerance: float, attempts: int = 8) -> list:
    """Simplified with the tolerance halved until the line doesn't cross itself; unchanged if that doesn't help, or if it crossed itself before."""
    if len(points) < 3 or not is_simple(points):
        return points
    for _ in range(attempts):
        made = simplify(points, tolerance)
        if is_simple(made):
            return made
        tolerance /= 2
    return points


def simplified(points: Column, tolerance: float) -> Column:
    """Of an array of struct lon, lat."""

    @F.pandas_udf("array<struct<lon: double, lat: double>>")
    def run(series: pd.Series) -> pd.Series:
        return series.map(lambda ps: [{"lon": x, "lat": y} for x, y in simplify_simple([(p["lon"], p["lat"]) for p in ps], tolerance)])

    return run(points)
