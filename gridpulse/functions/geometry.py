"""Polygon centroids and planar helpers as column expressions on GeoJSON text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from gridpulse.functions.columns import as_column, let

_POINTS = "array<array<double>>"
_POLYGON = f"struct<coordinates:array<{_POINTS}>>"
_MULTI = f"struct<coordinates:array<array<{_POINTS}>>>"

# Fixed value: below this (twice the) area a ring counts as degenerate.
MIN_TWICE_AREA = 1e-12


def outer_rings(geometry) -> Column:
    """Outer ring of each part, for Polygon and MultiPolygon; null for the rest."""
    g = as_column(geometry)
    polygon = F.from_json(g, _POLYGON)["coordinates"]
    multi = F.from_json(g, _MULTI)["coordinates"]
    return let(F.get_json_object(g, "$.type"), lambda kind: (
        F.when(kind == "Polygon", F.array(F.get(polygon, F.lit(0))))
        .when(kind == "MultiPolygon", F.transform(multi, lambda part: F.get(part, F.lit(0))))
    ))


def _mean(values: Column) -> Column:
    total = F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)
    return F.try_divide(total, F.size(values))


def _without_closing_point(points: Column) -> Column:
    first, last = F.get(points, F.lit(0)), F.get(points, F.size(points) - 1)
    closed = (F.get(first, F.lit(0)) == F.get(last, F.lit(0))) & (
        F.get(first, F.lit(1)) == F.get(last, F.lit(1)))
    return F.when(closed, F.slice(points, 1, F.size(points) - 1)).otherwise(points)


def _from_corner(points: Column) -> Column:
    """Corners relative to the first one: keeps cross products from cancelling."""
    return let(F.get(points, F.lit(0)), lambda o: F.transform(points, lambda p: F.struct(
        (F.get(p, F.lit(0)) - F.get(o, F.lit(0))).alias("x"),
        (F.get(p, F.lit(1)) - F.get(o, F.lit(1))).alias("y"),
    )))


def _edge_sums(corners: Column) -> Column:
    """Twice the area and the two first moments, summed over the edges."""
    following = F.concat(F.slice(corners, 2, F.size(corners)), F.slice(corners, 1, 1))
    edges = F.zip_with(corners, following, lambda a, b: F.struct(
        (a.x * b.y - b.x * a.y).alias("cross"),
        (a.x + b.x).alias("sx"),
        (a.y + b.y).alias("sy"),
    ))
    zero = F.struct(F.lit(0.0).alias("area"), F.lit(0.0).alias("cx"), F.lit(0.0).alias("cy"))
    return F.aggregate(edges, zero, lambda acc, e: F.struct(
        (acc.area + e.cross).alias("area"),
        (acc.cx + e.sx * e.cross).alias("cx"),
        (acc.cy + e.sy * e.cross).alias("cy"),
    ))


def _centre(corners: Column) -> Column:
    def pick(s: Column) -> Column:
        flat = F.abs(s.area) < MIN_TWICE_AREA
        return F.struct(
            F.when(flat, _mean(F.transform(corners, lambda p: p.x)))
            .otherwise(F.try_divide(s.cx, s.area * 3.0)).alias("x"),
            F.when(flat, _mean(F.transform(corners, lambda p: p.y)))
            .otherwise(F.try_divide(s.cy, s.area * 3.0)).alias("y"),
        )
    return let(_edge_sums(corners), pick)


def ring_centroid(ring: Column) -> Column:
    """Area-weighted centroid of a ring as struct(lon, lat), null if undefined.

    A closing point equal to the first is dropped; a ring without area falls
    back to the mean of its corners.
    """
    def located(points: Column) -> Column:
        origin = F.get(points, F.lit(0))
        return F.when(F.size(points) >= 3, let(let(_from_corner(points), _centre), lambda c: F.struct(
            (F.get(origin, F.lit(0)) + c.x).alias("lon"),
            (F.get(origin, F.lit(1)) + c.y).alias("lat"),
        )))

    usable = F.filter(ring, lambda p: F.size(p) >= 2)
    open_ring = let(usable, lambda p: F.when(F.size(p) >= 3, _without_closing_point(p)))
    return F.when(F.size(ring) >= 3, let(open_ring, located))


def centroid(geometry) -> Column:
    """struct(longitude, latitude), null where undefined. Parts of a
    MultiPolygon count alike, unweighted."""
    parts = F.filter(
        F.transform(outer_rings(geometry), ring_centroid), lambda c: c.isNotNull()
    )
    return let(parts, lambda found: F.when(F.size(found) > 0, F.struct(
        _mean(F.transform(found, lambda c: c.lon)).alias("longitude"),
        _mean(F.transform(found, lambda c: c.lat)).alias("latitude"),
    )))


def planar_distance(lon1, lat1, lon2, lat2) -> Column:
    """Distance in degrees on the plane."""
    dx = as_column(lon1) - as_column(lon2)
    dy = as_column(lat1) - as_column(lat2)
    return F.sqrt(dx * dx + dy * dy)


def in_box(lon, lat, box: tuple[float, float, float, float]) -> Column:
    lo_x, hi_x, lo_y, hi_y = box
    return as_column(lon).between(lo_x, hi_x) & as_column(lat).between(lo_y, hi_y)
