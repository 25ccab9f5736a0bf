"""Distances, UTM areas and text forms of points and polygons, as Column expressions.

A ring is array<struct<x,y>> (x = longitude, y = latitude), a polygon an array of rings with the
exterior first, a multipolygon an array of polygons.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

RING = "array<struct<x:double,y:double>>"
POLYGON = f"array<{RING}>"
MULTIPOLYGON = f"array<{POLYGON}>"

EARTH_R = 6371007.2
RAD = math.pi / 180.0

# WGS84 ellipsoid and the UTM scale on the central meridian.
WGS84_A = 6378137.0
WGS84_F = 1 / 298.257223563
UTM_K0 = 0.9996


def haversine_m(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Great-circle distance in metres."""
    r = F.lit(RAD)
    dlat = F.sin((lat2 - lat1) * r / 2)
    dlng = F.sin((lng2 - lng1) * r / 2)
    h = dlat * dlat + F.cos(lat1 * r) * F.cos(lat2 * r) * dlng * dlng
    return F.asin(F.least(F.sqrt(h), F.lit(1.0))) * F.lit(2.0 * EARTH_R)


def _utm_tangent(sin_phi: Column) -> Column:
    """Tangent of the conformal latitude from the sine of the latitude."""
    ecc = math.sqrt(WGS84_F * (2 - WGS84_F))
    return F.sinh(F.atanh(sin_phi) - F.lit(ecc) * F.atanh(F.lit(ecc) * sin_phi))


def _utm_sphere(t: Column, lam: Column) -> tuple[Column, Column]:
    """Transverse Mercator angles (xi, eta) of the conformal sphere."""
    return F.atan2(t, F.cos(lam)), F.atanh(F.sin(lam) / F.sqrt(F.lit(1.0) + t * t))


def _utm_plane(xi: Column, eta: Column) -> tuple[Column, Column]:
    """Easting and northing in metres."""
    n = WGS84_F / (2 - WGS84_F)
    big_a = WGS84_A / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = [
        n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16,
        13 * n**2 / 48 - 3 * n**3 / 5,
        61 * n**3 / 240,
    ]
    east, north = eta, xi
    for j, a in enumerate(alpha, start=1):
        east = east + F.lit(a) * F.cos(xi * (2 * j)) * F.sinh(eta * (2 * j))
        north = north + F.lit(a) * F.sin(xi * (2 * j)) * F.cosh(eta * (2 * j))
    scale = F.lit(UTM_K0 * big_a)
    return F.lit(500000.0) + scale * east, scale * north


def _meridian(zone: int) -> Column:
    return F.lit(6.0 * zone - 183.0)


def utm_forward(lat: Column, lng: Column, zone: int) -> tuple[Column, Column]:
    """UTM easting and northing (northern form) in metres: Krueger series to third order."""
    t = _utm_tangent(F.sin(lat * F.lit(RAD)))
    return _utm_plane(*_utm_sphere(t, (lng - _meridian(zone)) * F.lit(RAD)))


def utm_ring(ring: Column, zone: int) -> Column:
    """A ring in UTM metres, by the steps of ``utm_forward``.

    Lambdas are interpreted and share nothing, so each step's result is kept in an array and
    evaluated once per vertex instead of wherever the next step needs it.
    """
    pair = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    steps = F.transform(ring, lambda p: pair((p["x"] - _meridian(zone)) * F.lit(RAD), F.sin(p["y"] * F.lit(RAD))))
    steps = F.transform(steps, lambda p: pair(p["x"], _utm_tangent(p["y"])))
    steps = F.transform(steps, lambda p: pair(*_utm_sphere(p["y"], p["x"])))
    return F.transform(steps, lambda p: pair(*_utm_plane(p["x"], p["y"])))


def _num(c: Column, digits: int) -> Column:
    return F.round(c, digits).cast("string")


def _ring_text(ring: Column, digits: int) -> Column:
    pts = F.transform(ring, lambda p: F.concat_ws(" ", _num(p["x"], digits), _num(p["y"], digits)))
    return F.concat(F.lit("("), F.array_join(pts, ", "), F.lit(")"))


def polygon_wkt(polygon: Column, digits: int = 9) -> Column:
    """WKT text of a polygon."""
    rings = F.transform(polygon, lambda r: _ring_text(r, digits))
    return F.concat(F.lit("POLYGON("), F.array_join(rings, ", "), F.lit(")"))


def point_wkt(lng: Column, lat: Column, digits: int = 9) -> Column:
    return F.concat(F.lit("POINT("), _num(lng, digits), F.lit(" "), _num(lat, digits), F.lit(")"))


def _close(ring: Column) -> Column:
    same = (ring[0]["x"] == F.element_at(ring, -1)["x"]) & (ring[0]["y"] == F.element_at(ring, -1)["y"])
    return F.when(same, ring).otherwise(F.concat(ring, F.slice(ring, 1, 1)))


def polygon_geojson(polygon: Column) -> Column:
    """GeoJSON geometry struct of a polygon."""
    coords = F.transform(polygon, lambda r: F.transform(_close(r), lambda p: F.array(p["x"], p["y"])))
    return F.struct(F.lit("Polygon").alias("type"), coords.alias("coordinates"))


def point_geojson(lng: Column, lat: Column) -> Column:
    return F.struct(F.lit("Point").alias("type"), F.array(lng, lat).alias("coordinates"))


def feature_json(geometry: Column, properties: Column) -> Column:
    """One GeoJSON feature as JSON text."""
    f = F.struct(
        F.lit("Feature").alias("type"), geometry.alias("geometry"), properties.alias("properties")
    )
    return F.to_json(f, {"ignoreNullFields": "false"})


def _points(ring: Column) -> Column:
    return F.transform(ring, lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))


def multipolygon_from_geojson(text: Column) -> Column:
    """GeoJSON Polygon or MultiPolygon text -> multipolygon."""
    kind = F.get_json_object(text, "$.type")
    body = F.get_json_object(text, "$.coordinates")
    poly = F.from_json(body, "array<array<array<double>>>")
    multi = F.from_json(body, "array<array<array<array<double>>>>")
    to_poly = lambda p: F.transform(p, _points)
    return F.when(kind == "Polygon", F.array(to_poly(poly))).when(
        kind == "MultiPolygon", F.transform(multi, to_poly)
    )


def multipolygon_from_wkt(text: Column) -> Column:
    """WKT POLYGON or MULTIPOLYGON text -> multipolygon; EMPTY has no polygon, other text is NULL."""
    empty = F.upper(text).rlike(r"^\s*(MULTI)?POLYGON\s*Z?\s*EMPTY\s*$")
    known = F.upper(text).rlike(r"^\s*(MULTI)?POLYGON\s*Z?\s*\(")
    body = F.regexp_replace(F.upper(text), r"^\s*(MULTI)?POLYGON\s*Z?\s*\(", "")
    body = F.regexp_replace(body, r"\)\s*$", "")
    multi = F.upper(text).rlike(r"^\s*MULTI")
    body = F.when(multi, F.regexp_replace(body, r"^\s*\(|\)\s*$", "")).otherwise(body)
    polys = F.when(multi, F.split(body, r"\)\s*\)\s*,\s*\(\s*\(")).otherwise(F.array(body))

    def ring(t: Column) -> Column:
        clean = F.trim(F.regexp_replace(t, r"[()]", " "))
        return F.transform(
            F.split(clean, r"\s*,\s*"),
            lambda p: F.struct(
                F.get(F.split(F.trim(p), r"\s+"), 0).try_cast("double").alias("x"),
                F.get(F.split(F.trim(p), r"\s+"), 1).try_cast("double").alias("y"),
            ),
        )

    parsed = F.transform(polys, lambda t: F.transform(F.split(t, r"\)\s*,\s*\("), ring))
    return F.when(empty, F.array().cast(MULTIPOLYGON)).when(known, parsed)
