"""Hexagon index as Column expressions over a BIGINT cell id.

Cells are hexagons of a planar lattice over a cylindrical equal-area projection, in 16 resolutions
with seven children per cell. Every function is plain arithmetic on columns, so it stays in
whole-stage codegen and needs no Python worker.

* projection about (LAT0, LNG0): x = R cos(LAT0) dlng, y = R (sin(lat) - sin(LAT0)) / cos(LAT0)
* circumradius of resolution r: 575 m * 7^((8 - r) / 2); odd resolutions use a rotated frame
* id = (r + 1) 2^58 + (q + 2^28) 2^29 + (s + 2^28) with axial lattice coordinates (q, s)
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_R = 6371007.2
LAT0, LNG0 = 12.5, 105.0
COS0 = math.cos(math.radians(LAT0))
SIN0 = math.sin(math.radians(LAT0))
RAD = math.pi / 180.0
KX = RAD * EARTH_R * COS0
KY = EARTH_R / COS0
ALPHA = math.atan2(math.sqrt(3) / 2, 2.5)
SQRT3 = math.sqrt(3)
MAX_RES = 15

RES_UNIT = 1 << 58
Q_UNIT = 1 << 29
BIAS = 1 << 28


def _check(res: int) -> int:
    if not 0 <= res <= MAX_RES:
        raise ValueError(f"resolution {res} is not in 0..{MAX_RES}")
    return res


def circumradius(res: int) -> float:
    """Distance from a cell's centre to its corners, in metres of the plane."""
    return 575.0 * 7.0 ** ((8 - _check(res)) / 2)


def cell_area_km2(res: int) -> float:
    """Area of every cell of a resolution; the projection keeps areas."""
    return 1.5 * SQRT3 * circumradius(res) ** 2 / 1e6


def rotation(res: int) -> tuple[float, float]:
    """(cos, sin) of the lattice frame of a resolution."""
    return (math.cos(ALPHA), math.sin(ALPHA)) if res % 2 else (1.0, 0.0)


def project(lat: Column, lng: Column) -> tuple[Column, Column]:
    """Degrees -> metres of the plane."""
    x = (lng - F.lit(LNG0)) * F.lit(KX)
    y = (F.sin(lat * F.lit(RAD)) - F.lit(SIN0)) * F.lit(KY)
    return x, y


def unproject(x: Column, y: Column) -> tuple[Column, Column]:
    """Metres of the plane -> (lat, lng) in degrees."""
    lat = F.asin(y / F.lit(KY) + F.lit(SIN0)) / F.lit(RAD)
    lng = x / F.lit(KX) + F.lit(LNG0)
    return lat, lng


def to_frame(x: Column, y: Column, res: int) -> tuple[Column, Column]:
    """Plane -> lattice frame of a resolution, in units of its circumradius."""
    s = F.lit(circumradius(res))
    if res % 2 == 0:
        return x / s, y / s
    c, n = (F.lit(v) for v in rotation(res))
    return (x * c + y * n) / s, (y * c - x * n) / s


def axial_round(q: Column, r: Column) -> tuple[Column, Column]:
    """Nearest lattice point of fractional axial coordinates (as DOUBLE columns).

    Branch-free form: three floors select the hexagon among the triangles of the dual lattice.
    """
    a = F.floor(q - r + F.lit(1.0)).cast("double")
    qq = F.floor((a + F.lit(1.0) + q * F.lit(2.0) + r) / F.lit(3.0))
    rr = -F.floor((a + F.lit(1.0) - q - r * F.lit(2.0)) / F.lit(3.0))
    return qq, rr


def make_id(q: Column, r: Column, res: int) -> Column:
    """Cell id from integer axial coordinates."""
    base = (_check(res) + 1) * RES_UNIT + BIAS * Q_UNIT + BIAS
    return q.cast("long") * F.lit(Q_UNIT) + r.cast("long") + F.lit(base)


def cell(lat: Column, lng: Column, res: int) -> Column:
    """Cell id of a point."""
    u, v = to_frame(*project(lat, lng), _check(res))
    q = u * F.lit(SQRT3 / 3.0) - v / F.lit(3.0)
    r = v * F.lit(2.0 / 3.0)
    return make_id(*axial_round(q, r), res)


def cell_res(h: Column) -> Column:
    """Resolution of a cell id."""
    return (F.shiftright(h, 58) - F.lit(1)).cast("int")


def cell_q(h: Column) -> Column:
    return F.shiftright(h, 29).bitwiseAND(F.lit(Q_UNIT - 1)) - F.lit(BIAS)


def cell_r(h: Column) -> Column:
    return h.bitwiseAND(F.lit(Q_UNIT - 1)) - F.lit(BIAS)


def _by_res(h: Column, res: int | None, value) -> Column:
    """Literal of one resolution, or a lookup by the resolution inside the id."""
    if res is not None:
        return F.lit(value(_check(res)))
    return F.element_at(F.array(*[F.lit(value(r)) for r in range(MAX_RES + 1)]), cell_res(h) + 1)


def cell_xy(h: Column, res: int | None = None) -> tuple[Column, Column]:
    """Centre of a cell in metres of the plane."""
    s = _by_res(h, res, circumradius)
    q, r = cell_q(h).cast("double"), cell_r(h).cast("double")
    u = s * F.lit(SQRT3) * (q + r / F.lit(2.0))
    v = s * F.lit(1.5) * r
    if res is not None and res % 2 == 0:
        return u, v
    c = _by_res(h, res, lambda k: rotation(k)[0])
    n = _by_res(h, res, lambda k: rotation(k)[1])
    return u * c - v * n, u * n + v * c


def cell_latlng(h: Column, res: int | None = None) -> tuple[Column, Column]:
    return unproject(*cell_xy(h, res))


def cell_lat(h: Column, res: int | None = None) -> Column:
    """Latitude of the centre."""
    return cell_latlng(h, res)[0]


def cell_lng(h: Column, res: int | None = None) -> Column:
    """Longitude of the centre."""
    return cell_latlng(h, res)[1]


def cell_to_string(h: Column) -> Column:
    """Lower-case hexadecimal text of an id."""
    return F.lower(F.hex(h))


def string_to_cell(s: Column) -> Column:
    """Id from its hexadecimal text."""
    return F.conv(s, 16, 10).cast("long")


def cell_area(h: Column) -> Column:
    """Area in km2, by the resolution inside the id."""
    return _by_res(h, None, cell_area_km2)


def disk_offsets(k: int) -> list[tuple[int, int]]:
    """(id offset, ring) of the 1 + 3k(k+1) cells within k rings, in id order."""
    out = []
    for dq in range(-k, k + 1):
        for dr in range(max(-k, -dq - k), min(k, -dq + k) + 1):
            out.append((dq * Q_UNIT + dr, max(abs(dq), abs(dr), abs(dq + dr))))
    return out


def grid_disk(h: Column, k: int) -> Column:
    """Array of the cells within k rings, the cell itself included."""
    return F.array(*[h + F.lit(d) for d, _ in disk_offsets(k)])


def grid_disk_rings(h: Column, k: int) -> Column:
    """Array of (cell, ring) within k rings."""
    return F.array(
        *[F.struct((h + F.lit(d)).alias("cell"), F.lit(n).alias("ring")) for d, n in disk_offsets(k)]
    )


def _floor_div(n: Column, d: int) -> Column:
    """Exact floor division of integers below 2^52."""
    return F.floor(n.cast("double") / F.lit(float(d)))


def _parent_once(q: Column, r: Column, res: int) -> tuple[Column, Column]:
    """Axial coordinates of the parent of a res-``res`` cell: lattice division by 7, rounded."""
    if res % 2 == 0:
        n1, n2 = q * 3 + r, r * 2 - q
    else:
        n1, n2 = q * 2 - r, q + r * 3
    a = _floor_div(n1 - n2 + F.lit(7), 7)
    qq = _floor_div(a * 7 + F.lit(7) + n1 * 2 + n2, 21)
    rr = -_floor_div(a * 7 + F.lit(7) - n1 - n2 * 2, 21)
    return qq, rr


def cell_to_parent(h: Column, res: int, parent_res: int) -> Column:
    """Ancestor at ``parent_res`` of a cell of resolution ``res``."""
    if not _check(parent_res) <= _check(res):
        raise ValueError("parent resolution must not exceed the cell's resolution")
    if parent_res == res:
        return h
    parent = h
    for k in range(res, parent_res, -1):
        parent = make_id(*_parent_once(cell_q(parent), cell_r(parent), k), k - 1)
    return parent


def child_offsets(res: int) -> list[tuple[int, int]]:
    """Axial offsets from the centre child (res + 1) to the seven children."""
    return [(0, 0), (1, 0), (0, 1), (-1, 1), (-1, 0), (0, -1), (1, -1)]


def cell_to_children(h: Column, res: int) -> Column:
    """Array of the seven children (resolution ``res`` + 1) of a cell of resolution ``res``."""
    _check(res + 1)
    q, r = cell_q(h), cell_r(h)
    if res % 2 == 0:  # children live in an odd, rotated frame
        cq, cr = q * 3 + r, r * 2 - q
    else:
        cq, cr = q * 2 - r, q + r * 3
    return F.array(
        *[make_id(cq + F.lit(dq), cr + F.lit(dr), res + 1) for dq, dr in child_offsets(res)]
    )


def corner_offsets(res: int) -> list[tuple[float, float]]:
    """Six corner offsets from the centre in metres of the plane, counter-clockwise."""
    s, (c, n) = circumradius(res), rotation(res)
    out = []
    for i in range(6):
        a = math.radians(60 * i + 30)
        u, v = s * math.cos(a), s * math.sin(a)
        out.append((u * c - v * n, u * n + v * c))
    return out


def cell_boundary(h: Column, res: int) -> Column:
    """Closed ring of a cell as array<struct<x,y>> in degrees."""
    cx, cy = cell_xy(h, res)
    pts = []
    for dx, dy in corner_offsets(res) + corner_offsets(res)[:1]:
        lat, lng = unproject(cx + F.lit(dx), cy + F.lit(dy))
        pts.append(F.struct(lng.alias("x"), lat.alias("y")))
    return F.array(*pts)
