"""Polygon -> cells, in time proportional to the output.

* *center*: every lattice row is a scan line. Each edge is exploded to the rows it crosses, each
  crossing becomes the first cell centre to its east, and consecutive crossings of a row enclose
  a run of cells. Crossings are folded to their parity per cell first, so a row holds at most one
  entry per lattice column however many edges the polygon has.
* *overlap*: adds the cells an edge meets: edges are cut into pieces of about one cell, every
  piece looks at the cells around it, and a slab test keeps those the piece touches.

A hexagon meets a polygon exactly when its centre is inside or an edge meets it. Edges are
straight in degrees; where they are projected they are cut to at most MAX_EDGE_DEG first, which
keeps the difference between the two notions of "straight" below 2 mm.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hexmosaic.functions import hexgrid as hx
from hexmosaic.operators.polygons import ring_edges
from hexmosaic.session import bind, spread

MAX_EDGE_DEG = 0.005
#: Half a piece of an edge in circumradii, at most (pieces of ``max_len`` 0.9).
HALF_PIECE = 0.65
HALF_WIDTH = hx.SQRT3 / 2
# unit normals of the three pairs of hexagon sides in the lattice frame
NORMALS = [(1.0, 0.0), (0.5, HALF_WIDTH), (-0.5, HALF_WIDTH)]


def frame_pieces(edges: DataFrame, res: int, max_len: float | None = None) -> DataFrame:
    """Edges cut to short pieces in the lattice frame of ``res``: adds u1, v1, u2, v2.

    Shared end points of neighbouring pieces come from the same expression, so parity is kept.
    ``max_len`` bounds the piece length in circumradii as well.
    """
    span = F.greatest(F.abs(F.col("x2") - F.col("x1")), F.abs(F.col("y2") - F.col("y1")))
    limit = MAX_EDGE_DEG
    if max_len is not None:
        limit = min(limit, max_len * hx.circumradius(res) / (1.1 * hx.KX))
    n = F.greatest(F.ceil(span / F.lit(limit)).cast("int"), F.lit(1))
    e = edges.withColumn("_n", n).withColumn("_i", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))

    def at(i: Column) -> tuple[Column, Column]:
        t = i / F.col("_n")
        x = F.when(i == F.col("_n"), F.col("x2")).otherwise(F.col("x1") + (F.col("x2") - F.col("x1")) * t)
        y = F.when(i == F.col("_n"), F.col("y2")).otherwise(F.col("y1") + (F.col("y2") - F.col("y1")) * t)
        return x, y

    xa, ya = at(F.col("_i"))
    xb, yb = at(F.col("_i") + 1)
    u1, v1 = hx.to_frame(*hx.project(ya, xa), res)
    u2, v2 = hx.to_frame(*hx.project(yb, xb), res)
    return bind(e, edges.columns, u1=u1, v1=v1, u2=u2, v2=v2)


def row_crossings(edges: DataFrame, res: int, key: str) -> DataFrame:
    """(key, row, u): where edges cross the lattice rows, in the lattice frame.

    Rows of even resolutions are parallels of latitude, so whole edges are crossed exactly in
    degrees; odd resolutions have a rotated frame and take the edges in short pieces.
    """
    e = edges.select(key, "x1", "y1", "x2", "y2")
    row = F.col("row").cast("double")
    s = hx.circumradius(res)
    if res % 2 == 0:
        _, v1 = hx.to_frame(*hx.project(F.col("y1"), F.col("x1")), res)
        _, v2 = hx.to_frame(*hx.project(F.col("y2"), F.col("x2")), res)
        e = e.where(F.col("y1") != F.col("y2"))
        e = bind(e, e.columns, lo=F.floor(F.least(v1, v2) / 1.5), hi=F.ceil(F.greatest(v1, v2) / 1.5))
        e = e.select(key, "x1", "y1", "x2", "y2", F.explode(F.sequence("lo", "hi")).alias("row"))
        lat, _ = hx.unproject(F.lit(0.0), row * F.lit(1.5 * s))
        e = bind(e, e.columns, lat=lat).where((F.col("y1") > F.col("lat")) != (F.col("y2") > F.col("lat")))
        x = F.col("x1") + (F.col("lat") - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))
        return e.select(key, "row", ((x - F.lit(hx.LNG0)) * F.lit(hx.KX / s)).alias("u"))
    p = frame_pieces(e, res).where(F.col("v1") != F.col("v2"))
    lo, hi = F.least("v1", "v2"), F.greatest("v1", "v2")
    rows = F.sequence(F.floor(lo / 1.5), F.ceil(hi / 1.5))
    v = F.col("row") * F.lit(1.5)
    p = p.select(key, "u1", "v1", "u2", "v2", F.explode(rows).alias("row"))
    p = p.where((F.col("v1") > v) != (F.col("v2") > v))
    u = F.col("u1") + (v - F.col("v1")) * (F.col("u2") - F.col("u1")) / (F.col("v2") - F.col("v1"))
    return p.select(key, "row", u.alias("u"))


def along_row(u: Column, row: Column) -> Column:
    """Place on a lattice row in columns: whole numbers are cell centres."""
    return u / F.lit(hx.SQRT3) - row / 2


def _runs(edges: DataFrame, res: int, key: str) -> DataFrame:
    """Runs of cells with their centre inside: (key, row, q_from, q_to)."""
    p = row_crossings(edges, res, key)
    first_east = F.floor(along_row(F.col("u"), F.col("row"))) + 1
    toggles = (
        p.select(key, "row", first_east.alias("q"))
        .groupBy(key, "row", "q")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") % 2 == 1)
    )
    w = Window.partitionBy(key, "row").orderBy("q")
    return (
        toggles.select(key, "row", "q", F.row_number().over(w).alias("k"), F.lead("q").over(w).alias("nxt"))
        .where(F.col("k") % 2 == 1)
        .select(key, "row", F.col("q").alias("q_from"), (F.col("nxt") - 1).alias("q_to"))
    )


def center_cells(edges: DataFrame, res: int, key: str = "part_id") -> DataFrame:
    """(key, h3) of cells with their centre inside the polygon."""
    q = F.explode(F.sequence("q_from", "q_to")).alias("q")
    return _runs(edges, res, key).select(key, "row", q).select(key, hx.make_id(F.col("q"), F.col("row"), res).alias("h3"))


def _near_cells(p: DataFrame, cols: list[str], rings: int) -> DataFrame:
    """Pieces x cells around them (every cell the piece can meet, plus ``rings`` more).

    A piece shorter than a hexagon side can only meet cells within one ring of the cell of its
    middle.
    """
    um, vm = (F.col("u1") + F.col("u2")) / 2, (F.col("v1") + F.col("v2")) / 2
    q, r = hx.axial_round(um * F.lit(hx.SQRT3 / 3) - vm / 3, vm * F.lit(2 / 3))
    around = F.array(
        *[
            F.struct(F.lit(dq).alias("dq"), F.lit(dr).alias("dr"))
            for dq, dr in _disk_axial(1 + rings)
        ]
    )
    ends = ["u1", "v1", "u2", "v2"]
    p = bind(p, [*cols, *ends], _q=q, _r=r)
    p = p.select(*cols, *ends, "_q", "_r", F.inline(around))
    p = p.select(*cols, *ends, (F.col("_q") + F.col("dq")).alias("q"), (F.col("_r") + F.col("dr")).alias("r"))
    cu = F.lit(hx.SQRT3) * (F.col("q") + F.col("r") / 2)
    return bind(p, [*cols, *ends, "q", "r"], cu=cu, cv=F.col("r") * F.lit(1.5))


def _disk_axial(k: int) -> list[tuple[int, int]]:
    return [
        (dq, dr)
        for dq in range(-k, k + 1)
        for dr in range(max(-k, -dq - k), min(k, -dq + k) + 1)
    ]


def piece_meets_hexagon(near: DataFrame, cols: list[str], grow: float = 0.0) -> DataFrame:
    """Adds ``meets``: slab test of piece (u1,v1)-(u2,v2) against the closed hexagon at (cu, cv).

    The piece is clipped by the three strips between opposite sides; ``grow`` widens the strips
    by a fraction of the circumradius. Start and run across each strip are bound first, which
    keeps the generated methods small enough to be compiled.
    """
    half = HALF_WIDTH + grow
    across = {}
    for i, (nx, ny) in enumerate(NORMALS):
        across[f"a{i}"] = (F.col("u1") - F.col("cu")) * F.lit(nx) + (F.col("v1") - F.col("cv")) * F.lit(ny)
        d = (F.col("u2") - F.col("u1")) * F.lit(nx) + (F.col("v2") - F.col("v1")) * F.lit(ny)
        across[f"d{i}"] = F.when(d != 0, d)
    near = bind(near, cols, **across)
    spans = {}
    for i in range(len(NORMALS)):
        a, d = F.col(f"a{i}"), F.col(f"d{i}")
        t1, t2 = (F.lit(-half) - a) / d, (F.lit(half) - a) / d
        spans[f"lo{i}"] = F.coalesce(F.least(t1, t2), F.when(F.abs(a) <= half, 0.0).otherwise(2.0))
        spans[f"hi{i}"] = F.coalesce(F.greatest(t1, t2), F.lit(1.0))
    near = bind(near, cols, **spans)
    last = F.least(F.lit(1.0), F.col("hi0"), F.col("hi1"), F.col("hi2"))
    return near.withColumn("meets", F.greatest(F.lit(0.0), F.col("lo0"), F.col("lo1"), F.col("lo2")) <= last)


def edge_cells(edges: DataFrame, res: int, cols: list[str], grow: float = 0.0) -> DataFrame:
    """(cols, h3) of cells met by a piece of an edge, with repeats; ``cols`` are carried along."""
    p = frame_pieces(edges, res, max_len=0.9)
    near = piece_meets_hexagon(_near_cells(p, cols, 0), [*cols, "q", "r"], grow).where("meets")
    return near.select(*cols, hx.make_id(F.col("q"), F.col("r"), res).alias("h3"))


def _segment_distance2(px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    dx, dy = bx - ax, by - ay
    len2 = dx * dx + dy * dy
    t = F.coalesce(((px - ax) * dx + (py - ay) * dy) / F.when(len2 > 0, len2), F.lit(0.0))
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), t))
    ex, ey = px - ax - t * dx, py - ay - t * dy
    return ex * ex + ey * ey


def buffered_cells(edges: DataFrame, res: int, mode: str, buffer_m: float, key: str = "part_id") -> DataFrame:
    """(key, h3) of cells within ``buffer_m`` of an edge: by centre, or by any point of the cell.

    A distance predicate stands in for a buffered geometry. Distances are taken in the
    equal-area plane, whose scale differs from true metres by under 1 % in the default country.
    """
    reach = buffer_m / hx.circumradius(res)
    # centres lie that far from the middle of a piece, which lies within 1 of its own cell's centre;
    # those beyond ring k are at least 1.5 (k + 1) away
    far = reach if mode == "center" else reach + 1.0
    rings = int((far + HALF_PIECE + 1.0) / 1.5) - 1
    p = frame_pieces(edges.select(key, "x1", "y1", "x2", "y2"), res, max_len=0.9)
    near = _near_cells(p, [key], rings)
    u1, v1, u2, v2, cu, cv = (F.col(c) for c in ("u1", "v1", "u2", "v2", "cu", "cv"))
    near = bind(near, near.columns, gap2=_segment_distance2(cu, cv, u1, v1, u2, v2))
    near = near.where(F.col("gap2") <= F.lit(far * far))
    if mode == "overlap":
        # the circumcircle has ruled most cells out, the incircle decides most others
        sure = F.col("gap2") <= F.lit((reach + HALF_WIDTH) ** 2)
        corners = [(math.cos(math.radians(60 * i + 30)), math.sin(math.radians(60 * i + 30))) for i in range(6)]
        sides = F.array(
            *[
                F.struct(*[F.lit(v).alias(n) for n, v in zip(("ax", "ay", "bx", "by"), (*a, *b), strict=True)])
                for a, b in zip(corners, corners[1:] + corners[:1], strict=True)
            ]
        )

        def close(side: Column) -> Column:
            ax, ay, bx, by = cu + side["ax"], cv + side["ay"], cu + side["bx"], cv + side["by"]
            nearest = F.least(
                _segment_distance2(ax, ay, u1, v1, u2, v2),
                _segment_distance2(u1, v1, ax, ay, bx, by),
                _segment_distance2(u2, v2, ax, ay, bx, by),
            )
            return nearest <= F.lit(reach * reach)

        near = piece_meets_hexagon(near, near.columns).where(sure | F.col("meets") | F.exists(sides, close))
    return near.select(key, hx.make_id(F.col("q"), F.col("r"), res).alias("h3"))


def part_cells(
    edges: DataFrame, res: int, mode: str = "overlap", buffer_m: float = 0.0, key: str = "part_id"
) -> DataFrame:
    """Distinct (key, h3) cells of every polygon; an edge becomes many pieces and cells, so edges are spread first."""
    if mode not in ("center", "overlap"):
        raise ValueError("mode must be 'center' or 'overlap'")
    edges = spread(edges.select(key, "x1", "y1", "x2", "y2"))
    cells = center_cells(edges, res, key)
    if buffer_m > 0:
        cells = cells.unionByName(buffered_cells(edges, res, mode, buffer_m, key))
    elif mode == "overlap":
        cells = cells.unionByName(edge_cells(edges, res, [key]))
    else:
        return cells
    return cells.distinct()


def grid_table(cells: DataFrame, res: int) -> DataFrame:
    """Distinct cells -> the grid schema h3, h3_str, res, lat, lng."""
    h = F.col("h3")
    lat, lng = hx.cell_latlng(h, res)
    return cells.select("h3").distinct().select(
        "h3",
        hx.cell_to_string(h).alias("h3_str"),
        F.lit(res).cast("byte").alias("res"),
        lat.alias("lat"),
        lng.alias("lng"),
    )


def polyfill_grid(parts: DataFrame, res: int, mode: str = "overlap", buffer_m: float = 0.0) -> DataFrame:
    """Grid of all parts at one resolution; a cell met by several parts appears once."""
    return grid_table(part_cells(ring_edges(parts), res, mode, buffer_m), res)
