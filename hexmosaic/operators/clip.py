"""Exact clip of point tables to polygons by the lattice cells of the polygons.

A point in an *interior* cell is inside without any geometry. A point in a *border* cell is inside
exactly when the straight segment from a reference point of the cell to it crosses an odd number of
edges and the reference is outside, or an even number and it is inside. A hexagon is convex, so only
edges that meet the cell can cross the segment. Points exactly on an edge are inside.

The edges of a border cell lie in chunks: consecutive edges of one ring, CHUNK_EDGES at most. A
position meets the chunks of its cell, and what their edges give is folded to one parity before
anything is shuffled. So one plan serves cells of any number of edges, no row grows with them, and
copies of a position, which one chunk of each cell counts, are decided together. A polygon whose border
cells hold many edges on average is cut to smaller cells first, so a position meets few edges however
coarse the cells asked for are; where it meets an interior cell of any polygon, a clip keeps it at once.

Where many polygons lie over each other, pairs of a position and a polygon it might be in are far more than
both tables. ``locate_points`` therefore never shuffles or keeps them: positions and cells are dealt once into
groups that one call decides with numpy, and only pairs that are inside leave it.

Sides of reference points come from the fill itself. It says whether a cell's centre is inside;
from there a path runs along the lattice row to one of a few fixed places and then across the row to
the reference. Crossings on the first leg are those the fill was made of, crossings on the second
are counted on the cell's edges, and of the few references the one farthest from all edges is used.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from hexmosaic.functions import hexgrid as hx
from hexmosaic.operators.polyfill import along_row, center_cells, edge_cells, row_crossings
from hexmosaic.operators.polygons import ring_edges
from hexmosaic.session import bind, cut_lineage, unsent

CHUNK_EDGES = 64
#: Edges of a border cell, on average over a polygon, above which its cells get finer, and the finest of them.
CROWDED, FINEST = 64, 14
ATTACH_GROW = 0.01
#: What is decided at once, about: positions, and edges of parts (CHUNK_EDGES for a part with fewer).
POINTS, EDGES = 16_384, 16_384
#: Positions of a task, about, and cells that a broadcast holds.
TASK_POINTS, SENT_CELLS = 1_000_000, 65_536
#: Edges of a block of tests, about, and tests of a block: as many numbers as stay in a core's cache.
BLOCK_EDGES, BLOCK = 128, 32_768
#: References: lattice columns along the row, then circumradii across it.
SPOTS = [(-0.23, 0.31), (-0.16, -0.27), (-0.09, 0.19), (-0.03, -0.35), (0.04, 0.37), (0.11, -0.22), (0.17, 0.28), (0.22, -0.33)]
ENDS = ["x1", "y1", "x2", "y2"]


def _chunk() -> Column:
    return F.expr(f"edge_ix div {CHUNK_EDGES}")


def _edge_distance2(x: Column, y: Column) -> Column:
    """Squared distance in degrees from (x, y) to the row's edge."""
    x1, y1, x2, y2 = (F.col(c) for c in ENDS)
    dx, dy = x2 - x1, y2 - y1
    t = ((x - x1) * dx + (y - y1) * dy) / (dx * dx + dy * dy)
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), t))
    ex, ey = x - x1 - t * dx, y - y1 - t * dy
    return ex * ex + ey * ey


def _segment_crosses(cx: Column, cy: Column, x: Column, y: Column) -> Column:
    """True when segment (cx,cy)-(x,y) crosses the row's edge, end points counted half-open.

    The edge is taken from west to east, so a start exactly on a horizontal edge counts as north of
    it, as it does where the fill compares latitudes.
    """
    x1, y1, x2, y2 = (F.col(c) for c in ENDS)
    sx, sy = x - cx, y - cy
    side_a = sx * (y1 - cy) - sy * (x1 - cx)
    side_b = sx * (y2 - cy) - sy * (x2 - cx)
    turn = F.when(x2 < x1, -1.0).otherwise(1.0)
    ex, ey = (x2 - x1) * turn, (y2 - y1) * turn
    from_c = ex * (cy - y1) - ey * (cx - x1)
    from_p = ex * (y - y1) - ey * (x - x1)
    return ((side_a >= 0) != (side_b >= 0)) & ((from_c >= 0) != (from_p >= 0))


def _touches(x: Column, y: Column) -> Column:
    x1, y1, x2, y2 = (F.col(c) for c in ENDS)
    side = (x2 - x1) * (y - y1) - (x - x1) * (y2 - y1)
    return (side == 0) & x.between(F.least(x1, x2), F.greatest(x1, x2)) & y.between(F.least(y1, y2), F.greatest(y1, y2))


def _place(res: int, t: Column, s: Column | None = None) -> tuple[Column, Column]:
    """(lat, lng) of the place t columns along the row of the row's cell, and s radii across it."""
    q, r = hx.cell_q(F.col("h3")).cast("double"), hx.cell_r(F.col("h3")).cast("double")
    size = hx.circumradius(res)
    u, v = F.lit(hx.SQRT3 * size) * (q + t + r / 2), r * F.lit(1.5 * size)
    if s is not None:
        v = v + s * F.lit(size)
    c, n = hx.rotation(res)
    return hx.unproject(u, v) if res % 2 == 0 else hx.unproject(u * F.lit(c) - v * F.lit(n), u * F.lit(n) + v * F.lit(c))


def _references(edges: DataFrame, local: DataFrame, res: int, key: str) -> DataFrame:
    """(key, h3, ref) of border cells; ref has clear, spot, flip (1: the other side than the centre) and
    lead, the first chunk of the cell.

    Distances and crossings of all edges of a cell are combined per reference before the shuffle.
    """
    spots = F.inline(F.array(*[F.struct(F.lit(i).alias("spot"), F.lit(t).alias("t"), F.lit(s).alias("s")) for i, (t, s) in enumerate(SPOTS)]))
    q = F.floor(along_row(F.col("u"), F.col("row")) + 0.5)
    first = row_crossings(edges, res, key).select(key, "row", q.alias("q"), along_row(F.col("u"), F.col("row")).alias("at"), spots)
    leg = (F.col("at") < F.col("q") + F.col("t")) != (F.col("at") < F.col("q"))
    no = F.lit(None).cast("struct<ring_id:int,chunk:bigint>").alias("lead")
    first = first.where(leg).select(key, hx.make_id(F.col("q"), F.col("row"), res).alias("h3"), "spot", F.lit(None).cast("double").alias("clear"), F.lit(1).alias("flip"), no)

    (ly, lx), (py, px) = _place(res, F.col("t")), _place(res, F.col("t"), F.col("s"))
    second = local.select(key, "h3", *ENDS, F.struct("ring_id", _chunk().alias("chunk")).alias("lead"), spots)
    second = bind(second, [key, "h3", *ENDS, "lead", "spot"], lx=lx, ly=ly, px=px, py=py)
    corner = F.when(F.col("y1") != F.col("y2"), _edge_distance2(F.col("lx"), F.col("ly")))
    crosses = _segment_crosses(F.col("lx"), F.col("ly"), F.col("px"), F.col("py")).cast("int")
    second = second.select(key, "h3", "spot", F.least(corner, _edge_distance2(F.col("px"), F.col("py"))).alias("clear"), crosses.alias("flip"), "lead")

    each = first.union(second).groupBy(key, "h3", "spot").agg(F.min("clear").alias("clear"), F.bit_xor("flip").alias("flip"), F.min("lead").alias("lead"))
    return each.groupBy(key, "h3").agg(F.max(F.struct("clear", "spot", "flip", "lead")).alias("ref"))


def _local(edges: DataFrame, res: int, key: str) -> DataFrame:
    """Whole original edges with the cells they meet, a little generously: extra edges do not change parity."""
    named = [key, "ring_id", "edge_ix", *ENDS]
    return cut_lineage(edge_cells(edges.select(*named), res, named, grow=ATTACH_GROW).distinct())


def levels(parts: DataFrame, res: int, key: str = "part_id") -> Iterator[tuple[int, DataFrame]]:
    """(resolution, ``clip_cells`` of some parts at it): parts with crowded border cells go on to finer cells.

    A part has more than CROWDED edges for each of its border cells, so finer border cells are not more
    than its edges are.
    """
    while True:
        local = _local(ring_edges(parts, key), res, key)
        cells = local.groupBy(key, "h3").agg(F.count("*").alias("n")).groupBy(key).agg(F.avg("n").alias("n"))
        cells = cut_lineage(cells.select(F.col(key).alias("_crowded"), (F.col("n") > CROWDED).alias("many")))
        crowded = cells.where("many").select("_crowded")
        if res + 2 > FINEST or crowded.isEmpty():
            yield res, clip_cells(parts, res, key, local)
            return
        same = F.col(key) == F.col("_crowded")
        if not cells.where("_crowded is null or not many").isEmpty():
            yield res, clip_cells(parts.join(crowded, same, "left_anti"), res, key, local.join(crowded, same, "left_anti"))
        parts, res = cut_lineage(parts.join(crowded, same, "left_semi")), res + 2


def clip_cells(parts: DataFrame, res: int, key: str = "part_id", local: DataFrame | None = None) -> DataFrame:
    """(key, h3, ref_in, cx, cy, lead, edges): a row per chunk of a border cell, and one per interior cell.

    ``edges`` is null in interior cells; (cx, cy) is the reference point, ``ref_in`` its side. One row
    of each (key, h3) is the ``lead``.
    """
    edges = ring_edges(parts, key)
    local = _local(edges, res, key) if local is None else local
    refs = _references(edges, local, res, key)
    inside = center_cells(edges, res, key).select(key, "h3", F.lit(True).alias("centre_in"), F.lit(None).cast(refs.schema["ref"].dataType).alias("ref"))
    cells = inside.unionByName(refs.select("*", F.lit(False).alias("centre_in")))
    cells = cells.groupBy(key, "h3").agg(F.max("centre_in").alias("centre_in"), F.max("ref").alias("ref"))
    chunks = local.groupBy(key, "h3", "ring_id", _chunk().alias("chunk")).agg(F.collect_list(F.struct(*ENDS)).alias("edges"))
    t, s = (F.get(F.array(*[F.lit(p[i]) for p in SPOTS]), F.col("ref.spot")) for i in (0, 1))
    cy, cx = _place(res, t, s)
    found = bind(cells, [key, "h3", "centre_in", "ref"], cx=cx, cy=cy).join(chunks, [key, "h3"], "left")
    ref_in = F.col("centre_in") != (F.coalesce("ref.flip", F.lit(0)) == 1)
    lead = F.coalesce(F.col("ref.lead") == F.struct("ring_id", "chunk"), F.lit(True))
    return found.select(key, "h3", ref_in.alias("ref_in"), "cx", "cy", lead.alias("lead"), "edges")


def meeting(points: DataFrame, cells: DataFrame, res: int, by: list[str], key: str) -> DataFrame:
    """(by, key, ref_in, cx, cy, lead, edges): points with the rows of their cell in ``cells``."""
    p = points.select(*by)
    p = bind(p, p.columns, _cell=hx.cell(F.col("lat"), F.col("lng"), res))
    return p.join(unsent(cells), F.col("_cell") == F.col("h3")).select(*by, key, "ref_in", "cx", "cy", "lead", "edges")


def _inside(points: DataFrame, cells: DataFrame, res: int, by: list[str], key: str) -> DataFrame:
    """Distinct (by, key) of points inside parts, by the parts' cells; ``by`` holds lat and lng."""
    rows = meeting(points, cells, res, by, key)
    rows = rows.select(*by, key, "ref_in", "cx", "cy", "lead", F.posexplode_outer("edges").alias("pos", "e"))
    rows = rows.select(*by, key, "ref_in", "cx", "cy", (F.col("lead") & (F.coalesce("pos", F.lit(0)) == 0)).cast("int").alias("copy"), "e.*")
    lat, lng = F.col("lat"), F.col("lng")
    crossings = F.sum(F.coalesce(_segment_crosses(F.col("cx"), F.col("cy"), lng, lat), F.lit(False)).cast("int"))
    touch = F.max(F.coalesce(_touches(lng, lat), F.lit(False)))
    sides = rows.groupBy(*by, key).agg(crossings.alias("crossings"), F.sum("copy").alias("copies"), touch.alias("touch"), F.max("ref_in").alias("ref_in"))
    odd = F.expr("crossings div copies") % 2 == 1
    return sides.where((F.col("ref_in") != odd) | F.col("touch")).select(*by, key)


def _unused(columns: list[str], name: str) -> str:
    """``name`` with underscores before it, until no column has it, with or without the one that ``bind`` adds."""
    taken = {c.lower() for c in columns}
    while name in taken or f"_{name}" in taken:
        name = f"_{name}"
    return name


def clip_points(points: DataFrame, parts: DataFrame, res: int, seen: Observation | None = None) -> DataFrame:
    """Rows of ``points`` (with lat, lng) inside any part, boundary included.

    The rows are written once to the shared folder, as positions are decided apart from them and have
    to be the same doubles when they meet again; ``seen`` counts that write's ``rows``. Rows in an
    interior cell of any part stay as they are; only the others are shuffled, to meet the positions
    inside.
    """
    rows = cut_lineage(points.observe(seen, F.count("*").alias("rows")) if seen else points)
    out, steps = [], list(levels(parts, res))
    at, over = (_unused(rows.columns, n) for n in ("_cell", "_whole"))
    for k, (level, cells) in enumerate(steps):
        cells = cut_lineage(cells)
        whole = cells.where("edges is null").select(F.col("h3").alias(over)).distinct()
        border = cells.where("edges is not null").join(whole, F.col("h3") == F.col(over), "left_anti")
        placed = bind(rows, rows.columns, **{at: hx.cell(F.col("lat"), F.col("lng"), level)})
        out.append(placed.join(whole, F.col(at) == F.col(over), "left_semi").select(*points.columns))
        left = placed.join(whole, F.col(at) == F.col(over), "left_anti").select(*points.columns)
        inside = _inside(left, border, level, ["lat", "lng"], "part_id")
        if k + 1 < len(steps):
            inside = cut_lineage(inside)
        out.append(left.join(inside, ["lat", "lng"], "left_semi").select(*points.columns))
        rows = left.join(inside, ["lat", "lng"], "left_anti").select(*points.columns)
    return reduce(DataFrame.unionByName, out)


def _sides(x: np.ndarray, y: np.ndarray, edges: np.ndarray, of: np.ndarray, at: np.ndarray, ref: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(part, position) pairs inside, block by block, as ``_inside`` decides them.

    ``edges`` has a row for x1, y1, x2 and y2 each, ordered by part; ``of`` gives their parts, ``at`` the first edge
    of each part, and ``ref`` the parts' reference points (x, y) and sides.
    """
    x1, y1, x2, y2 = edges[:, :, None]
    cx, cy = (ref[i][of][:, None] for i in (0, 1))
    turn = np.where(x2 < x1, -1.0, 1.0)
    ex, ey = (x2 - x1) * turn, (y2 - y1) * turn
    ax, ay, bx, by = x1 - cx, y1 - cy, x2 - cx, y2 - cy
    from_c = ex * -ay - ey * -ax >= 0
    step = max(BLOCK // len(of), 16)
    numbers, sides = np.empty((4, len(of), min(step, len(x)))), np.empty((2, len(of), min(step, len(x))), bool)
    for first in range(0, len(x), step):
        px, py = x[None, first : first + step], y[None, first : first + step]
        sx, sy, m, n = numbers[:, :, : px.shape[1]]
        a, b = sides[:, :, : px.shape[1]]
        np.subtract(px, cx, out=sx)
        np.subtract(py, cy, out=sy)
        for ux, uy, side in ((ax, ay, a), (bx, by, b)):
            np.subtract(np.multiply(sx, uy, out=m), np.multiply(sy, ux, out=n), out=m)
            np.greater_equal(m, 0, out=side)
        np.not_equal(a, b, out=a)
        np.multiply(np.subtract(py, y1, out=sy), ex, out=m)
        np.multiply(np.subtract(px, x1, out=sx), ey, out=n)
        from_p = np.subtract(m, n, out=m)
        np.not_equal(np.greater_equal(from_p, 0, out=b), from_c, out=b)
        crosses = np.logical_and(a, b, out=a)
        inside = np.logical_xor.reduceat(crosses, at, axis=0) != (ref[2] > 0)[:, None]
        if np.equal(from_p, 0, out=b).any():
            e, p = np.nonzero(b)
            (u1, v1, u2, v2), u, v = edges[:, e], px[0, p], py[0, p]
            on = (u >= np.minimum(u1, u2)) & (u <= np.maximum(u1, u2)) & (v >= np.minimum(v1, v2)) & (v <= np.maximum(v1, v2))
            inside[of[e[on]], p[on]] = True
        part, point = np.nonzero(inside)
        yield part, point + first


def _decide(id_col: str, key: str, schema: pa.Schema) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Function for ``cogroup``: distinct positions and chunks of cells -> (id, key) of positions inside."""

    def firsts(*columns: np.ndarray) -> np.ndarray:
        """Where runs of equal rows begin, and the end."""
        new = reduce(np.logical_or, [c[1:] != c[:-1] for c in columns])
        return np.concatenate([[0], np.flatnonzero(new) + 1, [len(columns[0])]])

    def run(points: pa.Table, cells: pa.Table) -> pa.Table:
        if not (points.num_rows and cells.num_rows):
            return schema.empty_table()
        points = points.group_by([id_col, "lat", "lng", "_cell", "_slot"], use_threads=False).aggregate([])
        cell, slot, x, y = (points[c].to_numpy() for c in ("_cell", "_slot", "lng", "lat"))
        order = np.lexsort((slot, cell))
        cell, slot, x, y = cell[order], slot[order], x[order], y[order]

        coded = cells[key].combine_chunks().dictionary_encode()
        code = coded.indices.fill_null(-1).to_numpy(zero_copy_only=False)
        rows = np.lexsort((code, cells["_slot"].to_numpy(), cells["_cell"].to_numpy()))
        cells, code = cells.take(pa.array(rows)), code[rows]
        at_cell, at_slot = cells["_cell"].to_numpy(), cells["_slot"].to_numpy()
        held = cells["edges"].combine_chunks()
        ends = np.concatenate([[0], np.cumsum(pc.list_value_length(held).fill_null(0).to_numpy(zero_copy_only=False))])
        flat = held.flatten()
        edges = np.array([flat.field(c).to_numpy(zero_copy_only=False) for c in ENDS])
        begin = firsts(at_cell, at_slot, code)
        part, begin = begin[:-1], ends[begin]  # first row of each part in a cell, and its first edge
        ref = np.array([cells[c].to_numpy()[part].astype(float) for c in ("cx", "cy", "ref_in")])
        runs = firsts(at_cell[part], at_slot[part])
        where = {(at_cell[part[a]], at_slot[part[a]]): (a, b) for a, b in zip(runs[:-1], runs[1:], strict=True)}

        found = []
        bounds = firsts(cell, slot)
        for p, q in zip(bounds[:-1], bounds[1:], strict=True):
            a, b = where.get((cell[p], slot[p]), (0, 0))
            bare = np.flatnonzero(begin[a:b] == begin[a + 1 : b + 1]) + a
            bare = bare[ref[2, bare] > 0]
            found.append((np.repeat(bare, q - p), np.tile(np.arange(p, q), len(bare))))
            some = np.flatnonzero(begin[a:b] < begin[a + 1 : b + 1]) + a
            while len(some):
                n = max(1, np.searchsorted(begin[some + 1], begin[some[0]] + BLOCK_EDGES, "right"))
                now, some = some[:n], some[n:]
                e, f = begin[now[0]], begin[now[-1] + 1]
                of = np.repeat(np.arange(n), begin[now + 1] - begin[now])
                for k, i in _sides(x[p:q], y[p:q], edges[:, e:f], of, begin[now] - e, ref[:, now]):
                    found.append((now[k], i + p))
        k, i = (np.concatenate([f[j] for f in found]) for j in (0, 1))
        k = code[part[k]]
        out = [points[id_col].combine_chunks().take(pa.array(order[i])), coded.dictionary.take(pa.array(k, mask=k < 0))]
        return pa.Table.from_batches(pa.table(out, schema=schema).to_batches(max_chunksize=POINTS), schema)

    return run


def _located(points: DataFrame, cells: DataFrame, res: int, id_col: str, key: str) -> DataFrame:
    """(id, key) of distinct positions inside parts, by the parts' stored cells; what has to meet is dealt into groups.

    A cell with many positions, or edges, is dealt to several slots, which share its positions and hold all
    its edges, or the other way round. Edges of one part in one cell that are too many for a group are
    met and folded by Spark.
    """
    by = [id_col, "lat", "lng"]
    p = bind(points.select(*by), by, _cell=hx.cell(F.col("lat"), F.col("lng"), res)).where("_cell is not null")
    held = cells.groupBy(key, "h3").agg(F.coalesce(F.sum(F.size("edges")), F.lit(0)).alias("n"))
    load = F.sum(F.when(F.col("n") <= EDGES, F.greatest("n", F.lit(CHUNK_EDGES))).otherwise(0))
    held_by_cell = held.groupBy("h3").agg(load.alias("load"), F.max("n").alias("most"))
    met = p.groupBy("_cell").agg(F.count("*").alias("points")).join(unsent(held_by_cell), F.col("_cell") == F.col("h3"))
    met = cut_lineage(met.select("h3", "points", "load", "most"))
    sums = [F.coalesce(f(c), F.lit(0)).cast("long").alias(n) for f, c, n in ((F.sum, "points", "points"), (F.sum, "load", "load"), (F.max, "most", "most"), (F.count, "h3", "cells"))]
    total = met.agg(*sums).first()

    more = None
    if total["most"] > EDGES:
        many = cut_lineage(held.where(F.col("n") > EDGES).select(F.col(key).alias("_key"), F.col("h3").alias("_h3")))
        same = (F.col(key) == F.col("_key")) & (F.col("h3") == F.col("_h3"))
        more = _inside(points, cells.join(many, same, "left_semi"), res, by, key).select(id_col, key)
        cells = cells.join(many, same, "left_anti")

    tasks = max(int(points.sparkSession.conf.get("spark.sql.shuffle.partitions")), total["points"] // TASK_POINTS + 1)
    groups = max(4 * tasks, total["points"] // POINTS, total["load"] // EDGES)
    slots = met.select(F.col("h3").alias("_met"), F.ceil(F.col("points") / POINTS).alias("ps"), F.greatest(F.ceil(F.col("load") / EDGES), F.lit(1)).alias("es"))
    # either few cells, and what lies in no others is left out, or a row for every POINTS positions or EDGES edges at most
    few = total["cells"] <= SENT_CELLS
    slots = F.broadcast(slots if few else slots.where("ps > 1 or es > 1"))
    c = cells.select(key, F.col("h3").alias("_cell"), "ref_in", "cx", "cy", "edges")

    def dealt(df: DataFrame, own: Column, other: str) -> DataFrame:
        columns = df.columns
        df = df.join(slots, F.col("_cell") == F.col("_met"), "inner" if few else "left").withColumns({n: F.coalesce(n, F.lit(1)) for n in ("ps", "es")})
        df = df.select("*", F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias("_other"))
        df = df.withColumn("_own", own)
        a, b = ("_own", "_other") if other == "es" else ("_other", "_own")
        df = df.select(*columns, (F.shiftleft(F.col(a).cast("long"), 32) + F.col(b)).alias("_slot"))
        return df.withColumn("_group", F.pmod(F.xxhash64("_cell", "_slot"), F.lit(groups))).repartition(tasks, "_group")

    p = dealt(p, F.pmod(F.xxhash64(*by), F.col("ps")), "es").groupBy("_group")
    c = dealt(c, F.pmod(F.xxhash64(key), F.col("es")), "ps").groupBy("_group")
    fields = [points.schema[id_col], cells.schema[key]]
    schema = StructType([StructField(f.name, f.dataType) for f in fields])
    found = p.cogroup(c).applyInArrow(_decide(id_col, key, to_arrow_schema(schema)), schema)
    return found.unionByName(more) if more else found


def locate_points(points: DataFrame, parts: DataFrame, res: int, id_col: str, key: str = "part_id") -> DataFrame:
    """All (id, part) pairs of points inside parts, boundary included: the join form of the clip."""
    every = [_located(points, cut_lineage(cells), level, id_col, key) for level, cells in levels(parts, res, key)]
    return reduce(DataFrame.unionByName, every)
