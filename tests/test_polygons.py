import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from hexmosaic.functions import geo
from hexmosaic.functions import hexgrid as hx
from hexmosaic.operators import checks, clip, polyfill, polygons

SQUARE = "POLYGON((104.85 11.50, 104.95 11.50, 104.95 11.60, 104.85 11.60, 104.85 11.50))"
ISLET = "POLYGON((104.704 11.300, 104.705 11.300, 104.705 11.301, 104.704 11.301, 104.704 11.300))"


def star(rnd, cx, cy, n, r0, r1):
    out = []
    for i in range(n):
        r = rnd.uniform(r0, r1)
        out.append((cx + math.cos(2 * math.pi * i / n) * r, cy + math.sin(2 * math.pi * i / n) * r))
    return out


def brute_inside(x, y, rings):
    odd = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            if (y1 > y) != (y2 > y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
                odd = not odd
    return odd


@pytest.fixture(scope="module")
def shapes():
    rnd = random.Random(3)
    out = []
    for i in range(8):
        cx, cy = 104.9 + rnd.uniform(-0.1, 0.1), 11.5 + rnd.uniform(-0.1, 0.1)
        out.append((i, [star(rnd, cx, cy, 13, 0.015, 0.04), star(rnd, cx, cy, 6, 0.004, 0.012)]))
    return out


@pytest.fixture(scope="module")
def parts(spark, shapes):
    return spark.createDataFrame(shapes, f"part_id int, polygon {geo.POLYGON}").cache()


@pytest.fixture(scope="module")
def two_parts(spark):
    df = spark.createDataFrame([(1, SQUARE), (2, ISLET)], "part_id int, wkt string")
    return df.select("part_id", geo.multipolygon_from_wkt(F.col("wkt"))[0].alias("polygon"))


@pytest.mark.parametrize("res", [7, 8])
def test_center_equals_brute_force(parts, shapes, res):
    e = polygons.ring_edges(parts)
    center = {(r.part_id, r.h3) for r in polyfill.part_cells(e, res, "center").collect()}
    overlap = polyfill.part_cells(e, res, "overlap")
    over = {(r.part_id, r.h3) for r in overlap.collect()}
    near = overlap.select(F.explode(hx.grid_disk(F.col("h3"), 1)).alias("h3")).distinct()
    lat, lng = hx.cell_latlng(F.col("h3"), res)
    near = near.select("h3", lat.alias("lat"), lng.alias("lng")).collect()
    expected = {(p, r.h3) for r in near for p, rings in shapes if brute_inside(r.lng, r.lat, rings)}
    assert center == expected
    assert center < over


def test_square_and_islet(spark, two_parts):
    e = polygons.ring_edges(two_parts)
    center = polyfill.part_cells(e, 8, "center")
    assert {r.part_id for r in center.collect()} == {1}
    grid = polyfill.polyfill_grid(two_parts, 8, "overlap")
    assert center.join(grid, "h3", "left_anti").count() == 0
    islet = spark.range(1).select(hx.cell(F.lit(11.3005), F.lit(104.7045), 8).alias("h3"))
    assert islet.join(grid, "h3", "left_semi").count() == 1
    checks.check_parts(two_parts, grid, 8)
    with pytest.raises(AssertionError, match=r"\[2\]"):
        checks.check_parts(two_parts, polyfill.polyfill_grid(two_parts, 8, "center"), 8)
    area = two_parts.select(F.sum(polygons.area_km2(F.col("polygon"), 48))).first()[0]
    assert area == pytest.approx(120.6, abs=0.2)
    checks.check_grid(polyfill.polyfill_grid(two_parts, 8, "center"), 8, area, "center")


@pytest.mark.parametrize("mode", ["center", "overlap"])
def test_buffer_grows_and_matches_distance(parts, shapes, mode):
    e = polygons.ring_edges(parts)
    plain = {(r.part_id, r.h3) for r in polyfill.part_cells(e, 8, mode).collect()}
    grown = {(r.part_id, r.h3) for r in polyfill.part_cells(e, 8, mode, 500.0).collect()}
    assert plain < grown

    def xy(lng, lat):
        return (lng - hx.LNG0) * hx.KX, (math.sin(lat * hx.RAD) - hx.SIN0) * hx.KY

    def dist(p, a, b):
        (px, py), (ax, ay), (bx, by) = p, a, b
        dx, dy = bx - ax, by - ay
        t = max(0, min(1, ((px - ax) * dx + (py - ay) * dy) / (dx * dx + dy * dy)))
        return math.hypot(px - ax - t * dx, py - ay - t * dy)

    if mode == "center":
        spark = parts.sparkSession
        near = spark.createDataFrame([(h,) for h in {h for _, h in grown}], "h3 long")
        near = near.select(F.explode(hx.grid_disk(F.col("h3"), 1)).alias("h3")).distinct()
        lat, lng = hx.cell_latlng(F.col("h3"), 8)
        rows = near.select("h3", lat.alias("lat"), lng.alias("lng")).collect()
        for part, rings in shapes:
            segs = [(xy(*a), xy(*b)) for ring in rings for a, b in zip(ring, ring[1:] + ring[:1])]
            for r in rows:
                d = min(dist(xy(r.lng, r.lat), a, b) for a, b in segs)
                if abs(d - 500) < 0.5:
                    continue
                want = d < 500 or brute_inside(r.lng, r.lat, rings)
                assert ((part, r.h3) in grown) == want


def test_clip_equals_ray_casting(spark, parts, shapes):
    rng = np.random.default_rng(1)
    pts = [(f"n/{i}", float(a), float(b)) for i, (a, b) in enumerate(zip(rng.uniform(11.35, 11.65, 8000), rng.uniform(104.75, 105.05, 8000)))]
    df = spark.createDataFrame(pts, "source_id string, lat double, lng double")
    want = {i for i, a, b in pts if any(brute_inside(b, a, r) for _, r in shapes)}
    for res in (7, 8):
        got = [r.source_id for r in clip.clip_points(df, parts, res).collect()]
        assert len(got) == len(set(got)) and set(got) == want
    ray = {r.source_id for r in polygons.points_in_parts(df, polygons.ring_edges(parts), "source_id").collect()}
    assert ray == want


def comb(x0, y0, width, height, teeth):
    """A ring with many thin teeth: its edges all meet a few cells."""
    step = width / teeth
    top = [(x0 + i * step / 2, y0 + (height if i % 2 else height / 10)) for i in range(2 * teeth + 1)]
    return [(x0, y0), *top, (x0 + width, y0)]


@pytest.mark.parametrize("res", [7, 8])
def test_crowded_cells_take_the_same_path(spark, res, monkeypatch):
    monkeypatch.setattr(clip, "CHUNK_EDGES", 16)
    ring = comb(104.9, 11.5, 0.006, 0.005, 700)
    p = spark.createDataFrame([(1, [ring])], f"part_id int, polygon {geo.POLYGON}")
    rng = np.random.default_rng(2)
    pts = [(i, float(a), float(b)) for i, (a, b) in enumerate(zip(rng.uniform(11.498, 11.507, 3000), rng.uniform(104.898, 104.908, 3000)))]
    s = spark.createDataFrame(pts, "id int, lat double, lng double")
    assert {r.id for r in clip.clip_points(s, p, res).collect()} == {i for i, a, b in pts if brute_inside(b, a, [ring])}

    cells = clip.clip_cells(p, res).cache()
    assert cells.agg(F.max(F.size("edges"))).first()[0] <= 16
    held = cells.where("edges is not null").groupBy("h3").agg(F.sum(F.size("edges")).alias("edges"), F.count("*").alias("rows"))
    most = held.agg(F.max("edges"), F.max(F.col("rows") - F.col("edges") / 16)).first()
    assert most[0] > 800 and most[1] < 40
    pairs = clip.meeting(s, cells, res, ["id", "lat", "lng"], "part_id").groupBy("id").count()
    # of 1,400 edges a point meets chunks of its own cell, of 16 edges each but where the ring leaves the cell
    assert pairs.agg(F.max("count")).first()[0] <= held.agg(F.max("rows")).first()[0] < most[0] / 16 + 40


@pytest.mark.parametrize("res", [7, 8])
def test_edges_on_lattice_rows_and_through_centres(spark, res):
    """Rows, centres and references on edges: a rectangle and a kite of cell centres."""
    h = spark.range(1).select(hx.cell(F.lit(11.55), F.lit(104.92), res).alias("h"))
    around = h.select(F.explode(hx.grid_disk(F.col("h"), 3)).alias("h")).select(hx.cell_lat(F.col("h"), res).alias("a"), hx.cell_lng(F.col("h"), res).alias("b"))
    centres = sorted((r.a, r.b) for r in around.collect())
    (a0, b0), (a1, b1) = centres[0], centres[-1]
    west, east = min(b for _, b in centres), max(b for _, b in centres)
    rings = {1: [(west, a0), (east, a0), (east, a1), (west, a1)], 2: [(b0, a0), (east, a1), (b1, a1), (west, (a0 + a1) / 2)]}
    p = spark.createDataFrame([(k, [r]) for k, r in rings.items()], f"part_id int, polygon {geo.POLYGON}")
    rng = np.random.default_rng(4)
    pts = [(i, float(a), float(b)) for i, (a, b) in enumerate(zip(rng.uniform(a0 - 0.01, a1 + 0.01, 4000), rng.uniform(west - 0.01, east + 0.01, 4000)))]
    s = spark.createDataFrame(pts, "id int, lat double, lng double")
    got = {(r.id, r.part_id) for r in clip.locate_points(s, p, res, "id").collect()}
    assert got == {(i, k) for i, a, b in pts for k, r in rings.items() if brute_inside(b, a, [r])}


def test_clip_keeps_rows_as_they_are(spark, parts, shapes):
    """Copies of a position, equal ids and clashing names."""
    inside = next((y, x) for x in np.arange(104.7, 105.1, 0.003) for y in np.arange(11.3, 11.7, 0.003) if any(brute_inside(x, y, r) for _, r in shapes))
    rows = [("a", *map(float, inside), 1)] * 4 + [("a", 50.0, 50.0, 1), ("b", None, 104.9, 2), ("c", *map(float, inside), None)]
    s = spark.createDataFrame(rows, "source_id string, lat double, lng double, h3 int").withColumns({"edges": F.lit(1), "_cell": F.lit(2), "part_id": F.lit(3)})
    got = clip.clip_points(s, parts, 8)
    assert got.columns == s.columns and sorted(r.source_id for r in got.collect()) == ["a"] * 4 + ["c"]
    edge = spark.createDataFrame([(k, 11.31 + k / 1e3, 104.7) for k in (1, 1, 2, 2, 2)], "id int, lat double, lng double")
    where = polygons.points_in_parts(edge.distinct(), polygons.ring_edges(parts), "id").collect()
    assert sorted(map(tuple, clip.locate_points(edge, parts, 7, "id").collect())) == sorted(map(tuple, where))


def test_boundary_points_count_once(spark):
    left = "POLYGON((104.80 11.50, 104.90 11.50, 104.90 11.60, 104.80 11.60, 104.80 11.50))"
    right = "POLYGON((104.90 11.50, 105.00 11.50, 105.00 11.60, 104.90 11.60, 104.90 11.50))"
    df = spark.createDataFrame([(1, left), (2, right)], "part_id int, wkt string")
    p = df.select("part_id", geo.multipolygon_from_wkt(F.col("wkt"))[0].alias("polygon"))
    pts = [("shared", 11.55, 104.90), ("corner", 11.50, 104.80), ("edge", 11.50, 104.93), ("out", 11.4999, 104.93)]
    s = spark.createDataFrame(pts, "source_id string, lat double, lng double")
    assert sorted(r.source_id for r in clip.clip_points(s, p, 8).collect()) == ["corner", "edge", "shared"]


def test_cell_centre_on_an_edge(spark):
    """The reference point moves when a cell's centre lies on the polygon."""
    h = hx.cell(F.lit(11.55), F.lit(104.92), 8)
    c = spark.range(1).select(hx.cell_lat(h, 8).alias("a"), hx.cell_lng(h, 8).alias("b")).first()
    a, b = c["a"], c["b"]
    ring = [(b, a - 0.02), (b + 0.05, a - 0.02), (b + 0.05, a + 0.02), (b, a + 0.02)]
    p = spark.createDataFrame([(1, [ring])], f"part_id int, polygon {geo.POLYGON}")
    rng = np.random.default_rng(4)
    pts = [(f"{i}", float(a + u), float(b + v)) for i, (u, v) in enumerate(zip(rng.uniform(-0.004, 0.004, 500), rng.uniform(-0.004, 0.004, 500)))]
    s = spark.createDataFrame(pts, "source_id string, lat double, lng double")
    got = {r.source_id for r in clip.clip_points(s, p, 8).collect()}
    assert got == {i for i, _, y in pts if y >= b}


def test_boundary_parts_order(spark):
    wkt = "MULTIPOLYGON(((0 0, 1 0, 1 1, 0 1, 0 0)), ((5 5, 8 5, 8 8, 5 8, 5 5),(6 6, 7 6, 7 7, 6 7, 6 6)), ((20 1, 21 1, 21 2, 20 2, 20 1)))"
    a = spark.createDataFrame([("x", "country", "land", wkt)], "id string, subtype string, class string, geometry string")
    a = a.withColumn("geometry", geo.multipolygon_from_wkt(F.col("geometry")))
    rows = polygons.boundary_parts(a, 31, ("id",)).orderBy("part_id").collect()
    assert [r.part_id for r in rows] == [1, 2, 3]
    assert [len(r.polygon) for r in rows] == [2, 1, 1]
    assert rows[1].polygon[0][0].x == 0.0
    with pytest.raises(AssertionError, match="area_km2"):
        checks.check_boundary(polygons.boundary_parts(a, 31, ("id",)))


def test_geometry_text_forms(spark):
    g = '{"type":"MultiPolygon","coordinates":[[[[0,0],[1,0],[1,1],[0,0]]],[[[5,5],[6,5],[6,6],[5,5]]]]}'
    row = spark.range(1).select(
        geo.multipolygon_from_geojson(F.lit(g)).alias("m"),
        geo.multipolygon_from_wkt(F.lit(SQUARE)).alias("w"),
    ).first()
    assert len(row["m"]) == 2 and row["m"][1][0][1].x == 6.0
    assert len(row["w"]) == 1 and len(row["w"][0][0]) == 5
    txt = spark.range(1).select(geo.polygon_wkt(geo.multipolygon_from_wkt(F.lit(SQUARE))[0], 2)).first()[0]
    assert txt.startswith("POLYGON((104.85 11.5, 104.95 11.5")


def test_bbox_filter_is_strict_and_pushed(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, (0.0, 1.0, 0.0, 1.0)), (2, (1.0, 2.0, 0.0, 1.0)), (3, (0.5, 3.0, 0.5, 3.0))],
        "id int, bbox struct<xmin:double,xmax:double,ymin:double,ymax:double>",
    )
    df.write.parquet(str(tmp_path / "a"))
    out = polygons.filter_areas(spark.read.parquet(str(tmp_path / "a")), {"xmin": -1, "xmax": 1, "ymin": 0, "ymax": 2})
    assert sorted(r.id for r in out.collect()) == [1, 3]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "bbox.xmin" in plan.split("PushedFilters")[1]


def test_empty_and_broken_wkt(spark):
    from pyspark.sql import functions as F

    from hexmosaic.functions import geo

    texts = ["POLYGON EMPTY", "multipolygon empty", "POINT(1 2)", "POLYGON((a b, 1 2))", None, "POLYGON((0 0, 1 0, 1 1))"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(geo.multipolygon_from_wkt(F.col("t"))).collect()]
    assert got[0] == [] and got[1] == [] and got[2] is None and got[4] is None
    assert got[3][0][0][0]["x"] is None and got[5][0][0][1]["x"] == 1.0


def squares(n, at, apart, side):
    """Squares in a row, with their part ids."""
    x, y = at
    ring = lambda a: [(a, y), (a + side, y), (a + side, y + side), (a, y + side)]
    return [(i, [ring(x + i * apart)]) for i in range(n)]


def test_points_meet_the_edges_around_them_only(spark):
    """Parts side by side in one latitude band, and one below all of them: a point meets few of their edges."""
    shapes = squares(80, (103.0, 11.501), 0.05, 0.008) + [(99, [[(102.0, 11.4), (108.0, 11.4), (108.0, 11.505), (102.0, 11.505)]])]
    parts = spark.createDataFrame(shapes, f"part_id int, polygon {geo.POLYGON}")
    pts = [(i, 11.50303 + 0.0001 * (i % 50), 103.0013 + 0.0125 * i) for i in range(320)] + [(400, 11.501, 103.0), (401, None, 103.0)]
    p = spark.createDataFrame(pts, "id int, lat double, lng double")
    e = polygons.ring_edges(parts)
    got = sorted(map(tuple, polygons.points_in_parts(p, e, "id").collect()))
    want = {(i, k) for i, a, b in pts[:-2] for k, r in shapes if brute_inside(b, a, r)} | {(400, 0), (400, 99)}
    assert got == sorted(want)
    own = p.select("*", (F.col("id") % 80).cast("int").alias("part_id"))
    kept = polygons.points_in_parts(own, e, "id", own_part=True).collect()
    assert sorted(map(tuple, kept)) == sorted(x for x in want if x[1] == x[0] % 80)
    assert polygons.edges_met(p, e, "id", "part_id").count() <= 6 * len(pts)


def test_crowded_parts_get_finer_cells(spark):
    """A position meets few edges however coarse the cells asked for are."""
    ring = comb(104.9, 11.5, 0.3, 0.25, 300)
    plain = [(103.0, 11.0), (104.0, 11.0), (104.0, 12.0), (103.0, 12.0)]
    p = spark.createDataFrame([(1, [ring]), (2, [plain])], f"part_id int, polygon {geo.POLYGON}")
    steps = [(r, c.select("part_id", "h3", F.size("edges").alias("n")).collect()) for r, c in clip.levels(p, 4)]
    assert {x.part_id for x in steps[0][1]} == {2} and {x.part_id for r, c in steps[1:] for x in c} == {1}
    sizes = [x.n for x in steps[-1][1] if x.n and x.n > 0]
    assert sum(sizes) <= 64 * len(sizes)
    rng = np.random.default_rng(3)
    pts = [(i, float(a), float(b)) for i, (a, b) in enumerate(zip(rng.uniform(11.4, 11.8, 600), rng.uniform(103.8, 105.3, 600)))]
    s = spark.createDataFrame(pts + pts[:50], "id int, lat double, lng double")
    want = [(i, k) for i, a, b in pts for k, r in ((1, ring), (2, plain)) if brute_inside(b, a, [r])]
    assert sorted(map(tuple, clip.locate_points(s, p, 4, "id").collect())) == sorted(want)
    ids = {i for i, _ in want}
    assert sorted(r.id for r in clip.clip_points(s, p, 4).collect()) == sorted([i for i in ids] + [i for i in ids if i < 50])


@pytest.mark.parametrize("points, edges, sent", [(16_384, 16_384, 65_536), (16_384, 16_384, 0), (40, 300, 65_536), (40, 150, 0), (16_384, 20, 0)])
def test_pairs_are_decided_where_they_meet(spark, monkeypatch, points, edges, sent):
    """Parts over each other: pairs of a position and a part are not shuffled, however cells are dealt to groups."""
    for name, value in (("POINTS", points), ("EDGES", edges), ("SENT_CELLS", sent), ("TASK_POINTS", 100)):
        monkeypatch.setattr(clip, name, value)
    rnd = random.Random(5)
    shapes = [(k, [star(rnd, 104.9 + rnd.uniform(-0.03, 0.03), 11.5 + rnd.uniform(-0.03, 0.03), 12, 0.02, 0.06)]) for k in range(30)]
    shapes.append((99, [comb(104.88, 11.49, 0.03, 0.02, 40)]))
    p = spark.createDataFrame(shapes, f"part_id int, polygon {geo.POLYGON}")
    rng = np.random.default_rng(6)
    pts = [(i, float(a), float(b)) for i, (a, b) in enumerate(zip(rng.uniform(11.4, 11.6, 500), rng.uniform(104.8, 105.0, 500)))]
    corners = [(1000 + k, ring[0][1], ring[0][0]) for k, (ring,) in shapes]
    odd = [(0, 11.5, 104.9), (None, 11.5, 104.9), (2000, None, 104.9), (2001, 50.0, 50.0)]
    s = spark.createDataFrame(pts + corners + odd + pts[:50] + odd[:1], "id int, lat double, lng double")
    got = clip.locate_points(s, p, 6, "id")
    if edges > 150:
        exchanges = re.findall(r"Exchange (\w+\(\w+)", got._jdf.queryExecution().executedPlan().toString())
        assert exchanges and {x for x in exchanges if x.startswith("hash")} == {"hashpartitioning(_group"}
    every = [x for x in pts + corners + odd if x[1] is not None]
    want = {(i, a, b, k) for i, a, b in every for k, r in shapes if brute_inside(b, a, r) or (i or 0) - 1000 == k}
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(str((i, k)) for i, _, _, k in want)


def test_levels_without_parts_are_left_out(spark):
    ring = comb(104.9, 11.5, 0.3, 0.25, 300)
    p = spark.createDataFrame([(1, [ring]), (2, [])], f"part_id int, polygon {geo.POLYGON}")
    assert 4 not in [r for r, _ in clip.levels(p, 4)]


def test_rows_in_interior_cells_are_not_shuffled(spark, monkeypatch):
    big = [(104.0, 11.0), (105.0, 11.0), (105.0, 12.0), (104.0, 12.0)]
    small = [(104.5, 11.5), (104.52, 11.5), (104.52, 11.52), (104.5, 11.52)]
    p = spark.createDataFrame([(1, [big]), (2, [small])], f"part_id int, polygon {geo.POLYGON}")
    pts = [(i, 11.49 + 0.0004 * (i % 100), 104.49 + 0.0005 * i) for i in range(100)]
    asked = []
    inside = clip._inside
    monkeypatch.setattr(clip, "_inside", lambda points, *a: asked.append(points.count()) or inside(points, *a))
    got = clip.clip_points(spark.createDataFrame(pts, "id int, lat double, lng double"), p, 8)
    assert sorted(r.id for r in got.collect()) == list(range(100)) and asked == [0]


def test_buffered_cells_are_found_by_many_tasks_among_few(spark, monkeypatch):
    """Edges of one file are dealt out, few cells that are too far are tested, and none that is near is missed."""
    ring = comb(104.9, 11.5, 0.1, 0.08, 6)
    p = spark.createDataFrame([(1, [ring]), (None, [[(105.2, 11.5), (105.23, 11.53), (105.2, 11.53)]])], f"part_id int, polygon {geo.POLYGON}")
    e = polygons.ring_edges(p).coalesce(1)
    meets, near, tested = polyfill.piece_meets_hexagon, polyfill._near_cells, []
    monkeypatch.setattr(polyfill, "piece_meets_hexagon", lambda df, *a: tested.append(df) or meets(df, *a))
    got = {(m, b, r): polyfill.part_cells(e, r, m, b).collect() for m in ("center", "overlap") for b, r in ((40.0, 8), (500.0, 8), (900.0, 7))}
    pieces = polyfill.frame_pieces(e, 8, 0.9).count()
    assert tested[1].rdd.getNumPartitions() > 1 and tested[1].count() <= 8 * pieces
    monkeypatch.setattr(polyfill, "_near_cells", lambda df, cols, rings: near(df, cols, rings + 3))
    for (m, b, r), rows in got.items():
        assert sorted(map(str, rows)) == sorted(map(str, polyfill.part_cells(e, r, m, b).collect()))
        assert len(rows) > 0


def test_boundary_parts_are_measured_by_many_tasks(spark, monkeypatch):
    """Areas of one file are dealt out, and the range partitioning does not carry the UTM projection."""
    s = squares(40, (104.0, 11.0), 0.05, 0.01)
    rows = [(f"{i}", "country", "land", [[[(x + 0.0001 * i * (x > r[0][0]), y) for x, y in r]], [r]]) for i, [r] in s] + [(None, "country", "land", None)]
    a = spark.createDataFrame(rows, f"id string, subtype string, class string, geometry {geo.MULTIPOLYGON}").coalesce(1)
    number, seen = polygons.number_rows, []
    monkeypatch.setattr(polygons, "number_rows", lambda df, *x: seen.append(df) or number(df, *x))
    got = polygons.boundary_parts(a, 48, ("id",))
    assert seen[0].rdd.getNumPartitions() > 1 and "area_km2" not in seen[0].columns
    want = polygons.utm_areas(polygons.ring_edges(got), 48)
    rows = got.join(want.withColumnRenamed("area_km2", "km2"), "part_id").collect()
    assert sorted(r.part_id for r in rows) == list(range(1, 81))
    assert all(r.area_km2 == pytest.approx(r.km2, rel=1e-9) for r in rows)
