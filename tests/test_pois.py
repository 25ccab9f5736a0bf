import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from hexmosaic.config import Params
from hexmosaic.functions import geo
from hexmosaic.functions import hexgrid as hx
from hexmosaic.operators import checks, pois, population
from hexmosaic.operators.polyfill import grid_table, polyfill_grid
from hexmosaic.sources.readers import ELEMENTS


@pytest.fixture(scope="module")
def elements(spark):
    rows = [
        ("node", 1, {"amenity": "pharmacy", "healthcare": "pharmacy", "name": "A", "name:en": "B"}, None, 11.5, 104.9),
        ("node", 2, {"amenity": "bench", "shop": "x"}, None, 11.5, 104.9),
        ("node", 3, None, None, 11.0, 104.0),
        ("node", 4, {}, None, 11.2, 104.4),
        ("way", 1, {"shop": "mall"}, [3, 4, 3], None, None),
        ("way", 2, {"shop": "mall"}, [3, 99], None, None),
        ("way", 3, {"shop": "mall"}, [98, 99], None, None),
        ("way", 4, {"building": "yes"}, [3], None, None),
        ("relation", 5, {"amenity": "school"}, [1], None, None),
    ]
    return spark.createDataFrame(rows, ELEMENTS)


def test_staging_of_elements(elements):
    rows = {r["source_id"]: r for r in pois.stage_elements(elements).collect()}
    assert set(rows) == {"node/1", "way/1", "way/2"}
    n = rows["node/1"]
    assert (n["category"], n["category_hierarchy"]) == ("amenity=pharmacy", ["amenity", "amenity=pharmacy"])
    assert (n["name"], n["name_en"], n["confidence"], n["source"]) == ("A", "B", None, "osm")
    assert json.loads(n["attrs"])["healthcare"] == "pharmacy"
    assert rows["way/1"]["lat"] == pytest.approx((11.0 * 2 + 11.2) / 3)
    assert (rows["way/2"]["lat"], rows["way/2"]["lng"]) == (11.0, 104.0)


def test_staging_of_places(spark):
    schema = (
        "id string, names struct<primary:string,common:map<string,string>>, confidence double, operating_status string, "
        "basic_category string, taxonomy struct<primary:string,hierarchy:array<string>>, "
        "brand struct<names:struct<primary:string>>, sources array<struct<dataset:string>>, lat double, lng double"
    )

    def row(i, conf, status, tax):
        return (i, ("N", {"en": "E"}), conf, status, None, (tax, ["a", tax]), None, [("m",), (None,), ("m",), ("b",)], 11.0, 104.0)

    df = spark.createDataFrame(
        [
            row("keep", 0.6, None, "x"),
            row("open", 0.9, "open", "x"),
            row("low", 0.59, None, "x"),
            row("noconf", None, None, "x"),
            row("closed", 0.9, "closed", "x"),
            row("notax", 0.9, "open", None),
        ],
        schema,
    )
    rows = {r["source_id"]: r for r in pois.stage_places(df).collect()}
    assert set(rows) == {"keep", "open"}
    assert json.loads(rows["keep"]["attrs"]) == {"basic_category": None, "brand": None, "datasets": ["b", "m"]}
    assert rows["keep"]["name_en"] == "E"
    assert {r["source"] for r in pois.stage_places(df, 0.6, "fsq").collect()} == {"fsq"}


def test_clip_index_and_checks(spark):
    ring = [(104.85, 11.50), (104.95, 11.50), (104.95, 11.60), (104.85, 11.60)]
    parts = spark.createDataFrame([(1, [ring])], f"part_id int, polygon {geo.POLYGON}")
    pts = [("a", 11.55, 104.9), ("edge", 11.5, 104.9), ("near", 11.4999, 104.9), ("far", 12.0, 104.0)]
    staged = spark.createDataFrame(pts, "source_id string, lat double, lng double")
    for c in ("source", "name", "name_en", "category", "attrs"):
        staged = staged.withColumn(c, F.lit("x"))
    staged = staged.withColumn("category_hierarchy", F.array(F.lit("x"))).withColumn("confidence", F.lit(1.0))
    grid = polyfill_grid(parts, 8)
    out = pois.clip_and_index(staged, grid, parts, Params())
    assert sorted(r.source_id for r in out.collect()) == ["a", "edge"]
    assert out.columns[-3:] == ["h3_res8", "h3_res11", "attrs"]
    assert checks.check_pois(out, grid, 8)["pois"] == 2
    with pytest.raises(AssertionError, match="repeated"):
        checks.check_pois(out.unionByName(out), grid, 8)
    with pytest.raises(AssertionError, match="outside"):
        checks.check_pois(out, grid.limit(1), 8)
    with pytest.raises(AssertionError, match="pois = 0"):
        checks.check_pois(out.limit(0), grid, 8)


def _blocks(spark, arr, step=7):
    rows = []
    for r in range(0, arr.shape[0], step):
        for c in range(0, arr.shape[1], step):
            rows.append((r, c, [[float(v) for v in line] for line in arr[r : r + step, c : c + step]]))
    return spark.createDataFrame(rows, "row0 int, col0 int, values array<array<float>>")


AFFINE = population.Affine(1 / 1200, 0, 104.90, 0, -1 / 1200, 11.60)


def test_pixels_keep_total_and_skip_nodata(spark):
    arr = np.random.default_rng(0).uniform(0, 50, (40, 40)).astype("float32")
    arr[:5, :5] = -99999.0
    b = _blocks(spark, arr)
    px = population.raster_to_pixels(b, AFFINE, -99999.0)
    n, total, top = px.agg(F.count("*"), F.sum("pop"), F.max("lat")).first()
    want = arr[arr >= 0].astype("float64").sum()
    assert n == (arr > 0).sum() and total == pytest.approx(want)
    assert top == pytest.approx(11.60 - 0.5 / 1200)
    assert population.raster_total(b, -99999.0).first()[0] == pytest.approx(want)


def test_cells_keep_total_at_each_res(spark):
    arr = np.random.default_rng(1).uniform(0, 50, (60, 60)).astype("float32")
    px = population.raster_to_pixels(_blocks(spark, arr), AFFINE).cache()
    total = float(arr.astype("float64").sum())
    for res in (7, 8):
        grid = grid_table(px.select(hx.cell(F.col("lat"), F.col("lng"), res).alias("h3")), res)
        pop = population.population_by_cell(px, grid, res)
        assert checks.check_population(pop, total)["total"] == pytest.approx(total)
        with pytest.raises(AssertionError, match="difference"):
            checks.check_population(pop, total * 1.02)


def test_block_sum_and_window(spark):
    arr = np.arange(23 * 17, dtype="float32").reshape(23, 17)
    blocks = _blocks(spark, arr)
    cells = population.raster_cells(blocks)
    got = {(r.block_row, r.block_col): r.value for r in population.raster_block_sum(cells, 5, 23, 17).collect()}
    want = arr[:20, :15].reshape(4, 5, 3, 5).sum(axis=(1, 3))
    assert got == {(i, j): want[i, j] for i in range(4) for j in range(3)}
    box = {"xmin": 104.90 + 2.5 / 1200, "xmax": 104.90 + 6.5 / 1200, "ymax": 11.60 - 3.5 / 1200, "ymin": 11.60 - 9.5 / 1200}
    sub = population.raster_window(blocks, AFFINE, box, arr.shape)
    assert sub.agg(F.sum("value")).first()[0] == arr[3:9, 2:6].sum()


def test_rotated_raster_rejected():
    with pytest.raises(ValueError, match="rotated"):
        population.Affine(1, 0.1, 0, 0, -1, 0)


def test_many_nodes_and_ways_are_joined_by_many_tasks(spark, sf, monkeypatch):
    """The means of ways keep a bounded number of rows in a task, and ways are not combined before their shuffle."""
    from hexmosaic.plans import derived, queries

    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    e = derived.elements(spark, sf)
    want = sorted(map(tuple, queries.way_centroid(spark, sf).collect()))
    assert "RepartitionByExpression" not in plan(queries.way_centroid(spark, sf))
    monkeypatch.setattr(pois, "NODES_AT_ONCE", 100)
    monkeypatch.setattr(derived, "LINES_AT_ONCE", 300)
    nodes, lines = e.where("kind = 'node'").count(), derived.table(spark, sf, "lineitem").count()
    many = queries.way_centroid(spark, sf)
    text = plan(many)
    assert "RepartitionByExpression [ref#" in text and f"], {-(-nodes // 100)}" in text and f"], {-(-lines // 300)}" in text
    assert sorted(map(tuple, many.collect())) == want
    none = spark.createDataFrame([], e.schema)
    assert pois.way_positions(none, none).count() == 0
