import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from hexmosaic.functions import geo
from hexmosaic.functions import hexgrid as hx


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(5)
    rows = [(float(a), float(b)) for a, b in zip(rng.uniform(9.9, 14.7, 3000), rng.uniform(102.3, 107.7, 3000))]
    return spark.createDataFrame(rows, "lat double, lng double").cache()


@pytest.mark.parametrize("res", [0, 5, 7, 8, 11, 15])
def test_centre_is_in_its_cell_and_points_are_near(points, res):
    d = points.select("lat", "lng", hx.cell(F.col("lat"), F.col("lng"), res).alias("h"))
    d = d.select("*", hx.cell_lat(F.col("h")).alias("a"), hx.cell_lng(F.col("h"), res).alias("b"))
    far = geo.haversine_m(F.col("lat"), F.col("lng"), F.col("a"), F.col("b")) / hx.circumradius(res)
    r = d.agg(
        F.count_if(hx.cell(F.col("a"), F.col("b"), res) != F.col("h")).alias("lost"),
        F.max(far).alias("far"),
        F.count_if(hx.cell_res(F.col("h")) != res).alias("res"),
        F.count_if(hx.string_to_cell(hx.cell_to_string(F.col("h"))) != F.col("h")).alias("text"),
    ).first()
    assert (r["lost"], r["res"], r["text"]) == (0, 0, 0)
    if res > 4:
        assert r["far"] < 1.03


@pytest.mark.parametrize("res", [7, 8])
def test_seven_children_per_parent(points, res):
    cells = points.select(hx.cell(F.col("lat"), F.col("lng"), res).alias("h")).distinct()
    kids = cells.select("h", F.explode(hx.cell_to_children(F.col("h"), res)).alias("c"))
    back = kids.withColumn("p", hx.cell_to_parent(F.col("c"), res + 1, res))
    n = cells.count()
    assert kids.select("c").distinct().count() == 7 * n
    assert back.where(F.col("p") != F.col("h")).count() == 0


@pytest.mark.parametrize("k", [0, 1, 2, 3])
def test_disk_size_and_distance(points, k):
    h = points.limit(20).select(hx.cell(F.col("lat"), F.col("lng"), 8).alias("h"))
    d = h.select("h", F.explode(hx.grid_disk_rings(F.col("h"), k)).alias("t")).select("h", "t.*").distinct()
    assert d.groupBy("h").count().where(F.col("count") != 1 + 3 * k * (k + 1)).count() == 0
    x1, y1 = hx.cell_xy(F.col("h"), 8)
    x2, y2 = hx.cell_xy(F.col("cell"), 8)
    step = F.sqrt((x1 - x2) ** 2 + (y1 - y2) ** 2) / F.lit(hx.circumradius(8) * hx.SQRT3)
    assert d.where((step > F.col("ring") + 1e-6) | (step < F.col("ring") * 0.86)).count() == 0


def test_boundary_and_area(spark):
    c = hx.cell(F.lit(11.55), F.lit(104.92), 8)
    row = spark.range(1).select(hx.cell_boundary(c, 8).alias("ring"), hx.cell_area(c).alias("a")).first()
    assert len(row["ring"]) == 7 and row["ring"][0] == row["ring"][-1]
    assert row["a"] == pytest.approx(0.859, abs=1e-3)
    assert hx.cell_area_km2(7) == pytest.approx(7 * hx.cell_area_km2(8))


def test_utm_area_agrees_with_equal_area(spark):
    from hexmosaic.operators.polygons import area_km2

    c = hx.cell(F.lit(11.55), F.lit(104.92), 5)
    a = spark.range(1).select(area_km2(F.array(hx.cell_boundary(c, 5)), 48).alias("a")).first()["a"]
    assert a == pytest.approx(hx.cell_area_km2(5), rel=5e-3)
    e, n = spark.range(1).select(*geo.utm_forward(F.lit(0.0), F.lit(105.0), 48)).first()
    assert (e, n) == pytest.approx((500000.0, 0.0), abs=1e-6)


def test_resolution_bounds():
    with pytest.raises(ValueError):
        hx.circumradius(16)
    assert hx.circumradius(8) == 575.0 and math.isclose(hx.circumradius(6), 575 * 7)
