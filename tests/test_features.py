import pytest
from pyspark.sql import functions as F

from hexmosaic.functions import hexgrid as hx
from hexmosaic.operators import checks, features
from hexmosaic.operators.polyfill import grid_table


@pytest.fixture(scope="module")
def seven(spark):
    centre = hx.cell(F.lit(11.55), F.lit(104.92), 8)
    c = spark.range(1).select(centre).first()[0]
    grid = grid_table(spark.range(1).select(F.explode(hx.grid_disk(centre, 1)).alias("h3")), 8)
    other = grid.where(F.col("h3") != c).agg(F.min("h3")).first()[0]
    people = F.when(F.col("h3") == c, 1000.0).when(F.col("h3") == other, 300.0).otherwise(0.0)
    pop = grid.select("h3", "h3_str", people.alias("population"), F.lit(0).alias("n_pixels"))
    rows = [(c, "amenity=pharmacy"), (c, "amenity=pharmacy"), (c, "amenity=school")]
    pois = spark.createDataFrame(rows, "h3_res8 long, category string")
    out = features.hex_features(grid, pop, pois, 8, ks=(1,))
    return c, other, out, grid, pop, pois


def test_seven_cell_fixture(seven):
    c, other, out, grid, pop, pois = seven
    rows = {r["h3"]: r for r in out.collect()}
    assert len(rows) == 7
    r = rows[c]
    assert (r["n_poi"], r["n_health"], r["n_education"], r["n_health_k1"]) == (3, 2, 1, 2)
    assert r["poi_per_1k_pop"] == pytest.approx(3.0)
    assert r["poi_category_entropy"] == pytest.approx(0.9183, abs=1e-3)
    assert r["population_k1"] == pytest.approx(1300) and r["data_gap"] is False
    o = rows[other]
    assert (o["n_poi"], o["n_health_k1"], o["data_gap"]) == (0, 2, True)
    assert o["poi_category_entropy"] is None and rows[c]["n_other"] == 0
    checks.check_features(out, grid, pop, 3)
    with pytest.raises(AssertionError, match="n_poi"):
        checks.check_features(out, grid, pop, 4)


def test_schema_and_k_families(seven):
    _, _, out, grid, pop, pois = seven
    two = features.hex_features(grid, pop, pois, 8)
    assert len(two.columns) == 43
    assert dict(two.dtypes)["n_poi_k2"] == "int" and dict(two.dtypes)["population_k2"] == "double"
    assert "data_gap" in features.hex_features(grid, pop, pois, 8, ks=()).columns


def test_single_category_entropy_is_plus_zero(spark, seven):
    c = seven[0]
    pois = spark.createDataFrame([(c, "shop=x")] * 5, "h3_res8 long, category string")
    r = features.poi_counts(pois, "h3_res8", {}).first()
    assert str(r["poi_category_entropy"]) == "0.0" and r["n_other"] == 5


def test_duplicate_grid_rejected(spark, seven):
    grid = seven[3]
    with pytest.raises(AssertionError, match="repeated = 1"):
        checks.check_grid(grid.unionByName(grid.limit(1)), 8, 6.0, "overlap")
    with pytest.raises(AssertionError, match="wrong_res = 7"):
        checks.check_grid(grid, 7, 6.0, "overlap")


def test_quantiles_classes_and_gaps(spark):
    df = spark.createDataFrame([(i, float(i), i) for i in range(0, 100)], "h3 long, population double, n_poi int")
    b = features.quantile_breaks(df).orderBy("class").collect()
    assert len(b) == 7 and b[0]["lower"] == 1.0 and b[-1]["upper"] == 99.0
    assert b[0]["upper"] == pytest.approx(15.0)
    k = features.quantile_classes(df).groupBy("class").count().collect()
    assert {r["class"] for r in k} == set(range(1, 8)) and max(r["count"] for r in k) <= 15
    m = {r["n_poi"]: r["c"] for r in df.select("n_poi", features.manual_class(F.col("n_poi")).alias("c")).collect()}
    assert (m[0], m[1], m[4], m[5], m[24], m[25], m[99]) == (None, "1", "2–4", "5–9", "10–24", "25–99", "25–99")
    f = df.withColumn("n_health_k2", F.col("n_poi") - 60)
    assert [r.h3 for r in features.service_gaps(f, "health", 2, 50.0).collect()] == [60]


def test_rollup_and_disaggregate_keep_totals(spark):
    h = spark.range(1).select(F.explode(hx.grid_disk(hx.cell(F.lit(11.5), F.lit(104.9), 8), 3)).alias("h3"))
    v = h.withColumn("population", F.lit(7.0))
    up = features.rollup_cells(v, 8, 7, ["population"])
    down = features.disaggregate_cells(v, 8, ["population"])
    total = 7.0 * 37
    assert up.agg(F.sum("population")).first()[0] == pytest.approx(total)
    assert down.agg(F.sum("population")).first()[0] == pytest.approx(total)
    back = features.rollup_cells(down, 9, 8, ["population"])
    assert back.join(v.select("h3"), "h3", "left_semi").count() == 37 == back.count()


def test_city_first_match(spark):
    d = spark.createDataFrame([(11.5, 104.9), (13.35, 103.8), (0.0, 0.0)], "lat double, lng double")
    got = [r[0] for r in d.select(features.city_of(F.col("lat"), F.col("lng"))).collect()]
    assert got == ["Phnom Penh", "Siem Reap", None]


def test_neighbour_sums_of_any_numbers(spark):
    c = spark.range(1).select(hx.cell(F.lit(11.55), F.lit(104.92), 8)).first()[0]
    df = spark.createDataFrame([(c, -5, -1.5), (c + 1, 2, 3.25), (c + 2, 0, None)], "h3 long, n int, x double")
    got = {r.h3: (r.n_k1, r.x_k1) for r in features.neighbour_sums(df, ["n", "x"], [1]).collect()}
    assert got[c] == got[c + 1] == (-3, 1.75) and got[c - 1] == (-5, -1.5)
    one = {r.h3: r.x_k1 for r in features.neighbour_sums(df, ["x"], [1]).collect()}
    assert one[c] == 1.75


def test_wide_sums_equal_scattered_ones(spark):
    k, rows = 6, []
    start = spark.range(1).select(hx.cell(F.lit(11.5), F.lit(104.9), 8)).first()[0]
    for i, r in enumerate(spark.range(1).select(F.explode(hx.grid_disk(F.lit(start), 9)).alias("h3")).collect()):
        rows.append((r.h3, [0, None, i, -i][i % 4], [0.0, i / 7, None, -0.1][i % 4 if i % 3 else 0]))
    df = spark.createDataFrame(rows, "h3 long, n int, x double")
    got = {r.h3: (r.n_k6, r.x_k6) for r in features.wide_sums(df, ["n", "x"], k).collect()}
    want = {r.h3: (r.n_k6, r.x_k6) for r in features.neighbour_sums(df, ["n", "x"], [k]).collect()}
    assert set(got) == {r[0] for r in rows}
    for h, (n, x) in got.items():
        assert n == (want[h][0] or 0) and abs(x - (want[h][1] or 0)) < 1e-6
    filled = sum(1 for r in rows if r[1] or r[2])
    assert features.row_ends(df, ["n", "x"], k).count() == filled * 2 * (2 * k + 1)
    assert features.wide_sums(df.limit(0), ["n", "x"], k).count() == 0
