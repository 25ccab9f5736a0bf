from datetime import date

import pytest
from pyspark.sql import functions as F

from hexmosaic.config import Params
from hexmosaic.operators import catalog
from hexmosaic.sources import readers, sinks

RELEASES = ["2026-08-19.0", "2026-09-23.0", "2026-09-23.1", "not-a-release"]
STAMPS = ["260901", "260923", "260928"]


def pick(spark, names, ref):
    df = spark.createDataFrame([("s", n) for n in names], "source string, name string")
    return [r.snapshot for r in catalog.pick_snapshots(df, ref).collect()]


def test_pick_snapshots(spark):
    assert pick(spark, RELEASES, date(2026, 9, 23)) == ["2026-09-23.1"]
    assert pick(spark, RELEASES, date(2026, 9, 22)) == ["2026-08-19.0"]
    assert pick(spark, RELEASES, date(2026, 1, 1)) == []
    assert pick(spark, STAMPS, date(2026, 9, 23)) == ["260923"]
    assert pick(spark, STAMPS, date(2026, 9, 20)) == ["260901"]
    assert pick(spark, ["x-260901.osm.pbf", "junk"], date(2026, 9, 20)) == ["x-260901.osm.pbf"]
    assert pick(spark, ["2026-09-23.9", "2026-09-23.10"], date(2026, 9, 23)) == ["2026-09-23.10"]


def test_resolve_and_fallback(spark):
    online = spark.createDataFrame([("a", n) for n in RELEASES], "source string, name string")
    cached = spark.createDataFrame([("a", "2026-09-24.0"), ("b", "260701")], "source string, name string")
    r = {x.source: x for x in catalog.resolve_snapshots(online, date(2026, 9, 23), 45, cached).collect()}
    assert (r["a"].snapshot, r["a"].lag_days, r["a"].stale) == ("2026-09-23.1", 0, False)
    assert (r["b"].snapshot, r["b"].lag_days, r["b"].stale) == ("260701", 84, True)
    with pytest.raises(LookupError, match="c"):
        catalog.require_snapshots(catalog.pick_snapshots(online, date(2026, 9, 23)), ["a", "c"])


def test_source_catalogue(spark):
    sources = spark.createDataFrame(
        [
            ("a", "places", "https://h/{snapshot}/x", "CC0", False),
            ("b", "old", "https://h/{snapshot}", "ODbL", False),
            ("c", "none", "https://h/{snapshot}", "ODbL", False),
            ("pop", "people", "https://h/{year}/p_{year}.tif", "CC-BY", True),
        ],
        "name string, provides string, url_template string, license string, yearly boolean",
    )
    listing = spark.createDataFrame([("a", "2026-09-23.1"), ("b", "260101")], "source string, name string")
    resolved = catalog.resolve_snapshots(listing, date(2026, 9, 23))
    got = {r["name"]: r for r in catalog.source_catalogue(sources, resolved, 2025, date(2026, 9, 23)).collect()}
    assert (got["a"].url, got["a"].lag_days, got["a"].warning) == ("https://h/2026-09-23.1/x", 0, None)
    assert (got["b"].warning, got["c"].warning, got["c"].url) == ("stale snapshot", "no snapshot", None)
    assert (got["pop"].url, got["pop"].snapshot_date, got["pop"].warning) == ("https://h/2025/p_2025.tif", date(2025, 7, 1), "estimate of another year")


def test_a_broken_rerun_is_not_fresh(spark, tmp_path):
    ledger = catalog.Ledger(spark, str(tmp_path / "ledger"))
    out = str(tmp_path / "out")
    spark.range(3).write.parquet(out)
    ledger.record("s", "v1", {"n": 3}, [out])
    assert ledger.is_fresh("s", "v1") and not ledger.is_fresh("s", "v2") and not ledger.is_fresh("t", "v1")
    ledger.invalidate("s")  # a forced rerun begins, and dies before it records anything
    assert not ledger.is_fresh("s", "v1")
    ledger.record("s", "v1", {"n": 3}, [out, str(tmp_path / "gone")])
    assert not ledger.is_fresh("s", "v1")


def test_params():
    p = Params(resolutions=(8, 7, 8))
    assert p.resolutions == (7, 8) and p.index_resolutions == [7, 8, 11]
    assert p.year == 2026 and len(p.hash()) == 12 and p.hash() != Params().hash()
    for bad in ({"resolutions": (16,)}, {"resolutions": ()}, {"containment": "x"}, {"min_confidence": 2}, {"use": ("z",)}):
        with pytest.raises(ValueError):
            Params(**bad)


def test_truth_files(spark, tmp_path):
    csv = tmp_path / "t.csv"
    csv.write_text("Name,Latitude,LON,Type\nA,11.5,104.9,bank\nB,bad,104.9,\n")
    rows = readers.read_truth_csv(spark, str(csv)).collect()
    assert [(r.lat, r.lng, r.name, r.category) for r in rows] == [(11.5, 104.9, "A", "bank")]
    gj = tmp_path / "t.geojson"
    gj.write_text(
        '{"type":"FeatureCollection","features":[{"type":"Feature","geometry":{"type":"Point","coordinates":[104.9,11.5]},'
        '"properties":{"name":"A","amenity":"bank"}},{"type":"Feature","geometry":{"type":"LineString","coordinates":[[1,2],[3,4]]},"properties":{}}]}'
    )
    rows = readers.read_truth_geojson(spark, str(gj)).collect()
    assert [(r.lat, r.lng, r.name, r.category) for r in rows] == [(11.5, 104.9, "A", "bank")]
    with pytest.raises(ValueError, match="latitude"):
        readers.detect_columns(["a"])
        readers._truth(spark.createDataFrame([(1,)], "a int"), None)


def test_categories(spark):
    df = spark.createDataFrame([(["shop"], "shop=a"), (["shop"], "shop=a"), (["shop"], "shop=b"), (["amenity"], "amenity=c")], "category_hierarchy array<string>, category string")
    c = catalog.explore_categories(df)
    assert [(r.category, r.n) for r in catalog.top_categories(c, 2).collect()] == [("shop=a", 2), ("amenity=c", 1)]
    assert {r.top_level: r.n for r in catalog.by_top_level(c).collect()} == {"shop": 3, "amenity": 1}


def test_ledger(spark, tmp_path):
    led = catalog.Ledger(spark, str(tmp_path / "ledger"))
    assert not led.is_fresh("s", "i")
    out = tmp_path / "o"
    led.record("s", "i", {"rows": 1}, [str(out)], Params())
    assert not led.is_fresh("s", "i")
    out.mkdir()
    assert led.is_fresh("s", "i") and not led.is_fresh("s", "j")
    led.record("s", "j", {"rows": 2}, [str(out)])
    assert led.is_fresh("s", "j") and led.table().count() == 1


def test_sinks(spark, tmp_path):
    df = spark.range(50).select(F.col("id").alias("h3"), F.col("id").cast("string").alias("h3_str"), F.lit(None).cast("string").alias("n"))
    sinks.write_table(df, str(tmp_path / "p"), "h3")
    assert [r.h3 for r in spark.read.parquet(str(tmp_path / "p")).orderBy("h3").collect()] == list(range(50))
    sinks.write_csv(df, str(tmp_path / "c"), "h3_str")
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).columns == ["h3_str", "n"]
    sinks.write_json_lines(df, str(tmp_path / "j"), "h3")
    assert spark.read.json(str(tmp_path / "j")).count() == 50


def test_table_checksum_ignores_order(spark):
    import hashlib

    rows = [("a", None), ("b", "x"), ("a", "")]
    want = {c: sum(int(hashlib.sha256(r[i].encode()).hexdigest()[:8], 16) for r in rows if r[i] is not None) for i, c in enumerate("st")}
    for r in (rows, rows[::-1]):
        df = spark.createDataFrame(r, "s string, t string").repartition(3)
        assert {x["column"]: x["checksum"] for x in readers.table_checksum(df, ["s", "t"]).collect()} == want
    assert [x["checksum"] for x in readers.table_checksum(df.limit(0), ["s"]).collect()] == [0]


def test_partitioned_area_scan(spark, tmp_path):
    df = spark.createDataFrame(
        [("KH", "country", "a", (102.5, 103.0, 10.0, 11.0)), ("TH", "country", "b", (102.5, 103.0, 10.0, 11.0))],
        "country string, subtype string, id string, bbox struct<xmin:double,xmax:double,ymin:double,ymax:double>",
    )
    df.write.partitionBy("country").parquet(str(tmp_path / "areas"))
    out = readers.read_areas(spark, str(tmp_path / "areas"), Params().bbox, "KH")
    assert [r.id for r in out.collect()] == ["a"]
    assert "PartitionFilters: [isnotnull(country" in out._jdf.queryExecution().executedPlan().toString()
