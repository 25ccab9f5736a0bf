"""Named queries over the driver's tables: every operator on views derived from whole tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexmosaic.config import Params
from hexmosaic.functions import geo, rules, text
from hexmosaic.functions import hexgrid as hx
from hexmosaic.operators import admin, catalog, checks, clip, dedupe, features, match, polyfill, polygons, pois, population
from hexmosaic.plans import derived as d
from hexmosaic.session import cut_lineage, new_path, unsent
from hexmosaic.sources import readers, sinks

RES = 8
PARAMS = Params(resolutions=(RES,))
GROUPS = rules.DEFAULT_GROUPS
NAMES = features.group_names(GROUPS)
BOX = {"xmin": 102.45, "xmax": 102.95, "ymin": 10.05, "ymax": 10.2}
CITY_BOXES = {"West": (102.4, 102.6, 10.0, 10.31), "Middle": (102.5, 103.1, 10.1, 10.2), "East": (103.0, 107.7, 9.9, 14.7)}
REFERENCE = date.fromisoformat(d.REFERENCE)


def r6(c: str, name: str | None = None):
    return F.round(c, 6).alias(name or c)


# --- shared inputs ------------------------------------------------------------------------


def staged(spark: SparkSession, sf: str) -> DataFrame:
    return pois.stage_elements(d.elements(spark, sf))


def point_grid(spark: SparkSession, sf: str, res: int = RES) -> DataFrame:
    """Grid of all cells holding a node."""
    n = d.nodes(spark, sf)
    return polyfill.grid_table(n.select(hx.cell(F.col("lat"), F.col("lon"), res).alias("h3")), res)


def pixels(spark: SparkSession, sf: str) -> DataFrame:
    return population.raster_to_pixels(d.raster_blocks(spark, sf), d.AFFINE, d.NODATA)


def point_features(spark: SparkSession, sf: str) -> DataFrame:
    """Feature table over the cells of all nodes, without a boundary."""
    grid = point_grid(spark, sf)
    pop = population.population_by_cell(pixels(spark, sf), grid, RES)
    return features.hex_features(grid, pop, pois.index_points(staged(spark, sf), [RES]), RES)


def node_points(spark: SparkSession, sf: str) -> DataFrame:
    return d.positions(spark, sf).select("id", "lat", F.col("lon").alias("lng"))


# --- scans, filters, staging --------------------------------------------------------------


def bbox_prefilter(spark, sf):
    out = polygons.filter_areas(d.areas(spark, sf), BOX, "KH")
    return out.select("id", "area_name", r6("bbox.xmin", "xmin"), r6("bbox.ymax", "ymax"))


def osm_category(spark, sf):
    return pois.tagged_elements(d.elements(spark, sf)).select("kind", "id", "category")


def way_centroid(spark, sf):
    e = d.elements(spark, sf)
    pos = pois.way_positions(e.where(F.col("kind") == "way"), e)
    return pos.select("id", r6("lat"), r6("lon"))


def _common(df: DataFrame) -> DataFrame:
    return df.select(
        "source",
        "source_id",
        "name",
        "name_en",
        "category",
        F.array_join("category_hierarchy", ">").alias("category_hierarchy"),
        "confidence",
        r6("lat"),
        r6("lng"),
        "attrs",
    )


def stage_osm(spark, sf):
    return _common(staged(spark, sf))


def stage_places(spark, sf):
    return _common(pois.stage_places(d.places(spark, sf), PARAMS.min_confidence))


def source_union(spark, sf):
    both = pois.union_sources([staged(spark, sf), pois.stage_places(d.places(spark, sf), PARAMS.min_confidence)])
    return both.groupBy("source", "category").agg(F.count("*").alias("n"))


# --- hexagon index ------------------------------------------------------------------------


def cell_index(spark, sf):
    p = node_points(spark, sf)
    c = p.select("id", *[hx.cell(F.col("lat"), F.col("lng"), r).alias(f"h3_res{r}") for r in (7, 8, 11)])
    h = F.col("h3_res8")
    return c.select(
        "*",
        hx.cell_to_string(h).alias("h3_str"),
        hx.string_to_cell(hx.cell_to_string(h)).alias("back"),
        hx.cell_res(F.col("h3_res11")).alias("res11"),
        F.round(hx.cell_lat(h, RES), 6).alias("lat8"),
        F.round(hx.cell_lng(h, RES), 6).alias("lng8"),
        F.round(hx.cell_lat(F.col("h3_res7")), 6).alias("lat7"),
        F.round(hx.cell_lng(F.col("h3_res7")), 6).alias("lng7"),
        F.round(hx.cell_area(h), 9).alias("km2"),
    )


def cell_parent(spark, sf):
    g = point_grid(spark, sf, 9).select("h3")
    return g.select("h3", hx.cell_to_parent(F.col("h3"), 9, 8).alias("p8"), hx.cell_to_parent(F.col("h3"), 9, 7).alias("p7"))


def grid_disk(spark, sf):
    g = point_grid(spark, sf).select("h3", F.explode(hx.grid_disk_rings(F.col("h3"), 2)).alias("t"))
    return g.select("h3", F.col("t.cell").alias("cell"), F.col("t.ring").alias("ring"))


def cell_boundary_wkt(spark, sf):
    g = point_grid(spark, sf).select("h3")
    return g.select("h3", geo.polygon_wkt(F.array(hx.cell_boundary(F.col("h3"), RES)), 6).alias("wkt"))


# --- polygons -----------------------------------------------------------------------------


def polygon_area(spark, sf):
    return d.parts(spark, sf).select("part_id", F.round(polygons.area_deg2(F.col("polygon")), 12).alias("deg2"))


def utm_area(spark, sf):
    a = polygons.utm_areas(polygons.ring_edges(d.parts(spark, sf)), PARAMS.utm_zone)
    return a.select("part_id", F.round("area_km2", 5).alias("area_km2"))


def boundary_parts(spark, sf):
    p = polygons.boundary_parts(d.areas(spark, sf), PARAMS.utm_zone, ("id",))
    return p.select("part_id", F.round("area_km2", 5).alias("area_km2"))


def surface_points(spark, sf):
    s = polygons.surface_points(polygons.ring_edges(d.parts(spark, sf)))
    return s.select("part_id", r6("lat"), r6("lng"))


def point_in_polygon(spark, sf):
    return clip.locate_points(node_points(spark, sf), d.parts(spark, sf), RES, "id")


def point_in_polygon_bands(spark, sf):
    """The same by ray parity over latitude bands, the form that decides crowded cells."""
    return polygons.points_in_parts(d.ours(spark, sf), polygons.ring_edges(d.parts(spark, sf)), "id")


def crowded_cells(spark, sf):
    """Points against tiles of many rings (inside an odd number of them) by cells that hold hundreds of edges."""
    tile = F.expr(f"part_id div {2 * d.AREAS_PER_TILE}").alias("tile")
    rings = d.parts(spark, sf).groupBy(tile).agg(F.flatten(F.collect_list("polygon")).alias("polygon"))
    return clip.locate_points(node_points(spark, sf), rings, 4, "id", "tile")


def polyfill_center(spark, sf):
    return polyfill.part_cells(polygons.ring_edges(d.parts(spark, sf)), RES, "center")


def polyfill_center_odd(spark, sf):
    return polyfill.part_cells(polygons.ring_edges(d.parts(spark, sf)), 9, "center")


def polyfill_overlap(spark, sf):
    return polyfill.part_cells(polygons.ring_edges(d.parts(spark, sf)), RES, "overlap")


def polyfill_buffered(spark, sf):
    return polyfill.part_cells(polygons.ring_edges(d.parts(spark, sf)), RES, "center", 500.0)


def polyfill_buffered_overlap(spark, sf):
    return polyfill.part_cells(polygons.ring_edges(d.parts(spark, sf)), RES, "overlap", 500.0)


def grid_table(spark, sf):
    g = polyfill.polyfill_grid(d.parts(spark, sf), RES, "overlap")
    return g.select("h3", "h3_str", F.col("res").cast("int").alias("res"), r6("lat"), r6("lng"))


def clip_and_index(spark, sf):
    parts = d.parts(spark, sf)
    grid = polyfill.polyfill_grid(parts, RES, "overlap")
    out = pois.clip_and_index(staged(spark, sf), grid, parts, PARAMS)
    return out.select("source_id", "category", "h3_res8", "h3_res11")


def admin_tags(spark, sf):
    return admin.tag_admin(point_grid(spark, sf).select("h3"), d.admin_areas(spark, sf), RES)


# --- population ---------------------------------------------------------------------------


def raster_pixels(spark, sf):
    return pixels(spark, sf).select(F.round("lat", 7).alias("lat"), F.round("lng", 7).alias("lng"), "pop")


def raster_block_sum(spark, sf):
    cells = population.raster_cells(d.raster_blocks(spark, sf), d.NODATA)
    return population.raster_block_sum(cells, 7, d.RASTER_ROWS, d.RASTER_COLS)


def raster_window(spark, sf):
    """Blocks written as a table and read back by the block reader, with the window pushed to the scan."""
    path = new_path(spark, "blocks")
    d.raster_blocks(spark, sf).write.parquet(path)
    return population.raster_window(readers.read_raster_blocks(spark, path), d.AFFINE, BOX, (2, 3), d.NODATA)


def population_by_cell(spark, sf):
    return population.population_by_cell(pixels(spark, sf), point_grid(spark, sf), RES)


# --- features -----------------------------------------------------------------------------


def group_counts(spark, sf):
    c = features.poi_counts(pois.index_points(staged(spark, sf), [RES]), f"h3_res{RES}", GROUPS)
    return c.drop("poi_category_entropy")


def category_entropy(spark, sf):
    c = features.poi_counts(pois.index_points(staged(spark, sf), [RES]), f"h3_res{RES}", GROUPS)
    return c.select("h3", r6("poi_category_entropy", "bits"))


def neighbour_sums(spark, sf):
    grid = point_grid(spark, sf)
    pop = population.population_by_cell(pixels(spark, sf), grid, RES).select("h3", "population", "n_pixels")
    sums = features.neighbour_sums(pop, ["population", "n_pixels"], [1, 2])
    return grid.select("h3").join(sums, "h3", "left").na.fill(0)


def neighbour_sums_wide(spark, sf):
    pop = population.population_by_cell(pixels(spark, sf), point_grid(spark, sf), RES)
    sums = features.wide_sums(pop.select("h3", "population", "n_pixels"), ["population", "n_pixels"], 20)
    return sums.select("h3", r6("population_k20"), "n_pixels_k20")


def _rounded(f: DataFrame) -> DataFrame:
    digits = {"lat", "lng", "population", "poi_category_entropy", "poi_per_1k_pop"}
    return f.select(*[r6(c) if c in digits or c.startswith("population_k") else F.col(c) for c in f.columns])


def hex_features(spark, sf):
    """The whole pipeline: fill, population, staging, clip, features.

    The grid is written once, as between pipeline stages: three later steps read it.
    """
    parts = d.parts(spark, sf)
    grid = cut_lineage(polyfill.polyfill_grid(parts, RES, "overlap"))
    pop = population.population_by_cell(pixels(spark, sf), grid, RES)
    poi = pois.clip_and_index(staged(spark, sf), grid, parts, PARAMS)
    return _rounded(features.hex_features(grid, pop, poi, RES))


def data_gap(spark, sf):
    f = point_features(spark, sf)
    return f.where("data_gap").select("h3", r6("population"), "n_poi", "n_poi_k2")


def service_gaps(spark, sf):
    f = point_features(spark, sf)
    out = [
        features.service_gaps(f, g, k=1, min_pop=300.0).select(F.lit(g).alias("grp"), "h3", r6("population"))
        for g in ("health", "education", "finance")
    ]
    return pois.union_sources(out)


def quantile_breaks(spark, sf):
    b = features.quantile_breaks(population_by_cell(spark, sf))
    return b.select("class", r6("lower"), r6("upper"))


def quantile_classes(spark, sf):
    c = features.quantile_classes(population_by_cell(spark, sf))
    return c.select("h3", r6("population"), "class")


def manual_classes(spark, sf):
    c = features.poi_counts(pois.index_points(staged(spark, sf), [RES]), f"h3_res{RES}", GROUPS)
    return c.select("h3", "n_poi", features.manual_class(F.col("n_poi")).alias("class"))


def top_cells(spark, sf):
    c = features.poi_counts(pois.index_points(staged(spark, sf), [RES]), f"h3_res{RES}", GROUPS)
    top = features.top_cells(c.select("h3", "n_poi"))
    lat, lng = hx.cell_latlng(F.col("h3"), RES)
    return top.select("h3", "n_poi", features.city_of(lat, lng, CITY_BOXES).alias("city"))


def rollup_parent(spark, sf):
    p = population_by_cell(spark, sf)
    up = features.rollup_cells(p, RES, 7, ["population", "n_pixels"])
    return up.select("h3", r6("population"), "n_pixels")


def uniform_children(spark, sf):
    p = population_by_cell(spark, sf)
    return features.disaggregate_cells(p, RES, ["population"]).select("h3", r6("population"))


# --- consumers ----------------------------------------------------------------------------


def explore_categories(spark, sf):
    return catalog.explore_categories(staged(spark, sf))


def top_categories(spark, sf):
    return catalog.top_categories(catalog.explore_categories(staged(spark, sf)), 10)


def categories_by_top_level(spark, sf):
    return catalog.by_top_level(catalog.explore_categories(staged(spark, sf)))


def health_pois(spark, sf):
    s = features.pois_of(staged(spark, sf), ["amenity=clinic", "amenity=pharmacy"])
    return s.select("source_id", "category")


def snapshot_asof(spark, sf):
    r = catalog.resolve_snapshots(d.listings(spark, sf), REFERENCE, PARAMS.max_source_lag_days)
    return r.select("source", "snapshot", F.col("snapshot_date").cast("string").alias("snapshot_date"), "lag_days", "stale")


def orphan_parents(spark, sf):
    coarse = polyfill.polyfill_grid(d.parts(spark, sf), 7, "center")
    fine = polyfill.polyfill_grid(d.parts(spark, sf), RES, "center")
    return checks.orphan_parents(fine, RES, coarse, 7)


def name_trigram(spark, sf):
    c = d.ours(spark, sf).select("id", F.col("name").alias("a"))
    t = d.truth(spark, sf).select("id", F.col("name").alias("b"))
    return c.join(t, "id").select("id", r6_sim())


def r6_sim():
    return F.round(text.name_similarity(F.col("a"), F.col("b")), 6).alias("similarity")


def match_points(spark, sf):
    m = match.match_points(d.ours(spark, sf), d.truth(spark, sf), 100.0, 0.5)
    return m.select("ours_id", "truth_id", F.round("distance_m", 4).alias("distance_m"), r6("similarity"))


def match_distance_only(spark, sf):
    m = match.match_points(d.ours(spark, sf), d.truth(spark, sf), 300.0)
    return m.select("ours_id", "truth_id", F.round("distance_m", 4).alias("distance_m"))


def compare_by_cell(spark, sf):
    a, b = d.ours(spark, sf), d.truth(spark, sf)
    m = match.match_points(a, b, 100.0, 0.5)
    c = match.compare_by_cell(a, b, m, population.pixels_by_cell(pixels(spark, sf), RES), RES)
    return c.select(*[r6(x) if x in ("lat", "lng", "population") else F.col(x) for x in c.columns])


def agreement(spark, sf):
    a, b = d.ours(spark, sf), d.truth(spark, sf)
    m = match.match_points(a, b, 100.0, 0.5)
    c = match.compare_by_cell(a, b, m, population.pixels_by_cell(pixels(spark, sf), RES), RES)
    return match.agreement(c).select(
        "ours", "ground_truth", "matched_ours", "matched_ground_truth", r6("recall"), r6("precision")
    )


def _two_sources(spark, sf) -> DataFrame:
    """Places and a second source telling of the same customers a few metres away."""
    a = pois.stage_places(d.places(spark, sf), 0.0)
    told = d.truth(spark, sf).select(
        F.concat(F.lit("p"), F.col("id").cast("string")).alias("id"),
        F.col("name").alias("other"),
        F.lit(0.1).alias("w"),
        F.col("lat").alias("tlat"),
        F.col("lng").alias("tlng"),
    )
    t = d.places(spark, sf).drop("lat", "lng").join(unsent(told), "id")
    near = d.places(spark, sf).select("id", F.col("lat").alias("plat"), F.col("lng").alias("plng"))
    t = t.join(unsent(near), "id").select(
        *[c for c in t.columns if c not in ("names", "other", "w", "tlat", "tlng")],
        F.struct(F.col("other").alias("primary"), F.col("names.common").alias("common")).alias("names"),
        (F.col("plat") + (F.col("tlat") - F.col("plat")) * F.col("w")).alias("lat"),
        (F.col("plng") + (F.col("tlng") - F.col("plng")) * F.col("w")).alias("lng"),
    )
    b = pois.stage_places(t, 0.0, "fsq")
    return pois.index_points(pois.union_sources([a, b]), [11])


def dedupe_pois(spark, sf):
    out = dedupe.dedupe_pois(_two_sources(spark, sf), ["overture", "fsq"])
    return out.select("source", "source_id", "name", "dup_group_id")


# --- checks and exports -------------------------------------------------------------------


def quality_report(spark, sf):
    """One row per check: name, value."""
    grid = point_grid(spark, sf)
    f = point_features(spark, sf)
    rows = []
    fs = checks.feature_stats(f)
    gs = checks.grid_stats(grid, RES)
    ps = checks.population_stats(population_by_cell(spark, sf))
    for prefix, df in (("features", fs), ("grid", gs), ("population", ps)):
        pairs = F.array(
            *[
                F.struct(F.lit(f"{prefix}.{c}").alias("check"), F.round(F.col(c).cast("double"), 5).alias("value"))
                for c in df.columns
            ]
        )
        rows.append(df.select(F.inline(pairs)))
    return pois.union_sources(rows)


def poi_check(spark, sf):
    s = pois.index_points(staged(spark, sf), [RES])
    return checks.poi_stats(s, point_grid(spark, sf), RES)


def stage_rows(spark, sf):
    """Row counts per stage, as the ledger records them."""
    tables = {
        "elements": d.elements(spark, sf).select("id"),
        "poi_osm": staged(spark, sf).select(F.lit(1)),
        "places": pois.stage_places(d.places(spark, sf), PARAMS.min_confidence).select(F.lit(1)),
        "pixels": pixels(spark, sf).select(F.lit(1)),
        "parts": d.parts(spark, sf).select("part_id"),
    }
    out = [t.agg(F.count("*").alias("n_rows")).select(F.lit(n).alias("stage"), "n_rows") for n, t in tables.items()]
    return pois.union_sources(out)


def layer_extent(spark, sf):
    e = sinks.layer_extent(node_points(spark, sf))
    return e.select(*[r6(c) for c in e.columns])


def point_layer(spark, sf):
    s = staged(spark, sf)
    return s.select("source_id", geo.point_wkt(F.col("lng"), F.col("lat"), 6).alias("geometry"))


def app_pois(spark, sf):
    return sinks.app_pois(staged(spark, sf)).withColumnRenamed("group", "grp")


def app_population(spark, sf):
    return sinks.app_population(population_by_cell(spark, sf))


def population_layer(spark, sf):
    p = sinks.population_layer(population_by_cell(spark, sf), RES, digits=6)
    return p.select("h3_str", r6("population"), "geometry")


def app_meta(spark, sf):
    """What the comparison page shows, over the features of the given points."""
    m = sinks.app_meta(point_features(spark, sf), RES, d.REFERENCE, ["osm"], GROUPS)
    return m.select("res", "reference_date", F.array_join("sources", ",").alias("sources"), F.array_join("groups", ",").alias("groups"), F.size("fields").alias("n_fields"), "cells")


def geojson_sample(spark, sf):
    """GeoJSON features of the POIs in one bbox."""
    inside = sinks.in_bbox(staged(spark, sf), BOX)
    pts = inside.select("source_id", "name", "name_en", "category", "confidence", F.round("lat", 7).alias("lat"), F.round("lng", 7).alias("lng"))
    return sinks.point_layer(pts, "geojson").withColumnRenamed("value", "feature")


def checksums(spark, sf):
    """Order-free checksum of every text column of all tables."""
    parts = [readers.table_checksum(d.table(spark, sf, t), c).withColumn("table", F.lit(t)) for t, c in d.TEXT_COLUMNS.items()]
    return pois.union_sources(parts)


# --- comparison, checks and round trips ---------------------------------------------------


def biggest_differences(spark, sf):
    a, b = d.ours(spark, sf), d.truth(spark, sf)
    m = match.match_points(a, b, 100.0, 0.5)
    c = match.compare_by_cell(a, b, m, population.pixels_by_cell(pixels(spark, sf), RES), RES)
    return match.biggest_differences(c, 20).select("h3", "ours", "ground_truth", "gt_minus_ours")


def match_inspection(spark, sf):
    a, b = d.ours(spark, sf), d.truth(spark, sf)
    m = match.match_points(a, b, 100.0, 0.5)
    return match.inspect_matches(a, b, m, RES).withColumns({"distance_m": F.round("distance_m", 4), "similarity": F.round("similarity", 6)})


def match_far_north(spark, sf):
    """The same points 62 degrees farther north, where a degree of longitude is a quarter as long."""
    a, b = (t.withColumn("lat", F.col("lat") + 62.0) for t in (d.ours(spark, sf), d.truth(spark, sf)))
    m = match.match_points(a, b, 100.0)
    return m.select("ours_id", "truth_id", F.round("distance_m", 4).alias("distance_m"))


def parts_without_cell(spark, sf):
    parts = d.parts(spark, sf)
    return checks.parts_without_cell(parts, polyfill.polyfill_grid(parts, RES, "center"), RES)


def grid_coverage(spark, sf):
    """Cells, their area and its ratio to the area of the polygons."""
    parts = d.parts(spark, sf)
    area = polygons.utm_areas(polygons.ring_edges(parts), PARAMS.utm_zone).agg(F.sum("area_km2")).first()[0]
    c = checks.coverage(checks.grid_stats(polyfill.polyfill_grid(parts, RES, "center"), RES), area)
    return c.select("cells", "repeated", F.round("cell_km2", 4).alias("cell_km2"), r6("coverage"))


def population_difference(spark, sf):
    total = population.raster_total(d.raster_blocks(spark, sf), d.NODATA).first()["total"]
    p = checks.population_difference(population_by_cell(spark, sf), total)
    return p.select("cells", F.round("total", 3).alias("total"), r6("difference"))


def source_catalogue(spark, sf):
    listing = d.listings(spark, sf)
    sources = listing.select(F.col("source").alias("name")).distinct()
    sources = sources.select("name", F.lit("points").alias("provides"), F.lit("https://h/{snapshot}?y={year}").alias("url_template"), F.lit("CC0").alias("license"), F.col("name").endswith("/draft").alias("yearly"))
    r = catalog.resolve_snapshots(listing, REFERENCE, PARAMS.max_source_lag_days)
    c = catalog.source_catalogue(sources, r, REFERENCE.year, REFERENCE)
    return c.withColumn("snapshot_date", F.col("snapshot_date").cast("string"))


def ledger_rows(spark, sf):
    """Row counts of stages, recorded in a ledger and read back."""
    ledger = catalog.Ledger(spark, new_path(spark, "ledger"))
    for r in stage_rows(spark, sf).collect():  # one row per stage
        ledger.record(r["stage"], "v0", {}, [])
        ledger.record(r["stage"], "v1", {"n_rows": r["n_rows"]}, [])
    return ledger.table().select("stage", "inputs", F.col("rows")["n_rows"].cast("long").alias("n_rows"))


def truth_round_trip(spark, sf):
    """Ground truth written as CSV and read back by its detected columns."""
    path = new_path(spark, "truth")
    t = d.truth(spark, sf).select(F.col("name").alias("Name"), F.col("lat").alias("Latitude"), F.col("lng").alias("LON"), F.lit("customer").alias("Type"))
    t.write.option("header", True).csv(path)
    return readers.read_truth_csv(spark, path).select("name", "category", r6("lat"), r6("lng"))


def wkt_round_trip(spark, sf):
    """Polygons written as WKT and parsed again: vertices and area."""
    text = d.parts(spark, sf).select("part_id", geo.polygon_wkt(F.col("polygon")).alias("wkt"))
    back = readers.with_geometry(text, "wkt", "wkt").select("part_id", F.col("wkt")[0].alias("polygon"))
    return back.select("part_id", F.round(polygons.area_deg2(F.col("polygon")), 6).alias("deg2"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        bbox_prefilter,
        osm_category,
        way_centroid,
        stage_osm,
        stage_places,
        source_union,
        cell_index,
        cell_parent,
        grid_disk,
        cell_boundary_wkt,
        polygon_area,
        utm_area,
        boundary_parts,
        surface_points,
        point_in_polygon,
        point_in_polygon_bands,
        crowded_cells,
        polyfill_center,
        polyfill_center_odd,
        polyfill_overlap,
        polyfill_buffered,
        polyfill_buffered_overlap,
        grid_table,
        clip_and_index,
        admin_tags,
        raster_pixels,
        raster_block_sum,
        raster_window,
        population_by_cell,
        group_counts,
        category_entropy,
        neighbour_sums,
        neighbour_sums_wide,
        hex_features,
        data_gap,
        service_gaps,
        quantile_breaks,
        quantile_classes,
        manual_classes,
        top_cells,
        rollup_parent,
        uniform_children,
        explore_categories,
        top_categories,
        categories_by_top_level,
        health_pois,
        snapshot_asof,
        orphan_parents,
        name_trigram,
        match_points,
        match_distance_only,
        compare_by_cell,
        agreement,
        dedupe_pois,
        quality_report,
        poi_check,
        stage_rows,
        layer_extent,
        point_layer,
        app_pois,
        app_population,
        geojson_sample,
        population_layer,
        app_meta,
        checksums,
        biggest_differences,
        match_inspection,
        match_far_north,
        parts_without_cell,
        grid_coverage,
        population_difference,
        source_catalogue,
        ledger_rows,
        truth_round_trip,
        wkt_round_trip,
    )
}
