"""Data-quality checks: each is one aggregate per table, evaluated to a report or raised."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexmosaic.functions import hexgrid as hx
from hexmosaic.operators.features import city_of, top_cells
from hexmosaic.operators.polygons import ring_edges, surface_points

log = logging.getLogger(__name__)

# Sane land area (km2), cell area over land area by mode, raster tolerance.
AREA_RANGE_KM2 = (170_000, 190_000)
COVERAGE_RANGE = {"center": (0.97, 1.03), "overlap": (1.0, 1.2)}
POPULATION_TOLERANCE = 0.01


Limits = dict[str, tuple[float | None, float | None]]


def _judged(limits: Limits) -> list[Column]:
    number = lambda x: F.lit(x).cast("double")
    rows = []
    for name, (low, high) in limits.items():
        v = F.col(name).cast("double")
        ok = F.coalesce((v >= number(low if low is not None else float("-inf"))) & (v <= number(high if high is not None else float("inf"))), F.lit(False))
        rows.append(F.struct(F.lit(name).alias("check"), v.alias("value"), number(low).alias("low"), number(high).alias("high"), ok.alias("ok")))
    return rows


def report(stats: DataFrame, limits: Limits) -> DataFrame:
    """(check, value, low, high, ok): one row per limited column of a one-row table of statistics.

    A bound of None is open. A NULL value is not ok.
    """
    return stats.select(F.inline(F.array(*_judged(limits))))


def require(subject: str, stats: DataFrame, limits: Limits) -> dict:
    """The statistics as a dict, or AssertionError naming every check that failed; one job."""
    row = stats.select("*", F.array(*_judged(limits)).alias("_report")).first().asDict(recursive=True)
    failed = [r for r in row.pop("_report") if not r["ok"]]
    if failed:
        what = [f"{r['check']} = {r['value']} not in [{r['low']}, {r['high']}]" for r in failed]
        raise AssertionError(f"{subject}: " + "; ".join(what))
    return row


def boundary_stats(parts: DataFrame, raw: DataFrame | None = None) -> DataFrame:
    """Parts and their area; with ``raw`` also the rows they were made from, as a scalar subquery."""
    stats = parts.agg(F.count("*").alias("parts"), F.coalesce(F.sum("area_km2"), F.lit(0.0)).alias("area_km2"))
    return stats if raw is None else stats.select("*", raw.agg(F.count("*")).scalar().alias("raw_rows"))


def check_boundary(parts: DataFrame, area_range=AREA_RANGE_KM2, raw: DataFrame | None = None) -> dict:
    """At least one part, total area in range."""
    return require("boundary", boundary_stats(parts, raw), {"parts": (1, None), "area_km2": area_range})


def grid_stats(grid: DataFrame, res: int) -> DataFrame:
    """Cells, distinct cells, cells of another resolution, area. Keys fold before the count."""
    per = grid.groupBy("h3").agg(F.count("*").alias("n"))
    return per.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("cells"),
        F.count("*").alias("distinct_cells"),
        F.coalesce(F.sum(F.when(hx.cell_res(F.col("h3")) != res, F.col("n"))), F.lit(0)).alias("wrong_res"),
        F.coalesce(F.sum(F.col("n") * hx.cell_area(F.col("h3"))), F.lit(0.0)).alias("cell_km2"),
    )


def coverage(stats: DataFrame, area_km2: float) -> DataFrame:
    """Grid statistics plus the number of repeated keys and cell area over land area."""
    return stats.withColumn("repeated", F.col("cells") - F.col("distinct_cells")).withColumn("coverage", F.col("cell_km2") / F.lit(float(area_km2)))


def check_grid(grid: DataFrame, res: int, area_km2: float, mode: str) -> dict:
    """Unique cells of one resolution that cover the land area within the range of the mode."""
    limits = {"repeated": (0, 0), "wrong_res": (0, 0), "coverage": COVERAGE_RANGE[mode]}
    return require(f"grid {res}", coverage(grid_stats(grid, res), area_km2), limits)


def parts_without_cell(parts: DataFrame, grid: DataFrame, res: int) -> DataFrame:
    """(part_id) of parts whose surface point lies in no grid cell, a row each."""
    pts = surface_points(ring_edges(parts))
    at = pts.select("part_id", hx.cell(F.col("lat"), F.col("lng"), res).alias("h3"))
    return at.join(grid.select("h3"), "h3", "left_anti").select("part_id")


def check_parts(parts: DataFrame, grid: DataFrame, res: int, shown: int = 20) -> None:
    """Every part has a cell; the message names the first few that have none and how many there are."""
    missed = parts_without_cell(parts, grid, res)
    first = [r["part_id"] for r in missed.orderBy("part_id").limit(shown).collect()]
    if first:
        raise AssertionError(f"grid {res}: {missed.count()} parts hold no cell, first {first}")


def orphan_parents(fine: DataFrame, fine_res: int, coarse: DataFrame, coarse_res: int) -> DataFrame:
    """Parents of fine cells that the coarse grid lacks."""
    p = fine.select(hx.cell_to_parent(F.col("h3"), fine_res, coarse_res).alias("h3")).distinct()
    return p.join(coarse.select("h3"), "h3", "left_anti")


def population_stats(population: DataFrame) -> DataFrame:
    return population.agg(
        F.count("*").alias("cells"),
        F.count_if(F.col("population") > 0).alias("populated"),
        F.coalesce(F.sum("population"), F.lit(0.0)).alias("total"),
        F.max("population").alias("max_population"),
    )


def population_difference(population: DataFrame, source_total: float) -> DataFrame:
    """Population statistics plus the relative difference from the raster total (0 if that is 0)."""
    total = F.lit(float(source_total))
    return population_stats(population).withColumn("difference", F.when(total != 0, (F.col("total") - total) / total).otherwise(0.0))


def check_population(population: DataFrame, source_total: float) -> dict:
    """Cell total within the tolerance of the raster total."""
    limits = {"difference": (-POPULATION_TOLERANCE, POPULATION_TOLERANCE)}
    return require("population", population_difference(population, source_total), limits)


def poi_stats(pois: DataFrame, grid: DataFrame, res: int) -> DataFrame:
    """Rows, distinct ids, rows outside the grid: ids fold to one row before they are counted."""
    inside = grid.select(F.col("h3").alias(f"h3_res{res}")).withColumn("_in", F.lit(1))
    marked = pois.select("source_id", f"h3_res{res}").join(inside, f"h3_res{res}", "left")
    per = marked.groupBy("source_id").agg(
        F.count("*").alias("n"), F.count_if(F.col("_in").isNull()).alias("outside")
    )
    return per.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("pois"),
        F.count("*").alias("distinct_ids"),
        F.coalesce(F.sum("outside"), F.lit(0)).alias("outside"),
    )


def check_pois(pois: DataFrame, grid: DataFrame, res: int, source: str = "") -> dict:
    """Some rows, each id once, all of them in grid cells."""
    stats = poi_stats(pois, grid, res).withColumn("repeated", F.col("pois") - F.col("distinct_ids"))
    return require(f"points of {source}", stats, {"pois": (1, None), "repeated": (0, 0), "outside": (0, 0)})


def feature_stats(features: DataFrame) -> DataFrame:
    per = features.groupBy("h3").agg(
        F.count("*").alias("n"),
        F.sum("population").alias("population"),
        F.sum("n_poi").alias("n_poi"),
        F.count_if("data_gap").alias("gaps"),
    )
    return per.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.count("*").alias("distinct_cells"),
        F.coalesce(F.sum("population"), F.lit(0.0)).alias("population"),
        F.coalesce(F.sum("n_poi"), F.lit(0)).alias("n_poi"),
        F.coalesce(F.sum("gaps"), F.lit(0)).alias("data_gaps"),
    )


def check_features(features: DataFrame, grid: DataFrame, population: DataFrame, n_pois: int) -> dict:
    """Unique cells, one row per grid cell, population (within 1) and POI totals kept."""
    cells, people = grid.count(), population_stats(population).first()["total"]
    stats = feature_stats(features).withColumn("repeated", F.col("rows") - F.col("distinct_cells"))
    limits = {"repeated": (0, 0), "rows": (cells, cells), "population": (people - 1, people + 1), "n_poi": (n_pois, n_pois)}
    return require("features", stats, limits)


def busiest_places(features: DataFrame, n: int = 10) -> DataFrame:
    """The busiest cells with the city they lie in (logged by the pipeline, never fatal)."""
    top = top_cells(features.select("h3", "lat", "lng", "n_poi"), n)
    return top.withColumn("city", F.coalesce(city_of(F.col("lat"), F.col("lng")), F.lit("elsewhere")))
