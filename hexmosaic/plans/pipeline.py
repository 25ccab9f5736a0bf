"""The stages end to end: tables in, tables out, checks and a ledger entry after every stage.

Stages exchange Parquet tables, as the checks and later stages read what was written. A stage whose
inputs did not change and whose outputs exist is skipped.
"""

from __future__ import annotations

import json
import logging

from pyspark.sql import DataFrame, Observation, SparkSession

from hexmosaic.config import Params
from hexmosaic.functions import rules
from hexmosaic.operators import catalog, checks, dedupe, features, pois, population
from hexmosaic.operators.polyfill import polyfill_grid
from hexmosaic.operators.polygons import boundary_parts
from hexmosaic.sources import sinks

log = logging.getLogger(__name__)


#: Finest resolution whose bare grid is written as a layer; finer ones are too large for a map.
GRID_LAYER_RES = 8


class Pipeline:
    """Runs the stages into a folder that every executor can reach."""

    def __init__(
        self,
        spark: SparkSession,
        out: str,
        params: Params,
        groups: dict[str, list[str]] | None = None,
        area_range=checks.AREA_RANGE_KM2,
        force: bool = False,
    ):
        self.spark, self.out, self.params, self.force = spark, out.rstrip("/"), params, force
        self.groups = rules.check_groups(rules.DEFAULT_GROUPS if groups is None else groups)
        self.area_range = area_range
        self.ledger = catalog.Ledger(spark, f"{self.out}/ledger")
        self.inputs: dict[str, dict] = {}

    def path(self, name: str) -> str:
        return f"{self.out}/{name}"

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def _stage(self, name: str, inputs: dict, outputs: list[str], run) -> None:
        """Run a stage unless it is fresh; ``run`` returns the row counts to record."""
        self.inputs[name] = inputs
        key = json.dumps(inputs, sort_keys=True, default=str)
        if not self.force and self.ledger.is_fresh(name, key):
            log.info("%s: cached", name)
            return
        self.ledger.invalidate(name)
        rows = run()
        self.ledger.record(name, key, rows, [self.path(o) for o in outputs], self.params)
        log.info("%s: %s", name, rows)

    def boundary(self, areas: DataFrame, version: str, tie_break: tuple[str, ...] = ("id",)) -> None:
        def run() -> dict:
            parts = boundary_parts(areas, self.params.utm_zone, tie_break)
            sinks.write_table(parts, self.path("boundary"), "part_id")
            return checks.check_boundary(self.table("boundary"), self.area_range, areas)

        self._stage("boundary", {"areas": version}, ["boundary"], run)

    def grid(self) -> None:
        p = self.params
        names = [f"grid_res{r}" for r in p.resolutions]

        def run() -> dict:
            parts = self.table("boundary")
            area = checks.boundary_stats(parts).first()["area_km2"]
            rows = {}
            for r in p.resolutions:
                sinks.write_table(polyfill_grid(parts, r, p.containment, p.buffer_m), self.path(f"grid_res{r}"), "h3")
                g = self.table(f"grid_res{r}")
                rows[f"res{r}"] = checks.check_grid(g, r, area, p.containment)["cells"]
                if p.containment == "overlap":
                    checks.check_parts(parts, g, r)
            for coarse, fine in zip(p.resolutions, p.resolutions[1:], strict=False):
                n = checks.orphan_parents(self.table(f"grid_res{fine}"), fine, self.table(f"grid_res{coarse}"), coarse).count()
                if n:
                    log.warning("grid: %d res-%d parents of res-%d cells not in the grid", n, coarse, fine)
            return rows

        inputs = {
            "boundary": self.inputs["boundary"],
            "resolutions": p.resolutions,
            "containment": p.containment,
            "buffer_m": p.buffer_m,
        }
        self._stage("grid", inputs, names, run)

    def population(self, blocks: DataFrame, affine: population.Affine, nodata: float | None, version: str) -> None:
        p = self.params

        def run() -> dict:
            sinks.write_table(population.raster_to_pixels(blocks, affine, nodata), self.path("pixels"))
            total = population.raster_total(blocks, nodata).first()["total"]
            rows = {"source_total": total}
            for r in p.resolutions:
                table = population.population_by_cell(self.table("pixels"), self.table(f"grid_res{r}"), r)
                sinks.write_table(table, self.path(f"population_res{r}"), "h3")
                stats = checks.check_population(self.table(f"population_res{r}"), total)
                rows |= {f"res{r}_populated": stats["populated"], f"res{r}_total": stats["total"]}
            return rows

        outs = ["pixels", *[f"population_res{r}" for r in p.resolutions]]
        self._stage("population", {"raster": version, "grid": self.inputs["grid"]}, outs, run)

    def source(self, name: str, staged: DataFrame, version: str) -> None:
        """Clip, index and check the staged POIs of one source."""
        p, res = self.params, max(self.params.resolutions)

        def run() -> dict:
            seen = Observation()
            out = pois.clip_and_index(staged, self.table(f"grid_res{res}"), self.table("boundary"), p, seen)
            sinks.write_table(out, self.path(f"poi_{name}"), "source_id")
            kept = checks.check_pois(self.table(f"poi_{name}"), self.table(f"grid_res{res}"), res, name)
            return {**kept, "staged": seen.get["rows"]}

        inputs = {
            "source": version,
            "poi_keys": rules.POI_KEYS,
            "excluded": rules.EXCLUDED,
            "min_confidence": p.min_confidence,
            "resolutions": p.index_resolutions,
            "grid": self.inputs["grid"],
        }
        self._stage(f"poi_{name}", inputs, [f"poi_{name}"], run)

    def merge(self) -> None:
        """One POI table from all sources, duplicates across sources collapsed."""

        def run() -> dict:
            union = pois.union_sources([self.table(f"poi_{s}") for s in self.params.use])
            out = dedupe.dedupe_pois(union, list(self.params.use), self.params.poi_index_res)
            sinks.write_table(out, self.path("poi"), "source_id")
            res = max(self.params.resolutions)
            return checks.check_pois(self.table("poi"), self.table(f"grid_res{res}"), res, "all sources")

        self._stage("dedupe", {s: self.inputs[f"poi_{s}"] for s in self.params.use}, ["poi"], run)

    def features(self) -> None:
        p = self.params
        outs = [f"features_res{r}" for r in p.resolutions]

        def run() -> dict:
            rows = {}
            poi = self.table("poi")
            for r in p.resolutions:
                grid, people = self.table(f"grid_res{r}"), self.table(f"population_res{r}")
                f = features.hex_features(grid, people, poi, r, self.groups, p.neighborhood_k, p.coverage_flag_min_pop)
                sinks.write_table(f, self.path(f"features_res{r}"), "h3")
                done = self.table(f"features_res{r}")
                stats = checks.check_features(done, grid, people, poi.count())
                rows |= {f"res{r}_rows": stats["rows"], f"res{r}_data_gap": stats["data_gaps"]}
                cities = [c["city"] for c in checks.busiest_places(done).collect()]
                log.info("features res %d: busiest cells in %s", r, ", ".join(sorted(set(cities))))
                if "elsewhere" in cities:
                    log.warning("features res %d: %d of the busiest cells lie in no known city", r, cities.count("elsewhere"))
            return rows

        inputs = {
            "groups": self.groups,
            "k": p.neighborhood_k,
            "gap": p.coverage_flag_min_pop,
            "population": self.inputs["population"],
            "poi": self.inputs["dedupe"],
        }
        self._stage("features", inputs, outs, run)

    def export(self) -> None:
        """CSV, WKT layers and the files of the comparison page."""
        res = max(self.params.resolutions)
        outs = [f"features_res{r}_csv" for r in self.params.resolutions]
        outs += [f"features_res{r}_layer" for r in self.params.resolutions]
        shown = [r for r in self.params.resolutions if r <= GRID_LAYER_RES]
        outs += [f"grid_res{r}_layer" for r in shown] + [f"population_res{r}_layer" for r in self.params.resolutions]
        outs += ["boundary_layer", "poi_layer", "app_pois", "app_population", "app_meta"]

        def run() -> dict:
            for r in self.params.resolutions:
                f = self.table(f"features_res{r}")
                sinks.write_csv(f, self.path(f"features_res{r}_csv"), "h3_str")
                sinks.write_table(sinks.cell_layer(f, r), self.path(f"features_res{r}_layer"), "h3_str")
                people = sinks.population_layer(self.table(f"population_res{r}"), r)
                sinks.write_table(people, self.path(f"population_res{r}_layer"), "h3_str")
            for r in shown:
                sinks.write_table(sinks.cell_layer(self.table(f"grid_res{r}"), r), self.path(f"grid_res{r}_layer"), "h3_str")
            poi = self.table("poi")
            sinks.write_table(sinks.part_layer(self.table("boundary")), self.path("boundary_layer"), "part_id")
            sinks.write_table(sinks.point_layer(poi), self.path("poi_layer"), "source_id")
            sinks.write_json_lines(sinks.app_pois(poi, self.groups), self.path("app_pois"), "id")
            people = sinks.app_population(self.table(f"population_res{res}"))
            sinks.write_json_lines(people, self.path("app_population"), "h3_str")
            meta = sinks.app_meta(self.table(f"features_res{res}"), res, self.params.reference_date.isoformat(), list(self.params.use), self.groups)
            sinks.write_json_lines(meta, self.path("app_meta"))
            return {}

        self._stage("export", {"features": self.inputs["features"]}, outs, run)


def run_all(
    pipeline: Pipeline,
    areas: DataFrame,
    blocks: DataFrame,
    affine: population.Affine,
    nodata: float | None,
    staged: dict[str, DataFrame],
    version: str,
    tie_break: tuple[str, ...] = ("id",),
) -> DataFrame:
    """All stages; ``staged`` holds the staged POIs of every enabled source."""
    pipeline.boundary(areas, version, tie_break)
    pipeline.grid()
    pipeline.population(blocks, affine, nodata, version)
    for name in pipeline.params.use:
        pipeline.source(name, staged[name], version)
    pipeline.merge()
    pipeline.features()
    pipeline.export()
    return pipeline.table(f"features_res{max(pipeline.params.resolutions)}")
