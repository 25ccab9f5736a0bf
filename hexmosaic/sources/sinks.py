"""Sinks: ordered Parquet, CSV, map layers, JSON for map apps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexmosaic.functions import geo, rules
from hexmosaic.functions import hexgrid as hx


def ordered(df: DataFrame, *keys) -> DataFrame:
    """Globally ordered rows over many tasks: range partitions, each sorted."""
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)


def write_table(df: DataFrame, path: str, *keys: str, mode: str = "overwrite") -> None:
    """Parquet, zstd, ordered by ``keys``."""
    out = ordered(df, *keys) if keys else df
    out.write.mode(mode).option("compression", "zstd").parquet(path)


def write_csv(df: DataFrame, path: str, *keys, mode: str = "overwrite") -> None:
    """CSV with header, without the numeric cell id, ordered by ``keys``."""
    out = ordered(df, *keys) if keys else df
    out.drop("h3").write.mode(mode).option("header", True).csv(path)


def cell_layer(df: DataFrame, res: int, form: str = "wkt", digits: int = 9) -> DataFrame:
    """Rows with the hexagon of their cell instead of the numeric id."""
    polygon = F.array(hx.cell_boundary(F.col("h3"), res))
    if form == "wkt":
        return df.withColumn("geometry", geo.polygon_wkt(polygon, digits)).drop("h3")
    return _features(df.drop("h3").columns, df, geo.polygon_geojson(polygon))


def population_layer(population: DataFrame, res: int, digits: int = 9) -> DataFrame:
    """Cells with people, and their hexagons."""
    return cell_layer(population.where(F.col("population") > 0), res, digits=digits)


def point_layer(pois: DataFrame, form: str = "wkt") -> DataFrame:
    """POI points with the columns a map needs."""
    cols = ["source_id", "name", "name_en", "category", "confidence"]
    if form == "wkt":
        return pois.select(*cols, geo.point_wkt(F.col("lng"), F.col("lat")).alias("geometry"))
    return _features(cols, pois, geo.point_geojson(F.col("lng"), F.col("lat")))


def part_layer(parts: DataFrame, form: str = "wkt") -> DataFrame:
    """Boundary parts."""
    if form == "wkt":
        return parts.select("part_id", "area_km2", geo.polygon_wkt(F.col("polygon")).alias("geometry"))
    return _features(["part_id", "area_km2"], parts, geo.polygon_geojson(F.col("polygon")))


def _features(cols: list[str], df: DataFrame, geometry: Column) -> DataFrame:
    return df.select(geo.feature_json(geometry, F.struct(*cols)).alias("value"))


def in_bbox(df: DataFrame, bbox: dict) -> DataFrame:
    """Rows whose lat/lng lie in a bbox, for a sample of one city."""
    return df.where(
        F.col("lng").between(bbox["xmin"], bbox["xmax"]) & F.col("lat").between(bbox["ymin"], bbox["ymax"])
    )


def layer_extent(df: DataFrame) -> DataFrame:
    """One row with the bbox of a layer."""
    return df.agg(
        F.min("lng").alias("xmin"), F.max("lng").alias("xmax"), F.min("lat").alias("ymin"), F.max("lat").alias("ymax")
    )


def app_pois(pois: DataFrame, groups: dict[str, list[str]] | None = None) -> DataFrame:
    """POI rows for the comparison page: lat, lng, name, category, group, id, source."""
    return pois.select(
        F.round("lat", 6).alias("lat"),
        F.round("lng", 6).alias("lng"),
        F.coalesce("name", "name_en", F.lit("")).alias("name"),
        "category",
        rules.group_or_other(F.col("category"), rules.DEFAULT_GROUPS if groups is None else groups).alias("group"),
        F.col("source_id").alias("id"),
        "source",
    )


def app_population(population: DataFrame) -> DataFrame:
    """(h3_str, population) of cells with at least one person, rounded to whole people."""
    return population.where(F.col("population") >= 1).select("h3_str", F.round("population").cast("int").alias("population"))


def app_meta(features: DataFrame, res: int, reference_date: str, sources: list[str], groups: dict[str, list[str]]) -> DataFrame:
    """One row that tells the comparison page what it shows: res, reference date, sources, groups, the
    feature table's numeric fields and its number of cells."""
    numeric = [f.name for f in features.schema if f.dataType.typeName() in ("integer", "long", "double") and f.name != "h3"]
    text = lambda xs: F.array(*map(F.lit, xs)) if xs else F.array().cast("array<string>")
    return features.agg(F.count("*").alias("cells")).select(
        F.lit(res).alias("res"),
        F.lit(reference_date).alias("reference_date"),
        text(list(sources)).alias("sources"),
        text([*groups, rules.OTHER]).alias("groups"),
        text(numeric).alias("fields"),
        "cells",
    )


def write_json_lines(df: DataFrame, path: str, *keys: str) -> None:
    """JSON, one object per row (text rows are written as they are)."""
    out = ordered(df, *keys) if keys else df
    if out.columns == ["value"]:
        out.write.mode("overwrite").text(path)
    else:
        out.write.mode("overwrite").option("ignoreNullFields", False).json(path)
