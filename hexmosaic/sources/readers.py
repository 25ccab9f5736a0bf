"""Scans: Parquet tables with pruned columns, ground-truth files, listings, table checksums."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexmosaic.functions import geo
from hexmosaic.operators.polygons import filter_areas

# Columns the pipeline takes from the division and place tables.
AREA_COLUMNS = [
    "id",
    "division_id",
    "subtype",
    "admin_level",
    "class",
    "country",
    "region",
    "names",
    "is_land",
    "is_territorial",
    "sources",
    "geometry",
]
PLACE_COLUMNS = [
    "id",
    "names",
    "confidence",
    "operating_status",
    "basic_category",
    "taxonomy",
    "brand",
    "addresses",
    "sources",
]

ELEMENTS = "kind string, id bigint, tags map<string,string>, refs array<bigint>, lat double, lon double"
RASTER_BLOCKS = "row0 int, col0 int, values array<array<float>>"

# Column names looked for in ground-truth files, most specific first.
TRUTH_NAMES = {
    "lat": ["lat", "latitude", "y"],
    "lng": ["lng", "lon", "long", "longitude", "x"],
    "name": ["name", "title", "label", "name_en"],
    "category": ["category", "type", "class", "amenity", "kind"],
}


def read_areas(spark: SparkSession, path: str, bbox: dict, country: str | None = None) -> DataFrame:
    """Division areas of a country in a bbox; partition columns in the path are discovered."""
    df = spark.read.parquet(path)
    return filter_areas(df, bbox, country).select(*[c for c in AREA_COLUMNS if c in df.columns])


def read_places(spark: SparkSession, path: str, bbox: dict) -> DataFrame:
    """Place records in a bbox."""
    df = spark.read.parquet(path)
    keep = [c for c in [*PLACE_COLUMNS, "lat", "lng", "geometry"] if c in df.columns]
    return filter_areas(df, bbox).select(*keep)


def read_elements(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Map elements with their fixed schema."""
    return spark.read.schema(ELEMENTS).format(fmt).load(path)


def read_raster_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Raster blocks (row0, col0, values) with their fixed schema."""
    return spark.read.schema(RASTER_BLOCKS).parquet(path)


def detect_columns(columns: list[str]) -> dict[str, str]:
    """Roles (lat, lng, name, category) of a ground-truth file's columns, by name."""
    lower = {c.strip().lower(): c for c in columns}
    found = {}
    for role, names in TRUTH_NAMES.items():
        hit = next((lower[n] for n in names if n in lower), None)
        hit = hit or next((c for low, c in lower.items() if any(low.startswith(n) for n in names if len(n) > 2)), None)
        if hit:
            found[role] = hit
    return found


def _truth(df: DataFrame, columns: dict[str, str] | None) -> DataFrame:
    roles = columns or detect_columns(df.columns)
    if "lat" not in roles or "lng" not in roles:
        raise ValueError(f"no latitude/longitude columns in {df.columns}")
    text = lambda r: F.col(f"`{roles[r]}`").cast("string") if r in roles else F.lit(None).cast("string")
    return df.select(
        F.expr(f"try_cast(`{roles['lat']}` as double)").alias("lat"),
        F.expr(f"try_cast(`{roles['lng']}` as double)").alias("lng"),
        text("name").alias("name"),
        text("category").alias("category"),
    ).where(F.col("lat").isNotNull() & F.col("lng").isNotNull())


def read_truth_csv(spark: SparkSession, path: str, columns: dict[str, str] | None = None) -> DataFrame:
    """Ground-truth points (lat, lng, name, category) of a CSV with header."""
    return _truth(spark.read.option("header", True).csv(path), columns)


def read_truth_geojson(spark: SparkSession, path: str, columns: dict[str, str] | None = None) -> DataFrame:
    """Ground-truth points of a GeoJSON feature collection (point features)."""
    schema = (
        "features array<struct<geometry:struct<type:string,coordinates:string>,properties:map<string,string>>>"
    )
    raw = spark.read.option("multiLine", True).schema(schema).json(path)
    f = raw.select(F.explode("features").alias("f")).where(F.col("f.geometry.type") == "Point")
    xy = F.from_json(F.col("f.geometry.coordinates"), "array<double>")
    props = F.col("f.properties")
    roles = columns or {}
    names = {r: [roles[r]] if r in roles else TRUTH_NAMES[r] for r in ("name", "category")}
    return f.select(
        F.get(xy, F.lit(1)).alias("lat"),
        F.get(xy, F.lit(0)).alias("lng"),
        F.coalesce(*[props[n] for n in names["name"]]).alias("name"),
        F.coalesce(*[props[n] for n in names["category"]]).alias("category"),
    ).where(F.col("lat").isNotNull() & F.col("lng").isNotNull())


def with_geometry(df: DataFrame, column: str, form: str = "wkt") -> DataFrame:
    """Replace a text column (WKT or GeoJSON) by the multipolygon form."""
    parse = {"wkt": geo.multipolygon_from_wkt, "geojson": geo.multipolygon_from_geojson}[form]
    return df.withColumn(column, parse(F.col(column)))


def table_checksum(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, rows, checksum) per text column: the sum of 32-bit prefixes of the values' SHA-256.

    The sum does not depend on the order of rows or on the files that hold them; NULL adds nothing.
    """
    part = lambda c: F.conv(F.substring(F.sha2(F.col(c), 256), 1, 8), 16, 10).cast("long")
    sums = df.agg(F.count("*").alias("rows"), *[F.coalesce(F.sum(part(c)), F.lit(0)).alias(c) for c in columns])
    return sums.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col("rows"), F.col(c).alias("checksum")) for c in columns])))
