"""Polygons without a geometry type: parts, edge tables, areas and exact point-in-polygon.

Working form of a polygon set is the edge table ``(part_id, ring_id, edge_ix, is_hole, x1, y1, x2,
y2)`` in degrees, one row per non-degenerate edge, rings closed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hexmosaic.functions import geo
from hexmosaic.session import bind, cut_lineage, spread, unsent

BAND_DEG = 0.01
#: Columns of its level that a part spans at most, but for one more at its border.
COLUMNS = 8


def dump_parts(areas: DataFrame, geometry: str = "geometry") -> DataFrame:
    """One row per polygon of a multipolygon column; adds ``part_ix`` and ``polygon``."""
    others = [c for c in areas.columns if c != geometry]
    return areas.select(*others, F.posexplode(geometry).alias("part_ix", "polygon"))


def ring_edges(parts: DataFrame, key: str = "part_id", polygon: str = "polygon") -> DataFrame:
    """Edge table of a part table."""
    rings = parts.select(key, F.posexplode(polygon).alias("ring_id", "ring"))
    last = F.size("ring") - 1
    pairs = F.transform(
        F.col("ring"),
        lambda p, i: F.struct(p.alias("a"), F.get(F.col("ring"), F.when(i == last, 0).otherwise(i + 1)).alias("b")),
    )
    e = rings.where(F.size("ring") > 0).select(key, "ring_id", F.posexplode(pairs).alias("edge_ix", "e"))
    return e.select(
        key,
        "ring_id",
        "edge_ix",
        (F.col("ring_id") > 0).alias("is_hole"),
        F.col("e.a.x").alias("x1"),
        F.col("e.a.y").alias("y1"),
        F.col("e.b.x").alias("x2"),
        F.col("e.b.y").alias("y2"),
    ).where((F.col("x1") != F.col("x2")) | (F.col("y1") != F.col("y2")))


def _ring_area(polygon: Column, mapped) -> Column:
    """Exterior minus holes by the shoelace formula over mapped rings, row-local."""

    def area(pts: Column) -> Column:
        shifted = F.concat(F.slice(pts, 2, F.greatest(F.size(pts) - 1, F.lit(0))), F.slice(pts, 1, 1))
        cross = F.zip_with(pts, shifted, lambda a, b: a["x"] * b["y"] - b["x"] * a["y"])
        return F.abs(F.aggregate(cross, F.lit(0.0), lambda s, v: s + v)) / 2

    # as variables of a lambda, mapped rings and areas are evaluated once
    areas = F.transform(F.transform(polygon, mapped), area)
    signed = F.transform(areas, lambda a, i: F.when(i == 0, a).otherwise(-a))
    return F.aggregate(signed, F.lit(0.0), lambda s, v: s + v)


def area_deg2(polygon: Column) -> Column:
    """Planar area in square degrees (coordinates relative to the ring's first vertex)."""
    return _ring_area(
        polygon,
        lambda r: F.transform(r, lambda p: F.struct((p["x"] - r[0]["x"]).alias("x"), (p["y"] - r[0]["y"]).alias("y"))),
    )


def area_km2(polygon: Column, utm_zone: int) -> Column:
    """Area in the UTM plane, km2."""
    return _ring_area(polygon, lambda r: geo.utm_ring(r, utm_zone)) / F.lit(1e6)


def utm_areas(edges: DataFrame, utm_zone: int, key: str = "part_id") -> DataFrame:
    """(key, area_km2) in the UTM plane from the edge table.

    Vertices are projected in generated code and sums combine map-side, so a polygon of any number of
    vertices is spread over tasks; ``area_km2`` does the same for one small polygon inside a row.
    """
    e1, n1 = geo.utm_forward(F.col("y1"), F.col("x1"), utm_zone)
    e2, n2 = geo.utm_forward(F.col("y2"), F.col("x2"), utm_zone)
    ends = bind(edges, [key, "ring_id", "is_hole"], e1=e1, n1=n1, e2=e2, n2=n2)
    cross = F.sum(F.col("e1") * F.col("n2") - F.col("e2") * F.col("n1"))
    rings = ends.groupBy(key, "ring_id", "is_hole").agg((F.abs(cross) / 2e6).alias("a"))
    return rings.groupBy(key).agg(F.sum(F.when(F.col("is_hole"), -F.col("a")).otherwise(F.col("a"))).alias("area_km2"))


def crosses_ray(lat: Column, lng: Column, e: str = "") -> Column:
    """True when the edge crosses the eastward ray from the point (half-open in latitude)."""
    x1, y1, x2, y2 = (F.col(e + c) for c in ("x1", "y1", "x2", "y2"))
    side = (x2 - x1) * (lat - y1) - (lng - x1) * (y2 - y1)
    straddles = (y1 > lat) != (y2 > lat)
    return straddles & F.when(y2 > y1, side > 0).otherwise(side < 0)


def on_edge(lat: Column, lng: Column, e: str = "") -> Column:
    """True when the point lies exactly on the edge."""
    x1, y1, x2, y2 = (F.col(e + c) for c in ("x1", "y1", "x2", "y2"))
    side = (x2 - x1) * (lat - y1) - (lng - x1) * (y2 - y1)
    return (
        (side == 0)
        & lng.between(F.least(x1, x2), F.greatest(x1, x2))
        & lat.between(F.least(y1, y2), F.greatest(y1, y2))
    )


def band(lat: Column) -> Column:
    return F.floor(lat / F.lit(BAND_DEG))


def points_in_parts(
    points: DataFrame, edges: DataFrame, key: str, part: str = "part_id", own_part: bool = False
) -> DataFrame:
    """Exact point-in-polygon by ray parity: distinct ``(key, part)`` pairs, boundary included.

    Equi-join on the latitude band and a column, so each point meets only the edges of its band that
    belong to parts around its column and do not lie west of that. A level of columns holds parts of
    about one width, which span COLUMNS of them at most; a part whose extent leaves a point out has
    an even number of crossings. With ``own_part`` the points name the one part they are tested
    against. The parity aggregate has a map-side combine that folds a point's edges before the
    shuffle. Large point sets go through ``clip.clip_points``, which tests only the few edges of a
    point's own cell.
    """
    lat, lng = F.col("lat"), F.col("lng")
    return (
        edges_met(points, edges, key, part, own_part)
        .groupBy(key, "lat", "lng", part)
        .agg(
            F.sum(crosses_ray(lat, lng).cast("int")).alias("n"),
            F.max(on_edge(lat, lng)).alias("edge"),
        )
        .where((F.col("n") % 2 == 1) | F.col("edge"))
        .select(key, part)
        .distinct()
    )


def edges_met(points: DataFrame, edges: DataFrame, key: str, part: str, own_part: bool = False) -> DataFrame:
    """Points with the edges of their band that reach their latitude, not west of them, of parts around their column."""
    lo, hi = F.least("y1", "y2"), F.greatest("y1", "y2")
    extents = edges.groupBy(part).agg(F.min(F.least("x1", "x2")).alias("west"), F.max(F.greatest("x1", "x2")).alias("east"))
    level = F.greatest(F.ceil(F.log2((F.col("east") - F.col("west")) / F.lit(BAND_DEG * COLUMNS))), F.lit(0)).cast("int")
    extents = extents.select(F.col(part).alias("_part"), "west", F.coalesce(level, F.lit(0)).alias("level"))
    column = lambda x: F.floor(x / (F.lit(BAND_DEG) * F.pow(F.lit(2.0), F.col("level"))))
    e = edges.select(part, "x1", "y1", "x2", "y2").join(unsent(extents), F.col(part).eqNullSafe(F.col("_part")))
    e = e.select(part, "x1", "y1", "x2", "y2", "level", F.explode(F.sequence(column(F.col("west")), column(F.greatest("x1", "x2")))).alias("column"))
    e = e.select("*", F.explode(F.sequence(band(lo), band(hi))).alias("band"))
    on = ["band", "column", "level", part] if own_part else ["band", "column", "level"]
    # a level for each power of two of widths, so never more than a few rows
    levels = F.broadcast(extents.select("level").distinct())
    p = points.select(key, "lat", "lng", band(F.col("lat")).alias("band"), *on[3:]).crossJoin(levels)
    p = p.withColumn("column", column(F.col("lng")))
    lat, lng = F.col("lat"), F.col("lng")
    east = lng <= F.greatest("x1", "x2")
    return p.join(unsent(e), on).where(east & lat.between(lo, hi))


def surface_points(edges: DataFrame, part: str = "part_id") -> DataFrame:
    """(part, lat, lng) of a point inside every polygon: the middle of the widest interval that
    the polygon cuts from its middle parallel."""
    mid = edges.groupBy(part).agg(((F.min("y1") + F.max("y1")) / 2).alias("lat"))
    cut = edges.join(mid, part).where((F.col("y1") > F.col("lat")) != (F.col("y2") > F.col("lat")))
    x = F.col("x1") + (F.col("lat") - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))
    w = Window.partitionBy(part).orderBy("x")
    spans = cut.select(part, "lat", x.alias("x")).select(
        part, "lat", "x", F.row_number().over(w).alias("k"), F.lead("x").over(w).alias("x2")
    )
    spans = spans.where((F.col("k") % 2 == 1) & F.col("x2").isNotNull())
    best = spans.groupBy(part).agg(F.max(F.struct((F.col("x2") - F.col("x")).alias("w"), "x", "x2", "lat")).alias("m"))
    return best.select(part, F.col("m.lat").alias("lat"), ((F.col("m.x") + F.col("m.x2")) / 2).alias("lng"))


def filter_areas(areas: DataFrame, bbox: dict, country: str | None = None) -> DataFrame:
    """Rows whose bbox strictly overlaps ``bbox``, optionally of one country.

    Both conditions reach the Parquet scan; touching boxes are left out.
    """
    out = areas.where(
        (F.col("bbox.xmin") < bbox["xmax"])
        & (F.col("bbox.xmax") > bbox["xmin"])
        & (F.col("bbox.ymin") < bbox["ymax"])
        & (F.col("bbox.ymax") > bbox["ymin"])
    )
    return out.where(F.col("country") == country) if country else out


def boundary_parts(areas: DataFrame, utm_zone: int = 48, tie_break: tuple[str, ...] = ("id",)) -> DataFrame:
    """Country land areas -> ``(part_id, area_km2, polygon)``, largest first.

    ``part_id`` follows the area in square degrees, ``area_km2`` is measured in UTM. Areas equal
    to 12 digits are ties, broken by the ``tie_break`` columns and the place in the multipolygon.
    Parts are dealt out before they are measured, and projected once, after they are numbered: a
    range partitioning evaluates the rows below it twice.
    """
    land = areas.where((F.col("subtype") == "country") & (F.col("class") == "land"))
    parts = spread(dump_parts(land.select(*tie_break, "geometry")))
    parts = parts.select(*tie_break, "part_ix", "polygon", F.round(area_deg2(F.col("polygon")), 12).alias("deg2"))
    order = [F.desc("deg2"), *[F.asc(c) for c in tie_break], F.asc("part_ix")]
    return number_rows(parts, order, "part_id").select(
        F.col("part_id").cast("int").alias("part_id"), area_km2(F.col("polygon"), utm_zone).alias("area_km2"), "polygon"
    )


def number_rows(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Global 1-based row number in ``order`` without passing all rows through one task.

    The rows are range-partitioned and written once with their partition number; a row's number
    is its rank inside its range plus the sizes of the ranges before it. Only one row per range
    meets in a single task.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut_lineage(
        df.repartitionByRange(n, *order).withColumn("_range", F.spark_partition_id())
    )
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranged.groupBy("_range")
        .agg(F.count("*").alias("_n"))
        .select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    local = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return (
        ranged.withColumn("_local", local)
        .join(starts, "_range")
        .withColumn(name, F.col("_start") + F.col("_local"))
        .drop("_range", "_local", "_start")
    )
