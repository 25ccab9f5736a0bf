"""Points of interest: staging of the sources, clip, index, union."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from hexmosaic.config import Params
from hexmosaic.functions import hexgrid as hx
from hexmosaic.functions import rules
from hexmosaic.operators.clip import clip_points
from hexmosaic.session import bind, dealt

#: Nodes that a task joins with their references, about.
NODES_AT_ONCE = 250_000
JSON = {"ignoreNullFields": "false"}
COMMON = [
    "source",
    "source_id",
    "name",
    "name_en",
    "category",
    "category_hierarchy",
    "confidence",
    "lat",
    "lng",
    "attrs",
]


def tagged_elements(elements: DataFrame) -> DataFrame:
    """Nodes and ways whose tags make them a place; adds ``category``.

    The category is the first key present in priority order, and exclusion is applied after that:
    an excluded first key drops the element even when a later key would qualify.
    """
    has_tags = F.col("kind").isin("node", "way") & (F.size("tags") > 0)
    out = bind(elements.where(has_tags), elements.columns, category=rules.category_of(F.col("tags")))
    return out.where(rules.is_place(F.col("category")))


def way_positions(ways: DataFrame, nodes: DataFrame) -> DataFrame:
    """(id, lat, lon): mean position of a way's resolvable node references.

    A reference that occurs twice (the closing node) counts twice. The means are combined on the
    map side after the join, so a way with very many nodes does not load one task. The join sorts
    and the means keep an entry per way, so there are as many partitions as nodes ask for.
    """
    refs = ways.select("id", F.explode("refs").alias("ref"))
    n = nodes.where(F.col("kind") == "node").select(F.col("id").alias("ref"), "lat", "lon")
    refs, n = dealt(["ref"], n, NODES_AT_ONCE, refs, n)
    return refs.join(n, "ref").groupBy("id").agg(F.avg("lat").alias("lat"), F.avg("lon").alias("lon"))


def stage_elements(elements: DataFrame) -> DataFrame:
    """Map elements (kind, id, tags, refs, lat, lon) -> common POI schema.

    Nodes never meet the join: only ways are joined with the positions of their nodes.
    """
    poi = tagged_elements(elements)
    way = poi.where(F.col("kind") == "way")
    pos = way_positions(way, elements)
    own = poi.select("kind", "id", "tags", "category", "lat", "lon")
    nodes = own.where(F.col("kind") == "node")
    w = own.where(F.col("kind") == "way").withColumnsRenamed({"lat": "lat0", "lon": "lon0"})
    placed = w.join(pos, "id", "left").select(
        "kind",
        "id",
        "tags",
        "category",
        F.coalesce("lat0", "lat").alias("lat"),
        F.coalesce("lon0", "lon").alias("lon"),
    )
    return _element_schema(nodes.unionByName(placed).where(F.col("lat").isNotNull()))


def _element_schema(df: DataFrame) -> DataFrame:
    return df.select(
        F.lit("osm").alias("source"),
        F.concat("kind", F.lit("/"), F.col("id").cast("string")).alias("source_id"),
        F.col("tags")["name"].alias("name"),
        F.col("tags")["name:en"].alias("name_en"),
        "category",
        F.array(F.split_part("category", F.lit("="), F.lit(1)), "category").alias("category_hierarchy"),
        F.lit(None).cast("double").alias("confidence"),
        "lat",
        F.col("lon").alias("lng"),
        F.to_json("tags").alias("attrs"),
    )


def _datasets(sources: Column) -> Column:
    names = F.transform(sources, lambda s: s["dataset"])
    return F.sort_array(F.array_distinct(F.array_compact(names)))


def stage_places(places: DataFrame, min_confidence: float = 0.6, source: str = "overture") -> DataFrame:
    """Place records -> common POI schema: confident, not closed, with a taxonomy.

    Any further provider whose records have the same shape uses the same adapter under its own
    ``source`` name.
    """
    keep = (
        (F.col("confidence") >= min_confidence)
        & (F.coalesce("operating_status", F.lit("open")) == "open")
        & F.col("taxonomy.primary").isNotNull()
    )
    attrs = F.struct(
        F.col("basic_category").alias("basic_category"),
        F.col("brand.names.primary").alias("brand"),
        _datasets(F.col("sources")).alias("datasets"),
    )
    return places.where(keep).select(
        F.lit(source).alias("source"),
        F.col("id").alias("source_id"),
        F.col("names.primary").alias("name"),
        F.col("names.common")["en"].alias("name_en"),
        F.col("taxonomy.primary").alias("category"),
        F.col("taxonomy.hierarchy").alias("category_hierarchy"),
        "confidence",
        "lat",
        "lng",
        F.to_json(attrs, JSON).alias("attrs"),
    )


def index_points(pois: DataFrame, resolutions: list[int]) -> DataFrame:
    """Adds h3_res{r} for every resolution."""
    cells = [hx.cell(F.col("lat"), F.col("lng"), r).alias(f"h3_res{r}") for r in resolutions]
    return pois.select("*", *cells)


def clip_and_index(staged: DataFrame, grid: DataFrame, parts: DataFrame, params: Params, seen: Observation | None = None) -> DataFrame:
    """Staged POIs inside the polygons and the finest grid, with their cells.

    ``grid`` is the grid of the finest resolution; ``seen`` counts the staged rows. The exact clip runs
    first because it drops the most rows.
    """
    res = max(params.resolutions)
    inside = clip_points(staged, parts, res, seen)
    indexed = index_points(inside, params.index_resolutions)
    kept = indexed.join(grid.select(F.col("h3").alias(f"h3_res{res}")), f"h3_res{res}", "left_semi")
    cells = [f"h3_res{r}" for r in params.index_resolutions]
    return kept.select(*[c for c in COMMON if c != "attrs"], *cells, "attrs")


def union_sources(tables: list[DataFrame]) -> DataFrame:
    """All rows of all sources (UNION ALL by column name)."""
    return reduce(lambda a, b: a.unionByName(b), tables)
