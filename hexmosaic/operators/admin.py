"""Administrative names of cells."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexmosaic.operators.polyfill import center_cells
from hexmosaic.operators.polygons import dump_parts, ring_edges

# Area subtype of every level and the column it fills.
LEVELS = {"region": "province", "county": "district", "locality": "commune"}


def tag_admin(grid: DataFrame, areas: DataFrame, res: int, levels: dict[str, str] | None = None) -> DataFrame:
    """Grid with the name of the area holding each cell's centre, one column per level.

    The areas are filled with cells by their centres once for all levels, so the spatial test is
    an equi-join on the cell id. Where areas of a level overlap, the smallest name wins.
    """
    levels = LEVELS if levels is None else levels
    area = areas.where(F.col("subtype").isin(list(levels))).select("subtype", "area_name", "geometry")
    parts = dump_parts(area).withColumn("key", F.struct("subtype", "area_name", "part_ix"))
    cells = center_cells(ring_edges(parts, "key"), res, "key")
    names = cells.groupBy("h3").agg(
        *[F.min(F.when(F.col("key.subtype") == s, F.col("key.area_name"))).alias(c) for s, c in levels.items()]
    )
    return grid.join(names, "h3", "left")
