"""Raster blocks -> pixels -> population per cell."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexmosaic.functions import hexgrid as hx


@dataclass(frozen=True)
class Affine:
    """Raster transform x = c + a col + b row, y = f + d col + e row, in degrees."""

    a: float
    b: float
    c: float
    d: float
    e: float
    f: float

    def __post_init__(self):
        if self.b != 0 or self.d != 0:
            raise ValueError("rotated rasters are not supported")


def raster_cells(blocks: DataFrame, nodata: float | None = None) -> DataFrame:
    """Blocks (row0, col0, values) -> (row, col, value DOUBLE) of all unmasked cells."""
    lines = blocks.select("row0", "col0", F.posexplode("values").alias("i", "line"))
    cells = lines.select((F.col("row0") + F.col("i")).alias("row"), "col0", F.posexplode("line").alias("j", "v"))
    keep = F.col("v").isNotNull() & ~F.isnan("v")
    if nodata is not None:
        keep = keep & (F.col("v") != F.lit(nodata).cast("float"))
    return cells.where(keep).select(
        "row", (F.col("col0") + F.col("j")).alias("col"), F.col("v").cast("double").alias("value")
    )


def raster_to_pixels(blocks: DataFrame, affine: Affine, nodata: float | None = None) -> DataFrame:
    """(lat, lng, pop) at the centre of every populated pixel."""
    px = raster_cells(blocks, nodata).where(F.col("value") > 0)
    return px.select(
        (F.lit(affine.f) + (F.col("row") + F.lit(0.5)) * F.lit(affine.e)).alias("lat"),
        (F.lit(affine.c) + (F.col("col") + F.lit(0.5)) * F.lit(affine.a)).alias("lng"),
        F.col("value").alias("pop"),
    )


def raster_total(blocks: DataFrame, nodata: float | None = None) -> DataFrame:
    """One row with the sum over all unmasked cells."""
    return raster_cells(blocks, nodata).agg(F.coalesce(F.sum("value"), F.lit(0.0)).alias("total"))


def raster_window(blocks: DataFrame, affine: Affine, bbox: dict, block: tuple[int, int], nodata: float | None = None) -> DataFrame:
    """Cells of the rows and columns a bbox spans (edges truncated to whole cells).

    ``block`` is the largest height and width of a block. Blocks that lie outside are ruled out by
    their corner, a filter that reaches the scan, before any block is taken apart.
    """
    c0, c1 = int((bbox["xmin"] - affine.c) / affine.a), int((bbox["xmax"] - affine.c) / affine.a)
    r0, r1 = int((bbox["ymax"] - affine.f) / affine.e), int((bbox["ymin"] - affine.f) / affine.e)
    row0, col0 = F.col("row0"), F.col("col0")
    near = blocks.where((row0 > r0 - block[0]) & (row0 < r1) & (col0 > c0 - block[1]) & (col0 < c1))
    return raster_cells(near, nodata).where(
        (F.col("row") >= r0) & (F.col("row") < r1) & (F.col("col") >= c0) & (F.col("col") < c1)
    )


def raster_block_sum(cells: DataFrame, factor: int, height: int, width: int) -> DataFrame:
    """Sums of factor x factor blocks; the ragged edge of the raster is left out."""
    h, w = height // factor * factor, width // factor * factor
    inner = cells.where((F.col("row") < h) & (F.col("col") < w))
    by = [
        F.floor(F.col("row") / factor).cast("int").alias("block_row"),
        F.floor(F.col("col") / factor).cast("int").alias("block_col"),
    ]
    return inner.groupBy(*by).agg(F.sum("value").alias("value"), F.count("*").cast("int").alias("n_cells"))


def pixels_by_cell(pixels: DataFrame, res: int) -> DataFrame:
    """(h3, population, n_pixels): whole pixels summed by the cell of their centre.

    The sums are combined map-side, so a dense cell costs one row per task in the shuffle.
    """
    h = hx.cell(F.col("lat"), F.col("lng"), res).alias("h3")
    return (
        pixels.select(h, "pop")
        .groupBy("h3")
        .agg(F.sum("pop").alias("population"), F.count("*").alias("n_pixels"))
    )


def population_by_cell(pixels: DataFrame, grid: DataFrame, res: int) -> DataFrame:
    """Every grid cell with its population, 0 where no pixel has people."""
    return (
        grid.select("h3", "h3_str")
        .join(pixels_by_cell(pixels, res), "h3", "left")
        .select(
            "h3",
            "h3_str",
            F.coalesce("population", F.lit(0.0)).alias("population"),
            F.coalesce("n_pixels", F.lit(0)).cast("int").alias("n_pixels"),
        )
    )
