"""The feature table: one row per grid cell, and the questions asked of it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hexmosaic.functions import hexgrid as hx
from hexmosaic.functions import rules
from hexmosaic.session import cut_lineage

# Upper bounds and labels of the manual classes of n_poi.
MANUAL_CLASSES = [(1, "1"), (4, "2–4"), (9, "5–9"), (24, "10–24"), (99, "25–99"), (None, "100+")]

# Rectangles (xmin, xmax, ymin, ymax) in which the busiest cells are expected.
CITIES = {
    "Phnom Penh": (104.75, 105.05, 11.45, 11.70),
    "Siem Reap": (103.75, 103.95, 13.30, 13.45),
    "Sihanoukville": (103.45, 103.60, 10.58, 10.70),
    "Battambang": (103.15, 103.25, 13.05, 13.15),
    "Kampot": (104.14, 104.22, 10.57, 10.65),
}


def group_names(groups: dict[str, list[str]]) -> list[str]:
    return [*groups, rules.OTHER]


def category_counts(pois: DataFrame, cell_col: str) -> DataFrame:
    """(h3, category, c): the one pass over the POIs; combined map-side."""
    return (
        pois.select(F.col(cell_col).alias("h3"), "category")
        .groupBy("h3", "category")
        .agg(F.count("*").alias("c"))
    )


def poi_counts(pois: DataFrame, cell_col: str, groups: dict[str, list[str]]) -> DataFrame:
    """(h3, n_poi, n_{group}..., poi_category_entropy).

    Counts and entropy come from the same (cell, category) table. Entropy in bits over the raw
    categories uses log2(n) - sum(c log2 c) / n, which needs no window: 0 for one category.
    """
    cats = category_counts(pois, cell_col).withColumn("grp", rules.group_or_other(F.col("category"), groups))
    c = F.col("c").cast("double")
    counts = [
        F.sum(F.when(F.col("grp") == g, F.col("c")).otherwise(0)).cast("int").alias(f"n_{g}")
        for g in group_names(groups)
    ]
    agg = cats.groupBy("h3").agg(
        F.sum("c").cast("int").alias("n_poi"),
        *counts,
        F.sum(c * F.log2(c)).alias("_clogc"),
    )
    bits = F.greatest(F.log2("n_poi") - F.col("_clogc") / F.col("n_poi"), F.lit(0.0)) + F.lit(0.0)
    return agg.withColumn("poi_category_entropy", bits).drop("_clogc")


def neighbour_sums(base: DataFrame, sums: list[str], ks: list[int]) -> DataFrame:
    """(h3, {col}_k{k}...) of every cell some non-empty cell reaches.

    Non-empty cells scatter their values to the cells around them, each with its ring number, and
    one aggregate serves every k. Disks are symmetric, so this equals gathering, and cells whose
    columns are all 0 or NULL add nothing. Sums keep the type of their column. Cells outside the
    grid are reached too; the caller's join leaves them out.
    """
    filled = reduce(lambda x, y: x | y, [F.coalesce(F.col(c), F.lit(0)) != 0 for c in sums])
    spread = base.where(filled).select(*sums, F.explode(hx.grid_disk_rings(F.col("h3"), max(ks))).alias("t"))
    spread = spread.select(F.col("t.cell").alias("h3"), F.col("t.ring").alias("ring"), *sums)
    aggs = []
    for k in ks:
        for c in sums:
            s = F.sum(F.when(F.col("ring") <= k, F.col(c)))
            aggs.append(s.cast(base.schema[c].dataType).alias(f"{c}_k{k}"))
    return spread.groupBy("h3").agg(*aggs)


def row_ends(base: DataFrame, sums: list[str], k: int) -> DataFrame:
    """(h3, {col}...): where the reach of a non-empty cell begins, and with negative values where it is over.

    A disk is 2k+1 runs along lattice rows, so a cell gives 2(2k+1) rows.
    """
    filled = reduce(lambda x, y: x | y, [F.coalesce(F.col(c), F.lit(0)) != 0 for c in sums])
    runs = base.where(filled).select("h3", *sums, F.explode(F.sequence(F.lit(-k), F.lit(k))).alias("dr"))
    dr = F.col("dr")
    first, after = F.greatest(F.lit(-k), -k - dr), F.least(F.lit(k), k - dr) + 1
    at = lambda dq: F.col("h3") + dq.cast("long") * F.lit(hx.Q_UNIT) + dr
    ends = F.array(F.struct(at(first).alias("h3"), F.lit(True).alias("begins")), F.struct(at(after).alias("h3"), F.lit(False).alias("begins")))
    runs = runs.select(*sums, F.explode(ends).alias("t"))
    return runs.select("t.h3", *[F.when(F.col("t.begins"), F.col(c)).otherwise(-F.col(c)).alias(c) for c in sums])


def wide_sums(base: DataFrame, sums: list[str], k: int) -> DataFrame:
    """(h3, {col}_k{k}...) of every cell of ``base``, 0 where nothing is near: ``neighbour_sums`` for large k.

    Changes are added up along each lattice row, so a cell costs 2(2k+1) rows instead of 1+3k(k+1). A
    row of the lattice is one window, bounded by the lattice. Fractions are summed as decimals of 9
    places, so what ends cancels what began exactly. NULL counts as 0; an empty table gives none.
    """
    exact = {c: "decimal(38,9)" if base.schema[c].dataType.typeName() in ("double", "float", "decimal") else "long" for c in sums}
    cells = base.select("h3", *[F.coalesce(F.col(c).cast(t), F.lit(0).cast(t)).alias(c) for c, t in exact.items()])
    changes = row_ends(cells, sums, k).groupBy("h3").agg(*[F.sum(c).cast(t).alias(c) for c, t in exact.items()])
    asked = cells.select("h3", *[F.lit(0).cast(t).alias(c) for c, t in exact.items()], F.lit(True).alias("asked"))
    every = changes.withColumn("asked", F.lit(False)).unionByName(asked)
    row = Window.partitionBy(hx.cell_res(F.col("h3")), hx.cell_r(F.col("h3"))).orderBy("h3").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    total = [F.sum(c).over(row).cast(base.schema[c].dataType).alias(f"{c}_k{k}") for c in sums]
    return every.select("h3", "asked", *total).where("asked").drop("asked")


def base_features(grid: DataFrame, population: DataFrame, counts: DataFrame, names: list[str]) -> DataFrame:
    """Grid <- population <- POI counts, gaps filled with zero (entropy stays NULL)."""
    zero = [F.coalesce(c, F.lit(0)).cast("int").alias(c) for c in ("n_poi", *[f"n_{g}" for g in names])]
    return (
        grid.select("h3", "h3_str", "lat", "lng")
        .join(population.select("h3", "population"), "h3", "left")
        .join(counts, "h3", "left")
        .select(
            "h3",
            "h3_str",
            "lat",
            "lng",
            F.coalesce("population", F.lit(0.0)).alias("population"),
            *zero,
            "poi_category_entropy",
        )
    )


def hex_features(
    grid: DataFrame,
    population: DataFrame,
    pois: DataFrame,
    res: int,
    groups: dict[str, list[str]] | None = None,
    ks: tuple[int, ...] = (1, 2),
    gap_min_pop: float = 200.0,
) -> DataFrame:
    """Feature table of one resolution; every grid cell has a row."""
    groups = rules.DEFAULT_GROUPS if groups is None else groups
    names = group_names(groups)
    base = base_features(grid, population, poi_counts(pois, f"h3_res{res}", groups), names)
    if ks:  # read twice below: once per cell, once scattered
        base = cut_lineage(base)
    sums = ["population", "n_poi", *[f"n_{g}" for g in names]]
    out = base
    families = []
    if ks:
        out = base.join(neighbour_sums(base, sums, list(ks)), "h3", "left")
        for k in ks:
            for c in sums:
                zero = F.lit(0.0) if c == "population" else F.lit(0)
                families.append(F.coalesce(f"{c}_k{k}", zero).alias(f"{c}_k{k}"))
    return out.select(
        *base.columns,
        poi_per_1k(F.col("n_poi"), F.col("population")).alias("poi_per_1k_pop"),
        *families,
        data_gap(F.col("population"), F.col("n_poi"), gap_min_pop).alias("data_gap"),
    )


def poi_per_1k(n_poi: Column, population: Column) -> Column:
    """POIs per 1,000 people, NULL without people."""
    return F.when(population > 0, n_poi * F.lit(1000.0) / population)


def data_gap(population: Column, n_poi: Column, min_pop: float) -> Column:
    """Many people and no POI at all: probably unmapped."""
    return (population >= min_pop) & (n_poi == 0)


def service_gaps(features: DataFrame, group: str, k: int = 2, min_pop: float = 1000.0) -> DataFrame:
    """Cells with at least ``min_pop`` people and no POI of the group within k rings."""
    return features.where((F.col("population") >= min_pop) & (F.col(f"n_{group}_k{k}") == 0))


def pois_of(pois: DataFrame, categories: list[str]) -> DataFrame:
    """POIs of the given categories."""
    return pois.where(F.col("category").isin(categories))


def manual_class(n_poi: Column) -> Column:
    """Label of the manual class of a POI count, NULL for none."""
    out = F.when(n_poi < 1, None)
    for top, label in MANUAL_CLASSES:
        out = out.otherwise(label) if top is None else out.when(n_poi <= top, label)
    return out


def _holding(bins: DataFrame, by: list[str], order: str, wanted: DataFrame | None = None) -> DataFrame:
    """Bins (n rows each) that hold wanted ranks, with the rank inside the bin; ``by`` names the bins' parent.

    Without ``wanted`` the ranks are in the column ``ranks`` of the bins.
    """
    before = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    placed = bins.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    asked = placed.select("*", F.inline("ranks")).drop("ranks") if wanted is None else placed.join(wanted, by)
    return asked.where((F.col("rank") > F.col("before")) & (F.col("rank") <= F.col("before") + F.col("n"))).withColumn("rank", F.col("rank") - F.col("before"))


def quantile_breaks(features: DataFrame, column: str = "population", classes: int = 7) -> DataFrame:
    """(class, lower, upper) of equal-count classes over positive values, linearly interpolated.

    Exact selection by refining histograms: counts per fine step of the logarithm, then per 1/65536 of
    the few steps that hold a break, then per value of what is left of those. Counts combine before
    they are shuffled and the values are neither sorted nor written; a step is one row, of which there
    are at most some two million whatever the values, and the broadcast tables have two rows a break.
    """
    values = features.where(F.col(column) > 0).select(F.col(column).cast("double").alias("v"))
    values = values.select("v", F.floor(F.log2("v") * 1024).alias("step"))
    steps = values.groupBy("step").agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
    total = F.sum("n").over(Window.partitionBy())
    positions = [(F.lit(i), F.lit(i / classes) * (total - 1) + 1) for i in range(classes + 1)]
    asked = [F.struct(i.alias("i"), pos.alias("pos"), side(pos).cast("long").alias("rank")) for i, pos in positions for side in (F.floor, F.ceil)]
    steps = _holding(steps.withColumn("ranks", F.array_distinct(F.array(*asked))), [], "step").drop("n", "before")

    part = F.floor(F.coalesce((F.col("v") - F.col("low")) / F.nullif(F.col("high") - F.col("low"), F.lit(0.0)), F.lit(0.0)) * 65536)
    near = values.join(F.broadcast(steps.select("step", "low", "high").distinct()), "step").select("step", part.alias("part"), "v")
    parts = near.groupBy("step", "part").agg(F.count("*").alias("n"))
    parts = _holding(parts, ["step"], "part", steps.select("step", "i", "pos", "rank")).drop("n", "before")

    nearest = near.join(F.broadcast(parts.select("step", "part").distinct()), ["step", "part"])
    exact = nearest.groupBy("step", "part", "v").agg(F.count("*").alias("n"))
    found = _holding(exact, ["step", "part"], "v", parts)
    # a break between two ranks lies between their values, the smaller first
    ends = found.groupBy("i", "pos").agg(F.min("v").alias("a"), F.max("v").alias("b"))
    cuts = ends.select("i", (F.col("a") + (F.col("b") - F.col("a")) * (F.col("pos") - F.floor("pos"))).alias("v"))
    w = Window.orderBy("i")  # classes + 1 rows
    return (
        cuts.select(F.col("i").alias("class"), F.lag("v").over(w).alias("lower"), F.col("v").alias("upper"))
        .where(F.col("class") > 0)
    )


def quantile_classes(features: DataFrame, column: str = "population", classes: int = 7) -> DataFrame:
    """(h3, value, class) of every cell with a positive value; a value on a break stays below it."""
    uppers = [r["upper"] for r in quantile_breaks(features, column, classes).orderBy("class").collect()]
    above = sum([(F.col(column) > F.lit(u)).cast("int") for u in uppers[:-1]], F.lit(1))
    return features.where(F.col(column) > 0).select("h3", column, above.alias("class"))


def top_cells(features: DataFrame, n: int = 10) -> DataFrame:
    """The n cells with most POIs; ties by id."""
    return features.orderBy(F.desc("n_poi"), "h3").limit(n)


def city_of(lat: Column, lng: Column, cities: dict | None = None) -> Column:
    """Name of the first rectangle holding the point, NULL when none does."""
    out = None
    for name, (x0, x1, y0, y1) in (CITIES if cities is None else cities).items():
        hit = lng.between(x0, x1) & lat.between(y0, y1)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return F.lit(None).cast("string") if out is None else out


def rollup_cells(values: DataFrame, res: int, parent_res: int, sums: list[str]) -> DataFrame:
    """Sums of child cells per ancestor at ``parent_res``."""
    p = hx.cell_to_parent(F.col("h3"), res, parent_res).alias("h3")
    return values.select(p, *sums).groupBy("h3").agg(*[F.sum(c).alias(c) for c in sums])


def disaggregate_cells(values: DataFrame, res: int, sums: list[str]) -> DataFrame:
    """Values spread evenly over the seven children of every cell; totals are kept."""
    child = F.explode(hx.cell_to_children(F.col("h3"), res)).alias("h3")
    return values.select(child, *[(F.col(c) / F.lit(7.0)).alias(c) for c in sums])
