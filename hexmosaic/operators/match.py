"""One-to-one matching of two point sets, and the comparison per cell built on it.

A pair is a candidate when its points are within a radius and, optionally, their names are similar
enough. Candidates are taken closest first and every point at most once.

Equal places are merged first: points of one side with the same position (and the same name, when
names count) are one *site* with a capacity, so a place with millions of copies costs one row.

A round deals the sites to blocks, each a tile of the globe with what lies around it, and every block
decides what its own sites decide (``closest``). Chains of sites that wait for each other are
followed inside a block, so rounds do not grow with their length but with the tiles they cross; only
sites a block left undecided enter the next round, whose tiles lie elsewhere. Every round decides at
least all pairs that are each other's best, so the rounds end.

Blocks have a largest size. Where more sites lie within reach of each other, the radius is approached
by halves: all pairs within a smaller radius precede the others in the order, so matching those first
gives the same result from smaller blocks. What is too crowded even then (distinct places that all
lie far from their partners, but near each other) is decided by joins over all candidate pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hexmosaic.functions import geo, text
from hexmosaic.functions import hexgrid as hx
from hexmosaic.operators import closest
from hexmosaic.operators.polygons import number_rows
from hexmosaic.session import Rounds, bind, cut_lineage

#: How far a block goes beyond its tile, in radii: what a tile's sites may reach within the block.
REACH = 8
#: Widths of tiles in radii, the widest first: wide tiles repeat fewer sites in the blocks around them.
WIDTHS = (64, 24, REACH)
#: Sites of a block above which the radius is halved first, and smallest radius of that kind in metres.
BLOCK_SITES = 8192
LEAST_RADIUS = 0.5
#: Allowance for rounding in the blocking.
SLACK = 1 + 1e-6


class Tiles:
    """Blocks of the globe that hold all partners within a radius in their own and adjoining ones.

    Bands are a radius high. A band's columns are as wide as the largest difference in longitude of
    two points within the radius, one of them in the band and the other at most one band away; at
    the poles a band is one column. Columns close round the antimeridian.
    """

    def __init__(self, radius_m: float, turn: int = 0):
        if not 0 < radius_m < math.pi * geo.EARTH_R / 4:
            raise ValueError("the radius must be above 0 and below an eighth of the globe")
        # tiles of different turns have different borders
        self.shift = turn * 0.381966 % 1.0
        self.half = math.sin(radius_m / (2 * geo.EARTH_R)) * SLACK
        self.height = math.degrees(radius_m / geo.EARTH_R) * SLACK

    def band(self, lat: Column) -> Column:
        return F.floor((lat + 90.0) / F.lit(self.height) + F.lit(self.shift))

    def up(self, lat: Column) -> Column:
        """Place of a latitude in its band, 0 to 1."""
        at = (lat + 90.0) / F.lit(self.height) + F.lit(self.shift)
        return at - F.floor(at)

    def _cosine(self, band: Column) -> Column:
        """Smallest cosine of a latitude in a band and the two beside it."""
        low, high = ((band + k - self.shift) * self.height - 90.0 for k in (-1, 2))
        return F.cos(F.least(F.greatest(F.abs(low), F.abs(high)), F.lit(90.0)) * geo.RAD)

    def columns(self, band: Column) -> Column:
        """Number of columns of a band."""
        widest = self._cosine(band)
        width = 2 * F.asin(F.lit(self.half) / widest)  # degrees below
        return F.when(widest > 2 * self.half, F.greatest(F.floor(2 * math.pi / (width * SLACK)), F.lit(1))).otherwise(F.lit(1)).cast("long")

    def rim(self, band: Column, half: float) -> Column:
        """Largest difference in longitude, as a share of the globe, of a point in a band and one that ``half`` reaches."""
        widest = self._cosine(band)
        return F.when(widest > 2 * half, F.asin(F.lit(half) / widest) / math.pi * SLACK).otherwise(F.lit(1.0))

    def _at(self, lng: Column, n: Column) -> Column:
        return (F.pmod(lng + 180.0, F.lit(360.0)) / 360.0) * n + F.lit(self.shift)

    def column(self, lng: Column, n: Column) -> Column:
        return F.pmod(F.floor(self._at(lng, n)).cast("long"), n)

    def along(self, lng: Column, n: Column) -> Column:
        """Place of a longitude in its column, 0 to 1."""
        at = self._at(lng, n)
        return at - F.floor(at)

    def own(self, lat: Column, lng: Column) -> Column:
        """(band, column) of a point."""
        band = self.band(lat)
        return F.struct(band.alias("band"), self.column(lng, self.columns(band)).alias("col"))

    def around(self, lat: Column, lng: Column) -> Column:
        """All (band, column) a partner of the point can lie in, nine at most."""
        band = self.band(lat)
        n = [self.columns(band + k) for k in (-1, 0, 1)]
        every = [F.struct((band + k).alias("band"), F.pmod(self.column(lng, n[k + 1]) + j, n[k + 1]).alias("col")) for k in (-1, 0, 1) for j in (-1, 0, 1)]
        return F.array_distinct(F.array(*every))


def _sites(points: DataFrame, by_name: bool) -> DataFrame:
    """(site, lat, lng, name, grams, cap): one row per position and name."""
    name = text.normalise_name(F.coalesce("name", F.lit(""))) if by_name else F.lit("")
    s = (
        points.select("id", "lat", "lng", name.alias("name"))
        .groupBy("lat", "lng", "name")
        .agg(F.min("id").alias("site"), F.count("*").alias("cap"))
    )
    return s.select("site", "lat", "lng", "cap", text.trigrams(F.col("name")).alias("grams"))


def prefix_grams(grams: Column, min_similarity: float) -> Column:
    """Grams that two sets with at least this Jaccard similarity cannot both miss.

    Both sets are put in one global order (by hash); sets that share a fraction t share a gram
    among the first n - ceil(t n) + 1 of each.
    """
    ordered = F.transform(
        F.sort_array(F.transform(grams, lambda g: F.struct(F.xxhash64(g).alias("k"), g.alias("g")))),
        lambda s: s["g"],
    )
    n = F.size(grams)
    return F.slice(ordered, 1, n - F.ceil(n * F.lit(min_similarity - 1e-9)).cast("int") + 1)


def candidate_pairs(
    ours: DataFrame, truth: DataFrame, radius_m: float, min_similarity: float | None
) -> DataFrame:
    """(a, b, d, s, ca, cb): site pairs within the radius, blocked by tile.

    With a similarity above 0 also by the grams that similar names cannot both miss; a pair comes
    from the first gram it shares. A similarity of 0 filters nothing.
    """
    tiles = Tiles(radius_m)
    lat, lng = F.col("lat"), F.col("lng")
    cols = ["site", "lat", "lng", "cap", "grams"]
    a = ours.select(*cols, tiles.own(lat, lng).alias("c"))
    b = truth.select(*cols, F.explode(tiles.around(lat, lng)).alias("c"))
    on = ["c"]
    by_gram = min_similarity is not None and min_similarity > 0
    if by_gram:
        first = prefix_grams(F.col("grams"), min_similarity)
        a = a.withColumn("fa", first).select("*", F.explode("fa").alias("g"))
        b = b.withColumn("fb", first).select("*", F.explode("fb").alias("g"))
        on = ["c", "g"]
    names = {"site": "a", "lat": "la", "lng": "na", "cap": "ca", "grams": "ga"}
    other = {"site": "b", "lat": "lb", "lng": "nb", "cap": "cb", "grams": "gb"}
    p = a.withColumnsRenamed(names).join(b.withColumnsRenamed(other), on)
    if by_gram:
        p = p.where(F.get(F.array_intersect("fa", "fb"), 0) == F.col("g"))
    p = p.withColumn("d", geo.haversine_m(F.col("la"), F.col("na"), F.col("lb"), F.col("nb")))
    p = p.where(F.col("d") <= radius_m).withColumn("s", text.jaccard(F.col("ga"), F.col("gb")))
    if by_gram:
        p = p.where(F.col("s") >= min_similarity)
    return p.select("a", "b", "d", "s", "ca", "cb")


def _greedy(pairs: DataFrame) -> list[DataFrame]:
    """Closest-first matching of a pair table: (a, b, d, s, m) per round.

    ``before_a`` is what a site's better partners can take of it at most, ``before_b`` likewise. If
    nothing comes before b's side of a pair and a can serve b after all its better partners, the
    greedy order gives all of b to a, whatever else happens; so too with the sides changed. All such
    pairs are taken at once, and a round ends with what they used removed.
    """
    order = ["d", F.desc("s"), "a", "b"]
    cut, left, taken = Rounds(pairs.sparkSession), None, []
    left = cut.cut(pairs)
    while not left.isEmpty():
        ahead = lambda side, c: F.coalesce(F.sum(c).over(Window.partitionBy(side).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        ranked = left.withColumn("before_a", ahead("a", "cb")).withColumn("before_b", ahead("b", "ca"))
        best_b, best_a = F.col("before_b") == 0, F.col("before_a") == 0
        m = (
            F.when(best_a & best_b, F.least("ca", "cb"))
            .when(best_b & (F.col("before_a") + F.col("cb") <= F.col("ca")), F.col("cb"))
            .when(best_a & (F.col("before_b") + F.col("ca") <= F.col("cb")), F.col("ca"))
        )
        now = cut_lineage(ranked.withColumn("m", m).where("m is not null").select("a", "b", "d", "s", "m"))
        taken.append(now)
        used_a = now.groupBy("a").agg(F.sum("m").alias("ma"))
        used_b = now.groupBy("b").agg(F.sum("m").alias("mb"))
        done = now.select("a", "b", F.lit(True).alias("done"))
        rest = left.join(done, ["a", "b"], "left").where("done is null").join(used_a, "a", "left").join(used_b, "b", "left")
        left = cut.cut(
            rest.select(
                "a",
                "b",
                "d",
                "s",
                (F.col("ca") - F.coalesce("ma", F.lit(0))).alias("ca"),
                (F.col("cb") - F.coalesce("mb", F.lit(0))).alias("cb"),
            ).where((F.col("ca") > 0) & (F.col("cb") > 0))
        )
    return taken


def _members(points: DataFrame, by_name: bool, side: str) -> DataFrame:
    """(site, copy, id): the copies of every site numbered by id.

    Numbered by one range-partitioned sort, so the copies of a hot site spread over tasks.
    """
    name = text.normalise_name(F.coalesce("name", F.lit(""))) if by_name else F.lit("")
    p = points.select("id", "lat", "lng", name.alias("name"))
    ranked = number_rows(p, [F.asc("lat"), F.asc("lng"), F.asc("name"), F.asc("id")], "r")
    first = ranked.groupBy("lat", "lng", "name").agg(F.min("r").alias("r0"), F.min("id").alias("site"))
    return ranked.join(first, ["lat", "lng", "name"]).select(
        F.col("site").alias(side), (F.col("r") - F.col("r0")).alias(f"{side}_copy"), F.col("id").alias(f"{side}_id")
    )


def _side(rows: pd.DataFrame, box: tuple, sure_m: float) -> closest.Side:
    """Sites of one side of a block; ``box`` holds the home sites: south, north, west, width.

    A site is sure if all that lies within the radius of it is in the block: if the box, around which
    the block goes on for REACH radii, is ``sure_m`` away at most.
    """
    lat, lng = rows["lat"].to_numpy(), rows["lng"].to_numpy()
    turned = (lng - box[2] + 180.0) % 360.0 - 180.0
    gap = closest.distance(lat, lng, np.clip(lat, box[0], box[1]), box[2] + np.clip(turned, 0.0, box[3]))
    return closest.Side(rows["site"].tolist(), lat, lng, rows["cap"].to_numpy(), rows["grams"].tolist(), gap <= sure_m)


def _block(rows: pd.DataFrame, radius_m: float, sure_m: float, min_similarity: float | None) -> list[tuple]:
    """(a, b, d, s, m) of the pairs a block decides, and (site, null) or (null, site) of home sites it leaves open."""
    home, of_a = rows["home"].to_numpy(), (rows["side"] == "a").to_numpy()
    lat, lng = rows["lat"].to_numpy()[home], rows["lng"].to_numpy()[home]
    turned = (lng - lng[0] + 180.0) % 360.0 - 180.0
    box = (lat.min(), lat.max(), lng[0] + turned.min(), turned.max() - turned.min())
    a, b = (_side(rows[of], box, sure_m) for of in (of_a, ~of_a))
    out = [(a.ids[i], b.ids[j], d, s, n) for i, j, d, s, n in closest.decide(a, b, radius_m, min_similarity)]
    out += [(a.ids[k], None, None, None, None) for k in np.flatnonzero(home[of_a] & ~a.sure & (a.cap > 0))]
    return out + [(None, b.ids[k], None, None, None) for k in np.flatnonzero(home[~of_a] & ~b.sure & (b.cap > 0))]


def _each_block(radius_m: float, min_similarity: float | None):
    """Function for ``mapInPandas`` over rows in the order of their blocks; a block may span batches."""
    sure_m = (REACH - 1) * radius_m

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            tile = rows["tile"].to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(tile)) + 1).tolist()]
            rest = rows.iloc[cuts[-1] :]
            yield _frame([x for begin, end in zip(cuts, cuts[1:]) for x in _block(rows.iloc[begin:end], radius_m, sure_m, min_similarity)])
        if rest is not None and len(rest):
            yield _frame(_block(rest, radius_m, sure_m, min_similarity))

    return run


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["a", "b", "d", "s", "m"], dtype=object).astype({"m": "Int64"})


def _blocks(a: DataFrame, b: DataFrame, radius_m: float, turn: int, width: int = REACH) -> DataFrame:
    """Sites of both sides in all blocks they belong to: side, site, lat, lng, cap, grams, tile, home.

    A block holds its tile, ``width`` radii wide, and all sites up to REACH radii around it.
    """
    tiles, halo = Tiles(width * radius_m, turn), Tiles(REACH * radius_m)
    lat, lng = F.col("lat"), F.col("lng")
    both = a.select(F.lit("a").alias("side"), *SITE).union(b.select(F.lit("b").alias("side"), *SITE))
    keep = both.columns
    both = bind(both, keep, band=tiles.band(lat), up=tiles.up(lat))
    rim = F.lit(halo.height / tiles.height * SLACK)
    bands = F.filter(F.array(*[F.when(near, F.col("band") + k) for k, near in _sides(F.col("up"), rim)]), lambda x: x.isNotNull())
    both = both.select(*keep, F.col("band").alias("home_band"), F.explode(bands).alias("band"))
    both = bind(both, [*keep, "home_band", "band"], columns=tiles.columns(F.col("band")), rim=tiles.rim(F.col("band"), halo.half))
    both = bind(both, [*keep, "home_band", "band", "columns", "rim"], col=tiles.column(lng, F.col("columns")), along=tiles.along(lng, F.col("columns")))
    near = F.array(*[F.when(near, F.pmod(F.col("col") + k, F.col("columns"))) for k, near in _sides(F.col("along"), F.col("rim") * F.col("columns"))])
    near = F.array_distinct(F.filter(near, lambda x: x.isNotNull()))
    both = both.select(*keep, "band", "home_band", "col", F.explode(near).alias("near"))
    home = (F.col("band") == F.col("home_band")) & (F.col("near") == F.col("col"))
    return both.select(*keep, (F.col("band") * (1 << 32) + F.col("near")).alias("tile"), home.alias("home"))


def _sides(at: Column, rim: Column) -> list[tuple[int, Column]]:
    """Steps to the tiles before, at and after a place in its tile (0 to 1), and whether they lie within ``rim`` of it."""
    return [(-1, at <= rim), (0, F.lit(True)), (1, 1 - at <= rim)]


def _width(a: DataFrame, b: DataFrame, radius_m: float) -> int:
    """The widest tiles whose blocks all keep to BLOCK_SITES; the narrowest if there are none."""
    for width in WIDTHS[:-1]:
        if width * radius_m >= math.pi * geo.EARTH_R / 4:
            continue
        if _blocks(a, b, radius_m, 0, width).groupBy("tile").count().where(F.col("count") > BLOCK_SITES).isEmpty():
            return width
    return WIDTHS[-1]


SITE = ["site", "lat", "lng", "cap", "grams"]


def _decide(a: DataFrame, b: DataFrame, radius_m: float, min_similarity: float | None) -> Iterator[DataFrame]:
    """Tables (a, b, d, s, m) of matched site pairs within a radius, one per round."""
    ids = a.schema["site"].dataType.simpleString(), b.schema["site"].dataType.simpleString()
    schema = f"a {ids[0]}, b {ids[1]}, d double, s double, m long"
    turn, width = 0, _width(a, b, radius_m)
    while True:
        blocks = _blocks(a, b, radius_m, turn, width)
        # of tiles without sites of their own, or with one side only, nothing is to be decided
        sizes = blocks.groupBy("tile").agg(F.count("*").alias("n"), F.max("home").alias("home"), (F.min("side") < F.max("side")).alias("both"))
        sizes = cut_lineage(sizes.where("home and both").select("tile", "n"))
        crowded = sizes.where(F.col("n") > BLOCK_SITES).select("tile")
        few = blocks.join(sizes.where(F.col("n") <= BLOCK_SITES).select("tile"), "tile", "left_semi")
        few = few.repartition("tile").sortWithinPartitions("tile")
        got = cut_lineage(few.mapInPandas(_each_block(radius_m, min_similarity), schema))
        # several blocks may decide the same pair, and always alike
        now = cut_lineage(got.where("m is not null").distinct())
        yield now
        open_a = got.where("m is null and a is not null").select(F.col("a").alias("site"))
        open_b = got.where("m is null and b is not null").select(F.col("b").alias("site"))
        home = blocks.where("home").join(crowded, "tile", "left_semi")
        open_a = open_a.union(home.where("side = 'a'").select("site"))
        open_b = open_b.union(home.where("side = 'b'").select("site"))
        a, b = _spend(a.join(open_a, "site", "left_semi"), [now], "a"), _spend(b.join(open_b, "site", "left_semi"), [now], "b")
        if a.isEmpty() or b.isEmpty():
            return
        if now.isEmpty():  # only crowded blocks are left
            yield from _greedy(candidate_pairs(a, b, radius_m, min_similarity))
            return
        turn += 1


def match_points(
    ours: DataFrame, truth: DataFrame, radius_m: float = 100.0, min_similarity: float | None = None
) -> DataFrame:
    """(ours_id, truth_id, distance_m, similarity) of matched points.

    Both inputs have id, lat, lng, name. Order: distance, then the more similar name, then ids; of
    equal places the smaller ids go first. A similarity of 0 lets every name pass but still prefers
    the more similar one. Runs a few jobs per round and writes tables to the shared folder.
    """
    by_name = min_similarity is not None
    a, b = cut_lineage(_sites(ours, by_name)), cut_lineage(_sites(truth, by_name))
    copies = not a.select("cap").union(b.select("cap")).where("cap > 1").isEmpty()
    steps = [radius_m]
    while steps[0] > LEAST_RADIUS and not _blocks(a, b, steps[0], 0).groupBy("tile").count().where(F.col("count") > BLOCK_SITES).isEmpty():
        steps.insert(0, steps[0] / 2)
    taken: list[DataFrame] = []
    for i, step in enumerate(steps):
        rounds = list(_decide(a, b, step, min_similarity))
        taken += rounds
        if i + 1 < len(steps):
            a, b = _spend(a, rounds, "a"), _spend(b, rounds, "b")
    sites = taken[0]
    for t in taken[1:]:
        sites = sites.unionByName(t)
    if not copies:  # a site is its only point
        return sites.select(F.col("a").alias("ours_id"), F.col("b").alias("truth_id"), F.col("d").alias("distance_m"), F.col("s").alias("similarity"))
    return _to_points(sites, ours, truth, by_name)


def _spend(sites: DataFrame, rounds: list[DataFrame], side: str) -> DataFrame:
    """Sites with the capacity the rounds left them."""
    used = rounds[0].select(side, "m")
    for r in rounds[1:]:
        used = used.unionByName(r.select(side, "m"))
    used = used.groupBy(F.col(side).alias("site")).agg(F.sum("m").alias("used"))
    left = sites.join(used, "site", "left").withColumn("cap", F.col("cap") - F.coalesce("used", F.lit(0)))
    return cut_lineage(left.where(F.col("cap") > 0).drop("used"))


def _to_points(sites: DataFrame, ours: DataFrame, truth: DataFrame, by_name: bool) -> DataFrame:
    """Matched sites -> matched points: in the greedy order the smallest free ids of both sites meet.

    A pair becomes one row per copy; the rows of a site are numbered by a range-partitioned sort and
    meet its copies by (site, number), so a hot site is spread over tasks.
    """
    out = sites.select("a", "b", "d", "s", F.explode(F.sequence(F.lit(1), "m")).alias("unit"))
    for side in ("a", "b"):
        out = number_rows(out, [F.asc(side), F.asc("d"), F.desc("s"), F.asc("a"), F.asc("b"), F.asc("unit")], "r")
        first = cut_lineage(out.groupBy(side).agg(F.min("r").alias("r0")))
        out = out.join(first, side).withColumn(f"{side}_copy", F.col("r") - F.col("r0")).drop("r", "r0")
    return (
        out.join(_members(ours, by_name, "a"), ["a", "a_copy"])
        .join(_members(truth, by_name, "b"), ["b", "b_copy"])
        .select(F.col("a_id").alias("ours_id"), F.col("b_id").alias("truth_id"), F.col("d").alias("distance_m"), F.col("s").alias("similarity"))
    )


def inspect_matches(ours: DataFrame, truth: DataFrame, pairs: DataFrame, res: int) -> DataFrame:
    """(h3, kind, ours_id, truth_id, distance_m, similarity): every point of both sides, by cell.

    ``kind`` is matched, only_ours or only_truth; a pair stands in the cell of its point of ours.
    """
    cell = hx.cell(F.col("lat"), F.col("lng"), res).alias("h3")
    mine, theirs = ours.select(F.col("id").alias("ours_id"), cell), truth.select(F.col("id").alias("truth_id"), cell)
    cols = ["h3", "kind", "ours_id", "truth_id", "distance_m", "similarity"]
    hit = mine.join(pairs, "ours_id", "left")
    hit = hit.withColumn("kind", F.when(F.col("truth_id").isNotNull(), "matched").otherwise("only_ours"))
    rest = theirs.join(pairs.select("truth_id"), "truth_id", "left_anti")
    none = {"kind": F.lit("only_truth"), "ours_id": F.lit(None).cast(ours.schema["id"].dataType), "distance_m": F.lit(None).cast("double"), "similarity": F.lit(None).cast("double")}
    return hit.select(*cols).unionByName(rest.withColumns(none).select(*cols))


def like_with_like(ours: DataFrame, truth: DataFrame, group: str, category: str) -> tuple[DataFrame, DataFrame]:
    """Both sides cut to one of our groups and one category of theirs, before they are matched."""
    return ours.where(F.col("group") == group), truth.where(F.lower("category") == category.lower())


def compare_by_cell(
    ours: DataFrame, truth: DataFrame, pairs: DataFrame, population: DataFrame, res: int
) -> DataFrame:
    """h3, lat, lng, population, ours, ground_truth, matched_ground_truth, matched_ours, gt_minus_ours.

    One row per cell with a point of either side. Matched points count in the cell of each side.
    """
    c = hx.cell(F.col("lat"), F.col("lng"), res).alias("h3")
    hit_a = pairs.select(F.col("ours_id").alias("id"), F.lit(1).alias("hit"))
    hit_b = pairs.select(F.col("truth_id").alias("id"), F.lit(1).alias("hit"))

    def side(points: DataFrame, hits: DataFrame, n: str, m: str) -> DataFrame:
        p = points.select("id", c).join(hits, "id", "left")
        return p.groupBy("h3").agg(F.count("*").cast("int").alias(n), F.count("hit").cast("int").alias(m))

    a = side(ours, hit_a, "ours", "matched_ours")
    b = side(truth, hit_b, "ground_truth", "matched_ground_truth")
    both = a.join(b, "h3", "full").join(population.select("h3", "population"), "h3", "left")
    zero = {n: F.coalesce(n, F.lit(0)) for n in ("ours", "ground_truth", "matched_ground_truth", "matched_ours")}
    lat, lng = hx.cell_latlng(F.col("h3"), res)
    return both.select(
        "h3",
        lat.alias("lat"),
        lng.alias("lng"),
        F.coalesce("population", F.lit(0.0)).alias("population"),
        *[e.alias(n) for n, e in zero.items()],
        (zero["ground_truth"] - zero["ours"]).alias("gt_minus_ours"),
    )


def agreement(comparison: DataFrame) -> DataFrame:
    """One row: totals, recall (truth found in ours) and precision (ours confirmed by truth)."""
    t = comparison.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("ours", "ground_truth", "matched_ours", "matched_ground_truth")]
    )
    return t.select(
        "*",
        F.when(F.col("ground_truth") > 0, F.col("matched_ground_truth") / F.col("ground_truth")).alias("recall"),
        F.when(F.col("ours") > 0, F.col("matched_ours") / F.col("ours")).alias("precision"),
    )


def biggest_differences(comparison: DataFrame, n: int = 20) -> DataFrame:
    """The n cells with the largest difference in either direction; ties by id."""
    return comparison.orderBy(F.desc(F.abs("gt_minus_ours")), "h3").limit(n)
