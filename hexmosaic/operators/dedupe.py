"""Duplicates across sources: candidate pairs, groups, survivors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexmosaic.functions import hexgrid as hx
from hexmosaic.functions import text
from hexmosaic.session import Rounds, cut_lineage, unsent


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable over undirected edges (a, b).

    Alternating large-star and small-star rounds: every node hangs its larger neighbours, then its
    smaller ones, on the smallest node it sees, until nothing moves. The rounds grow with the
    logarithm of the graph, each is two aggregates with map-side combine, and no neighbour list is
    ever collected. Lineage is cut by a written table per round; count and checksum of the edges tell the end.
    """
    rounds = Rounds(edges.sparkSession)
    mark = lambda t: tuple(t.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    e = edges.where(F.col("a") != F.col("b"))
    e = rounds.cut(e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before, now = None, mark(e)
    while now != before:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(unsent(low), "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where(F.col("u") != F.col("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(unsent(low), "u").select(
            F.inline(
                F.array(
                    F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                    F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                )
            )
        )
        e = rounds.cut(small.where(F.col("u") != F.col("v")).distinct())
        before, now = now, mark(e)
    roots = e.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def duplicate_sites(pois: DataFrame, index_res: int = 11) -> DataFrame:
    """(site, source, cell, name, grams, rows): records of one source with one cell and name.

    Copies inside a source are one site, however many there are.
    """
    p = pois.where(text.normalise_name(F.coalesce("name", F.lit(""))) != "").select(
        "source",
        "source_id",
        F.col(f"h3_res{index_res}").alias("cell"),
        text.normalise_name(F.col("name")).alias("name"),
    )
    s = p.groupBy("source", "cell", "name").agg(
        F.min(F.concat_ws("|", "source", "source_id")).alias("site"), F.count("*").alias("rows")
    )
    return s.select("*", text.trigrams(F.col("name")).alias("grams"))


def rare_first(sites: DataFrame) -> DataFrame:
    """Sites with ``ordered``: their grams from the rarest of all sites to the most common one.

    Counts combine before the shuffle and meet each gram once; a common gram is one key of a join with
    a unique side.
    """
    each = sites.select("site", F.explode("grams").alias("g"))
    counts = each.groupBy("g").agg(F.count("*").alias("n"))
    ordered = each.join(counts, "g").groupBy("site").agg(F.array_sort(F.collect_list(F.struct("n", "g"))).alias("by_count"))
    return sites.join(unsent(ordered), "site").select("*", F.col("by_count.g").alias("ordered")).drop("by_count")


def gram_candidates(sites: DataFrame, min_similarity: float = 0.5) -> DataFrame:
    """(a, b, grams_a, grams_b): pairs of sites of different sources, in the same or a neighbouring cell, that may be similar.

    Similar names share one of their first grams in any common order, and in the order from the
    rarest on a common stem comes last. Sizes too different, or too few grams after the shared one, rule
    a pair out before the sets are compared. Rows that meet are repeated by gram and cell, so they hold
    no sets; these join the pairs that are left.
    """
    t = min_similarity - 1e-9
    size = F.size("ordered")
    first = sites.select("site", "source", "cell", size.alias("n"), F.posexplode(F.slice("ordered", 1, size - F.ceil(size * F.lit(t)).cast("int") + 1)).alias("pos", "g"))
    a = first.withColumnsRenamed({"site": "a", "source": "source_a", "n": "na", "pos": "pa"})
    b = first.withColumnsRenamed({"site": "b", "source": "source_b", "n": "nb", "pos": "pb", "cell": "cell0"})
    b = b.select("*", F.explode(hx.grid_disk(F.col("cell0"), 1)).alias("cell")).drop("cell0")
    hit = a.join(unsent(b), ["cell", "g"]).where(F.col("source_a") < F.col("source_b"))
    lengths = F.col("nb").between(F.col("na") * t, F.col("na") / t)
    left = F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb"))  # this gram and those after it
    enough = left >= F.ceil((F.col("na") + F.col("nb")) * F.lit(t / (1 + t)) - 1e-6)
    # the first gram leaves the most, so a later one lets no other pair through
    told = hit.where(lengths & enough).select("a", "b").distinct()
    sets = sites.select("site", "ordered").distinct()
    told = told.join(unsent(sets.withColumnsRenamed({"site": "a", "ordered": "grams_a"})), "a")
    return told.join(unsent(sets.withColumnsRenamed({"site": "b", "ordered": "grams_b"})), "b").select("a", "b", "grams_a", "grams_b")


def duplicate_pairs(sites: DataFrame, min_similarity: float = 0.5) -> DataFrame:
    """(a, b) sites of different sources in the same or a neighbouring cell with similar names."""
    hit = gram_candidates(rare_first(sites), min_similarity)
    return hit.where(text.jaccard(F.col("grams_a"), F.col("grams_b")) >= min_similarity).select("a", "b")


def duplicate_groups(pois: DataFrame, index_res: int = 11, min_similarity: float = 0.5) -> DataFrame:
    """POIs with ``dup_group_id``: records joined by chains of duplicates share one."""
    sites = cut_lineage(duplicate_sites(pois, index_res))
    comp = connected_components(duplicate_pairs(sites, min_similarity))
    named = sites.join(unsent(comp.withColumnRenamed("node", "site")), "site").select(
        "source", F.col("cell").alias(f"h3_res{index_res}"), F.col("name").alias("_norm"), "component"
    )
    keyed = pois.withColumn("_norm", text.normalise_name(F.coalesce("name", F.lit(""))))
    own = F.concat_ws("|", "source", "source_id")
    return (
        keyed.join(unsent(named), ["source", f"h3_res{index_res}", "_norm"], "left")
        .withColumn("dup_group_id", F.coalesce("component", own))
        .select(*pois.columns, "dup_group_id")
    )


def dedupe_pois(
    pois: DataFrame,
    source_order: list[str],
    index_res: int = 11,
    min_similarity: float = 0.5,
) -> DataFrame:
    """Of each duplicate group the records of one source: that of its best record.

    The best has the highest confidence, then comes the source order, then the id. Records of one
    source are never duplicates of each other, whether another source has a twin or not: they stay
    or go together. With a single source the input comes back with its own ids as groups.
    """
    if len(source_order) < 2:
        return pois.withColumn("dup_group_id", F.concat_ws("|", "source", "source_id"))
    grouped = cut_lineage(duplicate_groups(pois, index_res, min_similarity))
    rank = F.coalesce(
        *[F.when(F.col("source") == s, i) for i, s in enumerate(source_order)], F.lit(len(source_order))
    )
    order = F.struct(
        (-F.coalesce("confidence", F.lit(-1.0))).alias("conf"), rank.alias("src"), F.col("source_id").alias("sid")
    )
    best = grouped.groupBy("dup_group_id").agg(F.min_by("source", order).alias("_best"))
    return grouped.join(unsent(cut_lineage(best)), "dup_group_id").where(F.col("source") == F.col("_best")).select(*grouped.columns)
