"""Mixing sources to target weights by hash order and distributed prefix sums.

Every row gets a random key (MD5 of seed and id). Within a source the rows are ordered by that key;
ranges of keys are sorted on their own and joined by prefix sums of their word counts, so a source
of any size is spread over many tasks. The order is cut at the exact word budget of the source;
sources with a larger target repeat whole epochs first.
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hexmosaic.llm.common import WORD, kept_whole, stored, word_count

ROWS_PER_RANGE = 1024


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), share: float = 1.0, epochs: int = 3) -> DataFrame:
    """Targets of sources: columns source, source_size in; weight, target and budget come on top.

    Weights are dealt in code point order of the sources, null last, repeating. All targets together
    are ``share`` of all sizes and proportional to the weights, but none is above ``epochs`` times
    its source's size; the excess goes to the others by weight. In order of cap / weight, the first
    source that keeps its share below its cap fixes the level for all after it. The windows without
    a key run over one row per source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(w) for w in weights])
    s = sizes.select("source", "source_size", F.row_number().over(order).alias("rank"))
    s = s.withColumn("weight", F.get(cycle, (F.col("rank") - 1) % len(weights)).cast("long"))
    s = s.withColumn("cap", F.col("source_size") * epochs)
    ratio = F.col("cap").cast("double") / F.col("weight")
    before = Window.orderBy(ratio, "rank").rowsBetween(Window.unboundedPreceding, -1)
    all_rows = Window.orderBy(ratio, "rank").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = s.withColumn("open_weight", F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    left = F.sum("source_size").over(all_rows).cast("double") * share - F.coalesce(F.sum("cap").over(before), F.lit(0))
    s = s.withColumn("level", left / F.col("open_weight")).withColumn("turn", F.row_number().over(Window.orderBy(ratio, "rank")))
    below = F.col("weight") * F.col("level") < F.col("cap")
    found = F.min(F.when(below, F.struct("turn", "level"))).over(all_rows)["level"]
    s = s.withColumn("target", F.coalesce(F.least(F.col("cap").cast("double"), F.col("weight") * found), F.col("cap").cast("double")))
    return s.select("source", "source_size", "weight", "target", F.floor(F.col("target") + 0.5).cast("long").alias("budget"))


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = (1, 2, 3),
    share: float = 1.0,
    epochs: int = 3,
    seed: str = "mix-1",
) -> DataFrame:
    """Words taken from each document: doc_id, source, text_key, size, source_size, target, taken.

    ``docs`` needs doc_id, text and source; other columns are ignored. The size of a null or empty
    text is 0, and such rows get 0 words. A null source is a source of its own; a null id is an id
    like others. Repeated rows are rows of their own: among rows of equal id the shorter comes
    first. ``taken`` counts repeats: ``taken // size`` whole copies and the first ``taken % size``
    words once more, at most one document of a source being cut. Sums of ``taken`` equal the rounded
    targets. An empty table gives an empty result. Results depend on neither partitioning nor the
    number of ranges.
    """
    key = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    group = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n"))
    rows = stored(docs.select("doc_id", "source", F.xxhash64("text").alias("text_key"), word_count("text").alias("size"), key.alias("key"), group.alias("group")), "mix-sizes")
    digits = max(1, ceil(log2(max(1, rows.count() / ROWS_PER_RANGE)) / 4 + 0.5))
    rows = rows.withColumn("range", F.substring("key", 1, digits))

    ranges = rows.groupBy("group", "range").agg(F.sum("size").alias("range_size"), F.first("source").alias("source"))
    ranges = stored(ranges, "mix-ranges")
    before = Window.partitionBy("group").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.select("group", "range", F.coalesce(F.sum("range_size").over(before), F.lit(0)).alias("range_start"))
    sizes = ranges.groupBy("group").agg(F.first("source").alias("source"), F.sum("range_size").alias("source_size"))
    targets = source_targets(sizes.drop("group"), weights, share, epochs)
    targets = targets.select(F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n")).alias("group"), "source_size", "target", "budget")
    starts = starts.join(targets, "group")

    inside = Window.partitionBy("group", "range").orderBy("key", "doc_id", "size", "text_key").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.join(starts, ["group", "range"])
    rows = rows.withColumn("start", F.col("range_start") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    rounds = F.when(F.col("source_size") > 0, F.expr("budget div source_size")).otherwise(F.lit(0))
    rest = F.col("budget") - rounds * F.col("source_size")
    more = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("start")))
    return rows.select("doc_id", "source", "text_key", "size", "source_size", "target", (rounds * F.col("size") + more).cast("long").alias("taken"))


def apply_mix(docs: DataFrame, taken: DataFrame) -> DataFrame:
    """The mixed rows themselves: every document as often as it is taken, the cut one shortened.

    Rows of equal id, source and text are one document here, with the words taken from all of them,
    so repeated rows give as many words as they were granted. Columns of ``docs`` stay (of such rows
    those of one); ``n_chars`` follows a shortened text.
    """
    share = taken.groupBy("doc_id", "source", "text_key").agg(F.max("size").alias("size"), F.sum("taken").alias("taken")).where("taken > 0")
    share = share.withColumnsRenamed({"doc_id": "mixed_id", "source": "mixed_source", "text_key": "mixed_key"})
    once = kept_whole(docs, doc_id=F.col("doc_id"), source=F.col("source"), text_key=F.xxhash64("text")).dropDuplicates(["doc_id", "source", "text_key"])
    same = F.col("doc_id").eqNullSafe(F.col("mixed_id")) & F.col("source").eqNullSafe(F.col("mixed_source")) & (F.col("text_key") == F.col("mixed_key"))
    both = once.join(share, same)
    whole = F.expr("taken div size")
    rest = F.col("taken") % F.col("size")
    copies = F.concat(F.array_repeat(F.lit(-1).cast("long"), whole.cast("int")), F.when(rest > 0, F.array(rest)).otherwise(F.array().cast("array<bigint>")))
    rows = both.select("row", F.explode(copies).alias("words"))
    text = F.col("row.text")
    first = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(f"({WORD})"), 1), F.lit(1), F.col("words").cast("int")), " ")
    cut = F.col("row").withField("text", first)
    if "n_chars" in docs.columns:
        cut = cut.withField("n_chars", F.char_length(first).cast(docs.schema["n_chars"].dataType))
    return rows.select(F.when(F.col("words") < 0, F.col("row")).otherwise(cut).alias("row")).select("row.*")


SQL = r"""
WITH rows AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS key
  FROM documents),
sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM rows GROUP BY source),
ranked AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM sizes),
weighted AS (SELECT *, (rank - 1) % 3 + 1 AS weight, 3 * source_size AS cap FROM ranked),
levels AS (
  SELECT *,
    (CAST(sum(source_size) OVER () AS DOUBLE) - CAST(coalesce(sum(cap) OVER w, 0) AS DOUBLE))
      / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0)) AS level,
    row_number() OVER (ORDER BY CAST(cap AS DOUBLE) / weight, rank) AS turn
  FROM weighted
  WINDOW w AS (ORDER BY CAST(cap AS DOUBLE) / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
chosen AS (SELECT arg_min(level, turn) FILTER (weight * level < cap) AS level FROM levels),
targets AS (
  SELECT source, source_size, coalesce(least(CAST(cap AS DOUBLE), weight * c.level), CAST(cap AS DOUBLE)) AS target
  FROM levels, chosen c),
budgets AS (SELECT *, CAST(floor(target + 0.5) AS BIGINT) AS budget FROM targets),
placed AS (
  SELECT doc_id, size, source_size, target, budget,
    CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS rounds,
    coalesce(sum(size) OVER (PARTITION BY r.source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM rows r JOIN budgets b ON r.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target,
  CAST(rounds * size + greatest(0, least(size, budget - rounds * source_size - start)) AS BIGINT) AS taken
FROM placed
"""


def op9_mixing(spark, sf_dir):
    from hexmosaic.llm.common import table

    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
