"""Benchmark decontamination by spaced seeds, in DataFrame operations only.

Every position of every text is hashed under fixed masks, which ignore some of the words they span.
Hashes that also occur in the benchmark give an alignment of document and item; the words around the
hit are compared one by one. The two masks together meet every window of WINDOW words with at most
SUBSTITUTIONS different ones, wherever they stand (a test goes through all cases), so the seeds lose
no overlap.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexmosaic.llm.common import kept_whole, row_key, stored, table
from hexmosaic.session import bind

WINDOW, SUBSTITUTIONS = 13, 2
MASKS = ("1101000111", "11101101")
#: Items with fewer words than this are no evidence; those below WINDOW must occur as a whole.
LEAST_WORDS = 5
#: Seeds of the benchmark that are broadcast at once; more are done in turns.
SEEDS_AT_ONCE = 1 << 20


def tokens(text: str | Column) -> Column:
    """Lower-case runs of letters and digits; none for null."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def seed_at(words: Column, pos: Column, mask: str) -> Column:
    """Hash of the words under the mask from ``pos`` on; null where it does not fit."""
    at = [i for i, c in enumerate(mask) if c == "1"]
    return F.when(pos + len(mask) <= F.size(words), F.xxhash64(F.lit(mask), *[F.get(words, pos + k) for k in at]))


def with_seeds(words: DataFrame, keep: list[str], pos: str, masks: list[str]) -> DataFrame:
    """``keep``, pos and seed: a row for every position of ``words`` and mask that fits there.

    Positions are rows before they are hashed, so the hashing is generated code, and the words they
    come from are only referred to.
    """
    every = words.where(F.size("words") > 0).select(*keep, F.explode(F.sequence(F.lit(0), F.size("words") - 1)).alias(pos))
    under = F.array(*[F.struct(seed_at(F.col("words"), F.col(pos), m).alias("seed")) for m in masks])
    return every.select(*keep, pos, F.inline(under)).where("seed is not null")


def benchmark_seeds(items: DataFrame) -> tuple[DataFrame, DataFrame, list[str]]:
    """Items with their words, their seeds (seed, item_no, at), and all masks in use.

    Items below WINDOW words get a mask of their own length without gaps.
    """
    words = bind(items.select("item_id", "text"), ["item_id"], words=tokens("text"))
    words = words.where(F.size("words") >= LEAST_WORDS).withColumn("item_no", F.xxhash64("item_id", "words"))
    words = stored(words.dropDuplicates(["item_no"]), "benchmark")
    short = [r[0] for r in words.where(F.size("words") < WINDOW).select(F.size("words")).distinct().collect()]
    masks = list(MASKS) + ["1" * n for n in sorted(short)]
    parts = []
    for mask in masks:
        fits = F.size("words") >= WINDOW if mask in MASKS else F.size("words") == len(mask)
        parts.append(with_seeds(words.where(fits), ["item_no", "words"], "at", [mask]).select("item_no", F.size("words").alias("item_words"), "at", "seed"))
    every = parts[0]
    for p in parts[1:]:
        every = every.union(p)
    return words, stored(every, "benchmark-seeds"), masks


def alignments(docs: DataFrame, seed_part: DataFrame, masks: list[str]) -> DataFrame:
    """Distinct alignments (doc_id, item_no, shift) that a seed proposes, with the words there.

    The words of a text are only referred to while its seeds are looked up; a hit takes along the
    few that lie under the item.
    """
    words = bind(docs.where("doc_id is not null").select("doc_id", "text"), ["doc_id"], words=tokens("text"))
    hashed = with_seeds(words, ["doc_id", "words"], "pos", masks)
    hits = hashed.join(F.broadcast(seed_part), "seed")
    shift = F.col("pos") - F.col("at")
    begin = F.greatest(shift, F.lit(0))
    under = F.slice("words", begin + 1, F.col("item_words") - (begin - shift))
    hits = hits.select("doc_id", "item_no", shift.alias("shift"), under.alias("under"))
    return hits.groupBy("doc_id", "item_no", "shift", "under").agg(F.lit(1).alias("one")).drop("one")


def overlaps(found: DataFrame, items: DataFrame) -> DataFrame:
    """Alignments with a window of enough equal words: doc_id, item_id, words (equal ones in all)."""
    both = found.join(items.select("item_no", "item_id", F.col("words").alias("item")), "item_no")
    skip = F.greatest(-F.col("shift"), F.lit(0))
    equal = F.zip_with("under", F.slice("item", skip + 1, F.size("under")), lambda a, b: (a == b).cast("int"))
    both = bind(both, ["doc_id", "item_id", "item"], equal=equal)
    length = F.least(F.lit(WINDOW), F.size("item"))
    need = F.when(F.size("item") < WINDOW, length).otherwise(WINDOW - SUBSTITUTIONS)
    add = lambda a, x: a + x
    starts = F.sequence(F.lit(1), F.size("equal") - length + 1)
    enough = F.exists(starts, lambda s: F.aggregate(F.slice("equal", s, length), F.lit(0), add) >= need)
    both = both.where((F.size("equal") >= length) & F.when(F.size("equal") >= length, enough))
    return both.groupBy("doc_id", "item_id").agg(F.max(F.aggregate("equal", F.lit(0), add)).cast("long").alias("words"))


def leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Pairs of a document and a benchmark item that it holds: doc_id, item_id, words.

    A document holds an item if, somewhere, WINDOW consecutive words of both differ in at most
    SUBSTITUTIONS places; an item of LEAST_WORDS to WINDOW - 1 words must occur as a whole, and a
    shorter one never does. Case and punctuation do not count. ``words`` is the largest number of
    equal words in one alignment. Null and empty texts hold nothing and are held by nothing; rows
    with a null doc_id take no part; rows of one id count together; a null item_id is an id. Other
    columns are ignored; empty tables give an empty result. Only seeds of the benchmark are
    broadcast, a bounded number at once.
    """
    return held(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), items)


def held(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``leaks`` of documents whose doc_id is of any type."""
    words, every, masks = benchmark_seeds(items)
    turns = max(1, ceil(every.count() / SEEDS_AT_ONCE))
    found = None
    for turn in range(turns):
        part = every if turns == 1 else every.where(F.pmod("seed", F.lit(turns)) == turn)
        one = alignments(docs, part, masks)
        found = one if found is None else found.union(one)
    return overlaps(found, words)


def drop_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item, in their own columns.

    Each row goes or stays for its own text, also where its id is null or repeated.
    """
    rows = kept_whole(docs, key=row_key(), text=F.col("text"))
    bad = held(rows.select(F.col("key").alias("doc_id"), "text"), items).select(F.col("doc_id").alias("key")).distinct()
    return rows.join(bad, "key", "left_anti").select("row.*")


SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS words FROM documents),
b AS (
  SELECT item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS words FROM benchmark),
items AS (SELECT * FROM b WHERE len(words) >= 5),
runs AS (
  SELECT DISTINCT item_id, words, i, words[i:i + 3] AS run
  FROM (SELECT item_id, words, unnest(range(1, len(words) - 2)) AS i FROM items)),
hits AS (
  SELECT DISTINCT x.doc_id, r.item_id, x.i - r.i AS shift, x.words AS dw, r.words AS iw
  FROM (SELECT doc_id, words, i, words[i:i + 3] AS run FROM (SELECT doc_id, words, unnest(range(1, len(words) - 2)) AS i FROM d WHERE len(words) >= 4)) x
  JOIN runs r ON x.run = r.run),
eq AS (
  SELECT doc_id, item_id, len(iw) AS n,
    list_transform(range(greatest(1, 1 - shift), least(len(iw), len(dw) - shift) + 1), lambda k: CAST(dw[k + shift] = iw[k] AS INT)) AS e
  FROM hits),
ok AS (
  SELECT doc_id, item_id, list_sum(e) AS words FROM eq
  WHERE len(e) >= least(13, n)
    AND list_max(list_transform(range(1, len(e) - least(13, n) + 2), lambda s: list_sum(e[s:s + least(13, n) - 1]))) >= CASE WHEN n < 13 THEN n ELSE 11 END)
SELECT doc_id, item_id, CAST(max(words) AS BIGINT) AS words FROM ok GROUP BY ALL
"""


def op8_decontaminate(spark, sf_dir):
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
