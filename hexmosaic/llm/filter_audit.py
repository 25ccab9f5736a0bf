"""Interaction of five filters, from sorted posting lists of failing ids.

Each filter keeps, per part and range of ids, the sorted list of the rows that fail it. What a
filter removes after others is the difference between its list and their union; both come from
galloping merges, which copy whole runs and skip by doubling steps. Sizes of ranges add up, so
ranges are cut wherever a batch ends and no part or id is ever gathered in one place.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from heapq import heapify, heappop, heapreplace
from itertools import combinations, permutations
from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexmosaic.llm.common import documents, stored, table

FILTERS = "ABCDE"
LEAST_WORDS = 200
#: Percent of the words that must be distinct, and of the characters that may be capital letters.
LEAST_DISTINCT = 50
MOST_CAPITALS = 3
SYMBOLS = b"#$%&*|"
CAPITALS = bytes(range(65, 91))
LISTS = ", ".join(f"{f} array<int>" for f in FILTERS)


def failures(text: str) -> tuple[int, bytes]:
    """Failed ones of the filters A to D as bits, and a 160-bit digest of the text."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    bits = len(words) < LEAST_WORDS
    bits |= (100 * len(set(words)) < LEAST_DISTINCT * len(words)) << 1
    bits |= (100 * (len(raw) - len(raw.translate(None, CAPITALS))) > MOST_CAPITALS * len(text)) << 2
    bits |= (len(raw.translate(None, SYMBOLS)) < len(raw)) << 3
    return bits, hashlib.blake2b(raw, digest_size=20).digest()


def marked(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row: part, doc_id, turn (a number that sets equal ids apart), bits, good, toxic.

    Only a text that occurs under several ids meets its rows again, and only with its smallest id.
    """

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = [failures(t) for t in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"].array, "part": b["part"].array, "bits": np.array([g[0] for g in got], np.int32), "digest": [g[1] for g in got]})

    rows = documents(docs, F.coalesce("lang", F.lit("")).alias("part"))
    rows = stored(rows.mapInPandas(judge, "doc_id long, part string, bits int, digest binary"), "audit-marks")
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("last > first").drop("last")
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    known = known.agg(*[F.coalesce(F.max(F.col(c) == 1), F.lit(False)).alias(n) for c, n in (("quality", "good"), ("toxic", "toxic"))])
    again = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)).cast("int") * 16
    full = rows.join(first, "digest", "left").join(known, "doc_id", "left")
    flags = [F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")]
    return full.select("part", "doc_id", F.monotonically_increasing_id().alias("turn"), (F.col("bits") + again).alias("bits"), *flags)


def posting_lists(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per part and range of ids: part, first_id, last_id, n (rows), one sorted list per filter, and good, toxic.

    A list holds places in the range's id order, so repeated and null ids stay rows of their own.
    """

    def collect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for part, rows in b.groupby("part", sort=False):
                bits = rows["bits"].to_numpy()
                one = {"part": part, "first_id": rows["doc_id"].iloc[0], "last_id": rows["doc_id"].iloc[-1], "n": len(rows)}
                one |= {f: np.flatnonzero(bits >> k & 1).astype(np.int32) for k, f in enumerate(FILTERS)}
                one |= {c: np.flatnonzero(rows[c].to_numpy()).astype(np.int32) for c in ("good", "toxic")}
                yield pd.DataFrame([one]).astype({"first_id": "Int64", "last_id": "Int64"})

    rows = stored(marked(docs, labels), "audit-rows")
    rows = rows.repartitionByRange("part", "doc_id", "turn").sortWithinPartitions("part", "doc_id", "turn")
    return rows.mapInPandas(collect, f"part string, first_id long, last_id long, n long, {LISTS}, good array<int>, toxic array<int>")


def gallop(ids: list[int], least: int, at: int) -> int:
    """First place from ``at`` on whose id is ``least`` or more."""
    step = 1
    while at + step < len(ids) and ids[at + step] < least:
        step *= 2
    return bisect_left(ids, least, at + step // 2, min(len(ids), at + step))


def union(*lists: list[int]) -> list[int]:
    """Sorted union of sorted lists: the list with the smallest head gives all below the next head."""
    heads = [(ids[0], k, 0) for k, ids in enumerate(lists) if ids]
    heapify(heads)
    out: list[int] = []
    while len(heads) > 1:
        head, k, at = heads[0]
        ids = lists[k]
        below = min(h[0] for h in heads[1:3])
        to = at + 1 if head == below else gallop(ids, below, at)
        if head < below:
            out.extend(ids[at:to])
        if to < len(ids):
            heapreplace(heads, (ids[to], k, to))
        else:
            heappop(heads)
    for _, k, at in heads:
        out.extend(lists[k][at:])
    return out


def difference(ids: list[int], others: list[int]) -> list[int]:
    """Sorted ids that are not among the sorted others."""
    out: list[int] = []
    at = other = 0
    while at < len(ids):
        other = gallop(others, ids[at], other)
        if other == len(others):
            out.extend(ids[at:])
            break
        to = gallop(ids, others[other], at)
        out.extend(ids[at:to])
        at = to + (to < len(ids) and ids[to] == others[other])
    return out


def priors(name: str) -> list[str]:
    """All sets of other filters, as strings in order."""
    rest = FILTERS.replace(name, "")
    return ["".join(c) for k in range(len(rest) + 1) for c in combinations(rest, k)]


def differences(lists: DataFrame) -> DataFrame:
    """Per part, filter and set of earlier filters: n, gone (by the earlier ones), removed, good_lost, toxic_lost."""

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict = {}
        for b in batches:
            for row in b.to_dict("records"):
                ids = {c: row[c].tolist() for c in (*FILTERS, "good", "toxic")}
                unions = {p: union(*[ids[f] for f in p]) for f in FILTERS for p in priors(f)}
                for f in FILTERS:
                    for p in priors(f):
                        left = difference(ids[f], unions[p])
                        lost = [len(left) - len(difference(left, ids[c])) for c in ("good", "toxic")]
                        total = sums.setdefault((row["part"], f, p), np.zeros(5, np.int64))
                        total += (row["n"], len(unions[p]), len(left), *lost)
        keys = list(sums)
        yield pd.DataFrame([(*k, *sums[k].tolist()) for k in keys], columns=["part", "filter", "prior", *COUNTS])

    partial = lists.mapInPandas(merge, "part string, filter string, prior string, " + ", ".join(f"{c} long" for c in COUNTS))
    return partial.groupBy("part", "filter", "prior").agg(*[F.sum(c).alias(c) for c in COUNTS])


COUNTS = ("n", "gone", "removed", "good_lost", "toxic_lost")


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step: part, filter_order, step, filter and the counts.

    A null text is empty, a null lang is the part ''. A null id is smaller or larger than none, so
    its row never fails E and makes no row fail it. Repeated rows count each; a row of labels counts
    once for its id, as good or toxic if any says so. Other columns are ignored; no documents give
    no rows.
    """
    sizes = stored(differences(posting_lists(docs, labels)), "audit-sizes")
    weight = F.expr("CASE length(prior) " + " ".join(f"WHEN {k} THEN {factorial(k) * factorial(4 - k)}" for k in range(5)) + " END")
    every = sizes.groupBy("part", "filter").agg(
        F.sum(F.col("removed") * weight).alias("shapley"),
        F.max(F.when(F.col("prior") == "", F.col("removed"))).alias("fails"),
        F.max(F.when(F.length("prior") == 4, F.col("removed"))).alias("unique_fails"),
    )
    steps = [("".join(o), k + 1, o[k], "".join(sorted(o[:k]))) for o in permutations(FILTERS) for k in range(len(FILTERS))]
    orders = docs.sparkSession.createDataFrame(steps, "filter_order string, step int, filter string, prior string")
    got = sizes.join(every, ["part", "filter"]).join(orders, ["filter", "prior"])
    kept = (F.col("n") - F.col("gone") - F.col("removed")).alias("kept")
    redundant = (F.col("fails") - F.col("removed")).alias("redundant")
    return got.select("part", "filter_order", "step", "filter", kept, "removed", redundant, "unique_fails", "good_lost", "toxic_lost", "shapley")


SQL = r"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS t, coalesce(lang, '') AS part, min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first
  FROM documents),
words AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM texts),
known AS (
  SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
fails AS (
  SELECT part,
    CASE WHEN len(w) < 200 THEN 'A' ELSE '' END
    || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
    || CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 3 * length(t) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN doc_id > first THEN 'E' ELSE '' END AS failed,
    coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
  FROM words LEFT JOIN known USING (doc_id)),
classes AS (SELECT part, failed, good, toxic, count(*) AS n FROM fails GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (SELECT filter_order, CAST(unnest(range(1, 6)) AS INTEGER) AS step FROM orders),
placed AS (
  SELECT part, filter_order, step, n, good, toxic, filter_order[step] AS filter,
    contains(failed, filter_order[step]) AS fails_it,
    failed = filter_order[step] AS only_it,
    coalesce(list_min([strpos(filter_order, x) FOR x IN string_split(failed, '')]), 9) AS gone_at_raw,
    failed
  FROM classes, steps),
judged AS (SELECT *, CASE WHEN failed = '' THEN 9 ELSE gone_at_raw END AS gone_at FROM placed),
counted AS (
  SELECT part, filter_order, step, filter,
    CAST(coalesce(sum(n) FILTER (gone_at > step), 0) AS BIGINT) AS kept,
    CAST(coalesce(sum(n) FILTER (gone_at = step), 0) AS BIGINT) AS removed,
    CAST(coalesce(sum(n) FILTER (fails_it AND gone_at < step), 0) AS BIGINT) AS redundant,
    CAST(coalesce(sum(n) FILTER (only_it), 0) AS BIGINT) AS unique_fails,
    CAST(coalesce(sum(n) FILTER (gone_at = step AND good), 0) AS BIGINT) AS good_lost,
    CAST(coalesce(sum(n) FILTER (gone_at = step AND toxic), 0) AS BIGINT) AS toxic_lost
  FROM judged GROUP BY ALL)
SELECT *, CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley FROM counted
"""


def op11_filter_audit(spark, sf_dir):
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
