"""Divergence between sources of a language, by row accumulation over a term-major index.

Exact smoothed term probabilities of two groups are compared term by term. The index lists the
groups of each term. Row by row, a group scatters its terms through those lists into one dense
accumulator of all its peers, so no pair of postings ever becomes a row. Only terms that both
groups hold are met this way; what a group's terms give against the peers that lack them, and what
terms that both lack give, is added from the groups' baseline probabilities.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hexmosaic.llm.common import stored, table

LEAST_DOCS = 10
UNIT = 1_000_000_000
SMOOTHING = 2
TOP = 10
#: Counters of a task are given away at so many terms.
TERMS_AT_ONCE = 300_000
#: Postings that one task accumulates.
POSTINGS_PER_BUCKET = 1 << 17
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def terms(text: str) -> list[bytes]:
    """Runs of ASCII letters and characters beyond ASCII, with A to Z in lower case."""
    return text.encode("utf-8", "surrogatepass").translate(_LETTERS).split()


def group_rows(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")])


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, count (occurrences) and docs (documents that hold it)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def out() -> Iterator[pd.DataFrame]:
            for (lang, source), (count, docs_of) in held.items():
                if not count:
                    continue
                names = [t.decode("utf-8", "surrogatepass") for t in count]
                yield pd.DataFrame({"lang": lang, "source": source, "term": names, "count": list(count.values()), "docs": list(docs_of.values())})
            held.clear()

        for b in batches:
            for lang, source, text in zip(b["lang"], b["source"], b["text"]):
                if (lang, source) not in held:
                    held[lang, source] = Counter(), Counter()
                count, docs_of = held[lang, source]
                found = terms(text)
                # dictionaries keep their order, so both counters list the same terms alike
                distinct = dict.fromkeys(found)
                count.update(found)
                docs_of.update(list(distinct))
            if sum(len(c) for c, _ in held.values()) > TERMS_AT_ONCE:
                yield from out()
        yield from out()

    rows = docs.mapInPandas(run, "lang string, source string, term string, count long, docs long")
    return rows.groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))


def probability(count: Column, total: Column, size: Column) -> Column:
    """1 + floor(UNIT * (count + SMOOTHING) / (total + SMOOTHING * size)), exactly."""
    wide = lambda x: x.cast("decimal(28,0)")
    whole = wide(total) + SMOOTHING * wide(size)
    # the decimal quotient is a long, as no count exceeds its total
    return 1 + F.call_function("div", UNIT * (wide(count) + SMOOTHING), F.when(whole > 0, whole))


def divided(p, q):
    """floor((p - q)^2 / (p + q)) of arrays or columns of numbers below 2^31."""
    return (p - q) * (p - q) // (p + q)


def accumulate(rows: pd.DataFrame, base: np.ndarray) -> np.ndarray:
    """Sums over the terms of ``rows`` (number, term, p) for each pair of groups, without terms both lack.

    For each term that either group of a pair has, f of the two probabilities less f of the two
    baselines. A group's row of the result is one dense accumulator.
    """
    code = pd.factorize(rows["term"])[0]
    order = np.argsort(code, kind="stable")
    number, p, code = rows["number"].to_numpy()[order], rows["p"].to_numpy()[order], code[order]
    start = np.searchsorted(code, np.arange(code[-1] + 2 if len(code) else 1))
    width = len(base)
    both, alone = np.zeros((width, width), np.int64), np.zeros((width, width), np.int64)
    by_group = np.argsort(number, kind="stable")
    cuts = np.searchsorted(number[by_group], np.arange(width + 1))
    for g in range(width):
        mine = by_group[cuts[g] : cuts[g + 1]]
        if not len(mine):
            continue
        # scatter: all postings of all terms of the group
        lengths = start[code[mine] + 1] - start[code[mine]]
        skipped = np.repeat(np.cumsum(lengths) - lengths, lengths)
        at = np.repeat(start[code[mine]], lengths) + np.arange(lengths.sum()) - skipped
        peer, theirs, own = number[at], p[at], np.repeat(p[mine], lengths)
        part = divided(own, theirs) - divided(own, base[peer]) - divided(base[g], theirs) + divided(base[g], base[peer])
        np.add.at(both[g], peer, part)
        # the group's own terms against every peer's baseline
        values, times = np.unique(p[mine], return_counts=True)
        for v, n in zip(values, times):
            alone[g] += n * (divided(v, base) - divided(base[g], base))
    return both + alone + alone.T


def index(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Postings (lang, source, term, count, p, q, number, bucket) of kept terms, and the groups' table.

    Groups have lang, source, number (from 0 in a lang), terms (V of the lang), base (probability of
    a term without occurrence, 1 without terms) and buckets. Sums are combined before each shuffle;
    the windows run over the sources of one term or of one lang.
    """
    docs = group_rows(docs)
    one_term = Window.partitionBy("lang", "term")
    sums = [F.sum("count").over(one_term).alias("lang_count"), F.sum("docs").over(one_term).alias("lang_docs"), F.min("source").over(one_term).alias("lead")]
    kept = term_counts(docs).select("lang", "source", "term", "count", *sums).where(F.col("lang_docs") >= LEAST_DOCS)
    kept = stored(kept.select("lang", "source", "term", "count", "lang_count", (F.col("lead") == F.col("source")).alias("lead")), "divergence-terms")

    totals = kept.groupBy("lang", "source").agg(F.sum("count").alias("total"), F.count("*").alias("postings"), F.sum(F.col("lead").cast("long")).alias("leads"))
    groups = docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").na.fill(0)
    one_lang = Window.partitionBy("lang")
    groups = groups.select(
        "lang", "source", "total",
        (F.row_number().over(one_lang.orderBy("source")) - 1).alias("number"),
        F.sum("leads").over(one_lang).alias("terms"),
        F.sum("total").over(one_lang).alias("lang_total"),
        F.ceil(F.sum("postings").over(one_lang) / POSTINGS_PER_BUCKET).cast("long").alias("buckets"),
    )
    base = F.coalesce(probability(F.lit(0), F.col("total"), F.col("terms")), F.lit(1))
    groups = stored(groups.withColumn("base", base.cast("long")), "divergence-groups")
    own = kept.join(groups, ["lang", "source"])
    p = probability(F.col("count"), F.col("total"), F.col("terms")).alias("p")
    q = probability(F.col("lang_count"), F.col("lang_total"), F.col("terms")).alias("q")
    bucket = F.pmod(F.xxhash64("term"), "buckets").alias("bucket")
    return own.select("lang", "source", "term", "count", p, q, "number", bucket), groups


def pair_values(postings: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item (the other source) and value of every pair of groups of a lang."""

    def run(key: tuple, rows: pd.DataFrame, peers: pd.DataFrame) -> pd.DataFrame:
        sums = accumulate(rows, peers.sort_values("peer")["base"].to_numpy())
        a, b = np.nonzero(sums)
        return pd.DataFrame({"lang": np.full(len(a), key[0], object), "a": a, "b": b, "part": sums[a, b]})

    every = F.explode(F.sequence(F.lit(0), F.col("buckets") - 1)).alias("bucket")
    peers = groups.where("buckets > 0").select("lang", F.col("number").alias("peer"), "base", every)
    got = postings.select("lang", "bucket", "number", "term", "p").groupBy("lang", "bucket").cogroup(peers.groupBy("lang", "bucket"))
    sums = got.applyInPandas(run, "lang string, a int, b int, part long").groupBy("lang", "a", "b").agg(F.sum("part").alias("part"))
    mine = groups.select("lang", "source", "terms", F.col("number").alias("a"), F.col("base").alias("p"))
    theirs = groups.select("lang", F.col("source").alias("item"), F.col("number").alias("b"), F.col("base").alias("q"))
    zero = F.expr("terms * ((p - q) * (p - q) div (p + q))")
    both = mine.join(theirs, "lang").where("a <> b").join(sums, ["lang", "a", "b"], "left")
    return both.select("lang", "source", "item", (zero + F.coalesce("part", F.lit(0))).alias("value"))


def compare(docs: DataFrame) -> DataFrame:
    """lang, source, part (pair or term), item, value, rank: all pairs of a lang, and the top terms of a group.

    Nulls in text, lang and source are ''. Repeated rows count each, and other columns are ignored.
    Groups without terms have pairs; a lang without kept terms gives pairs of value 0. A lang has as
    many pairs as its sources squared, so its sources, unlike its terms, are few enough for one
    accumulator a source. No documents give no rows.
    """
    postings, groups = index(docs)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pair_values(postings, groups).withColumn("rank", F.row_number().over(order))
    value = F.expr("(p - q) * (p - q) div (p + q)")
    tops = postings.where("p > q").select("lang", "source", F.col("term").alias("item"), value.alias("value"))
    tops = tops.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TOP)
    shape = lambda df, part: df.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")
    return shape(pairs, "pair").union(shape(tops, "term"))


SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents),
words AS (SELECT row, lang, source, unnest(words) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS lang_count FROM words GROUP BY lang, term HAVING count(DISTINCT row) >= 10),
counts AS (SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL),
langs AS (SELECT lang, count(*) AS v, sum(lang_count) AS lang_total FROM kept GROUP BY lang),
totals AS (SELECT lang, source, sum(n) AS total FROM counts GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM docs),
filled AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 2) // (coalesce(t.total, 0) + 2 * v) AS p,
    1 + CAST(1000000000 AS HUGEINT) * (lang_count + 2) // (lang_total + 2 * v) AS q
  FROM groups g JOIN kept k USING (lang) JOIN langs USING (lang)
    LEFT JOIN totals t USING (lang, source) LEFT JOIN counts c USING (lang, source, term)),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM filled a JOIN filled b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (
  SELECT lang, source, 'term' AS part, term AS item, CAST((p - q) * (p - q) // (p + q) AS BIGINT) AS value
  FROM filled WHERE n > 0 AND p > q),
both_parts AS (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM both_parts QUALIFY part = 'pair' OR rank <= 10
"""


def op13_divergence(spark, sf_dir):
    return compare(table(spark, sf_dir, "documents"))
