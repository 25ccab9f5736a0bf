"""Exact top-k inner products by pruning blocks of vectors.

Vectors are dealt into blocks of consecutive ids; a block carries its forward index (the integer
matrix) and the maximum and minimum of each term. A query's score in a block is at most the sum of
the larger products with these bounds. Queries visit the blocks of a range in the order of these
sums and stop when the next sum is below their k-th score, so that skipped blocks cannot hold a
better vector. A first pass over each query's own range gives a k-th score to start from.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hexmosaic.llm.common import stored, table

K = 5
#: Vectors of a block, blocks of a range, queries that meet a range in one task.
BLOCK, RANGE, QUERIES = 256, 32, 512


def quantised(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id, dim and q, the components times ``scale`` rounded down, of the vectors that take part.

    Null vectors, and those with null or non-finite components, are left out, as are null ids.
    """
    x = F.transform("embedding", lambda c: c.cast("double"))
    fine = F.forall(x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(fine)
    q = F.transform(x, lambda c: F.floor(c * scale).cast("long"))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), q.alias("q"), F.size("embedding").alias("dim"))


def matrix(column) -> np.ndarray:
    """Rows as float64 while every sum of products stays exact in it, else as int64."""
    whole = np.stack(column.to_list()).astype(np.int64) if len(column) else np.zeros((0, 0), np.int64)
    large = int(np.abs(whole.astype(float)).max(initial=0))
    return whole.astype(float) if large * large * max(1, whole.shape[1]) < 2**52 else whole


class Ranges:
    """Blocks of one range, ready for queries."""

    def __init__(self, rows: pd.DataFrame):
        rows = rows.sort_values("vec_id", kind="stable")
        self.ids, self.x = rows["vec_id"].to_numpy(), matrix(rows["q"])
        cuts = range(0, len(rows), BLOCK)
        self.blocks = [slice(i, i + BLOCK) for i in cuts]
        self.top = np.stack([self.x[b].max(0) for b in self.blocks])
        self.low = np.stack([self.x[b].min(0) for b in self.blocks])

    def search(self, query_ids, queries: np.ndarray, floor: np.ndarray, k: int) -> pd.DataFrame:
        """Best ``k`` of the range for each query, left out where surely below ``floor``."""
        up, down = np.maximum(queries, 0).astype(float), np.minimum(queries, 0).astype(float)
        bounds = up @ self.top.T.astype(float) + down @ self.low.T.astype(float)
        if self.x.dtype != float or queries.dtype != float:  # sums may be rounded; stay above them
            bounds += 1e-9 * (np.abs(queries).astype(float) @ np.maximum(np.abs(self.top), np.abs(self.low)).T.astype(float))
        order = np.argsort(-bounds, axis=1, kind="stable")
        bounds = np.take_along_axis(bounds, order, 1)
        best = [np.zeros((0, 2), np.int64)] * len(queries)
        for turn in range(len(self.blocks)):
            alive = np.flatnonzero(bounds[:, turn] >= floor)
            if not len(alive):
                break
            for block in np.unique(order[alive, turn]):
                here = alive[order[alive, turn] == block]
                at = self.blocks[block]
                scores = (queries[here] @ self.x[at].T).astype(np.int64)
                for i, s in zip(here, scores):
                    keep = np.flatnonzero((s >= floor[i]) & (self.ids[at] != query_ids[i]))
                    if len(keep):
                        both = np.concatenate([best[i], np.stack([s[keep], keep + at.start], 1)])
                        both = both[np.lexsort((self.ids[both[:, 1]], -both[:, 0]))[:k]]
                        best[i] = both
                        if len(both) == k:
                            floor[i] = max(floor[i], both[-1, 0])
        rows = [(q, int(self.ids[j]), int(s)) for q, b in zip(query_ids, best) for s, j in b]
        return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"])


FOUND = "query_id long, vec_id long, score long"


def search(rows: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Candidates of queries (vec_id, dim, q, range, floor) among rows of the same dim and range.

    Queries of a range are cut into groups of a bounded number; the range's rows go to each group,
    so no task holds more than one range and one group.
    """

    def run(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
        right = right.sort_values("vec_id", kind="stable")
        floor = right["floor"].to_numpy(dtype=float)
        return Ranges(left).search(right["vec_id"].to_numpy(), matrix(right["q"]), np.where(np.isnan(floor), -np.inf, floor), k)

    keys = ["dim", "range", "group"]
    asked = queries.select(*[F.col(c).alias(c) for c in (*keys, "vec_id", "q", "floor")])
    spread = queries.select(*[F.col(c).alias(c) for c in keys]).distinct()
    dealt = rows.join(spread, ["dim", "range"]).select(*[F.col(c).alias(c) for c in (*keys, "vec_id", "q")])
    return dealt.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(run, FOUND)


def top_k(vectors: DataFrame, is_query, k: int = K) -> DataFrame:
    """The ``k`` highest integer inner products of each query: query_id, rank, vec_id, score.

    ``is_query`` is a condition on vec_id. Candidates are all other rows of the same length; ties go
    to the smaller vec_id. Vectors that are null or hold null or non-finite components take no part.
    Rows of a repeated vec_id are candidates of their own, but never of a query of that id; such a
    query counts once, by its first vector in array order. Other columns are ignored; an empty table
    gives an empty result, and an only vector finds nothing.
    """
    rows = stored(quantised(vectors), "topk-vectors")
    n = rows.count()
    ranges = max(1, ceil(n / (BLOCK * RANGE)))
    # ranges of consecutive ids, of about the same number of rows
    cuts = rows.approxQuantile("vec_id", [i / ranges for i in range(1, ranges)], 0.1 / ranges) if ranges > 1 and n else []
    place = F.lit(0)
    if cuts:
        place = F.aggregate(F.array(*[F.lit(c) for c in sorted(set(cuts))]), F.lit(0), lambda a, c: a + (F.col("vec_id") > c).cast("int"))
    rows = stored(rows.withColumn("range", place), "topk-ranges")
    asked = rows.where(is_query).groupBy("vec_id").agg(F.min(F.struct("q", "dim", "range")).alias("x")).select("vec_id", "x.*")
    asked = asked.withColumnRenamed("range", "own")
    asked = stored(asked, "topk-queries")
    groups = max(1, ceil(asked.count() / QUERIES))
    asked = asked.withColumn("group", F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int"))

    first = search(rows, asked.withColumnRenamed("own", "range").withColumn("floor", F.lit(None).cast("long")), k)
    first = stored(first, "topk-first")
    floors = first.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score")).alias("floor"))
    floors = floors.select(F.col("query_id").alias("vec_id"), "floor")
    dims = rows.select("dim", "range").distinct()
    others = asked.join(dims, "dim").where("range <> own").join(floors, "vec_id", "left")
    more = search(rows, others.drop("own"), k)
    ranked = first.unionByName(more).withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


SQL = """
WITH ok AS (
  SELECT vec_id, list_transform(embedding, lambda c: CAST(floor(CAST(c AS DOUBLE) * 256) AS BIGINT)) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id,
    CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM r WHERE rank <= 5
"""


def op10_topk(spark, sf_dir):
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
