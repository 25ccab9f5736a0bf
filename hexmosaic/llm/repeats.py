"""Removal of long repeated word windows behind a count-min prefilter.

1. Each document's windows are counted under their anchors. The anchor of a window is the smallest
   hash of the grams inside it: equal windows have equal anchors, so the count of an anchor is never
   below that of its windows, and neighbouring windows share one, so there are far fewer to count.
   Tasks count the documents of their anchors in count-min sketches; the sketches are merged block by
   block, and what is left is one bit a cell: estimated in two documents or more.
2. A second pass over the texts gives the windows whose anchor is estimated repeated their digest.
   Only these are grouped exactly, within each task first, so that a window is asked for once a task
   however many documents hold it; single windows fall away, repeated ones all stay.
3. Windows that start in a document with a smaller id mark their words in the larger ones.

The bit table is the only thing broadcast. It has 8 cells an anchor up to a fixed number of bytes.
Beyond it, more windows pass the filter, which costs time but no result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import ceil, log2

import numpy as np
import pandas as pd
from pandas.util import hash_array
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexmosaic.llm.common import documents, small_side, stored, table

WINDOW = 50
GRAM = 25
#: Rows of the sketch; multipliers of their hashes (fixed odd numbers).
MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
BLOCK = 1 << 16
#: Bits of the table at most, over all rows.
MAX_BITS = 1 << 30
#: Anchors that a task gathers before it gives out a part of its sketch.
FLUSH = 1 << 22
#: Windows of a task that are combined at once.
ASKED_AT_ONCE = 1 << 21
BASE = 0x5851F42D4C957F2D
POWERS_MADE = 1 << 16


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, by doubling."""
    out = np.ones(max(n, 1), np.uint64)
    done = 1
    while done < n:
        step = np.uint64(pow(base, done, 1 << 64))
        out[done : 2 * done] = out[: min(done, n - done)] * step
        done *= 2
    return out[:n]


_POWERS: list[np.ndarray] = []


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, POWERS_MADE)
        _POWERS[:] = [powers(BASE, size), powers(pow(BASE, -1, 1 << 64), size)]
    return _POWERS[0][:n], _POWERS[1][:n]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def word_hashes(words: list[bytes]) -> np.ndarray:
    boxed = np.empty(len(words), object)
    boxed[:] = words
    return hash_array(boxed, categorize=False)


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Mixed polynomial hashes of all runs of ``n`` words."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    up, down = _tables(len(hashes) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * down[:-1], dtype=np.uint64)])
    return mixed((sums[n:] - sums[:-n]) * up[: len(hashes) - n + 1])


def sliding_min(x: np.ndarray, n: int) -> np.ndarray:
    span = 1
    out = x
    while 2 * span <= n:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    return np.minimum(out[: len(x) - n + 1], out[n - span :]) if span < n else out


def anchors(hashes: np.ndarray, window: int, gram: int) -> np.ndarray:
    """Anchor of the window at each start."""
    if len(hashes) < window:
        return np.zeros(0, np.uint64)
    return sliding_min(gram_hashes(hashes, gram), window - gram + 1)


def cells(of: np.ndarray, row: int, bits: int) -> np.ndarray:
    return (of * MULTIPLIERS[row]) >> np.uint64(64 - bits)


PARTS = "part long, sketch_row int, block long, once binary, more binary"


def sketch_parts(docs: DataFrame, bits: int, window: int, gram: int) -> DataFrame:
    """Partial sketches: for a block of cells, those counted once and those counted more often."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, held, n = TaskContext.get().partitionId(), [], 0
        for b in batches:
            for text in b["text"]:
                words = text.encode().split()
                if len(words) < window:
                    continue
                held.append(np.unique(anchors(word_hashes(words), window, gram)))
                n += len(held[-1])
                if n >= FLUSH:
                    yield from given(part, held)
                    held, n = [], 0
        if held:
            yield from given(part, held)

    def given(part: int, held: list[np.ndarray]) -> Iterator[pd.DataFrame]:
        every = np.concatenate(held)
        for row in range(len(MULTIPLIERS)):
            cell, n = np.unique(cells(every, row, bits), return_counts=True)
            blocks, starts = np.unique(cell // BLOCK, return_index=True)
            low, ends = (cell % BLOCK).astype("<u2"), [*starts[1:], len(cell)]
            rows = [(part, row, int(k), low[i:j][n[i:j] == 1].tobytes(), low[i:j][n[i:j] > 1].tobytes()) for k, i, j in zip(blocks, starts, ends)]
            yield pd.DataFrame(rows, columns=["part", "sketch_row", "block", "once", "more"])

    return docs.select("text").mapInPandas(count, PARTS)


def _merged(b: pd.DataFrame) -> np.ndarray:
    total = np.zeros(BLOCK, np.int64)
    for c, by in (("once", 1), ("more", 2)):
        total += by * np.bincount(np.frombuffer(b"".join(b[c]), "<u2"), minlength=BLOCK)
    return total


def merge_some(b: pd.DataFrame) -> pd.DataFrame:
    total = _merged(b)
    low = np.arange(BLOCK).astype("<u2")
    b = b.iloc[:1][["part", "sketch_row", "block"]].copy()
    b["once"], b["more"] = [low[total == 1].tobytes()], [low[total > 1].tobytes()]
    return b


def merge_all(b: pd.DataFrame) -> pd.DataFrame:
    out = b.iloc[:1][["sketch_row", "block"]].copy()
    out["repeated"] = [np.packbits(_merged(b) > 1).tobytes()]
    return out


def repeated_cells(docs: DataFrame, bits: int, window: int, gram: int) -> np.ndarray:
    """Bit per cell and row of the merged sketch: counted in two documents or more.

    At most 64 parts meet in a first merge and the merged ones in a second, so no group grows with
    the table; the driver gets ``len(MULTIPLIERS) * 2**bits`` bits and no more.
    """
    parts = sketch_parts(docs, bits, window, gram).withColumn("part", F.col("part").bitwiseAND(F.lit(-64)))
    some = parts.groupBy("part", "sketch_row", "block").applyInPandas(merge_some, PARTS)
    merged = some.groupBy("sketch_row", "block").applyInPandas(merge_all, "sketch_row int, block long, repeated binary")
    out = np.zeros((len(MULTIPLIERS), (1 << bits) // 8), np.uint8)
    for row, block, got in merged.toLocalIterator():
        out[row, block * BLOCK // 8 : (block + 1) * BLOCK // 8] = np.frombuffer(got, np.uint8)
    return out


def passing(of: np.ndarray, repeated: np.ndarray, bits: int) -> np.ndarray:
    """Which anchors the sketch estimates in two documents or more."""
    keep = np.ones(len(of), bool)
    for row in range(len(MULTIPLIERS)):
        c = cells(of, row, bits)
        keep &= (repeated[row, c >> np.uint64(3)] >> (7 - (c & np.uint64(7))).astype(np.uint8)) & 1 == 1
    return keep


FOUND = "doc_id long, text_key long, high long, low long, starts array<int>"


def runs_of(starts: np.ndarray) -> list[int]:
    """Sorted starts as first and last of each run of consecutive ones."""
    cut = np.flatnonzero(np.diff(starts) > 1)
    return np.stack([starts[np.r_[0, cut + 1]], starts[np.r_[cut, len(starts) - 1]]], 1).ravel().tolist()


def combined(held: list[tuple]) -> pd.DataFrame:
    """What a part of a task's windows comes to: runs that are surely repeated, and windows to ask for.

    Of equal windows those in the smallest document are given on with their digest; those in larger
    ones begin a repeat whatever other tasks find, and go as runs of starts, without a digest.
    """
    sizes = [len(x[2]) for x in held]
    doc, key = (np.repeat(np.array([x[i] for x in held], np.int64), sizes) for i in (0, 1))
    start, pair = np.concatenate([x[2] for x in held]), np.concatenate([x[3] for x in held])
    order = np.lexsort((start, key, doc, pair[:, 1], pair[:, 0]))
    doc, key, start, pair = doc[order], key[order], start[order], pair[order]
    fresh = np.r_[True, (pair[1:] != pair[:-1]).any(1)]
    least = doc[np.flatnonzero(fresh)[np.cumsum(fresh) - 1]]
    ask = doc == least
    out = pd.DataFrame({"doc_id": doc[ask], "text_key": key[ask], "high": pair[ask, 0], "low": pair[ask, 1]}).astype({"high": "Int64", "low": "Int64"})
    out["starts"] = [[int(x)] for x in start[ask]]
    sure = pd.DataFrame({"doc_id": doc[~ask], "text_key": key[~ask], "start": start[~ask]}).sort_values(["doc_id", "text_key", "start"])
    rows = [(d, k, None, None, runs_of(g.to_numpy())) for (d, k), g in sure.groupby(["doc_id", "text_key"])["start"]]
    return pd.concat([out, pd.DataFrame(rows, columns=out.columns).astype(out.dtypes.to_dict())])


def candidates(docs: DataFrame, bits: int, repeated, window: int, gram: int) -> DataFrame:
    """Windows that pass the sketch, under 128-bit digests, combined within each task."""

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n = [], 0
        for b in batches:
            for doc_id, key, text in zip(b["doc_id"], b["text_key"], b["text"]):
                words = text.encode().split()
                if len(words) < window:
                    continue
                each = anchors(word_hashes(words), window, gram)
                starts = np.flatnonzero(passing(each, repeated.value, bits))
                if not len(starts):
                    continue
                lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
                ends = np.cumsum(lengths)
                flat = b" ".join(words)
                begins = ends[starts] - lengths[starts]
                digests = b"".join([hashlib.blake2b(flat[i:j], digest_size=16).digest() for i, j in zip(begins.tolist(), (ends[starts + window - 1] - 1).tolist())])
                held.append((int(doc_id), int(key), starts.astype(np.int32), np.frombuffer(digests, "<i8").reshape(-1, 2)))
                n += len(starts)
                if n > ASKED_AT_ONCE:
                    yield combined(held)
                    held, n = [], 0
        if held:
            yield combined(held)

    return docs.mapInPandas(find, FOUND)


RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"


def removal(docs: DataFrame, window: int, with_text: bool) -> DataFrame:
    """Drop the words covered by windows that begin in ``runs`` (first and last of each run)."""

    def drop(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for doc_id, text, runs in zip(b["doc_id"].astype("object").where(b["doc_id"].notna(), None), b["text"], b["runs"]):
                words = text.encode().split()
                kept = words
                if runs is not None and len(runs) and len(words) >= window:
                    first, last = np.minimum(np.concatenate(list(runs)).reshape(-1, 2).T, len(words) - window)
                    edges = np.zeros(len(words) + 1, np.int64)
                    np.add.at(edges, first, 1)
                    np.add.at(edges, last + window, -1)
                    kept = [words[i] for i in np.flatnonzero(np.cumsum(edges)[:-1] == 0)]
                flat = b" ".join(kept)
                rows.append((doc_id, len(words), len(words) - len(kept), hashlib.sha256(flat).hexdigest(), flat.decode() if with_text else None))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in RESULT.split(", ")]).astype({"doc_id": "Int64"})

    return docs.select("doc_id", "text", "runs").mapInPandas(drop, RESULT)


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, with_text: bool = True) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256 and kept (the words left, or null).

    A word goes if it is covered by a window of ``window`` words whose word sequence also starts in
    a document with a smaller id. Null and empty texts have no words and shorter texts no window;
    rows of one id do not remove from each other, and rows with a null id neither remove nor lose
    words. Other columns are ignored; an empty table gives an empty result. Results do not depend
    on the size of the sketch. Whole copies lose all words to the first one and are not cut into
    windows, as the first one holds the same.
    """
    spark = docs.sparkSession
    docs = documents(docs).withColumn("text_key", F.xxhash64("text"))
    known = docs.where("doc_id is not null")
    same = stored(known.select("doc_id", "text_key", F.md5("text").alias("copy"), F.octet_length("text").alias("size")), "repeat-copies")
    firsts = stored(same.groupBy("copy").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"), "repeat-copy-firsts")
    copies = stored(same.join(firsts, "copy").where("doc_id > first").select("doc_id", "text_key").distinct(), "repeat-later-copies")
    once = known.join(small_side(copies, copies.count()), ["doc_id", "text_key"], "left_anti")

    size = same.agg(F.sum("size")).first()[0] or 0
    expected = size / 6 * 2 / (window - gram + 2)  # words of six bytes; two anchors in that many
    most = int(log2(MAX_BITS // len(MULTIPLIERS)))
    bits = min(most, max(16, ceil(log2(8 * expected + 1))))
    repeated = spark.sparkContext.broadcast(repeated_cells(once, bits, window, gram))

    found = stored(candidates(once, bits, repeated, window, gram), "repeat-windows")
    asked = found.where("high is not null").select("doc_id", "text_key", "high", "low", F.col("starts")[0].alias("start"))
    first = asked.groupBy("high", "low").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    first = stored(first.where("first < last").drop("last"), "repeat-firsts")
    later = asked.join(first, ["high", "low"]).where("doc_id > first").select("doc_id", "text_key", F.array("start", "start").alias("starts"))
    whole = copies.withColumn("starts", F.array(F.lit(0), F.lit((1 << 31) - 1)))
    every = later.union(found.where("high is null").select("doc_id", "text_key", "starts")).union(whole)
    runs = every.groupBy("doc_id", "text_key").agg(F.collect_list("starts").alias("runs"))
    return removal(docs.join(runs, ["doc_id", "text_key"], "left"), window, with_text)


SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
n AS (SELECT doc_id, words, len(words) AS n_words FROM w),
wins AS (
  SELECT doc_id, i AS start, md5(array_to_string(words[i:i + 49], ' ')) AS h
  FROM (SELECT doc_id, words, unnest(range(1, n_words - 48)) AS i FROM n WHERE n_words >= 50)),
firsts AS (SELECT h, min(doc_id) AS first FROM wins GROUP BY h HAVING min(doc_id) < max(doc_id)),
hit AS (
  SELECT DISTINCT doc_id, unnest(range(start, start + 50)) AS i
  FROM wins JOIN firsts USING (h) WHERE doc_id > first),
gone AS (SELECT doc_id, list(i) AS places, count(*) AS n_removed FROM hit GROUP BY doc_id),
left_over AS (
  SELECT n.doc_id, n_words, coalesce(n_removed, 0) AS n_removed,
    CASE WHEN n_removed IS NULL THEN words
         ELSE (SELECT list(word ORDER BY k) FROM (SELECT unnest(words) AS word, unnest(range(1, n_words + 1)) AS k) x WHERE NOT list_contains(places, k)) END AS kept
  FROM n LEFT JOIN gone ON gone.doc_id = n.doc_id)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(n_removed AS BIGINT) AS n_removed,
  sha256(coalesce(array_to_string(kept, ' '), '')) AS kept_sha256
FROM left_over
"""


def op2_repeats(spark, sf_dir):
    return remove_repeats(table(spark, sf_dir, "documents"), with_text=False).drop("kept")
