"""Toxicity by subword embeddings: averaged character n-gram vectors under a linear softmax.

A word is the mean of the vectors of its character n-grams (3 to 5, with word ends) and of itself,
all in one hashed table; a document is the mean of its words. Vectors and softmax weights are
trained together. A misspelt word shares most n-grams with the right one and so keeps its meaning.
With two classes the gradient of every vector is a multiple of the difference of the class weights,
so a step needs one weighted count over the sample. Scoring needs one number per table entry.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexmosaic.llm.common import documents, fold, labelled, stored, table

BUCKETS = 1 << 17
DIM = 8
NGRAMS = (3, 4, 5)
#: Toxic documents that training reads at most, and twice as many others.
SAMPLE = 1500
#: Table entries seen in fewer documents of the sample are left at zero.
LEAST_DOCS = 4
STEPS = 80
RATE = 0.05
#: Decay of the vectors in a step, times RATE; the best of six settings in cross-validation on the training folds of sf 0.1.
DECAY = 0.75
#: Texts scored at once.
CHUNK = 500
#: Labels of the ids with remainder 0 are held out.
FOLDS = 5
_WORD = re.compile(r"\w+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Table entries of all words one after the other, and the index of the word of each."""
    marked = [f"<{w}>" for w in words]
    flat = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    lengths = np.fromiter(map(len, marked), np.int64, len(marked))
    owner = np.repeat(np.arange(len(words)), lengths)
    ends = np.repeat(np.cumsum(lengths), lengths)
    at = np.arange(len(flat))
    ids = [np.fromiter((zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in words), np.int64, len(words)) % BUCKETS]
    owners = [np.arange(len(words))]
    h = np.zeros(len(flat), np.uint64)
    for n in range(1, max(NGRAMS) + 1):
        if n > len(flat):
            break
        h = h[: len(flat) - n + 1] * np.uint64(0x100000001B3) + flat[n - 1 :] + np.uint64(n)
        if n in NGRAMS:
            fits = at[: len(h)] + n <= ends[: len(h)]
            x = h[fits] * np.uint64(0x9E3779B97F4A7C15)
            ids.append((x >> np.uint64(64 - 17)).astype(np.int64))
            owners.append(owner[: len(h)][fits])
    return np.concatenate(ids), np.concatenate(owners)


def document_row(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Table entries of a document and their weights, which sum to 1 (none without words)."""
    words, counts = np.unique(np.array(words_of(text), object), return_counts=True) if text else ([], [])
    if not len(words):
        return np.zeros(0, np.int64), np.zeros(0)
    ids, owner = subwords(list(words))
    each = np.bincount(owner, minlength=len(words))
    total = np.bincount(ids, (counts / each)[owner], BUCKETS) / counts.sum()
    at = np.flatnonzero(total)
    return at, total[at]


def train(starts: np.ndarray, ids: np.ndarray, x: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, float]:
    """Fit vectors and softmax weights together; returns the score of each table entry, and a bias.

    Document d has the table entries ``ids[starts[d]:starts[d + 1]]`` with weights ``x``, no entry
    twice; ``x`` is changed in place.
    """
    seen = np.bincount(ids, minlength=BUCKETS) >= LEAST_DOCS
    doc = np.repeat(np.arange(len(labels), dtype=np.int32), np.diff(starts))
    for k in range(0, len(ids), 1 << 20):
        x[k : k + (1 << 20)] *= seen[ids[k : k + (1 << 20)]]

    def summed(by: np.ndarray, n: int, part) -> np.ndarray:
        """Sums of ``part(slice)`` by ``by``, in pieces of bounded size."""
        out = np.zeros(n)
        for k in range(0, len(by), 1 << 20):
            at = slice(k, k + (1 << 20))
            out += np.bincount(by[at], part(at), n)
        return out

    rng = np.random.default_rng(1)
    vectors = rng.normal(0, 0.1, (BUCKETS, DIM)) * seen[:, None]
    soft = rng.normal(0, 0.1, (2, DIM))
    bias = np.zeros(2)
    params = [vectors, soft, bias]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    # an entry is a small part of a document; bring the inputs to the order of 1
    unit = float(np.sqrt(np.dot(x, x) / max(1, np.count_nonzero(x)))) or 1.0
    x /= np.float32(unit)
    scale = 1.0
    for step in range(1, STEPS + 1):
        entry = (vectors @ (soft[1] - soft[0])).astype(np.float32)
        logit = summed(doc, len(labels), lambda at: x[at] * entry[ids[at]]) + bias[1] - bias[0]
        miss = weights * (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels)
        pull = summed(ids, BUCKETS, lambda at: x[at] * miss[doc[at]])
        toward = vectors.T @ pull
        grads = [pull[:, None] * (soft[1] - soft[0]), np.stack([-toward, toward]), np.array([-miss.sum(), miss.sum()])]
        for p, g, m, v in zip(params, grads, first, second):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= RATE * scale * (m / (1 - 0.9**step) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8) + (DECAY * p if p is vectors else 0))
        scale = 1 - step / STEPS
    return vectors @ (soft[1] - soft[0]) / unit, float(bias[1] - bias[0])


def fit(docs: DataFrame, labels: DataFrame, held: int = 0) -> tuple[np.ndarray, float]:
    """Scores of table entries, learnt from labels outside the held-out fold.

    The sample is at most 3 * SAMPLE documents; each returns its table entries, never its text. One
    task reads them into arrays of known size and trains, so the driver sees the model alone. If no
    document of one class is labelled, all entries are 0 and the bias says the known class.
    """
    sample, counts = labelled(documents(docs), labels, "toxic", {0: 2 * SAMPLE, 1: SAMPLE}, FOLDS, held)

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for doc_id, text, toxic in zip(b["doc_id"], b["text"], b["toxic"]):
                ids, x = document_row(text)
                yield pd.DataFrame({"doc_id": [doc_id], "toxic": [toxic], "ids": [ids.astype("<i4").tobytes()], "x": [x.astype("<f4").tobytes()]})

    got = stored(sample.mapInPandas(rows, "doc_id long, toxic int, ids binary, x binary"), "toxicity-sample")
    in_sample, entries = {0: 0, 1: 0}, 0
    for toxic, n, size in got.groupBy("toxic").agg(F.count("*"), F.sum(F.length("ids"))).collect():
        in_sample[toxic], entries = n, entries + size // 4
    total = sum(in_sample.values())
    if not in_sample[0] or not in_sample[1]:
        return np.zeros(BUCKETS), 5.0 if in_sample[1] else -5.0
    share = [counts[k] / sum(counts.values()) / (in_sample[k] / total) for k in (0, 1)]

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, labels = np.zeros(total + 1, np.int64), np.zeros(total)
        ids, x = np.empty(entries, np.int32), np.empty(entries, np.float32)
        d = 0
        for b in batches:
            for toxic, entry, weight in zip(*(b.column(c) for c in ("toxic", "ids", "x"))):
                part = np.frombuffer(entry.as_buffer(), "<i4")
                starts[d + 1], labels[d] = starts[d] + len(part), toxic.as_py()
                ids[starts[d] : starts[d + 1]], x[starts[d] : starts[d + 1]] = part, np.frombuffer(weight.as_buffer(), "<f4")
                d += 1
        model, bias = train(starts, ids, x, labels, np.array(share)[labels.astype(int)])
        yield pa.RecordBatch.from_pydict({"entries": [model.tobytes()], "bias": [bias]})

    in_order = got.repartition(1).sortWithinPartitions("doc_id", F.length("ids"), "ids")
    model = in_order.mapInArrow(learn, "entries binary, bias double").first()
    return np.frombuffer(bytes(model["entries"])), model["bias"]


def scores(texts: Iterable[str], entries: np.ndarray, bias: float) -> np.ndarray:
    """Score of each text, 0 to 1; one without words gets the bias alone."""
    words = [words_of(t) for t in texts]
    every = list(set().union(*words))
    known = {}
    if every:
        ids, owner = subwords(every)
        known = dict(zip(every, np.bincount(owner, entries[ids], len(every)) / np.bincount(owner, minlength=len(every))))
    logit = np.array([bias + sum(map(known.__getitem__, w)) / max(1, len(w)) for w in words])
    return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def score(docs: DataFrame, entries: np.ndarray, bias: float) -> DataFrame:
    """doc_id and score of every text."""
    shared = docs.sparkSession.sparkContext.broadcast((entries, bias))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for k in range(0, len(b), CHUNK):
                part = b.iloc[k : k + CHUNK]
                yield pd.DataFrame({"doc_id": part["doc_id"].array, "score": scores(part["text"], *shared.value)})

    return docs.select("doc_id", "text").mapInPandas(run, "doc_id long, score double")


def detect(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, score (0 to 1) and predicted (1 from 0.5 on).

    Null and empty texts get the score of no words, near the share of toxic labels. Rows repeat as
    they are; labels of unknown documents and other columns are ignored; empty tables give an empty
    result. A null id is not held out.
    """
    entries, bias = fit(docs, labels)
    got = score(documents(docs), entries, bias)
    held = F.coalesce(fold("doc_id", FOLDS) == 0, F.lit(False))
    return got.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows that score 0.5 or more, in their own columns.

    The text of a row decides for that row alone, whatever its id and the other rows of that id.
    """
    entries, bias = fit(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast((entries, bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, len(b), CHUNK):
                part = b.slice(k, CHUNK)
                texts = [t or "" for t in part.column(at).to_pylist()]
                yield part.filter(pa.array(scores(texts, *shared.value) < 0.5))

    at = docs.columns.index("text")
    return docs.mapInArrow(run, docs.schema)


def op3_toxicity(spark, sf_dir):
    return detect(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
