"""Quality by Bradley-Terry ranking: scores learnt from pairs, cut at a quantile.

Every label says only that its document is better than one of the other label. A score is linear
in a document's features, and the chance that it beats another one is the logistic function of the
difference; the weights minimise the logistic loss over such pairs. Only differences count in
training, so the cut comes from a quantile of scores: that of the share of labels 0, taken on
scores of documents that the scoring half of the model has not seen.

All labelled documents train. What is more than a task takes is dealt to blocks by a hash of the id; each
block ranks its own documents, the model is the mean of the blocks' weights, and the cut the mean of the
blocks' quantiles, on scores by the blocks of the other half of the documents.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexmosaic.llm.common import all_labelled, documents, fold, stored, table

#: Documents that one task ranks, and documents of the rarer label that each block gets at least, if there are so many.
BLOCK = 4000
LEAST = 1000
FOLDS = 5
#: Pairs in which a document of the rarer side of a pairing takes part, at least.
PAIRS = 16
BUCKETS = 1 << 11
STEPS = 150
RATE = 0.05
DECAY = 1e-3
#: Score at the cut, and how steep scores rise there.
CUT = 0.3
SLOPE = 1.0
CHUNK = 2000
_RUNS = re.compile(r"(.)\1{2,}", re.DOTALL)
_PLAIN = 13
WIDTH = _PLAIN + BUCKETS


def features(text: str) -> np.ndarray:
    """Shape of a text (lengths, shares of kinds of characters, repetition) and its hashed byte pairs."""
    out = np.zeros(WIDTH, np.float32)
    if not text:
        return out
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    words, lines = text.split(), text.split("\n")
    kinds = np.bincount(raw, minlength=256)
    n, m = len(raw), max(1, len(words))
    counts = Counter(words)
    upper, lower, digits = kinds[65:91].sum(), kinds[97:123].sum(), kinds[48:58].sum()
    marks = kinds[[33, 34, 39, 40, 41, 44, 46, 58, 59, 63]].sum()
    white = kinds[[9, 10, 11, 12, 13, 32]].sum()
    other = kinds[33:127].sum() - upper - lower - digits - marks
    out[:_PLAIN] = [
        np.log1p(len(words)), np.log1p(len(lines)), np.log1p(n / m), len(counts) / m, max(counts.values(), default=0) / m,
        1 - len(set(lines)) / len(lines), upper / n, digits / n, marks / n, other / n, white / n, kinds[128:].sum() / n,
        sum(len(x.group()) for x in _RUNS.finditer(text)) / len(text),
    ]
    if n > 1:
        pair = (raw[:-1].astype(np.uint32) << 8 | raw[1:]) * np.uint32(0x9E3779B1) >> np.uint32(21)
        out[_PLAIN:] = np.sqrt(np.bincount(pair, minlength=BUCKETS) / (n - 1))
    return out


def pairs(good: np.ndarray, bad: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Winners and losers: PAIRS rounds, each joining shuffled rows of both labels, the shorter repeated."""
    longest = max(len(good), len(bad))
    rounds = [[np.resize(rng.permutation(side), longest) for side in (good, bad)] for _ in range(PAIRS)]
    return tuple(np.concatenate([r[k] for r in rounds]) for k in (0, 1))


def rank(x: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Weights that minimise the logistic loss of score differences, by Adam over all pairs."""
    rng = np.random.default_rng(5)
    winners, losers = pairs(np.flatnonzero(labels == 1), np.flatnonzero(labels == 0), rng)
    w, first, second = np.zeros(x.shape[1]), np.zeros(x.shape[1]), np.zeros(x.shape[1])
    for step in range(1, STEPS + 1):
        s = x @ w.astype(np.float32)
        miss = 1 / (1 + np.exp(np.clip(s[winners] - s[losers], -30, 30)))
        pull = np.bincount(losers, miss, len(x)) - np.bincount(winners, miss, len(x))
        g = (pull.astype(np.float32) @ x) / len(winners) + DECAY * w
        first += 0.1 * (g - first)
        second += 0.01 * (g * g - second)
        w -= RATE * (1 - step / STEPS) * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return w


def cut_of(scores: np.ndarray, labels: np.ndarray, low_share: float) -> float:
    """The score below which ``low_share`` of all labelled documents lie, each label at its true share."""
    at = np.argsort(scores, kind="stable")
    share = np.where(labels == 0, low_share / max(1, (labels == 0).sum()), (1 - low_share) / max(1, (labels == 1).sum()))
    below = np.searchsorted(np.cumsum(share[at]), low_share - 1e-9)
    low, high = scores[at[min(below, len(at) - 1)]], scores[at[min(below + 1, len(at) - 1)]]
    return float((low + high) / 2)


def _standard(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Standardised columns, their mean and spread."""
    mean, spread = x.mean(0), x.std(0)
    # what hardly varies is not blown up
    spread = np.maximum(spread, max(1e-4, float(np.median(spread))) * 0.1)
    return (x - mean) / spread, mean, spread


def learn(x: np.ndarray, labels: np.ndarray, low_share: float) -> tuple[np.ndarray, float]:
    """Weights of raw features and the cut. Ranks of two halves place the cut, of all rows the scores."""
    x, mean, spread = _standard(x)
    half = np.zeros(len(x), int)
    for k in (0, 1):
        at = np.flatnonzero(labels == k)
        half[at] = np.arange(len(at)) % 2
    whole = rank(x, labels)
    cuts = []
    for k in (0, 1):
        rest, seen = half != k, half == k
        if all((labels[rest] == c).any() and (labels[seen] == c).any() for c in (0, 1)):
            w = rank(x[rest], labels[rest])
            scale = (x @ whole).std() / ((x @ w).std() or 1.0)
            cuts.append(cut_of(x[seen] @ w * scale, labels[seen], low_share))
    cut = float(np.mean(cuts)) if cuts else cut_of(x @ whole, labels, low_share)
    return whole / spread, cut + float(whole @ (mean / spread))


def block_cut(x: np.ndarray, labels: np.ndarray, whole: np.ndarray, other: np.ndarray, low_share: float) -> float:
    """Cut of the whole model's scores, from scores by weights that have not seen these rows."""
    own, unseen = x @ whole, x @ other
    scale = own.std() / (unseen.std() or 1.0)
    return cut_of((unseen - unseen.mean()) * scale + own.mean(), labels, low_share)


def _matrix(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of stored rows."""
    return np.frombuffer(b"".join(rows["x"]), np.float32).reshape(len(rows), -1), rows["quality"].to_numpy()


def _mean(value: str) -> Column:
    """Mean over the blocks, added in their order, so that reruns agree to the last bit."""
    ordered = F.array_sort(F.collect_list(F.struct("block", value)))
    return F.aggregate(ordered, F.lit(0.0), lambda s, v: s + v[value]) / F.count("*")


def blocks(got: DataFrame, sizes: dict[tuple[int, int], int]) -> tuple[DataFrame, int]:
    """Rows (doc_id, quality, x, block) of all documents, and the number of halves.

    ``sizes`` are rows by (half, quality). Block k is of half k % halves. A block holds about BLOCK
    rows; rows of the rarer label go to as many blocks of their half as it takes to give each LEAST
    of them, or all there are.
    """
    halves = 2 if all(sizes.get((h, k)) for h in (0, 1) for k in (0, 1)) else 1
    n = {(h, k): sum(v for (g, c), v in sizes.items() if c == k and g % halves == h) for h in range(halves) for k in (0, 1)}
    each = max(1, -(-max(n[h, 0] + n[h, 1] for h in range(halves)) // BLOCK))
    half = F.col("half") % halves
    copies = F.lit(1)
    for (h, k), rows in n.items():
        copies = F.when((half == h) & (F.col("quality") == k), min(each, max(1, -(-LEAST * each // max(1, rows))))).otherwise(copies)
    dealt = got.select("doc_id", "quality", "x", "salt", half.alias("half"), F.explode(F.sequence(F.lit(0), copies - 1)).alias("copy"))
    at = F.pmod(F.pmod(F.xxhash64("doc_id", "x", "salt"), F.lit(each)) + F.col("copy"), F.lit(each))
    dealt = dealt.select("doc_id", "quality", "x", (at * halves + F.col("half")).cast("int").alias("block"))
    return dealt.repartition(each * halves, "block"), halves


def fit_blocks(got: DataFrame, sizes: dict[tuple[int, int], int], low_share: float) -> tuple[np.ndarray, float]:
    """Weights and cut of more documents than one task takes."""
    dealt, halves = blocks(got, sizes)

    def train(rows: pd.DataFrame) -> pd.DataFrame:
        x, y = _matrix(rows.sort_values(["doc_id", "x"]))
        if not (y == 0).any() or not (y == 1).any():
            return pd.DataFrame({"block": [], "i": [], "w": []})
        x, _, spread = _standard(x)
        return pd.DataFrame({"block": rows["block"].iloc[0], "i": np.arange(WIDTH), "w": rank(x, y) / spread})

    ranked = stored(dealt.groupBy("block").applyInPandas(train, "block int, i int, w double"), "quality-weights")
    means = ranked.groupBy((F.col("block") % halves).alias("half"), "i").agg(_mean("w").alias("w"), F.count("*").alias("n")).toPandas()
    means = means.sort_values(["half", "i"])
    w, n = (means[c].to_numpy().reshape(-1, WIDTH) for c in ("w", "n"))
    whole = (w * n).sum(0) / n.sum(0)

    def place(rows: pd.DataFrame) -> pd.DataFrame:
        x, y = _matrix(rows.sort_values(["doc_id", "x"]))
        if not (y == 0).any() or not (y == 1).any():
            return pd.DataFrame({"block": [], "cut": []})
        block = rows["block"].iloc[0]
        return pd.DataFrame({"block": [block], "cut": [block_cut(x, y, whole, w[(block + 1) % halves], low_share)]})

    cuts = dealt.groupBy("block").applyInPandas(place, "block int, cut double")
    return whole, cuts.agg(_mean("cut").alias("cut")).first()["cut"]


def fit(docs: DataFrame, labels: DataFrame, held: int = 0) -> tuple[np.ndarray, float]:
    """Weights and cut, from all labels outside the held-out fold.

    Up to BLOCK documents are ranked in one task, more in blocks; the driver sees the model alone. If
    one label is missing, weights are 0 and every score says the other label.
    """
    known, counts = all_labelled(documents(docs), labels, "quality", (0, 1), FOLDS, held)
    low_share = counts[0] / max(1, counts[0] + counts[1])

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            # very many rows of one id are dealt by hundreds
            salt = b.groupby("doc_id").cumcount() // 100
            yield pd.DataFrame({"doc_id": b["doc_id"], "quality": b["quality"], "x": [features(t).tobytes() for t in b["text"]], "salt": salt})

    got = stored(known.mapInPandas(rows, "doc_id long, quality int, x binary, salt int"), "quality-features")
    got = got.withColumn("half", F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(2)).cast("int"))
    sizes = {(r[0], r[1]): r[2] for r in got.groupBy("half", "quality").count().collect()}
    good, bad = (sum(n for (_, k), n in sizes.items() if k == c) for c in (1, 0))
    if not good or not bad:
        return np.zeros(WIDTH), -9.0 if good else 9.0
    if good + bad > BLOCK:
        return fit_blocks(got, sizes, low_share)

    def train(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        w, cut = learn(*_matrix(pd.concat(batches)), low_share)
        yield pd.DataFrame({"w": [w.tobytes()], "cut": [cut]})

    one = got.select("doc_id", "quality", "x").repartition(1).sortWithinPartitions("doc_id", "x")
    model = one.mapInPandas(train, "w binary, cut double").first()
    return np.frombuffer(bytes(model["w"])), model["cut"]


def scores(texts: pd.Series, weights: np.ndarray, cut: float) -> np.ndarray:
    """Score of each text, 0 to 1, CUT at the cut."""
    raw = np.array([features(t) @ weights for t in texts]) - cut
    return 1 / (1 + np.exp(-np.clip(SLOPE * raw + np.log(CUT / (1 - CUT)), -30, 30)))


def assess(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, score (0 to 1) and predicted (1 from CUT on).

    Null and empty texts get the score of a text without features. Rows repeat as they are; labels
    of unknown documents and other columns are ignored; without any label all scores are low. A null
    id is not held out. Empty tables give an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for k in range(0, len(b), CHUNK):
                part = b.iloc[k : k + CHUNK]
                yield pd.DataFrame({"doc_id": part["doc_id"].array, "score": scores(part["text"], *shared.value)})

    got = documents(docs).mapInPandas(run, "doc_id long, score double")
    held = F.coalesce(fold("doc_id", FOLDS) == 0, F.lit(False))
    return got.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def op12_quality(spark, sf_dir):
    return assess(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
