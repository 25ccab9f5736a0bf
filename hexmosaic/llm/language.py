"""Language identification by string kernels: Nystroem landmarks and kernel ridge regression.

The kernel of two texts is the blended spectrum of character n-grams (1 to 3), by presence: shared
n-grams over the root of the product of their numbers. N-grams are exact up to a hashed table. A few
texts of each language are landmarks; the others are described by their kernels with the landmarks,
whitened (Nystroem), and one ridge regression per language against the rest is solved in closed form.
Scoring a batch is two matrix products: presence by landmarks, and kernels by weights.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexmosaic.llm.common import documents, fold, table

NGRAMS = 3
BITS = 14
#: Landmarks and training texts of each language, at most.
LANDMARKS, SAMPLE = 32, 300
RIDGE = 1e-2
#: Texts in one matrix product.
CHUNK = 256
FOLDS, HELD = 4, 2
UNKNOWN = "und"
_SPACES = re.compile(r"[\W\d_]+")


def presence(text: str) -> np.ndarray:
    """Which entries of the table the n-grams of a text fill. Case is folded; what is no letter is a space."""
    flat = np.frombuffer(f" {_SPACES.sub(' ', text.lower())} ".encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    out = np.zeros(1 << BITS, bool)
    gram = np.zeros(len(flat), np.uint64)
    for n in range(1, NGRAMS + 1):
        if n > len(flat):
            break
        gram = (gram[: len(flat) - n + 1] << np.uint64(21)) | flat[n - 1 :]  # code points have 21 bits
        out[((gram + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)] = True
    return out


def normalised(texts: list[str]) -> np.ndarray:
    x = np.stack([presence(t) for t in texts]).astype(np.float32)
    return x / np.sqrt(x.sum(1, keepdims=True))


class Model:
    """Landmarks (table entries by landmark) and weights (landmarks by language)."""

    def __init__(self, languages: list[str], landmarks: np.ndarray, weights: np.ndarray):
        self.languages, self.landmarks, self.weights = languages, landmarks, weights

    def scores(self, texts: list[str]) -> np.ndarray:
        kernels = normalised(texts) @ self.landmarks
        return np.concatenate([kernels, np.ones((len(texts), 1), np.float32)], 1) @ self.weights


def solve(presences: np.ndarray, langs: list[str], is_landmark: np.ndarray) -> Model:
    """Nystroem features of all rows by the landmark rows, then ridge regression per language."""
    languages = sorted(set(langs))
    marks = presences[is_landmark]
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(float))
    good = values > 1e-6 * values.max()
    whiten = vectors[:, good] / np.sqrt(values[good])
    x = (presences @ marks.T).astype(float) @ whiten
    x = np.concatenate([x, np.ones((len(x), 1))], 1)
    y = np.array([[1.0 if lang == k else 0.0 for k in languages] for lang in langs])
    # every language counts alike
    w = 1 / y.sum(0)[[languages.index(lang) for lang in langs]]
    beta = np.linalg.solve(x.T @ (x * w[:, None]) + RIDGE * np.eye(x.shape[1]), x.T @ (y * w[:, None]))
    return Model(languages, np.ascontiguousarray(marks.T), np.concatenate([whiten @ beta[:-1], beta[-1:]]).astype(np.float32))


def fit(docs: DataFrame) -> Model | None:
    """Learn from text and lang outside the held-out fold; None if no text there has letters.

    The languages' first SAMPLE rows in an order by hash; each returns one bit a table entry. The
    languages themselves are collected: they are as many as the values of ``lang``.
    """
    known = docs.where((fold("doc_id", FOLDS) != HELD) & F.col("lang").isNotNull())
    names = [r[0] for r in known.select("lang").distinct().collect()]
    order = F.xxhash64("doc_id", F.lit(23))
    # the rank limit per language is applied before the shuffle as well
    picked = None
    for name in sorted(names):
        one = known.where(F.col("lang") == name).select("doc_id", "lang", order.alias("turn")).orderBy("turn", "doc_id").limit(SAMPLE)
        picked = one if picked is None else picked.union(one)
    if picked is None:
        return None
    ids = docs.sparkSession.createDataFrame(picked.drop("lang").distinct().toPandas(), "doc_id long, turn long")
    sample = known.join(F.broadcast(ids), "doc_id").select("doc_id", "turn", "lang", "text")

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            b = b[[any(map(str.isalpha, t)) for t in b["text"]]]
            yield pd.DataFrame({"doc_id": b["doc_id"], "turn": b["turn"], "lang": b["lang"], "bits": [np.packbits(presence(t)).tobytes() for t in b["text"]]})

    got = sample.mapInPandas(rows, "doc_id long, turn long, lang string, bits binary").toPandas()
    got = got.sort_values(["lang", "turn", "doc_id", "bits"])
    if got.empty:
        return None
    x = np.unpackbits(np.frombuffer(b"".join(got["bits"]), np.uint8)).reshape(len(got), -1).astype(np.float32)
    x /= np.sqrt(x.sum(1, keepdims=True))
    return solve(x, got["lang"].tolist(), (got.groupby("lang").cumcount() < LANDMARKS).to_numpy())


def identify(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred and score (0 to 1).

    A null text, or one without a letter, is ``und`` with score 0, and so is every text if there is
    nothing to learn from. The score is the share of the best language in the softmax of all
    regressions. Rows repeat as they are, a null id is not held out, other columns are ignored, and
    an empty table gives an empty result.
    """
    docs = documents(docs, F.col("lang").cast("string").alias("lang"))
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for b in batches:
            for k in range(0, len(b), CHUNK):
                part = b.iloc[k : k + CHUNK]
                lang, score = np.full(len(part), UNKNOWN, object), np.zeros(len(part))
                ok = np.array([model is not None and any(map(str.isalpha, t)) for t in part["text"]])
                if ok.any():
                    s = model.scores(part["text"][ok].tolist()).astype(float)
                    p = np.exp(8 * (s - s.max(1, keepdims=True)))
                    lang[ok] = np.array(model.languages, object)[s.argmax(1)]
                    score[ok] = (1 / p.sum(1)).clip(0, 1)
                yield pd.DataFrame({"doc_id": part["doc_id"].array, "lang_pred": lang, "score": score})

    got = docs.select("doc_id", "text").mapInPandas(run, "doc_id long, lang_pred string, score double")
    held = F.coalesce(fold("doc_id", FOLDS) == HELD, F.lit(False))
    return got.select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op4_language(spark, sf_dir):
    return identify(table(spark, sf_dir, "documents"))
