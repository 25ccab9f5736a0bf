"""Small tables with the cases that every operator must take."""

from __future__ import annotations

DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string, size int, start int, word string, _row int, _size int, row int, taken int"


def odd_documents(spark, texts=(), lang="en"):
    """Nulls in every column, empty and very long texts, repeated rows, clashing column names."""
    long_text = " ".join(f"w{i % 977}x{i % 13}" for i in range(30_000))
    rows = [
        (1, "the quick brown fox jumps over the lazy dog again and again today", "en", "a", 5, "k", 1, 1, "w"),
        (2, "the quick brown fox jumps over the lazy dog again and again today", "en", "a", 5, "k", 1, 1, "w"),
        (3, None, None, None, None, None, None, None, None),
        (4, "", "de", "b", 0, "k", 1, 1, "w"),
        (5, " \t\n ", "de", "b", 0, "k", 1, 1, "w"),
        (6, long_text, "fr", "c", None, "k", 1, 1, "w"),
        (7, long_text, "fr", "c", None, "k", 1, 1, "w"),
        (8, "12 34 56 \U0001f600 éñß 0", None, "b", 5, "k", 1, 1, "w"),
        (9, "word", "es", None, 5, "k", 1, 1, "w"),
        (None, "a row without an id but with some words in it", "en", "a", 5, "k", 1, 1, "w"),
        (1, "the quick brown fox jumps over the lazy dog again and again today", "en", "a", 5, "k", 1, 1, "w"),
    ]
    rows += [(100 + i, t, lang, f"s{i % 3}", len(t), "k", 1, 1, "w") for i, t in enumerate(texts)]
    return spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], DOCS)


def empty_documents(spark):
    return spark.createDataFrame([], DOCS)
