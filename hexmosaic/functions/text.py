"""Names: normalisation and character-trigram similarity, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalise_name(name: Column) -> Column:
    """Lower case, punctuation and symbols removed, runs of blanks collapsed.

    Letters of every script stay, so Khmer names are compared as written.
    """
    bare = F.regexp_replace(F.lower(name), r"[\p{P}\p{S}]+", "")
    return F.trim(F.regexp_replace(bare, r"\s+", " "))


def trigrams(normalised: Column) -> Column:
    """Distinct character trigrams of the name padded with two blanks before and one after.

    An empty or missing name has none.
    """
    padded = F.concat(F.lit("  "), normalised, F.lit(" "))
    grams = F.transform(F.sequence(F.lit(1), F.length(padded) - 2), lambda i: F.substring(padded, i, F.lit(3)))
    return F.when(F.length(normalised) > 0, F.array_distinct(grams)).otherwise(
        F.array().cast("array<string>")
    )


def jaccard(a: Column, b: Column) -> Column:
    """Shared over all distinct elements; 0 when both sides are empty."""
    shared = F.size(F.array_intersect(a, b)).cast("double")
    total = F.size(a) + F.size(b) - shared
    return F.when(total > 0, shared / total).otherwise(F.lit(0.0))


def name_similarity(a: Column, b: Column) -> Column:
    """Jaccard similarity of the trigram sets of two raw names, in 0..1."""
    return jaccard(trigrams(normalise_name(a)), trigrams(normalise_name(b)))
