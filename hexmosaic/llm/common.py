"""Helpers that several operators share: input tables, files in the shared folder, word rules."""

from __future__ import annotations

import re
import uuid
from functools import reduce

import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hexmosaic.session import shared_folder

#: A word is a run of anything but space, tab, line feed, vertical tab, form feed and return.
#: ``bytes.split()`` without arguments cuts at exactly these bytes.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(docs: DataFrame, *extra: str) -> DataFrame:
    """``doc_id`` as long and ``text`` without nulls, plus the named columns; all others go."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), *extra)


def word_count(text: str | Column) -> Column:
    """Number of words, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fold(doc_id: str | Column, mod: int) -> Column:
    """Remainder of the CRC-32 of the id's decimal text."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % mod


def _known(labels: DataFrame, label: str, kinds: tuple[int, ...], folds: int, held: int) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, label) of all labelled ids outside the held-out fold, each with its greatest label; counts by label."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    known = known.agg(F.max(label).cast("int").alias(label)).where(fold("doc_id", folds) != held)
    return known, {k: 0 for k in kinds} | {r[0]: r[1] for r in known.groupBy(label).count().collect()}


def all_labelled(docs: DataFrame, labels: DataFrame, label: str, kinds: tuple[int, ...], folds: int, held: int) -> tuple[DataFrame, dict[int, int]]:
    """doc_id, text and label of every document with a label of ``kinds``; counts of labels. Rows as in ``labelled``."""
    known, counts = _known(labels, label, kinds, folds, held)
    ids = small_side(known.where(F.col(label).isin(*kinds)), sum(counts[k] for k in kinds))
    return docs.join(ids, "doc_id").select("doc_id", "text", label), counts


def labelled(docs: DataFrame, labels: DataFrame, label: str, most: dict[int, int], folds: int, held: int) -> tuple[DataFrame, dict[int, int]]:
    """doc_id, text and label of at most ``most[k]`` documents of each label k, by hash; all labels' counts.

    A document labelled several times counts once, with its greatest label. Rows of the held-out
    fold, and null ids or labels, are left out before.
    """
    known, counts = _known(labels, label, tuple(most), folds, held)
    order = F.xxhash64("doc_id", F.lit(17))
    picked = [known.where(F.col(label) == k).orderBy(order, "doc_id").limit(n) for k, n in most.items()]
    ids = docs.sparkSession.createDataFrame(reduce(DataFrame.union, picked).toPandas(), f"doc_id long, {label} int")
    return docs.join(F.broadcast(ids), "doc_id").select("doc_id", "text", label), counts


def row_key(*more: Column) -> Column:
    """Binary key of a row: its doc_id (in order, null last), a digest of its text, and ``more`` longs.

    Without ``more``, only rows equal in id and text share a key. A null text is an empty one.
    """
    digits = lambda x: F.lpad(F.hex(x), 16, "0")
    number = F.concat(F.lit("00"), digits(F.col("doc_id").cast("long").bitwiseXOR(F.lit(-(1 << 63)))))
    text = F.md5(F.coalesce("text", F.lit("")))
    return F.unhex(F.concat(F.coalesce(number, F.lit("01" + "0" * 16)), text, *map(digits, more)))


def new_folder(spark: SparkSession, kind: str) -> str:
    """Path of a new folder below the shared one; the caller's writer creates it."""
    return f"{shared_folder(spark)}/{kind}-{uuid.uuid4().hex}"


def stored(df: DataFrame, kind: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back.

    A plan above it neither recomputes ``df`` nor depends on the executors that made it.
    """
    path = new_folder(df.sparkSession, kind)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI, for binary files that tasks write or read themselves.

    Hadoop's names of the S3 scheme, which Spark paths use, are taken as well.
    """
    return pafs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", uri))


def kept_whole(docs: DataFrame, **more: Column) -> DataFrame:
    """Each row in one struct column ``row``, beside ``more``: no name of ``docs`` can clash with theirs."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *[c.alias(n) for n, c in more.items()])


#: A table that is joined to whole texts is broadcast up to so many rows (each of a few numbers).
BROADCAST_ROWS = 2_000_000


def small_side(df: DataFrame, rows: int) -> DataFrame:
    """``df`` to be broadcast if it has no more than BROADCAST_ROWS rows, else for a shuffled join.

    ``rows`` is its measured size. The results are the same; a broadcast spares shuffling the texts.
    """
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df
