"""Similarity join on word n-grams: MinHash bands, then exact verification.

1. Texts become sets of word five-grams; texts of equal sets are copies and go on as one.
2. Each set has a signature for each of several bands ("tries"). Sets of equal signature in a band
   are candidates. All bands have one fixed length, the longest with which a pair at the threshold
   meets in some band with the target probability (a more similar pair more surely): plain banding
   in place of a forest, whose prefixes would adapt to the data. Sets of one signature are linked
   to their smallest one, never all pairs.
3. Within the components of these links all pairs are verified by their exact Jaccard index, as
   products of 0/1 matrices. Components of any size are cut into blocks of bounded size; tasks get
   a block, or two, and give out sums per document and links to a local root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexmosaic.llm.common import documents, kept_whole, row_key, stored, table
from hexmosaic.llm.components import components
from hexmosaic.llm.repeats import gram_hashes, word_hashes

WORDS, THRESHOLD = 5, 0.8
TRIES, DEPTH, RECALL = 24, 8, 0.9999
#: Bounds of a block of sets: members and five-grams.
BLOCK_SETS, BLOCK_GRAMS = 1024, 1 << 19
#: Columns of a 0/1 matrix at once.
COLUMNS = 2048


def prefix_length(tries: int, depth: int, threshold: float, recall: float) -> int:
    """Longest prefix with which a pair at the threshold meets in some trie with that probability.

    Starts at the full depth and shortens; 1 if none is enough.
    """
    length = depth
    while length > 1 and 1 - (1 - threshold**length) ** tries < recall:
        length -= 1
    return length


def gram_set(text: str, n: int) -> np.ndarray:
    """Sorted hashes of the word n-grams; all words as one, if there are fewer; empty without words."""
    words = text.encode().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = word_hashes(words)
    return np.unique(gram_hashes(hashes, min(n, len(hashes))))


def digest(grams: np.ndarray) -> bytes:
    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest()


class Forest:
    """MinHash signatures of a number of tries, as deep as the prefix in use."""

    def __init__(self, tries: int, length: int):
        rng = np.random.default_rng(5)
        self.tries, self.length = tries, length
        self.mask = rng.integers(0, 1 << 32, tries * length, dtype=np.uint32)
        self.factor = rng.integers(0, 1 << 31, tries * length, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        self.salt = rng.integers(0, 1 << 63, tries, dtype=np.uint64)

    def prefixes(self, grams: np.ndarray) -> np.ndarray:
        """One key per trie: its number and the values of the prefix, hashed."""
        low = (grams >> np.uint64(32)).astype(np.uint32)[:, None]
        least = None
        for k in range(0, len(low), 2048):
            m = ((low[k : k + 2048] ^ self.mask) * self.factor).min(0)
            least = m if least is None else np.minimum(least, m)
        key = self.salt.copy()
        for column in least.reshape(self.tries, self.length).T:
            key = (key ^ column.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
        return key.astype(np.int64)


SETS = "node binary, n_grams int, keys array<long>"


def signed(docs: DataFrame, n: int, forest: Forest) -> DataFrame:
    """Digest of the set (null without words), number of its n-grams and keys, for every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    types = {"doc_id": "Int64"} if kind == "bigint" else {}

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for doc_id, text in zip(b["doc_id"].astype("object").where(b["doc_id"].notna(), None), b["text"]):
                grams = gram_set(text, n)
                rows.append((doc_id, digest(grams), len(grams), forest.prefixes(grams)) if len(grams) else (doc_id, None, 0, None))
            yield pd.DataFrame(rows, columns=["doc_id", "node", "n_grams", "keys"]).astype(types)

    return docs.mapInPandas(sign, f"doc_id {kind}, {SETS}")


def intersections(left: list[np.ndarray], right: list[np.ndarray] | None) -> np.ndarray:
    """Sizes of the intersections of all sets of one list with all of another (or itself)."""
    every = left + (right or [])
    owner = np.repeat(np.arange(len(every)), [len(x) for x in every])
    _, word, counts = np.unique(np.concatenate(every), return_inverse=True, return_counts=True)
    shared = counts[word] > 1
    owner, word = owner[shared], np.unique(word[shared], return_inverse=True)[1]
    order = np.argsort(word, kind="stable")
    owner, word = owner[order], word[order]
    total = np.zeros((len(left), len(right or left)), np.float64)
    last = int(word[-1]) + 1 if len(word) else 0
    for k in range(0, last, COLUMNS):
        i, j = np.searchsorted(word, [k, k + COLUMNS])
        x = np.zeros((len(every), min(COLUMNS, last - k)), np.float32)
        x[owner[i:j], word[i:j] - k] = 1
        total += x[: len(left)] @ (x[len(left) :].T if right else x.T)
    return total


def linked(left: list[np.ndarray], right: list[np.ndarray] | None, threshold: float) -> np.ndarray:
    """Which pairs reach the threshold, in whole numbers; a set is not linked to itself."""
    t = Fraction(str(threshold))
    inter = intersections(left, right).astype(np.int64)
    size = lambda x: np.array([len(s) for s in x], np.int64)
    union = size(left)[:, None] + size(right or left)[None, :] - inter
    yes = inter * t.denominator >= union * t.numerator
    if right is None:
        np.fill_diagonal(yes, False)
    return yes


def local_roots(yes: np.ndarray) -> np.ndarray:
    """Smallest index of each row's component in a symmetric 0/1 matrix."""
    root = np.arange(len(yes))
    while True:
        low = np.minimum(root, np.where(yes, root[None, :], len(yes)).min(1, initial=len(yes)))
        low = low[low]
        if (low == root).all():
            return root
        root = low


FOUND = "node binary, links long, root binary"


def verified(nodes: list[bytes], copies: np.ndarray, yes: np.ndarray) -> pd.DataFrame:
    """Number of linked documents and local root of each set with a link."""
    links = yes @ copies
    root = local_roots(yes)
    at = np.flatnonzero(links)
    return pd.DataFrame({"node": [nodes[i] for i in at], "links": links[at].astype("int64"), "root": [nodes[i] for i in root[at]]})


def unpack(sets) -> tuple[list[bytes], np.ndarray, list[np.ndarray]]:
    """Members of a block, each set once, in order of their digests."""
    by_node = {s["node"]: s for s in sets}
    order = sorted(by_node)
    return order, np.array([by_node[k]["copies"] for k in order], np.int64), [np.frombuffer(by_node[k]["grams"], np.uint64) for k in order]


def verify_blocks(members: DataFrame, docs: DataFrame, n: int, threshold: float) -> DataFrame:
    """Exact links among the sets of each component.

    ``members``: node, component, copies, n_grams and the id of a document with that text.
    """
    sizes = members.groupBy("component").agg(F.greatest(F.ceil(F.count("*") / BLOCK_SETS), F.ceil(F.sum("n_grams") / BLOCK_GRAMS)).cast("int").alias("blocks"))
    sizes = stored(sizes, "component-sizes")
    placed = members.join(sizes, "component").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))

    def grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            sets = [gram_set(t, n) for t in b["text"]]
            b = b.assign(grams=[s.tobytes() for s in sets])[[digest(s) == k for s, k in zip(sets, b["node"])]]
            yield b[["component", "block", "node", "copies", "grams"]]

    texts = docs.select(F.col("doc_id").alias("rep"), "text").join(placed, "rep")
    sets = texts.select("component", "block", "node", "copies", "text").mapInPandas(grams, "component binary, block int, node binary, copies long, grams binary")
    packed = sets.groupBy("component", "block").agg(F.collect_list(F.struct("node", "copies", "grams")).alias("sets"))
    packed = stored(packed, "blocks")

    def inside(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for sets in b["sets"]:
                nodes, copies, grams = unpack(sets)
                yield verified(nodes, copies, linked(grams, None, threshold))

    def across(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for first, second in zip(b["left"], b["right"]):
                (a, n_a, x), (c, n_c, y) = unpack(first), unpack(second)
                yes = np.zeros((len(a) + len(c),) * 2, bool)
                yes[: len(a), len(a) :] = linked(x, y, threshold)
                yes |= yes.T
                yield verified(a + c, np.concatenate([n_a, n_c]), yes)

    number = F.sequence(F.lit(0), F.col("blocks") - 1)
    pairs = sizes.where("blocks > 1").select("component", "blocks", F.explode(number).alias("i"))
    pairs = pairs.where("i < blocks - 1").select("component", "i", F.explode(F.sequence(F.col("i") + 1, F.col("blocks") - 1)).alias("j"))
    left = packed.select("component", F.col("block").alias("i"), F.col("sets").alias("left"))
    right = packed.select("component", F.col("block").alias("j"), F.col("sets").alias("right"))
    both = pairs.join(left, ["component", "i"]).join(right, ["component", "j"])
    return packed.select("sets").mapInPandas(inside, FOUND).union(both.select("left", "right").mapInPandas(across, FOUND))


def join_similar(docs: DataFrame, n: int = WORDS, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """Per document: doc_id, class_id, n_links.

    Two documents are linked if the Jaccard index of their sets of word n-grams is ``threshold`` or
    more; a text with fewer than n words is one n-gram of all its words. n_links counts the linked
    documents, copies included; class_id is the smallest id of the document's connected component.
    Null and empty texts have no n-grams and so no link; rows with a null id take no part, their
    class is null. Rows of one id are documents of their own. Other columns are ignored; an empty
    table gives an empty result. N-grams are compared by 64-bit hashes.
    """
    return classes_of(documents(docs), n, threshold, recall)


def classes_of(docs: DataFrame, n: int = WORDS, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """``join_similar`` of documents (doc_id, text without nulls) whose doc_id is of any ordered type."""
    forest = Forest(TRIES, prefix_length(TRIES, DEPTH, threshold, recall))
    rows = stored(signed(docs, n, forest), "signatures")
    known = rows.where("doc_id is not null and n_grams > 0")
    sets = known.groupBy("node").agg(F.min(F.struct("doc_id", "n_grams", "keys")).alias("x"), F.count("*").alias("copies"))
    sets = stored(sets.select("node", F.col("x.doc_id").alias("rep"), "x.n_grams", "x.keys", "copies"), "sets")

    keyed = sets.select("node", F.explode("keys").alias("key"))
    heads = keyed.groupBy("key").agg(F.min("node").alias("head"), F.count("*").alias("n")).where("n > 1").select("key", "head")
    heads = stored(heads, "trie-runs")
    edges = keyed.join(heads, "key").select(F.col("node").alias("a"), F.col("head").alias("b"))
    found = stored(components(edges).select("node", F.col("root").alias("component")), "candidates")

    members = found.join(sets.select("node", "rep", "n_grams", "copies"), "node")
    links = stored(verify_blocks(members, docs, n, threshold), "links")
    total = links.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(links.select(F.col("node").alias("a"), F.col("root").alias("b")))
    roots = stored(roots, "class-roots")
    least = stored(roots.join(sets.select("node", "rep"), "node").groupBy("root").agg(F.min("rep").alias("class")), "class-ids")
    classes = roots.join(least, "root").select("node", "class").join(total, "node")
    labelled = stored(sets.select("node", "rep", "copies").join(classes, "node", "left"), "classes")

    got = rows.select("doc_id", "node").join(labelled, "node", "left")
    alone = F.col("doc_id").isNull() | F.col("rep").isNull()
    return got.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.coalesce("class", "rep")).alias("class_id"),
        F.when(alone, F.lit(0)).otherwise(F.col("copies") - 1 + F.coalesce("links", F.lit(0))).cast("long").alias("n_links"),
    )


def keep_first(docs: DataFrame, repeats: bool = True) -> DataFrame:
    """``docs`` with one document of each class, that of the smallest id, in their own columns.

    Every row is a document of its own, with the class of its own text; a null id comes after all
    others. Of rows of one id, the one of the smallest text digest is first; those equal to it in id
    and text stay with it if ``repeats``, else exactly one row of a class stays.
    """
    rows = kept_whole(docs, key=row_key()) if repeats else stored(kept_whole(docs, key=row_key(F.monotonically_increasing_id())), "rows")
    texts = rows.select(F.col("key").alias("doc_id"), F.coalesce("row.text", F.lit("")).alias("text"))
    gone = classes_of(texts).where("doc_id <> class_id").select(F.col("doc_id").alias("key"))
    return rows.join(gone, "key", "left_anti").select("row.*")


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
n AS (SELECT * FROM w WHERE len(words) > 0),
sh AS (
  SELECT DISTINCT doc_id, hash(array_to_string(words[i:i + least(len(words), 5) - 1], ' ')) AS g
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 5, 0) + 2)) AS i FROM n)),
size AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
inter AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT i.a, i.b FROM inter i JOIN size x ON x.doc_id = i.a JOIN size y ON y.doc_id = i.b
  WHERE 10 * i.n >= 8 * (x.n + y.n - i.n)),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
class AS (SELECT a, least(a, min(b)) AS class_id FROM reach GROUP BY a),
degree AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
SELECT doc_id, coalesce(c.class_id, doc_id) AS class_id, CAST(coalesce(d.n_links, 0) AS BIGINT) AS n_links
FROM documents LEFT JOIN class c ON c.a = doc_id LEFT JOIN degree d ON d.a = doc_id
"""


def op6_jaccard(spark, sf_dir):
    return join_similar(table(spark, sf_dir, "documents"))
