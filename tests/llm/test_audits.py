"""Filter audit, quality ranking and source divergence."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from hexmosaic.llm import divergence, filter_audit, quality
from hexmosaic.llm.common import table
from tests.llm.data import empty_documents, odd_documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LABELS = "doc_id long, quality int, toxic int"

# --- filter audit -------------------------------------------------------------------------


def brute_audit(rows, labels):
    """rows: (doc_id, text, lang); labels: (doc_id, quality, toxic)."""
    first = {}
    for d, t, _ in rows:
        if d is not None:
            first[t or ""] = min(first.get(t or "", d), d)
    parts = defaultdict(list)
    for d, t, lang in rows:
        t = t or ""
        words = WORD.findall(t)
        failed = "A" * (len(words) < 200) + "B" * (2 * len(set(words)) < len(words))
        failed += "C" * (100 * len(re.findall("[A-Z]", t)) > 3 * len(t)) + "D" * bool(re.search("[#$%&*|]", t))
        failed += "E" * (d is not None and first[t] < d)
        good, toxic = (any(i is not None and i == d and x[k] == 1 for i, *x in labels) for k in (0, 1))
        parts[lang or ""].append((failed, good, toxic))
    out = []
    for part, docs in parts.items():
        shapley, some = Counter(), []
        for order in permutations("ABCDE"):
            left = docs
            for step, f in enumerate(order, 1):
                gone, left = [x for x in left if f in x[0]], [x for x in left if f not in x[0]]
                shapley[f] += len(gone)
                redundant = sum(f in x[0] for x in docs) - len(gone)
                alone = sum(x[0] == f for x in docs)
                some.append((part, "".join(order), step, f, len(left), len(gone), redundant, alone, sum(x[1] for x in gone), sum(x[2] for x in gone)))
        out += [(*r, shapley[r[3]]) for r in some]
    return sorted(out)


def test_audit_equals_brute_force(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choices(["Ab", "cd", "e#", "XY", "zz", "q1", "é"], k=rng.choice([5, 199, 200, 350]))) for _ in range(20)]
    texts += [" ".join(f"w{rng.randint(0, 400)}" for _ in range(n)) for n in (199, 200, 400)] + ["", None]
    rows = [(rng.choice([None, i, i, i, i // 2]), rng.choice(texts), rng.choice(["en", "de", None, ""])) for i in range(150)]
    labels = [(rng.choice([None, rng.randint(0, 150)]), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    got = filter_audit.audit(docs, spark.createDataFrame(labels, LABELS))
    assert sorted(map(tuple, got.collect())) == brute_audit(rows, labels)


def test_audit_of_odd_rows(spark):
    docs = odd_documents(spark).withColumns({"part": F.lit("x"), "bits": F.lit(1), "digest": F.lit("d"), "n": F.lit(2), "good": F.lit(True), "first": F.lit(0)})
    labels = spark.createDataFrame([(1, 1, 0), (1, None, 1), (None, 1, 1), (99, 1, 1)], LABELS).withColumn("part", F.lit("y"))
    rows = [(r.doc_id, r.text, r.lang) for r in docs.collect()]
    got = filter_audit.audit(docs, labels)
    assert sorted(map(tuple, got.collect())) == brute_audit(rows, [tuple(r)[:3] for r in labels.collect()])
    assert filter_audit.audit(empty_documents(spark), labels).count() == 0
    assert filter_audit.audit(docs, labels.limit(0)).agg(F.sum("good_lost") + F.sum("toxic_lost")).first()[0] == 0


def test_merges_equal_sets():
    rng = random.Random(1)
    for _ in range(300):
        lists = [sorted(rng.sample(range(60), rng.choice([0, 1, 3, 40]))) for _ in range(rng.randint(0, 5))]
        assert filter_audit.union(*lists) == sorted(set().union(*lists))
        a, b = (sorted(rng.sample(range(60), rng.choice([0, 1, 7, 50]))) for _ in range(2))
        assert filter_audit.difference(a, b) == sorted(set(a) - set(b))
        x, at = rng.randint(0, 60), rng.randint(0, len(a))
        assert filter_audit.gallop(a, x, at) == max(at, sum(v < x for v in a))


def test_merges_gallop():
    class Counted(list):
        reads = 0

        def __getitem__(self, i):
            Counted.reads += 1
            return super().__getitem__(i)

    long, short = Counted(range(0, 200_000, 2)), [7, 100_001, 150_000]
    assert filter_audit.difference(short, long) == [7, 100_001]
    assert len(filter_audit.union(long, short)) == 100_002
    assert Counted.reads < 400


def test_lists_are_sorted_and_cut_into_ranges(spark, sf):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20")
    try:
        lists = filter_audit.posting_lists(table(spark, sf, "documents"), table(spark, sf, "labels")).collect()
        got = filter_audit.op11_filter_audit(spark, sf).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sum(r.n for r in lists) == table(spark, sf, "documents").count() and max(r.n for r in lists) <= 20
    assert all(list(r[f]) == sorted(set(r[f])) for r in lists for f in filter_audit.FILTERS)
    ends = sorted((r.part, r.first_id, r.last_id) for r in lists)
    assert all(a[0] != b[0] or a[2] < b[1] for a, b in zip(ends, ends[1:]))
    rows = [(r.doc_id, r.text, r.lang) for r in table(spark, sf, "documents").collect()]
    assert sorted(map(tuple, got)) == brute_audit(rows, [tuple(r) for r in table(spark, sf, "labels").select("doc_id", "quality", "toxic").collect()])


# --- quality ------------------------------------------------------------------------------


def test_quality_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    got = quality.op12_quality(spark, sf).toPandas().merge(table(spark, sf, "labels").toPandas(), on="doc_id")
    held = got[got["held_out"]]
    assert (held["held_out"] == [zlib.crc32(str(d).encode()) % 5 == 0 for d in held["doc_id"]]).all()
    hit = held["predicted"] == held["quality"]
    assert hit.mean() > 0.95 and hit[held["quality"] == 1].mean() > 0.97 and hit[held["quality"] == 0].mean() > 0.8
    good, bad = held["score"][held["quality"] == 1].to_numpy(), held["score"][held["quality"] == 0].to_numpy()
    assert (good[:, None] > bad[None, :]).mean() > 0.95
    assert got["score"].between(0, 1).all() and ((got["score"] >= 0.3) == (got["predicted"] == 1)).all()


def test_ranks_learn_from_pairs_alone():
    rng = np.random.default_rng(2)
    labels = np.repeat([0, 1], [300, 60])
    x = rng.normal(0, 1, (360, 4)).astype(np.float32)
    x[:, 1] += labels * 4
    w = quality.rank(x, labels)
    assert np.argmax(np.abs(w)) == 1 and w[1] > 0
    winners, losers = quality.pairs(np.flatnonzero(labels == 1), np.flatnonzero(labels == 0), rng)
    assert (labels[winners] == 1).all() and (labels[losers] == 0).all() and set(winners) | set(losers) == set(range(360))
    # what all documents share says nothing about an order
    assert np.allclose(quality.rank(x + np.float32([5, 0, 0, 0]), labels), w, atol=1e-3)


def test_cut_is_a_quantile_of_weighted_scores():
    scores, labels = np.array([1.0, 2, 3, 4, 5, 6]), np.array([0, 0, 0, 1, 1, 1])
    assert quality.cut_of(scores, labels, 0.5) == 3.5
    # labels 0 weigh 1/12 each, labels 1 a quarter each
    assert quality.cut_of(scores, np.array([0, 1, 0, 0, 1, 1]), 0.25) == 2.5
    assert quality.cut_of(scores[::-1], np.array([1, 1, 0, 0, 1, 0]), 0.25) == 2.5


def test_quality_learns_from_every_label(spark):
    """What only the last 600 of 2,600 low labels show, in the order of a hash of the id, is learnt."""
    ids = spark.range(6_500).where(quality.fold("id", 5) != 0).select("id", (F.col("id") % 2).alias("good"))
    order = Window.partitionBy("good").orderBy(F.xxhash64("id", F.lit(17)))
    ids = ids.withColumn("k", F.row_number().over(order))
    kind = F.when(F.col("good") == 1, "some words of a text").when(F.col("k") <= 2_000, "12 34 567 890").otherwise("some words of a tune")
    docs = ids.select(F.col("id").alias("doc_id"), F.concat_ws(" ", kind, kind, F.col("id").cast("string")).alias("text"))
    unseen = next(d for d in range(6_500, 9_999) if zlib.crc32(str(d).encode()) % 5 == 0)
    docs = docs.union(spark.createDataFrame([(unseen, f"some words of a tune some words of a tune {unseen}")], docs.schema))
    labels = ids.select(F.col("id").alias("doc_id"), F.col("good").cast("int").alias("quality"), F.lit(0).alias("toxic"))
    got = quality.assess(docs, labels).where("held_out").collect()
    assert len(got) == 1 and got[0].predicted == 0


def test_blocks_hold_every_document_and_both_labels(spark, monkeypatch):
    monkeypatch.setattr(quality, "BLOCK", 100)
    monkeypatch.setattr(quality, "LEAST", 20)
    rows = spark.range(1_000).select(F.col("id").alias("doc_id"), (F.col("id") % 50 != 0).cast("int").alias("quality"), F.lit(b"x").alias("x"), F.lit(0).alias("salt"))
    rows = rows.withColumn("half", (F.col("doc_id") % 4 == 0).cast("int"))
    sizes = {(r[0], r[1]): r[2] for r in rows.groupBy("half", "quality").count().collect()}
    dealt, halves = quality.blocks(rows, sizes)
    got = dealt.groupBy("block").agg(F.sum("quality").alias("good"), F.sum(1 - F.col("quality")).alias("bad"), F.min(F.col("doc_id") % 4).alias("low")).collect()
    assert halves == 2 and len(got) == 16 and sum(r.good for r in got) == 980 and all(r.bad == 10 for r in got)
    assert all((r.low == 0) == (r.block % 2 == 1) for r in got) and dealt.select("doc_id").distinct().count() == 1_000
    # with one document of a label there are no halves, and every block gets it
    dealt, halves = quality.blocks(rows.where("quality = 1 or doc_id = 0"), {(0, 1): 735, (1, 1): 245, (1, 0): 1})
    assert halves == 1 and dealt.where("doc_id = 0").count() == dealt.select("block").distinct().count() == 10


def test_quality_of_odd_rows(spark):
    odd = odd_documents(spark, [f"plain words {i} in a row" if i % 2 else f"## $$ {i} %% ##" for i in range(60)])
    odd = odd.withColumns({"quality": F.lit(1), "score": F.lit(0.5), "x": F.lit("x")})
    labels = spark.createDataFrame([(100 + i, i % 2, 0) for i in range(60)] + [(None, 1, 1), (5, None, None), (99999, 1, 1), (100, 0, 0)], LABELS)
    got = quality.assess(odd, labels).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.doc_id is not None and r.doc_id >= 100]
    assert np.mean([r.predicted == r.doc_id % 2 for r in held]) > 0.95
    assert [r.held_out for r in got if r.doc_id is None] == [False]
    assert quality.assess(empty_documents(spark), labels).count() == 0
    assert {r.predicted for r in quality.assess(odd, labels.limit(0)).collect()} == {0}
    assert {r.predicted for r in quality.assess(odd, labels.where("quality = 1")).collect()} == {1}


# --- divergence ---------------------------------------------------------------------------


def brute_divergence(rows, least_docs=10):
    """rows: (text, lang, source). Every group against every term, without an index."""
    docs = defaultdict(list)
    for text, lang, source in rows:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        docs[lang or "", source or ""].append(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text))
    out = []
    for lang in {k[0] for k in docs}:
        groups = sorted(s for g, s in docs if g == lang)
        held = Counter(t for s in groups for d in docs[lang, s] for t in set(d))
        kept = sorted(t for t, n in held.items() if n >= least_docs)

        def chances(count, kept=kept):
            total = sum(count[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 1_000_000_000 * (count[t] + 2) // total for t in kept}

        counts = {s: Counter(t for d in docs[lang, s] for t in d) for s in groups}
        p = {s: chances(counts[s]) for s in groups}
        q = chances(sum(counts.values(), Counter()))
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in groups:
            pairs = sorted((-sum(f(p[s][t], p[o][t]) for t in kept), o.encode()) for o in groups if o != s)
            tops = sorted((-f(p[s][t], q[t]), t.encode()) for t in kept if counts[s][t] > 0 and p[s][t] > q[t])[:10]
            for part, found in (("pair", pairs), ("term", tops)):
                out += [(lang, s, part, item.decode(), -v, k) for k, (v, item) in enumerate(found, 1)]
    return sorted(out)


@pytest.mark.parametrize("postings", [1 << 17, 40])
def test_divergence_equals_brute_force(spark, monkeypatch, postings):
    monkeypatch.setattr(divergence, "POSTINGS_PER_BUCKET", postings)
    monkeypatch.setattr(divergence, "TERMS_AT_ONCE", 50)
    rng = random.Random(6)
    words = ["The", "the", "éa", "Éa", "x1y", "don't", "A", "\U0001f600", "straße", *[f"w{chr(97 + i)}" for i in range(25)]]
    rows = []
    for i in range(400):
        source = rng.choice(["s0", "s0", "s1", "s2", None, "é"])
        some = words[: rng.choice([3, 10, 30])] if source != "s2" else words[20:]
        rows.append((" ".join(rng.choices(some, k=rng.randint(0, 12))), rng.choice(["en", "de", None]), source))
    rows += [(None, "fr", "only"), ("...", "fr", "other"), ("rare words here", "xx", "a"), ("no", "xx", "b"), ("lone", "zz", "a")]
    docs = spark.createDataFrame(rows, "text string, lang string, source string").repartition(5)
    assert sorted(map(tuple, divergence.compare(docs).collect())) == brute_divergence(rows)


def test_divergence_of_odd_rows(spark):
    docs = odd_documents(spark, ["some words Repeat"] * 12, None).withColumns({"term": F.lit("t"), "count": F.lit(1), "base": F.lit(1), "number": F.lit(1), "lead": F.lit(1)})
    rows = [(r.text, r.lang, r.source) for r in docs.collect()]
    assert sorted(map(tuple, divergence.compare(docs).collect())) == brute_divergence(rows)
    assert divergence.compare(empty_documents(spark)).count() == 0


def test_probabilities_are_exact_for_large_counts(spark):
    cases = [(0, 0, 1), (10**13, 10**15, 10**9), (10**15, 10**15, 1), (123456789012, 987654321098765, 7)]
    df = spark.createDataFrame(cases, "count long, total long, size long")
    got = df.select("count", "total", "size", divergence.probability(F.col("count"), F.col("total"), F.col("size")).alias("p")).collect()
    assert all(r.p == 1 + 10**9 * (r["count"] + 2) // (r.total + 2 * r.size) for r in got)


def test_no_pairs_of_postings_leave_a_task(spark, sf):
    postings, groups = divergence.index(table(spark, sf, "documents"))
    plan = divergence.pair_values(postings, groups)._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert "term" not in " ".join(joins) and "FlatMapCoGroupsInPandas" in plan
