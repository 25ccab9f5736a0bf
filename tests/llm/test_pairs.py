"""Operators on pairs: Jaccard join, decontamination, top-k search, components."""

from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from hexmosaic.llm import decontaminate, jaccard, topk
from hexmosaic.llm.common import table
from hexmosaic.llm.components import components
from tests.llm.data import empty_documents, odd_documents

# --- Jaccard join -------------------------------------------------------------------------


def grams(text, n=5):
    w = (text or "").encode().split()
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def brute_join(rows, threshold=0.8):
    """(doc_id, class_id, n_links) of every row; rows are documents of their own."""
    sets = [grams(t) if d is not None else set() for d, t in rows]
    links = [[] for _ in rows]
    for i, j in combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and both * 1000 >= round(threshold * 1000) * len(sets[i] | sets[j]):
            links[i].append(j)
            links[j].append(i)
    out = []
    for i, (d, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            new = set(links[todo.pop()]) - seen
            seen |= new
            todo += new
        out.append((d, min((rows[k][0] for k in seen), default=d) if d is not None else None, len(links[i])))
    return sorted(out, key=str)


def near_rows(seed, groups=6, size=12):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randint(0, 9999)}"
    rows = []
    for _ in range(groups):
        base = [word() for _ in range(rng.randint(3, 120))]
        for _ in range(rng.randint(1, size)):
            w = list(base)
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = word()
            rows.append((len(rows), " ".join(w)))
    return rows + [(len(rows) + i, rows[i][1]) for i in range(5)] + [(900, None), (901, ""), (902, ""), (None, rows[0][1]), (3, rows[3][1])]


@pytest.mark.parametrize("seed", [1, 2])
def test_join_equals_brute_force(spark, monkeypatch, seed):
    if seed == 2:  # many small blocks
        monkeypatch.setattr(jaccard, "BLOCK_SETS", 2)
        monkeypatch.setattr(jaccard, "COLUMNS", 16)
    rows = near_rows(seed)
    got = jaccard.join_similar(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, got.collect()), key=str) == brute_join(rows)


def test_join_of_odd_rows(spark):
    odd = odd_documents(spark)
    got = jaccard.join_similar(odd)
    assert sorted(map(tuple, got.collect()), key=str) == brute_join([(r.doc_id, r.text) for r in odd.collect()])
    assert jaccard.join_similar(empty_documents(spark)).count() == 0
    kept = jaccard.keep_first(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [1, 1, 3, 4, 5, 6, 8, 9]


def test_join_of_a_large_near_group_makes_no_pairs(spark):
    rng = random.Random(5)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(600):
        w = list(base)
        w[rng.randrange(200)] = f"x{i}"
        rows.append((i, " ".join(w)))
    got = jaccard.join_similar(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.class_id, r.n_links) for r in got} == {(0, 599)}


def test_prefix_is_the_longest_that_reaches_the_recall():
    for tries, t, recall in ((24, 0.8, 0.9999), (10, 0.5, 0.9), (64, 0.9, 0.999)):
        n = jaccard.prefix_length(tries, 12, t, recall)
        miss = lambda p: (1 - t**p) ** tries
        assert 1 - miss(n) >= recall > 1 - miss(n + 1) or n == 12
    assert jaccard.prefix_length(1, 8, 0.1, 0.999) == 1


def test_pairs_at_the_threshold_meet_in_a_trie():
    rng = np.random.default_rng(3)
    p = jaccard.prefix_length(jaccard.TRIES, jaccard.DEPTH, 0.8, jaccard.RECALL)
    forest, missed = jaccard.Forest(jaccard.TRIES, p), 0
    for _ in range(400):
        x = rng.integers(0, 1 << 63, 100).astype(np.uint64)
        a, b = x[:90], x[10:]  # 80 of 100
        missed += not (forest.prefixes(a) == forest.prefixes(b)).any()
    assert missed <= 2


@pytest.mark.parametrize("seed", range(3))
def test_components_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(50)] + [(i, i + 1) for i in range(100, 140)] + [(200, i) for i in range(201, 240)]
    root = {x: x for e in edges for x in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = components(spark.createDataFrame(edges, "a long, b long"))
    assert dict(got.collect()) == {k: v for k, v in root.items() if any(k in e and e[0] != e[1] for e in edges)}
    assert got.count() == len(dict(got.collect()))


# --- decontamination ----------------------------------------------------------------------


def test_masks_meet_every_window():
    places = [{i + k for i, c in enumerate(m) if c == "1"} for m in decontaminate.MASKS for k in range(decontaminate.WINDOW - len(m) + 1)]
    for wrong in combinations(range(decontaminate.WINDOW), decontaminate.SUBSTITUTIONS):
        assert any(not p & set(wrong) for p in places), wrong


def words_of(text):
    import regex

    return [w for w in regex.split(r"[^\p{L}\p{N}]+", (text or "").lower()) if w]


def brute_leaks(docs, items):
    out = {}
    for d, text in docs:
        w = words_of(text)
        for item, itext in items:
            v = words_of(itext)
            n = min(13, len(v))
            if d is None or len(v) < 5:
                continue
            for shift in range(-len(v) + 1, len(w)):
                eq = [w[k + shift] == v[k] for k in range(max(0, -shift), min(len(v), len(w) - shift))]
                if any(sum(eq[s : s + n]) >= (len(v) if len(v) < 13 else 11) for s in range(len(eq) - n + 1)):
                    out[d, item] = max(out.get((d, item), 0), sum(eq))
    return sorted((d, i, n) for (d, i), n in out.items())


def leak_tables(spark, seed=1):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randint(0, 400)}"
    items = [(i, " ".join(word() for _ in range(rng.choice([3, 5, 7, 12, 13, 20, 40])))) for i in range(25)] + [(30, None), (31, "")]
    docs = []
    for d in range(80):
        parts = [word() for _ in range(rng.randint(0, 20))]
        if rng.random() < 0.8:
            v = words_of(rng.choice(items)[1])
            for _ in range(rng.randint(0, 4)):
                if v:
                    v[rng.randrange(len(v))] = word()
            parts += v[rng.choice([0, 0, 3]) : len(v) - rng.choice([0, 0, 4])]
        parts += [word() for _ in range(rng.randint(0, 10))]
        docs.append((d, "! ".join(parts).title()))
    docs += [(200, None), (201, ""), (None, items[4][1]), (5, items[5][1])]
    frame = lambda rows, name: spark.createDataFrame(rows, f"{name} long, text string")
    return docs, items, frame(docs, "doc_id"), frame(items, "item_id")


@pytest.mark.parametrize("turns", [1, 3])
def test_leaks_equal_brute_force(spark, monkeypatch, turns):
    docs, items, d, i = leak_tables(spark)
    if turns > 1:
        monkeypatch.setattr(decontaminate, "SEEDS_AT_ONCE", 300)
    want = {}
    for key, item, n in brute_leaks(docs, items):
        want[key, item] = max(n, want.get((key, item), 0))
    assert {(r.doc_id, r.item_id): r.words for r in decontaminate.leaks(d, i).collect()} == want and want


def test_leaks_of_odd_rows(spark):
    odd = odd_documents(spark)
    items = spark.createDataFrame([(1, "Quick brown fox jumps over the lazy dog again and again, today!", "x"), (None, None, None)], "item_id long, text string, words string")
    assert {r.doc_id for r in decontaminate.leaks(odd, items).collect()} == {1, 2}
    kept = decontaminate.drop_leaks(odd, items)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 3
    assert decontaminate.leaks(empty_documents(spark), items).count() == 0
    assert decontaminate.leaks(odd, items.limit(0)).count() == 0


def test_decontamination_runs_no_python(spark, sf):
    plan = decontaminate.op8_decontaminate(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan and "Cartesian" not in plan


# --- top-k --------------------------------------------------------------------------------


def brute_top(rows, k):
    ok = [(i, [int(np.floor(256 * float(c))) for c in v]) for i, v in rows if i is not None and v is not None and all(c is not None and np.isfinite(c) for c in v)]
    out, done = [], set()
    for i, q in sorted(ok):
        if i % 50 == 0 and i not in done:
            done.add(i)
            best = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in ok if j != i and len(v) == len(q))[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    return out


@pytest.mark.parametrize("small", [False, True])
def test_top_k_equals_brute_force(spark, monkeypatch, small):
    if small:
        for name, n in (("BLOCK", 8), ("RANGE", 3), ("QUERIES", 4)):
            monkeypatch.setattr(topk, name, n)
    rng = np.random.default_rng(1)
    rows = [(int(i), [float(np.float32(x)) for x in rng.normal(0, 0.3, 6)]) for i in rng.permutation(500)]
    rows += [(1000 + i, list(rows[0][1])) for i in range(30)]  # ties
    rows += [(50, None), (2000, [None] * 6), (2050, [1.0, float("nan"), 1.0, 1.0, 1.0, 1.0]), (2100, [float("inf")] * 6), (2150, [1.0, 2.0]), (2151, [0.5, 0.5]), (2200, [1.0] * 3), (2250, []), (None, [1.0] * 6), (3, [9.0] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit("x"))
    got = topk.top_k(df, F.col("vec_id") % 50 == 0)
    assert sorted(map(tuple, got.collect())) == brute_top(rows, 5)
    assert topk.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_top_k_on_the_table(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in table(spark, sf, "embeddings").collect()]
    assert sorted(map(tuple, topk.op10_topk(spark, sf).collect())) == brute_top(rows, 5)


def test_large_components_stay_exact(spark):
    rows = [(i * 25, [float(1e5 * (i + 1)), -2e5 * i, 3e4]) for i in range(9)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, topk.top_k(df, F.col("vec_id") % 50 == 0).collect())) == brute_top(rows, 5)
