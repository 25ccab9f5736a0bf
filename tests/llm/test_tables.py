"""Archives, mixing, the pipeline and the registered queries with their SQL."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import random
from fractions import Fraction

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from hexmosaic.llm import decontaminate, entries, mixing, warc
from hexmosaic.llm.common import table
from tests.llm.data import empty_documents, odd_documents
from tests.llm.test_pairs import brute_join, brute_leaks
from tests.llm.test_texts import brute_tokens, plain_tokenizer, toxic_fixture

# --- WARC ---------------------------------------------------------------------------------


def brute_warc(rows, min_bytes=0):
    first = {}
    for page, html in rows:
        if page is not None and len((html or "").encode()) >= min_bytes:
            first[html or ""] = min(first.get(html or "", page), page)
    out = []
    for page, html in rows:
        raw = (html or "").encode()
        to = first.get(html or "") if len(raw) >= min_bytes else None
        again = to is not None and to != page
        out.append((page, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if again else "response", to if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("min_bytes", [0, 5])
def test_round_trip_of_odd_pages(spark, min_bytes):
    long_html = "<p>" + "x\r\n\r\nWARC/1.1\r\n" * 40_000 + "é</p>"
    rows = [(1, "<p>a</p>"), (2, "<p>a</p>"), (3, None), (4, ""), (5, long_html), (6, long_html), (7, "WARC/1.1\r\n"), (8, "abc"), (9, "abc"), (0, "abc"), (9, "abc")]
    df = spark.createDataFrame([(p, None if p == 3 else f"http://x/{p} \r\nA: b", h, "n", "d") for p, h in rows], "page_id long, url string, html string, n string, digest string")
    got = warc.round_trip(df, min_bytes).cache()
    assert sorted((tuple(r)[:5] for r in got.collect()), key=str) == brute_warc(rows, min_bytes)
    texts = {(p, h or "") for p, h in rows}
    assert all((r.page_id, r.html) in texts for r in got.collect() if r.record_type == "response")
    assert all(r.html is None for r in got.collect() if r.record_type == "revisit")
    assert warc.round_trip(df.limit(0)).count() == 0


def test_a_lone_null_page_is_a_response(spark):
    df = spark.createDataFrame([(None, "u", "one"), (None, "u", "two"), (4, "u", "two")], "page_id long, url string, html string")
    got = sorted(((r.page_id, r.record_type, r.refers_to) for r in warc.round_trip(df).collect()), key=str)
    assert got == [(4, "response", None), (None, "response", None), (None, "revisit", 4)]


def test_pages_of_the_table_come_back(spark, sf):
    rows = [(r.page_id, r.html) for r in table(spark, sf, "pages").collect()]
    assert sorted((tuple(r)[:5] for r in warc.op7_warc(spark, sf).collect()), key=str) == brute_warc(rows)


def test_members_are_read_one_after_the_other():
    member = lambda i: warc.gzip_member(warc.record("response", i, "u", b"x" * i, warc.payload_digest(b"x" * i), None))
    raw = b"".join(member(i) for i in (0, 1, 70_000, 3))
    assert gzip.decompress(raw).count(b"WARC-Type") == 4
    assert [len(b) for _, b in warc.read_records(io.BytesIO(raw))] == [0, 1, 70_000, 3]
    with pytest.raises(ValueError):
        list(warc.read_records(io.BytesIO(raw[:-20])))
    bad = warc.gzip_member(warc.record("response", 1, "u", b"abc", warc.payload_digest(b"abd"), None))
    with pytest.raises(ValueError):
        list(warc.read_records(io.BytesIO(bad)))


# --- mixing -------------------------------------------------------------------------------


def brute_targets(sizes, weights=(1, 2, 3), epochs=3):
    """Shares by weight, capped, the excess dealt out again until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    capped, total = set(), sum(sizes.values())
    while True:
        left = total - sum(epochs * sizes[s] for s in capped)
        free = sum(weight[s] for s in names if s not in capped)
        target = {s: Fraction(epochs * sizes[s]) if s in capped else Fraction(left * weight[s], free) for s in names}
        over = {s for s in names if target[s] > epochs * sizes[s]}
        if not over:
            return target
        capped |= over


def check_mix(rows, docs):
    sizes, want = {}, {}
    for r in docs:
        sizes[r.source] = sizes.get(r.source, 0) + len((r.text or "").encode().split())
    target = brute_targets(sizes)
    assert len(rows) == len(docs)
    for r in rows:
        assert r.source_size == sizes[r.source] and abs(r.target - float(target[r.source])) < 1e-6 * max(1, r.target)
        assert 0 <= r.taken <= 3 * r.size
        want[r.source] = want.get(r.source, 0) + r.taken
    for s, t in target.items():
        assert abs(want[s] - t) <= 1


def test_mix_meets_its_targets(spark, sf):
    docs = table(spark, sf, "documents").withColumn("source", F.when(F.col("doc_id") % 7 > 0, "big").when(F.col("doc_id") % 2 == 0, F.concat(F.lit("é"), "source")).when(F.col("doc_id") % 3 > 0, F.lit("Z")))
    rows = mixing.mix(docs).collect()
    check_mix(rows, docs.collect())
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, again), key=str)


def test_mix_does_not_depend_on_ranges(spark, sf, monkeypatch):
    docs = table(spark, sf, "documents")
    one = sorted(map(tuple, mixing.mix(docs).collect()))
    monkeypatch.setattr(mixing, "ROWS_PER_RANGE", 1)
    assert sorted(map(tuple, mixing.mix(docs).collect())) == one


def test_mix_of_odd_rows(spark):
    odd = odd_documents(spark)
    check_mix(mixing.mix(odd).collect(), odd.collect())
    assert mixing.mix(empty_documents(spark)).count() == 0
    nothing = odd.withColumn("text", F.lit(None).cast("string"))
    assert {(r.size, r.taken, r.target) for r in mixing.mix(nothing).collect()} == {(0, 0, 0.0)}


def test_mixed_rows_hold_the_words_taken(spark, sf):
    docs = table(spark, sf, "documents")
    taken = {r.doc_id: (r.size, r.taken, r.source) for r in mixing.mix(docs).collect()}
    out = mixing.apply_mix(docs, mixing.mix(docs))
    assert out.columns == docs.columns
    words, cut = {}, {}
    texts = dict(docs.select("doc_id", "text").collect())
    for r in out.collect():
        n = len(r.text.encode().split())
        words[r.doc_id] = words.get(r.doc_id, 0) + n
        if n < taken[r.doc_id][0]:
            cut[taken[r.doc_id][2]] = cut.get(taken[r.doc_id][2], 0) + 1
            assert r.text.encode().split() == texts[r.doc_id].encode().split()[:n] and r.n_chars == len(r.text)
        else:
            assert r.text == texts[r.doc_id]
    assert words == {d: t for d, (_, t, _) in taken.items() if t}
    assert max(cut.values(), default=0) <= 1


def test_mixed_rows_of_repeated_documents(spark):
    odd = odd_documents(spark)
    want, got = {}, {}
    for r in mixing.mix(odd).collect():
        want[r.doc_id] = want.get(r.doc_id, 0) + r.taken
    for r in mixing.apply_mix(odd, mixing.mix(odd)).collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + len(r.text.encode().split())
    assert got == {d: n for d, n in want.items() if n}


# --- pipeline and registered queries ------------------------------------------------------


def test_pipeline_stages_keep_what_they_should(spark, sf):
    docs = table(spark, sf, "documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near copies", "decontamination", "mixing", "token files"]
    stage = dict(corpus_pipeline.STAGES)
    clean = stage["toxicity"](spark, docs, sf)
    assert clean.columns == docs.columns and 0 < clean.count() <= docs.count()

    rows = [(r.doc_id, r.text) for r in docs.collect()]
    first = stage["near copies"](spark, docs, sf)
    assert sorted(r.doc_id for r in first.collect()) == sorted({c for _, c, _ in brute_join(rows)})
    items = [(r.item_id, r.text) for r in table(spark, sf, "benchmark").collect()]
    held = {d for d, _, _ in brute_leaks(rows[:60], items)}
    some = docs.where(F.col("doc_id").isin([d for d, _ in rows[:60]]))
    kept = stage["decontamination"](spark, some, sf)
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in rows[:60]} - held
    last = stage["token files"](spark, first, sf)
    assert sorted(map(tuple, last.collect())) == brute_tokens([(r.doc_id, r.text) for r in first.collect()], plain_tokenizer())


def test_pipeline_equals_its_stages(spark, sf):
    docs = table(spark, sf, "documents")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf).collect())) == sorted(map(tuple, docs.collect()))


def test_stages_take_odd_rows(spark, sf):
    for docs in (odd_documents(spark), empty_documents(spark)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, sf)
            assert out.columns == docs.columns, name
            out.collect()


def test_filter_stages_judge_each_row(spark, sf, monkeypatch):
    rng = random.Random(8)
    text = lambda n=40: " ".join(f"w{rng.randint(0, 9999)}" for _ in range(n))
    same, other, third, item = text(), text(), text(), text(20)
    far = -(1 << 63)
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    ids = lambda out: sorted(((r.doc_id, r.text) for r in out.collect()), key=str)

    rows = [(None, same, 1), (None, same, 2), (7, other, 3), (7, other, 4), (7, third, 5), (None, third, 6), (None, text(), 7), (far, same, 8), (-5, same, 9), (3, None, 10), (3, None, 11)]
    kept = corpus_pipeline.without_near_copies(spark, frame(rows), sf)
    assert kept.columns == ["doc_id", "text", "n_chars"]
    assert ids(kept) == sorted([(far, same), (7, other), (7, third), (None, rows[6][1]), (3, None), (3, None)], key=str)

    rows = [(None, other, 1), (None, f"{text()} {item}", 2), (7, third, 3), (7, f"{item} end", 4), (None, None, 5)]
    monkeypatch.setattr(corpus_pipeline, "table", lambda *_: spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert ids(corpus_pipeline.without_leaks(spark, frame(rows), sf)) == sorted([(None, other), (7, third), (None, None)], key=str)

    plain, labels = toxic_fixture(spark)
    bad, good = "horrid beastly horrid stone", "stone river cloud garden"
    rows = [(i, t, 0) for i, t in plain] + [(None, bad, 1), (None, good, 2), (7, bad, 3), (7, good, 4), (None, good, 5)]
    monkeypatch.setattr(corpus_pipeline, "table", lambda *_: labels)
    clean = [(r.doc_id, r.text) for r in corpus_pipeline.without_toxic(spark, frame(rows), sf).collect() if r.text in (bad, good)]
    assert sorted(clean, key=str) == sorted([(None, good), (7, good), (None, good)], key=str)


@pytest.mark.parametrize("name", sorted(entries.ORACLES))
def test_query_equals_its_sql(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    want = con.execute(entries.ORACLES[name])
    columns = [c[0] for c in want.description]
    got = entries.QUERIES[name](spark, sf)
    assert set(got.columns) == set(columns)
    assert sorted(map(str, map(tuple, got.select(columns).collect()))) == sorted(map(str, want.fetchall()))


def test_every_operator_is_registered():
    assert sorted(int(k[2:].split("_")[0]) for k in entries.QUERIES) == list(range(1, 14))
    assert decontaminate.SQL == entries.ORACLES["op8_decontaminate"]
