"""Operators that work on each text: personal data, repeats, toxicity, language, tokens."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from hexmosaic.llm import language, pii, repeats, token_file, toxicity
from hexmosaic.llm.common import stored, table
from tests.llm.data import empty_documents, odd_documents

# --- personal data ------------------------------------------------------------------------

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def accepted(kind, value):
    digits = [int(c) for c in value if c.isdigit()]
    if kind == "ip":
        return all(int(x) <= 255 for x in value.split("."))
    if kind == "card":
        total = sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(reversed(digits)))
        return 14 <= len(digits) <= 19 and total % 10 == 0
    return 10 <= len(digits) <= 15 if kind == "phone" else True


def base_spans(text):
    found = [(m.start(), i, m.end(), k) for i, (k, p) in enumerate(BASE.items()) for m in re.finditer(p, text) if accepted(k, m.group())]
    return ",".join(f"{k}:{a}:{e}" for a, _, e, k in sorted(found))


def check_base(found, texts):
    for r in found:
        want = base_spans(texts[r.doc_id] or "")
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest(), (texts[r.doc_id][:200], want, r.spans)
        assert set(filter(None, want.split(","))) <= set(r.spans.split(","))
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [want.count(k + ":") for k in BASE]


def test_base_spans_equal_the_patterns(spark):
    rng = random.Random(4)
    bits = ["a@b.c", "x.y@z", "..d@e.f", "a@b.c_d@e.f", "1.2.3.4", "256.1.1.1", "001.02.3.04.5", "4111 1111-1111 1111", "4111111111111111", "5555 5555 5555 4444", "+1 (555) 123-4567", "+12", "+1 2 3 4 5 6 7 8 9 0", "@", ".", "..", "-", " ", "é", "\U0001f600", "_", "%", "(", "0", "12345678901234567890", chr(0xFDD0), chr(0xFDD2), "$1", "\\"]
    texts = {i: "".join(rng.choice(bits) for _ in range(rng.randint(1, 14))) for i in range(600)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    check_base(pii.find(docs).collect(), texts)


def test_base_spans_of_long_runs_take_linear_time(spark):
    n = 200_000
    texts = {1: "a" * n, 2: "1" * n, 3: "1 " * n, 4: "a@b" + ".c" * n, 5: "+1" + " " * n, 6: "1.2.3.4 " * 3000, 7: "." * n}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r for r in pii.find(docs).collect()}
    assert (got[4].n_email, got[6].n_ip, got[2].n_card, got[3].n_card) == (1, 3000, 0, 0)
    assert got[4].spans == f"email:0:{3 + 2 * n}"


def test_pii_of_whole_table_and_odd_rows(spark, sf):
    docs = table(spark, sf, "documents")
    texts = dict(docs.select("doc_id", "text").collect())
    check_base(pii.op1_pii(spark, sf).collect(), texts)
    odd = odd_documents(spark)
    got = pii.find(odd).collect()
    assert len(got) == odd.count()
    check_base([r for r in got if r.doc_id is not None], dict(odd.select("doc_id", "text").collect()))
    assert pii.find(empty_documents(spark)).count() == 0


def pii_texts(n, seed):
    rng, out = random.Random(seed), []
    for i in range(n):
        number = "4" + "".join(rng.choice("0123456789") for _ in range(14))
        good = next(number + d for d in "0123456789" if accepted("card", number + d))
        bad = number + str((int(good[-1]) + 5) % 10)
        cue = f"card {good}" if i % 2 else f"serial {bad}x"
        out.append(f"some words {cue} then {rng.randint(1, 255)}.{rng.randint(1, 255)}.1.{rng.choice([7, 999])} end")
    return out


def test_trees_add_spans_that_look_like_accepted_ones(spark):
    texts = pii_texts(600, 1) + ["some words card 4000 0000 0000 0001 then"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    score, limits = pii.train(docs.select("doc_id", "text"))
    assert pii.KINDS.index("card") in limits
    got = {r.doc_id: r for r in pii.find(docs).collect()}
    check_base(got.values(), dict(enumerate(texts)))
    assert all("card" not in got[i].spans for i in range(0, 600, 2)), "refused serial numbers stay out"


def test_disguised_spans_are_added(spark):
    rng = random.Random(2)
    name = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 8)))
    texts = []
    for i in range(400):
        user, host = name(), name()
        mail = f"write to {user}@{host}.com now" if i % 2 else f"rate of {user}@{host}: low"
        ip = f"server {rng.randint(1, 255)}.{rng.randint(1, 255)}.{rng.randint(1, 255)}.7 is up" if i % 2 else f"version={rng.randint(300, 999)}.1.2.3x"
        texts.append(f"{mail} and {ip}")
    hidden = ["write to jane (at) acme (dot) com now", "write to joe[at]corp[dot]org now", "the server 10,20,30,7 is up"]
    docs = spark.createDataFrame(list(enumerate(texts + hidden)), "doc_id long, text string")
    got = {r.doc_id: r for r in pii.find(docs).collect()}
    check_base(got.values(), dict(enumerate(texts + hidden)))
    assert [got[400 + i].spans for i in range(3)] == ["email:9:33", "email:9:28", "ip:11:21"]
    assert all("ip" not in got[i].spans and "email" not in got[i].spans for i in range(0, 400, 2)), "what fails the checks stays out"


@pytest.mark.parametrize("texts", [["write to a@b.com"], ["no span"], ["a@b", "1.2.3.4", None]])
def test_few_spans_still_give_a_model(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert (pii.train(docs) is None) == (texts == ["no span"])
    check_base(pii.find(docs).collect(), dict(enumerate(texts)))


def test_tree_expression_equals_the_model(spark):
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    rng = np.random.default_rng(0)
    rows = pd.DataFrame(rng.integers(0, 9, (400, 3)).astype(float), columns=list("abc"))
    rows["y"] = (rows["a"] * rows["b"] > 12).astype(float)
    x = VectorAssembler(inputCols=list("abc"), outputCol="x").transform(spark.createDataFrame(rows))
    model = GBTClassifier(featuresCol="x", labelCol="y", maxIter=5, maxDepth=3, seed=1).fit(x)
    own = pii.tree_columns(model, [F.col(c) for c in "abc"])
    both = model.transform(x).select(own.alias("own"), vector_to_array("probability")[1].alias("p")).toPandas()
    assert np.allclose(both["own"], both["p"])


# --- repeats ------------------------------------------------------------------------------


def brute_repeats(rows, window):
    words = [(d, (t or "").encode().split()) for d, t in rows]
    first = {}
    for d, w in words:
        for i in range(len(w) - window + 1):
            if d is not None:
                k = tuple(w[i : i + window])
                first[k] = min(first.get(k, d), d)
    out = []
    for d, w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if d is not None and first[tuple(w[i : i + window])] < d:
                gone |= set(range(i, i + window))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def repeat_rows(seed, n=60):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randint(0, 5000)}"
    passages = [[word() for _ in range(rng.randint(8, 40))] for _ in range(5)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randint(1, 4)):
            parts += [word() for _ in range(rng.randint(0, 15))] + (rng.choice(passages) if rng.random() < 0.7 else [])
        rows.append((i, rng.choice([" ", "\n", "  "]).join(parts)))
    return rows + [(200, rows[3][1]), (201, rows[3][1]), (3, "again " + rows[3][1]), (202, None), (None, rows[4][1])]


@pytest.mark.parametrize("bits", [None, 16])
def test_repeats_equal_brute_force(spark, monkeypatch, bits):
    monkeypatch.setattr(repeats, "ASKED_AT_ONCE", 50)
    monkeypatch.setattr(repeats, "FLUSH", 100)
    if bits:
        monkeypatch.setattr(repeats, "MAX_BITS", len(repeats.MULTIPLIERS) << bits)
    rows = repeat_rows(7)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = repeats.remove_repeats(docs, window=10, gram=4)
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got.collect()), key=str) == brute_repeats(rows, 10)


def test_repeats_do_not_depend_on_the_sketch(spark, monkeypatch):
    rows = repeat_rows(8)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(repeats, "passing", lambda of, *_: np.ones(len(of), bool))
    got = repeats.remove_repeats(docs, window=10, gram=4).select("doc_id", "n_words", "n_removed", "kept_sha256")
    assert sorted(map(tuple, got.collect()), key=str) == brute_repeats(rows, 10)


def test_repeats_join_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr("hexmosaic.llm.common.BROADCAST_ROWS", -1)
    rows = repeat_rows(9)
    got = repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), window=10, gram=4)
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got.collect()), key=str) == brute_repeats(rows, 10)


def test_repeats_of_odd_rows(spark):
    odd = odd_documents(spark)
    got = repeats.remove_repeats(odd)
    want = brute_repeats([(r.doc_id, r.text) for r in odd.collect()], repeats.WINDOW)
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got.collect()), key=str) == want
    assert repeats.remove_repeats(empty_documents(spark)).count() == 0


def test_anchor_is_the_smallest_gram():
    rng = np.random.default_rng(1)
    h = rng.integers(0, 1 << 63, 300).astype(np.uint64)
    for window, gram in ((50, 25), (10, 4), (7, 7), (33, 1)):
        grams = repeats.gram_hashes(h, gram)
        want = [grams[i : i + window - gram + 1].min() for i in range(len(h) - window + 1)]
        assert (repeats.anchors(h, window, gram) == np.array(want)).all()
    assert (repeats.gram_hashes(np.concatenate([h, h]), 20)[:281] == repeats.gram_hashes(np.concatenate([h, h]), 20)[300:]).all()


# --- toxicity, language -------------------------------------------------------------------


def test_toxicity_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    got = toxicity.op3_toxicity(spark, sf).toPandas().merge(table(spark, sf, "labels").toPandas(), on="doc_id")
    held = got[got["held_out"]]
    assert (held["held_out"] == [zlib.crc32(str(d).encode()) % 5 == 0 for d in held["doc_id"]]).all()
    hit = held["predicted"] == held["toxic"]
    # some 350 toxic documents to learn from, in four languages; larger tables give more
    assert hit.mean() > 0.92 and hit[held["toxic"] == 1].mean() > 0.5 and hit[held["toxic"] == 0].mean() > 0.97
    assert got["score"].between(0, 1).all()


def test_toxicity_finds_most_unseen_toxic_documents(spark):
    sf = "/root/testdata/sf0.1"
    got = toxicity.op3_toxicity(spark, sf).where("held_out").join(table(spark, sf, "labels").where("toxic = 1"), "doc_id")
    assert got.agg(F.avg("predicted")).first()[0] > 0.6


def toxic_fixture(spark, bad="horrid beastly"):
    rng = random.Random(2)
    plain = "stone river cloud garden window paper little music summer letter".split()
    rows, labels = [], []
    for i in range(400):
        words = [rng.choice(plain) for _ in range(rng.randint(8, 30))]
        if i % 4 == 0:
            words += rng.choices(bad.split(), k=3)
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 4 == 0)))
    return rows, spark.createDataFrame(labels, "doc_id long, toxic int")


def test_unseen_misspellings_share_ngrams(spark):
    rows, labels = toxic_fixture(spark)
    more = [(1000, "stone river cloud horridd beastlyy horrrid garden"), (1001, "stone river cloud little music garden")]
    got = {r.doc_id: r for r in toxicity.detect(spark.createDataFrame(rows + more, "doc_id long, text string"), labels).collect()}
    assert got[1000].predicted == 1 and got[1001].predicted == 0


def test_toxicity_of_odd_rows(spark):
    rows, labels = toxic_fixture(spark)
    odd = odd_documents(spark, [t for _, t in rows])
    shifted = labels.withColumn("doc_id", F.col("doc_id") + 100)
    shifted = shifted.union(spark.createDataFrame([(None, 1), (5, None), (100, 0), (100, 1), (99999, 1)], "doc_id long, toxic int"))
    got = toxicity.detect(odd, shifted)
    assert got.count() == odd.count() and got.where("score is null").count() == 0
    assert toxicity.keep_clean(odd, shifted).columns == odd.columns
    assert toxicity.detect(empty_documents(spark), shifted).count() == 0
    none = toxicity.detect(odd, shifted.limit(0))
    assert none.where("predicted = 1").count() == 0 and none.count() == odd.count()


def test_language_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    got = language.op4_language(spark, sf).toPandas().merge(table(spark, sf, "documents").select("doc_id", "lang").toPandas(), on="doc_id")
    held = got[got["held_out"]]
    assert (held["held_out"] == [zlib.crc32(str(d).encode()) % 4 == 2 for d in held["doc_id"]]).all()
    assert (held["lang_pred"] == held["lang"]).mean() > 0.97
    assert got["score"].between(0, 1).all()


def test_language_of_odd_rows(spark):
    texts = ["straße und garten", "die blume ist schön", "der wald und die wiese"] * 4
    odd = odd_documents(spark, texts, "de")
    got = {(r.doc_id, r.lang_pred) for r in language.identify(odd).collect()}
    assert {(3, "und"), (4, "und"), (5, "und")} <= got and language.identify(odd).count() == odd.count()
    assert language.identify(empty_documents(spark)).count() == 0
    nothing = language.identify(odd.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in nothing.collect()} == {"und"}


def test_kernel_is_the_share_of_common_ngrams():
    a, b = language.presence("abc abd"), language.presence("abc xyz")
    x = language.normalised(["abc abd", "abc xyz"])
    assert np.isclose(x[0] @ x[1], (a & b).sum() / np.sqrt(a.sum() * b.sum()))
    assert np.isclose(x[0] @ x[0], 1)


# --- tokens -------------------------------------------------------------------------------


def plain_tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def brute_tokens(rows, tokenizer):
    out, at = [], 0
    for d, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        out.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_tokens_equal_the_tokenizer(spark, sf):
    tokenizer = plain_tokenizer()
    rng = random.Random(3)
    bits = ["word", "Word.", "it's,", "it's", "12,", "é,", "a\nb", "\n", "  ", " ", " ", "\x1c", "　", "<|endoftext|>", "x.\ny,", ",", ".", "...", "\U0001f600", "́,", "don't.", "$5.", "a", "\r\n", "\t"]
    rows = [(i, "".join(rng.choice(bits) + rng.choice([" ", " ", ""]) for _ in range(rng.randint(0, 12)))) for i in range(500)]
    for docs in (spark.createDataFrame(rows, "doc_id long, text string"), odd_documents(spark), table(spark, sf, "documents")):
        got = sorted(map(tuple, token_file.encode_documents(docs).collect()), key=lambda r: r[1])
        assert got == brute_tokens([(r.doc_id, r.text) for r in docs.collect()], tokenizer)
    assert token_file.encode_documents(empty_documents(spark)).count() == 0


def test_long_word_lists_equal_the_tokenizer():
    import public_tokenizers

    enc, tokenizer = token_file.Encoder(public_tokenizers.path("byte_bpe_50k.json")), plain_tokenizer()
    lines = "\n".join(random.Random(6).choices(["word", "Word.", "it's,", "12,", "é,", "."], k=100_000))
    texts = [lines, "two " + lines, "a\n\nb", "a\n", "\na b", "\n", "a <|endoftext|> b", "x<|endoftext|>y z"]
    assert 50256 in tokenizer.encode(texts[-1], add_special_tokens=False).ids
    for text, got in zip(texts, enc.tokens(texts)):
        assert got.tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_files_are_cut_and_read_by_document(spark, sf, monkeypatch, tmp_path):
    import public_tokenizers

    monkeypatch.setattr(token_file, "FILE_DOCS", 7)
    docs, tokenizer = table(spark, sf, "documents"), plain_tokenizer()
    manifest = token_file.write_tokens(docs, str(tmp_path), public_tokenizers.path("byte_bpe_50k.json"))
    assert manifest.count() >= docs.count() / 7
    got = sorted(map(tuple, token_file.read_digests(manifest, str(tmp_path)).collect()))
    assert got == brute_tokens([(r.doc_id, r.text) for r in docs.collect()], tokenizer)
    wanted = manifest.select("path").crossJoin(spark.createDataFrame([(3,), (11,)], "doc_id long"))
    some = {r.doc_id: r.tokens for r in token_file.read_some(manifest.select("path"), str(tmp_path), wanted).collect()}
    texts = dict(docs.select("doc_id", "text").collect())
    assert some == {d: tokenizer.encode(texts[d], add_special_tokens=False).ids + [0] for d in (3, 11)}


def test_a_damaged_frame_is_found(tmp_path):
    import pyarrow.fs as pafs

    fs, path = pafs.LocalFileSystem(), str(tmp_path / "f")
    w = token_file.FileWriter(fs.open_output_stream(path, compression=None), 2)
    for i in range(5):
        w.add(i, np.arange(i * 50, dtype="<u2"))
    w.close()
    r = token_file.FileReader(fs, path)
    assert [len(r.read(k)) for k in range(5)] == [0, 50, 100, 150, 200] and list(r.ids) == [0, 1, 2, 3, 4]
    raw = bytearray(open(path, "rb").read())
    raw[r.starts[3] + 8] ^= 1
    open(path, "wb").write(raw)
    r = token_file.FileReader(fs, path)
    assert len(r.read(2)) == 100
    with pytest.raises(Exception):
        r.read(3)


def test_stored_tables_are_read_back(spark):
    df = stored(spark.range(5), "test")
    assert df.count() == 5 and "Range" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_all_proposed_spans_train(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(pii, "stored", lambda df, kind: seen.append(df.count()) or df.where("false"))
    docs = spark.range(12_000).selectExpr("id as doc_id", "concat('write to a', id, '@b.com now') as text")
    assert pii.train(docs) is None and seen == [12_000]


class Asked:
    """A tokenizer that counts the characters it is given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.characters = tokenizer, 0

    def encode(self, text, **more):
        self.characters += len(text)
        return self.tokenizer.encode(text, **more)

    def encode_batch_fast(self, texts, **more):
        self.characters += sum(map(len, texts))
        return self.tokenizer.encode_batch_fast(texts, **more)


def test_tokenizer_gets_a_word_once_whatever_ends_it():
    import public_tokenizers

    e = token_file.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    whole = e.tokenizer
    rnd = random.Random(7)
    stems = ["".join(rnd.choices("abcdefghijklmnopqrstuvwxyzéß", k=12)) for _ in range(300)]
    texts = [" ".join(w + m for w in rnd.sample(stems, 200) for m in ["", ".", "!!", "$$$", ",%%%"]) + "\n" + rnd.choice(stems) for _ in range(50)]
    e.tokenizer = Asked(whole)
    got = [t.tolist() for t in e.tokens(texts)]
    assert got == [whole.encode(t, add_special_tokens=False).ids for t in texts]
    assert e.tokenizer.characters < 1.5 * sum(len(w) + 1 for w in stems)


def test_tokens_of_odd_texts_are_those_of_the_tokenizer():
    import public_tokenizers

    e = token_file.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    rnd = random.Random(5)
    parts = ["a", "B", "é", "1", "²", "'", "'s", " ", " ", "\n", "\t", "\r", "\xa0", "\x1c", "᠎", ",", ".", "!!", "_", "$$$", "漢", "😀", "́", "Ġ", "word", "<|endoftext|>", "\0"]
    texts = ["".join(rnd.choices(parts, k=rnd.randint(0, 24))) for _ in range(4000)] + ["", "\n", " ", "a", "a\n", "\na"]
    assert [t.tolist() for t in e.tokens(texts)] == [e.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert list(e.tokens([])) == [] and [t.tolist() for t in e.tokens(["", ""])] == [[], []]


def test_portions_keep_all_texts(monkeypatch):
    monkeypatch.setattr(token_file, "TEXTS", 3)
    monkeypatch.setattr(token_file, "CHARACTERS", 10)
    texts = ["a" * n for n in (1, 1, 1, 1, 30, 2, 9, 9, 0, 0, 0, 0)]
    assert [t for p in token_file.portions(texts) for t in p] == texts
    assert max(map(len, token_file.portions(texts))) == 3 and list(token_file.portions([])) == [[]]
