"""Personal data: spans proposed widely, scored by boosted trees, selected by calibrated thresholds.

Everything works on one row: patterns mark their matches in the text, the marked text is cut at the
marks, and piece lengths give the positions; so no text is shuffled, and a text of any length costs
its own length. The base spans (email, ip, card, phone by the fixed rules) always stay. Wider
patterns propose further spans, which may overlap; their format and context features go through
boosted trees, turned into one column expression each, and those above a kind's threshold are added.

The trees learn from all proposed spans with weak labels, which are wider than the base rules: a span counts as right if its plain form, without disguise ("(at)", "(dot)", commas in an
address, a leading 00), passes the checks of its kind (Luhn sum, range of the parts, number of digits).
The features see the plain form only and leave those checks out, so they cannot tell a disguised span
from a plain one, and the model judges by format and context what a rule cannot.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hexmosaic.llm.common import documents, stored, table
from hexmosaic.session import bind

KINDS = ("email", "ip", "card", "phone")
#: Trees and their depth.
TREES, DEPTH = 12, 3
#: Share of accepted spans among those above a threshold, on the half that is kept for calibration.
PRECISION = 0.95
CONTEXT = 24

# One-character stand-ins, none of them a character of any script: begin and end of a match, a full
# stop that no domain character follows, a space and a hyphen between two digits.
MARKS = [chr(0xFDD0 + i) for i in range(5)]
BEGIN, END, STOP, SPACE, DASH = MARKS

_LOCAL = rf"A-Za-z0-9._%+\-{STOP}"
#: Per kind: replacements that make its base rule a run of plain character classes, that rule, and a
#: wider pattern. A run is entered at its first character or right after the last match, and never
#: given back, so no text is scanned twice however long its runs are.
RULES = {
    "email": (
        [(r"\.(?![A-Za-z0-9-])", STOP)],
        rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++\.[A-Za-z0-9.-]++",
        r"(?<![A-Za-z0-9._-])[A-Za-z0-9][A-Za-z0-9._-]{0,63} ?(?:\(at\)|\[at\]|@) ?[A-Za-z0-9-]{1,63}(?: ?(?:\(dot\)|\[dot\]|\.) ?[A-Za-z0-9-]{2,24}){0,4}",
    ),
    "ip": ([], r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"(?<![0-9.])[0-9]{1,4}(?:[.,][0-9]{1,4}){3}(?![0-9])"),
    "card": (
        [(r"(?<=[0-9]) (?=[0-9])", SPACE), (r"(?<=[0-9])-(?=[0-9])", DASH)],
        rf"(?<![0-9{SPACE}{DASH}])[0-9][0-9{SPACE}{DASH}]++",
        r"(?<![0-9])[0-9]{4}(?:[ ./-]?[0-9]{4}){2}[ ./-]?[0-9]{1,7}(?![0-9])",
    ),
    "phone": ([], r"\+[0-9][\x20().0-9-]+[0-9]", r"(?<![0-9])(?:\+|00)?[0-9]{0,3}[ .-]?\(?[0-9]{2,4}\)?[ .-][0-9]{3,4}[ .-]?[0-9]{3,4}(?![0-9])"),
}
#: What a text must hold to be searched for a kind at all.
HINTS = {"email": r"@|\(at\)|\[at\]", "ip": r"[0-9][.,][0-9]", "card": r"[0-9][0-9 ./-]{6}", "phone": r"[0-9][0-9 ().-]{4}"}
CUES = {
    "email": r"mail|contact|write|correo|courriel|kontakt",
    "ip": r"\bip\b|host|server|address|login",
    "card": r"card|visa|credit|payment|konto|carte|tarjeta",
    "phone": r"phone|call|tel|fax|mobil|handy",
}
FEATURES = ("kind", "length", "digits", "letters", "others", "distinct", "before", "after", "cue", "lead")
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the weighted digit sum is a multiple of 10."""
    n = F.length(digits)
    one = lambda i: F.substring(digits, n - i, F.lit(1)).cast("int")
    twice = lambda i: 2 * one(i) - F.when(one(i) > 4, 9).otherwise(0)
    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda a, i: a + F.when(i % 2 == 1, twice(i)).otherwise(one(i))) % 10 == 0


def accepted(kind: str, value: Column) -> Column:
    """The checks of the base rule on one match."""
    n = F.length(digits_of(value))
    if kind == "ip":
        return value.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    if kind == "card":
        return F.when(n.between(14, 19), luhn(digits_of(value))).otherwise(False)
    return n.between(10, 15) if kind == "phone" else F.lit(True)


def _by_kind(no: Column, per_kind) -> Column:
    return F.coalesce(*[F.when(no == i, per_kind(k)) for i, k in enumerate(KINDS)])


def _cue(s: Column) -> Column:
    return _by_kind(s["no"], lambda k: F.lower(s["before"]).rlike(CUES[k]))


def plain_form(kind: str, value: Column) -> Column:
    """A proposed span without what disguises it; a plain span stays nearly as it is."""
    if kind == "email":
        value = F.regexp_replace(value, r" ?(?:\(at\)|\[at\]|@) ?", "@")
        return F.regexp_replace(value, r" ?(?:\(dot\)|\[dot\]|\.) ?", ".")
    if kind == "ip":
        return F.translate(value, ",", ".")
    return F.regexp_replace(value, "[ ./-]", " ") if kind == "card" else F.regexp_replace(value, r"^(?:\+|00)", "")


def weak_label(s: Column) -> Column:
    """Whether a proposed span's plain form passes the checks of its kind.

    A disguised address must end in letters, and a phone number have a prefix or a cue before it.
    """

    def right(k: str) -> Column:
        value = plain_form(k, s["value"])
        if k == "email":
            ends = (value == s["value"]) | value.rlike(r"\.[A-Za-z]{2,24}$")
            return value.rlike(r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+$") & ends
        if k == "phone":
            return accepted(k, value) & (s["value"].rlike(r"^(?:\+|00)") | _cue(s))
        return accepted(k, value)

    return _by_kind(s["no"], right).cast("double")


def _joined(chars: Column, start: Column, length: Column) -> Column:
    return F.array_join(F.slice(chars, start, F.greatest(length, F.lit(0))), "")


def spans(rows: DataFrame, keep: list[str]) -> DataFrame:
    """Columns ``keep`` plus ``base`` and ``wide``: arrays of (start, no, end, value, before, after).

    ``no`` is the kind's place in KINDS. A mark's place in the marked text less the marks before it
    is its place in the text. Each of the steps is computed once per row.
    """
    marked = {}
    for k, (changes, base, wide) in RULES.items():
        text = F.col("text")
        for pattern, mark in changes:
            text = F.regexp_replace(text, pattern, mark)
        here = F.col("text").rlike(HINTS[k])
        for which, source, pattern in (("base", text, base), ("wide", F.col("text"), wide)):
            found = F.regexp_replace(source, f"({pattern})", f"{BEGIN}$1{END}")
            marked[f"{which}_{k}"] = F.when(here, found)
    rows = bind(rows, keep, **marked)
    rows = bind(rows, keep, **{c: F.when(F.contains(F.col(c), F.lit(BEGIN)), F.split(c, "")) for c in marked})
    at = lambda c, mark: F.filter(F.transform(c, lambda x, i: F.when(x == mark, i)), lambda i: i.isNotNull())
    rows = bind(rows, keep, **{c: F.col(c) for c in marked}, **{f"{c}_from": at(c, BEGIN) for c in marked}, **{f"{c}_to": at(c, END) for c in marked})

    def found(c: str, k: str) -> Column:
        plain = lambda x: F.translate(x, "".join(MARKS), "." if k == "email" else "")
        chars, to = F.col(c), F.col(f"{c}_to")

        def one(b, i):
            e = F.get(to, i)
            value = F.translate(_joined(chars, b + 2, e - b - 1), STOP + SPACE + DASH, ". -")
            before = _joined(chars, F.greatest(b - CONTEXT + 1, F.lit(1)), F.least(b, F.lit(CONTEXT)))
            after = _joined(chars, e + 2, F.lit(CONTEXT))
            return F.struct((b - 2 * i).alias("start"), F.lit(KINDS.index(k)).alias("no"), (e - 2 * i - 1).alias("end"), value.alias("value"), plain(before).alias("before"), plain(after).alias("after"))

        return F.coalesce(F.transform(F.col(f"{c}_from"), one), F.array().cast("array<struct<start:int,no:int,end:int,value:string,before:string,after:string>>"))

    right = lambda k: lambda s: accepted(k, s["value"])
    base = F.concat(*[F.filter(found(f"base_{k}", k), right(k)) for k in KINDS])
    wide = F.concat(*[found(f"wide_{k}", k) for k in KINDS])
    return bind(rows, keep, base=base, wide=wide)


def features(s: Column) -> list[Column]:
    """Format and context of a span, without the checks of the base rules."""
    no = s["no"]
    value = _by_kind(no, lambda k: plain_form(k, s["value"]))
    kind_of = lambda c: F.when(c == "", 0).when(c.rlike(r"\s"), 1).when(c.rlike(r"[0-9]"), 2).when(c.rlike(r"\p{L}"), 3).otherwise(4)
    n, digits, letters = F.char_length(value), F.length(digits_of(value)), F.length(F.regexp_replace(value, "[^A-Za-z]", ""))
    out = [no, n, digits, letters, n - digits - letters, F.size(F.array_distinct(F.split(value, ""))), kind_of(F.right(s["before"], F.lit(1))), kind_of(F.left(s["after"], F.lit(1))), _cue(s), F.ascii(value)]
    return [c.cast("double") for c in out]


def tree_columns(model: GBTClassificationModel, values: list[Column]) -> Column:
    """The model's probability as one expression of the features."""
    lines = [x.strip() for x in model.toDebugString.splitlines()[1:]]
    total, at = F.lit(0.0), 0

    def node() -> Column:
        nonlocal at
        line = lines[at]
        at += 1
        if line.startswith("Predict"):
            return F.lit(float(line.split()[-1]))
        feature, limit = re.match(r"If \(feature (\d+) <= (\S+)\)", line).groups()
        low = node()
        at += 1  # the line of Else
        return F.when(values[int(feature)] <= float(limit), low).otherwise(node())

    while at < len(lines):
        head = re.match(r"Tree \d+ \(weight (\S+)\)", lines[at])
        at += 1
        if head:
            total = total + float(head[1]) * node()
    return 1 / (1 + F.exp(-2 * total))


def train(docs: DataFrame):
    """Scoring function and threshold of every kind, or None if no span at all is proposed.

    All spans that all documents propose count, written once as numbers only; trees and thresholds are
    made by Spark over them. One half trains, the other sets for each kind the lowest threshold above
    which PRECISION of the spans have the label (a half without spans gives way to the whole). A kind
    with fewer than 20 such spans takes the threshold of all kinds together; where none is precise
    enough, only spans above all scores seen pass, that is, none.
    """
    rows = spans(docs, ["doc_id"]).select("doc_id", F.explode("wide").alias("s"))
    rows = rows.select("doc_id", weak_label(F.col("s")).alias("label"), *[c.alias(f) for c, f in zip(features(F.col("s")), FEATURES)])
    half = F.pmod(F.xxhash64("doc_id", F.lit(4)), F.lit(2))
    rows = stored(rows.withColumn("half", half), "pii-spans")
    halves = {r[0] for r in rows.select("half").distinct().collect()}
    if not halves:
        return None
    part = lambda i: rows.where(F.col("half") == i) if len(halves) == 2 else rows
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="x").transform(part(0))
    model = GBTClassifier(featuresCol="x", labelCol="label", maxIter=TREES, maxDepth=DEPTH, seed=7, checkpointInterval=-1).fit(vectors)
    score = lambda values: tree_columns(model, values)

    judged = part(1).select("kind", "label", score([F.col(f) for f in FEATURES]).alias("score"))
    by_score = judged.groupBy("kind", "score").agg(F.sum("label").alias("yes"), F.count("*").alias("n"))
    every = by_score.groupBy(F.lit(-1.0).alias("kind"), "score").agg(F.sum("yes").alias("yes"), F.sum("n").alias("n"))
    above = Window.partitionBy("kind").orderBy(F.desc("score"))
    by_score = by_score.unionByName(every).select("kind", "score", F.sum("yes").over(above).alias("yes"), F.sum("n").over(above).alias("n"))
    good = F.min(F.when((F.col("yes") >= PRECISION * F.col("n")) & ((F.col("n") >= 20) | (F.col("kind") < 0)), F.col("score")))
    found = {int(r[0]): (r[1], r[2]) for r in by_score.groupBy("kind").agg(good, F.max("n")).collect()}
    none, limits = (None, 0), {}
    for k in range(len(KINDS)):
        own, seen = found.get(k, none)
        limits[k] = own if seen >= 20 else found.get(-1, none)[0]
    return score, {k: 2.0 if t is None else t for k, t in limits.items()}


def find(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans.

    Base spans are leftmost and non-overlapping per kind. Offsets count code points; ``spans`` lists
    base and added ones, by start, kind and end. A null or empty text has none: counts of 0, the hash
    of no text and an empty list. Rows repeat as they are, null ids included; other columns are
    ignored; an empty table gives an empty result.
    """
    docs = documents(docs).withColumn("text", F.translate("text", "".join(MARKS), chr(0xFDEF) * len(MARKS)))
    found = spans(docs, ["doc_id"])
    place = lambda s: F.struct(s["start"].alias("start"), s["no"].alias("no"), s["end"].alias("end"))
    judged = lambda s: F.struct(place(s).alias("at"), F.array(*features(s)).alias("x"))
    found = bind(found, ["doc_id"], base=F.array_sort(F.transform("base", place)), wide=F.transform("wide", judged))
    trained, more = train(docs), F.slice(F.transform("base", place), 1, 0)
    if trained:
        score, limits = trained
        limit = lambda s: F.get(F.array(*[F.lit(limits[k]) for k in range(len(KINDS))]), s["at"]["no"])
        passes = lambda s: score([F.get(s["x"], F.lit(i)) for i in range(len(FEATURES))]) >= limit(s)
        more = F.transform(F.filter("wide", passes), lambda s: s["at"])
    found = bind(found, ["doc_id", "base"], every=F.array_sort(F.array_union("base", more)))
    names = F.array(*map(F.lit, KINDS))
    text = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", F.get(names, s["no"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
    of = lambda i: lambda s: s["no"] == i
    counts = [F.size(F.filter("base", of(i))).cast("long").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(text("base").cast("binary"), 256).alias("base_sha256"), text("every").alias("spans"))


def op1_pii(spark, sf_dir):
    return find(table(spark, sf_dir, "documents"))
