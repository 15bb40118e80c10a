"""Personal data in whole texts: validated patterns, and candidates chosen by boosted trees.

The base kinds are found by fixed patterns and checks.  Beyond them, wide
generators propose overlapping candidates; gradient-boosted trees over format
and context, trained on the corpus's own validated spans, score them; a
threshold per kind, set on held-out candidates, selects.  A token that a name
and a sign precede is a secret by rule, in a corpus of any size.  DataFrame
functions and JVM trees only; the trees become conditional expressions.

Spans are code points, end exclusive.  A selected candidate is added if no base
span holds it, no base span of another kind overlaps it, and no better
candidate does.

Defined cases: a null or empty text has no spans; repeated rows are scanned
alike; an empty table gives an empty result; without both outcomes among the
training candidates, or where no threshold is precise enough, a kind gets no
span beyond the base and the named secrets.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genrec.llm.common import free_name, let, materialise

KINDS = ("email", "ip", "card", "phone", "secret")

# The base patterns.  Possessive, and starting only where a run
# starts or a match ended, so that a text of any length is scanned in one pass
# without backtracking; the matches are those of the plain patterns.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# a text without this holds no match
NEEDS = {"email": "@", "phone": "+"}

GENERATORS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)*+",
    "ip": r"(?<![0-9.])[0-9]{1,4}+(?:\x20?+\.\x20?+[0-9]{1,4}+){3}+",
    "card": r"(?<![0-9])[0-9](?:[\x20./-]?+[0-9]){12,18}+",
    "phone": r"(?<![0-9])\+?+\(?+[0-9](?:[\x20().-]{0,2}+[0-9]){8,14}+",
    "secret": r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{20,}+",
}
PIECE = 1024                   # code points of a piece of a text
CONTEXT = 24                   # code points before and after a candidate that features see
TRAIN_ROWS = 20_000            # candidates the trees are fitted on, about as many at most: every n-th by hash
MIN_PRECISION = 0.99           # of the selected held-out candidates of a kind
DOUBT = 0.2                    # negatives added to them, so that few positives prove little
TREES, DEPTH = 10, 3
FEATURES = ("kind", "length", "digits", "letters", "upper", "others", "digit_share", "at", "dots", "plus",
            "word_before", "word_after", "space_before", "space_after", "quote_before", "label_before", "assign_before")
SECRET_CONTEXT = r"(?i)(?:token|secret|password|passwd|pwd|api_?key|key)[\"']?\s*[=:]\s*[\"']?$"
LABEL_CONTEXT = r"(?i)(?:token|key|secret|passw\w*|pwd|mail|phone|tel|call|card|ip|address)[^A-Za-z0-9]{0,4}$"


def _running(values: Column, merge: Callable[[Column, Column], Column]) -> Column:
    """Running totals of ``values`` under ``merge``, by doubling steps: n log n work, where a
    fold that appends copies its array for every element."""
    steps = F.transform(F.sequence(F.lit(0), F.ceil(F.log2(F.greatest(F.size(values), F.lit(1))))),
                        lambda k: F.pow(F.lit(2.0), k).cast("int"))
    return F.aggregate(steps, values, lambda a, step: F.transform(
        a, lambda x, i: F.when(i >= step, merge(x, F.get(a, i - step))).otherwise(x)))


def _pieces(text: Column) -> Column:
    """``text`` in pieces of ``PIECE`` code points, so that a cut need not count from the start."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))


def _cut(pieces: Column, at: Column, length: Column) -> Column:
    """``length`` code points from ``at`` (0: the first) of a text in ``pieces``."""
    first = F.floor(at / PIECE).cast("int")
    many = F.floor((at + length) / PIECE).cast("int") - first + 1
    return F.substring(F.array_join(F.slice(pieces, first + 1, many), ""), at % PIECE + 1, length)


def _by_kind(spans: Column) -> Column:
    """The spans of each kind, which are in order and do not overlap, with the steps of a search by halving."""
    def of(kind: int) -> Column:
        return let(F.filter(spans, lambda x: x["k"] == kind), lambda own: F.struct(
            own.alias("spans"), F.when(F.size(own) > 0, F.transform(
                F.sequence(F.floor(F.log2(F.size(own))), F.lit(0).cast("long"), F.lit(-1).cast("long")),
                lambda j: F.pow(F.lit(2.0), j).cast("int"))).otherwise(F.array().cast("array<int>")).alias("steps")))

    return F.array(*(of(kind) for kind in range(len(KINDS))))


def _overlapping(groups: Column, span: Column) -> Column:
    """Those spans of ``groups`` (of ``_by_kind``) that overlap ``span``."""
    def count(g: Column, holds: Callable[[Column], Column]) -> Column:
        return F.aggregate(g["steps"], F.lit(0), lambda n, step: F.when(
            holds(F.get(g["spans"], n + step - 1)), n + step).otherwise(n))

    return F.flatten(F.transform(groups, lambda g: let(
        count(g, lambda x: x["e"] <= span["s"]), lambda before: F.slice(
            g["spans"], before + 1, F.greatest(count(g, lambda x: x["s"] < span["e"]) - before, F.lit(0))))))


def _matches(text: Column, pattern: str) -> Column:
    """Array of ``s, e, v``: all leftmost matches with their places."""
    empty = F.array().cast("array<struct<s:int,e:int,v:string>>")

    def placed(found: Column) -> Column:
        def at(parts: Column) -> Column:
            lengths = F.zip_with(F.slice(parts, 1, F.size(found)), found, lambda p, v: F.char_length(p) + F.char_length(v))
            return let(_running(lengths, lambda x, y: x + y), lambda ends: F.zip_with(found, ends, lambda v, e: F.struct(
                (e - F.char_length(v)).alias("s"), e.alias("e"), v.alias("v"))))

        return F.when(F.size(found) == 0, empty).otherwise(let(F.split(text, pattern, -1), at))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)


def _valid(kind: str) -> Callable[[Column], Column]:
    def digits(v: Column) -> Column:
        return F.regexp_replace(v, "[^0-9]", "")

    def ip(v: Column) -> Column:
        return F.forall(F.split(v, r"\."), lambda p: let(F.ltrim(p, F.lit("0")), lambda x: F.when(
            F.length(x) > 3, F.lit(False)).otherwise(F.when(x == "", F.lit(0)).otherwise(x.cast("int")) <= 255)))

    def luhn(d: Column) -> Column:
        n = F.length(d)
        total = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda a, i: a + let(
            F.substring(d, n - i + 1, F.lit(1)).cast("int") * (F.lit(2) - i % 2), lambda x: x - F.when(x > 9, 9).otherwise(0)))
        return total % 10 == 0

    def card(v: Column) -> Column:
        return let(digits(v), lambda d: F.when(F.length(d).between(14, 19), luhn(d)).otherwise(F.lit(False)))

    def phone(v: Column) -> Column:
        return F.length(digits(v)).between(10, 15)

    return {"email": lambda v: F.lit(True), "ip": ip, "card": card, "phone": phone}[kind]


def base_spans(text: Column) -> Column:
    """Array of ``s, k, e`` (k: index in ``KINDS``), by start, then kind."""
    found = []
    for kind, pattern in BASE.items():
        spans = F.transform(_kept(text, kind, pattern), _as_span(KINDS.index(kind)))
        if kind in NEEDS:
            spans = F.when(F.contains(text, F.lit(NEEDS[kind])), spans).otherwise(_no_spans())
        found.append(spans)
    return F.sort_array(F.concat(*found))


def _no_spans() -> Column:
    return F.array().cast("array<struct<s:int,k:int,e:int>>")


def _kept(text: Column, kind: str, pattern: str) -> Column:
    valid = _valid(kind)
    return F.filter(_matches(text, pattern), lambda m: valid(m["v"]))


def _as_span(k: int) -> Callable[[Column], Column]:
    return lambda m: F.struct(m["s"].alias("s"), F.lit(k).alias("k"), m["e"].alias("e"))


def _features(pieces: Column, kind: int) -> Callable[[Column], Column]:
    def count(v: Column, pattern: str) -> Column:
        return F.regexp_count(v, F.lit(pattern)).cast("double")

    def flag(c: Column) -> Column:
        return c.cast("double")

    def build(m: Column, before: Column, after: Column) -> Column:
        v = m["v"]
        values = (
            F.lit(float(kind)), F.char_length(v).cast("double"), count(v, "[0-9]"), count(v, r"\p{L}"), count(v, r"\p{Lu}"),
            count(v, r"[^\p{L}0-9]"), count(v, "[0-9]") / F.char_length(v), count(v, "@"), count(v, r"\."), count(v, r"\+"),
            flag(before.rlike(r"[\p{L}0-9]$")), flag(after.rlike(r"^[\p{L}0-9]")),
            flag(before.rlike(r"(?:^|\s)$")), flag(after.rlike(r"^(?:\s|$)")), flag(before.rlike("[\"']$")),
            flag(before.rlike(LABEL_CONTEXT)), flag(before.rlike(r"[=:]\s*[\"']?$")))
        named = F.struct(*(c.alias(n) for n, c in zip(FEATURES, values, strict=True)))
        return F.struct(m["s"].alias("s"), F.lit(kind).alias("k"), m["e"].alias("e"), named.alias("f"),
                        before.rlike(SECRET_CONTEXT).alias("named"))

    def of(m: Column) -> Column:
        before = _cut(pieces, F.greatest(m["s"] - CONTEXT, F.lit(0)), F.least(m["s"], F.lit(CONTEXT)))
        after = _cut(pieces, m["e"], F.lit(CONTEXT))
        return let(before, lambda b: let(after, lambda a: build(m, b, a)))

    return of


def candidates(text: Column) -> Column:
    """Array of proposed spans ``s, k, e`` with features ``f`` and whether a name precedes (``named``)."""
    return let(_pieces(text), lambda pieces: _candidates(text, pieces))


def _candidates(text: Column, pieces: Column) -> Column:
    found = []
    for kind, pattern in GENERATORS.items():
        spans = F.transform(_matches(text, pattern), _features(pieces, KINDS.index(kind)))
        if kind == "email":
            spans = F.when(F.contains(text, F.lit("@")), spans)
        found.append(F.coalesce(spans, F.array().cast(
            "array<struct<s:int,k:int,e:int,f:struct<" + ",".join(f"{n}:double" for n in FEATURES) + ">,named:boolean>>")))
    return F.concat(*found)


def scan(text: Column) -> Column:
    """Struct of ``base`` spans and ``proposed`` candidates of a whole text."""
    return let(F.coalesce(text, F.lit("")), lambda t: F.struct(
        base_spans(t).alias("base"), candidates(t).alias("proposed")))


def _tree_sql(debug: list[tuple[int, str]], names: tuple[str, ...], at: int = 0) -> tuple[str, int]:
    """A tree's printed lines as a conditional expression over ``c.f``."""
    _, line = debug[at]
    if line.startswith("Predict:"):
        return f"{float(line.split(':')[1])!r}D", at + 1
    m = re.match(r"If \(feature (\d+) <= (\S+)\)", line)
    if not m:
        raise ValueError(f"unexpected line of a tree: {line}")
    yes, at = _tree_sql(debug, names, at + 1)
    if not debug[at][1].startswith("Else"):
        raise ValueError(f"unexpected line of a tree: {debug[at][1]}")
    no, at = _tree_sql(debug, names, at + 1)
    return f"if(c.f.{names[int(m[1])]} <= {float(m[2])!r}D, {yes}, {no})", at


def fit(scanned: DataFrame) -> tuple[str, dict[int, float]] | None:
    """``(score, thresholds)``: the trees as an SQL expression over a candidate ``c``,
    and the least score that selects each kind; None without both outcomes.

    ``scanned`` has the column ``s`` of ``scan``.  A candidate is positive if a
    base span of its kind overlaps it, a secret if a name and a sign precede it;
    the checks themselves (checksums, ranges) are not features.  Two thirds of
    the candidates, thinned by a hash to about ``TRAIN_ROWS``, are fitted; thresholds
    are set on the whole last third.
    """
    rows = scanned.where("size(s.proposed) > 0").select(
        F.xxhash64("doc_id").alias("h"), F.explode(let(_by_kind(F.col("s.base")), lambda base: F.transform(
            F.col("s.proposed"), lambda c: F.struct(c.alias("c"), F.exists(
                _overlapping(base, c), lambda b: b["k"] == c["k"]).alias("valid"))))).alias("x"))
    labelled = rows.select(
        F.pmod("h", F.lit(3)).alias("fold"), F.xxhash64("h", "x.c.s", "x.c.k").alias("h"), "x.c",
        F.when(F.col("x.c.k") == KINDS.index("secret"), F.col("x.c.named")).otherwise(F.col("x.valid")).cast("double").alias("label"))
    labelled = materialise(labelled, "pii-candidates")
    every = labelled.where("fold < 2").count() // TRAIN_ROWS + 1
    train = materialise(labelled.where(F.expr(f"fold < 2 and pmod(h, {every}) = 0")).select("label", "c.f.*"), "pii-train")
    outcomes = train.agg(F.countDistinct("label")).first()[0]
    if outcomes < 2:
        return None
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="v").transform(train).select("label", "v")
    model = GBTClassifier(featuresCol="v", labelCol="label", maxIter=TREES, maxDepth=DEPTH, seed=7).fit(vectors)
    parts = []
    for tree, weight in zip(model.trees, model.treeWeights, strict=True):
        lines = [(0, x.strip()) for x in tree.toDebugString.splitlines()[1:] if x.strip()]
        parts.append(f"{float(weight)!r}D * {_tree_sql(lines, FEATURES)[0]}")
    score = " + ".join(parts)
    held = labelled.where("fold = 2").select(F.col("c.k").alias("k"), F.expr(f"round({score}, 3)").alias("score"), "label")
    by_score = held.groupBy("k", "score").agg(F.sum("label").alias("p"), F.count(F.lit(1)).alias("n"))
    # at most one row for each kind and each thousandth of a bounded score
    thresholds: dict[int, float] = {}
    seen: dict[int, tuple[float, float]] = {}
    for r in sorted(by_score.collect(), key=lambda r: -r["score"]):
        p, n = seen.get(r["k"], (0.0, DOUBT))
        p, n = p + r["p"], n + r["n"]
        seen[r["k"]] = (p, n)
        # a negative in a high band does not end the kind: what is selected as a whole decides
        if p >= MIN_PRECISION * n:
            thresholds[r["k"]] = r["score"]
    return (score, thresholds) if thresholds else None


def selected(scanned: DataFrame, column: str, model: tuple[str, dict[int, float]] | None) -> Column:
    """Array of all spans ``s, k, e`` of a row, base and added, by start, then kind."""
    score, thresholds = model or ("0.0D", {})
    least = "case x.k " + " ".join(f"when {k} then {t!r}D" for k, t in sorted(thresholds.items())) + " else null end" \
        if thresholds else "cast(null as double)"
    # a named token is a secret whatever the rest of the corpus holds
    wanted = F.expr(f"""
      filter(transform({column}.proposed, c -> named_struct(
          'score', round({score}, 3), 's', c.s, 'k', c.k, 'e', c.e, 'named', c.named)),
        x -> (x.k = {KINDS.index('secret')} and x.named) or coalesce(x.score >= {least}, false))""")

    def added(base: Column) -> Column:
        return F.filter(wanted, lambda x: ~F.exists(_overlapping(base, x), lambda b: (
            (b["s"] <= x["s"]) & (b["e"] >= x["e"])) | (b["k"] != x["k"])))

    def rank(x: Column) -> Column:
        return F.struct(-x["score"], x["s"] - x["e"], x["s"], x["k"])

    def best(good: Column) -> Column:
        return let(_by_kind(good), lambda groups: F.transform(
            F.filter(good, lambda x: ~F.exists(_overlapping(groups, x), lambda y: rank(y) < rank(x))),
            lambda x: F.struct(x["s"].alias("s"), x["k"].alias("k"), x["e"].alias("e"))))

    base = F.col(f"{column}.base")
    return F.sort_array(F.concat(base, let(let(_by_kind(base), added), best)))


def _listed(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def find(docs: DataFrame) -> DataFrame:
    """``doc_id``, the counts of the base kinds, ``base_sha256`` and ``spans`` of every row.

    Runs the scanning job, the training jobs and one aggregate of held-out scores.
    """
    scanned = materialise(docs.select("doc_id", scan(F.col("text")).alias("s")), "pii-spans")
    model = fit(scanned)
    base = F.col("s.base")
    counts = [_count(base, i).alias(f"n_{kind}") for i, kind in enumerate(KINDS[:4])]
    return scanned.select("doc_id", *counts, F.sha2(_listed(base).cast("binary"), 256).alias("base_sha256"),
                          _listed(selected(scanned, "s", model)).alias("spans"))


def _count(spans: Column, k: int) -> Column:
    return F.size(F.filter(spans, lambda x: x["k"] == k)).cast("long")


def redact(docs: DataFrame) -> DataFrame:
    """``docs``, with its columns and rows; in ``text`` every span is replaced by its
    kind in brackets (overlapping spans by the first one's).  Null texts stay
    null; ``n_chars``, where present, follows the text."""
    column, spans = free_name(docs, "pii_scan"), free_name(docs, "pii_spans")
    # scanned once for the trees and once here, which costs less than a second copy of the documents
    model = fit(materialise(docs.select("doc_id", scan(F.col("text")).alias("s")), "pii-spans"))
    scanned = docs.withColumn(column, scan(F.col("text")))
    rows = scanned.withColumn(spans, selected(scanned, column, model))
    names = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))
    text = F.col("text")

    def redacted(pieces: Column, until: Column) -> Column:
        # ``until``: how far the spans up to each one reach
        def part(x: Column, i: Column) -> Column:
            return let(F.coalesce(F.get(until, i - 1), F.lit(0)), lambda at: F.when(x["s"] >= at, F.concat(
                _cut(pieces, at, x["s"] - at), F.get(names, x["k"]))).otherwise(F.lit("")))

        last = F.get(until, F.size(until) - 1)
        return F.concat(F.array_join(F.transform(F.col(spans), part), ""), _cut(pieces, last, F.char_length(text) - last))

    pieces = let(_pieces(text), lambda p: let(
        _running(F.transform(F.col(spans), lambda x: x["e"]), F.greatest), lambda until: redacted(p, until)))
    out = rows.withColumn("text", F.when(F.size(spans) > 0, pieces).otherwise(text))
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        out = out.withColumn("n_chars", F.when(F.size(spans) > 0, F.char_length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out.select(*(F.col(f"`{c}`") for c in docs.columns))
