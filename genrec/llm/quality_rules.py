"""Quality rules: a decision list learned by sequential covering.

DataFrame functions only: statistics of a text are column expressions, the
covering loop reads one small aggregate per step, and the learned list is an
ordered conditional expression.

Defined cases: a null or blank text has no words (every count 0) and fails the
base rule; repeated ids are judged row by row; an empty table gives an empty
result; with no usable labels the list has no rule and nothing but the base
rule rejects.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genrec.llm.common import SPACES, let, materialise, spaced, words_of_spaced

WINDOW = 8                    # words in a repeated window
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
SYMBOLS = r"[#*$%&|<>]"


@dataclass(frozen=True)
class Literal:
    """``feature >= threshold`` (``above``) or ``feature < threshold``."""

    feature: str
    above: bool
    threshold: float

    def condition(self, value: Callable[[str], Column] = F.col) -> Column:
        col = value(self.feature)
        return col >= F.lit(self.threshold) if self.above else col < F.lit(self.threshold)


Rule = tuple[Literal, ...]


def _covered(positions: Column) -> Column:
    """Words covered by windows that start at the sorted ``positions``."""
    steps = F.transform(positions, lambda p, k: F.least(
        F.lit(WINDOW), F.coalesce(F.get(positions, k + 1) - p, F.lit(WINDOW))))
    return F.aggregate(steps, F.lit(0), lambda a, x: a + x)


def _repeated_positions(hashes: Column) -> Column:
    """Positions (sorted) of the windows whose hash occurs at least twice."""
    ranked = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return let(ranked, lambda s: F.sort_array(F.transform(
        F.filter(F.transform(s, lambda x, k: F.when(
            F.coalesce(F.when(k > 0, F.get(s, k - 1)["h"]) == x["h"], F.lit(False))
            | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False)), x["i"])),
            lambda i: i.isNotNull()), lambda i: i)))


def _joined(hashes: Column, step: int) -> Column:
    """Hashes of each element together with the one ``step`` further on."""
    n = F.greatest(F.size(hashes) - step, F.lit(0))
    return F.zip_with(F.slice(hashes, 1, n), F.slice(hashes, step + 1, n), lambda a, b: F.xxhash64(a, b))


def _repeat_words(w: Column) -> Column:
    """Words in repeated windows: window hashes by doubling (2, 4, 8 words); a
    text without a repeated run of 4 words has no repeated window."""
    def of_windows(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(
            let(_repeated_positions(h), _covered))

    return let(_joined(w, 1), lambda two: let(_joined(two, 2), lambda four: F.when(
        F.size(F.array_distinct(four)) == F.size(four), F.lit(0)).otherwise(let(_joined(four, 4), of_windows))))


def text_stats(text: Column) -> Column:
    """One struct with every statistic of a whole text."""
    t = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda line: F.btrim(line, F.lit(SPACES)) != "")
    by_words = let(spaced(t), lambda s: let(words_of_spaced(s), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.char_length(F.replace(s, F.lit(" "), F.lit(""))).cast("long").alias("word_chars"),
        F.size(F.array_distinct(w)).cast("long").alias("n_distinct_words"),
        _repeat_words(w).cast("long").alias("n_repeat_words"))))
    by_lines = let(lines, lambda x: F.struct(
        F.size(x).cast("long").alias("n_lines"),
        (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    return F.struct(
        by_words.alias("w"), by_lines.alias("l"),
        F.regexp_count(t, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.char_length(t) - F.char_length(F.replace(t, F.lit("!"), F.lit("")))).cast("long").alias("n_bangs"),
        F.regexp_count(t, F.lit("[A-Z]")).cast("long").alias("n_upper"),
    )


FEATURES = ("words", "word_length", "symbol_share", "bang_share", "upper_share", "dup_line_share",
            "repeat_share", "distinct_share", "words_per_line")


def _features(s: Column) -> dict[str, Column]:
    n, chars, lines = (F.greatest(c, F.lit(1)).cast("double") for c in (
        s["w"]["n_words"], s["w"]["word_chars"], s["l"]["n_lines"]))
    values = (
        s["w"]["n_words"].cast("double"), s["w"]["word_chars"] / n, s["n_symbols"] / chars, s["n_bangs"] / chars,
        s["n_upper"] / chars, s["l"]["n_dup_lines"] / lines, s["w"]["n_repeat_words"] / n,
        s["w"]["n_distinct_words"] / n, n / lines)
    return dict(zip(FEATURES, values, strict=True))


def _measured(stats: DataFrame, column: str, keep: list[str]) -> DataFrame:
    s = F.col(column)
    counts = {"n_words": s["w"]["n_words"], "word_chars": s["w"]["word_chars"], "n_symbols": s["n_symbols"],
              "n_dup_lines": s["l"]["n_dup_lines"], "n_repeat_words": s["w"]["n_repeat_words"]}
    failed = (counts["n_words"] < MIN_WORDS) | (
        counts["n_repeat_words"] * 100 > counts["n_words"] * MAX_REPEAT_PERCENT)
    return stats.select(*keep, *(c.alias(k) for k, c in counts.items()), failed.alias("base_failed"),
                        *(c.alias(k) for k, c in _features(s).items()))


def measure(docs: DataFrame) -> DataFrame:
    """``doc_id``, the counts, ``base_failed`` and the features of each row."""
    stats = docs.select("doc_id", text_stats(F.col("text")).alias("s"))
    return _measured(materialise(stats, "quality-stats"), "s", ["doc_id"])


def _gain(p0: float, n0: float, p1: float, n1: float) -> float:
    """FOIL gain of a literal that leaves p1, n1 of p0, n0."""
    if p1 <= 0:
        return -1.0
    return p1 * (math.log2(p1 / (p1 + n1)) - math.log2(p0 / (p0 + n0)))


def _all(rule: Rule, value: Callable[[str], Column] = F.col) -> Column:
    out = F.lit(True)
    for x in rule:
        out = out & x.condition(value)
    return out


def _any(rules: list[Rule]) -> Column:
    out = F.lit(False)
    for r in rules:
        out = out | _all(r)
    return out


def _binned(rows: DataFrame, cuts: dict[str, list[float]]) -> DataFrame:
    """``rows`` with ``bins``: for each feature, how many of its cuts are at or below the value."""
    one = "aggregate(array({}), 0, (a, t) -> a + int({} >= t))"
    parts = (one.format(", ".join(f"{v!r}D" for v in c), f) for f, c in cuts.items())
    return materialise(rows.withColumn("bins", F.expr(f"array({', '.join(parts)})")), "quality-binned")


def _histograms(rows: DataFrame, cuts: dict[str, list[float]]) -> dict[tuple[str, int], tuple[float, float]]:
    """(feature, bin) -> (bad, good) counts; at most features x cuts rows reach the driver."""
    got = rows.select("bad", F.posexplode("bins").alias("f", "b")).groupBy("f", "b").agg(
        F.sum("bad").alias("p"), F.sum(1 - F.col("bad")).alias("n")).collect()
    names = list(cuts)
    return {(names[r["f"]], r["b"]): (r["p"], r["n"]) for r in got}


def _best_literal(hist: dict, cuts: dict[str, list[float]]) -> tuple[Literal | None, float, float, float]:
    first = next(iter(cuts))
    p0 = sum(v[0] for k, v in hist.items() if k[0] == first)
    n0 = sum(v[1] for k, v in hist.items() if k[0] == first)
    best, score, left = None, 1e-9, (p0, n0)
    for f, c in cuts.items():
        p = n = 0.0
        for b in range(len(c), 0, -1):
            dp, dn = hist.get((f, b), (0, 0))
            p, n = p + dp, n + dn
            for above, (x, y) in ((True, (p, n)), (False, (p0 - p, n0 - n))):
                if x and (g := _gain(p0, n0, x, y)) > score:
                    best, score, left = Literal(f, above, c[b - 1]), g, (x, y)
    return best, left[0], left[1], p0


def learn(rows: DataFrame, bins: int = 40, min_precision: float = 0.95, min_bad: int = 5) -> list[Rule]:
    """A decision list for ``bad`` (1 or 0) over the feature columns of ``rows``.

    Sequential covering: a rule grows by the literal of highest FOIL gain on
    two thirds of the rows until it covers no good row or nothing gains, loses
    trailing literals while the other third prefers it, is kept if it is precise
    on that third and on all, and the rows that it covers leave.  An imprecise
    rule is set aside: the rows that it covers grow no further rule, but still
    count when one is pruned and judged.  The loop ends when no literal gains on
    ``min_bad`` bad rows; every round takes that many away, so it does end.  All
    labelled rows are used; each step is one aggregate.
    """
    cuts = {}
    probs = [i / bins for i in range(1, bins)] + [0.99, 0.995, 0.999]
    got = rows.agg(*(F.percentile_approx(F.when(F.col("bad") == side, F.col(f)), probs, 2000).alias(f"{f}_{side}")
                     for f in FEATURES for side in (0, 1))).first()
    for f in FEATURES:
        # both classes' quantiles: the rarer class is not lost between cuts
        values = sorted({v for side in (0, 1) for v in (got[f"{f}_{side}"] or [])})
        if len(values) > 1:
            # midpoints stay away from values that rows have
            cuts[f] = [(a + b) / 2 for a, b in zip(values, values[1:], strict=False)]
    rules: list[Rule] = []
    aside: list[Rule] = []
    if not cuts:
        return rules
    rows = _binned(rows, cuts)
    while True:
        left = rows.where(~_any(rules)) if rules else rows
        grow, prune = left.where("fold < 2"), left.where("fold = 2")
        if aside:
            grow = grow.where(~_any(aside))
        rule: Rule = ()
        while True:
            literal, p, n, _ = _best_literal(_histograms(grow.where(_all(rule)), cuts), cuts)
            if literal is None or p < min_bad:
                break
            rule += (literal,)
            if n == 0:
                break
        if not rule:
            break
        prefixes = [rule[:k] for k in range(1, len(rule) + 1)]
        counts = prune.agg(*(F.sum((_all(r) & (F.col("bad") == side)).cast("int")).alias(f"{k}_{side}")
                             for k, r in enumerate(prefixes) for side in (0, 1))).first()
        worth = [((counts[f"{k}_1"] or 0) - (counts[f"{k}_0"] or 0)) / max(
            1, (counts[f"{k}_1"] or 0) + (counts[f"{k}_0"] or 0)) for k in range(len(prefixes))]
        k = max(range(len(prefixes)), key=lambda i: (worth[i], -i))
        rule = prefixes[k]
        confirmed, refuted = counts[f"{k}_1"] or 0, counts[f"{k}_0"] or 0
        on = left.where(_all(rule)).agg(F.sum("bad").alias("p"), F.count(F.lit(1)).alias("n")).first()
        precise = confirmed and confirmed >= min_precision * (confirmed + refuted) and on["p"] >= max(
            min_bad, min_precision * on["n"])
        (rules if precise else aside).append(rule)
    return rules


def decision(rules: list[Rule], value: Callable[[str], Column] = F.col) -> Column:
    """The ordered conditional expression: false at the first rule that fires, else true."""
    out = None
    for r in rules:
        fires = _all(r, value)
        out = F.when(fires, F.lit(False)) if out is None else out.when(fires, F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def training_rows(measured: DataFrame, labels: DataFrame) -> DataFrame:
    """Labelled rows that pass the base rule; a label that is null says nothing."""
    known = labels.where("doc_id is not null and quality in (0, 1)").select(
        "doc_id", (F.lit(1) - F.col("quality")).cast("long").alias("bad"))
    rows = measured.where(~F.col("base_failed")).join(known, "doc_id")
    return materialise(rows.select("bad", F.pmod(F.xxhash64("doc_id"), F.lit(3)).cast("int").alias("fold"),
                                   *FEATURES), "quality-train")


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts, features, ``base_failed`` and ``kept`` of every row of ``docs``.

    Runs the measuring job and the covering loop's aggregates.
    """
    measured = measure(docs)
    rules = learn(training_rows(measured, labels))
    return measured.withColumn("kept", ~F.col("base_failed") & decision(rules))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, with its columns, that the rules keep.

    Texts are measured once for learning and once in the filter, which costs
    less than a second copy of the documents.
    """
    rules = learn(training_rows(measure(docs), labels))

    def kept(s: Column) -> Column:
        failed = (s["w"]["n_words"] < MIN_WORDS) | (
            s["w"]["n_repeat_words"] * 100 > s["w"]["n_words"] * MAX_REPEAT_PERCENT)
        values = F.struct(*(c.alias(k) for k, c in _features(s).items()))
        return ~failed & let(values, lambda f: decision(rules, lambda name: f[name]))

    return docs.where(let(text_stats(F.col("text")), kept))
