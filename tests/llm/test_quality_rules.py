import random
import re
from collections import defaultdict

from genrec.llm import quality_rules as q


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    at = defaultdict(list)
    for i in range(len(w) - 7):
        at[tuple(w[i:i + 8])].append(i)
    covered = {k for places in at.values() if len(places) > 1 for i in places for k in range(i, i + 8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def texts():
    rnd = random.Random(1)
    vocabulary = ["a", "b", "c#", "dé", "e𝕏"]
    out = [None, "", " \t\n\x0b\x0c\r ", "one", "x " * 7, "x " * 8, "x " * 9, "\n".join(["a b"] * 3 + [" a b", "", " "]),
           " ".join(f"w{i}" for i in range(30)), "long " * 20000, "y" * 100000]
    return out + ["".join(rnd.choice(vocabulary) + rnd.choice([" ", "  ", "\n", "\t", "\x0b"]) for _ in range(rnd.randint(1, 60)))
                  for _ in range(60)]


def test_counts_equal_brute_force(spark, docs):
    rows = [(i, t, "s") for i, t in enumerate(texts())]
    got = {r.doc_id: r for r in q.measure(docs(rows)).collect()}
    for i, t, _ in rows:
        r, want = got[i], brute(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, repr(t)[:60]
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])


def _corpus(n=300):
    rnd = random.Random(2)
    rows, labels = [], []
    for i in range(n):
        bad = i % 3 == 0
        words = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 9))) + ("%%" if bad and rnd.random() < 0.8 else "")
                 for _ in range(rnd.randint(40, 80))]
        rows.append((i, " ".join(words), "s"))
        labels.append((i, 0 if bad else 1, 0))
    return rows, labels


def test_learned_list_separates(spark, docs):
    rows, labels = _corpus()
    known = spark.createDataFrame(labels[:200], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.kept for r in q.judge(docs(rows), known).collect()}
    held = [(got[i], bool(good)) for i, good, _ in labels[200:]]
    assert sum(a == b for a, b in held) >= 0.97 * len(held)
    rules = q.learn(q.training_rows(q.measure(docs(rows)), known))
    assert rules and "CASE WHEN" in str(q.decision(rules))


def _rows(spark, rows):
    """Rows for ``learn``: ``bad``, ``fold`` and features, of which those not named are 0."""
    fields = ", ".join(f"{f} double" for f in q.FEATURES)
    return spark.createDataFrame([(bad, i % 3, *(float(v.get(f, 0)) for f in q.FEATURES)) for i, (bad, v) in enumerate(rows)],
                                 f"bad long, fold int, {fields}")


def test_as_many_rules_as_there_are_kinds_of_bad_rows(spark):
    # nine kinds of bad rows, one to a feature; good rows are low everywhere
    rnd = random.Random(5)
    rows = [(0, {f: rnd.random() for f in q.FEATURES}) for _ in range(600)]
    for f in q.FEATURES:
        rows += [(1, {g: rnd.random() + (5 if g == f else 0) for g in q.FEATURES}) for _ in range(60)]
    df = _rows(spark, rows)
    rules = q.learn(df)
    assert {r[0].feature for r in rules} == set(q.FEATURES) and len(rules) >= 9
    judged = df.withColumn("kept", q.decision(rules)).groupBy("bad").agg({"kept": "count"}).collect()
    assert len(judged) == 2
    assert df.where(q.decision(rules)).where("bad = 1").count() == 0
    assert df.where(~q.decision(rules)).where("bad = 0").count() <= 6


def test_an_imprecise_rule_is_set_aside(spark):
    # half of the rows with many symbols are good, whatever else they hold; those with long words are all bad
    rnd = random.Random(9)
    rows = [(0, {"words": rnd.random()}) for _ in range(300)]
    rows += [(rnd.randint(0, 1), {"words": rnd.random(), "symbol_share": 5 + rnd.random()}) for _ in range(600)]
    rows += [(1, {"words": rnd.random(), "word_length": 9 + rnd.random()}) for _ in range(30)]
    df = _rows(spark, rows)
    rules = q.learn(df)
    caught = df.where(~q.decision(rules))
    assert caught.where("word_length > 8").count() == 30
    assert caught.where("bad = 0").count() <= 0.05 * caught.count()


def test_labels_without_a_pattern_end(spark):
    rnd = random.Random(11)
    df = _rows(spark, [(rnd.randint(0, 1), {f: rnd.random() for f in q.FEATURES}) for _ in range(300)])
    rules = q.learn(df)
    assert df.where(~q.decision(rules)).where("bad = 0").count() <= 0.05 * df.count()


def test_edge_tables(spark, docs):
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert q.judge(docs([]), empty).count() == 0
    rows = [(1, None, None), (None, "word " * 3, "s"), (2, " ".join(f"w{i}" for i in range(25)), "s"),
            (2, " ".join(f"w{i}" for i in range(25)), "s")]
    odd = spark.createDataFrame([(None, 1, None), (2, None, 0), (9, 0, 0)], "doc_id long, quality int, toxic int")
    got = sorted((r.doc_id or 0, r.n_words, r.kept) for r in q.judge(docs(rows), odd).collect())
    assert got == [(0, 3, False), (1, 0, False), (2, 25, True), (2, 25, True)]


def test_stage_keeps_columns(spark, docs):
    rows, labels = _corpus(60)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    df = docs(rows + [(99, "short", "s")], ["quality_stats", "n_words"])
    kept = q.keep_good(df, known)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in q.judge(df, known).where("kept").collect()}
