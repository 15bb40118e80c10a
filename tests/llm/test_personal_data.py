import hashlib
import random
import re

from genrec.llm import personal_data as q

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    d = [int(x) for x in d[::-1]]
    return (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0


def good(kind, v):
    d = re.sub("[^0-9]", "", v)
    return {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in v.split(".")),
            "card": lambda: 14 <= len(d) <= 19 and luhn(d), "phone": lambda: 10 <= len(d) <= 15}[kind]()


def brute(text):
    found = [(m.start(), k, m.end(), kind) for k, (kind, p) in enumerate(PLAIN.items())
             for m in re.finditer(p, text or "") if good(kind, m[0])]
    return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(found))


def texts():
    rnd = random.Random(4)
    out = [None, "", "a@b.c_x@d.org", "x@y", "𝕏 é@b.co m.n@o.p", "1.2.3.4.5.6.7.8", "256.1.1.1 000255.0.0.01", "4111 1111 1111 1111",
           "4111-1111 1111-1112", "+1 (555) 555-1234.", "+1 23", "1 " * 30000, "a" * 100000, "9" * 50000, "+" + "1" * 30000, "a.b@" * 2000]
    alphabet = ["a", "Z", "é", ".", "@", "-", " ", "+", "(", ")", "1", "4", "9", "25", "555 0", "4111111111111111", "a@b.co", "1.2.3.4", "\n"]
    return out + ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 25))) for _ in range(400)]


def test_base_spans_equal_plain_patterns(spark, docs):
    rows = [(i, t, "s") for i, t in enumerate(texts())]
    got = {r.doc_id: r for r in q.find(docs(rows, ["spans", "n_email"])).collect()}
    for i, t, _ in rows:
        want = brute(t)
        assert got[i].base_sha256 == hashlib.sha256(want.encode()).hexdigest(), repr(t)[:80]
        assert got[i].n_email == want.count("email:") and got[i].n_card == want.count("card:")
        assert set(want.split(",")) <= set(got[i].spans.split(","))


def _corpus():
    rnd = random.Random(6)

    def word():
        return "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 9)))

    rows, secret = [], {}
    for i in range(400):
        parts = [word() for _ in range(30)]
        if i % 2:
            parts.insert(10, f"{word()}@{word()}.org")
        if i % 4 == 0:
            secret[i] = "".join(rnd.choice("0123456789abcdef") for _ in range(40))
            parts.insert(20, f'token = "{secret[i]}"')
        elif i % 4 == 1:
            parts.insert(20, "".join(rnd.choice("0123456789abcdef") for _ in range(40)))
        rows.append((i, " ".join(parts), "s"))
    return rows, secret


def test_trees_add_named_secrets_only(spark, docs):
    rows, secret = _corpus()
    got = {r.doc_id: r.spans for r in q.find(docs(rows)).collect()}
    for i, text, _ in rows:
        added = [s for s in got[i].split(",") if s.startswith("secret")]
        if i in secret:
            at = text.index(secret[i])
            assert added == [f"secret:{at}:{at + 40}"]
        else:
            assert not added


def test_named_secrets_do_not_depend_on_the_corpus(spark, docs):
    rows, secret = _corpus()
    # a single document, and 300 tokens named and unnamed among them
    for part in (rows[:1], rows[:16], rows * 2):
        got = {r.doc_id: r.spans for r in q.find(docs(part)).collect()}
        for i, text, _ in part:
            at = text.index(secret[i]) if i in secret else 0
            want = [f"secret:{at}:{at + 40}"] if i in secret else []
            assert [s for s in got[i].split(",") if s.startswith("secret")] == want
    assert secret[0] not in q.redact(docs(rows[:1])).first().text


def test_a_stray_negative_does_not_end_a_kind(spark, monkeypatch):
    # the trees' scores are replaced: one held-out negative stands alone at the top
    monkeypatch.setattr(q, "_tree_sql", lambda lines, names: ("if(c.f.length = 99, 1.0D, if(c.f.length = 40, 0.5D, -0.5D))", 1))
    stray = spark.range(1200, 1300).where("pmod(xxhash64(id), 3) = 2").first().id
    features = ", ".join(f"'{n}', {'l' if n == 'length' else '0D'}" for n in q.FEATURES)
    scanned = spark.range(1200).selectExpr("id as doc_id", "if(id % 2 = 1, 40D, 20D) as l").unionAll(
        spark.range(stray, stray + 1).selectExpr("id", "99D")).selectExpr(
        "doc_id", f"""named_struct('base', cast(array() as array<struct<s:int,k:int,e:int>>), 'proposed', array(named_struct(
            's', 0, 'k', 4, 'e', 20, 'f', named_struct({features}), 'named', l = 40D))) as s""")
    assert 4 in q.fit(scanned)[1]


def test_many_matches_in_one_text(spark, docs):
    """Spans, additions and redaction of thousands of matches beside each other, far into a text with wide characters."""
    rnd = random.Random(12)
    parts = []
    for i in range(3000):
        parts.append(rnd.choice(["é𝕏 ", "x", " "]) + rnd.choice([
            f"u{i}@h{i}.org", "10.0.0.7", "+49 30 1234567", f'token = "{i:040x}"', "4111 1111 1111 1111"]) + " ")
    text = "".join(parts)
    row = q.find(docs([(1, text, "s")])).first()
    base = brute(text)
    assert row.base_sha256 == hashlib.sha256(base.encode()).hexdigest() and len(base.split(",")) > 2000
    named = [f"secret:{m.start(1)}:{m.end(1)}" for m in re.finditer('token = "([0-9a-f]{40})"', text)]
    got = row.spans.split(",")
    assert [x for x in got if x.startswith("secret")] == named and len(named) > 400
    out, at = [], 0
    for kind, a, b in (x.split(":") for x in got):
        if int(a) >= at:
            out += [text[at:int(a)], f"[{kind.upper()}]"]
        at = max(at, int(b))
    assert q.redact(docs([(1, text, "s")])).first().text == "".join(out) + text[at:]


def test_redaction(spark, docs):
    rows, secret = _corpus()
    rows += [(900, None, "s"), (901, "mail a@b.co, 1.2.3.4!", "s"), (901, "mail a@b.co, 1.2.3.4!", "s")]
    df = docs(rows, ["pii_scan"])
    out = q.redact(df)
    assert out.columns == df.columns
    by = {r.doc_id: r for r in out.collect()}
    assert out.count() == len(rows)
    assert by[901].text == "mail [EMAIL], [IP]!" and by[901].n_chars == len(by[901].text) and by[900].text is None
    assert not any(s in by[i].text for i, s in secret.items())
    assert q.redact(docs([])).count() == 0 and q.find(docs([])).count() == 0
