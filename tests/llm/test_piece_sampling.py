import math
from collections import Counter
from dataclasses import fields

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from genrec.llm import piece_sampling as q

MODEL = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["", "a", " the  cat\n𝕏é sat", "\n\n x", "x" * 500, "one two", "tab\there  ", "▁ sign", "名前 и слово"]


@pytest.fixture(scope="module")
def pieces():
    return q.Pieces(MODEL)


def segmentations(lat, place):
    if place < 0:
        return [((), 0.0)]
    return [((a, *rest), lat.logp[a] + p) for a in range(lat.first[place], lat.first[place + 1])
            for rest, p in segmentations(lat, lat.to[a])]


def test_round_trip(pieces):
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for text, got in zip(TEXTS, q.sample(TEXTS, list(range(len(TEXTS))), pieces, 4), strict=True):
        assert len({tuple(x.tolist()) for x, _, _ in got}) == len(got) >= 1
        for ids, _, score in got:
            assert pieces.decode(ids) == sp.decode(ids.tolist()) == text.replace("▁", " ")
            assert score <= 0


def test_lattice_is_normalised_and_complete(pieces):
    lat = q.lattice(["▁then", "▁é", "q"], pieces)
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for word, start in zip(["▁then", "▁é", "q"], lat.start, strict=True):
        all_ways = segmentations(lat, start)
        assert math.isclose(sum(math.exp(p) for _, p in all_ways), 1)
        want = 0
        for cuts in range(1 << (len(word) - 1)):
            parts, last = [], 0
            for i in range(1, len(word) + 1):
                if i == len(word) or cuts >> (i - 1) & 1:
                    parts.append(word[last:i])
                    last = i
            want += all(sp.piece_to_id(p) != sp.unk_id() for p in parts)
        assert len(all_ways) == want


def test_sampling_without_replacement(pieces):
    """First and second draws follow the sequential law, and inclusion scores are unbiased."""
    lat = q.lattice(["▁then"], pieces)
    law = {tuple(int(lat.ids[a]) for a in path): math.exp(p) for path, p in segmentations(lat, lat.start[0])}
    n = 8000
    keys = np.random.default_rng(3).integers(-2**62, 2**62, n).tolist()
    got = q.sample(["then"] * n, keys, pieces, 2)
    first = Counter(tuple(x[0][0].tolist()) for x in got)
    second = Counter(tuple(x[1][0].tolist()) for x in got)
    weighted = Counter()
    for x in got:
        for ids, logp, score in x:
            weighted[tuple(ids.tolist())] += math.exp(logp - score)
    for way, p in sorted(law.items(), key=lambda x: -x[1])[:3]:
        then = sum(law[o] * p / (1 - law[o]) for o in law if o != way)
        for seen, expected in ((first[way] / n, p), (second[way] / n, then)):
            assert abs(seen - expected) < 4.5 * math.sqrt(expected / n)
        # Horvitz-Thompson: probability over inclusion estimates the probability
        assert abs(weighted[way] / n - p) < 0.05


def test_all_segmentations_when_k_is_large(pieces):
    lat = q.lattice(["▁at"], pieces)
    ways = {tuple(int(lat.ids[a]) for a in path) for path, _ in segmentations(lat, lat.start[0])}
    got = q.sample(["at"], [7], pieces, 50)[0]
    assert {tuple(x.tolist()) for x, _, _ in got} == ways and all(s == 0 for _, _, s in got)


def test_batches_do_not_matter(pieces):
    alone = [q.sample([t], [i], pieces, 3)[0] for i, t in enumerate(TEXTS)]
    for a, b in zip(alone, q.sample(TEXTS, list(range(len(TEXTS))), pieces, 3), strict=True):
        assert [x.tolist() for x, _, _ in a] == [x.tolist() for x, _, _ in b]


def test_tables(spark, docs):
    rows = [(i, t, "s") for i, t in enumerate([*TEXTS, None, "two words " * 20000])] + [(1, "a", "s"), (None, "no id", "s")]
    df = docs(rows, ["sample", "ids"])
    digest = q.encode(df, MODEL, digest=True).collect()
    assert all(r.round_trip for r in digest)
    assert {r.doc_id for r in digest} == {r[0] for r in rows}
    assert [r.n_tokens for r in digest if r.doc_id in (0, len(TEXTS))] == [0, 0]
    encoded = q.encode(df, MODEL, k=2)
    texts = {r.doc_id: r.text for r in q.decode(encoded, MODEL).collect()}
    assert all(texts[i] == (t or "").replace("▁", " ") for i, t, _ in rows)
    assert q.encode(docs([]), MODEL).count() == 0


def test_ids_next_to_null_ids(spark):
    rows = [(9007199254740993, "one two"), (None, "three"), (-1, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = q.encode(df, MODEL, 1)
    assert {r.doc_id for r in got.collect()} == {9007199254740993, None, -1}
    assert {(r.doc_id, r.text) for r in q.decode(got, MODEL).collect()} == set(rows)


def test_split_equals_the_pattern():
    for text in [*TEXTS, "a b", "a\nb c", "\na", "a\n", "a ", "a \n b", "\n", "x  y z", " a", "a\n\nb"]:
        assert q.text_words(text) == (q._WORD.findall(q.SPACE + text.replace(" ", q.SPACE)) if text else [])


def test_lexicon_starts_anew_and_changes_nothing(pieces, monkeypatch):
    texts = [f"word{i} and {'x' * (i % 7)} sigh" for i in range(60)]
    want = [[x[0].tolist() for x in got] for got in q.sample(texts, list(range(60)), q.Pieces(MODEL), 3)]
    monkeypatch.setattr(q, "LEXICON_CHARS", 50)
    few = q.Pieces(MODEL)
    got = [[x[0].tolist() for x in q.sample([t], [i], few, 3)[0]] for i, t in enumerate(texts)]
    assert got == want and few.lexicon.chars < 200


def test_lattices_are_added_in_place():
    """A batch's new words cost what they hold, not what the worker remembers."""
    lexicon, held = q.Pieces(MODEL).lexicon, []
    for words in ([f"▁{a}{b}{c}" for a in "abcdefgh" for b in "aeiou" for c in "lmnrst"], ["▁other"], ["▁further"]):
        lexicon.look_up(words)
        held.append(lexicon.lattice)
    for f in fields(q.Lattice):
        assert np.shares_memory(getattr(held[1], f.name), getattr(held[2], f.name)), f.name
    whole = q.lattice(list(lexicon.unit), lexicon.pieces)
    assert len(whole.ids) == len(held[2].ids) > len(held[1].ids)
    assert np.allclose(np.sort(whole.logp), np.sort(held[2].logp))
    assert np.array_equal(np.diff(held[2].first)[held[2].start], np.diff(whole.first)[whole.start])


def test_a_worker_remembers_little(monkeypatch):
    """Words met once are forgotten, those met often stay; at most a batch's words are held beyond the limit."""
    monkeypatch.setattr(q, "LEXICON_CHARS", 2000)
    lexicon, most = q.Pieces(MODEL).lexicon, 0
    for i in range(60):
        lexicon.look_up([f"\u2581met{chr(97 + i // 26)}{chr(97 + i % 26)}{chr(97 + j // 26)}{chr(97 + j % 26)}" for j in range(40)] + ["\u2581often", "\u2581x=1"] * 3)
        most = max(most, lexicon.chars)
        assert lexicon.chars == sum(map(len, lexicon.unit)) and len(lexicon.word) == len(lexicon.count) == len(lexicon.met)
        for name, n in (("\u2581often", 1), ("\u2581x=1", len(q._units(["\u2581x=1"], lexicon.pieces)[0]))):
            at = lexicon.word[name]
            assert lexicon.count[at] == n
            assert at < lexicon.core[0] if lexicon.core else True
    assert most < 2000 + 40 * 10 + 20 and lexicon.core and lexicon.returns
    whole = q.lattice(list(lexicon.unit), lexicon.pieces)
    assert np.allclose(np.sort(whole.logp), np.sort(lexicon.lattice.logp))
    assert sum(getattr(lexicon.lattice, f.name).itemsize for f in fields(q.Lattice)) <= 48


def test_sets_are_drawn_near_the_beginning(pieces, monkeypatch):
    """Sets far along a path are too unlikely to hold a next segmentation; those drawn change no sample."""
    texts = ["the quick brown fox jumps over a lazy dog " * 60, "a", "of it", "", "x" * 400, "one two three"]
    drawn = []
    below = q._below

    def counted(limit, location, u):
        drawn.append(len(location))
        return below(limit, location, u)

    monkeypatch.setattr(q, "_below", counted)
    few = q.sample(texts, list(range(6)), pieces, 3)
    near = sum(drawn)
    drawn.clear()
    monkeypatch.setattr(q, "NEAR", 1e9)
    every = q.sample(texts, list(range(6)), pieces, 3)
    assert near * 2 < sum(drawn)
    for a, b in zip(few, every, strict=True):
        assert [(x.tolist(), p, s) for x, p, s in a] == [(x.tolist(), p, s) for x, p, s in b]
    monkeypatch.setattr(q, "NEAR", 1e-3)             # too near: the rest is drawn after all
    rest = q.sample(texts, list(range(6)), pieces, 3)
    assert [[x.tolist() for x, _, _ in a] for a in rest] == [[x.tolist() for x, _, _ in a] for a in every]


def test_samples_are_decoded_together(pieces, monkeypatch):
    """The bytes of several samples are put together in bulk, in bounded slices."""
    got = [ids for text in q.sample(TEXTS, list(range(len(TEXTS))), pieces, 3) for ids, _, _ in text]
    joined = [b"".join(pieces.bytes[i] for i in ids.tolist()) for ids in got]
    want = [x[1:] if x[:1] == b" " else x for x in joined]
    assert pieces.decode_bytes(got) == want and pieces.decode_bytes([]) == []
    assert [pieces.decode(ids) for ids in got] == [x.decode("utf-8", "replace") for x in want]
    monkeypatch.setattr(q, "DECODED", 3)
    assert pieces.decode_bytes(got) == want


def test_a_worker_goes_back_at_once(monkeypatch):
    """Words that are forgotten are not taken out one by one."""
    monkeypatch.setattr(q, "LEXICON_CHARS", 2000)
    monkeypatch.setattr(q.Numbers, "popitem", None)
    lexicon, back = q.Pieces(MODEL).lexicon, 0
    for i in range(60):
        words = [f"\u2581met{chr(97 + i // 26)}{chr(97 + i % 26)}{chr(97 + j // 26)}{chr(97 + j % 26)}" for j in range(40)]
        back += lexicon.chars > 2000 and bool(lexicon.core) and lexicon.returns < q.RENEWED
        lexicon.look_up([*words, "\u2581often", "\u2581often"])
        assert list(lexicon.word.values()) == list(range(len(lexicon.count)))
        assert list(lexicon.unit.values()) == list(range(len(lexicon.lattice.start)))
    assert back > 3
