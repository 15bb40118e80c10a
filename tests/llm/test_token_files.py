import random

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from genrec.llm import token_files as q
from genrec.session import scratch_dir

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_codes_round_trip():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 3, 4, 5, 1000):
        for top in (2, 300, 70_000, 1 << 20, 1 << 32):
            x = rng.integers(0, top, n, dtype=np.uint64).astype(np.uint32)
            assert (q.unpack(q.pack(x)) == x).all()
    # one control byte for four values, then their bytes
    assert q.pack(np.array([1, 256, 65536, 1 << 24]))[24:] == bytes([0b11100100, 1, 0, 1, 0, 0, 1, 0, 0, 0, 1])


def test_words_give_the_ids_of_whole_texts():
    whole = Tokenizer.from_file(PATH)
    rnd = random.Random(1)
    alphabet = list("abXYZ'éÉİßŞΣσ!?.,<|>&_-0 1\n\t é中ǅŉ́̇\xa0\x85\u3000") + ["<|endoftext|>", "'s", "'LL", "don't"] + [
        chr(c) for c in range(0x21, 0x250)]
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40))) for _ in range(6000)]
    encoder = q.WordEncoder(PATH)
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert ids.tolist() == whole.encode(text, add_special_tokens=False).ids, text
    assert encoder.encode([]) == []


def test_cache_limit_does_not_change_ids(monkeypatch):
    texts = [f"word{i} of {i % 7} more, And {i}more!!" for i in range(300)]
    want = [x.tolist() for x in q.WordEncoder(PATH).encode(texts)]
    monkeypatch.setattr(q, "CACHE_WORDS", 40)
    small = q.WordEncoder(PATH)
    assert [small.encode([t])[0].tolist() for t in texts] == want


def test_files(spark, docs, monkeypatch):
    monkeypatch.setattr(q, "BLOCK_IDS", 50)
    rows = [(9, "The cat.", "s"), (3, None, "s"), (4, "", "s"), (None, "no id", "s"), (7, "long text " * 30000, "s"), (9, "The cat.", "s"),
            (9, "another", "s"), (1, "é 名前", "s")]
    df = docs(rows, ["part", "start"])
    whole = Tokenizer.from_file(PATH)
    path = scratch_dir(spark, "ids")
    id_of = q.write_files(df, path, PATH, partitions=3)
    assert sorted(id_of.tolist()) == list(range(49408)) and id_of[0] in whole.encode("text long", add_special_tokens=False).ids
    back = sorted(q.read_files(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in back] == [None, 1, 3, 4, 7, 9, 9, 9]
    at = 0
    texts = {i: t for i, t, _ in rows}
    for r in back:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert r.start == at and r.n_tokens == len(ids) and ids[-1] == 1
        if r.doc_id != 9:
            assert ids[:-1] == whole.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        at += len(ids)
    got = {(r.doc_id, r.ids_crc32) for r in q.digest(df, PATH).collect()}
    assert (9, q.crc32([*whole.encode("another", add_special_tokens=False).ids, 1])) in got and len(got) == 7
    assert q.digest(docs([]), PATH).count() == 0


def test_ids_next_to_null_ids(spark):
    rows = [(9007199254740993, "one two"), (None, "three"), (9007199254740992, "")]
    got = {r.doc_id: r.n_tokens for r in q.digest(spark.createDataFrame(rows, "doc_id long, text string"), PATH).collect()}
    assert set(got) == {None, 9007199254740992, 9007199254740993} and got[9007199254740992] == 1
