"""Token ids of whole texts, written as byte-aligned variable-length codes and read back.

A block holds the ids of consecutive documents as ranks by corpus frequency
(rank 0: the most frequent id; ties: the smaller id), four ranks to a control
byte that gives their lengths in bytes, and the bytes apart from the control
bytes, so that a decoder finds all lengths with one numpy table lookup.

Defined cases: a null or empty text has only the end id; equal ``doc_id``
values stay separate documents, ordered by a hash of their texts; a null
``doc_id`` comes first; an empty table gives no blocks and an empty result.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genrec.llm.common import Numbers, arrow_batch_rows, materialise
from genrec.session import scratch_dir

MAGIC = b"FRVB1\0\0\0"
BLOCK_IDS = 1 << 19            # a block ends with the document that reaches this many ids
CACHE_WORDS = 1_500_000         # distinct words that a worker remembers before it starts anew
BATCH_ROWS = 256
GROUP_BYTES = 4 << 20           # batches are encoded together up to this many bytes of text

# bytes of each of the four ranks that a control byte describes
_LENGTHS = np.array([[(c >> (2 * k) & 3) + 1 for k in range(4)] for c in range(256)], dtype=np.uint8)


# a word in Latin characters (but U+0130, whose lower case ends in a mark): anything up to its
# last letter, and the signs after it
_SIGNS_AFTER = re.compile("([!-~\u00a1-\u012f\u0131-\u024f]*[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f])([!-/:-@\\[-`{-~]*)")


class WordEncoder:
    """Ids of texts, each distinct word encoded once.

    Splits only at plain spaces and line feeds, which the tokenizer's own
    splitting never crosses, so the ids are those of the whole text.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size()
        added = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(added) or "(?!)")
        self.model = self.tokenizer.model
        self.letters = self._letters()
        self.lettered = re.compile(f"[{''.join(map(chr, self.letters))}]+" if self.letters else "(?!)")
        self._reset()

    def _letters(self) -> dict[int, str]:
        """Small Latin letters that the normalizer leaves alone, each as the model spells it.

        A run of them is one piece to the tokenizer, so the model can be asked directly.
        """
        out = {}
        normal, cut = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        for c in map(chr, range(ord("a"), 0x250)):
            if not c.isalpha() or c in "\u00aa\u00ba" or normal is None or cut is None or normal.normalize_str(c) != c:
                continue
            pieces = cut.pre_tokenize_str(c)
            if len(pieces) == 1 and [t.id for t in self.model.tokenize(pieces[0][0])] == self.tokenizer.encode(
                    c, add_special_tokens=False).ids:
                out[ord(c)] = pieces[0][0]
        return out

    def _reset(self) -> None:
        self.known, self.parts = Numbers(), Numbers()
        self.parts.of([""])                          # the second part of a word that is left whole
        self.parts.new = []
        self.flat = np.empty(0, np.uint32)           # ids of all words one after another
        self.starts = np.zeros(1, np.int64)
        self.part_flat = np.empty(0, np.uint32)      # and of all parts
        self.part_starts = np.zeros(2, np.int64)

    def _encode_parts(self, new: list[str]) -> None:
        direct = [self.lettered.fullmatch(p) is not None for p in new]
        others = iter(self.tokenizer.encode_batch_fast([p for p, d in zip(new, direct, strict=True) if not d],
                                                       add_special_tokens=False))
        spell, ask = self.letters, self.model.tokenize
        got = [[t.id for t in ask(p if p.isascii() else p.translate(spell))] if d else next(others).ids
               for p, d in zip(new, direct, strict=True)]
        n = np.fromiter(map(len, got), np.int64, len(got))
        self.part_flat = np.concatenate([self.part_flat, np.fromiter(chain.from_iterable(got), np.uint32, int(n.sum()))])
        self.part_starts = np.concatenate([self.part_starts, self.part_starts[-1] + np.cumsum(n)])

    def _learn(self, new: list[str]) -> None:
        """Add words.  Of a word in Latin characters, what goes up to its last letter (in lower
        case, as the tokenizer makes it) and the signs after it are looked up
        apart, for the tokenizer cuts between a letter and a sign; a word with one
        of its added tokens is left whole."""
        whole, cut = self.added.search, []
        for w in new:
            m = _SIGNS_AFTER.fullmatch(w)
            cut += (w, "") if m is None or whole(w) else (m[1].lower(), m[2])
        parts = self.parts.of(cut)
        self._encode_parts(self.parts.new)
        self.parts.new = []
        ids, ends = _gathered(self.part_flat, self.part_starts, parts)
        self.flat = np.concatenate([self.flat, ids])
        self.starts = np.concatenate([self.starts, self.starts[-1] + ends[1::2]])

    def encode(self, texts: list[str] | pa.Array) -> list[np.ndarray]:
        if not len(texts):
            return []
        if len(self.known) > CACHE_WORDS:
            self._reset()
        whole = pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string())
        split = pc.split_pattern(pc.replace_substring(whole, "\n", " "), " ")
        # a word is looked up once for all of its places in these texts
        words = split.flatten().dictionary_encode()
        number = self.known.of(words.dictionary.to_numpy(zero_copy_only=False).tolist())
        if self.known.new:
            self._learn(self.known.new)
            self.known.new = []
        ids, ends = _gathered(self.flat, self.starts, number[words.indices.to_numpy()])
        return np.split(ids, ends[split.offsets.to_numpy()[1:-1] - 1])


def _gathered(flat: np.ndarray, starts: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs ``at`` of ``flat``, where run k is ``starts[k]:starts[k + 1]``, and the end of each."""
    first = starts[at]
    lengths = starts[at + 1] - first
    ends = np.cumsum(lengths)
    return flat[np.repeat(first - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)], ends


@lru_cache(maxsize=2)
def _encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def pack(ranks: np.ndarray) -> bytes:
    """Header, control bytes, data bytes."""
    ranks = ranks.astype("<u4")
    n = len(ranks)
    padded = np.zeros(-(-n // 4) * 4, "<u4")
    padded[:n] = ranks
    extra = (padded >= 1 << 8).astype(np.uint8) + (padded >= 1 << 16) + (padded >= 1 << 24)
    quads = extra.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    used = np.arange(4, dtype=np.uint8) <= extra[:, None]
    data = padded.view(np.uint8).reshape(-1, 4)[used]
    return MAGIC + np.array([n, len(control)], "<u8").tobytes() + control.astype(np.uint8).tobytes() + data.tobytes()


def unpack(payload: bytes) -> np.ndarray:
    """The ranks of a block; the inverse of ``pack``."""
    if payload[:8] != MAGIC:
        raise ValueError("not a block of token ids")
    n, n_control = (int(x) for x in np.frombuffer(payload, "<u8", 2, 8))
    control = np.frombuffer(payload, np.uint8, n_control, 24)
    data = np.frombuffer(payload, np.uint8, offset=24 + n_control)
    lengths = _LENGTHS[control].ravel()
    ends = np.cumsum(lengths, dtype=np.int64)
    first = ends - lengths
    out = np.zeros(len(lengths), np.uint32)
    for k in range(int(lengths.max()) if len(lengths) else 0):
        has = lengths > k
        out[has] |= data[first[has] + k].astype(np.uint32) << np.uint32(8 * k)
    return out[:n]


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Runs of batches as tables, each ended by the batch that reaches ``GROUP_BYTES``."""
    held, size = [], 0
    for b in batches:
        if b.num_rows:
            held.append(b)
            size += b.nbytes
        if size >= GROUP_BYTES:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def encode(docs: DataFrame, tokenizer: str, end_id: int = 1, partitions: int | None = None) -> DataFrame:
    """``part, doc_id, none, first, n_tokens, ids`` of every row, written and reread; ``none`` marks a null ``doc_id``.

    Rows are range-partitioned by ``doc_id``; ``part`` numbers the ranges in
    ascending order and ``first`` counts the ids before a document in its
    range.  ``ids`` holds little-endian unsigned integers of 2 bytes, or 4 if
    the tokenizer has more than 65536 ids.
    """
    spark = docs.sparkSession
    arrow_batch_rows(spark, BATCH_ROWS)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        kind = "<u2" if max(encoder.size, end_id + 1) <= 1 << 16 else "<u4"
        done = 0
        for b in _grouped(batches):
            ids = [np.append(x, end_id).astype(kind) for x in encoder.encode(b["text"].combine_chunks())]
            n_tokens = np.array([len(x) for x in ids], dtype=np.int64)
            first = done + np.cumsum(n_tokens) - n_tokens
            done += int(n_tokens.sum())
            out = b.drop_columns("text").combine_chunks().append_column("first", pa.array(first)).append_column(
                "n_tokens", pa.array(n_tokens)).append_column("ids", pa.array([x.tobytes() for x in ids], pa.binary()))
            yield from out.to_batches()

    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
               .withColumn("tie", F.xxhash64("text"))
               .repartitionByRange(n, "doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text"))
    # ids travel as whole numbers beside the mark of a null: a column with nulls would become floating
    rows = ordered.select(F.spark_partition_id().alias("part"), F.coalesce("doc_id", F.lit(0)).alias("doc_id"),
                          F.col("doc_id").isNull().alias("none"), "text").mapInArrow(
        run, "part int, doc_id long, none boolean, first long, n_tokens long, ids binary")
    return materialise(rows, "token-ids")


def _width(spark: SparkSession, tokenizer: str, end_id: int) -> str:
    return "<u2" if max(_encoder(tokenizer).size, end_id + 1) <= 1 << 16 else "<u4"


def frequency_ranks(encoded: DataFrame, kind: str, size: int) -> np.ndarray:
    """``ids[rank]`` over the whole corpus; one partial count per task, at most ``size`` rows to the driver."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(size, np.int64)
        for b in batches:
            for x in b["ids"]:
                total += np.bincount(np.frombuffer(x, kind), minlength=size)
        ids = np.flatnonzero(total)
        yield pd.DataFrame({"id": ids, "n": total[ids]})

    counted = encoded.select("ids").mapInPandas(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    n = np.zeros(size, np.int64)
    for r in counted.collect():
        n[r["id"]] = r["n"]
    return np.lexsort((np.arange(size), -n)).astype(np.uint32)


def write_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1,
                partitions: int | None = None) -> np.ndarray:
    """Write the id files of ``docs`` to ``path`` and return the id of each rank.

    ``path/blocks/part=N`` in ascending N holds ascending ``doc_id`` ranges;
    ``path/ranks`` the ids by rank.  Runs the encoding job, two aggregates over
    its ids and the writing job.
    """
    spark = docs.sparkSession
    encoded = encode(docs, tokenizer, end_id, partitions)
    encoder = _encoder(tokenizer)
    kind = _width(spark, tokenizer, end_id)
    id_of = frequency_ranks(encoded, kind, max(encoder.size, end_id + 1))
    # one row per range, as many as the partitions asked for
    totals = {r["part"]: r["n"] for r in encoded.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()}
    before, done = {}, 0
    for p in sorted(totals):
        before[p], done = done, done + totals[p]
    rank_of = np.empty_like(id_of)
    rank_of[id_of] = np.arange(len(id_of), dtype=np.uint32)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []

        def block() -> pd.DataFrame:
            ranks = rank_of[np.concatenate([np.frombuffer(x[5], kind) for x in held])]
            return pd.DataFrame({
                "part": [held[0][0]], "start": [before[held[0][0]] + held[0][3]],
                "doc_ids": [[None if x[2] else x[1] for x in held]],
                "n_tokens": [[x[4] for x in held]], "payload": [pack(ranks)]})

        size = 0
        for b in batches:
            for row in b.itertuples(index=False):
                if held and (row[0] != held[0][0] or row[3] != held[-1][3] + held[-1][4] or size >= BLOCK_IDS):
                    yield block()
                    held, size = [], 0
                held.append(tuple(row))
                size += row[4]
        if held:
            yield block()

    encoded.mapInPandas(run, "part int, start long, doc_ids array<long>, n_tokens array<long>, payload binary") \
        .write.partitionBy("part").parquet(f"{path}/blocks")
    spark.createDataFrame([(i, int(x)) for i, x in enumerate(id_of)], "rank long, id long") \
        .coalesce(1).write.parquet(f"{path}/ranks")
    return id_of


BLOCK_SCHEMA = "start long, doc_ids array<long>, n_tokens array<long>, payload binary, part int"


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document in the files at ``path``."""
    ids = spark.read.parquet(f"{path}/ranks").orderBy("rank").collect()   # one row per id of the tokenizer
    id_of = np.array([r["id"] for r in ids], dtype="<u4")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for row in b.itertuples(index=False):
                n = np.asarray(row.n_tokens, dtype=np.int64)
                ends = np.cumsum(n)
                parts = np.split(id_of[unpack(row.payload)], ends[:-1])
                yield pd.DataFrame({"doc_id": pd.array(list(row.doc_ids), dtype="Int64"), "start": row.start + ends - n,
                                    "n_tokens": n, "ids": [x.tobytes() for x in parts]})

    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks")
    return blocks.select("start", "doc_ids", "n_tokens", "payload").mapInPandas(
        run, "doc_id long, start long, n_tokens long, ids binary")


def digest(docs: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` from files written for ``docs`` and read back."""
    spark = docs.sparkSession
    path = scratch_dir(spark, "token-files")
    write_files(docs, path, tokenizer, end_id)
    return read_files(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def crc32(ids: list[int]) -> int:
    """The digest of one document's ids, end id included."""
    return zlib.crc32(np.asarray(ids, dtype="<u4").tobytes())
