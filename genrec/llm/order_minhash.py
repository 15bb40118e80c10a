"""Near-duplicate documents by Order MinHash and banded alignment.

A text is the sequence of its five-word shingles (a shorter text: one shingle
of all its words).  For sketches and counts each is labelled with its
occurrence number.  A sketch keeps the ``l`` labelled shingles of smallest hash
in text order; two texts are candidates if one of their sketches agrees.
Candidates are verified by an alignment of their unlabelled shingle sequences
inside the band that the threshold allows: ``matched / (n_a + n_b - matched) >= 0.8``.

Links are found between distinct texts and copies share their text's class.
Sketch collisions give candidate groups; a group's most typical text is
compared with all of it first, and only texts that are not yet joined that way
are compared further, in blocks of bounded size, so a large group does not
compare all pairs and no candidate link between different texts is lost.

Defined cases: a null or blank text has no shingles and is a class of its own;
copies (repeated rows among them) share a class, whose id is its smallest
``doc_id`` (null only if it has no other); an empty table gives an empty result.

With ``SKETCHES`` a pair of similarity 0.8 is missed with a probability below
1e-5 (60 shingles or more) or 1e-6 (less), if its shingles do not repeat; see tests.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genrec.llm.common import arrow_batch_rows, free_name, let, materialise, words
from genrec.llm.graph import components

SHINGLE_WORDS = 5
THRESHOLD = 0.8
# (fewest shingles, fewer than, sketches, labelled shingles kept in each): the
# ranges overlap by more than the factor 0.8, so similar texts meet in one of them
SKETCHES = ((1, 100, 16, 2), (60, None, 40, 6))
BLOCK_TEXTS = 100              # texts in a block of a group
BLOCK_SHINGLES = 200_000
BATCH_ROWS = 256


def shingles(text: Column) -> Column:
    """Hashes of the five-word shingles of a whole text, in text order."""
    def pair(a: Column, b: Column, step: int) -> Column:
        n = F.greatest(F.size(b) - step, F.lit(0))
        return F.zip_with(F.slice(a, 1, n), F.slice(b, step + 1, n), lambda x, y: F.xxhash64(x, y))

    hashed = F.transform(words(text), lambda w: F.xxhash64(w))
    return let(hashed, lambda one: F.when(F.size(one) == 0, one).when(
        F.size(one) < SHINGLE_WORDS, F.array(F.xxhash64(one))).otherwise(
        let(pair(one, one, 1), lambda two: let(pair(two, two, 2), lambda four: pair(four, one, 4)))))


def labelled(s: np.ndarray) -> np.ndarray:
    """Shingle hashes made distinct by their occurrence numbers."""
    s = s.astype(np.uint64)
    order = np.argsort(s, kind="stable")
    ranked = s[order]
    first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    if len(first) == len(s):
        return s
    nth = np.arange(len(s)) - np.repeat(first, np.diff(np.append(first, len(s))))
    out = s.copy()
    out[order] ^= nth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return out


def _multipliers(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, (n, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def sketch_keys(s: np.ndarray) -> list[int]:
    """One signed 64-bit key for each sketch of a text."""
    x = labelled(s)
    out: list[int] = []
    for k, (least, below, n_sketches, size) in enumerate(SKETCHES):
        if len(x) < least or below is not None and len(x) >= below:
            continue
        a = _multipliers(n_sketches, k)
        size = min(size, len(x))
        with np.errstate(over="ignore"):
            h = x[None, :] * a
            h ^= h >> np.uint64(32)
            h *= a
            at = np.argpartition(h, size - 1, axis=1)[:, :size] if len(x) > size else np.tile(
                np.arange(size), (n_sketches, 1))
            at.sort(axis=1)
            key = (np.arange(n_sketches, dtype=np.uint64) + np.uint64(1 + 1000 * k)) * np.uint64(0xD6E8FEB86659FD93)
            for c in range(size):
                key = (key ^ x[at[:, c]]) * np.uint64(0xFF51AFD7ED558CCD)
                key ^= key >> np.uint64(33)
        out += key.view(np.int64).tolist()
    return out


def aligned(a: np.ndarray, b: np.ndarray, threshold: float = THRESHOLD) -> int:
    """Most shingles of ``a`` and ``b`` that match in the same order within the band
    of diagonals that the threshold leaves reachable; any two equal shingles match."""
    band = int((len(a) + len(b)) * (1 - threshold) / (1 + threshold)) + 1
    i, j = np.flatnonzero(np.isin(a, b)), np.flatnonzero(np.isin(b, a))
    if len(np.unique(a[i])) < len(i) or len(np.unique(b[j])) < len(j):
        return _aligned_repeats(a[i], i, b[j], j, band)
    # every shingle matches once, so the alignment is the longest increasing run of positions
    j = j[np.argsort(b[j])][np.argsort(np.argsort(a[i]))]
    j = j[np.abs(i - j) <= band]
    if len(j) < 2 or (j[1:] > j[:-1]).all():
        return len(j)
    tails: list[int] = []
    for p in j.tolist():
        k = bisect_left(tails, p)
        tails[k:k + 1] = [p]
    return len(tails)


def _aligned_repeats(a: np.ndarray, at_a: np.ndarray, b: np.ndarray, at_b: np.ndarray, band: int) -> int:
    """Longest common subsequence of ``a`` and ``b``, which stand at ``at_a`` and ``at_b``
    and match at most ``band`` places apart.

    Bit-parallel: a 0 in ``row`` is a place of ``b`` where the longest alignment so far
    grows by one; places below the band no longer change and are counted and shifted out.
    """
    places: dict[int, list[int]] = {}
    for p, x in enumerate(b.tolist()):
        places.setdefault(x, []).append(p)
    whole: dict[int, int] = {}
    lows, highs = np.searchsorted(at_b, at_a - band, "left"), np.searchsorted(at_b, at_a + band, "right")
    matched = low = high = row = 0
    for x, lo, hi in zip(a.tolist(), lows.tolist(), highs.tolist(), strict=True):
        if hi > high:
            row |= ((1 << (hi - high)) - 1) << (high - low)
            high = hi
        if lo > low:
            matched += lo - low - (row & ((1 << (lo - low)) - 1)).bit_count()
            row >>= lo - low
            low = lo
        own = places[x]
        if len(own) <= 16:
            match = sum(1 << (p - low) for p in own if low <= p < high)
        else:
            if x not in whole:
                whole[x] = int.from_bytes(np.packbits(b == x, bitorder="little").tobytes(), "little")
            match = whole[x] >> low
        match &= row
        if match:
            row = ((row + match) | (row ^ match)) & ((1 << (high - low)) - 1)
    return matched + high - low - row.bit_count()


def similar(a: np.ndarray, b: np.ndarray, threshold: float = THRESHOLD) -> bool:
    def enough(m: int) -> bool:
        return m >= threshold * (len(a) + len(b) - m) - 1e-9

    # shared labelled shingles bound the alignment
    return enough(len(np.intersect1d(labelled(a), labelled(b), assume_unique=True))) and enough(aligned(a, b, threshold))


class _Forest:
    """Union-find over the texts of a block pair."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


def _block_links(nodes: list[int], joined: list[int], sides: list[int], texts: list[np.ndarray],
                 threshold: float) -> list[tuple[int, int]]:
    """Links between side 0 and side 1 (or within side 0) that join texts not joined yet.

    Shared labelled shingles are counted through the postings of one side; only
    pairs that reach the threshold without regard to order are aligned.
    """
    left = [i for i, s in enumerate(sides) if s == 0]
    right = [i for i, s in enumerate(sides) if s == 1] or left
    forest = _Forest(len(nodes))
    by_hub: dict[int, int] = {}
    for i, hub in enumerate(joined):
        if hub >= 0:
            forest.join(by_hub.setdefault(hub, i), i)
    x = [labelled(t) for t in texts]
    flat = np.concatenate([x[i] for i in right])
    owner = np.repeat(np.arange(len(right)), [len(x[i]) for i in right])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    sizes = np.array([len(x[i]) for i in right])
    out = []
    for i in left:
        lo, hi = np.searchsorted(flat, x[i], "left"), np.searchsorted(flat, x[i], "right")
        n = hi - lo
        ends = np.cumsum(n)
        shared = np.bincount(owner[np.repeat(lo - (ends - n), n) + np.arange(ends[-1])], minlength=len(right))
        near = np.flatnonzero(shared >= threshold * (sizes + len(x[i]) - shared) - 1e-9)
        for k in near.tolist():
            j = right[k]
            if i != j and forest.root(i) != forest.root(j) and similar(texts[i], texts[j], threshold):
                forest.join(i, j)
                out.append((nodes[i], nodes[j]))
    return out


def _groups(candidates: DataFrame) -> DataFrame:
    """``node, grp, n, texts_in_group``: candidate groups, by sketch collisions; also ``weight``,
    how many texts share the node's sketches."""
    rows = candidates.select("node", "n", F.explode("keys").alias("key"))
    buckets = materialise(rows.groupBy("key").agg(F.min("node").alias("least"), F.max("node").alias("most"),
                                                  F.count(F.lit(1)).alias("members")).where("least <> most"), "omh-buckets")
    met = materialise(rows.join(buckets, "key").select("node", "n", "least", "members"), "omh-met")
    groups = components(met.select(F.col("node").alias("a"), F.col("least").alias("b")), "omh-groups")
    weights = met.groupBy("node", "n").agg(F.sum("members").alias("weight"))
    return weights.join(groups, "node").withColumnRenamed("component", "grp")


def links(docs: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """``(members, links)``: ``doc_id, node`` of every row (node null: no words), and links
    ``a, b`` between nodes whose components are those of all verified candidate links.

    Runs the sketching job, the rounds of the candidate groups and two verifying jobs.
    """
    spark = docs.sparkSession
    arrow_batch_rows(spark, BATCH_ROWS)
    source = docs.select("doc_id", "text").withColumn("node", F.xxhash64("text", F.length("text")))

    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            s = [np.asarray(x, dtype=np.int64) for x in b["s"]]
            yield pd.DataFrame({"doc_id": b["doc_id"], "none": b["none"], "node": b["node"],
                                "n": [len(x) for x in s], "keys": [sketch_keys(x) if len(x) else [] for x in s]})

    # ids travel as whole numbers beside the mark of a null: a column with nulls would become floating
    doc = F.col("doc_id").cast("long")
    sketched = materialise(source.select(F.coalesce(doc, F.lit(0)).alias("doc_id"), doc.isNull().alias("none"), "node",
                                         shingles(F.col("text")).alias("s")).mapInPandas(
        sketch, "doc_id long, none boolean, node long, n int, keys array<long>").withColumn(
        "doc_id", F.when(~F.col("none"), F.col("doc_id"))).drop("none"), "omh-sketches")
    members = sketched.select("doc_id", F.when(F.col("n") > 0, F.col("node")).alias("node"))
    # one row for each text: copies have equal sketches, and collapse before the shuffle
    distinct = sketched.where("n > 0").select("node", "n", "keys").dropDuplicates(["node"])
    groups = materialise(_groups(distinct), "omh-members")

    # a group's most typical text is compared with the whole group first
    of_group = materialise(groups.groupBy("grp").agg(
        F.max_by("node", F.struct("weight", "node")).alias("hub"), F.count(F.lit(1)).alias("texts"),
        F.sum("n").alias("size")).where("texts > 1"), "omh-hubs")
    wanted = groups.join(of_group, "grp")
    # copies carry the same shingles; one of them is enough
    carrier = sketched.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("id")).join(
        wanted.select("node", "grp", "hub", "texts", "size"), "node").withColumnRenamed("node", "of")
    text_of = materialise(source.join(
        carrier, (F.col("node") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("id"))).dropDuplicates(["node"]).select(
        "node", "grp", "hub", "texts", "size", shingles(F.col("text")).alias("s")), "omh-texts")
    hubs = text_of.where("node = hub").select("grp", F.col("s").alias("hub_s"))

    def with_hub(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            near = [node == hub or similar(np.asarray(s), np.asarray(h), threshold)
                    for node, hub, s, h in zip(b["node"], b["hub"], b["s"], b["hub_s"], strict=True)]
            yield pd.DataFrame({"node": b["node"], "near": near})

    checked = materialise(text_of.join(hubs, "grp").select("node", "hub", "s", "hub_s").mapInPandas(
        with_hub, "node long, near boolean"), "omh-near")
    rest = text_of.join(checked, "node")
    star = rest.where("near and node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b"))
    open_groups = checked.join(text_of.select("node", "grp"), "node").groupBy("grp").agg(
        F.sum((~F.col("near")).cast("int")).alias("far")).where("far > 0")
    rest = rest.join(open_groups, "grp")

    # blocks: texts that the hub did not join (far) against each other and against those it did
    share = F.ceil(F.greatest(F.col("texts") / BLOCK_TEXTS, F.col("size") / BLOCK_SHINGLES)).cast("int")
    far_blocks = F.ceil(share * F.col("far") / F.col("texts")).cast("int")
    far_no, near_no = F.pmod(F.col("node"), F.greatest(far_blocks, F.lit(1))), F.pmod(F.col("node"), share)
    all_far = F.sequence(F.lit(0), F.greatest(far_blocks, F.lit(1)) - 1)
    pairs = F.when(F.col("near"), F.transform(all_far, lambda k: F.struct(
        k.cast("long").alias("i"), near_no.cast("long").alias("j"), F.lit(True).alias("mixed"), F.lit(1).alias("side")))
    ).otherwise(F.concat(
        F.transform(all_far, lambda k: F.struct(
            F.least(k, far_no).cast("long").alias("i"), F.greatest(k, far_no).cast("long").alias("j"),
            F.lit(False).alias("mixed"), (far_no > k).cast("int").alias("side"))),
        F.transform(F.sequence(F.lit(0), share - 1), lambda k: F.struct(
            far_no.cast("long").alias("i"), k.cast("long").alias("j"), F.lit(True).alias("mixed"), F.lit(0).alias("side")))))
    dealt = rest.select("grp", "node", "s", F.when(F.col("near"), F.col("hub")).otherwise(F.lit(None)).alias("hub"),
                        F.explode(pairs).alias("p")).select("grp", "p.*", "node", "hub", "s")

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []

        def found() -> pd.DataFrame:
            sides = [r[4] for r in held]
            mixed = held[0][3]
            usable = len(held) > 1 and 0 in sides and (not mixed or 1 in sides)
            got = _block_links([r[5] for r in held], [-1 if pd.isna(r[6]) else 0 for r in held], sides,
                               [np.asarray(r[7]) for r in held], threshold) if usable else []
            return pd.DataFrame(got, columns=["a", "b"], dtype="int64")

        for b in batches:
            b["hub"] = b["hub"].astype("Int64")
            for r in b.itertuples(index=False, name=None):
                if held and r[:4] != held[0][:4]:
                    yield found()
                    held = []
                held.append(r)
        if held:
            yield found()

    more = dealt.repartition("grp", "i", "j", "mixed").sortWithinPartitions("grp", "i", "j", "mixed").mapInPandas(
        verify, "a long, b long")
    return members, materialise(star.unionAll(more), "omh-links")


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, component_id, kept`` of every row: the smallest ``doc_id`` of its
    class, and whether the row has it."""
    members, found = links(docs, threshold)
    whole = components(found, "omh-classes")
    named = members.join(whole, "node", "left").select(
        "doc_id", F.coalesce("component", "node").alias("class"))
    least = named.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("component_id"))
    out = named.join(least, "class", "left").select("doc_id", F.when(
        F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_copies(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, with its columns, one for each class: the smallest
    ``doc_id`` (of repeated rows any one; rows without words all stay)."""
    column = free_name(docs, "omh_node")
    kept_ids = free_name(docs, "omh_class")
    members, found = links(docs, threshold)
    whole = components(found, "omh-classes")
    named = members.where("node is not null").distinct().join(whole, "node", "left").select(
        "doc_id", "node", F.coalesce("component", "node").alias("class"))
    first = named.groupBy("class").agg(F.min(F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "node")).alias("f"))
    keep = first.select(F.col("f.doc_id").alias(kept_ids), F.col("f.node").alias(column))
    rows = docs.withColumn(f"{column}_own", F.xxhash64("text", F.length("text"))).withColumn(
        f"{column}_blank", F.btrim(F.coalesce("text", F.lit("")), F.lit(" \t\n\x0b\x0c\r")) == "")
    own = [F.col(f"`{c}`") for c in docs.columns]
    blank = rows.where(f"{column}_blank").select(own)
    worded = rows.where(~F.col(f"{column}_blank")).join(
        keep, (F.col("doc_id").eqNullSafe(F.col(kept_ids))) & (F.col(f"{column}_own") == F.col(column)))
    return worded.dropDuplicates([column]).select(own).unionAll(blank)
