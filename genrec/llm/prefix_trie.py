"""The trie of conversation prefixes, from ROLLUPs over positional turn columns.

A conversation becomes one row per block of ``BLOCK`` turns: the key of the node
at which the block begins, and a column per position that holds the turn's id.
``GROUP BY block, node, ROLLUP (t1, ..., t8)`` then has a group for every
prefix; ``grouping_id`` gives its depth.  Blocks of a long conversation are keyed
by the node that the block before ends in, so all blocks are rolled up in the
same query, however long the longest conversation is.

A node's key is its depth and 128 bits combined from the hashes of its
(position, turn) pairs by exclusive or, so the keys at block starts come
from running aggregates and no round waits for another.

Sums over subtrees are sums over members.  A node's leaves are the members
that are the smallest of a childless node.  For a member c let S(c) be the words
of its turns before the first node whose smallest member it is; then the tokens
saved in the subtree of v are the sum of S(c) - B(v) over v's members but the
smallest, where B(v) are the words before v.  So two ROLLUPs suffice: the first
finds smallest members, the second adds S(c) and leaves.

Defined cases: rows without ``conv_id`` belong to no conversation; a null role
or text is empty; rows of one turn stand in the order of their digest; repeated
rows are turns of their own; an empty table has no nodes, not even a root;
columns other than the four are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from genrec.llm.common import materialise, words
from genrec.llm.turns import numbered_turns, turn_digest
from genrec.operators.skew import salted_lookup

BLOCK = 8                      # positional columns of one ROLLUP
SUPERBLOCK = 1024              # blocks whose running aggregates one window holds
FAMILY = 20                    # conversations that share a base, whose first turns they begin with
HEADS = 4                      # so many lengths of a shared beginning: 0 to HEADS - 1

_NODE = ["depth", "ka", "kz"]


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(turns, convs)``: ``conv_id, d, tid, n_words`` for every turn of the rebuilt conversations
    (``d`` from 1) and ``conv_id, n_turns`` for every conversation, turnless ones too.

    A conversation begins with the first h turns of its family's base, then
    has its own turns after its first h.  Runs two writing jobs.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        turn_digest(role, text).alias("tid"), F.size(words(text)).cast("long").alias("n_words"))
    own, sizes = numbered_turns(rows, "conv_id")
    head = (F.crc32(F.col("conv_id").cast("string")) % HEADS).alias("h")
    convs = sizes.select("conv_id", "n_rows", head, (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"))
    bases = sizes.select(F.col("conv_id").alias("base"), F.col("n_rows").alias("base_rows"))
    convs = materialise(convs.join(bases, "base", "left").select(
        "conv_id", "base", "h", "n_rows", F.least("h", F.coalesce("base_rows", F.lit(0))).alias("n_head")), "trie-convs")
    # at most HEADS - 1 turns of a base, for at most 2 FAMILY conversations
    first = own.where(F.col("pos") < HEADS).select(F.col("conv_id").alias("base"), "pos", "tid", "n_words")
    heads = convs.where("n_head > 0").select("conv_id", "base", "h").join(first, "base").where("pos <= h").select(
        "conv_id", F.col("pos").alias("d"), "tid", "n_words")
    tails = salted_lookup(own, convs.select("conv_id", "h", "n_head"), ["conv_id"], "pos",
                          convs.select("conv_id", F.col("n_rows").alias("_n"))).where("pos > h").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("n_head")).alias("d"), "tid", "n_words")
    n_turns = F.col("n_head") + F.greatest(F.col("n_rows") - F.col("h"), F.lit(0))
    return heads.unionByName(tails), convs.select("conv_id", n_turns.alias("n_turns"))


def _hash(seed: int, depth: Column, tid: Column) -> Column:
    return F.xxhash64(F.lit(seed), depth.cast("long"), tid)


def blocks(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """``conv_id, b, na, nz, before, t1 .. t8, n_words, n_turns, a, z`` for every block of every
    conversation: its number, the node at which it begins (two key halves) and the words before it, the
    turns (``id, words``; null after the end), and the block's words, turns and share of the keys.
    A turnless conversation has block 0.
    """
    at = F.col("d") - 1
    placed = turns.select("conv_id", F.floor(at / BLOCK).alias("b"), "d", "tid", "n_words",
                          _hash(1, F.col("d"), F.col("tid")).alias("a"), _hash(2, F.col("d"), F.col("tid")).alias("z"))
    rows = placed.groupBy("conv_id", "b").agg(
        F.sort_array(F.collect_list(F.struct("d", F.col("tid").alias("id"), F.col("n_words").alias("words")))).alias("ts"),
        F.bit_xor("a").alias("a"), F.bit_xor("z").alias("z"), F.sum("n_words").alias("n_words"))
    rows = rows.withColumn("sb", F.floor(F.col("b") / SUPERBLOCK))

    def running(window) -> list[Column]:
        before = window.rowsBetween(Window.unboundedPreceding, -1)
        return [F.coalesce(f(c).over(before), F.lit(0)).alias(f"{c}_") for f, c in (
            (F.bit_xor, "a"), (F.bit_xor, "z"), (F.sum, "n_words"))]

    supers = rows.groupBy("conv_id", "sb").agg(F.bit_xor("a").alias("a"), F.bit_xor("z").alias("z"), F.sum("n_words").alias("n_words"))
    supers = supers.select("conv_id", "sb", *running(Window.partitionBy("conv_id").orderBy("sb"))).toDF(
        "conv_id", "sb", "sa", "sz", "sw")
    inside = rows.select("*", *running(Window.partitionBy("conv_id", "sb").orderBy("b")))
    cells = [F.get("ts", F.lit(j)) for j in range(BLOCK)]
    cols = [F.when(c.isNotNull(), F.struct(c["id"].alias("id"), c["words"].alias("words"))).alias(f"t{j + 1}")
            for j, c in enumerate(cells)]
    full = inside.join(supers, ["conv_id", "sb"]).select(
        "conv_id", "b", F.col("a_").bitwiseXOR(F.col("sa")).alias("na"), F.col("z_").bitwiseXOR(F.col("sz")).alias("nz"),
        (F.col("n_words_") + F.col("sw")).alias("before"), *cols, "n_words",
        F.size("ts").cast("long").alias("n_turns"), "a", "z")
    zero = F.lit(0).cast("long")
    empty = F.lit(None).cast("struct<id:binary,words:bigint>")
    turnless = convs.where("n_turns = 0").select(
        "conv_id", zero.alias("b"), zero.alias("na"), zero.alias("nz"), zero.alias("before"),
        *[empty.alias(f"t{j + 1}") for j in range(BLOCK)], *[zero.alias(c) for c in ("n_words", "n_turns", "a", "z")])
    return full.unionByName(turnless)


def rolled_up(rows: DataFrame, aggregates: str) -> DataFrame:
    """The nodes of ``blocks``: ``depth, ka, kz`` and the parent's ``pa, pz``, ``words`` of the last turn,
    words ``before`` it, and the ``aggregates`` over the members."""
    names = [f"t{j + 1}" for j in range(BLOCK)]
    groups = rows.sparkSession.sql(
        f"SELECT b, na, nz, before, {', '.join(names)}, grouping_id() AS gid, {aggregates} "
        f"FROM {{rows}} GROUP BY b, na, nz, before, ROLLUP ({', '.join(names)})", rows=rows)
    # level j has the bits of t(j+1) .. t8 set: 2^(8 - j) - 1
    level = (F.lit(BLOCK) - F.log2(F.col("gid") + 1)).cast("int")
    ts = F.slice(F.array(*names), F.lit(1), level)
    groups = groups.select("*", level.alias("level"), ts.alias("ts")).where(
        F.when(F.col("level") == 0, F.col("b") == 0).otherwise(F.get("ts", F.col("level") - 1).isNotNull()))
    first = F.col("b") * BLOCK

    def key(start: str, seed: int, upto: Column) -> Column:
        hashes = F.transform(F.slice("ts", F.lit(1), F.greatest(upto, F.lit(0))), lambda t, i: _hash(seed, first + i + 1, t["id"]))
        return F.aggregate(hashes, F.col(start), lambda a, x: a.bitwiseXOR(x))

    last = F.get("ts", F.col("level") - 1)
    spoken = F.aggregate(F.slice("ts", F.lit(1), F.greatest(F.col("level") - 1, F.lit(0))), F.lit(0).cast("long"), lambda a, t: a + t["words"])
    keep = [c for c in groups.columns if c not in {"b", "na", "nz", "before", "gid", "level", "ts", *names}]
    return groups.select(
        (first + F.col("level")).cast("long").alias("depth"), key("na", 1, F.col("level")).alias("ka"), key("nz", 2, F.col("level")).alias("kz"),
        key("na", 1, F.col("level") - 1).alias("pa"), key("nz", 2, F.col("level") - 1).alias("pz"),
        F.coalesce(last["words"], F.lit(0)).alias("words"), (F.col("before") + spoken).alias("before"), *keep)


def _digests(ends: DataFrame) -> DataFrame:
    """``depth, ka, kz, ends_sha256`` of the nodes where conversations end, by ``conv_id``.

    The digest of a list is sequential, so a node's ids pass through one task, as
    a sorted stream of which only the digest's state is held.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None

        def row():
            return pa.RecordBatch.from_pylist([dict(zip(_NODE, node)) | {"ends_sha256": state.hexdigest()}], schema=schema)

        for batch in batches:
            out = []
            for *key, conv in zip(*(batch.column(c).to_pylist() for c in [*_NODE, "conv_id"])):
                if key != node:
                    if node is not None:
                        out.append(row())
                    node, state = key, hashlib.sha256(str(conv).encode())
                else:
                    state.update(f",{conv}".encode())
            if out:
                yield pa.Table.from_batches(out).combine_chunks().to_batches()[0]
        if node is not None:
            yield row()

    schema = pa.schema([("depth", pa.int64()), ("ka", pa.int64()), ("kz", pa.int64()), ("ends_sha256", pa.string())])
    ordered = ends.select(*_NODE, "conv_id").repartition(*_NODE).sortWithinPartitions(*_NODE, "conv_id")
    return ordered.mapInArrow(run, "depth long, ka long, kz long, ends_sha256 string")


def trie(conversations: DataFrame) -> DataFrame:
    """One row per node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256`` (see the module).

    Runs writing jobs for the numbered turns, the conversations, the blocks, the
    first nodes and the conversations' sums.
    """
    turns, convs = rebuilt(conversations)
    rows = materialise(blocks(turns, convs), "trie-blocks")
    nodes = materialise(rolled_up(rows, "count(*) AS n_convs, min(conv_id) AS conv_id"), "trie-nodes")
    parent = [(F.col("depth") - 1).alias("depth"), F.col("pa").alias("ka"), F.col("pz").alias("kz")]
    kids = nodes.where("depth > 0").select(*parent).groupBy(*_NODE).agg(F.count(F.lit(1)).alias("n_children"))
    # the nodes that a conversation is the smallest member of are the lower end of its path
    smallest = nodes.join(kids, _NODE, "left").groupBy("conv_id").agg(
        F.min_by("before", "depth").alias("shared"), F.max_by(F.col("n_children").isNull(), "depth").alias("leaf"))
    spoken = rows.groupBy("conv_id").agg(F.sum("n_words").alias("spoken"), F.count(F.lit(1)).alias("_n"))
    sums = materialise(spoken.join(smallest, "conv_id", "left").select(
        "conv_id", F.coalesce("shared", "spoken").alias("shared"),
        F.coalesce("leaf", F.lit(False)).cast("long").alias("leaf"), "_n"), "trie-sums")
    members = salted_lookup(rows, sums.drop("_n"), ["conv_id"], "b", sums.select("conv_id", "_n"))
    full = rolled_up(members, "count(*) AS n_convs, min(conv_id) AS conv_id, sum(leaf) AS n_leaves, "
                              "sum(shared) AS shared, min_by(shared, conv_id) AS own")
    full = full.select("*", (F.col("shared") - F.col("own") - (F.col("n_convs") - 1) * F.col("before")).alias("saved_tokens"),
                       (F.col("depth") - 1).alias("pd"))
    tops = nodes.select(F.col("depth").alias("pd"), F.col("ka").alias("pa"), F.col("kz").alias("pz"),
                        F.col("conv_id").alias("parent_conv_id"))
    asked = kids.select(F.col("depth").alias("pd"), F.col("ka").alias("pa"), F.col("kz").alias("pz"), F.col("n_children").alias("_n"))
    full = salted_lookup(full, tops, ["pd", "pa", "pz"], "ka", asked, how="left")
    ends = rows.groupBy("conv_id").agg(F.sum("n_turns").alias("depth"), F.bit_xor("a").alias("ka"), F.bit_xor("z").alias("kz"))
    out = full.join(kids, _NODE, "left").join(_digests(ends), _NODE, "left")
    nothing = hashlib.sha256(b"").hexdigest()
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
                      "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"))
