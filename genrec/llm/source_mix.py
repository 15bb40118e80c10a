"""Mix sources to target weights by Sainte-Lague apportionment of equal word blocks.

Words are the tokens of the mix.  A source is dealt into shards of about
``SHARD_WORDS`` words by a seeded hash; a shard's documents, in a seeded order,
form one stream that is cut into blocks of ``BLOCK_WORDS`` words.  The words that
its source's target grants a shard are whole passes over it, and a rest.  For
the rest, the shard's quota of blocks is the number of its quotients
``rest / (2k - 1)`` that reach half a block: the Sainte-Lague seats of highest
quotient, with the block as divisor.  A seeded permutation picks the blocks.

Defined cases: a null or blank text has size 0 and is never taken; a null
source is a source of its own, after all others; repeated rows are separate
documents; an empty table gives an empty result; a corpus without words has
targets of 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from genrec.llm.common import free_name, materialise, spaced, words_of_spaced

WEIGHTS = (5, 2, 1)            # by source in code point order, repeating
MAX_REPEATS = 3
BLOCK_WORDS = 32
SHARD_WORDS = 50_000
# steps of the block permutations: for any number of blocks that a shard can
# have, one of them shares no factor with it (fixed values: primes)
STEPS = (7919, 6007, 4057, 2053, 1031, 521, 257, 131, 67, 37)


def word_count(text: Column) -> Column:
    return F.size(words_of_spaced(spaced(text))).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``source, source_size, weight, target`` from rows with ``source`` and ``size``.

    Sources share all words by weight; a share above ``max_repeats`` times its
    source's size stops there and the excess is shared again among the others,
    until none is above.  Runs one small aggregate per round.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    cycle = F.array(*map(F.lit, weights))
    sources = materialise(by_source.withColumn(
        "weight", F.get(cycle, F.pmod(rank - 1, F.lit(len(weights))))), "mix-sources")
    cap = F.col("source_size") * max_repeats
    words = sources.agg(F.sum("source_size")).first()[0] or 0
    capped = F.lit(False)
    n_capped = 0
    while True:
        sums = sources.agg(F.sum(F.when(capped, cap)).alias("fixed"),
                           F.sum(F.when(~capped, F.col("weight"))).alias("open")).first()
        rest, weight = words - (sums["fixed"] or 0), sums["open"] or 1
        share = F.lit(float(rest)) * F.col("weight") / F.lit(float(weight))
        now = capped | (share > cap)
        n = sources.where(now).count()
        if n == n_capped:
            return sources.withColumn("target", F.when(capped, cap.cast("double")).otherwise(share))
        # a capped source stays capped: what it leaves only raises the others' shares
        capped, n_capped = now, n


def _selected(block: Column, p: str) -> Column:
    """Whether the permutation puts ``block`` among the picked ones."""
    return F.pmod(F.col(f"{p}.step") * block + F.col(f"{p}.turn"), F.col(f"{p}.blocks")) < F.col(f"{p}.picked")


def _sized(docs: DataFrame, seed: int) -> tuple[DataFrame, str]:
    """``docs`` with a struct of each row's size and seeded order, and its name."""
    p = free_name(docs, "mix")
    return docs.withColumn(p, F.struct(
        word_count(F.col("text")).alias("size"), F.xxhash64(F.lit(seed), "doc_id", "text").alias("order"))), p


def _planned(rows: DataFrame, p: str, seed: int) -> DataFrame:
    """``rows`` with ``p`` replaced by a struct with ``size``, ``source_size``,
    ``target``, the place of the document in its shard's stream (``start``) and
    the shard's ``passes``, ``blocks``, ``picked``, ``step``, ``turn``."""
    s, t, w, k = (free_name(rows, x) for x in ("mix_source", "mix_target", "mix_words", "mix_shard"))
    shares = targets(rows.select("source", f"{p}.size")).select(F.col("source").alias(s), F.struct(
        "source_size", "target", F.greatest(F.ceil(F.col("source_size") / SHARD_WORDS), F.lit(1)).alias("shards")).alias(t))
    placed = rows.join(shares, F.col("source").eqNullSafe(F.col(s))).withColumn(
        k, F.pmod(F.xxhash64(F.lit(seed + 1), F.col(f"{p}.order")), F.col(f"{t}.shards")))
    of_shard = Window.partitionBy(s, k)
    stream = of_shard.orderBy(F.col(f"{p}.order"), F.col("doc_id"), F.col(f"{p}.size")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    placed = placed.withColumn(w, F.struct(
        F.sum(f"{p}.size").over(of_shard).alias("all"),
        (F.sum(f"{p}.size").over(stream) - F.col(f"{p}.size")).alias("start")))
    blocks = F.ceil(F.col(f"{w}.all") / BLOCK_WORDS)
    weight = F.col(f"{w}.all") * F.col(f"{t}.target") / F.col(f"{t}.source_size")
    passes = F.when(F.col(f"{t}.source_size") > 0, F.floor(F.col(f"{t}.target") / F.col(f"{t}.source_size"))).otherwise(F.lit(0))
    # seats whose quotient rest / (2k - 1) is at least BLOCK_WORDS / 2
    rest = F.when(F.col(f"{t}.source_size") > 0, weight - passes * F.col(f"{w}.all")).otherwise(F.lit(0.0))
    picked = F.least(F.floor(rest / BLOCK_WORDS + 0.5), blocks).cast("long")
    safe = F.greatest(blocks, F.lit(1))
    steps = F.filter(F.array(*map(F.lit, STEPS)), lambda x: safe % x != 0)
    placed = placed.withColumn(p, F.struct(
        f"{p}.size", f"{t}.source_size", f"{t}.target", f"{w}.start", passes.alias("passes"), safe.alias("blocks"),
        picked.alias("picked"), F.get(steps, F.lit(0)).alias("step"),
        F.pmod(F.xxhash64(F.lit(seed + 2), F.col(s), F.col(k)), safe).alias("turn")))
    return placed.drop(s, t, w, k)


def mix(docs: DataFrame, seed: int = 0) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` of every row."""
    rows, p = _sized(docs, seed)
    rows = _planned(materialise(rows.select("doc_id", "source", p), "mix-sizes"), p, seed)
    start, size, b = F.col(f"{p}.start"), F.col(f"{p}.size"), F.lit(BLOCK_WORDS)
    picked = F.aggregate(
        F.sequence(F.floor(start / b), F.floor((start + size - 1) / b)), F.lit(0).cast("long"),
        lambda acc, j: acc + F.when(_selected(j, p), F.least(start + size, (j + 1) * b)
                                    - F.greatest(start, j * b)).otherwise(F.lit(0)))
    taken = F.when(size > 0, F.col(f"{p}.passes") * size + picked).otherwise(F.lit(0)).cast("long")
    return rows.select("doc_id", f"{p}.size", f"{p}.source_size", f"{p}.target", taken.alias("taken"))


def mixed_documents(docs: DataFrame, seed: int = 0) -> DataFrame:
    """The mix as rows of ``docs``: a document once for each whole pass, and once
    more with the words of its picked blocks, joined by spaces, if it has any.

    ``n_chars``, where present, follows the text.
    """
    rows, p = _sized(docs, seed)
    rows = _planned(rows, p, seed)
    text = F.coalesce("text", F.lit(""))
    kept = F.array_join(F.filter(
        words_of_spaced(spaced(F.col("text"))),
        lambda w, i: _selected(F.floor((F.col(f"{p}.start") + i) / BLOCK_WORDS), p)), " ")
    whole = F.when(F.col(f"{p}.size") > 0, F.array_repeat(text, F.col(f"{p}.passes").cast("int"))).otherwise(
        F.array().cast("array<string>"))
    part = F.when(F.col(f"{p}.picked") > 0, kept).otherwise(F.lit(""))
    out = rows.withColumn("text", F.explode(F.concat(whole, F.filter(F.array(part), lambda x: x != "")))).drop(p)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(dict(docs.dtypes)["n_chars"]))
    return out.select(*(F.col(f"`{c}`") for c in docs.columns))
