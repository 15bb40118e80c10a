"""Candidates, scores and top-N per user.

A score depends on the movie only through its average and the affinity of each
genre to its genre set.  Those affinities are one map per distinct genre set
(genre x genre set entries, whatever the number of users), carried by the movie
row, so a candidate is scored in its row from the user's favourites.

Nothing here runs an action unless its docstring says so.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from genrec.operators.model import AFF_TYPE, EXACT_DIGITS, affinity_of, score_expr, set_affinities, set_maps
from genrec.operators.rank import group_rank, id_rank, ranked_groups
from genrec.operators.skew import COPIES, salted_lookup
from genrec.session import stored


def user_profiles(fav: DataFrame) -> DataFrame:
    """``userid, pkey, pgenres``: the favourite set, sorted, and its string key."""
    g = F.array_sort("favgenres")
    return fav.where(F.size("favgenres") > 0).select(
        "userid", F.array_join(g, "|").alias("pkey"), g.alias("pgenres"))


def movie_profiles(movies: DataFrame) -> DataFrame:
    """``movieid, avgrating, skey, sgenres`` for model movies with genres.

    A movie with an empty genre list has no score (it is not a candidate).
    """
    g = F.array_sort("genres")
    return movies.where(F.size("genres") > 0).select(
        "movieid", "avgrating", F.array_join(g, "|").alias("skey"), g.alias("sgenres"))


def test_candidates(fav: DataFrame, test: DataFrame, by_user: DataFrame | None = None) -> DataFrame:
    """``userid, movieid`` — each user's test movies, for users with favourites.

    ``by_user`` (``userid, _n``): request counts or upper bounds of them.
    """
    return salted_lookup(test.select("userid", "movieid"), fav.select("userid"), ["userid"], "movieid", by_user)


def genre_sets(movies: DataFrame) -> DataFrame:
    """``skey, sgenres``: the distinct genre sets of the model movies."""
    return movie_profiles(movies).select("skey", "sgenres").distinct()


def scored_movies(movies: DataFrame, weights: DataFrame, exact: bool = False) -> DataFrame:
    """``movieid, avgrating, skey, affinity``: model movies with the affinities of their genre set."""
    maps = set_maps(genre_sets(movies), weights, exact)
    return movie_profiles(movies).select("movieid", "avgrating", "skey").join(maps, "skey")


def score_candidates(cands: DataFrame, fav: DataFrame, movies: DataFrame, weights: DataFrame, exact: bool = False,
                     by_user: DataFrame | None = None, by_movie: DataFrame | None = None) -> DataFrame:
    """``userid, movieid, score`` for candidate pairs.

    The user and movie lookups are salted for keys that a large share of the
    candidates carry; ``by_user`` and ``by_movie`` (key, ``_n``) give the
    request counts or upper bounds where an aggregate has them.  The movie row,
    with its map, comes last, so maps are not shuffled with candidates.
    """
    favs = fav.where(F.size("favgenres") > 0).select("userid", "favgenres")
    c = salted_lookup(cands.select("userid", "movieid"), favs, ["userid"], "movieid", by_user)
    c = salted_lookup(c, scored_movies(movies, weights, exact).drop("skey"), ["movieid"], "userid",
                      by_movie if by_movie is not None else _requests(cands, "movieid"))
    score = score_expr(affinity_of(F.col("favgenres"), F.col("affinity"), exact), F.col("avgrating"),
                       F.size("favgenres"), exact)
    return c.select("userid", "movieid", score.alias("score"))


def _requests(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))


def dropped_candidates(cands: DataFrame, fav: DataFrame, movies: DataFrame) -> DataFrame:
    """``reason, n`` — candidates that get no score: ``no_favourites`` (of the user),
    ``no_movie`` (not in the model) or ``no_genres`` (a model movie without genres)."""
    users = fav.where(F.size("favgenres") > 0).select("userid", F.lit(True).alias("has_fav"))
    known = movies.select("movieid", (F.size("genres") > 0).alias("has_genres"))
    c = salted_lookup(cands.select("userid", "movieid"), users, ["userid"], "movieid", how="left")
    c = salted_lookup(c, known, ["movieid"], "userid", _requests(cands, "movieid"), how="left")
    reason = F.when(F.col("has_fav").isNull(), "no_favourites").when(
        F.col("has_genres").isNull(), "no_movie").when(~F.col("has_genres"), "no_genres")
    return c.select(reason.alias("reason")).where("reason is not null").groupBy("reason").agg(
        F.count(F.lit(1)).alias("n"))


def top_n(scored: DataFrame, n: int = 10, key: str = "userid") -> DataFrame:
    """Best ``n`` per user by score desc, ties by lower movie id; adds ``rank``.

    ``row_number() <= n`` with a literal n is planned as WindowGroupLimit, which
    keeps n rows per user on the map side before the shuffle.
    """
    w = Window.partitionBy(key).orderBy(F.col("score").desc(), F.col("movieid").asc())
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def predictions(fav: DataFrame, test: DataFrame, movies: DataFrame, weights: DataFrame,
                n: int = 10, exact: bool = False, by_user: DataFrame | None = None,
                by_movie: DataFrame | None = None) -> DataFrame:
    """``userid, movieid, score, rank`` — top-n scored test movies per user."""
    # users without favourites drop out in the user lookup of score_candidates
    return top_n(score_candidates(test, fav, movies, weights, exact, by_user, by_movie), n)


def clip_scores(preds: DataFrame, cap: float = 5.0) -> DataFrame:
    """The exported score is clipped at the top of the rating scale."""
    return preds.withColumn("score", F.least(F.col("score"), F.lit(cap)))


# ------------------------------------------------------------ unseen movies

def seen_movies(training: DataFrame) -> DataFrame:
    """``userid, movieid`` — the distinct movies each user has rated."""
    return training.select("userid", "movieid").distinct()


def seen_counts(training: DataFrame) -> DataFrame:
    """``userid, n_seen``."""
    return training.groupBy("userid").agg(F.count(F.lit(1)).alias("n_seen"))


def unseen_counts(fav: DataFrame, training: DataFrame, movies: DataFrame,
                  by_movie: DataFrame | None = None) -> DataFrame:
    """O57 size: ``userid, n_unseen`` = model movies with genres not rated by the user,
    without building the users x movies table."""
    mp = movie_profiles(movies)
    total = mp.select(F.count(F.lit(1))).scalar()
    seen = (salted_lookup(training.select("userid", "movieid"), mp.select("movieid"), ["movieid"], "userid", by_movie)
            .groupBy("userid").agg(F.count(F.lit(1)).alias("n_seen")))
    return (user_profiles(fav).select("userid").join(seen, "userid", "left")
            .select("userid", (total - F.coalesce("n_seen", F.lit(0))).alias("n_unseen")))


RANK_CHUNK = 4096


def explode_ranks(df: DataFrame, chunk: int = RANK_CHUNK) -> DataFrame:
    """Rows ``(..., rank)`` for rank = 1..upto of each input row (``upto`` dropped).

    Two steps so that one user with a very long range is not expanded inside
    a single task: first one row per chunk of ``chunk`` ranks, spread by a
    shuffle on (userid, chunk), then the ranks of each chunk.
    """
    keep = [c for c in df.columns if c != "upto"]
    chunks = (df.select(*keep, "upto",
                        F.explode(F.sequence(F.lit(0), F.floor((F.col("upto") - 1) / chunk))).alias("_chunk"))
              .repartition("userid", "_chunk"))
    first = F.col("_chunk") * chunk + 1
    last = F.least(F.col("upto"), (F.col("_chunk") + 1) * chunk)
    return chunks.select(*keep, F.explode(F.sequence(first, last)).alias("rank"))


SET_CHUNK = 32                 # movies in the first block of a genre set; each block after it holds twice as many
PROFILES_PER_TASK = 20_000     # favourite sets that one task merges lists for


def _set_blocks(movies: DataFrame) -> DataFrame:
    """``skey, movieid, avgrating, chunk``: each genre set's movies by average, best first, in blocks of
    1, 2, 4, ... times ``SET_CHUNK`` ranks.  Runs the writing job of ``group_rank``."""
    mp = movie_profiles(movies)
    ranked = group_rank(mp.select("skey", "movieid", "avgrating"), ["skey"], [F.col("avgrating").desc(), F.col("movieid").asc()])
    # a set of r ranks has log2(r / SET_CHUNK) blocks, so the table of blocks stays small
    chunk = F.floor(F.log2(F.floor((F.col("rank") - 1) / SET_CHUNK) + 1)).cast("int")
    return ranked.select("skey", "movieid", "avgrating", chunk.alias("chunk"))


def _merge(unit: float, exact: bool):
    """For cogrouped favourite sets and blocks: the blocks that a set's best ``need`` movies lie in.

    The lists of the genre sets are merged by the least score of their blocks until
    ``need`` movies are certain; that score is the bar, and a block is read if its
    best score reaches the bar.  ``unit`` is the step of a rounded score: scores
    closer than that may be equal.  A favourite set with fewer movies whose score is surely above 0
    gets a row with ``chunk`` -1.
    """
    def run(profiles: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
        sets, at = np.unique(blocks["skey"].to_numpy(str), return_inverse=True)
        hi, lo, count, chunk = (blocks[c].to_numpy() for c in ("hi", "lo", "n", "chunk"))
        first = np.unique(at, return_index=True)[1]
        by_genre: dict[str, np.ndarray] = {}
        for i, k in enumerate(first):
            for genre, aff in zip(blocks["genres"].iloc[k], blocks["affs"].iloc[k]):
                by_genre.setdefault(genre, np.zeros(len(sets)))[i] = aff if exact else round(aff * 1000)
        out = []
        for pkey, genres, need, n_users in zip(profiles["pkey"], profiles["pgenres"], profiles["need"], profiles["n_users"]):
            aff = sum((by_genre[g] for g in genres if g in by_genre), np.zeros(len(sets))) / (1 if exact else 1000)
            share = aff[at] / len(genres)
            best, least = share * hi, share * lo
            order = np.argsort(-least, kind="stable")
            certain = np.cumsum(count[order])
            bar = least[order[np.searchsorted(certain, need)]] if len(order) and certain[-1] >= need else 0.0
            for b in np.flatnonzero((share > 0) & (best >= bar - unit)):
                out.append((pkey, sets[at[b]], int(chunk[b]), float(aff[at[b]]), len(genres), need, n_users))
            if count[least >= unit].sum() < need:
                out.append((pkey, "", -1, 0.0, len(genres), need, n_users))
        return pd.DataFrame(out, columns=["pkey", "skey", "chunk", "aff", "n_fav", "need", "n_users"])

    return run


def wanted_blocks(profiles: DataFrame, blocks: DataFrame, movies: DataFrame, weights: DataFrame, exact: bool = False) -> DataFrame:
    """``pkey, skey, chunk, aff, n_fav, need, n_users``: per favourite set (``profiles``: ``pkey, pgenres, need,
    n_users``) the blocks of ``_set_blocks`` to read.

    Favourite sets are dealt to tasks, each of which holds the summary of all
    blocks (genre sets times the logarithm of their size); no table of favourite
    sets and genre sets is formed.
    """
    affs = set_affinities(genre_sets(movies), weights, exact).groupBy("skey").agg(
        F.collect_list("genre_u").alias("genres"), F.collect_list(F.col("aff").cast("double")).alias("affs"))
    summary = blocks.groupBy("skey", "chunk").agg(
        F.max("avgrating").alias("hi"), F.min("avgrating").alias("lo"), F.count(F.lit(1)).alias("n")).join(affs, "skey")
    tasks = profiles.select(F.greatest(F.ceil(F.count(F.lit(1)) / PROFILES_PER_TASK), F.lit(COPIES)).cast("int")).scalar()
    mine = profiles.select(F.pmod(F.xxhash64("pkey"), tasks).cast("int").alias("salt"), "pkey", "pgenres", "need", "n_users")
    copies = summary.withColumn("salt", F.explode(F.sequence(F.lit(0), tasks - 1)))
    return mine.groupBy("salt").cogroup(copies.groupBy("salt")).applyInPandas(
        _merge(10.0 ** -(EXACT_DIGITS if exact else 3), exact),
        "pkey string, skey string, chunk int, aff double, n_fav int, need long, n_users long")


def _profile_lists(wanted: DataFrame, blocks: DataFrame, movies: DataFrame, exact: bool) -> tuple[DataFrame, DataFrame]:
    """``(lists, sizes)``: ``pkey, movieid, score, n_users, rank`` with the best ``need`` movies of each favourite set
    (or more), movies at 0 by id where fewer score, and ``pkey, n_rows``.  Runs the writing job of ``group_rank``."""
    read = wanted.where("chunk >= 0")
    aff = F.col("aff") if exact else F.col("aff").cast(AFF_TYPE)
    found = salted_lookup(read, blocks, ["skey", "chunk"], "pkey").select(
        "pkey", "movieid", score_expr(aff, F.col("avgrating"), F.col("n_fav"), exact).alias("score"), "n_users").where("score > 0")
    # the first `need` ids hold enough movies beside those that score
    short = wanted.where("chunk < 0").select(F.col("pkey").alias("userid"), "pkey", "n_users", F.col("need").alias("upto"))
    low = salted_lookup(explode_ranks(short), id_rank(movie_profiles(movies), "movieid"), ["rank"], "pkey").select("pkey", "movieid", "n_users")
    scored = found.join(short.select("pkey"), "pkey", "left_semi").select("pkey", "movieid", F.lit(True).alias("scored"))
    fill = low.join(scored, ["pkey", "movieid"], "left").where("scored is null").select(
        "pkey", "movieid", F.lit(0.0).alias("score"), "n_users")
    return ranked_groups(found.unionByName(fill), ["pkey"], [F.col("score").desc(), F.col("movieid").asc()])


_BITS = 64                     # positions of one bitmap, a long


def seen_bitmaps(seen: DataFrame) -> DataFrame:
    """``userid, bucket, bits, n_bits``: the list ranks (``userid, rank``) that a user has rated, one bitmap of
    ``_BITS`` positions per bucket (from 1), so a heavy user is many small rows.

    ``bit_or`` of longs is a hash aggregate; Spark's ``bitmap_construct_agg`` would sort, for its buffer is a binary.
    """
    at = F.col("rank").cast("long") - 1
    # the bit's place varies by row, which the function shiftleft does not take
    bit = F.expr("shiftleft(1L, cast((cast(rank as bigint) - 1) % 64 as int))")
    return seen.groupBy("userid", (F.floor(at / _BITS) + 1).alias("bucket")).agg(F.bit_or(bit).alias("bits")).select(
        "userid", "bucket", "bits", F.bit_count("bits").alias("n_bits"))


def _free_ranks(upto: Column, n: int) -> Column:
    """The first ``n`` ranks of the row's bucket, up to ``upto``, whose bit is not set."""
    first = (F.col("bucket") - 1) * _BITS + 1
    # n ranks and as many as the bitmap holds are enough
    last = F.least(upto, F.col("bucket") * _BITS, first + n - 1 + F.coalesce("n_bits", F.lit(0)))
    ranks = F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))
    free = F.filter(ranks, lambda rank: F.getbit("bits", (rank - first).cast("int")) == 0)
    return F.when(F.col("bits").isNull(), ranks).otherwise(F.slice(free, 1, n))


def unseen_recommendations(fav: DataFrame, training: DataFrame, movies: DataFrame,
                           weights: DataFrame, n: int = 10, exact: bool = False) -> DataFrame:
    """O48 + O57: top-n movies each user has not rated, over all model movies.

    ``userid, rank, movieid, score``; a user with nothing to recommend keeps
    one row with NULLs.  Exact without the users x movies product:

    * movies are ranked once per genre set, in blocks; for each distinct favourite
      set the lists are merged by their blocks' scores (``wanted_blocks``) as far
      as its users need: a user who rated s movies needs the first n + s;
    * the movies read are ranked once per favourite set, movies at score 0 by id at
      the end where fewer score;
    * a user's rated movies become bitmaps of ranks in that list, probed in
      the user's row for the first n free ranks; only those n are fetched.

    Rows per user are O(n + s); a list shared by most users is split across
    tasks by ``group_rank``, and its keys are salted with the number of its users.
    Runs writing jobs for users' needs and the genre sets' blocks (at the same
    time), the wanted blocks and the lists.
    """
    def needs() -> DataFrame:
        wanting = user_profiles(fav).join(seen_counts(training), "userid", "left").select(
            "userid", "pkey", "pgenres", (F.lit(n) + F.coalesce("n_seen", F.lit(0))).alias("need"))
        return stored(wanting, "unseen-need")

    with ThreadPoolExecutor(max_workers=2) as pool:
        users, blocks = (f.result() for f in (pool.submit(needs), pool.submit(_set_blocks, movies)))
    profiles = users.groupBy("pkey", "pgenres").agg(F.max("need").alias("need"), F.count(F.lit(1)).alias("n_users"))
    wanted = stored(wanted_blocks(profiles, blocks, movies, weights, exact), "unseen-blocks")
    lists, sizes = _profile_lists(wanted, blocks, movies, exact)

    by_user = users.select("userid", F.col("need").alias("_n"))
    seen = salted_lookup(training.select("userid", "movieid"), users.select("userid", "pkey"), ["userid"], "movieid", by_user)
    seen = salted_lookup(seen, lists.select("pkey", "movieid", "rank"), ["pkey", "movieid"], "userid",
                         lists.select("pkey", "movieid", F.col("n_users").alias("_n")))
    by_list = profiles.select("pkey", F.col("n_users").alias("_n"))
    asks = salted_lookup(users.select("userid", "pkey", "need"), sizes, ["pkey"], "userid", by_list).select(
        "userid", "pkey", F.least("need", "n_rows").alias("upto"))
    asks = asks.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.ceil(F.col("upto") / _BITS))).alias("bucket"))
    free = asks.join(seen_bitmaps(seen), ["userid", "bucket"], "left").select(
        "userid", "pkey", F.explode(_free_ranks(F.col("upto"), n)).alias("at"))
    order = Window.partitionBy("userid").orderBy("at")
    picked = free.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
    best = salted_lookup(picked, lists.select("pkey", F.col("rank").alias("at"), "movieid", "score"), ["pkey", "at"], "userid",
                         lists.select("pkey", F.col("rank").alias("at"), F.col("n_users").alias("_n")))
    return users.select("userid").join(best.select("userid", "rank", "movieid", "score"), "userid", "left")
