"""Item neighbours by the cosine of their ratings, and scores from them.

A pair of movies is met only through its lighter raters.  Users are ordered by
how many movies they rate.  A movie leaves its heaviest raters out of the index
as long as their part of its vector is shorter than the least cosine: if two
movies reach that cosine, the lightest of their common raters is indexed in
both, because otherwise all common raters lie in one movie's short part, and by
the Cauchy-Schwarz inequality the cosine stays below.  Where neighbours need two
common raters, a movie's heaviest rater is left out as well.

A user's indexed movies are dealt into chunks, and pairs are formed per pair of
chunks, so a user with very many movies is many small tasks; movies that leave
the user out meet the indexed ones only.  A pair is skipped when its norms and
counts of raters alone keep it below the least cosine.  Pairs carry their
products, so adding them up gives the dot product but for raters that both
movies leave out; those few are looked up for the pairs that can have them.
The output is ``k`` neighbours per movie.

Ratings are counted in hundredths, so dot products are whole numbers and do not
depend on the order of summation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from genrec.operators.skew import salted_lookup
from genrec.session import stored

RATING_UNITS = 100             # a rating's parts, so that products are whole
STEPS = 4                      # classes of user sizes to a doubling
CHUNK = 256                    # movies of a user in one chunk (read at call time)
PAIRS_PER_TASK = 1 << 20       # pairs that one task adds up before the shuffle
TASKS = 1 << 13                # of these tasks at most
_ID = 1 << 32                  # user sizes stand above the ids in an ordering key


def item_vectors(ratings: DataFrame) -> DataFrame:
    """``movieid, userid, w``: one entry per (movie, user), ratings that are not 0."""
    w = F.round(F.col("rating") * RATING_UNITS).cast("long")
    return ratings.select("movieid", "userid", w.alias("w")).where("w <> 0")


def _with_weight(vectors: DataFrame) -> DataFrame:
    """Adds ``heavy``: the user's number of movies, then the id, as one ordering key."""
    sizes = vectors.groupBy("userid").agg(F.count(F.lit(1)).alias("_n"))
    heavy = sizes.select("userid", (F.col("_n") * _ID + F.col("userid").cast("long")).alias("heavy"))
    return salted_lookup(vectors, heavy, ["userid"], "movieid", sizes)


def _size(heavy: str) -> Column:
    return F.floor(F.col(heavy) / _ID)


def _size_class(heavy: str) -> Column:
    return F.floor(F.log2(_size(heavy)) * STEPS).cast("int")


def movie_bounds(entries: DataFrame, least: float) -> DataFrame:
    """``movieid, n, n2, wmax, top, wtop, n_top, cut, n_out``: raters, squared norm, greatest entry, heaviest rater's key,
    entry and number of rows, the heaviest class of users that is indexed (the classes above it hold less than ``least`` of the
    norm), and the number of raters in the classes above."""
    raters = entries.groupBy("movieid", "heavy").agg(
        F.sum(F.col("w") * F.col("w")).alias("s"), F.count(F.lit(1)).alias("n"), F.max("w").alias("w"))
    per_class = raters.groupBy("movieid", _size_class("heavy").alias("size")).agg(
        F.sum("s").alias("s"), F.sum("n").alias("n"), F.max("w").alias("wmax"), F.max("heavy").alias("top"),
        F.max_by("w", "heavy").alias("wtop"), F.max_by("n", "heavy").alias("n_top"))
    movies = per_class.groupBy("movieid").agg(
        F.sum("n").alias("n"), F.sum("s").alias("n2"), F.max("wmax").alias("wmax"), F.max("top").alias("top"),
        F.max_by("wtop", "top").alias("wtop"), F.max_by("n_top", "top").alias("n_top"),
        F.sort_array(F.collect_list(F.struct("size", "s", "n")), asc=False).alias("classes"))
    # from the heaviest class down, while the squares still stay below least^2 of the norm
    room = F.col("n2") * (least * least * (1 - 1e-9))
    walked = F.aggregate("classes", F.struct(F.lit(0).cast("long").alias("used"), F.lit(None).cast("int").alias("cut")),
                         lambda a, c: F.struct((a["used"] + c["s"]).alias("used"),
                                               F.coalesce(a["cut"], F.when(a["used"] + c["s"] >= room, c["size"])).alias("cut")))
    n_out = F.aggregate("classes", F.lit(0).cast("long"), lambda a, c: a + F.when(c["size"] > F.col("cut"), c["n"]).otherwise(F.lit(0)))
    return movies.withColumn("cut", walked["cut"]).select("movieid", "n", "n2", "wmax", "top", "wtop", "n_top", "cut", n_out.alias("n_out"))


def _indexed(min_common: int) -> Column:
    light = _size_class("heavy") <= F.col("cut")
    return light & (F.col("heavy") != F.col("top")) if min_common > 1 else light


def _chunk_pairs(entries: DataFrame, least: float, min_common: int = 1) -> DataFrame:
    """``a, b, n2ab, n_common, dot, open``: the pairs (``a < b``) with a common indexed user that the bounds allow, the
    product of their squared norms, their common raters and dot product; ``open``: raters that both leave out are missing in these.

    ``entries`` with their movies' bounds.  Collects one number, that of the pairs to expect.
    """
    n_out = F.greatest("n_out", "n_top") if min_common > 1 else F.col("n_out")
    rows = entries.select("userid", "movieid", "w", "n", "n2", "wmax", "top", "wtop", n_out.alias("n_out"), _indexed(min_common).alias("ix"))
    users = rows.groupBy("userid").agg(F.count_if("ix").alias("n_in"), F.count(F.lit(1)).alias("_n")).where("n_in > 0")
    met = F.col("n_in") * (F.col("_n") - (F.col("n_in") + 1) / 2)
    tasks = users.agg(F.ceil(F.sum(met) / PAIRS_PER_TASK)).first()[0] or 1
    # chunks 0 to cs - 1 hold the movies that index the user, those after them the others, which meet the former only
    dealt = salted_lookup(rows, users.select("userid", F.ceil(F.col("n_in") / CHUNK).alias("cs"), F.ceil((F.col("_n") - F.col("n_in")) / CHUNK).alias("ds")),
                          ["userid"], "movieid", users.select("userid", "_n"))
    spread = F.xxhash64("movieid")
    dealt = dealt.withColumn("c", F.when(F.col("ix"), F.pmod(spread, F.col("cs"))).otherwise(F.col("cs") + F.pmod(spread, F.greatest("ds", F.lit(1)))).cast("int"))
    others = F.sequence(F.lit(0).cast("long"), F.when(F.col("ix"), F.col("cs") + F.col("ds")).otherwise(F.col("cs")) - 1)
    dealt = dealt.select("userid", "c", F.struct("movieid", "w", "n", "n2", "wmax", "top", "wtop", "n_out", "ix", "c").alias("x"),
                         F.explode(others.cast("array<int>")).alias("o"))
    dealt = dealt.select("userid", F.least("c", "o").alias("i"), F.greatest("c", "o").alias("j"), "x").repartition(min(int(tasks), TASKS), "userid", "i", "j")
    blocks = dealt.groupBy("userid", "i", "j").agg(F.collect_list("x").alias("xs")).where(F.size("xs") > 1)

    def reach(x: Column, y: Column) -> Column:
        """Whether x, on at most as many common raters as both have, can be long enough for the least cosine."""
        return x["wmax"] * x["wmax"] * F.least(x["n"], y["n"]) >= x["n2"] * (least * least * (1 - 1e-9))

    def pair(x: Column, y: Column) -> Column:
        out = (x["n_out"] > 0) & (y["n_out"] > 0)
        single = (x["n_out"] == 1) & (y["n_out"] == 1)          # a single rater left out is the heaviest
        return F.struct(x["movieid"].alias("a"), y["movieid"].alias("b"), (x["n2"].cast("double") * y["n2"].cast("double")).alias("n2ab"),
                        F.when(single & (x["top"] == y["top"]), x["wtop"] * y["wtop"]).otherwise(F.lit(0)).alias("shared"),
                        (out & ~single).alias("open"), (x["w"] * y["w"]).alias("dot"), (x["ix"] & y["ix"]).alias("ix"))

    def partners(x: Column) -> Column:
        return F.transform(F.filter("xs", lambda y: (y["movieid"] > x["movieid"]) & ((F.col("i") == F.col("j")) | (y["c"] != x["c"]))
                                    & reach(x, y) & reach(y, x)), lambda y: pair(x, y))

    pairs = blocks.select(F.explode(F.flatten(F.transform("xs", partners))).alias("p")).select("p.*")
    sums = pairs.groupBy("a", "b", "n2ab", "shared", "open").agg(
        F.count(F.lit(1)).alias("n_common"), F.sum("dot").alias("dot"), F.max("ix").alias("ix")).where("ix")
    return sums.select("a", "b", "n2ab", (F.col("n_common") + (F.col("shared") != 0).cast("int")).alias("n_common"),
                       (F.col("dot") + F.col("shared")).alias("dot"), "open")


def similar_pairs(ratings: DataFrame, least: float = 0.05, min_common: int = 1) -> DataFrame:
    """``a, b, n_common, cosine``: every pair of movies with a cosine of at least ``least`` (above 0) over at
    least ``min_common`` common raters.  Runs three writing jobs (entries with their users' sizes, entries with their
    movies' bounds, pairs) and a count."""
    if not 0 < least <= 1 or min_common < 1:
        raise ValueError("least lies in (0, 1], min_common is at least 1")
    entries = stored(_with_weight(item_vectors(ratings)), "neighbour-entries")
    movies = stored(movie_bounds(entries, least), "neighbour-movies")
    demand = movies.select("movieid", F.col("n").alias("_n"))
    bounded = stored(salted_lookup(entries, movies, ["movieid"], "userid", demand), "neighbour-index")
    cosine = F.col("dot") / F.sqrt("n2ab")
    fine = (cosine >= least) & (F.col("n_common") >= min_common)
    pairs = stored(_chunk_pairs(bounded, least, min_common).where(F.col("open") | fine), "neighbour-pairs")
    # raters that both movies leave out
    out = bounded.where(~_indexed(min_common)).select("movieid", "userid", "w")
    opened = pairs.where("open")
    met = salted_lookup(opened.select("a", "b"), out.select(F.col("movieid").alias("a"), "userid", F.col("w").alias("wa")), ["a"], "b").join(
        out.select(F.col("movieid").alias("b"), "userid", F.col("w").alias("wb")), ["b", "userid"])
    more = met.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n_more"), F.sum(F.col("wa") * F.col("wb")).alias("more"))
    added = opened.join(more, ["a", "b"], "left").select(
        "a", "b", "n2ab", (F.col("n_common") + F.coalesce("n_more", F.lit(0))).alias("n_common"), (F.col("dot") + F.coalesce("more", F.lit(0))).alias("dot"))
    return pairs.where("not open").drop("open").unionByName(added).where(fine).select("a", "b", "n_common", cosine.alias("cosine"))


def item_neighbours(ratings: DataFrame, k: int = 10, least: float = 0.05, min_common: int = 1) -> DataFrame:
    """``movieid, rank, neighbour, n_common, cosine``: the ``k`` best neighbours of each movie by cosine
    (6 digits), ties by lower id.  ``(userid, movieid)`` is unique in ``ratings``."""
    pairs = similar_pairs(ratings, least, min_common).withColumn("cosine", F.round("cosine", 6))
    sides = F.array(*[F.struct(F.col(x).alias("movieid"), F.col(y).alias("neighbour")) for x, y in ("ab", "ba")])
    both = pairs.select(F.explode(sides).alias("side"), "n_common", "cosine").select("side.*", "n_common", "cosine")
    best = Window.partitionBy("movieid").orderBy(F.col("cosine").desc(), F.col("neighbour").asc())
    return both.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "movieid", "rank", "neighbour", "n_common", "cosine")


# ---- scores

SIM_TYPE = "decimal(18,6)"


def boosted(neighbours: DataFrame, movies: DataFrame, boost: float = 0.0) -> DataFrame:
    """``movieid, neighbour, sim``: the cosine, raised by ``boost`` times the share of common genres (their number
    over that of all genres of both; 0 where a movie has none or is unknown), to 6 digits.  Reads ``neighbours``
    several times (for the counts of requests), so it should be a written table."""
    genres = movies.select("movieid", "genres")
    asked = neighbours.groupBy("neighbour").agg(F.count(F.lit(1)).alias("_n"))
    mine = salted_lookup(neighbours.select("movieid", "neighbour", "cosine"), genres, ["movieid"], "neighbour", how="left")
    theirs = genres.select(F.col("movieid").alias("neighbour"), F.col("genres").alias("other"))
    both = salted_lookup(mine, theirs, ["neighbour"], "movieid", asked, how="left")
    share = F.coalesce(F.try_divide(F.size(F.array_intersect("genres", "other")), F.size(F.array_union("genres", "other"))), F.lit(0.0))
    return both.select("movieid", "neighbour", F.round(F.col("cosine") * (1 + boost * share), 6).cast(SIM_TYPE).alias("sim"))


def neighbour_scores(cands: DataFrame, ratings: DataFrame, sims: DataFrame) -> DataFrame:
    """``userid, movieid, n_rated, score``: the mean of the user's ratings of the movie's neighbours, weighted by
    ``sim`` (``boosted``), to 3 digits; a candidate none of whose neighbours the user has rated has no row.

    Candidates meet the at most ``k`` neighbours of their movie (salted for popular
    movies), then the user's own ratings by (user, movie).  Sums are exact decimals.
    """
    wanted = salted_lookup(cands.select("userid", "movieid"), sims, ["movieid"], "userid")
    rated = ratings.select("userid", F.col("movieid").alias("neighbour"), F.col("rating").cast("decimal(6,3)").alias("r"))
    met = wanted.join(rated, ["userid", "neighbour"])
    sums = met.groupBy("userid", "movieid").agg(
        F.count(F.lit(1)).alias("n_rated"), F.sum(F.col("sim") * F.col("r")).alias("up"), F.sum("sim").alias("down"))
    return sums.select("userid", "movieid", "n_rated", F.round(F.col("up").cast("double") / F.col("down").cast("double"), 3).alias("score"))
