"""Best inner products of factor vectors: top-N per user without users x movies.

Movies are ordered by the norm of their factors and cut into blocks.  A user's
product with a movie is at most the product of their norms, so a user whose
n-th best score exceeds their norm times the next block's greatest norm is
done.  Rounds take 1, 1, 2, 4, ... blocks, up to what is broadcast at once, and
groups of users that are still open meet them, a group a task.

A block's movies are put in cells by direction, and a cell's in parts by their
lengths along the cell's direction (h) and across it (p).  A user who stands
at an angle to that direction has a product of at most
``norm * (cos * h + sin * p)`` with a movie, so most parts are met by few users.
Those products are formed in single precision first; the ones that may reach a
user's n-th best are formed again in double precision, rounded and ordered.
Blocks are cut, and users meet them, by Python in tasks.

``als_factors`` trains factors with Spark's own trainer; ``genre_factors`` states
users and movies in the space of genres, without training.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from genrec.operators.model import known_genres
from genrec.operators.prep import user_genre_hist
from genrec.operators.rank import group_rank
from genrec.session import stored

BLOCK = 1 << 16                # movies of a block at most (read at call time)
GROUP = 1 << 14                # users of a group (read at call time)
PART = 64                      # movies of a part at most (read at call time)
FIRST_PARTS = 16               # parts that give a user's first bar
BROADCAST_BLOCKS = 512         # blocks of a round at most (read at call time)
BROADCAST_DOUBLES = 1 << 22    # factors of a round at most: its blocks are broadcast
DIGITS = 6                     # of a score
_PENDING = 1 << 18             # products that wait to be ordered
_PRODUCTS = 1 << 22            # numbers of a matrix at most
_FOUND = "userid int, movieid int, score double"
_GROUPS = "grp int, users binary, user_vectors binary, best_ids binary, best_scores binary, open int"
_BLOCKS = "block bigint, head double, width bigint, ids binary, vectors binary, centres binary, parts binary"
_PARTS = np.dtype([("size", "i8"), ("cell", "i8"), ("top", "f8"), ("low", "f8"), ("side", "f8"), ("scale", "f8")])


def _norm(factors: str) -> Column:
    return F.sqrt(F.aggregate(factors, F.lit(0.0), lambda a, x: a + x * x))


def _numbers(values: pa.Scalar, kind: str) -> np.ndarray:
    return np.frombuffer(values.as_py(), kind)


def _lengths(vectors: np.ndarray) -> np.ndarray:
    """Norms whose squares may be too great or too small for a number."""
    most = np.abs(vectors).max(axis=1, initial=0.0)
    with np.errstate(all="ignore"):
        scaled = vectors / np.where(most > 0, most, 1.0)[:, None]
        return most * np.sqrt(np.einsum("ij,ij->i", scaled, scaled))


def _rows(kinds: str, *values: object) -> pa.RecordBatch:
    """One row of a table of ``kinds``; arrays as their bytes."""
    names, types = zip(*(k.split(" ") for k in kinds.split(", ")))
    made = {"int": pa.int32(), "bigint": pa.int64(), "double": pa.float64(), "binary": pa.binary()}
    return pa.RecordBatch.from_arrays([
        pa.array([v.tobytes() if isinstance(v, np.ndarray) else v], made[t]) for v, t in zip(values, types)], names=list(names))


# ---- movies: blocks, cells and parts

def _directions(units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(cell of each row, directions)`` for rows of length 1 (or 0): a few rounds of means by the nearest direction."""
    count = max(int(len(units) ** 0.5), 1)
    centres = units[np.linspace(0, len(units) - 1, count).astype(int)].copy()
    for last in (False, False, False, False, True):
        cell = np.concatenate([(units[s:s + 4096] @ centres.T).argmax(axis=1) for s in range(0, len(units), 4096)])
        if last:
            return cell, centres
        sums = np.stack([np.bincount(cell, x, count) for x in units.T], axis=1)
        length = np.linalg.norm(sums, axis=1)
        centres[length > 0] = sums[length > 0] / length[length > 0, None]


def _halved(rows: np.ndarray, h: np.ndarray, p: np.ndarray) -> Iterator[np.ndarray]:
    """The rows in parts of at most ``PART``, split by whichever of ``h`` and ``p`` spreads more."""
    if len(rows) <= PART:
        yield rows
        return
    by = h if np.ptp(h[rows]) >= np.ptp(p[rows]) else p
    order = rows[np.argsort(by[rows], kind="stable")]
    yield from _halved(order[:len(rows) // 2], h, p)
    yield from _halved(order[len(rows) // 2:], h, p)


def _parts(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(order of the rows, directions of the cells, parts)``; the rows of a part stand together, the parts of a cell too.
    Rows that are not finite are parts without a cell."""
    norm = _lengths(vectors)
    sound = np.flatnonzero(np.isfinite(norm))
    order, parts, centres = [], [], np.zeros((0, vectors.shape[1]))
    if len(sound):
        mine, length = vectors[sound], norm[sound]
        cell, centres = _directions(mine / np.where(length > 0, length, 1.0)[:, None])
        h = np.einsum("ij,ij->i", mine, centres[cell])
        p = np.linalg.norm(mine - h[:, None] * centres[cell], axis=1)
        by_cell = np.argsort(cell, kind="stable")
        for rows in np.split(by_cell, np.flatnonzero(np.diff(cell[by_cell])) + 1):
            for x in _halved(rows, h, p):
                order.append(sound[x])
                parts.append((len(x), cell[x[0]], h[x].max(), h[x].min(), p[x].max(), length[x].max() or 1.0))
    odd = np.flatnonzero(~np.isfinite(norm))
    for s in range(0, len(odd), PART):
        order.append(odd[s:s + PART])
        parts.append((len(order[-1]), -1, np.inf, -np.inf, np.inf, np.inf))
    return np.concatenate(order), centres, np.array(parts, _PARTS)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow: blocks with their movies in parts."""
    for b in batches:
        for r in range(b.num_rows):
            ids = b.column("ids")[r].values.to_numpy()     # raises if one is null
            vectors = b.column("vectors")[r].values.to_numpy(zero_copy_only=False).reshape(len(ids), -1)
            order, centres, parts = _parts(vectors)
            yield _rows(_BLOCKS, b.column("block")[r].as_py(), b.column("head")[r].as_py(), vectors.size, ids[order], vectors[order], centres, parts)


def item_blocks(items: DataFrame) -> DataFrame:
    """``block, head`` and binaries: the movies by norm, best first, ``BLOCK`` to a block (fewer if that is more than a round
    may broadcast); ``head`` is its greatest norm, ``width`` its number of factors.  Runs two writing jobs (order, blocks)."""
    rows = items.select("movieid", "factors", _norm("factors").alias("norm"))
    ranked = group_rank(rows, [], [F.col("norm").desc(), F.col("movieid").asc()])
    size = F.least(F.lit(BLOCK), F.greatest(F.floor(F.lit(BROADCAST_DOUBLES) / F.size("factors")), F.lit(1)))
    packed = ranked.groupBy(F.floor((F.col("rank") - 1) / size).alias("block")).agg(
        F.max("norm").alias("head"), F.collect_list(F.struct("movieid", "factors")).alias("xs"))
    arrays = packed.select("block", "head", F.col("xs.movieid").alias("ids"), F.flatten("xs.factors").alias("vectors"))
    return stored(arrays.mapInArrow(_cut, _BLOCKS), "factor-blocks", 1)


# ---- users: groups and their best lists

class _Best:
    """The ``n`` best of each user of a group so far: rounded scores, best first, equal ones by lower ids."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, scores: np.ndarray, unit: float):
        self.vectors, self.ids, self.scores, self.unit = vectors, ids, scores, unit
        self.n = ids.shape[1]
        self.norm = _lengths(vectors)
        self.least = np.full(len(ids), -np.inf)         # products below it are not among the n best
        self.pending, self.waiting, self.formed = [], 0, 0

    def reach(self, users: np.ndarray) -> np.ndarray:
        """The least products that can still count."""
        bars = self.scores[users, -1]
        # half a unit can be rounded up to the bar
        bars = bars - (0.5 + 1e-6) / self.unit - np.abs(bars, where=np.isfinite(bars), out=np.zeros_like(bars)) * 1e-12
        return np.maximum(bars, self.least[users])

    def add(self, users: np.ndarray, ids: np.ndarray, products: np.ndarray) -> bool:
        """Whether the lists changed; else the products wait."""
        score = np.floor(products * self.unit + 0.5) / self.unit
        bars = self.scores[users, -1]
        fine = (score > bars) | ((score == bars) & (ids < self.ids[users, -1]))
        if fine.any():
            self.pending.append((users[fine], ids[fine], score[fine]))
            self.waiting += np.count_nonzero(fine)
            if self.waiting >= _PENDING:
                self.settle()
                return True
        return False

    def settle(self) -> None:
        if not self.pending:
            return
        users, ids, scores = (np.concatenate(x) for x in zip(*self.pending))
        self.pending, self.waiting = [], 0
        some = np.unique(users)
        users = np.concatenate([users, np.repeat(some, self.n)])
        ids, scores = np.concatenate([ids, self.ids[some].ravel()]), np.concatenate([scores, self.scores[some].ravel()])
        order = np.lexsort((ids, -scores, users))
        users, ids, scores = users[order], ids[order], scores[order]
        place = np.arange(len(users)) - np.searchsorted(users, users)
        kept = place < self.n
        self.ids[users[kept], place[kept]], self.scores[users[kept], place[kept]] = ids[kept], scores[kept]


def _plain(best: _Best, users: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> None:
    """All products, for factors that are not finite."""
    step = max(_PENDING // max(len(users), 1), 1)
    for s in range(0, len(ids), step):
        with np.errstate(all="ignore"):
            products = best.vectors[users] @ vectors[s:s + step].T
            best.add(np.repeat(users, products.shape[1]), np.tile(ids[s:s + step], len(users)), products.ravel())


def _meet_parts(best: _Best, users: np.ndarray, ids: np.ndarray, vectors: np.ndarray, centres: np.ndarray, parts: np.ndarray) -> None:
    """The parts of a round against users of a group with finite factors."""
    eps = np.float32((vectors.shape[1] + 16) * 2.0 ** -23)     # rounding of products in single precision, of factors of length 1
    norm = best.norm[users]
    units = (best.vectors[users] / norm[:, None]).astype("f4")
    centres = centres.astype("f4")
    starts = np.cumsum(parts["size"]) - parts["size"]
    unit_vectors = (vectors / np.repeat(parts["scale"], parts["size"])[:, None]).astype("f4")
    cells = np.split(np.arange(len(parts)), np.flatnonzero(np.diff(parts["cell"])) + 1)
    scales = [parts["scale"][x].max() for x in cells]
    sides = [np.stack([parts[f][x] / scale for f in ("top", "low", "side")], axis=1).astype("f4") for x, scale in zip(cells, scales)]

    def bounds(c: int, cosine: np.ndarray) -> np.ndarray:
        """Parts of a cell by users: no product is greater, of users of norm 1, as a share of the cell's scale."""
        sine = np.sqrt(np.maximum(1 - cosine * cosine, 0) + 4 * eps)
        return sides[c] @ np.stack([np.maximum(cosine, 0), np.minimum(cosine, 0), sine])

    def products(j: int, some: np.ndarray) -> np.ndarray:
        best.formed += len(some) * int(parts["size"][j])
        return units[some] @ unit_vectors[starts[j]:starts[j] + parts["size"][j]].T

    def first(some: np.ndarray) -> None:
        """The n-th best product of the parts with the greatest bounds, which the n-th best of all is not below."""
        count, most = min(FIRST_PARTS, len(parts)), min(best.n, int(parts["size"].max()))
        if count * most < best.n:
            return
        directions, chosen = centres[parts["cell"][[x[0] for x in cells]]], np.empty((len(some), count), "i4")
        step = max(_PRODUCTS // len(parts), 1)
        for s in range(0, len(some), step):
            cosines = directions @ units[some[s:s + step]].T
            every = np.concatenate([bounds(c, cosines[c]) * np.float32(scales[c] / max(scales)) for c in range(len(cells))])
            chosen[s:s + step] = np.argpartition(every.T, -count, axis=1)[:, -count:]
        greatest = np.full((len(some), count, most), -np.inf)
        by_part = np.argsort(chosen, axis=None, kind="stable")
        for x in np.split(by_part, np.flatnonzero(np.diff(chosen.ravel()[by_part])) + 1):
            place, slot = np.divmod(x, count)
            j = chosen[place[0], slot[0]]
            found = products(j, some[place])
            kept = min(most, found.shape[1])
            greatest[place, slot, :kept] = (np.partition(found, -kept, axis=1)[:, -kept:] - 4 * eps) * parts["scale"][j]
        nth = np.partition(greatest.reshape(len(some), -1), -best.n, axis=1)[:, -best.n] * norm[some]
        # equal after rounding is a tie, which a lower id wins
        best.least[users[some]] = nth - (1 + 1e-6) / best.unit - np.abs(nth, where=np.isfinite(nth), out=np.zeros_like(nth)) * 1e-12

    new = np.flatnonzero(best.scores[users, -1] == -np.inf)
    if len(new):
        first(new)
    least = best.reach(users) / norm
    step = max(_PRODUCTS // vectors.shape[1], 1)
    for c, these in enumerate(cells):
        cosine = units @ centres[parts["cell"][these[0]]]
        # products and bounds lie between -1 and 1 of a scale
        met = bounds(c, cosine) >= np.clip(least / scales[c], -2, 2).astype("f4") - 4 * eps
        for j, row in zip(these, met):
            some = np.flatnonzero(row)
            if not len(some):
                continue
            hits = products(j, some) >= (np.clip(least[some] / parts["scale"][j], -2, 2).astype("f4") - 4 * eps)[:, None]
            place, col = np.divmod(np.flatnonzero(hits), hits.shape[1])
            for s in range(0, len(place), step):
                who, which = some[place[s:s + step]], starts[j] + col[s:s + step]
                if best.add(users[who], ids[which], np.einsum("ij,ij->i", best.vectors[users[who]], vectors[which])):
                    least = best.reach(users) / norm


def _meeting(n: int, digits: int, blocks: int, then: float | None):
    """For mapInArrow: groups of users against the ``blocks`` blocks of a round, which follow a group's first row; ``then``
    is the greatest norm after them, if there are any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, round_ = None, []
        for b in batches:
            for r in range(b.num_rows):
                if b.column("users")[r].is_valid:
                    grp = b.column("grp")[r].as_py()
                    users = _numbers(b.column("users")[r], "i4")
                    vectors = _numbers(b.column("user_vectors")[r], "f8").reshape(len(users), -1)
                    ids, scores = (_numbers(b.column(c)[r], t).reshape(-1, n).copy() for c, t in (("best_ids", "i4"), ("best_scores", "f8")))
                    group, round_ = _Best(vectors, ids, scores, 10.0 ** digits), []
                round_.append([_numbers(b.column(c)[r], t) for c, t in (("ids", "i4"), ("vectors", "f8"), ("centres", "f8"), ("parts", _PARTS))]
                              + [b.column("head")[r].as_py()])
                if len(round_) < blocks:
                    continue
                _meet_round(group, round_)
                left = 0 if then is None else np.count_nonzero(_open(group, then))
                yield _rows(_GROUPS, grp, users, vectors, group.ids, group.scores, left)

    return run


def _open(best: _Best, head: float) -> np.ndarray:
    """Users whom a movie of norm ``head`` can still give a better list."""
    low = best.scores[:, -1]
    with np.errstate(all="ignore"):
        # half a unit of the last digit and a rounding error can still lift a product to the bar
        return ~(best.norm * head < low - 0.5 / best.unit * (1 + 1e-6) - best.norm * head * 1e-12)


def _meet_round(best: _Best, blocks: list) -> None:
    rank = best.vectors.shape[1]
    users = np.flatnonzero(_open(best, blocks[0][-1]))
    ids, vectors, centres = np.concatenate([b[0] for b in blocks]), np.concatenate([b[1].reshape(-1, rank) for b in blocks]), []
    parts, cells = [], 0
    for b in blocks:
        mine = b[3].copy()
        mine["cell"][mine["cell"] >= 0] += cells
        parts.append(mine)
        centres.append(b[2].reshape(-1, rank))
        cells += len(centres[-1])
    parts, centres = np.concatenate(parts), np.concatenate(centres)
    sound, odd = np.isfinite(best.norm[users]), np.repeat(parts["cell"] < 0, parts["size"])
    _plain(best, users[~sound], ids, vectors)
    _plain(best, users[sound], ids[odd], vectors[odd])
    best.settle()
    if sound.any() and not odd.all():
        _meet_parts(best, users[sound], ids[~odd], vectors[~odd], centres, parts[parts["cell"] >= 0])
    best.settle()


def _user_groups(users: DataFrame, n: int) -> DataFrame:
    """Users with a norm above 0 in groups, with empty lists."""
    groups = max(-(-users.count() // GROUP), 1)

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                ids = b.column("ids")[r].values.to_numpy()     # raises if one is null
                vectors = b.column("vectors")[r].values.to_numpy(zero_copy_only=False)
                yield _rows(_GROUPS, b.column("grp")[r].as_py(), ids, vectors, np.full((len(ids), n), np.iinfo("i4").max, "i4"),
                            np.full((len(ids), n), -np.inf), len(ids))

    packed = users.where("norm > 0").groupBy(F.pmod(F.xxhash64("userid"), F.lit(groups)).cast("int").alias("grp")).agg(
        F.collect_list(F.struct("userid", "factors")).alias("us"))
    return stored(packed.select("grp", F.col("us.userid").alias("ids"), F.flatten("us.factors").alias("vectors")).mapInArrow(start, _GROUPS), "factor-groups", 1)


def _lists(n: int):
    """For mapInArrow: a row per place in the lists of groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                users, ids, scores = (_numbers(b.column(c)[r], t) for c, t in (("users", "i4"), ("best_ids", "i4"), ("best_scores", "f8")))
                fine = scores > -np.inf
                yield pa.RecordBatch.from_arrays([pa.array(x[fine]) for x in (np.repeat(users, n), ids, scores)], names=["userid", "movieid", "score"])

    return run


def factor_top_n(users: DataFrame, items: DataFrame, n: int = 10, digits: int = DIGITS) -> DataFrame:
    """``userid, rank, movieid, score``: the ``n`` movies with the greatest inner products, rounded to ``digits``
    digits, ties by lower id; ``users (userid, factors)``, ``items (movieid, factors)``, one row per id.

    Rows without factors have no scores; a user whose factors are all 0 gets the
    lowest ids at 0.  Runs two writing jobs for the users, those of ``item_blocks``, and one and a
    sum per round, and collects one number per round.
    """
    users = stored(users.where(F.size("factors") > 0).select(
        F.col("userid").cast("int").alias("userid"), "factors", _norm("factors").alias("norm")), "factor-users")
    items = items.where(F.size("factors") > 0).select(F.col("movieid").cast("int").alias("movieid"), "factors")
    blocks = item_blocks(items)
    last, doubles = blocks.agg(F.max("block"), F.max("width")).first()
    lowest = items.select("movieid").orderBy("movieid").limit(n).agg(F.collect_list("movieid").alias("ids")).scalar()
    out = users.where("norm = 0").select("userid", F.explode(lowest).alias("movieid"), F.lit(0.0).alias("score"))
    if last is not None:
        widest = max(min(BROADCAST_BLOCKS, BROADCAST_DOUBLES // doubles), 1)
        starts = [0]
        while (start := starts[-1] + min(max(starts[-1], 1), widest)) <= last:
            starts.append(start)
        heads = {r.block: r.head for r in blocks.where(F.col("block").isin(starts)).select("block", "head").collect()}
        groups = _user_groups(users, n)
        left = groups.count()
        for start, end in zip(starts, [*starts[1:], last + 1]):
            if not left:
                break
            groups = stored(_meet(groups.where("open > 0"), blocks.where(F.col("block").between(start, end - 1)), start, end, n, digits,
                                  heads.get(end), left), "factor-best", 1)
            out = out.unionByName(groups.where("open = 0").mapInArrow(_lists(n), _FOUND))
            left = groups.where("open > 0").count()
    order = Window.partitionBy("userid").orderBy(F.col("score").desc(), F.col("movieid").asc())
    return out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n).select("userid", "rank", "movieid", "score")


def _meet(opened: DataFrame, blocks: DataFrame, start: int, end: int, n: int, digits: int, then: float | None, groups: int) -> DataFrame:
    """The groups with their lists after the blocks ``start`` to ``end - 1``, and how many users a movie of norm ``then`` can concern."""
    # a group a task, however few bytes it is: it meets every block, and only its first row carries it
    rows = opened.repartition(groups, "grp").withColumn("block", F.explode(F.sequence(F.lit(start).cast("long"), F.lit(end - 1).cast("long"))))
    once = [F.when(F.col("block") == start, F.col(c)).alias(c) for c in ("users", "user_vectors", "best_ids", "best_scores")]
    met = rows.select("grp", "block", *once).join(F.broadcast(blocks), "block")
    return met.select("grp", "users", "user_vectors", "best_ids", "best_scores", "head", "ids", "vectors", "centres", "parts").mapInArrow(
        _meeting(n, digits, end - start, then), _GROUPS)


# ---- factors

def genre_factors(training: DataFrame, movies: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(users, items)`` over the known genres by name: a user's share of each genre among the genres of the movies
    they rated, a movie's average over the root of its number of genres for each genre it has (3 digits)."""
    names = known_genres(movies).agg(F.sort_array(F.collect_list("genre")).alias("names")).scalar()

    def vector(entries: Column) -> Column:
        by_name = F.map_from_entries(entries)
        return F.transform("names", lambda g: F.coalesce(F.try_element_at(by_name, g), F.lit(0.0)))

    counts = user_genre_hist(training).groupBy("userid").agg(
        F.collect_list(F.struct("genre", "cnt")).alias("h"), F.sum("cnt").alias("total"))
    users = counts.withColumn("names", names).select("userid", vector(F.transform("h", lambda x: F.struct(
        x["genre"].alias("g"), F.round(x["cnt"] / F.col("total"), 3).alias("s")))).alias("factors"))
    share = F.round(F.col("avgrating") / F.sqrt(F.size("genres")), 3)
    items = movies.where(F.size("genres") > 0).withColumn("names", names).select("movieid", vector(F.transform("genres", lambda g: F.struct(
        g.alias("g"), share.alias("s")))).alias("factors"))
    return users, items


def als_factors(ratings: DataFrame, rank: int = 10, iterations: int = 10, regularisation: float = 0.1, seed: int = 7) -> tuple[DataFrame, DataFrame]:
    """``(users, items)``: factors from Spark's alternating least squares.  Runs the trainer's jobs."""
    from pyspark.ml.recommendation import ALS

    model = ALS(rank=rank, maxIter=iterations, regParam=regularisation, seed=seed, userCol="userid", itemCol="movieid", ratingCol="rating").fit(
        ratings.select("userid", "movieid", "rating"))
    return tuple(f.select(F.col("id").alias(name), F.col("features").cast("array<double>").alias("factors"))
                 for f, name in ((model.userFactors, "userid"), (model.itemFactors, "movieid")))
