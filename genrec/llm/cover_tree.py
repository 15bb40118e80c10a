"""Near-duplicate embeddings: cover trees joined with themselves by dual traversal.

Vectors are unit vectors under the distance of their chords; cosine ``c`` is
distance ``sqrt(2 - 2c)``.  A tree has nested levels with halving radii; a node
knows its centre and covering radius (the farthest of its vectors), and a pair
of nodes is dropped when the centres are farther apart than both radii and the
threshold together, so no pair of vectors within the threshold is lost.

The upper levels are built over all rows: a cell with more than ``LEAF``
vectors is split around centres chosen from a sample of it.  Surviving pairs of
cells are cut into blocks of at most ``BLOCK`` vectors, and inside a pair of
blocks the lower levels are built and traversed in one task.  Equal vectors are
one node with a multiplicity.

Vectors compare only within equal labels that are not null.  Null or zero
vectors and vectors with null or non-finite components link with nothing;
neither do vectors of different lengths.  Repeated rows are separate, linked
vectors; ``vec_id`` null makes no component id unless it stands alone; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genrec.llm.common import arrow_batch_rows, materialise
from genrec.llm.graph import components

COSINE = 0.98
LEAF = 4096                    # vectors in a cell that is not split
BLOCK = 512                    # vectors in a block
CENTRES, SAMPLE = 16, 64       # centres of a cell, chosen from about so many of its vectors
LEVELS = 24
BATCH_ROWS = 2048
SLACK = 1e-6                   # above rounding, so that bounds never drop a pair


def _unit(vectors: pd.Series) -> np.ndarray:
    x = np.array([np.asarray(v, dtype=np.float64) for v in vectors])
    # scaled first: squares of very large or small components stay finite
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _comparable(v: Column, label: Column) -> Column:
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(label.isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def _net(x: np.ndarray, radius: float, most: int) -> np.ndarray:
    """Farthest-first centres, more than ``radius`` apart."""
    chosen = [0]
    far = np.linalg.norm(x - x[0], axis=1)
    while len(chosen) < most and far.max() > radius:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, np.linalg.norm(x - x[chosen[-1]], axis=1))
    return x[chosen]


def _split(cells: DataFrame, level: int) -> DataFrame | None:
    """``cells`` with the large cells split around new centres; None if there are none."""
    big = materialise(cells.groupBy("cell").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > LEAF), "tree-big")
    if big.isEmpty():
        return None
    radius = 2.0 ** (1 - level)
    some = cells.join(big, "cell").where(
        F.pmod(F.xxhash64(F.lit(level), "node"), F.ceil(F.col("size") / SAMPLE)) == 0)

    def choose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = [_net(_unit(v), radius, CENTRES) for v in b["sample"]]
            yield pd.DataFrame({"cell": b["cell"], "centres": [c.ravel().tolist() for c in got]})

    centres = materialise(some.groupBy("cell").agg(F.collect_list("v").alias("sample")).mapInPandas(
        choose, "cell long, centres array<double>"), "tree-centres")

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x = _unit(b["v"])
            at, far, centre = np.full(len(b), -1), np.zeros(len(b)), [None] * len(b)
            for _, rows in b.reset_index(drop=True).groupby("cell", sort=False).groups.items():
                c = b["centres"].iloc[rows[0]]
                if c is None:
                    continue
                c = np.asarray(c).reshape(-1, x.shape[1] if x.ndim == 2 else 1)
                d = np.sqrt(np.maximum(0, 2 - 2 * x[rows] @ c.T))
                at[rows], far[rows] = d.argmin(axis=1), d.min(axis=1)
                for r in rows:
                    centre[r] = c[at[r]].tolist()
            yield pd.DataFrame({"node": b["node"], "v": b["v"], "m": b["m"], "cell": b["cell"], "path": b["path"],
                                "at": at, "far": far, "centre": centre})

    moved = cells.join(centres, "cell", "left").select("node", "v", "m", "cell", "path", "centres")
    out = _by_length(moved, assign, "node long, v array<float>, m long, cell long, path array<struct<cell:long,"
                     "centre:array<double>,far:double>>, at int, far double, centre array<double>")
    child = F.when(F.col("at") >= 0, F.xxhash64("cell", "at", F.lit(level))).otherwise(F.col("cell"))
    last = F.element_at("path", -1)
    step = F.when(F.col("at") >= 0, F.struct(child.alias("cell"), F.col("centre"), F.col("far"))).otherwise(last)
    return materialise(out.select("node", "v", "m", child.alias("cell"), F.array_append("path", step).alias("path")), "tree-cells")


def _by_length(rows: DataFrame, run, schema: str) -> DataFrame:
    """``run`` over batches whose vectors have one length."""
    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for _, part in b.groupby(b["v"].str.len(), sort=False):
                yield from run(iter([part.reset_index(drop=True)]))

    return rows.mapInPandas(each, schema)


def _cell_pairs(cells: DataFrame, depth: int, reach: float) -> DataFrame:
    """``a, b`` (a <= b): pairs of final cells that may hold vectors within ``reach``."""
    pairs = cells.select(F.col("path")[0]["cell"].alias("a")).distinct().withColumn("b", F.col("a"))
    for level in range(1, depth):
        node = materialise(cells.select(F.col("path")[level - 1]["cell"].alias("up"), F.col("path")[level].alias("n")).groupBy(
            "up", F.col("n.cell").alias("cell")).agg(F.first("n.centre").alias("centre"), F.max("n.far").alias("far")), "tree-nodes")
        left = node.select(F.col("up").alias("a"), F.struct("cell", "centre", "far").alias("x"))
        right = node.select(F.col("up").alias("b"), F.struct("cell", "centre", "far").alias("y"))
        gap = F.sqrt(F.aggregate(F.zip_with("x.centre", "y.centre", lambda p, q: (p - q) * (p - q)), F.lit(0.0), lambda s, d: s + d))
        near = (F.col("x.cell") == F.col("y.cell")) | F.col("x.centre").isNull() | F.col("y.centre").isNull() | (
            gap <= F.col("x.far") + F.col("y.far") + reach + SLACK)
        pairs = materialise(pairs.join(left, "a").join(right, "b").where(
            ((F.col("a") != F.col("b")) | (F.col("x.cell") <= F.col("y.cell"))) & near).select(
            F.least("x.cell", "y.cell").alias("a"), F.greatest("x.cell", "y.cell").alias("b")), "tree-pairs")
    return pairs


class _Tree:
    """The lower levels over one block: nested centres with halving radii."""

    def __init__(self, x: np.ndarray, reach: float):
        self.x = x
        d = np.sqrt(np.maximum(0, 2 - 2 * x @ x.T))
        # of each level: its points, their parents in the level above, their covering radii
        chosen, levels, radius = [0], [], 2.0
        near = d[0].copy()
        points = [np.array([0])]
        while len(chosen) < len(x) and radius > reach / 4:
            radius /= 2
            while near.max() > radius:
                chosen.append(int(near.argmax()))
                near = np.minimum(near, d[chosen[-1]])
            points.append(np.array(chosen))
        points.append(np.arange(len(x)))
        self.points = points
        self.parent = [np.zeros(1, int)]
        for up, own in zip(points, points[1:], strict=False):
            self.parent.append(d[np.ix_(own, up)].argmin(axis=1))
        holder = np.arange(len(x))
        self.radius = [np.zeros(len(x))]
        for level in range(len(points) - 2, -1, -1):
            holder = self.parent[level + 1][holder]
            far = np.zeros(len(points[level]))
            np.maximum.at(far, holder, d[points[level][holder], np.arange(len(x))])
            self.radius.insert(0, far)


def _traverse(a: _Tree, b: _Tree, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Indices (into a, into b) of all vector pairs of cosine at least ``cosine``."""
    reach = np.sqrt(2 - 2 * cosine)
    alive = np.ones((1, 1), bool)
    depth = max(len(a.points), len(b.points))
    ia = ib = 0
    for level in range(depth):
        na, nb = min(level, len(a.points) - 1), min(level, len(b.points) - 1)
        if na > ia:
            alive, ia = alive[a.parent[na]], na
        if nb > ib:
            alive, ib = alive[:, b.parent[nb]], nb
        rows, cols = np.flatnonzero(alive.any(axis=1)), np.flatnonzero(alive.any(axis=0))
        if not len(rows):
            break
        x, y = a.x[a.points[na][rows]], b.x[b.points[nb][cols]]
        d = np.sqrt(np.maximum(0, 2 - 2 * x @ y.T))
        alive[np.ix_(rows, cols)] &= d <= a.radius[na][rows][:, None] + b.radius[nb][cols] + reach + SLACK
    i, j = np.nonzero(alive)
    if len(i):
        near = np.einsum("ij,ij->i", a.x[a.points[-1][i]], b.x[b.points[-1][j]]) >= cosine
        i, j = i[near], j[near]
    return i, j


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> list[tuple[int, int]]:
    """Edges that join the same components as all pairs (i, j)."""
    up = list(range(n))

    def root(k: int) -> int:
        while up[k] != k:
            up[k] = up[up[k]]
            k = up[k]
        return k

    out = []
    for x, y in zip(i.tolist(), j.tolist(), strict=True):
        p, q = root(x), root(y)
        if p != q:
            up[max(p, q)] = min(p, q)
            out.append((x, y))
    return out


def _compare(held: list[tuple], cosine: float) -> pd.DataFrame:
    """Links of one pair of blocks: (node, other or null, linked vectors or null)."""
    left = [r for r in held if r[1] == 0]
    right = [r for r in held if r[1] == 1]
    same = not right
    if not left:
        return pd.DataFrame(columns=["a", "b", "n"])
    reach = np.sqrt(2 - 2 * cosine)
    x = _Tree(_unit(pd.Series([r[3] for r in left])), reach)
    y = x if same else _Tree(_unit(pd.Series([r[3] for r in right])), reach)
    i, j = _traverse(x, y, cosine)
    if same:
        i, j = i[i != j], j[i != j]
    rows = left if same else left + right
    other = j if same else j + len(left)
    m = np.array([r[4] for r in rows])
    count = np.bincount(i, m[other], len(rows)).astype(np.int64)
    if not same:
        count += np.bincount(other, m[i], len(rows)).astype(np.int64)
    nodes = np.array([r[2] for r in rows], dtype=np.int64)
    linked = np.flatnonzero(count)
    edges = _forest(len(rows), i, other)
    a = np.concatenate([nodes[linked], nodes[[e[0] for e in edges]] if edges else np.empty(0, np.int64)])
    b = [None] * len(linked) + [int(nodes[e[1]]) for e in edges]
    n = count[linked].tolist() + [0] * len(edges)
    return pd.DataFrame({"a": a, "b": pd.array(b, dtype="Int64"), "n": np.array(n, dtype=np.int64)})


def links(vectors: DataFrame, cosine: float = COSINE) -> tuple[DataFrame, DataFrame]:
    """``(members, found)``: ``vec_id, node, m`` of every row (node null: not comparable; m: how
    many rows have the node's vector) and ``a, b, n``: node, linked node of a spanning
    forest of the links (or null), linked vectors of other nodes counted by a block pair.

    Runs the splitting jobs, one job for each level of cells and the block job.
    """
    arrow_batch_rows(vectors.sparkSession, BATCH_ROWS)
    v = F.col("embedding").cast("array<float>")
    rows = vectors.select("vec_id", "label", v.alias("v")).withColumn("node", F.when(
        _comparable(F.col("v"), F.col("label")), F.xxhash64("label", "v")))
    nodes = materialise(rows.where("node is not null").groupBy("node", "label", "v").agg(
        F.count(F.lit(1)).alias("m")), "tree-vectors")
    root = F.xxhash64("label", F.size("v"))
    no_centre = F.lit(None).cast("array<double>")
    cells = materialise(nodes.select("node", "v", "m", root.alias("cell"), F.array(F.struct(
        root.alias("cell"), no_centre.alias("centre"), F.lit(2.0).alias("far"))).alias("path")), "tree-cells")
    depth = 1
    while depth < LEVELS and (deeper := _split(cells, depth)) is not None:
        cells, depth = deeper, depth + 1
    reach = float(np.sqrt(2 - 2 * cosine))
    sizes = materialise(cells.groupBy("cell").agg(F.count(F.lit(1)).alias("size")).withColumn(
        "blocks", F.ceil(F.col("size") / BLOCK).cast("long")), "tree-sizes")
    pairs = _cell_pairs(cells, depth, reach)
    pairs = pairs.join(sizes.select(F.col("cell").alias("a"), F.col("blocks").alias("na")), "a").join(
        sizes.select(F.col("cell").alias("b"), F.col("blocks").alias("nb")), "b")
    tasks = materialise(pairs.select("a", "b", "nb", F.explode(F.sequence(F.lit(0).cast("long"), F.col("na") - 1)).alias("i")).select(
        "a", "b", "i", F.explode(F.sequence(F.when(F.col("a") == F.col("b"), F.col("i")).otherwise(0).cast("long"),
                                            F.col("nb") - 1)).alias("j")).withColumn("task", F.xxhash64("a", "i", "b", "j")), "tree-tasks")
    dealt = cells.join(sizes, "cell").select("cell", F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks")).alias("block"), "node", "v", "m")
    left = tasks.select("task", F.col("a").alias("cell"), F.col("i").alias("block"), F.lit(0).alias("side"))
    right = tasks.where("a <> b or i <> j").select("task", F.col("b").alias("cell"), F.col("j").alias("block"), F.lit(1).alias("side"))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []
        for b in batches:
            for r in b.itertuples(index=False, name=None):
                if held and r[0] != held[0][0]:
                    yield _compare(held, cosine)
                    held = []
                held.append(r)
        if held:
            yield _compare(held, cosine)

    met = dealt.join(left.unionAll(right), ["cell", "block"]).select("task", "side", "node", "v", "m")
    found = materialise(met.repartition("task").sortWithinPartitions("task").mapInPandas(
        compare, "a long, b long, n long"), "tree-links")
    return rows.select("vec_id", "node").join(nodes.select("node", "m"), "node", "left").select("vec_id", "node", "m"), found


def near_vectors(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row."""
    members, found = links(vectors, cosine)
    members = materialise(members, "tree-members")
    counted = found.groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    whole = components(found.where("b is not null").select("a", "b"), "tree-components")
    named = members.join(counted, "node", "left").join(whole, "node", "left").select(
        "vec_id", F.coalesce(F.col("n"), F.lit(0)).alias("n"), F.coalesce(F.col("m") - 1, F.lit(0)).alias("copies"),
        F.coalesce("component", "node").alias("class"))
    least = named.where("class is not null").groupBy("class").agg(F.min("vec_id").alias("component_id"))
    out = named.join(least, "class", "left").select(
        "vec_id", (F.col("n") + F.col("copies")).cast("long").alias("n_links"),
        F.when(F.col("class").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
