"""Cheapest repair of a conversation's structure by the auction algorithm for shortest paths.

A conversation's rows span a lattice: a node says how many rows are consumed and
what the repaired roles so far ask for (nothing yet, a user after the system
turn, an assistant after a user, or nothing more).  Arcs keep, rerole or delete
the next row or insert a turn, at integer costs; a shortest path to a complete
sequence ``(s?(ua)+)?`` is a cheapest repair.

The auction holds a path and a price per node, with no price above any arc's
cost plus the price at its head.  It looks at the path's last node: if the price is below
the cheapest such sum, it is raised to it and the path contracts by the node,
else the path extends along the cheapest arc, until it reaches a node whose
price is known to be its distance to the end.  Origins go from the last rows to the
first, ``STEP`` rows at a time; prices before a cut start from the least price at the
cut, so a path is at most ``STEP`` rows long and the work is linear in the rows.  At the end the arcs whose cost equals the difference of their
prices are tight, and the paths of tight arcs from the start to the end are all
shortest paths.  The tight arcs that lead to the end are traced with the
letters D < I < K < R, and the trace is the least of the cheapest audits.

Long conversations are cut into segments of ``SEGMENT`` rows, on which tasks
work in parallel: distances from every entry to every exit state, then the
prices at the cuts from the last segment to the first (four numbers a segment),
then the traces from every entry state, then the choice from first to last.
The digest of a repaired text is sequential, so a conversation's rows pass one
task as a sorted stream, of which the digest's state, the counters and the audit are held.

Defined cases: a null role or text is one space, and so is a null id or turn where the
damage is drawn; rows without ``conv_id`` form one conversation; rows of one turn
stand in the order of their digest; repeated rows are rows of their own; an empty table
gives an empty result; columns other than the four are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genrec.llm.common import SPACES, materialise
from genrec.llm.turns import numbered_turns, turn_digest
from genrec.operators.skew import salted_lookup

DAMAGE = 20                    # one draw of so many for each kind of damage
CHUNK = 16384                  # characters of a text that travel together
SEGMENT = 256                  # rows that a task repairs at a time
STEP = 16                      # rows between two origins of the auction
DELETE, REROLE, INSERT, CUT_OFF = 3, 2, 2, 1

NONE, SYSTEM, USER, PAIR = range(4)      # what the repaired roles end in
STATES = range(4)
NO_WAY = 1 << 30
ENDS = (0, NO_WAY, NO_WAY, 0)            # exit prices of a whole conversation
NEXT = {NONE: USER, SYSTEM: USER, USER: PAIR, PAIR: USER}


# ---- the lattice and the auction

def lattice(codes: str, exits: tuple[int, ...], last: bool) -> list[list[tuple[str, int, int]]]:
    """Arcs ``(letter, cost, node)`` of every node, by letter; node ``4 i + state`` has ``i`` rows consumed,
    the end comes last.  A code is a row's role initial (``o``: other), a capital if
    truncated, or ``x`` for a row that has to go."""
    n = len(codes)
    end = 4 * (n + 1)
    arcs: list[list[tuple[str, int, int]]] = []
    for i in range(n + 1):
        for s in STATES:
            out = []
            insert = ("I", INSERT, 4 * i + NEXT[s])
            if i < n:
                code, ahead = codes[i], 4 * (i + 1)
                role, late = code.lower(), CUT_OFF * code.isupper()
                out = [("D", DELETE, ahead + s), insert]
                if role == "s" and s == NONE:
                    out.append(("K", late, ahead + SYSTEM))
                if role == "u" and s != USER or role == "a" and s == USER:
                    out.append(("K", late, ahead + NEXT[s]))
                if role != "x":
                    out.append(("R", REROLE + late, ahead + NEXT[s]))
            elif last:
                out = [insert]
            if i == n and exits[s] < NO_WAY:
                out.append(("Z", exits[s], end))
            arcs.append(out)
    arcs.append([])
    return arcs


def converge(arcs: list, price: list[int], exact: list[bool], origin: int, most: int) -> None:
    """Raise prices until ``origin``'s is its distance to the end; distances above ``most`` do not exist."""
    path = [origin]
    while not exact[path[-1]]:
        here = path[-1]
        best, ahead = NO_WAY, -1
        for _, cost, node in arcs[here]:
            if cost + price[node] < best:
                best, ahead = cost + price[node], node
        if best > most:
            best = NO_WAY
        if price[here] < best:                   # contraction
            price[here] = best
            if len(path) > 1:
                path.pop()
        elif best == NO_WAY:                     # the origin has no way
            break
        else:                                    # extension
            path.append(ahead)
    for node in path:
        exact[node] = True


def prices(codes: str, exits: tuple[int, ...], last: bool, entries: tuple[int, ...]) -> tuple[list, list[int]]:
    """``(arcs, prices)`` converged for all states at every ``STEP`` rows and for ``entries`` at the first."""
    arcs = lattice(codes, exits, last)
    n = len(codes)
    price, exact = [0] * len(arcs), [False] * len(arcs)
    exact[-1] = True
    most = DELETE * n + 3 * INSERT + max(x for x in exits if x < NO_WAY)
    cuts = [*range(n, 0, -STEP), 0]
    for i, left in zip(cuts, cuts[1:]):
        for s in STATES:
            converge(arcs, price, exact, 4 * i + s, most)
        # the least price at a cut is a lower bound of all prices before it, so the auction need not climb there
        price[4 * left:4 * i] = [min(price[4 * i:4 * i + 4])] * (4 * (i - left))
    for s in entries:
        converge(arcs, price, exact, s, most)
    return arcs, price


def distances(codes: str, last: bool) -> list[int]:
    """From each entry state to each exit state (16 numbers); for the ``last`` segment to the end (in the first
    of each four)."""
    out = [NO_WAY] * 16
    for x in (NONE,) if last else STATES:
        exits = ENDS if last else tuple(0 if s == x else NO_WAY for s in STATES)
        price = prices(codes, exits, last, tuple(STATES))[1]
        for s in STATES:
            out[4 * s + x] = price[s]
    return out


def traces(codes: str, exits: tuple[int, ...], last: bool, entries: tuple[int, ...]) -> list[tuple[str, int] | None]:
    """For each entry state the least cheapest way: a token per row, comma-joined, and the exit state.

    A token's letters, in order: ``U``, ``A`` insert a user or assistant turn, ``K`` keeps, ``D`` deletes,
    ``u``, ``a`` rerole."""
    arcs, price = prices(codes, exits, last, entries)
    n, end = len(codes), len(arcs) - 1
    leads = [False] * end + [True]
    for i in range(n, -1, -1):
        for _ in STATES:                         # inserts stay in the layer
            for s in STATES:
                at = 4 * i + s
                leads[at] = price[at] < NO_WAY and any(leads[to] and cost + price[to] == price[at] for _, cost, to in arcs[at])
    out: list[tuple[str, int] | None] = [None] * 4
    for entry in entries:
        if not leads[entry]:
            continue
        at, tokens, token = entry, [], ""
        while True:
            letter, to = next((a, to) for a, cost, to in arcs[at] if leads[to] and cost + price[to] == price[at])
            if letter == "Z":
                break
            role = "u" if to % 4 == USER else "a"
            token += {"I": role.upper(), "R": role}.get(letter, letter)
            if letter != "I":
                tokens.append(token)
                token = ""
            at = to
        tokens[-1] += token
        out[entry] = ",".join(tokens), at % 4
    return out


# ---- damage and faults

def damaged(conversations: DataFrame) -> DataFrame:
    """``k, conv_id, turn, role, text``: the rows after the drawn damage; ``k`` is the id as text."""
    def said(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    draw = F.crc32(F.concat_ws(":", said("conv_id"), said("turn"))) % DAMAGE
    rows = conversations.select(said("conv_id").alias("k"), F.col("conv_id").cast("long").alias("conv_id"),
                                F.col("turn").cast("long").alias("turn"), said("role").alias("role"), said("text").alias("text"),
                                draw.alias("draw")).where("draw <> 0")
    text = F.when(F.col("draw") == 1, F.lit("")).when(
        F.col("draw") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("draw") == 4, F.lit("user")).otherwise(F.col("role"))
    copies = F.when(F.col("draw") == 3, F.lit(2)).otherwise(F.lit(1))
    return rows.select("k", "conv_id", "turn", role.alias("role"), text.alias("text"),
                       F.explode(F.sequence(F.lit(1), copies)).alias("copy")).drop("copy")


def faulty(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(rows + pos, seg, fault, code, k + n_segs)``: the first fault of each row (blank, duplicate, truncated
    or null) in the order of its conversation.  Runs two writing jobs."""
    placed, sizes = numbered_turns(rows.withColumn("tid", turn_digest(F.col("role"), F.col("text"))), "k")
    # the first row of each role and text, found by an aggregate; copies meet in no join
    first = placed.groupBy("k", "tid").agg(F.min("pos").alias("pos")).select("k", "pos", F.lit(True).alias("first"))
    end = F.right(F.rtrim("text", F.lit(SPACES)), F.lit(1))
    fault = F.when(end == "", "blank").when(F.col("first").isNull(), "duplicate").when(~end.isin(".", "!", "?"), "truncated")
    initial = F.substring("role", 1, 1)
    role = F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit("o"))
    code = F.when(fault.isin("blank", "duplicate"), F.lit("x")).when(fault == "truncated", F.upper(role)).otherwise(role)
    out = placed.join(first, ["k", "pos"], "left").select(
        "k", "conv_id", "pos", F.floor((F.col("pos") - 1) / SEGMENT).alias("seg"), "turn", "role", "text",
        fault.alias("fault"), code.alias("code"))
    return materialise(out, "repair-rows"), sizes.select("k", F.ceil(F.col("n_rows") / SEGMENT).alias("n_segs"))


# ---- segments

def _arrow(df: DataFrame, function: Callable[..., Iterator[dict]], schema: str, stream: bool = False) -> DataFrame:
    """``function(**row)`` for each row, or ``function(rows)`` for the rows of a partition in order."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow, names = to_arrow_schema(StructType.fromDDL(schema)), df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            for b in batches:
                for values in zip(*(b.column(c).to_pylist() for c in names)):
                    yield dict(zip(names, values))

        out = []
        for row in function(rows()) if stream else (x for r in rows() for x in function(**r)):
            out.append(row)
            if len(out) == 1000:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return df.mapInArrow(run, schema)


def _measure(k: str, seg: int, last: bool, codes: str) -> Iterator[dict]:
    yield {"k": k, "seg": seg, "last": last, "far": distances(codes, last)}


def _cut_prices(rows: Iterator[dict]) -> Iterator[dict]:
    """Prices at the segments' ends, from the last segment of a conversation to its first."""
    ahead: list[int] = []
    for r in rows:
        far = r["far"]
        exits = list(ENDS) if r["last"] else ahead
        yield {"k": r["k"], "seg": r["seg"], "exits": exits}
        ahead = [far[4 * s] if r["last"] else min(min(far[4 * s + x] + exits[x], NO_WAY) for x in STATES) for s in STATES]


def _trace(k: str, seg: int, last: bool, codes: str, exits: list[int] | None) -> Iterator[dict]:
    found = traces(codes, tuple(exits or ENDS), last, tuple(STATES) if seg else (NONE,))
    yield {"k": k, "seg": seg, "ways": [{"tokens": w[0], "exit": w[1]} if w else None for w in found]}


def _choose(rows: Iterator[dict]) -> Iterator[dict]:
    """The way of each segment, from the first segment of a conversation to its last."""
    state = NONE
    for r in rows:
        way = r["ways"][state if r["seg"] else NONE]
        state = way["exit"]
        yield {"k": r["k"], "seg": r["seg"], "tokens": way["tokens"]}


def repaired_tokens(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """``k, seg, tokens`` of every segment.  Runs three writing jobs."""
    codes = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "code"))), lambda x: x["code"]), "")
    segs = rows.groupBy("k", "seg").agg(codes.alias("codes"))
    demand = sizes.select("k", F.col("n_segs").alias("_n"))
    segs = materialise(salted_lookup(segs, sizes, ["k"], "seg", demand), "repair-segments")
    segs = segs.select("k", "seg", (F.col("seg") == F.col("n_segs") - 1).alias("last"), "codes", "n_segs")
    long = segs.where("n_segs > 1").drop("n_segs")
    far = materialise(_arrow(long, _measure, "k string, seg long, last boolean, far array<int>"), "repair-distances")
    cuts = _arrow(far.repartition("k").sortWithinPartitions("k", F.desc("seg")), _cut_prices,
                  "k string, seg long, exits array<int>", stream=True)
    ways = materialise(_arrow(segs.drop("n_segs").join(cuts, ["k", "seg"], "left").select("k", "seg", "last", "codes", "exits"), _trace,
                              "k string, seg long, ways array<struct<tokens:string,exit:int>>"), "repair-ways")
    return _arrow(ways.repartition("k").sortWithinPartitions("k", "seg"), _choose, "k string, seg long, tokens string", stream=True)


# ---- the result

_RESULT = ("k string, conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
           "audit string, repaired_sha256 string")
LETTERS = str.maketrans("UAua", "IIRR")


def _report(rows: Iterator[dict]) -> Iterator[dict]:
    """One row a conversation from its rows in order; a long text comes in several parts."""
    now, k = None, None

    def done() -> dict:
        turns = now.pop("turns")
        now["gaps"] = turns[1] - turns[0] + 1 - turns[2] if turns else 0
        now["repaired_sha256"] = now.pop("state").hexdigest()
        now["audit"] = "".join(now["audit"]).translate(LETTERS)
        now.pop("initial"), now.pop("lines")
        return now

    for r in rows:
        if now is None or r["k"] != k:
            if now is not None:
                yield done()
            k = r["k"]
            now = {"k": k, "conv_id": r["conv_id"], "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0,
                   "audit": [], "state": hashlib.sha256(), "turns": None, "initial": None, "lines": 0}
        if r["part"] == 0:
            if r["fault"]:
                now[r["fault"]] += 1
            if now["initial"] is not None and now["initial"] + r["initial"] not in ("su", "ua", "au"):
                now["illegal"] += 1
            now["initial"] = r["initial"]
            if (t := r["turn"]) is not None:
                low, high, n = now["turns"] or (t, None, 0)
                now["turns"] = low, t, n + (t != high)
            token = r["token"]
            now["audit"].append(token)
            late = CUT_OFF * (r["fault"] == "truncated")
            now["cost"] += sum({"D": DELETE, "K": late, "U": INSERT, "A": INSERT}.get(x, REROLE + late) for x in token)
        if r["chunk"] is not None:
            if r["part"] == 0 and now["lines"]:
                now["state"].update(b"\n")
            now["lines"] += 1
            now["state"].update(r["chunk"].encode("utf-8", "surrogatepass"))
    if now is not None:
        yield done()


def repair(conversations: DataFrame) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256`` for every
    conversation (see the module).

    Runs writing jobs for the numbered rows, their faults, the sizes, the segments, the
    distances of long conversations' segments and the traces.
    """
    rows, sizes = faulty(damaged(conversations))
    tokens = repaired_tokens(rows, materialise(sizes, "repair-sizes"))
    whole = F.concat_ws(":", "role", "text")
    with_token = rows.join(tokens, ["k", "seg"]).withColumn(
        "token", F.get(F.split("tokens", ","), ((F.col("pos") - 1) % SEGMENT).cast("int")))
    lines = F.transform(F.split(F.replace(F.col("token"), F.lit("D"), F.lit("")), ""), lambda x: F.when(x == "U", "user:").when(
        x == "A", "assistant:").when(x == "K", whole).when(x == "u", F.concat(F.lit("user:"), "text")).when(
        x == "a", F.concat(F.lit("assistant:"), "text")))
    said = with_token.withColumn("said", F.when(F.col("token") != "D", F.concat_ws("\n", lines)))
    parts = F.when(F.char_length("said") <= CHUNK, F.array("said")).otherwise(
        F.regexp_extract_all("said", F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0)))
    ordered = said.select("k", "conv_id", "pos", "turn", F.substring("role", 1, 1).alias("initial"), "fault", "token",
                          F.posexplode_outer(parts).alias("part", "chunk"))
    ordered = ordered.withColumn("part", F.coalesce("part", F.lit(0))).repartition("k").sortWithinPartitions("k", "pos", "part")
    found = _arrow(ordered, _report, _RESULT, stream=True)
    every = conversations.select(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")).alias("k"),
                                 F.col("conv_id").cast("long").alias("conv_id")).distinct()
    zero = F.lit(0).cast("long")
    counts = [F.coalesce(c, zero).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return every.join(found.drop("conv_id"), "k", "left").select(
        "conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
