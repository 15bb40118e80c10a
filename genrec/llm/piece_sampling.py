"""Distinct sampled segmentations of whole texts into SentencePiece pieces, and decoding.

The lattice of a text has an arc for every piece that fits a place, weighted by
``-log(2 + rank)`` times a sharpness, and for a character without a piece one
arc of its bytes.  A segmentation's probability is the normalised product of
its arcs.  The ``k`` segmentations of highest Gumbel-perturbed log-probability
are an exact sample without replacement.  They are found best first: a node of
the search is a set of segmentations (a shared beginning, and arcs excluded at
the next place) with the maximum of its perturbed values; the node of the
highest maximum gives the next segmentation, and splits along its path into
the sets that leave it at each place, whose maxima are truncated Gumbel draws.

The inclusion score of a segmentation is the probability that it is perturbed
above the best value left out.

Where two characters stand together in no piece, the lattice falls apart, so it
is a chain of small lattices, and parts that are alike share one (``Lexicon``).  Random numbers are
hashes of the row key, the round, the word's place and the step.

Defined cases: a null or empty text has one segmentation, without pieces; a
text with fewer than ``k`` segmentations gives them all, with inclusion 1;
equal rows give equal samples; an empty table gives an empty result.  As in the
library, U+2581 is decoded as a space.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, fields, replace
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genrec.llm.common import Numbers, arrow_batch_rows

SAMPLES = 3
SHARPNESS = 1.0
BATCH_ROWS = 768
CHUNK_CHARS = 200_000          # texts are worked on together up to this size
RENEWED = 10
LEXICON_CHARS = 120_000        # of the parts of words that a worker remembers from one batch to the next
NEAR = 45.0                    # sets less likely than exp(-NEAR) hold no next segmentation but by a draw above LUCKIEST
LUCKIEST = 37.0                # no Gumbel draw from 53 bits is greater
DECODED = 1 << 16              # pieces whose bytes are put together at once
SPACE = "▁"


class _Table:
    """Whole numbers at least 0 by key, in open addressing."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(4 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, -1, np.int32)
        left, slot = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = np.flatnonzero(self.keys[slot] < 0)
            self.keys[slot[free]] = keys[left[free]]      # of several, one stays
            self.values[slot[free]] = values[left[free]]
            on = self.keys[slot] != keys[left]
            left, slot = left[on], slot[on] + 1 & len(self.keys) - 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def of(self, keys: np.ndarray) -> np.ndarray:
        """The values of the keys; -1: none."""
        slot = self._slot(keys)
        held = self.keys[slot]
        found = np.where(held == keys, self.values[slot], -1)
        left = np.flatnonzero((held != keys) & (held >= 0))
        while len(left):
            slot[left] = slot[left] + 1 & len(self.keys) - 1
            held = self.keys[slot[left]]
            hit = held == keys[left]
            found[left[hit]] = self.values[slot[left[hit]]]
            left = left[~hit & (held >= 0)]
        return found


class Pieces:
    """The pieces of a model as a trie of hashed arcs, and their bytes."""

    def __init__(self, path: str, sharpness: float = SHARPNESS):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.vocab_size()
        self.bytes = [b""] * n
        byte_id = {}
        pieces: dict[str, int] = {}
        rank = np.zeros(n)
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                byte_id[int(piece[1:-1], 16)] = i
                self.bytes[i] = bytes([int(piece[1:-1], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                pieces[piece] = i
                rank[i] = -sp.get_score(i)
                self.bytes[i] = piece.replace(SPACE, " ").encode()
        if len(byte_id) < 256:
            raise ValueError("the model needs a piece for every byte")
        if any(SPACE in p.lstrip(SPACE) or "\n" in p and len(p) > 1 for p in pieces):
            raise ValueError("a piece of the model reaches over a word boundary")
        self.byte_id = np.array([byte_id[b] for b in range(256)], dtype=np.int64)
        # the bytes of all pieces one after another, for decoding in bulk
        self.spelling = np.frombuffer(b"".join(self.bytes), np.uint8)
        self.size = np.fromiter(map(len, self.bytes), np.int64, n)
        self.begin = np.cumsum(self.size) - self.size
        self.longest = max(map(len, pieces))
        self.byte_weight = -sharpness * float(np.log(2 + n))
        weight = -sharpness * np.log(2 + np.maximum(rank, 0))
        nodes: dict[tuple[int, str], int] = {}
        ends: dict[int, int] = {}
        for p, i in pieces.items():
            at = 0
            for c in p:
                at = nodes.setdefault((at, c), len(nodes) + 1)
            ends[at] = i
        keys = np.array([a << 21 | ord(c) for a, c in nodes], dtype=np.int64)
        child = np.fromiter(nodes.values(), np.int64, len(nodes))
        self.arcs = _Table(keys, child)
        self.end_id = np.full(len(nodes) + 1, -1, np.int64)
        self.end_id[list(ends)] = list(ends.values())
        self.weight = weight
        # characters that stand together in some piece; the lattice falls apart between all others
        pairs = {ord(a) << 21 | ord(b) for p in pieces for a, b in zip(p, p[1:], strict=False)}
        self.pairs = _Table(np.array(sorted(pairs), dtype=np.int64), np.zeros(len(pairs), np.int64))
        self.lexicon = Lexicon(self)

    def decode_bytes(self, paths: list[np.ndarray]) -> list[bytes]:
        """For each array of ids the bytes of its pieces, without the space that encoding puts first."""
        ids = np.concatenate(paths) if paths else np.empty(0, np.int64)
        parts = []
        for lo in range(0, len(ids), DECODED):
            some = ids[lo:lo + DECODED]
            size = self.size[some]
            end = np.cumsum(size)
            parts.append(self.spelling[np.arange(end[-1]) + np.repeat(self.begin[some] - (end - size), size)].tobytes())
        whole, out, at = b"".join(parts), [], 0
        for path in paths:
            end = at + int(self.size[path].sum())
            out.append(whole[at + (whole[at:min(at + 1, end)] == b" "):end])
            at = end
        return out

    def decode(self, ids: np.ndarray) -> str:
        return self.decode_bytes([np.asarray(ids, dtype=np.int64)])[0].decode("utf-8", "replace")


@lru_cache(maxsize=2)
def _pieces(path: str, sharpness: float) -> Pieces:
    return Pieces(path, sharpness)


_WORD = re.compile(f"\n|{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+")


def text_words(text: str) -> list[str]:
    """The text as the lattice sees it, cut where no piece reaches over."""
    if text and "  " not in text and text[0] != " " and SPACE not in text:
        # single spaces only: a split at plain characters gives the same words
        words = (SPACE + text.replace(" ", " " + SPACE)).replace("\n", " \n ").split(" ")
        return list(filter(None, words)) if "\n" in text else words
    return _WORD.findall(SPACE + text.replace(" ", SPACE)) if text else []


def _units(words: list[str], pieces: Pieces) -> tuple[list[str], np.ndarray]:
    """Words cut between characters that stand together in no piece: the parts of all words
    one after another, and how many each word has."""
    text = "".join(words)
    code = _code_points(text)
    length = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(length) - length
    cut = np.zeros(len(code), bool)
    if len(code):
        cut[1:] = pieces.pairs.of(code[:-1] << 21 | code[1:]) < 0
        cut[starts] = True
    bounds = np.flatnonzero(cut)
    edges = [*bounds.tolist(), len(code)]
    parts = [text[a:b] for a, b in zip(edges, edges[1:], strict=False)]
    return parts, np.diff(np.searchsorted(bounds, np.append(starts, len(code))))


def _code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)


@dataclass
class Lattice:
    """Lattices of many words.  Places are numbered by the characters left in
    their word; the arcs of a place lie together, longer ones first."""

    ids: np.ndarray           # piece of each arc; -2 - c: the bytes of the character c
    logp: np.ndarray          # log-probability of the arc, given its place
    log_other: np.ndarray     # logarithm of the probability of the place's other arcs; -inf: there is none
    reach: np.ndarray         # place + probability of the arc and the longer ones; below the next place but for its last arc
    to: np.ndarray            # place that the arc leads to; -1: the word's end
    first: np.ndarray         # first arc of each place; one more entry than places
    start: np.ndarray         # first place of each word


def lattice(words: list[str], pieces: Pieces) -> Lattice:
    length = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(length)
    code = _code_points("".join(words))
    n = len(code)
    left = np.repeat(end, length) - np.arange(n)
    # 16-bit numbers are sorted by their digits, in linear time
    order = np.argsort(left.astype(np.uint16) if length.max(initial=0) < 1 << 16 else left, kind="stable")
    ranked = left[order]
    number = np.empty(n + 1, np.int64)
    number[order] = np.arange(n)
    at, ids = [], []                             # by the arcs' length
    node, alive = np.zeros(n, np.int64), np.arange(n)
    bare = np.ones(n, bool)
    for j in range(pieces.longest):
        alive = alive[left[alive] > j]
        if not len(alive):
            break
        child = pieces.arcs.of(node[alive] << 21 | code[alive + j])
        good = child >= 0
        alive, child = alive[good], child[good]
        node[alive] = child
        i = pieces.end_id[child]
        whole = i >= 0
        at.append(alive[whole])
        ids.append(i[whole])
        if j == 0:
            bare[at[0]] = False
    if n:
        alone = np.flatnonzero(bare)
        at[0], ids[0] = np.concatenate([at[0], alone]), np.concatenate([ids[0], -2 - code[alone]])
    # the longest arcs are dealt to their places first, so nothing is sorted
    first = np.zeros(n + 1, np.int64)
    slots = [number[x] for x in at]
    for x in slots:
        first[x + 1] += 1
    first = np.cumsum(first)
    free = first[:-1].copy()
    where, piece, steps, place = (np.empty(first[-1], np.int64) for _ in range(4))
    for j in reversed(range(len(at))):
        to = free[slots[j]]
        free[slots[j]] += 1
        where[to], piece[to], steps[to], place[to] = at[j], ids[j], j + 1, slots[j]
    at, ids = where, piece
    weight = pieces.weight[np.maximum(ids, 0)]
    spelled = np.flatnonzero(ids < 0)
    weight[spelled] = pieces.byte_weight * _byte_count(-2 - ids[spelled])
    inside = left[at] > steps
    to = np.where(inside, number[np.minimum(at + steps, n)], -1)
    beta = np.zeros(n + 1)                       # the last entry, reached by -1, is the word's end
    for lo, hi in _ranges(ranked):
        x, y = first[lo], first[hi]
        total = weight[x:y] + beta[to[x:y]]
        weight[x:y] = total
        cuts = first[lo:hi] - x
        top = np.maximum.reduceat(total, cuts)
        beta[lo:hi] = top + np.log(np.add.reduceat(np.exp(total - np.repeat(top, np.diff(first[lo:hi + 1]))), cuts))
    logp = weight - beta[place]
    p = np.exp(logp)
    below, above = np.zeros(len(p)), np.zeros(len(p))
    head, count = first[:-1], np.diff(first)
    for k in range(1, int(count.max()) if n else 0):
        many = count > k
        head, count = head[many], count[many]
        up, down = head + k, head + count - 1 - k
        below[up] = below[up - 1] + p[up - 1]
        above[down] = above[down + 1] + p[down + 1]
    last = first[1:] - 1
    reach = place + below + p
    reach[last] = place[last] + 1.0
    with np.errstate(divide="ignore"):
        log_other = np.log(below + above)
    return Lattice(ids.astype(np.int32), logp, log_other, reach, to.astype(np.int32), first, number[end - length] if n else end)


def _byte_count(code: np.ndarray) -> np.ndarray:
    """UTF-8 bytes of code points."""
    return 1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF)


class Lexicon:
    """The lattices of the words met so far, and of which parts each word consists.

    Words recur from batch to batch, so a worker builds a part's lattice once.
    When the parts exceed ``LEXICON_CHARS``, it goes back before a batch to its
    core, the words met most often (half of that, and twice at least): most words
    of a corpus are met once.  At first, and after ``RENEWED`` times, it chooses
    the core anew.
    """

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self._reset()

    def _reset(self) -> None:
        self.word, self.unit = Numbers(), Numbers()
        self.chars = 0
        self.lattice = lattice([], self.pieces)
        self.room = {f.name: getattr(self.lattice, f.name) for f in fields(Lattice)}
        self.units = np.empty(0, np.int64)       # the parts of all words one after another
        self.count = np.empty(0, np.int64)       # how many each word has
        self.met = np.empty(0, np.int64)         # how often each word was looked up
        self.core: tuple[int, ...] = ()          # words, parts, parts of all words, characters, places and arcs of the core
        self.numbered: tuple[dict[str, int], ...] = ()    # the core's words and parts
        self.returns = 0

    def _sizes(self) -> tuple[int, ...]:
        return len(self.word), len(self.unit), len(self.units), self.chars, len(self.lattice.first) - 1, len(self.lattice.ids)

    def _renew(self) -> None:
        if self.core and self.returns < RENEWED:
            self.returns += 1
            words, parts, spread, self.chars, places, arcs = self.core
            self.word, self.unit = Numbers(), Numbers()
            self.word.update(self.numbered[0])
            self.unit.update(self.numbered[1])
            self.units, self.count, self.met = self.units[:spread], self.count[:words], self.met[:words]
            size = {"first": places + 1, "start": parts}
            self.lattice = Lattice(**{name: room[:size.get(name, arcs)] for name, room in self.room.items()})
            return
        words = list(self.word)
        often = [words[i] for i in np.argsort(-self.met, kind="stable")[:np.count_nonzero(self.met > 1)].tolist()]
        room = np.searchsorted(np.cumsum([len(w) for w in often]), LEXICON_CHARS // 2, "right")
        self._reset()
        self.look_up(often[:room])
        self.core = self._sizes()
        self.numbered = dict(self.word), dict(self.unit)

    def _add(self, new: Lattice) -> None:
        """The lattices of ``new`` come after those held, whose places and arcs are numbered on; the arrays are
        filled in place, in room that doubles."""
        old = self.lattice
        places, arcs = len(old.first) - 1, len(old.ids)
        later = replace(new, reach=new.reach + places, to=np.where(new.to >= 0, new.to + places, -1), first=new.first[1:] + arcs,
                        start=new.start + places)
        grown = {}
        for name, room in self.room.items():
            n, more = len(getattr(old, name)), getattr(later, name)
            if n + len(more) > len(room):
                self.room[name] = np.empty(max(2 * len(room), n + len(more)), room.dtype)
                self.room[name][:n] = room[:n]
            self.room[name][n:n + len(more)] = more
            grown[name] = self.room[name][:n + len(more)]
        self.lattice = Lattice(**grown)

    def look_up(self, spelled: list[str]) -> np.ndarray:
        """The number of each word; new words are added."""
        if self.chars > LEXICON_CHARS:
            self._renew()
        numbers = self.word.of(spelled)
        if self.word.new:
            parts, count = _units(self.word.new, self.pieces)
            unit = self.unit.of(parts)
            self._add(lattice(self.unit.new, self.pieces))
            self.chars += sum(map(len, self.unit.new))
            self.units = np.concatenate([self.units, unit])
            self.count = np.concatenate([self.count, count])
            self.word.new, self.unit.new = [], []
        met = np.bincount(numbers, minlength=len(self.count))
        met[:len(self.met)] += self.met
        self.met = met
        return numbers


def _ranges(ranked: np.ndarray) -> list[tuple[int, int]]:
    """Runs of equal values in a sorted array."""
    cuts = np.flatnonzero(np.diff(ranked)) + 1
    return list(zip([0, *cuts.tolist()], [*cuts.tolist(), len(ranked)], strict=True)) if len(ranked) else []


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def _uniform(key: np.ndarray, step: int) -> np.ndarray:
    """Numbers inside (0, 1), functions of the keys and the step."""
    z = _mix(key + np.uint64((step + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
    return ((z >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


def _walk(lat: Lattice, place: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Arcs sampled from each place to its word's end, entry by entry; and the first arc of each entry (one more
    entry than places)."""
    active, step, parts = np.arange(len(place)), 0, []
    steps = np.zeros(len(place), np.int64)
    while len(active):
        arc, aim = lat.first[place], place + _uniform(key[active], step)
        short = np.flatnonzero(lat.reach[arc] <= aim)
        while len(short):                        # the longest arc is the likeliest: few go on
            arc[short] += 1
            short = short[lat.reach[arc[short]] <= aim[short]]
        parts.append((active, arc))
        step += 1
        steps[active] = step
        onward = lat.to[arc]
        on = onward >= 0
        active, place = active[on], onward[on]
    first = np.concatenate([[0], np.cumsum(steps)])
    out = np.empty(first[-1], np.int64)
    for i, (entry, arc) in enumerate(parts):
        out[first[entry] + i] = arc
    return out, first


def _below(limit: np.ndarray, location: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Gumbel draws at ``location``, given that they are under ``limit``."""
    return -np.logaddexp(-limit, np.log(-np.log(u)) - location)


@dataclass
class _Path:
    word: np.ndarray          # number of each arc's part of the chain, counted over the batch
    arc: np.ndarray
    logp: float
    ids: np.ndarray


@dataclass
class _Set:
    """Segmentations that begin with ``path`` up to arc ``at`` and go on with none of ``excluded``."""

    best: float               # maximum of their perturbed log-probabilities
    path: _Path
    at: int
    excluded: tuple[int, ...]


def _seed(key: np.ndarray, *numbers: int) -> np.ndarray:
    for x in numbers:
        key = _mix(key + np.uint64((x + 1) * 0x632BE59BD9B4E019 & 0xFFFFFFFFFFFFFFFF))
    return key


def _branch(lat: Lattice, node: _Set, u: float) -> tuple[int, tuple[int, ...], float]:
    """An arc of the set's place, sampled among those not excluded; what is then
    excluded; and the probability of the rest of the place."""
    p = int(np.searchsorted(lat.first, node.path.arc[node.at], "right")) - 1
    arcs = np.arange(lat.first[p], lat.first[p + 1])
    odds = np.exp(lat.logp[arcs])
    odds[[x - arcs[0] for x in node.excluded]] = 0.0
    c = np.cumsum(odds)
    k = int(min(np.searchsorted(c, u * c[-1], "right"), np.flatnonzero(odds)[-1]))
    odds[k] = 0.0
    return int(arcs[k]), (*node.excluded, int(arcs[k])), float(odds.sum())


def sample(texts: list[str], keys: list[int], pieces: Pieces, k: int = SAMPLES,
           ) -> list[list[tuple[np.ndarray, float, float]]]:
    """For each text up to ``k`` of (piece ids, log-probability, log inclusion score), best perturbed first."""
    split = [text_words(t) for t in texts]
    lexicon = pieces.lexicon
    word = lexicon.look_up([w for s in split for w in s])
    lat, unit, count = lexicon.lattice, lexicon.units, lexicon.count
    ends = np.cumsum(count[word])
    before = (np.cumsum(count) - count)[word]
    start = lat.start[unit[np.repeat(before - (ends - count[word]), count[word]) + np.arange(ends[-1] if len(ends) else 0)]]
    last = np.concatenate([[0], ends])[np.cumsum([len(s) for s in split])]
    first = np.concatenate([[0], last[:-1]])
    row_key = _mix(np.array([x & 0xFFFFFFFFFFFFFFFF for x in keys], dtype=np.uint64))
    paths: list[list[_Path]] = [[] for _ in texts]
    sets: list[list[_Set]] = [[] for _ in texts]
    # (text, the set that holds its next segmentation, the segmentation's perturbed value)
    todo: list[tuple[int, _Set | None, float]] = [
        (d, None, float(g)) for d, g in enumerate(-np.log(-np.log(_uniform(_seed(row_key, 0), 0))))]
    for turn in range(k):
        if not todo:
            break
        of = np.array([d for d, _, _ in todo])
        key = _seed(row_key[of], 1, turn)
        toss = _uniform(_seed(key, 2), 0)
        heads, words, places = [], [], []
        for x, (d, node, _) in enumerate(todo):
            word, place = np.arange(first[d], last[d]), start[first[d]:last[d]]
            if node is None:
                heads.append(None)
            else:
                # the beginning is kept, one new arc leaves it, the words after it are sampled freely
                arc, gone, rest = _branch(lat, node, float(toss[x]))
                own = int(node.path.word[node.at])
                inside = lat.to[arc] >= 0
                word = np.arange(own + (not inside), last[d])
                place = start[own + (not inside):last[d]]
                if inside:
                    place = place.copy()
                    place[0] = lat.to[arc]
                heads.append((node.path.word[:node.at], node.path.arc[:node.at], own, arc, gone, rest))
            words.append(word)
            places.append(place)
        n_words = np.array([len(w) for w in words])
        word = np.concatenate(words)
        with np.errstate(over="ignore"):
            salt = _mix(np.repeat(key, n_words) + (word - np.repeat(first[of], n_words)).astype(np.uint64)
                        * np.uint64(0x9FB21C651E98DF25))
        arc, begin = _walk(lat, np.concatenate(places), salt)
        cut = begin[np.concatenate([[0], np.cumsum(n_words)])]
        word = np.repeat(word, np.diff(begin))
        new = []
        for x, head in enumerate(heads):
            w, a = word[cut[x]:cut[x + 1]], arc[cut[x]:cut[x + 1]]
            if head is not None:
                w, a = np.concatenate([head[0], [head[2]], w]), np.concatenate([head[1], [head[3]], a])
            new.append((w, a))
        # the sets that leave the new paths at each place, and the best of them
        n_arcs = np.array([len(a) for _, a in new])
        arcs = np.concatenate([a for _, a in new])
        offset = np.cumsum(n_arcs) - n_arcs
        logp = lat.logp[arcs]
        run = np.cumsum(logp)
        whole = np.concatenate([run, [0.0]])[offset + n_arcs - 1] - np.concatenate([[0.0], run])[offset]
        base = np.concatenate([[0.0], run])[offset]
        ids, edge = _ids(lat.ids[arcs], pieces)
        edge = edge[np.concatenate([offset, [len(arcs)]])]
        salt, limit = _seed(key, 3), np.array([v for _, _, v in todo])
        low = np.array([0 if node is None else node.at + 1 for _, node, _ in todo])
        keep = k - turn

        def leaving(texts: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
            """The best of the sets that leave the paths of ``texts`` at their arcs from ``lo`` to ``hi``."""
            n = hi - lo
            t = np.repeat(texts, n)
            i = np.arange(len(t)) + np.repeat(lo - (np.cumsum(n) - n), n)
            with np.errstate(over="ignore"):
                own = salt[t] + (i - offset[t]).astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)
            return _below(limit[t], run[i] - logp[i] - base[t] + lat.log_other[arcs[i]], _uniform(_mix(own), 0))

        # the further along a path, the less likely the sets: those beyond NEAR are drawn only if they can matter
        lo, end = offset + low, offset + n_arcs
        hi = np.minimum(np.maximum(np.searchsorted(-run, NEAR - base), lo), end)
        best, cut = leaving(np.arange(len(todo)), lo, hi), np.concatenate([[0], np.cumsum(hi - lo)])
        toss = _uniform(_seed(key, 4), 0)
        for x, (d, node, value) in enumerate(todo):
            path = _Path(*new[x], float(whole[x]) if n_arcs[x] else 0.0, ids[edge[x]:edge[x + 1]])
            paths[d].append(path)
            if node is not None:
                _, _, _, _, gone, rest = heads[x]
                if rest > 0:
                    at = offset[x] + node.at
                    mass = float(run[at] - logp[at] - base[x]) + np.log(rest)
                    g = _below(np.array([value]), np.array([mass]), toss[x:x + 1])[0]
                    sets[d].append(_Set(float(g), path, node.at, gone))
            own = best[cut[x]:cut[x + 1]]
            if hi[x] < end[x] and np.count_nonzero(own > LUCKIEST - NEAR) < keep:
                own = leaving(np.array([x]), lo[x:x + 1], end[x:x + 1])
            top = np.argpartition(-own, keep - 1)[:keep] if len(own) > keep else np.arange(len(own))
            first_arc = int(low[x])
            sets[d] += [_Set(float(own[t]), path, first_arc + int(t), (int(path.arc[first_arc + t]),)) for t in top if own[t] > -np.inf]
            sets[d].sort(key=lambda s: -s.best)
            del sets[d][keep:]
        if turn + 1 < k:
            todo = [(d, s, s.best) for d, s in ((d, sets[d].pop(0)) for d, _, _ in todo if sets[d])]
    return [[(p.ids, p.logp, _inclusion(p.logp - sets[d][0].best) if sets[d] else 0.0) for p in got]
            for d, got in enumerate(paths)]


def _inclusion(x: float) -> float:
    """``log(1 - exp(-exp(x)))``."""
    return float(x) if x < -30 else float(np.log(-np.expm1(-np.exp(min(x, 50.0)))))


def _ids(ids: np.ndarray, pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """The ids of arcs with characters spelled as bytes, and the first of each arc (one more entry than arcs)."""
    bare = np.flatnonzero(ids < 0)
    if not len(bare):
        return ids, np.arange(len(ids) + 1)
    code = -2 - ids[bare]
    count = np.ones(len(ids), np.int64)
    count[bare] = _byte_count(code)
    raw = "".join(map(chr, code.tolist())).encode("utf-8", "surrogatepass")
    ids = np.repeat(ids, count)
    ids[ids < 0] = pieces.byte_id[np.frombuffer(raw, np.uint8)]
    return ids, np.concatenate([[0], np.cumsum(count)])


def _chunks(batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
    size = batch["text"].str.len().cumsum() // CHUNK_CHARS
    for _, part in batch.groupby(size, sort=True):
        yield part


def encode(docs: DataFrame, model: str, k: int = SAMPLES, sharpness: float = SHARPNESS, seed: int = 0,
           digest: bool = False) -> DataFrame:
    """``doc_id, sample, n_tokens, log_prob, log_inclusion`` and ``ids`` (little-endian
    unsigned 16-bit, or 32-bit beyond 65536 pieces), one row for each sampled segmentation.

    The row key is ``doc_id`` (null: the text).  With ``digest``, ``ids_crc32``
    (of the ids as 32-bit integers) and ``round_trip`` (whether the ids decode
    to the text) stand in place of ``ids``.
    """
    arrow_batch_rows(docs.sparkSession, BATCH_ROWS)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = _pieces(model, sharpness)
        kind = "<u2" if len(pieces.bytes) <= 1 << 16 else "<u4"
        for batch in batches:
            for b in _chunks(batch):
                texts = b["text"].tolist()
                rows = []
                for doc, none, text, got in zip(b["doc_id"].tolist(), b["none"].tolist(), texts, sample(texts, b["key"].tolist(), pieces, k), strict=True):
                    if digest:
                        plain = text.replace(SPACE, " ").encode("utf-8", "surrogatepass")
                        decoded = pieces.decode_bytes([ids for ids, _, _ in got])
                    for i, (ids, logp, score) in enumerate(got):
                        row = [doc, none, i + 1, len(ids), logp, score]
                        if digest:
                            row += [zlib.crc32(ids.astype("<u4").tobytes()), decoded[i] == plain]
                        else:
                            row.append(ids.astype(kind).tobytes())
                        rows.append(row)
                yield pd.DataFrame(rows, columns=names)

    # ids travel as whole numbers beside the mark of a null: a column with nulls would become floating
    schema = "doc_id long, none boolean, sample int, n_tokens long, log_prob double, log_inclusion double, " + (
        "ids_crc32 long, round_trip boolean" if digest else "ids binary")
    names = [x.split()[0] for x in schema.split(", ")]
    text = F.coalesce("text", F.lit(""))
    key = F.xxhash64(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.col("text")))
    rows = docs.select(*_marked(docs), text.alias("text"), key.alias("key")).mapInPandas(run, schema)
    return rows.withColumn("doc_id", F.when(~F.col("none"), F.col("doc_id"))).drop("none")


def _marked(rows: DataFrame) -> list[Column]:
    doc = F.col("doc_id").cast("long")
    return [F.coalesce(doc, F.lit(0)).alias("doc_id"), doc.isNull().alias("none")]


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """``encoded`` with ``text``, decoded from its column ``ids``."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = _pieces(model, SHARPNESS)
        kind = "<u2" if len(pieces.bytes) <= 1 << 16 else "<u4"
        for b in batches:
            b["text"] = [pieces.decode(np.frombuffer(x, kind)) for x in b["ids"]]
            yield b

    rows = encoded.select(*_marked(encoded), "sample", "n_tokens", "log_prob", "log_inclusion", "ids").mapInPandas(
        run, "doc_id long, none boolean, sample int, n_tokens long, log_prob double, log_inclusion double, ids binary, text string")
    return rows.withColumn("doc_id", F.when(~F.col("none"), F.col("doc_id"))).drop("none")
