"""Secrets in whole texts: fixed patterns, and windows of high entropy.

Three patterns give the base spans.  Beyond them, a candidate is a maximal run
of characters that keys are written in.  In each character class's runs of it a
window slides; its Shannon entropy follows from counts that change by one
character in and one out, with the sum of ``c log2 c`` kept up to date.  Windows
at the class's bits or above that hold a digit and a letter are joined to spans.
Candidates on the allow list give none: identifiers, alphabets, placeholders, and
names whose parts are plain words or numbers; callers add patterns of their own.

Work is linear in a text's length.  Spans are code points, end exclusive.

Defined cases: a null or empty text has no spans; a null id stays null; repeated
rows are scanned alike; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import log2

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "entropy")

# The base patterns and their least lengths (of the group, for assignments)
BASE = {
    "assign": (r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]+", 0, 24),
}
FLAGS = {"assign": re.IGNORECASE | re.ASCII}
# runs shorter than the least length match nothing that is kept, so they are passed over in one step
FAST = {"hex": r"(?<![0-9a-f])[0-9a-f]{24,}"}


@dataclass(frozen=True)
class CharClass:
    """Runs of ``chars`` are scanned in windows of ``window`` characters; ``bits`` is the least entropy."""
    name: str
    chars: str
    window: int
    bits: float


CLASSES = (CharClass("hex", "0-9A-Fa-f", 20, 3.0), CharClass("base32", "A-Z2-7", 20, 3.6),
           CharClass("base64", "A-Za-z0-9+/_-", 20, 3.75))
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}"
ALLOWED = (
    r"(?i)[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}",                    # identifiers
    r"(?i).*(?:abcdefgh|bcdefghi|12345678|23456789|example|changeme|placeholder|xxxx).*",
    r"[+/_-]*(?:(?:[A-Z]?[a-z]+|[A-Z]+|[A-Z]?[a-z]{2,}[0-9]{1,4}|[0-9]{8}T[0-9]{4,6}Z?|[0-9]+)(?:[+/_-]+|$))+",   # words, numbers, times
)


def entropy_windows(run: str, window: int, bits: float) -> list[tuple[int, int]]:
    """The places of ``run`` in windows of at least ``bits`` that hold a digit and a letter, joined."""
    if len(run) < window:
        return []
    term = [0.0] + [c * log2(c) for c in range(1, window + 1)]
    most = window * (log2(window) - bits) + 1e-9           # entropy = log2(w) - sum / w
    counts: Counter[str] = Counter()
    total, digits, letters = 0.0, 0, 0
    out: list[tuple[int, int]] = []
    for i, x in enumerate(run):
        total += term[counts[x] + 1] - term[counts[x]]
        counts[x] += 1
        digits, letters = digits + x.isdigit(), letters + x.isalpha()
        if i >= window:
            y = run[i - window]
            total += term[counts[y] - 1] - term[counts[y]]
            counts[y] -= 1
            digits, letters = digits - y.isdigit(), letters - y.isalpha()
        if i >= window - 1 and digits and letters and total <= most:
            start = i - window + 1
            if out and start <= out[-1][1]:
                out[-1] = out[-1][0], i + 1
            else:
                out.append((start, i + 1))
    return out


class Scanner:
    """The patterns of one task, compiled; ``allowed`` extends the allow list."""

    def __init__(self, allowed: Sequence[str] = (), classes: Sequence[CharClass] = CLASSES):
        self.base = [(k, re.compile(FAST.get(k, p), FLAGS.get(k, 0)), g, least) for k, (p, g, least) in BASE.items()]
        self.candidate = re.compile(CANDIDATE)
        self.allowed = [re.compile(p) for p in (*ALLOWED, *allowed)]
        self.classes = [(c, re.compile(f"[{c.chars}]{{{c.window},}}")) for c in classes]

    def base_spans(self, text: str) -> list[tuple[int, int, int]]:
        """``(start, kind, end)``, leftmost and non-overlapping in each kind."""
        return sorted((m.start(), k, m.end()) for k, (_, p, g, least) in enumerate(self.base)
                      for m in p.finditer(text) if m.end(g) - m.start(g) >= least)

    def entropy_spans(self, text: str) -> list[tuple[int, int]]:
        out: list[tuple[int, int]] = []
        for m in self.candidate.finditer(text):
            if any(p.fullmatch(m[0]) for p in self.allowed):
                continue
            found = sorted((m.start() + r.start() + s, m.start() + r.start() + e) for c, p in self.classes
                           for r in p.finditer(m[0]) for s, e in entropy_windows(r[0], c.window, c.bits))
            for s, e in found:
                if out and s <= out[-1][1]:
                    out[-1] = out[-1][0], max(out[-1][1], e)
                else:
                    out.append((s, e))
        return out

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        """Base spans, and the spans of high entropy that no base span holds."""
        base = self.base_spans(text)
        extra, reach, i = [], 0, 0
        for s, e in self.entropy_spans(text):
            while i < len(base) and base[i][0] <= s:        # the furthest end of what starts before
                reach = max(reach, base[i][2])
                i += 1
            if e > reach:
                extra.append((s, KINDS.index("entropy"), e))
        return sorted(base + extra)


def find(documents: DataFrame, allowed: Sequence[str] = (), classes: Sequence[CharClass] = CLASSES) -> DataFrame:
    """``doc_id, secrets ARRAY<STRUCT<start, kind, end>>`` by start, then kind as in ``KINDS``.

    ``allowed``: further patterns of whole candidates that are no secrets.  Lazy.
    """
    span = pa.struct([("start", pa.int32()), ("kind", pa.string()), ("end", pa.int32())])
    schema = pa.schema([("doc_id", pa.int64()), ("secrets", pa.list_(span))])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(allowed, classes)
        for b in batches:
            found = [[{"start": s, "kind": KINDS[k], "end": e} for s, k, e in scanner.spans(x.as_py() or "")] for x in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(found, pa.list_(span))], schema=schema)

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(scan, "doc_id long, secrets array<struct<start:int,kind:string,end:int>>")


def redact(documents: DataFrame, allowed: Sequence[str] = ()) -> DataFrame:
    """``doc_id, text`` with every secret replaced by ``[secret]``; overlapping ones by one.  Lazy."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(allowed)
        for b in batches:
            out = []
            for x in b.column("text").to_pylist():
                parts, at = [], 0
                for s, _, e in scanner.spans(x or ""):
                    if s >= at:
                        parts += [x[at:s], "[secret]"]
                    at = max(at, e)
                out.append(x if x is None else "".join(parts) + x[at:])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(out, pa.string())], names=["doc_id", "text"])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(write, "doc_id long, text string")


def digest(found: DataFrame) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` of ``find``'s rows."""
    def joined(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(
            ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    def of(kind: str):
        return F.filter("secrets", lambda x: x["kind"] == kind)

    counts = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in BASE]
    base = F.filter("secrets", lambda x: x["kind"] != KINDS[-1])
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("secrets")).alias("spans"))
