"""Secret scan: fixed key patterns plus sliding-window entropy per character class.

Spans count code points, end exclusive. Null and empty texts give no spans. Every row is judged alone, so repeated
rows give repeated results; extra columns pass through, and an input column named like the output is replaced.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices

# The kinds in the order that ties are listed, and their patterns.
KINDS = ("assign", "access", "hex", "entropy")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
#: Candidate strings of the entropy scan: a run of one class, with the least bits that a window must hold.
_CLASSES = (
    ("base64", re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"), 3.6),
    ("hex", re.compile(r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{20,}"), 3.0),
)
_MIXED = (re.compile("[A-Z]"), re.compile("[a-z]"), re.compile("[0-9]"))
#: Candidates that hold one of these are never reported by the entropy scan.
ALLOWED = (
    re.compile(r"example|sample|placeholder|dummy|changeme|xxxx|test", re.I),
    re.compile(r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$", re.I),
    re.compile(r"^[A-Za-z]+(?:[-_/][A-Za-z]+)*$"),
    re.compile(r"^[0-9=+/_-]+$"),
)
_PLOGP = [0.0, *(c * math.log2(c) for c in range(1, 4097))]

SPAN = "struct<kind:string,start:int,end:int>"
_SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def dense_part(s: str, window: int, least: float) -> tuple[int, int] | None:
    """From the first to the last window of s with at least `least` bits a character; counts move one character at a time."""
    size = min(window, len(s))
    counts: dict[str, int] = {}
    total = 0.0
    first = last = -1
    log = math.log2(size)
    for i, c in enumerate(s):
        n = counts.get(c, 0)
        total += _PLOGP[n + 1] - _PLOGP[n]
        counts[c] = n + 1
        if i >= size:
            gone = s[i - size]
            n = counts[gone]
            total += _PLOGP[n - 1] - _PLOGP[n]
            counts[gone] = n - 1
        if i >= size - 1 and log - total / size >= least:
            last = i + 1
            if first < 0:
                first = i + 1 - size
    return None if first < 0 else (first, last)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, rank of the kind, end) of the fixed patterns."""
    found = []
    if ":" in text or "=" in text:
        low = text.lower()
        if any(w in low for w in _WORDS):
            found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def entropy_spans(text: str, window: int, taken: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Dense parts of candidate strings that no allow rule and no other span covers."""
    found: list = []
    for name, pattern, least in _CLASSES:
        # matches of one class are apart, so only earlier spans can cover one: of those that start before it, the farthest end tells
        spans = sorted([*taken, *found])
        starts, reach = [a for a, _, _ in spans], list(accumulate((b for _, _, b in spans), max))
        for m in pattern.finditer(text):
            s = m.group()
            if name == "base64" and not all(p.search(s) for p in _MIXED) or any(p.search(s) for p in ALLOWED):
                continue
            if (part := dense_part(s, window, least)) is None:
                continue
            start, end = m.start() + part[0], m.start() + part[1]
            i = bisect_right(starts, start)
            if not i or reach[i - 1] < end:
                found.append((start, 3, end))
    return found


def spans_of(text: str, window: int = 20) -> list[tuple[int, int, int]]:
    """All spans of one text in order."""
    base = base_spans(text)
    return sorted(base + entropy_spans(text, window, base))


def secret_spans(text: Column, window: int = 20) -> Column:
    """Spans of each text as array<struct<kind,start,end>>; null counts as empty."""

    @F.arrow_udf(f"array<{SPAN}>")
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out: list = []
            for part in slices(batch):
                out += [[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans_of(t, window)] for t in part.to_pylist()]
            yield pa.array(out, _SPAN_TYPE)

    return scan(text)


def find_secrets(df: DataFrame, text: str = "text", out: str = "secret_spans", window: int = 20) -> DataFrame:
    """df with the spans of each text in column `out`."""
    return df.withColumn(out, secret_spans(F.col(f"`{text}`"), window))


def redact_secrets(df: DataFrame, text: str = "text", mask: str = "[SECRET]", window: int = 20) -> DataFrame:
    """df with every span of the text replaced by the mask; overlapping spans become one mask. Null stays null."""

    @F.arrow_udf("string")
    def cleaned(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            nulls, out = batch.is_null().to_pylist(), []
            for part in slices(batch):
                out += [masked(t, mask, window) for t in part.to_pylist()]
            yield pa.array([None if n else t for t, n in zip(out, nulls, strict=True)], pa.string())

    return df.withColumn(text, cleaned(F.col(f"`{text}`")))


def masked(text: str, mask: str = "[SECRET]", window: int = 20) -> str:
    """One text with its spans masked."""
    out, at, end = [], 0, -1
    for a, _, b in spans_of(text, window):
        if a >= end:
            out += [text[at:a], mask]
        at = end = max(end, b)
    return text if end < 0 else "".join([*out, text[at:]])


def digest(df: DataFrame, window: int = 20) -> DataFrame:
    """Counts by kind, the hash of the fixed-pattern spans and all spans as text, one row per row of df.

    Null texts count as empty and have no spans; spans that start together go by kind; an empty table gives no rows."""
    joined = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    found = find_secrets(df.select("doc_id", "text"), window=window)
    n = lambda k: F.size(F.filter("secret_spans", lambda s: s["kind"] == k)).cast("long")
    base = F.filter("secret_spans", lambda s: s["kind"] != "entropy")
    return found.select(
        "doc_id", n("assign").alias("n_assign"), n("access").alias("n_access"), n("hex").alias("n_hex"),
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("secret_spans")).alias("spans"), n("entropy").alias("n_entropy"),
    )
