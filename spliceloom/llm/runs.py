"""Periodic runs of words: maximal stretches that repeat with a period, found over a harmonic grid of probes.

The words of a text are numbered from 0. A run is a stretch of at least max(shortest, 2 * period) words in which words one
period apart are identical and which no neighbouring word extends; its period is the smallest it has. For each period q
places are probed max(q, shortest - q) apart: a run of period q holds one of them, i, so that words i and i + q are equal,
and the longest common extensions of i and i + q to both sides give its ends. A stretch of two periods or more that also
has a smaller period is found with that one at the same ends, so of equal ends the smallest period is the run.

Extensions come from a difference cover: modulo 31 every difference occurs between residues of the cover, so after fewer
than 31 compared words both places are sampled suffixes. Only those are sorted (blocks of 31 words first, then by doubling),
and the smallest common prefix between two of them is a range minimum over a sparse table. The extensions to the left are
those of the reversed words.

Texts are worked on in batches of whole texts, about 100 bytes of memory for each word of a batch; the longest text bounds it. Null and empty
texts have no words and no runs, null ids stay null, repeated rows have a row each, an empty table gives no rows, and
other columns are not looked at.
"""

from __future__ import annotations

import functools
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import compress, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

# A perfect difference cover.
MODULUS, COVER = 31, (0, 1, 3, 8, 12, 18)
#: Texts up to this many words take their probes from one shared table.
TABLE = 4096
#: Probes judged at once.
PROBES = 1 << 20

_SLOT = np.full(MODULUS, -1, np.int64)
_SLOT[list(COVER)] = np.arange(len(COVER))
#: words until places of residue r and of residue r + d are both sampled
_AHEAD = np.array([[min((c - r) % MODULUS for c in COVER if (c + d) % MODULUS in COVER) for d in range(MODULUS)] for r in range(MODULUS)])


class Extensions:
    """Longest common extensions to the right between places of one sequence of positive numbers."""

    def __init__(self, seq: np.ndarray):
        v, k = MODULUS, len(COVER)
        n = -(-(len(seq) + v) // v) * v
        padded = np.zeros(n + v, np.uint16 if len(seq) and seq.max() < 1 << 16 else np.uint32)
        padded[: len(seq)] = seq
        self.seq = padded
        at = (np.arange(0, n, v)[:, None] + np.array(COVER)).ravel()
        blocks = np.lib.stride_tricks.sliding_window_view(padded, v)[at].astype(padded.dtype.newbyteorder(">"))
        m = len(at)
        rank = np.unique(blocks.view(f"S{blocks.itemsize * v}").ravel(), return_inverse=True)[1].ravel().astype(np.int64)
        levels, step = [rank], k
        while step < m and rank.max() + 1 < m:
            key = rank * (m + 1)
            key[:-step] += rank[step:] + 1
            rank = np.unique(key, return_inverse=True)[1].ravel()
            levels.append(rank)
            step *= 2
        order = np.argsort(rank, kind="stable")
        self.rank = np.empty(m, np.int64)
        self.rank[order] = np.arange(m)
        self.table = self._minima(self._neighbours(order, levels, blocks))

    def _neighbours(self, order: np.ndarray, levels: list[np.ndarray], blocks: np.ndarray) -> np.ndarray:
        """Words that sampled suffixes have in common with the next in order."""
        k, m = len(COVER), len(order)
        a, b = order[:-1].copy(), order[1:].copy()
        common = np.zeros(len(a), np.int64)
        for level in range(len(levels) - 1, -1, -1):
            inside = np.flatnonzero((a < m) & (b < m))
            same = inside[levels[level][a[inside]] == levels[level][b[inside]]]
            common[same] += MODULUS << level
            a[same] += k << level
            b[same] += k << level
        for lo in range(0, len(a), 1 << 16):
            part = np.arange(lo, min(lo + (1 << 16), len(a)))
            part = part[(a[part] < m) & (b[part] < m)]
            common[part] += (blocks[a[part]] != blocks[b[part]]).argmax(axis=1)
        return common

    def _minima(self, common: np.ndarray) -> list[np.ndarray]:
        table, width = [common.astype(np.int32)], 1
        while 2 * width <= len(common):
            table.append(np.minimum(table[-1][:-width], table[-1][width:]))
            width *= 2
        return table

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Equal words from places i and j on, for each pair; i and j differ."""
        v, k, seq = MODULUS, len(COVER), self.seq
        ahead = _AHEAD[i % v, (j - i) % v]
        out, live = ahead.copy(), np.arange(len(i))
        far, t = ahead.max(initial=0), 0
        while t < far and len(live):
            alike = (seq[i[live] + t] == seq[j[live] + t]) | (ahead[live] <= t)
            out[live[~alike]] = t
            live = live[alike]
            t += 1
        x, y = i[live] + ahead[live], j[live] + ahead[live]
        x, y = self.rank[x // v * k + _SLOT[x % v]], self.rank[y // v * k + _SLOT[y % v]]
        lo, hi = np.minimum(x, y), np.maximum(x, y)
        size = np.frexp((hi - lo).astype(float))[1] - 1
        for s in np.unique(size).tolist():
            some = size == s
            row = self.table[s]
            out[live[some]] += np.minimum(row[lo[some]], row[hi[some] - (1 << s)])
        return out


@functools.cache
def _probes(shortest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places and periods of all probes with place + period < TABLE, in order of that sum, and the sums."""
    place, period = map(np.concatenate, zip(*((i := np.arange(0, TABLE - q, max(q, shortest - q)), np.full(len(i), q)) for q in range(1, TABLE // 2 + 1)), strict=True))
    order = np.argsort(place + period, kind="stable")
    return place[order], period[order], (place + period)[order]


def _alike(seq: np.ndarray, lo: int, n: int, shortest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Probes (place, period) of the n words from lo on whose two words are equal."""
    if n <= TABLE:
        place, period, last = _probes(shortest)
        m = int(np.searchsorted(last, n))
        some = np.flatnonzero(seq[lo + place[:m]] == seq[lo + last[:m]])
        yield lo + place[some], period[some]
        return
    root = max(shortest, int(n**0.5))
    for q in range(1, root):
        step = max(q, shortest - q)
        some = np.flatnonzero(seq[lo : lo + n - q : step] == seq[lo + q : lo + n : step])
        yield lo + some * step, np.full(len(some), q)
    for nth in range(n // root + 1):
        period = np.arange(root, min(n // 2, (n - 1) // (nth + 1)) + 1)
        some = period[seq[lo + nth * period] == seq[lo + (nth + 1) * period]]
        yield lo + nth * some, some


def find(seq: np.ndarray, bounds: list[tuple[int, int]], shortest: int = 12) -> np.ndarray:
    """Runs inside each stretch (place, words) of seq as rows (start, end, period), sorted by start, then end.

    Place 0 and the places around each stretch must hold numbers that occur nowhere else."""
    pairs = [p for lo, n in bounds if n >= shortest for p in _alike(seq, lo, n, shortest)]
    if not sum(len(p) for p, _ in pairs):
        return np.zeros((0, 3), np.int64)
    place, period = (np.concatenate(x) for x in zip(*pairs, strict=True))
    cuts = [slice(x, x + PROBES) for x in range(0, len(place), PROBES)]
    reach = Extensions(seq)
    right = np.concatenate([reach(place[c], place[c] + period[c]) for c in cuts])
    reach, n = Extensions(seq[::-1]), len(seq)
    left = np.concatenate([reach(n - place[c], n - place[c] - period[c]) for c in cuts])
    ok = left + right + period >= np.maximum(shortest, 2 * period)
    found = np.unique(np.stack([(place - left)[ok], (place + period + right)[ok], period[ok]], axis=1), axis=0)
    first = np.ones(len(found), bool)
    first[1:] = (found[1:, :2] != found[:-1, :2]).any(axis=1)
    return found[first]


def find_runs(df: DataFrame, shortest: int = 12, rewrite: Callable[[object, int], np.ndarray | None] | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, runs as array of (start, length, period) by start, then period, and collapsed, the words joined by
    one space without those that repeat: in each run all words after its first period.

    rewrite(id, number of words) may give the word numbers that a document is taken to consist of."""
    if shortest < 2:
        raise ValueError("shortest must be 2 or more")
    rows = df.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for some in slices(batch.column(1)):
                ids = batch.column(0).slice(at, len(some))
                number: dict[bytes, int] = defaultdict(count(1).__next__)
                words, seqs, bounds, place = [], [], [], 1
                for i, t in zip(ids.to_pylist(), some.to_pylist(), strict=True):
                    own = t.encode().split()
                    order = rewrite(i, len(own)) if rewrite else None
                    if order is not None:
                        own = [own[x] for x in order.tolist()]
                    words.append(own)
                    seqs.append(np.fromiter(map(number.__getitem__, own), np.int64, len(own)))
                    bounds.append((place, len(own)))
                    place += len(own) + 1
                seq, edge = np.zeros(place, np.int64), len(number) + 1
                seq[0] = edge
                for k, ((lo, n), own) in enumerate(zip(bounds, seqs, strict=True)):
                    seq[lo : lo + n] = own
                    seq[lo + n] = edge + 1 + k
                found = find(seq, bounds, shortest)
                owner = np.searchsorted([lo for lo, _ in bounds], found[:, 0], side="right") - 1
                cuts = np.searchsorted(owner, np.arange(len(bounds) + 1))
                starts = found[:, 0] - np.array([lo for lo, _ in bounds], np.int64)[owner] if len(found) else found[:, 0]
                lengths, periods = found[:, 1] - found[:, 0], found[:, 2]
                # by start, then end is not by period: sort anew inside a document
                by = np.lexsort((periods, starts, owner))
                starts, lengths, periods = starts[by], lengths[by], periods[by]
                collapsed = []
                for k, own in enumerate(words):
                    a, b = int(cuts[k]), int(cuts[k + 1])
                    if b > a:
                        edges = np.zeros(len(own) + 1, np.int64)
                        np.add.at(edges, starts[a:b] + periods[a:b], 1)
                        np.add.at(edges, starts[a:b] + lengths[a:b], -1)
                        own = compress(own, (np.cumsum(edges[:-1]) == 0).tolist())
                    collapsed.append(b" ".join(own).decode())
                values = pa.StructArray.from_arrays([pa.array(x) for x in (starts, lengths, periods)], fields=list(run))
                runs = pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), values)
                yield pa.RecordBatch.from_arrays([ids, runs, pa.array(collapsed, pa.string())], names=["doc_id", "runs", "collapsed"])
                at += len(some)

    return rows.mapInArrow(work, f"doc_id {dict(rows.dtypes)['doc_id']}, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def made_periodic(doc_id: object, n: int) -> np.ndarray | None:
    """Word numbers of a document that the digest makes periodic: one id in ten, by crc32 of the id; null ids never."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return np.concatenate([np.arange(a), a + np.arange(n - a) % p])


def run_digest(df: DataFrame, rewrite: Callable[[object, int], np.ndarray | None] | None = made_periodic, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_runs, the longest run (ties: smallest start, then period) and digests of runs and collapsed words."""
    found = find_runs(df, 12, rewrite, doc_id, text)
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.concat(F.array_join(F.transform("runs", line), "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    rows = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), lines.alias("lines"), "collapsed")
    return rows.select(
        "doc_id", "n_runs", (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(F.col("lines").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
