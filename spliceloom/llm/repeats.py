"""Repeated passages by longest-previous-factor arrays, sharded by minimisers.

Every `width`-byte string of a text belongs to the shard of its minimiser, the least hash of its 32-byte substrings, so equal
strings meet. Consecutive strings of one minimiser form a segment. Equal segments (same minimiser, same 64-bit hash of the
content) are settled first: the earliest stays and the later are covered entirely. Segments that share a minimiser but
differ go on with their bytes. There the shard sorts their suffixes (truncated to `width` bytes) by rank doubling, finds for
every suffix the nearest earlier position before and after it in suffix order, and takes the longer common prefix with
those two as its longest previous factor; a suffix whose factor reaches `width` is covered. Shards above HOT segments
do not go to one task: their strings are grouped by 128-bit hash with partial aggregation. Covered bytes of all strings
are joined into spans of each document.

Order is by document id, then start. Matches never cross documents. Null texts count as empty; rows with a null id are
neither compared nor changed; rows that repeat an id and a text are one document, and each gets its result; rows of one id
with different texts are documents of their own, in order of a hash of the text. Extra columns pass through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, text_bytes, written
from .words import _BASE, _VALUES, mix, span_hashes

GRAM = 32
#: Segments of one shard up to which a task compares their suffixes.
HOT = 30_000
#: Segments that a scanning task settles at once.
SCANNED = 1_500_000
#: Low bits of a hash that make room for the place, so that the least of a window also tells where it is.
_PLACE = np.uint64((1 << 22) - 1)


def gram_hashes(raw: np.ndarray) -> np.ndarray:
    """Hash of the 32 bytes from each position on; the last 31 are undefined."""
    h = _VALUES[raw]
    step, power = 1, _BASE
    while step < GRAM:
        nxt = h * np.uint64(power)
        nxt[: len(h) - step] += h[step:]
        h, step, power = nxt, 2 * step, power * power % (1 << 64)
    return mix(h)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Least of x[i : i + width] for each i; undefined near the end."""
    size = 1
    while 2 * size <= width:
        x = np.concatenate([np.minimum(x[:-size], x[size:]), x[len(x) - size :]]) if len(x) > size else x
        size *= 2
    rest = width - size
    return np.concatenate([np.minimum(x[:-rest], x[rest:]), x[len(x) - rest :]]) if 0 < rest < len(x) else x


def segments(raw: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """Per segment: minimiser, content hash, text number, first start in its text, and twice the number of starts plus 1 if the minimiser occurs more than once in it."""
    none = np.zeros(0, np.int64)
    starts_in = np.maximum(np.diff(bounds) - width + 1, 0)
    if not starts_in.any():
        return none.astype(np.uint64), none.astype(np.uint64), none, none, none
    grams = gram_hashes(raw)
    place = np.arange(len(raw), dtype=np.uint64) & _PLACE
    least = sliding_min(grams & ~_PLACE | place, width - GRAM + 1)
    # starts of all windows, text by text
    doc = np.repeat(np.arange(len(starts_in)), starts_in)
    local = np.arange(len(doc)) - np.repeat(np.cumsum(starts_in) - starts_in, starts_in)
    at = bounds[doc] + local
    spot = at + ((least[at] - at.astype(np.uint64)) & _PLACE).astype(np.int64)
    m = grams[spot]
    moved = np.concatenate([[0], np.cumsum(spot[1:] != spot[:-1])])
    first = np.flatnonzero(np.concatenate([[True], (m[1:] != m[:-1]) | (doc[1:] != doc[:-1])]))
    count = np.diff(np.append(first, len(m)))
    begin = at[first]
    twice = moved[first + count - 1] > moved[first]
    return m[first], span_hashes(raw, begin, begin + count + width - 1), doc[first], local[first], 2 * count + twice


def _scan(df: DataFrame, width: int, repeat: bool) -> DataFrame:
    """m, c, doc_id, (t,) p, n per segment; equal later segments of one task are settled at once (n < 0) and get any m."""
    most, names = SCANNED, ["m", "c", "doc_id", *["t"] * repeat, "p", "n"]

    def settled(parts: list[tuple]) -> Iterator[pa.RecordBatch]:
        m, c, d, t, p, n = (np.concatenate(x) for x in zip(*parts, strict=True))
        parts.clear()
        order = np.lexsort((p, t, d, c, m) if t.any() else (p, d, c, m))
        m, c, d, t, p, n = (x[order] for x in (m, c, d, t, p, n))
        later = np.zeros(len(m), bool)
        later[1:] = (m[1:] == m[:-1]) & (c[1:] == c[:-1])
        head = np.maximum.accumulate(np.where(later, 0, np.arange(len(m))))
        keep = ~(later & (d == d[head]) & (t == t[head]) & (p == p[head]))
        m = np.where(later, mix(d.astype(np.uint64) + p.astype(np.uint64)), m)  # spreads what is settled
        n = np.where(later, -n, n)
        cols = [x[keep] for x in (m.view(np.int64), c.view(np.int64), d, *[t] * repeat, p, n)]
        for i in range(0, len(cols[0]), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(x[i : i + 100_000]) for x in cols], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple] = []
        held = 0
        for batch in batches:
            ids, own, at = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False), 0
            for some in slices(batch.column(2)):
                m, c, d, p, n = segments(*text_bytes(some), width)
                parts.append((m, c, ids[at + d], own[at + d], p.astype(np.int32), n.astype(np.int32)))
                at += len(some)
                held += len(m)
                if held > most:
                    yield from settled(parts)
                    held = 0
        if parts:
            yield from settled(parts)

    return df.mapInArrow(run, "m long, c long, doc_id long, " + "t long, " * repeat + "p int, n int")


def _settle(rows: DataFrame, repeat: bool) -> DataFrame:
    """Per segment that is not alone with its minimiser: m (null if it is covered entirely), doc_id, t, p, n.

    Rows come sorted, so that of a shard no more than its last different segment is held.
    """

    def out(cols: list[np.ndarray], some: np.ndarray, covered: np.ndarray) -> pa.RecordBatch:
        m, _, d, t, p, n = (x[some] for x in cols)
        return pa.RecordBatch.from_arrays([pa.array(m, mask=covered[some]), pa.array(d), pa.array(t), pa.array(p), pa.array((np.abs(n) >> 1).astype(np.int32))], names=["m", "doc_id", "t", "p", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head_row: list[np.ndarray] | None = None  # the last shard's last different segment, whether it waits, whether others differ
        waits = mixed = False
        for batch in batches:
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if not repeat:
                cols.insert(3, np.zeros(len(cols[0]), np.int64))
            known = cols[5] < 0
            if known.any():
                yield out(cols, known, known)
                cols = [c[~known] for c in cols]
            if not len(cols[0]):
                continue
            if held := head_row is not None:
                cols = [np.concatenate([a, b]) for a, b in zip(head_row, cols, strict=True)]
            m, c, d, t, p, n = cols
            same_m = np.concatenate([[False], m[1:] == m[:-1]])
            later = same_m & np.concatenate([[False], c[1:] == c[:-1]])
            head = np.maximum.accumulate(np.where(later, 0, np.arange(len(m))))
            covered = later & ~((d == d[head]) & (t == t[head]) & (p == p[head]))
            group = np.cumsum(~same_m) - 1
            many = np.bincount(group, weights=~later) > 1
            many[0] |= held and mixed
            contested = ~later & (many[group] | (n & 1 == 1))
            some = covered | contested
            some[0] &= waits or not held
            yield out(cols, some, covered)
            last = int(head[-1])
            waits, mixed = not some[last] and (waits or last > 0 or not held), bool(many[-1])
            head_row = [x[last : last + 1] for x in cols]

    ordered = rows.repartition("m").sortWithinPartitions(*rows.columns[:-1])
    return ordered.mapInArrow(run, "m long, doc_id long, t long, p int, n int")


def suffix_ranks(raw: np.ndarray, width: int) -> list[tuple[int, np.ndarray]]:
    """(size, rank of each suffix by its first `size` bytes) for sizes 8, doubled up to `width`; zeros follow the end."""
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    word = np.zeros(len(raw), np.uint64)
    for k in range(8):
        word = word << np.uint64(8) | padded[k : k + len(raw)].astype(np.uint64)
    rank, size, out = np.unique(word, return_inverse=True)[1], 8, []
    while True:
        out.append((size, rank.astype(np.int32)))
        if size >= width:
            return out
        step = min(size, width - size)
        after = np.zeros(len(raw), np.uint64)
        after[: len(raw) - step] = rank[step:].astype(np.uint64) + np.uint64(1)
        rank, size = np.unique(rank.astype(np.uint64) << np.uint64(32) | after, return_inverse=True)[1], size + step


def nearest_smaller(x: np.ndarray, step: int) -> np.ndarray:
    """Index of the nearest smaller value before (step -1) or after (step 1) each value; -1 for none. Pointers jump along pointers."""
    n = len(x)
    at = np.arange(n) + step
    live = np.arange(n)
    while len(live):
        inside = (at[live] >= 0) & (at[live] < n)
        live = live[inside]
        live = live[x[at[live]] >= x[live]]
        at[live] = at[at[live]]
    return np.where((at >= 0) & (at < n), at, -1)


def longest_previous_factors(raw: np.ndarray, levels: list[tuple[int, np.ndarray]], at: np.ndarray, place: np.ndarray, exact: bool = True) -> np.ndarray:
    """Longest common prefix, up to the levels' last size, of each suffix raw[at:] with one of an earlier place.

    In suffix order the longest is with the nearest earlier place before it or after it. Unless exact, factors below the
    last size are given as 0.
    """
    width, whole = levels[-1]
    order = np.lexsort((place, whole[at]))
    sorted_place, own, best = place[order], at[order], np.zeros(len(at), np.int64)
    for step in (-1, 1):
        near = nearest_smaller(sorted_place, step)
        i = np.flatnonzero(near >= 0)
        a, b = own[i], own[near[i]]
        length = np.where(whole[a] == whole[b], width, 0)
        rest = np.flatnonzero(length == 0) if exact else i[:0]
        a, b, got = a[rest], b[rest], np.zeros(len(rest), np.int64)
        for size, rank in reversed(levels[:-1]):
            x, y = np.minimum(a + got, len(raw) - 1), np.minimum(b + got, len(raw) - 1)
            got += size * (rank[x] == rank[y])
        for _ in range(7):
            x, y = np.minimum(a + got, len(raw) - 1), np.minimum(b + got, len(raw) - 1)
            same = (raw[x] == raw[y]) & (got < width - 1)
            if not same.any():
                break
            got += same
        length[rest] = np.minimum(got, width - 1)
        best[i] = np.maximum(best[i], length)
    out = np.empty(len(at), np.int64)
    out[order] = best
    return out


def _bytes_of(df: DataFrame, verdicts: DataFrame, width: int) -> DataFrame:
    """m, doc_id, t, p, bytes of the contested segments."""
    wanted = verdicts.groupBy("doc_id", "t").agg(F.collect_list(F.struct("m", "p", "n")).alias("s"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                doc, own, text, segs = (c[i] for c in batch.columns)
                raw, segs = (text.as_buffer() if text.is_valid else b""), segs.as_py()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([s["m"] for s in segs], pa.int64()), pa.array([doc.as_py()] * len(segs), pa.int64()), pa.array([own.as_py()] * len(segs), pa.int64()), pa.array([s["p"] for s in segs], pa.int32()), pa.array([bytes(raw[s["p"] : s["p"] + s["n"] + width - 1]) for s in segs], pa.binary())],
                    names=["m", "doc_id", "t", "p", "bytes"],
                )

    return df.join(wanted, ["doc_id", "t"]).select("doc_id", "t", "text", "s").mapInArrow(cut, "m long, doc_id long, t long, p int, bytes binary")


def _compare(rows: DataFrame, width: int, most: int = 3 << 20) -> DataFrame:
    """doc_id, t, a, b: covered byte ranges among segments that share minimisers; whole shards of about `most` bytes at a time."""

    def judge(group: list[tuple]) -> pa.RecordBatch:
        _, doc, own, p, data = zip(*group, strict=True)
        size = np.fromiter(map(len, data), np.int64, len(data))
        raw = np.frombuffer(b"".join(data), np.uint8)
        starts = size - width + 1
        seg = np.repeat(np.arange(len(size)), starts)
        local = np.arange(len(seg)) - np.repeat(np.cumsum(starts) - starts, starts)
        doc, own, p = np.array(doc), np.array(own), np.array(p)
        # positions: documents in order, then starts
        order = np.lexsort((own, doc))
        first = np.append(True, (doc[order][1:] != doc[order][:-1]) | (own[order][1:] != own[order][:-1]))
        nth = np.empty(len(doc), np.int64)
        nth[order] = np.cumsum(first)
        factors = longest_previous_factors(raw, suffix_ranks(raw, width), (np.cumsum(size) - size)[seg] + local, nth[seg] << 36 | (p[seg] + local), exact=False)
        hit = factors >= width
        run = np.flatnonzero(hit & ~np.concatenate([[False], hit[:-1] & (seg[1:] == seg[:-1])]))
        last = np.flatnonzero(hit & ~np.concatenate([hit[1:] & (seg[1:] == seg[:-1]), [False]]))
        return pa.RecordBatch.from_arrays([pa.array(doc[seg[run]]), pa.array(own[seg[run]]), pa.array((p[seg[run]] + local[run]).astype(np.int32)), pa.array((p[seg[last]] + local[last] + width).astype(np.int32))], names=["doc_id", "t", "a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if size >= most and row[0] != group[-1][0]:
                    yield judge(group)
                    group, size = [], 0
                group.append(row)
                size += len(row[4])
        if group:
            yield judge(group)

    return rows.repartition("m").sortWithinPartitions("m").mapInArrow(run, "doc_id long, t long, a int, b int")


def _grouped(rows: DataFrame, width: int) -> DataFrame:
    """As _compare, for shards of any size: every string by itself, grouped by its 128-bit hash."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, doc, own, p, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                n = len(data) - width + 1
                yield pa.RecordBatch.from_arrays([pa.array([xxhash.xxh3_128_digest(data[i : i + width]) for i in range(n)], pa.binary()), pa.array([doc] * n, pa.int64()), pa.array([own] * n, pa.int64()), pa.array(range(p, p + n), pa.int32())], names=["w", "doc_id", "t", "a"])

    strings = rows.mapInArrow(cut, "w binary, doc_id long, t long, a int")
    first = strings.groupBy("w").agg(F.min(F.struct("doc_id", "t", "a")).alias("first"), F.count(F.lit(1)).alias("times")).filter("times > 1")
    later = strings.join(first, "w").filter(F.struct("doc_id", "t", "a") > F.col("first"))
    return later.select("doc_id", "t", "a", (F.col("a") + width).alias("b"))


def _repeat(df: DataFrame, doc_id: str) -> bool:
    """Whether an id stands on several rows."""
    return not df.select(F.col(f"`{doc_id}`").alias("d")).filter("d IS NOT NULL").groupBy("d").count().filter("count > 1").isEmpty()


def _numbered(df: DataFrame, doc_id: str, text: str, repeat: bool) -> DataFrame:
    """df with __d (id) and __t, which tells apart rows of one id with different texts and is 0 where ids do not repeat."""
    return df.withColumn("__d", F.col(f"`{doc_id}`").cast("long")).withColumn("__t", F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit(""))) if repeat else F.lit(0).cast("long"))


def covered_spans(df: DataFrame, width: int = 100, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, t, a, b: byte ranges whose every byte lies in a `width`-byte string that also starts earlier; ranges may overlap."""
    if width < 2 * GRAM:
        raise ValueError(f"width must be {2 * GRAM} at least")
    repeat = _repeat(df, doc_id)
    rows = _numbered(df, doc_id, text, repeat).select(F.col("__d").alias("doc_id"), F.col("__t").alias("t"), F.col(f"`{text}`").alias("text")).filter("doc_id IS NOT NULL")
    verdicts = written(_settle(_scan(rows, width, repeat), repeat), "segments")
    whole = verdicts.filter("m IS NULL").select("doc_id", "t", F.col("p").alias("a"), (F.col("p") + F.col("n") + (width - 1)).alias("b"))
    contested = verdicts.filter("m IS NOT NULL")
    hot = written(contested.groupBy("m").count().filter(F.col("count") > HOT).select("m"), "hot")
    if hot.isEmpty():
        return whole.union(_compare(_bytes_of(rows, contested, width), width))
    large = _grouped(written(_bytes_of(rows, contested.join(hot, "m"), width), "strings"), width)
    return whole.union(_compare(_bytes_of(rows, contested.join(hot, "m", "left_anti"), width), width)).union(large)


def _joined(spans: list) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _with_spans(df: DataFrame, width: int, doc_id: str, text: str) -> DataFrame:
    spans = covered_spans(df, width, doc_id, text).groupBy("doc_id", "t").agg(F.collect_list(F.struct("a", "b")).alias("__spans"))
    spans = spans.select(F.col("doc_id").alias("__id"), F.col("t").alias("__own"), "__spans")
    return _numbered(df, doc_id, text, _repeat(df, doc_id)).join(spans, (F.col("__d") == F.col("__id")) & (F.col("__t") == F.col("__own")), "left").drop("__id", "__own", "__d", "__t")


def repeat_digest(df: DataFrame, width: int = 100) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for text, spans in zip(batch.column(1), batch.column(2), strict=True):
                raw = memoryview(text.as_buffer()) if text.is_valid else memoryview(b"")
                gone = _joined([(s["a"], s["b"]) for s in spans.as_py() or []])
                sha, at = hashlib.sha256(), 0
                for a, b in gone:
                    sha.update(raw[at:a])
                    at = b
                sha.update(raw[at:])
                for c, v in zip(out, (len(raw), sum(b - a for a, b in gone), len(gone), sha.hexdigest()), strict=True):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in out[:3]), pa.array(out[3], pa.string())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    kind = dict(df.dtypes)["doc_id"]
    rows = _with_spans(df.select("doc_id", "text"), width, "doc_id", "text").select("doc_id", "text", "__spans")
    return rows.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove_repeats(df: DataFrame, width: int = 100, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """df, all columns whatever their names, with covered bytes cut out of the texts; code points cut in two become U+FFFD. Null texts stay null."""

    @F.arrow_udf("string")
    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for t, s in zip(texts, spans, strict=True):
            if not t.is_valid or not s.is_valid:
                out.append(t.as_py())
                continue
            raw, at, kept = t.as_buffer().to_pybytes(), 0, []
            for a, b in _joined([(x["a"], x["b"]) for x in s.as_py()]):
                kept.append(raw[at:a])
                at = b
            out.append(b"".join([*kept, raw[at:]]).decode("utf-8", "replace"))
        return pa.array(out, pa.string())

    packed = df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"), F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    done = _with_spans(packed, width, "doc_id", "text").withColumn("text", cut(F.col("text"), F.col("__spans")))
    return done.select(*(F.col("text").alias(c) if c == text else F.col("row").getField(c).alias(c) for c in df.columns))
