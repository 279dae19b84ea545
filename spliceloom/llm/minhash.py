"""Near-duplicate texts by a chosen-path set similarity join over word shingles.

A text's set holds the hashes of its distinct shingles of `width` words (ASCII lower-cased; fewer words: the whole sequence;
no words: no set and no links). Equal sets are one class with a representative. In each of several independent trees every
representative follows paths: at a node, coordinates chosen from the node's own hash (one, and with chance 1/similarity - 1
a second) lead to the children named by its minwise tokens there. Nodes of one member end. The rest is compared:

1. each node's smallest member with the others; confirmed links give components;
2. in nodes of up to SMALL members, each member with the BEST most similar sketches outside its component;
3. all nodes exhaustively, those above WHOLE members in pairs of blocks; pairs that a component already joins are left out,
   which loses no component (labels between the rounds need not be final for that). Groups with more than FEW candidates a
   member get the members' full sets and settle them in their own task, which gives at most one link a member.

Every link is confirmed on full sets. The number of trees follows from the target recall, counted over the COORDS coordinates
that all trees share and the bound on sketch bits. Null ids have no links (and are kept); rows that repeat an id share its
component.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free, slices, text_bytes, written
from .components import components
from .words import LOWER, SPACE, mix, span_hashes, split

COORDS, DEPTH, SMALL, BEST = 128, 3, 1000, 4
#: Rows up to which a node is compared in one task; a larger one is dealt into blocks of half as many at least.
WHOLE = 3000
#: Left rows compared at once with all rows of their part.
STRIP = 256
#: Candidate pairs a member of a node up to which they are joined with their sets one by one.
FEW = 8
#: Bytes of sets that go to a Python worker at once.
BATCH = 16 << 20
#: Slots of the filter that spares most texts the shuffle to their candidates; a broadcast of no more rows than this.
SLOTS = 1 << 20
_WORDS = (~SPACE).astype(np.uint8)
_RNG = np.random.default_rng(65537)
_MULTIPLY = _RNG.integers(1, 1 << 31, COORDS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_XOR = _RNG.integers(0, 1 << 32, COORDS, dtype=np.uint64).astype(np.uint32)


def _binomial(n: int, p: float) -> list[float]:
    return [math.comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(n + 1)]


def most_bits(similarity: float) -> int:
    """Bits that sketches of a pair of at least this similarity differ in at most, but for 1 in a million."""
    over, chances = 1.0, _binomial(COORDS, (1 - similarity) / 2)
    for bits, p in enumerate(chances):
        over -= p
        if over < 1e-6:
            return bits
    return COORDS


def missed(similarity: float, trees: int, depth: int = DEPTH) -> float:
    """Chance that a pair of this similarity shares no node of this depth in any tree, or that its sketches differ too much.

    All trees draw from the same coordinates, so they are independent only given how many of those agree.
    """
    two, bits, out = 1 / similarity - 1, most_bits(similarity), 0.0
    for agree, p in enumerate(_binomial(COORDS, similarity)):
        meet = 1.0
        for _ in range(depth):
            one = agree / COORDS * meet
            meet = (1 - two) * one + two * (1 - (1 - one) ** 2)
        out += p * (1 - sum(_binomial(COORDS - agree, 0.5)[: bits + 1]) * (1 - (1 - meet) ** trees))
    return out


def tree_count(similarity: float, recall: float, depth: int = DEPTH) -> int:
    """Trees so that a pair of this similarity becomes a candidate with the chance `recall`."""
    trees = 1
    while missed(similarity, trees, depth) > 1 - recall:
        trees += 1
        if trees > 1000:
            raise ValueError(f"{COORDS} coordinates do not give a recall of {recall}")
    return trees


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    raw, bounds = text_bytes(texts)
    low = LOWER[raw]
    starts, ends, at = split(low, bounds, _WORDS)
    h = span_hashes(low, starts, ends)
    gram, out = h, []
    short = [h]
    for k in range(1, width):
        gram = mix(gram[:-1] * np.uint64(31) + h[k:] + np.uint64(k)) if len(gram) > 1 else gram[:0]
        short.append(gram)
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        n = b - a
        out.append(np.unique(gram[a : b - width + 1]) if n >= width else short[n - 1][a : a + 1] if n else h[:0])
    return out


def sketches(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Minwise tokens (sets, COORDS) and one bit of each, 64 to a number; empty sets get zeros."""
    size = np.fromiter(map(len, sets), np.int64, len(sets))
    mins = np.zeros((len(sets), COORDS), np.uint32)
    full = np.flatnonzero(size)
    if len(full):
        x = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
        at = (np.cumsum(size) - size)[full]
        for c in range(COORDS):
            y = (x ^ _XOR[c]) * _MULTIPLY[c]
            y ^= y >> np.uint32(15)
            y *= np.uint32(0x2C1B3C6D)
            mins[full, c] = np.minimum.reduceat(y, at)
    bits = np.packbits((mins ^ mins >> np.uint32(7) ^ mins >> np.uint32(19)).astype(np.uint8) & 1, axis=1)
    return mins, bits.view(np.int64)


def branch(node: np.ndarray, row: np.ndarray, mins: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Children of (node, row of mins) entries: new nodes and their rows."""
    u = mix(node)
    first = (u % np.uint64(COORDS)).astype(np.int64)
    second = (first + 1 + ((u >> np.uint64(8)) % np.uint64(COORDS - 1)).astype(np.int64)) % COORDS
    two = (u >> np.uint64(32)).astype(np.float64) / 2.0**32 < 1 / similarity - 1
    child = lambda n, r, c: mix(mix(n + np.uint64(0x9E3779B97F4A7C15) * (c.astype(np.uint64) + np.uint64(1))) ^ mins[r, c].astype(np.uint64))
    return np.concatenate([child(node, row, first), child(node[two], row[two], second[two])]), np.concatenate([row, row[two]])


def sketch_table(df: DataFrame, doc_id: str, text: str, width: int) -> DataFrame:
    """doc_id, n, h1, h2 (hash of the set), sig and gis (sketch bits), mins of every row."""
    rows = df.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in slices(batch.column(1)):
                sets = shingle_sets(part, width)
                mins, sig = sketches(sets)
                whole = np.frombuffer(b"".join(xxhash.xxh3_128_digest(s.tobytes()) for s in sets), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(part)), pa.array(np.fromiter(map(len, sets), np.int64, len(sets))), pa.array(whole[:, 0]), pa.array(whole[:, 1]), pa.array(sig[:, 0]), pa.array(sig[:, 1]), pa.array([m.tobytes() for m in mins], pa.binary())],
                    names=["doc_id", "n", "h1", "h2", "sig", "gis", "mins"],
                )
                at += len(part)

    return rows.mapInArrow(run, "doc_id long, n long, h1 long, h2 long, sig long, gis long, mins binary")


def path_rows(reps: DataFrame, similarity: float, trees: int, levels: int) -> DataFrame:
    """node, doc_id, n, sig, gis: where each representative stands after `levels` levels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            mins = np.frombuffer(b"".join(batch.column(4).to_pylist()), np.uint32).reshape(-1, COORDS)
            node = np.repeat(mix(np.arange(1, trees + 1, dtype=np.uint64)), len(mins))
            row = np.tile(np.arange(len(mins)), trees)
            for _ in range(levels):
                node, row = branch(node, row, mins, similarity)
            rest = [batch.column(i).take(pa.array(row)) for i in range(4)]
            yield pa.RecordBatch.from_arrays([pa.array(node.view(np.int64)), *rest], names=["node", "doc_id", "n", "sig", "gis"])

    return reps.select("doc_id", "n", "sig", "gis", "mins").mapInArrow(run, "node long, doc_id long, n long, sig long, gis long")


def full_sets(df: DataFrame, ids: DataFrame, doc_id: str, text: str, width: int) -> DataFrame:
    """doc_id, set of the rows whose id is among `ids` (doc_id)."""
    need = written(ids.distinct(), "needed")
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(SLOTS)).cast("int")
    rows = df.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text")).withColumn("slot", slot)
    rows = rows.join(F.broadcast(need.select(slot.alias("slot")).distinct()), "slot", "left_semi").select("doc_id", "text").join(need, "doc_id", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in slices(batch.column(1)):
                sets = shingle_sets(part, width)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(part)), pa.array([s.tobytes() for s in sets], pa.binary())], names=["doc_id", "set"])
                at += len(part)

    return written(rows.mapInArrow(run, "doc_id long, set binary"), "sets")


def small_batches(df: DataFrame, label: str) -> DataFrame:
    """df as a written table; rows with sets go to Python in batches of about BATCH bytes, so that memory follows the batch."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    was = conf.get(key)
    conf.set(key, str(BATCH))
    try:
        return written(df, label)
    finally:
        conf.set(key, was)


def confirmed(df: DataFrame, pairs: DataFrame, doc_id: str, text: str, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the similarity."""
    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b"))
    return _confirmed(pairs, full_sets(df, ids, doc_id, text, width), percent)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    joined = pairs.join(sets.select(F.col("doc_id").alias("b"), F.col("set").alias("y")), "b").join(sets.select(F.col("doc_id").alias("a"), F.col("set").alias("x")), "a")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.sort(np.concatenate([x, y]), kind="stable")
                common = int(np.count_nonzero(both[1:] == both[:-1]))
                keep.append(100 * common >= percent * (len(both) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return small_batches(joined.select("a", "b", "x", "y").mapInArrow(judge, "a long, b long"), "links")


def _groups(batches: Iterator[pa.RecordBatch], keys: int, rows: int = 50_000, most: int = 64 << 20) -> Iterator[pa.Table]:
    """Tables of whole groups; a group is a run of rows with equal first `keys` columns (null-free long numbers)."""
    held: list[pa.RecordBatch] = []
    size = n = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size, n = size + batch.nbytes, n + batch.num_rows
        if n < rows and size < most:
            continue
        t = pa.Table.from_batches(held)
        change = np.flatnonzero(_edges(t, keys))
        last = int(change[-1])
        if last:
            yield t.slice(0, last)
            t = t.slice(last)
        held, size, n = t.combine_chunks().to_batches(), t.nbytes, t.num_rows
    if held:
        yield pa.Table.from_batches(held)


def _edges(t: pa.Table, keys: int) -> np.ndarray:
    """Whether each row begins a group."""
    new = np.ones(t.num_rows, bool)
    cols = [t.column(i).to_numpy() for i in range(keys)]
    new[1:] = np.any([c[1:] != c[:-1] for c in cols], axis=0)
    return new


def _best_pairs(rows: DataFrame, percent: int, bits: int, best: int) -> DataFrame:
    """Of each row's pairs (a, b) of different labels inside each node of up to SMALL rows, those of the most similar sketches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches, 1):
            doc, *rest = (t.column(c).to_numpy() for c in ("doc_id", *_SKETCH))
            edge = np.append(np.flatnonzero(_edges(t, 1)), t.num_rows).tolist()
            pairs = [np.zeros((2, 0), np.int64)]
            for s, e in zip(edge[:-1], edge[1:], strict=True):
                for at in range(s, e, STRIP):
                    far, ok = _allowed([x[at : min(e, at + STRIP)] for x in rest], [x[s:e] for x in rest], percent, bits)
                    if e - s > best:
                        near = np.argpartition(np.where(ok, far, 255), best, axis=1)[:, :best]
                        some = np.zeros_like(ok)
                        np.put_along_axis(some, near, True, axis=1)
                        ok &= some
                    i, j = np.nonzero(ok)
                    i, j = doc[at + i], doc[s + j]
                    pairs.append(np.unique(np.stack([np.minimum(i, j), np.maximum(i, j)]), axis=1))
            a, b = np.concatenate(pairs, axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    ordered = rows.select("node", "doc_id", *_SKETCH).repartition("node").sortWithinPartitions("node")
    return ordered.mapInArrow(run, "a long, b long")


#: What a comparison of rows looks at before their sets.
_SKETCH = ["n", "sig", "gis", "label"]


def _allowed(x: list[np.ndarray], y: list[np.ndarray], percent: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Differing sketch bits of each left (_SKETCH) with each right row, and whether labels differ while sizes and sketches allow a link."""
    n, sig, gis, label = (c[:, None] for c in x)
    far = np.bitwise_count(sig ^ y[1]) + np.bitwise_count(gis ^ y[2])
    return far, (label != y[3]) & (100 * n >= percent * y[0]) & (percent * n <= 100 * y[0]) & (far <= bits)


def blocked(rows: DataFrame) -> DataFrame:
    """rows with part and side: nodes of up to WHOLE rows are one part (side -1); the rows of a larger one are dealt into
    blocks, and each pair of blocks is a part (sides 0 and 1), so that every two rows meet in just one, or inside their block."""
    zero = F.lit(0).cast("long")
    small = rows.filter(F.col("size") <= WHOLE).select("node", zero.alias("part"), F.lit(-1).cast("long").alias("side"), "doc_id", *_SKETCH)
    step = F.greatest(F.lit(WHOLE / 2), F.least(F.lit(2.0 * WHOLE), F.sqrt("size") * WHOLE / 125))
    large = rows.filter(F.col("size") > WHOLE).withColumn("k", F.ceil(F.col("size") / step))
    large = large.withColumn("own", F.pmod(F.xxhash64("doc_id", F.lit(7)), "k")).withColumn("other", F.explode(F.sequence(zero, F.col("k") - 1)))
    part = F.least("own", "other") * F.col("k") + F.greatest("own", "other")
    side = F.when(F.col("own") == F.col("other"), -1).when(F.col("own") < F.col("other"), 0).otherwise(1)
    return small.union(large.select("node", part.alias("part"), side.cast("long").alias("side"), "doc_id", *_SKETCH))


def candidates(parts: DataFrame, percent: int, bits: int) -> DataFrame:
    """node, part, side, a, b, label: pairs of different labels that size and sketch allow; of parts with more than FEW pairs
    a row, each row that has one (b is null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches, 2):
            cols = [c.to_numpy() for c in t.columns]
            edge = np.append(np.flatnonzero(_edges(t, 2)), t.num_rows)
            light, heavy = [np.zeros((2, 0), np.int64)], [np.zeros(0, np.int64)]
            for s, e in zip(edge[:-1], edge[1:], strict=True):
                _, _, side, d, *rest = (x[s:e] for x in cols)
                within = bool((side < 0).all())
                x, y = (np.arange(e - s),) * 2 if within else (np.flatnonzero(side == 0), np.flatnonzero(side == 1))
                some, right = np.zeros(e - s, bool), [c[y] for c in rest]
                found, pairs = 0, [np.zeros((2, 0), np.int64)]
                for at in range(0, len(x), STRIP):
                    left = x[at : at + STRIP]
                    _, ok = _allowed([c[left] for c in rest], right, percent, bits)
                    found += np.count_nonzero(ok) / (1 + within)
                    some[left] |= ok.any(axis=1)
                    some[y] |= ok.any(axis=0)
                    if found <= FEW * (e - s):
                        i, j = np.nonzero(ok)
                        pairs.append(np.stack([d[left[i]], d[y[j]]]))
                if found > FEW * (e - s):
                    heavy.append(s + np.flatnonzero(some))
                else:
                    light.append(np.unique(np.sort(np.concatenate(pairs, axis=1), axis=0), axis=1))
            at, (a, b) = np.concatenate(heavy), np.concatenate(light, axis=1)
            none = pa.nulls(len(a), pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, none, pa.array(a), pa.array(b), none], names=["node", "part", "side", "a", "b", "label"])
            node, part, side, doc, *_, label = (pa.array(c[at]) for c in cols)
            yield pa.RecordBatch.from_arrays([node, part, side, doc, pa.nulls(len(at), pa.int64()), label], names=["node", "part", "side", "a", "b", "label"])

    ordered = parts.repartition("node", "part").sortWithinPartitions("node", "part")
    return ordered.mapInArrow(run, "node long, part long, side long, a long, b long, label long")


def spanning(sets: list[np.ndarray], side: np.ndarray, label: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links between rows of different labels whose sets reach the similarity, enough to join all that such links join.

    side: -1 for all, else only rows of sides 0 and 1 are compared.
    """
    size = np.fromiter(map(len, sets), np.int64, len(sets))
    starts = np.cumsum(size) - size
    token = np.unique(np.concatenate(sets), return_inverse=True)[1]
    mark = np.zeros(int(token.max()) + 1, bool)
    names, now, counts = np.unique(label, return_inverse=True, return_counts=True)
    main, links = int(np.argmax(counts)), []
    for i in np.flatnonzero(now != main).tolist():
        other = now != now[i]
        if side[i] >= 0:
            other &= side != side[i]
        if not other.any():
            continue
        own = token[starts[i] : starts[i] + size[i]]
        mark[own] = True
        common = np.add.reduceat(mark[token], starts, dtype=np.int64)
        mark[own] = False
        hit = np.flatnonzero(other & (100 * common >= percent * (size + size[i] - common)))
        joined, first = np.unique(now[hit], return_index=True)
        links += [(i, j) for j in hit[first].tolist()]
        now[np.isin(now, joined)] = now[i]
    return links


def settled_links(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) inside each part of the rows, compared on full sets in the part's task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches, 2, most=BATCH):
            side, doc, label = (t.column(c).to_numpy() for c in ("side", "doc_id", "label"))
            edge, out = np.append(np.flatnonzero(_edges(t, 2)), t.num_rows), []
            for s, e in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
                some = [np.frombuffer(x.as_buffer(), np.uint64) for x in t.column("set").slice(s, e - s)]
                out += [(s + i, s + j) for i, j in spanning(some, side[s:e], label[s:e], percent)]
            i, j = np.array(out, np.int64).reshape(-1, 2).T
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(doc[i], doc[j])), pa.array(np.maximum(doc[i], doc[j]))], names=["a", "b"])

    joined = rows.select("node", "part", "side", F.col("a").alias("doc_id"), "label").join(sets, "doc_id")
    ordered = joined.select("node", "part", "side", "doc_id", "label", "set").repartition("node", "part").sortWithinPartitions("node", "part")
    return small_batches(ordered.mapInArrow(run, "a long, b long"), "links")


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80, recall: float = 0.99999) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept (one row id of each component stays).

    Null texts count as empty; texts without words have no shingles and are linked with nothing. Rows without an id take
    no part in links and have a null component. Rows that repeat an id are one document. Of a component the smallest id
    stays, so nothing hangs on ties. An empty table gives no rows; other columns are not looked at."""
    similarity = percent / 100
    trees, bits = tree_count(similarity, recall), most_bits(similarity)
    table = written(sketch_table(df, doc_id, text, width), "sketches")  # mins are read once more, for the representatives
    real = table.filter("n > 0 AND doc_id IS NOT NULL")
    classes = written(real.groupBy("h1", "h2").agg(F.min("doc_id").alias("rep")), "classes")
    reps = written(table.join(classes, ["h1", "h2"]).filter("doc_id = rep").select("doc_id", "n", "sig", "gis", "mins"), "representatives")
    differ = lambda c: F.bit_count(F.col(c).bitwiseXOR(F.col(f"p.{c}")))

    paths = path_rows(reps, similarity, trees, DEPTH)
    first = paths.groupBy("node").agg(F.count(F.lit(1)).alias("size"), F.min(F.struct("doc_id", "n", "sig", "gis")).alias("p")).filter("size > 1")
    nodes = written(paths.join(first, "node"), "nodes")
    near = (100 * F.least("n", "p.n") >= percent * F.greatest("n", "p.n")) & (differ("sig") + differ("gis") <= bits)
    star = nodes.filter((F.col("doc_id") != F.col("p.doc_id")) & near).select(F.col("p.doc_id").alias("a"), F.col("doc_id").alias("b"))
    links = confirmed(df, written(star.distinct(), "star"), doc_id, text, width, percent)

    def sized(nodes: DataFrame, labels: DataFrame) -> DataFrame:
        """Rows of nodes that hold more than one component, with the node's size."""
        rows = written(nodes.join(labels.withColumnRenamed("id", "doc_id"), "doc_id", "left").withColumn("label", F.coalesce("component", "doc_id")).drop("component"), "labelled")
        per = rows.groupBy("node", "label").agg(F.count(F.lit(1)).alias("c"))
        sizes = per.groupBy("node").agg(F.sum("c").alias("size"), F.max("c").alias("top")).filter("size > top").drop("top")
        return written(rows.join(sizes, "node"), "sized")

    nodes = nodes.select("node", "doc_id", "n", "sig", "gis")
    mixed = sized(nodes, components(links, rounds=1))
    best = _best_pairs(mixed.filter(F.col("size") <= SMALL), percent, bits, BEST)
    links = links.union(confirmed(df, written(best.distinct(), "best"), doc_id, text, width, percent))

    mixed = sized(mixed.select("node", "doc_id", "n", "sig", "gis"), components(links, rounds=2))
    found = written(candidates(blocked(mixed), percent, bits), "candidates")
    pairs, rows = written(found.filter("b IS NOT NULL").select("a", "b").distinct(), "pairs"), found.filter("b IS NULL")
    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).union(rows.select("a"))
    sets = full_sets(df, ids, doc_id, text, width)
    more_links = _confirmed(pairs, sets, percent).union(settled_links(rows, sets, percent))
    joined = components(links.union(more_links))
    of_class = classes.join(joined.select(F.col("id").alias("rep"), "component"), "rep", "left").select("h1", "h2", F.coalesce("component", "rep").alias("component"))
    out = table.join(of_class, ["h1", "h2"], "left")
    linked = (F.col("n") > 0) & F.col("doc_id").isNotNull()
    component = F.when(linked, F.col("component")).otherwise(F.col("doc_id"))
    return out.select(F.col("doc_id").alias(doc_id), F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def drop_near_copies(df: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """df with one row id of each group of near copies, all columns, whatever their names; rows without an id stay."""
    gone = free(df, "__gone")
    rows = df.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    copies = near_duplicates(rows, width=width, percent=percent).filter("NOT kept").select(F.col("doc_id").alias(gone)).distinct()
    return df.join(copies, F.col(f"`{doc_id}`") == F.col(gone), "left_anti")
