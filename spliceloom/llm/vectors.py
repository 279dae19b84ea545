"""Near-duplicate vectors by a robust-pruned flat graph over overlapping cluster shards.

Equal vectors are one class, which stands once with its size. Centres fitted on a bounded sample deal every class to its
`overlap` nearest clusters; clusters above SHARD classes are dealt on by hash, and then pairs of parts are searched too. Each
shard builds a graph: near candidates pruned robustly, far ones for reach, reversed edges added. Adjacency lists of one class
from all its shards are united. The search runs in every shard from several medoids: a greedy beam towards each query, then
an expansion along edges through everything within range. Each reported link is verified in double precision, and counted
in the first shard its two ends share. `audit` measures recall against brute force over all rows; below LEAST_RECALL the
search is repeated with more overlap.

Null, empty, zero and non-finite vectors, or those with null components, link with nothing; so do rows with a null id.
Vectors of different lengths count as padded with zeros. Rows that repeat an id count as rows each; those with different
vectors belong to different classes and may be in different components. Extra columns are ignored; an empty table gives
no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sampled, written
from .components import components

SAMPLE, CENTRES, CLUSTER, SHARD = 16_384, 512, 400, 2_000
NEAR, FAR, DEGREE, BACK, ALPHA = 40, 24, 20, 12, 1.2
BEAM, MEDOIDS, SLACK = 24, 8, 0.1
#: Audited rows; recall below which the overlap grows; the least recall that ends the growth once the overlap is 16 or more.
AUDIT, LEAST_RECALL, STATED_RECALL = 128, 0.98, 0.9


def matrix(col: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list array as unit vectors in double precision, padded with zeros."""
    out = np.zeros((len(col), dim))
    lists = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    values, ends = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64), np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])
    size = np.diff(ends)
    out[np.arange(dim) < size[:, None]] = values
    out /= np.abs(out).max(axis=1, initial=0.0)[:, None]  # squares of very large or small components stay in range
    return out / np.sqrt((out * out).sum(axis=1))[:, None]


def fit_centres(x: np.ndarray, count: int, rounds: int = 6, seed: int = 3) -> np.ndarray:
    """Spherical k-means."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(count, len(x)), replace=False)]
    for _ in range(rounds):
        near = np.argmax(x @ c.T, axis=1)
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        norm = np.linalg.norm(total, axis=1)
        c = np.where(norm[:, None] > 0, total / np.maximum(norm, 1e-12)[:, None], c)
    return c


def pruned(x: np.ndarray, of: np.ndarray, pool: np.ndarray, degree: int) -> np.ndarray:
    """Robust pruning: of each pool (ids, nearest first, -1 for none) the nearest is taken and those it dominates by ALPHA go, again and again."""
    out = np.full((len(of), degree), -1)
    for a in range(0, len(of), 256):
        ids = pool[a : a + 256]
        v = x[np.maximum(ids, 0)]
        far = 1 - np.einsum("nkd,nd->nk", v, x[of[a : a + 256]])
        live = (ids >= 0) & (ids != of[a : a + 256, None])
        rows = np.arange(len(ids))
        for k in range(degree):
            best = np.argmin(np.where(live, far, np.inf), axis=1)
            some = live[rows, best]
            out[a : a + 256, k][some] = ids[rows, best][some]
            between = 1 - np.einsum("nkd,nd->nk", v, v[rows, best])
            live &= ~(some[:, None] & (ALPHA * between <= far))
            live[rows, best] = False
    return out


def build(x: np.ndarray, seed: int = 5) -> np.ndarray:
    """Adjacency (n, degree of near, far and reversed edges), -1 for none, over one shard's unit vectors."""
    n, rng = len(x), np.random.default_rng(seed)
    of = np.arange(n)
    pool = np.full((n, min(NEAR, n)), -1)
    for a in range(0, n, 512):
        s = x[a : a + 512] @ x.T
        k = pool.shape[1]
        top = np.argpartition(-s, k - 1, axis=1)[:, :k]
        pool[a : a + 512] = np.take_along_axis(top, np.argsort(-np.take_along_axis(s, top, 1), axis=1), 1)
    near = pruned(x, of, pool, DEGREE)
    far = pruned(x, of, rng.integers(0, n, (n, FAR)), DEGREE // 2)
    edges = np.concatenate([near, far], axis=1)
    src, dst = np.repeat(of, edges.shape[1]), edges.ravel()
    src, dst = src[dst >= 0], dst[dst >= 0]
    order = rng.permutation(len(dst))
    src, dst = src[order], dst[order]
    order = np.argsort(dst, kind="stable")
    src, dst = src[order], dst[order]
    nth = np.arange(len(dst)) - np.searchsorted(dst, dst)
    back = np.full((n, BACK), -1)
    back[dst[nth < BACK], nth[nth < BACK]] = src[nth < BACK]
    return np.concatenate([edges, back], axis=1)


def search(x: np.ndarray, edges: np.ndarray, queries: np.ndarray, least: float, seed: int = 9) -> tuple[np.ndarray, np.ndarray]:
    """(query number, node) pairs at or above `least`: greedy beams from medoids, then expansion within range."""
    n, rng = len(x), np.random.default_rng(seed)
    mean = x @ x.mean(axis=0)
    groups = fit_centres(x, min(MEDOIDS - 1, n), 2, int(rng.integers(1 << 30)))
    start = np.unique(np.append(np.argmax(x @ groups.T, axis=0), np.argmax(mean)))
    found_q, found_v = [], []
    for a in range(0, len(queries), 512):
        q = queries[a : a + 512]
        m, rows = len(q), np.arange(len(q))
        seen = np.zeros((m, n), bool)
        beam = np.tile(start, (m, 1))
        sim = q @ x[start].T
        seen[:, start] = True
        spent = np.zeros(beam.shape, bool)
        hits = [(*np.nonzero(sim >= least - SLACK), sim[sim >= least - SLACK])]
        hits = [(hits[0][0], start[hits[0][1]], hits[0][2])]
        while True:
            open_sim = np.where(spent, -2.0, sim)
            best = np.argmax(open_sim, axis=1)
            go = np.flatnonzero(open_sim[rows, best] > -2)
            if not len(go):
                break
            spent[go, best[go]] = True
            nxt = edges[beam[go, best[go]]]
            r, k = np.nonzero((nxt >= 0) & ~seen[go[:, None], np.maximum(nxt, 0)])
            v = nxt[r, k]
            key = np.unique(r * n + v)
            r, v = key // n, key % n
            seen[go[r], v] = True
            s = np.einsum("nd,nd->n", q[go[r]], x[v])
            ok = s >= least - SLACK
            hits.append((go[r[ok]], v[ok], s[ok]))
            at = np.arange(len(r)) - np.searchsorted(r, r)
            width = int(at.max()) + 1 if len(at) else 0
            new_v, new_s = np.zeros((m, width), np.int64), np.full((m, width), -2.0)
            new_v[go[r], at], new_s[go[r], at] = v, s
            beam, sim = np.concatenate([beam, new_v], 1), np.concatenate([sim, new_s], 1)
            spent = np.concatenate([spent, new_s == -2.0], 1)
            if beam.shape[1] > BEAM:
                top = np.argpartition(-sim, BEAM - 1, axis=1)[:, :BEAM]
                beam, sim, spent = (np.take_along_axis(z, top, 1) for z in (beam, sim, spent))
        front = [np.concatenate(z) for z in zip(*hits, strict=True)]
        while len(front[0]):
            found_q.append(front[0][front[2] >= least] + a)
            found_v.append(front[1][front[2] >= least])
            grown: list[tuple] = []
            for b in range(0, len(front[0]), 50_000):
                fq, fv = front[0][b : b + 50_000], front[1][b : b + 50_000]
                nxt = edges[fv]
                r, k = np.nonzero((nxt >= 0) & ~seen[fq[:, None], np.maximum(nxt, 0)])
                key = np.unique(fq[r] * n + nxt[r, k])
                gq, gv = key // n, key % n
                seen[gq, gv] = True
                s = np.einsum("nd,nd->n", q[gq], x[gv])
                ok = s >= least - SLACK
                grown.append((gq[ok], gv[ok], s[ok]))
            front = [np.concatenate(z) for z in zip(*grown, strict=True)]
    flat = lambda z: np.concatenate(z) if z else np.zeros(0, np.int64)
    return flat(found_q), flat(found_v)


def local_labels(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Least member of each component over n nodes."""
    label = np.arange(n)
    while True:
        low = label.copy()
        np.minimum.at(low, a, label[b])
        np.minimum.at(low, b, label[a])
        low = low[low]
        if (low == label).all():
            return label
        label = low


def _classes(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """Equal valid vectors: rep (a key of the class: its least id, or a number below all ids if several classes have that id), id (least), size, v."""
    v = F.col(f"`{vector}`")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))) & F.exists(v, lambda c: c != 0)
    rows = df.select(F.col(f"`{vec_id}`").cast("long").alias("id"), v.alias("v")).filter(F.col("id").isNotNull() & v.isNotNull() & finite)
    classes = written(rows.groupBy("v").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("size")), "vectors")
    shared = classes.groupBy("id").count().filter("count > 1")
    if shared.isEmpty():
        return classes.select("v", F.col("id").alias("rep"), "id", "size")
    # rows of one id with different vectors: such classes get keys of their own, below all ids
    least = F.least(F.min("id"), F.lit(0))
    base = classes.agg(least.alias("b")).first()["b"]
    several = written(classes.join(shared.select("id"), "id").withColumn("rep", F.lit(base) - 1 - F.monotonically_increasing_id()), "several")
    single = classes.join(shared.select("id"), "id", "left_anti").withColumn("rep", F.col("id"))
    return single.select("v", "rep", "id", "size").union(several.select("v", "rep", "id", "size"))


def _assigned(classes: DataFrame, centres: np.ndarray, overlap: int, dim: int) -> DataFrame:
    """rep, size, v (bytes of the unit vector), cs: the nearest clusters, in ascending order."""
    shared = classes.sparkSession.sparkContext.broadcast(centres)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = shared.value
        k = min(overlap, len(c))
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column(2), dim)
                near = np.sort(np.argpartition(-(x @ c.T), k - 1, axis=1)[:, :k], axis=1).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([r.tobytes() for r in x], pa.binary()), pa.array(list(near), pa.list_(pa.int32()))], names=["rep", "size", "v", "cs"])

    return classes.select("rep", "size", "v").mapInArrow(run, "rep long, size long, v binary, cs array<int>")


def _unit(t: pa.Table, name: str = "v") -> np.ndarray:
    return np.frombuffer(b"".join(t.column(name).to_pylist()), np.float64).reshape(t.num_rows, -1)


def linked(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", least: float = 0.9, overlap: int = 3) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(classes, counts, links): per class its links to other classes weighted by their sizes, and links that span components."""
    spark = df.sparkSession
    classes = _classes(df, vec_id, vector)
    stats = classes.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("d")).first()
    n, dim = stats["n"], stats["d"] or 1
    share = min(1.0, SAMPLE / max(1, n))
    sample = classes.filter(sampled(F.col("rep"), share, 0)).select("v").limit(2 * SAMPLE).toArrow()
    if not sample.num_rows:
        sample = classes.select("v").limit(1).toArrow()
    x = matrix(sample.column(0), dim) if sample.num_rows else np.ones((1, dim)) / np.sqrt(dim)
    centres = fit_centres(x, max(1, min(CENTRES, n // CLUSTER)))
    given = written(_assigned(classes, centres, overlap, dim), "assigned")
    member = given.select("rep", "size", "v", "cs", F.explode("cs").alias("c"))
    parts = {r["c"]: -(-r["count"] // SHARD) for r in member.groupBy("c").count().collect()}  # at most CENTRES rows
    split = F.create_map(*[F.lit(z) for c, k in parts.items() for z in (c, k)]) if parts else F.create_map(F.lit(0), F.lit(1))
    member = member.withColumn("k", split[F.col("c")]).withColumn("part", F.pmod(F.xxhash64("rep", "c"), F.col("k")).cast("int"))

    def make(t: pa.Table) -> pa.Table:
        edges = build(_unit(t))
        rep = t.column("rep").to_numpy()
        return pa.table({"rep": pa.array(rep), "near": pa.array([rep[e[e >= 0]] for e in edges], pa.list_(pa.int64()))})

    lists = member.select("c", "part", "rep", "v").groupBy("c", "part").applyInArrow(make, "rep long, near array<long>")
    united = lists.groupBy("rep").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
    graph = written(member.join(united, "rep"), "graph")
    # a task is a shard, or two parts of one cluster
    other = graph.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    task = other.select("c", F.least("part", "other").alias("p1"), F.greatest("part", "other").alias("p2"), "part", "rep", "size", "v", "cs", "near")

    def find(key: tuple, t: pa.Table) -> pa.Table:
        c, p1, p2 = (k.as_py() for k in key)
        x, rep, size, part = _unit(t), t.column("rep").to_numpy(), t.column("size").to_numpy(), t.column("part").to_numpy()
        cs = np.array(t.column("cs").to_pylist())
        order = np.argsort(rep)
        x, rep, size, part, cs = x[order], rep[order], size[order], part[order], cs[order]
        near = t.column("near").take(pa.array(order)).combine_chunks()
        ends = np.concatenate([[0], np.cumsum(near.value_lengths().to_numpy())])
        flat = near.flatten().to_numpy()
        at = np.minimum(np.searchsorted(rep, flat), len(rep) - 1)
        here = rep[at] == flat
        src, dst = np.repeat(np.arange(len(rep)), np.diff(ends))[here], at[here]
        nth = np.arange(len(src)) - np.searchsorted(src, src)
        edges = np.full((len(rep), int(nth.max()) + 1 if len(nth) else 1), -1)
        edges[src, nth] = dst
        q, v = search(x, edges, x, least)
        key2 = np.unique(np.concatenate([q * len(rep) + v, v * len(rep) + q]))
        q, v = key2 // len(rep), key2 % len(rep)
        keep = (q != v) & (part[q] != part[v] if p1 != p2 else True)
        q, v = q[keep], v[keep]
        if len(q):
            common = np.where((cs[q][:, :, None] == cs[v][:, None, :]).any(axis=2), cs[q], np.iinfo(np.int32).max).min(axis=1)
            mine = common == c
            n_links = np.bincount(q[mine], weights=size[v[mine]], minlength=len(rep)).astype(np.int64)
        else:
            n_links = np.zeros(len(rep), np.int64)
        label = local_labels(q, v, len(rep))
        out = np.flatnonzero((n_links > 0) | (label != np.arange(len(rep))))
        return pa.table({"rep": rep[out], "n": n_links[out], "to": rep[label[out]]})

    result = written(task.groupBy("c", "p1", "p2").applyInArrow(find, "rep long, n long, to long"), "found")
    counts = result.groupBy("rep").agg(F.sum("n").alias("n"))
    return classes, counts, result.select(F.col("rep").alias("a"), F.col("to").alias("b")).filter("a <> b")


def audit(classes: DataFrame, counts: DataFrame, least: float, dim: int, queries: int = AUDIT) -> float:
    """Links found of the links that brute force over all rows finds, for a bounded sample of classes that have some or none."""
    share = min(1.0, queries / max(1, classes.count()))
    picked = classes.filter(sampled(F.col("rep"), share, 1)).select("rep", "v").limit(queries)
    linked_too = counts.filter("n > 0").orderBy(F.xxhash64("rep")).limit(queries).join(classes, "rep").select("rep", "v")
    sample = picked.union(linked_too).distinct().toArrow()
    if not sample.num_rows:
        return 1.0
    q, ids = matrix(sample.column(1), dim), sample.column(0).to_numpy()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(ids), np.int64)
        for batch in batches:
            if batch.num_rows:
                near = (matrix(batch.column(2), dim) @ q.T >= least) & (batch.column(0).to_numpy()[:, None] != ids)
                total += (near * batch.column(1).to_numpy()[:, None]).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total)], names=["rep", "truth"])

    truth = classes.select("rep", "size", "v").mapInArrow(run, "rep long, truth long").groupBy("rep").agg(F.sum("truth").alias("truth"))
    both = truth.join(counts, "rep", "left").agg(F.sum("truth").alias("t"), F.sum(F.least(F.coalesce("n", F.lit(0)), F.col("truth"))).alias("f")).first()
    return (both["f"] or 0) / both["t"] if both["t"] else 1.0


def near_vectors(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", least: float = 0.9, overlap: int = 3) -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept, recall (as audited)."""
    while True:
        classes, counts, links = linked(df, vec_id, vector, least, overlap)
        dim = classes.agg(F.max(F.size("v")).alias("d")).first()["d"] or 1
        recall = audit(classes, counts, least, dim)
        if recall >= LEAST_RECALL or (overlap >= 16 and recall >= STATED_RECALL) or overlap >= CENTRES:
            break  # with as many clusters a vector as there are centres every pair has met
        overlap *= 2
    joined = components(links)
    of = classes.join(counts, "rep", "left").join(joined.withColumnRenamed("id", "rep"), "rep", "left")
    of = of.select("v", "id", (F.coalesce("n", F.lit(0)) + F.col("size") - 1).alias("__n"), F.coalesce("component", "rep").alias("key"))
    of = of.join(of.groupBy("key").agg(F.min("id").alias("__component")), "key").select(F.col("v").alias("__v"), "__n", "__component")
    rows = df.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").alias("__vector"))
    out = rows.join(of, (F.col("__vector") == F.col("__v")) & F.col("vec_id").isNotNull(), "left")
    component = F.coalesce("__component", "vec_id")
    return out.select("vec_id", F.coalesce("__n", F.lit(0)).alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"), F.lit(float(recall)).alias("recall"))
