"""Cross-tokenizer alignment: groups of byte-level and merge-type tokens that cover the same bytes.

Each text with a space in front is encoded by two public tokenizers, A (byte-level) and B (SentencePiece, which adds the
space itself); strings of special tokens are plain text. The ends of tokens in bytes go into one dictionary for each side,
end to index; the keys that both dictionaries hold, sorted, cut both id lists into groups, and the tokens of a group are
linked, each A with each B. Texts that are null, empty, or that either side's tokens do not spell byte by byte (B reads
U+2581 as a space) have no tokens.

Corpus counts are documents that hold an id pair linked. Each batch counts its pairs before they are shuffled. To give
counts back to documents, pairs that at least 1/FREQUENT of all (document, pair) rows have, at most FREQUENT of them
whatever the corpus, are broadcast; the others meet their counts by a join on the pair, in which no key is hot.

Each row is a document of its own, repeated ids too; null ids stay null; an empty table gives no rows; other columns are
not looked at. Memory grows with the longest text.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, written
from .pieces import SPACE, Decoder
from .tokens import Encoder

#: Bound of the pairs that are broadcast.
FREQUENT = 1 << 18
#: Chunks that a worker keeps in each of two generations, and parts of new chunks.
MOST, FEW = 200_000, 50_000
#: Pair keys are A id << WIDTH | B id.
WIDTH = 16
_BODY = "row long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>"


_CHUNK_END = re.compile(r"(?<=\S)(?=[ \n])")
#: Texts with characters that a side reads in its own way are aligned as one chunk.
_WHOLE = re.compile("[\x1c-\x1f\ufff9]")
# Bytes that byte-level vocabularies show as themselves; the others, in order, are U+0100 and up.
SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]


def byte_alphabet() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies."""
    hidden = iter(range(256, 512))
    return [chr(b if b in SHOWN else next(hidden)) for b in range(256)]


class Aligner:
    """Two tokenizers and the bytes of their tokens; chunks of text that were aligned before are looked up.

    A chunk ends where a space or line feed follows a visible character: there both sides end a token, and what
    stands before and after has no influence on a chunk's tokens, so groups of a text are those of its chunks in order.
    """

    def __init__(self, a_path: str, b_path: str):
        self.a, decoder = Encoder(a_path, plain=True), Decoder(b_path)
        if decoder.size > 1 << WIDTH:
            raise ValueError("ids of more than 16 bits are not supported")
        byte = {c: b for b, c in enumerate(byte_alphabet())}
        vocab = self.a.tokenizer.get_vocab(with_added_tokens=True)
        spelled = {i: bytes(byte[c] for c in t) if all(c in byte for c in t) else t.encode() for t, i in vocab.items()}
        self.a_bytes = [spelled.get(i, b"") for i in range(1 + max(spelled, default=0))]
        self.b_model, self.b_bytes = decoder.model, decoder.bytes
        self.a_width, self.b_width = (np.array([len(x) for x in some]) for some in (self.a_bytes, self.b_bytes))
        self.known: dict[str, tuple | None] = {}
        self.old = self.known

    def cuts(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ends that both sides have, sorted, and the number of A and of B tokens up to each."""
        at_a, at_b = (dict(zip(np.cumsum(width[ids]).tolist(), range(1, len(ids) + 1), strict=True)) for ids, width in ((a, self.a_width), (b, self.b_width)))
        both = sorted(at_a.keys() & at_b.keys())
        return np.array(both, np.int64), *(np.fromiter(map(at.__getitem__, both), np.int64, len(both)) for at in (at_a, at_b))

    def aligned(self, chunks: list[str], ids_a: list[bytes], ids_b: list[list[int]]) -> list[tuple[str, bytes, int, int] | None]:
        """For each chunk groups as text, keys of all links, and how many tokens each side has; None if a side spells another text."""
        if not chunks:
            return []
        raw = [c.encode() for c in chunks]
        a, b = np.frombuffer(b"".join(ids_a), "<u2").astype(np.int64), np.array(list(chain.from_iterable(ids_b)), np.int64)
        whole, ends, at = b"".join(raw), np.cumsum([len(x) for x in raw]), None
        if all(b"".join(map(some.__getitem__, ids.tolist())) == whole for some, ids in ((self.a_bytes, a), (self.b_bytes, b))):
            both, to_a, to_b = self.cuts(a, b)
            at = np.searchsorted(both, ends)
            at = at + 1 if (both[np.minimum(at, len(both) - 1)] == ends).all() else None
        if at is None:
            return [None] if len(chunks) == 1 else [self.aligned([c], [x], [y])[0] for c, x, y in zip(chunks, ids_a, ids_b, strict=True)]
        from_a, from_b = (np.concatenate([[0], x[:-1]]) for x in (to_a, to_b))
        size = (to_a - from_a) * (to_b - from_b)
        upto = np.concatenate([[0], np.cumsum(size)])
        keys = np.empty(upto[-1], "<u4")
        keys[upto[:-1]] = a[from_a] << WIDTH | b[from_b]
        said = [f"{x}|{y}" for x, y in zip(a[from_a].tolist(), b[from_b].tolist(), strict=True)]
        many = np.flatnonzero(size > 1)
        for g, o, i, x, j, y in zip(*(v.tolist() for v in (many, upto[many], from_a[many], to_a[many], from_b[many], to_b[many])), strict=True):
            some_a, some_b = a[i:x], b[j:y]
            keys[o : o + (x - i) * (y - j)] = (some_a[:, None] << WIDTH | some_b).ravel()
            said[g] = ",".join(map(str, some_a.tolist())) + "|" + ",".join(map(str, some_b.tolist()))
        keys, upto, at = keys.tobytes(), upto.tolist(), [0, *at.tolist()]
        return [(";".join(said[g:h]), keys[4 * upto[g] : 4 * upto[h]], len(x) // 2, len(y)) for g, h, x, y in zip(at[:-1], at[1:], ids_a, ids_b, strict=True)]

    def learn(self, chunks: list[str]) -> None:
        """Aligns chunks that are not known yet. B puts a space in front: it is the chunk's own, or a token of its own that goes."""
        new, space = [], [self.b_model.piece_to_id(SPACE)]
        for c in chunks:
            if c in self.old:
                self.known[c] = self.old[c]
            else:
                new.append(c)
        for lo in range(0, len(new), 10_000):
            some = new[lo : lo + 10_000]
            ids_b = self.b_model.encode([c[1:] if c[0] == " " else c for c in some], num_threads=1)
            ids_b = [space if c == " " else x if c[0] == " " else x[1:] for c, x in zip(some, ids_b, strict=True)]
            self.known.update(zip(some, self.aligned(some, self.a.encode(some), ids_b), strict=True))
        if len(self.a) > FEW:
            self.a.clear()
            self.a.old = {}

    def whole(self, text: str) -> tuple[str, bytes, int, int] | None:
        """A text aligned as one chunk."""
        return self.aligned([" " + text], self.a.encode([" " + text]), [self.b_model.encode(text)])[0]

    def align(self, texts: list[str]) -> Iterator[tuple[str, np.ndarray, int, int]]:
        """For each text its groups as text, keys of its links, and how many tokens each side has."""
        if len(self.known) > MOST:
            self.old, self.known = self.known, {}
        cut = [[] if not t or SPACE in t else [t] if _WHOLE.search(t) else _CHUNK_END.split(" " + t) for t in texts]
        self.learn(list({c for t, chunks in zip(texts, cut, strict=True) if chunks and chunks[0] is not t for c in chunks if c not in self.known}))
        for t, chunks in zip(texts, cut, strict=True):
            items = [self.whole(t)] if chunks and chunks[0] is t else list(map(self.known.__getitem__, chunks))
            if not items or None in items:
                yield "", np.zeros(0, np.uint32), 0, 0
            else:
                said, keys, n_a, n_b = zip(*items, strict=True)
                yield ";".join(said), np.frombuffer(b"".join(keys), "<u4"), sum(n_a), sum(n_b)


@functools.cache
def aligner(a_path: str, b_path: str) -> Aligner:
    """This worker's aligner of two tokenizer files."""
    return Aligner(a_path, b_path)


def align_documents(df: DataFrame, a_path: str, b_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, row (a number of its own), n_a, n_b, n_groups, n_links, groups_sha256, pairs and times."""
    rows = df.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, nth = aligner(a_path, b_path), TaskContext.get().partitionId() << 33
        for batch in batches:
            at = 0
            for some in slices(batch.column(1)):
                cols: list[list] = [[] for _ in range(8)]
                for k, (groups, keys, n_a, n_b) in enumerate(own.align(some.to_pylist())):
                    pairs, times = np.unique(keys, return_counts=True)
                    digest = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
                    for c, v in zip(cols, (nth + k, n_a, n_b, groups.count("|"), len(keys), digest, pairs.astype(np.int64), times.astype(np.int32)), strict=True):
                        c.append(v)
                nth += len(some)
                numbers = [pa.array(c, pa.int64()) for c in cols[:5]]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(some)), *numbers, pa.array(cols[5], pa.string()), pa.array(cols[6], pa.list_(pa.int64())), pa.array(cols[7], pa.list_(pa.int32()))],
                    names=["doc_id", *(c.split()[0] for c in _BODY.split(", "))],
                )
                at += len(some)

    return rows.mapInArrow(work, f"doc_id {dict(rows.dtypes)['doc_id']}, {_BODY}")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """Per linked pair: pair, n (documents that hold it) and best, whether no pair of the same A id has more."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            keys, which = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
            return keys, np.bincount(which, np.concatenate([n for _, n in held]), len(keys)).astype(np.int64)

        def out(keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], names=["pair", "n"])

        for batch in batches:
            values = batch.column(0).flatten().to_numpy(zero_copy_only=False)
            if len(values):
                held.append(np.unique(values, return_counts=True))
            if len(held) > 15:
                held = [merged()]
                if len(held[0][0]) > 1 << 20:
                    yield out(*held[0])
                    held = []
        if held:
            yield out(*merged())

    counts = aligned.select("pairs").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = written(counts, "pairs")
    a = F.shiftright("pair", WIDTH)
    top = counts.groupBy(a.alias("a")).agg(F.max("n").alias("most"))  # no more rows than A has ids
    return counts.join(F.broadcast(top), a == F.col("a")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def with_counts(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """Per document row: row, n_best and count_sum, over its links."""
    spark = aligned.sparkSession
    total = counts.agg(F.sum("n")).first()[0] or 0
    often = F.col("n") * FREQUENT >= total
    some = counts.filter(often).orderBy("pair").toPandas()
    known = spark.sparkContext.broadcast((some["pair"].to_numpy(np.int64), some["n"].to_numpy(np.int64), some["best"].to_numpy(bool)))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n, best = known.value
        for batch in batches:
            size = np.diff(batch.column(1).offsets.to_numpy())
            row = np.repeat(batch.column(0).to_numpy(), size)
            pair, times = (batch.column(c).flatten().to_numpy() for c in (1, 2))
            at = np.minimum(np.searchsorted(keys, pair), max(len(keys) - 1, 0))
            hit = keys[at] == pair if len(keys) else np.zeros(len(pair), bool)
            at, left = at[hit], ~hit
            rows, inverse = np.unique(row[hit], return_inverse=True)
            sums = [np.bincount(inverse, w, len(rows)).astype(np.int64) for w in (times[hit] * best[at], times[hit] * n[at])]
            rest = int(left.sum())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([rows, row[left]])), *(pa.array(np.concatenate([s, np.zeros(rest, np.int64)])) for s in sums), pa.array(np.concatenate([np.full(len(rows), -1), pair[left]])), pa.array(np.concatenate([np.zeros(len(rows), np.int64), times[left]]))],
                names=["row", "n_best", "count_sum", "pair", "times"],
            )

    seen = aligned.select("row", "pairs", "times").mapInArrow(look, "row long, n_best long, count_sum long, pair long, times long")
    seen = written(seen, "seen")
    rare = counts.filter(~often).select("pair", "n", "best")
    met = seen.filter("pair >= 0").join(rare, "pair").select("row", (F.col("times") * F.col("best").cast("long")).alias("n_best"), (F.col("times") * F.col("n")).alias("count_sum"))
    return seen.filter("pair < 0").select("row", "n_best", "count_sum").unionByName(met).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def alignment_digest(df: DataFrame, a_path: str, b_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 (empty without tokens)."""
    aligned = written(align_documents(df, a_path, b_path, doc_id, text), "aligned")
    sums = with_counts(aligned, pair_counts(aligned))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    return aligned.drop("pairs", "times").join(sums, "row", "left").select("doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256")
