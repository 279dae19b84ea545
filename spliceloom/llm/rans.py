"""Token files by a static range asymmetric numeral system.

One frequency table over the whole corpus, scaled to 2**20, is shared by all blocks. A block holds whole documents with
about BLOCK ids; its ids go round-robin over up to LANES interleaved coder states, which write 32-bit words into one
stream. Every STRIDE steps the block keeps a checkpoint (step, words still to come, states), from which decoding can start,
and it holds the checksums of its stream and of its ids. Files are Parquet tables written by Spark (freqs and blocks), so
any store that Spark writes to will do. A block's number is the position of its first id, so numbers ascend from file to
file by name and are unique, however tasks were split. Documents are in ascending order of id (null first; repeated rows one by one);
null and empty texts have the end id alone; an empty table gives empty files; other
columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import partitions, slices, written
from .tokens import encoder

SCALE_BITS, LANES, BLOCK, STRIDE = 20, 4096, 1 << 20, 128
_LOW, _32, _MASK = np.uint64(1 << 31), np.uint64(32), np.uint64(0xFFFFFFFF)
BLOCKS = "block long, doc_ids array<long>, starts array<long>, n_tokens array<int>, n_ids int, stream binary, states binary, steps array<int>, to_come array<int>, checkpoints binary, stream_crc32 long, ids_crc32 long"
_BLOCK_TYPE = pa.schema([("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("starts", pa.list_(pa.int64())), ("n_tokens", pa.list_(pa.int32())), ("n_ids", pa.int32()), ("stream", pa.binary()), ("states", pa.binary()), ("steps", pa.list_(pa.int32())), ("to_come", pa.list_(pa.int32())), ("checkpoints", pa.binary()), ("stream_crc32", pa.int64()), ("ids_crc32", pa.int64())])


class Table:
    """Scaled frequencies of symbols with the lookup tables of coder and decoder."""

    def __init__(self, freq: np.ndarray):
        self.freq = freq.astype(np.uint64)
        self.cum = np.concatenate([[0], np.cumsum(freq)[:-1]]).astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(freq), dtype=np.uint16), freq)


def scaled(counts: np.ndarray, bits: int = SCALE_BITS) -> np.ndarray:
    """Frequencies that sum to 2**bits, at least 1 where the count is not 0."""
    total, used = int(counts.sum()), counts > 0
    if not total:
        return np.zeros(len(counts), np.int64)
    freq = np.where(used, 1 + counts * ((1 << bits) - int(used.sum())) // total, 0)
    freq[int(np.argmax(counts))] += (1 << bits) - int(freq.sum())
    return freq


def encode_block(ids: np.ndarray, table: Table, lanes: int = LANES, stride: int = STRIDE) -> dict:
    """Stream, states and checkpoints of one block of ids."""
    n = len(ids)
    width = max(1, min(lanes, n))
    steps = -(-n // width)
    x, words, kept, out = np.full(width, _LOW), [], [], 0
    for t in range(steps - 1, -1, -1):
        s = ids[t * width : (t + 1) * width]
        m = len(s)
        f, y = table.freq[s], x[:m]
        over = y >= f << np.uint64(43)
        if over.any():
            words.append((y[over] & _MASK).astype("<u4"))
            out += len(words[-1])
            y = np.where(over, y >> _32, y)
        q = y // f
        x[:m] = (q << np.uint64(SCALE_BITS)) + (y - q * f) + table.cum[s]
        if t and t % stride == 0:
            kept.append((t, out, x.copy()))
    stream = (np.concatenate(words[::-1]) if words else np.zeros(0, "<u4")).tobytes()
    return {
        "n_ids": n, "stream": stream, "states": x.astype("<u8").tobytes(), "steps": [k[0] for k in kept], "to_come": [k[1] for k in kept],
        "checkpoints": b"".join(k[2].astype("<u8").tobytes() for k in kept), "stream_crc32": zlib.crc32(stream), "ids_crc32": zlib.crc32(ids.astype("<u2").tobytes()),
    }


def decode_block(b: dict, table: Table, checkpoint: int = -1, stop: int | None = None) -> np.ndarray:
    """Ids of a block, from its start or from one of its checkpoints on, to its end or to step `stop`."""
    if zlib.crc32(b["stream"]) != b["stream_crc32"]:
        raise ValueError("the block's stream does not match its checksum")
    n, words = b["n_ids"], np.frombuffer(b["stream"], "<u4").astype(np.uint64)
    width = max(1, len(b["states"]) // 8)
    steps, first, at = -(-n // width) if stop is None else stop, 0, 0
    x = np.frombuffer(b["states"], "<u8").astype(np.uint64)
    if checkpoint >= 0:
        first, at = b["steps"][checkpoint], len(words) - b["to_come"][checkpoint]
        x = np.frombuffer(b["checkpoints"], "<u8")[checkpoint * width : (checkpoint + 1) * width].astype(np.uint64)
    ids = np.empty(min(n, steps * width) - first * width, np.uint16)
    low = np.uint64((1 << SCALE_BITS) - 1)
    for t in range(first, steps):
        m = min(width, n - t * width)
        slot = x[:m] & low
        s = table.symbol[slot.astype(np.int64)]
        ids[(t - first) * width : (t - first) * width + m] = s
        y = table.freq[s] * (x[:m] >> np.uint64(SCALE_BITS)) + slot - table.cum[s]
        short = np.flatnonzero(y < _LOW)
        y[short] = y[short] << _32 | words[at : at + len(short)]
        at += len(short)
        x[:m] = y
    if checkpoint < 0 and stop is None and zlib.crc32(ids.astype("<u2").tobytes()) != b["ids_crc32"]:
        raise ValueError("the block's ids do not match their checksum")
    return ids


def token_rows(df: DataFrame, tokenizer: str, end_id: int, vocabulary: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents in ranges of ascending id: part, ids before the document in its part, doc_id, n, ids (16 bits each).

    Each part ends with a row of n = -1 that has the counts of all its ids (64 bits each).
    """
    rows = df.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    ranged = rows.repartitionByRange(partitions(df.sparkSession), "doc_id").sortWithinPartitions("doc_id")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, before, end = encoder(tokenizer), TaskContext.get().partitionId(), 0, np.array([end_id], "<u2").tobytes()
        counts, names = np.zeros(vocabulary, np.int64), ["part", "before", "doc_id", "n", "ids"]
        for batch in batches:
            at = 0
            for some in slices(batch.column(1)):
                ids = [x + end for x in enc.encode(some.to_pylist())]
                n = np.fromiter((len(x) // 2 for x in ids), np.int64, len(ids))
                yield pa.RecordBatch.from_arrays([pa.array([part] * len(n), pa.int32()), pa.array(before + np.cumsum(n) - n), batch.column(0).slice(at, len(n)), pa.array(n), pa.array(ids, pa.binary())], names=names)
                counts += np.bincount(np.frombuffer(b"".join(ids), "<u2"), minlength=vocabulary)
                before += int(n.sum())
                at += len(n)
        if before:
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([before]), pa.array([None], pa.int64()), pa.array([-1]), pa.array([counts.tobytes()], pa.binary())], names=names)

    return ranged.mapInArrow(encode, "part int, before long, doc_id long, n long, ids binary")


def frequencies(tokens: DataFrame, vocabulary: int) -> np.ndarray:
    """Counts of every id over all documents, from the last rows of the parts."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(vocabulary, np.int64)
        for batch in batches:
            for x in batch.column(0):
                total += np.frombuffer(x.as_buffer(), np.int64)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["id", "n"])

    out = np.zeros(vocabulary, np.int64)
    for r in tokens.filter("n < 0").select("ids").mapInArrow(add, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():
        out[r["id"]] = r["n"]
    return out


def write_files(tokens: DataFrame, path: str, vocabulary: int, lanes: int = LANES, stride: int = STRIDE) -> None:
    """Token rows (a written table) as a file set at path: freqs and blocks."""
    spark = tokens.sparkSession
    freq = scaled(frequencies(tokens, vocabulary))
    totals = dict(sorted((r["part"], r["n"]) for r in tokens.filter("n >= 0").groupBy("part").agg(F.sum("n").alias("n")).collect()))  # one row per part
    base = dict(zip(totals, [0, *np.cumsum(list(totals.values()))[:-1].tolist()], strict=True)) if totals else {}
    spark.createDataFrame([(i, int(f)) for i, f in enumerate(freq) if f], "id int, freq long").coalesce(1).write.parquet(f"{path}/freqs")
    shared = spark.sparkContext.broadcast((freq, base))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, bases = Table(shared.value[0]), shared.value[1]

        def block(docs: list) -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(d[2] for d in docs), "<u2")
            row = {"block": docs[0][1], "doc_ids": [d[0] for d in docs], "starts": [d[1] for d in docs], "n_tokens": [len(d[2]) // 2 for d in docs]}
            return pa.RecordBatch.from_pylist([row | encode_block(ids, table, lanes, stride)], _BLOCK_TYPE)

        part, docs, size = None, [], 0
        for batch in batches:
            for p, before, doc, _, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if docs and (p != part or size >= BLOCK):
                    yield block(docs)
                    docs, size = [], 0
                part = p
                docs.append((doc, bases[p] + before, ids))
                size += len(ids) // 2
        if docs:
            yield block(docs)

    # files hold equal stretches of positions in ascending order, whatever splits the tasks before read
    total = max(1, sum(totals.values()))
    files = max(1, min(partitions(spark), -(-total // BLOCK)))
    blocks = tokens.filter("n >= 0").mapInArrow(encode, BLOCKS)
    blocks = blocks.repartitionById(files, F.floor(F.col("block") * files / total).cast("int")).sortWithinPartitions("block")
    blocks.write.option("compression", "none").parquet(f"{path}/blocks")


def _table(spark: SparkSession, path: str) -> np.ndarray:
    freqs = spark.read.parquet(f"{path}/freqs").collect()  # no longer than the vocabulary
    freq = np.zeros(1 + max((r["id"] for r in freqs), default=0), np.int64)
    for r in freqs:
        freq[r["id"]] = r["freq"]
    return freq


def _decoded(spark: SparkSession, path: str, each, fields: str) -> DataFrame:
    shared = spark.sparkContext.broadcast(_table(spark, path))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table(shared.value)
        for batch in batches:
            for i in range(batch.num_rows):
                b = batch.slice(i, 1).to_pylist()[0]
                yield each(b, np.split(decode_block(b, table), np.cumsum(b["n_tokens"])[:-1]))

    return spark.read.schema(BLOCKS).parquet(f"{path}/blocks").mapInArrow(decode, fields)


def read_stretch(spark: SparkSession, path: str, first: int, last: int) -> DataFrame:
    """start and ids of all ids at positions first to last (inclusive) of a file set, one row for each stretch between checkpoints.

    Blocks that end before or begin behind are left out; the others are decoded from their checkpoints on, each stretch
    as a row of its own that any task can work on."""
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks").filter((F.col("block") <= last) & (F.col("block") + F.col("n_ids") > first))
    pieces = blocks.select("block", "n_ids", "stream", "states", "steps", "to_come", "checkpoints", "stream_crc32", "ids_crc32", F.explode(F.sequence(F.lit(-1), F.size("steps") - 1)).alias("nth"))
    shared = spark.sparkContext.broadcast(_table(spark, path))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table(shared.value)
        for batch in batches:
            for i in range(batch.num_rows):
                b = batch.slice(i, 1).to_pylist()[0]
                n, order = b["n_ids"], sorted(range(len(b["steps"])), key=lambda k: b["steps"][k])
                width = len(b["states"]) // 8
                nth = order[b["nth"]] if b["nth"] >= 0 else -1
                lo = b["steps"][nth] * width if nth >= 0 else 0
                after = [b["steps"][k] for k in order][b["nth"] + 1 :]
                hi = min(n, after[0] * width) if after else n
                if b["block"] + hi <= first or b["block"] + lo > last:
                    continue
                ids = decode_block(b, table, nth, stop=after[0] if after else None)
                x, y = max(0, first - b["block"] - lo), min(hi - lo, last + 1 - b["block"] - lo)
                yield pa.RecordBatch.from_arrays([pa.array([b["block"] + lo + x]), pa.array([ids[x:y].astype(np.int32)], pa.list_(pa.int32()))], names=["start", "ids"])

    return pieces.mapInArrow(decode, "start long, ids array<int>")


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, ids of every document in a file set."""

    def each(b: dict, ids: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(b["doc_ids"], pa.int64()), pa.array(b["starts"], pa.int64()), pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32()))], names=["doc_id", "start", "ids"])

    return _decoded(spark, path, each, "doc_id long, start long, ids array<int>")


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and checksum of the decoded ids of every document in a file set."""

    def each(b: dict, ids: list[np.ndarray]) -> pa.RecordBatch:
        crc = [zlib.crc32(x.astype("<u4").tobytes()) for x in ids]
        return pa.RecordBatch.from_arrays([pa.array(b["doc_ids"], pa.int64()), pa.array(b["starts"], pa.int64()), pa.array(b["n_tokens"], pa.int64()), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return _decoded(spark, path, each, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(df: DataFrame, path: str, tokenizer: str, end_id: int, vocabulary: int) -> DataFrame:
    """Encodes df's texts to a file set at path and returns what its files hold, as read_digests does."""
    write_files(written(token_rows(df, tokenizer, end_id, vocabulary), "tokens"), path, vocabulary)
    return read_digests(df.sparkSession, path)
