"""Packing by power-of-two decomposition.

A document of n ids becomes n // longest pieces of the longest length and one piece for each binary digit of the rest, in
order. A piece is a sequence of its own; sequences of one length form a bucket, so no sequence crosses documents and none
is padded. Sequence numbers run through the buckets, longest first, without gaps. Null and empty texts have the end id
alone. Repeated rows are packed once each; a null id stays null; nothing hangs on ties; an empty table gives no pieces, and other
columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import slices, written
from .tokens import encoder


def pieces(n: int, longest: int = 1024) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids; longest is a power of two."""
    out = [(i, longest) for i in range(0, n - longest + 1, longest)]
    at, rest = len(out) * longest, n % longest
    for bit in range(longest.bit_length() - 2, -1, -1):
        if rest >> bit & 1:
            out.append((at, 1 << bit))
            at += 1 << bit
    return out


def pack_documents(df: DataFrame, tokenizer: str, end_id: int, longest: int = 1024, with_ids: bool = True, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and its ids if asked for."""
    if longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    rows = df.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    fields = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, __part int, __nth long" + ", ids binary" * with_ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, end = encoder(tokenizer), TaskContext.get().partitionId(), np.array([end_id], "<u2").tobytes()
        count: dict[int, int] = {}
        for batch in batches:
            at = 0
            for some in slices(batch.column(1)):
                cols: list[list] = [[] for _ in range(7)]
                for i, ids in enumerate(enc.encode(some.to_pylist())):
                    wide = np.frombuffer(ids + end, "<u2").astype("<u4").tobytes()
                    n = len(wide) // 4
                    for start, length in pieces(n, longest):
                        nth = count.get(length, 0)
                        count[length] = nth + 1
                        own = wide[4 * start : 4 * (start + length)]
                        for c, v in zip(cols, (at + i, start, length, zlib.crc32(own), n, nth, own if with_ids else None), strict=True):
                            c.append(v)
                own_ids = [pa.array(cols[6], pa.binary())] if with_ids else []
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(cols[0], pa.int64())), *(pa.array(c, pa.int64()) for c in cols[1:5]), pa.array([part] * len(cols[0]), pa.int32()), pa.array(cols[5], pa.int64()), *own_ids],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "__part", "__nth", *["ids"] * with_ids],
                )
                at += len(some)

    cuts = written(rows.mapInArrow(cut, fields), "pieces")
    sizes = cuts.groupBy("length", "__part").count()
    before = Window.orderBy(F.desc("length"), "__part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("length", "__part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__base"))
    return cuts.join(bases, ["length", "__part"]).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("__base") + F.col("__nth")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"), *["ids"] * with_ids
    )
