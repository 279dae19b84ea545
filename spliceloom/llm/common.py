"""Helpers that the text operators share: tables, shared storage, batches."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """df as a Parquet table in the shared folder: cuts lineage, survives lost executors."""
    spark, path = df.sparkSession, f"{shared_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free(df: DataFrame, name: str) -> str:
    """The name, or a longer one that no column of df has; upper and lower case count as equal."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def partitions(spark: SparkSession) -> int:
    """Shuffle partitions of the session."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id falls in fold 0 of the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def sampled(key: Column, share: float, salt: int) -> Column:
    """Whether a row is among about `share` of all, by a 64-bit hash of its key; a small share is never rounded to none."""
    return F.xxhash64(key, F.lit(salt)) < F.lit(min(-(1 << 63) + int(share * 2.0**64), (1 << 63) - 1))


def slices(arr: pa.Array, most: int = 2 << 20) -> Iterator[pa.Array]:
    """Consecutive parts of a string array with about `most` bytes each, one text at least; nulls become empty."""
    arr = pc.fill_null(arr.cast(pa.large_string()), "")
    if not len(arr):
        return
    ends = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset : arr.offset + len(arr) + 1]
    at = 0
    while at < len(arr):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + most, side="right")) - 1)
        yield arr.slice(at, to - at)
        at = to


def text_bytes(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a null-free large_string array, and the bounds of its texts in them."""
    ends = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset : arr.offset + len(arr) + 1]
    data = arr.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None and ends[-1] > ends[0] else np.zeros(0, np.uint8)
    return raw, ends - ends[0]
