"""Measured recall of near-duplicate components: a bounded sample of documents against all others, exactly.

At most `sample` documents, those with the smallest hashes of their ids, are compared with every row by full shingle sets;
their sets alone are broadcast. A pair that is similar enough counts as found when both ends have one component.
Rows without an id or without shingles are not looked at. No pair at all is a recall of 1.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices
from .minhash import shingle_sets


def component_recall(df: DataFrame, result: DataFrame, width: int = 5, percent: int = 80, sample: int = 64, doc_id: str = "doc_id", text: str = "text") -> tuple[float, int]:
    """(share of the sampled documents' true links that lie inside one component of result, number of those links).

    result: doc_id and component_id, as near_duplicates gives them for the same df, width and percent."""
    rows = df.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text")).filter("doc_id IS NOT NULL")
    picked = rows.orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text")).limit(sample).toArrow()
    ids = picked.column("doc_id").to_numpy()
    sets = [s for part in slices(picked.column("text").combine_chunks()) for s in shingle_sets(part, width)] if len(ids) else []
    every = np.unique(np.concatenate([*sets, np.zeros(0, np.uint64)]))
    # which sampled documents hold each of their shingles
    at, of = (np.concatenate([np.zeros(0, np.int64), *x]) for x in ([np.searchsorted(every, s) for s in sets], [np.full(len(s), i) for i, s in enumerate(sets)]))
    order = np.argsort(at, kind="stable")
    shared = df.sparkSession.sparkContext.broadcast((ids, np.array([len(s) for s in sets]), every, of[order], np.searchsorted(at[order], np.arange(len(every) + 1))))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, sizes, every, holders, bounds = shared.value
        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False)
            a, b, k = [], [], 0
            for part in slices(batch.column(1)):
                for s in shingle_sets(part, width):
                    if len(s) and len(every):
                        i = np.minimum(np.searchsorted(every, s), len(every) - 1)
                        i = i[every[i] == s]
                        size = bounds[i + 1] - bounds[i]
                        lists = np.repeat(bounds[i] - np.cumsum(size) + size, size) + np.arange(size.sum())
                        both = np.bincount(holders[lists], minlength=len(ids))
                        near = np.flatnonzero((both > 0) & (100 * both >= percent * (sizes + len(s) - both)) & (ids != own[k]))
                        a += ids[near].tolist()
                        b += [int(own[k])] * len(near)
                    k += 1
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    truth = rows.mapInArrow(compare, "a long, b long").distinct()
    of_id = result.select(F.col("doc_id").cast("long").alias("id"), "component_id").distinct()
    sides = truth.join(of_id.select(F.col("id").alias("a"), F.col("component_id").alias("x")), "a").join(of_id.select(F.col("id").alias("b"), F.col("component_id").alias("y")), "b")
    n, found = sides.agg(F.count(F.lit(1)), F.count_if(F.col("x") == F.col("y"))).first()
    return (found / n if n else 1.0), n
