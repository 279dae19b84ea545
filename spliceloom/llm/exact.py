"""Exact duplicates by a tree merge of sorted digest runs.

Each input partition makes a run: one entry for each digest, found by a sorted aggregation. In every round runs are
merged 2**bits at a time (run number shifted right), so that after a few rounds one run is left, spread over tasks by
its digests; an entry holds the group's size and its best row. Entries merge only when the SHA-256, the byte length
and a second 64-bit hash agree, so a collision of one hash never joins two texts. Aggregation before each exchange
keeps a hot group at one entry per task. Null texts count as empty; null ids sort last; repeated rows count each; ties in length
go to the smallest id; texts are worked on whole at any length; an empty table gives no rows, and other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free, written

_NO_ID = (1 << 63) - 1
_KEY = ["__digest", "__bytes", "__check"]


def normalised(text: Column) -> Column:
    """The text without the characters U+0020 and U+0009 to U+000D."""
    return F.translate(F.coalesce(text, F.lit("")), "\x20\x09\x0a\x0b\x0c\x0d", "")


def merge_rounds(runs: DataFrame, n_runs: int, bits: int = 4) -> DataFrame:
    """Runs (run, key, __best, __size) merged round by round into one."""
    left = n_runs
    while left > 1:
        left = (left + (1 << bits) - 1) >> bits
        runs = runs.groupBy(F.shiftright("__run", bits).alias("__run"), *_KEY).agg(F.min("__best").alias("__best"), F.sum("__size").alias("__size"))
    return runs


def digests(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key of the normalised text, its rank among equal texts (longest, then smallest id) and its run."""
    norm = normalised(F.col(f"`{text}`"))
    return df.select(
        F.col(f"`{doc_id}`").alias("__id"),
        F.sha2(norm.cast("binary"), 256).alias("__hex"),
        F.octet_length(norm).alias("__bytes"),
        F.xxhash64(norm).alias("__check"),
        (-F.length(F.coalesce(F.col(f"`{text}`"), F.lit("")))).alias("__neg"),
        F.spark_partition_id().alias("__run"),
    ).withColumn("__digest", F.unhex("__hex"))


def exact_groups(df: DataFrame, doc_id: str = "doc_id", text: str = "text", bits: int = 4) -> DataFrame:
    """Per row: doc_id, keep_id (its group's row that stays), group_size, kept, text_sha256.

    Rows of one id (repeated rows) share keep_id; kept is true for each row whose id and length are the group's best.
    """
    rows = written(digests(df, doc_id, text).drop("__hex"), "digests")
    best = F.struct("__neg", F.coalesce(F.col("__id").cast("long"), F.lit(_NO_ID)).alias("__id"))
    runs = rows.groupBy("__run", *_KEY).agg(F.min(best).alias("__best"), F.count(F.lit(1)).alias("__size"))
    n_runs = rows.agg(F.max("__run")).first()[0]
    groups = merge_rounds(runs, 1 + (n_runs or 0), bits).select(*_KEY, "__best", "__size")
    keep = F.when(F.col("__best.__id") != _NO_ID, F.col("__best.__id"))
    return rows.join(groups, _KEY).select(
        F.col("__id").alias(doc_id), keep.alias("keep_id"), F.col("__size").alias("group_size"),
        (F.col("__id").eqNullSafe(keep) & (F.col("__neg") == F.col("__best.__neg"))).alias("kept"),
        F.lower(F.hex("__digest")).alias("text_sha256"),
    )


def drop_exact_copies(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """df without later copies, all columns, whatever their names. Rows that repeat an id and a text become one; rows without an id stay."""
    gone, sha = free(df, "__gone"), free(df, "__sha")
    groups = exact_groups(df, doc_id, text).select(F.col(f"`{doc_id}`").alias(gone), F.col("kept").alias("__best"), F.col("text_sha256").alias(sha))
    groups = written(groups, "groups").filter(F.col(gone).isNotNull())
    by_id = groups.groupBy(gone).agg(F.count(F.lit(1)).alias("__rows"), F.max("__best").alias("__kept"))
    same = F.col(f"`{doc_id}`") == F.col(gone)
    once = df.join(by_id.filter("NOT __kept OR __rows > 1").select(gone), same, "left_anti")
    repeated = by_id.filter("__rows > 1").select(gone)
    if repeated.isEmpty():
        return once
    own = F.sha2(normalised(F.col(f"`{text}`")).cast("binary"), 256)
    rows = df.join(repeated, same, "left_semi").join(groups.filter("__best").select(gone, sha).distinct(), same & (own == F.col(sha)), "left_semi")
    best = rows.groupBy(F.col(f"`{doc_id}`").alias("__i"), own.alias("__s")).agg(F.max_by(F.struct(*(F.col(f"`{c}`") for c in df.columns)), F.coalesce(F.length(f"`{text}`"), F.lit(0))).alias("__row"))
    return once.unionByName(best.select("__row.*"))


SQL = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS h FROM documents),
g AS (
  SELECT doc_id, h, count(*) OVER (PARTITION BY h) AS group_size,
         first_value(doc_id) OVER (PARTITION BY h ORDER BY length(t) DESC, doc_id) AS keep_id FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, h AS text_sha256 FROM g
"""
