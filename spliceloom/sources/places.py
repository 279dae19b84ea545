"""Tables sorted by place: files in ranges of (chromosome, start), an index of what each holds, and a reader of regions.

Rows are dealt to files by ranges, so a file holds a stretch of the genome. The index has one row for each file and
chromosome; a region reader opens the files whose stretch meets the region and no other. Rows without a place are kept
in the files but belong to no region.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_by_place(df: DataFrame, path: str, chrom: str = "chr", start: str = "start", end: str = "end", files: int | None = None) -> None:
    """df as Parquet files (rows) with an index. files: how many at most, as many as shuffle partitions if not given."""
    spark, place = df.sparkSession, [chrom, start, end]
    dealt = df.repartitionByRange(files, *place) if files else df.repartitionByRange(*place)
    dealt.sortWithinPartitions(*place).write.parquet(f"{path}/rows")
    rows = spark.read.parquet(f"{path}/rows").withColumn("file", F.col("_metadata.file_path"))
    held = rows.filter(F.col(start).isNotNull()).groupBy("file", F.col(chrom).alias("chr"))
    held.agg(F.min(start).alias("first"), F.max(F.greatest(start, end)).alias("last"), F.count(F.lit(1)).alias("n")).coalesce(1).write.parquet(f"{path}/index")


def read_region(spark: SparkSession, path: str, chromosome: str, first: int, last: int, chrom: str = "chr", start: str = "start", end: str = "end") -> DataFrame:
    """Rows on a chromosome that share a position with [first, last]."""
    index = spark.read.parquet(f"{path}/index")
    files = [r["file"] for r in index.filter((F.col("chr") == chromosome) & (F.col("first") <= last) & (F.col("last") >= first)).select("file").collect()]  # of one region
    meets = (F.col(chrom) == chromosome) & (F.col(start) <= last) & (F.col(end) >= first)
    if not files:
        return spark.read.parquet(f"{path}/rows").filter("false")
    return spark.read.parquet(*files).filter(meets)
