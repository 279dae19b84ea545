"""Reads and their alignments: quality filter, chimeras, introns and exons.

Alignment rows have sample, seq_id, strand, chr, start, end (0-based half-open), cs and aln, a number that tells alignments
of one read apart. Reads are always keyed by (sample, seq_id), since ids repeat across samples.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.cs import span, variants

READ = ["sample", "seq_id"]
ALN = [*READ, "aln"]


def passing_reads(alignments: DataFrame, threshold: int = 50, by: list[str] | None = None, mapq: str = "mapq") -> DataFrame:
    """Keys whose alignments all have a mapping quality above the threshold (not equal to it)."""
    by = by or READ
    return alignments.groupBy(*by).agg(F.min(mapq).alias("__least")).filter(F.col("__least") > threshold).select(*by)


def quality_filter(alignments: DataFrame, threshold: int = 50, by: list[str] | None = None, mapq: str = "mapq") -> DataFrame:
    """Alignments of passing reads."""
    by = by or READ
    return alignments.join(passing_reads(alignments, threshold, by, mapq), by, "left_semi")


def split_chimeras(alignments: DataFrame, by: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(reads with one alignment, reads with several)."""
    by = by or READ
    n = alignments.withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy(*by)))
    return n.filter("__n = 1").drop("__n"), n.filter("__n > 1").drop("__n")


def chimeric_ids(rows: DataFrame, by: list[str], place: list[str]) -> DataFrame:
    """Keys that lie on more than one place, such as (chr, strand)."""
    return rows.groupBy(*by).agg(F.countDistinct(*place).alias("__n")).filter("__n > 1").select(*by)


def read_variants(alignments: DataFrame) -> DataFrame:
    """Variant rows of alignments with the alignment's columns: ALN, chr, strand, tx_start, tx_end beside those of variants()."""
    keep = alignments.select(*ALN, "chr", "strand", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("tx_end"), "cs")
    found = variants(keep, ALN, "cs", "start")
    return found.join(keep.drop("cs").withColumnRenamed("start", "tx_start"), ALN)


def end_mismatches(alignments: DataFrame, by: list[str]) -> DataFrame:
    """Alignments whose difference string does not take up the bases from start to end: by, found, expected. Null strings count as none."""
    out = alignments.select(*by, F.coalesce(span(F.col("cs")), F.lit(0)).alias("found"), (F.col("end") - F.col("start")).cast("long").alias("expected"))
    return out.filter("found <> expected")


def introns(variant_rows: DataFrame) -> DataFrame:
    """Introns of alignments, without alignments in which one intron starts where another ends (an insertion between)."""
    i = variant_rows.filter("type = '~'")
    order = Window.partitionBy(*ALN).orderBy("var_start", "pos")
    i = i.withColumn("__touch", (F.lag("var_end").over(order) == F.col("var_start")).cast("int"))
    bad = i.groupBy(*ALN).agg(F.max("__touch").alias("__bad")).filter("__bad = 1").select(*ALN)
    return i.drop("__touch").join(bad, ALN, "left_anti")


def exons_of(alignments: DataFrame, intron_rows: DataFrame) -> DataFrame:
    """Exons (1-based closed) of alignments from their introns; an alignment without introns is one exon."""
    order = Window.partitionBy(*ALN).orderBy("var_start")
    ends = alignments.select(*ALN, "chr", "strand", F.col("start").cast("long").alias("tx_start"), F.col("end").cast("long").alias("tx_end"))
    i = intron_rows.select(*ALN, "chr", "strand", "tx_start", "tx_end", "var_start", "var_end")
    i = i.withColumns({"__from": F.coalesce(F.lag("var_end").over(order), F.col("tx_start")), "__last": F.lead("var_end").over(order).isNull()})
    before = i.select(*ALN, "chr", "strand", (F.col("__from") + 1).alias("start"), F.col("var_start").alias("end"))
    last = i.filter("__last").select(*ALN, "chr", "strand", (F.col("var_end") + 1).alias("start"), F.col("tx_end").alias("end"))
    whole = ends.join(intron_rows.select(*ALN).distinct(), ALN, "left_anti").select(*ALN, "chr", "strand", (F.col("tx_start") + 1).alias("start"), F.col("tx_end").alias("end"))
    return before.unionByName(last).unionByName(whole)


def introns_of_exons(exons: DataFrame, by: list[str]) -> DataFrame:
    """Gaps between consecutive exons of each key: start, end (1-based closed)."""
    order = Window.partitionBy(*by).orderBy("start", "end")
    nxt = exons.withColumn("__next", F.lead("start").over(order)).filter("__next IS NOT NULL")
    return nxt.select(*by, (F.col("end") + 1).alias("start"), (F.col("__next") - 1).alias("end"))


def spliced_reads(variant_rows: DataFrame) -> DataFrame:
    """Reads with an intron."""
    return variant_rows.filter("type = '~'").select(*READ).distinct()


def unique_only(links: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Rows whose key occurs once."""
    by = by or READ
    return links.withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy(*by))).filter("__n = 1").drop("__n")


def first_of(df: DataFrame, by: list[str], order: list) -> DataFrame:
    """The first row of each key in an explicit order."""
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter("__n = 1").drop("__n")
