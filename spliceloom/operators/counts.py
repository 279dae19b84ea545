"""Read support: full-length counts, unique assignment, count, presence and expression matrices, range links, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .alignments import READ, unique_only

TX = ["gene_id", "transcript_id"]


def cluster_counts(report: DataFrame) -> DataFrame:
    """fl and nfl of each (sample, cluster_id); both spellings of non-full-length count."""
    kind = F.col("read_type")
    return report.groupBy("sample", "cluster_id").agg(F.count_if(kind == "FL").alias("fl"), F.count_if(kind.isin("nFL", "nonFL")).alias("nfl"))


def counts_in_id(seq_id: Column) -> tuple[Column, Column]:
    """(fl, nfl) written in a read id as f<n>p<m>; an id without them raises."""
    pattern = "f([0-9]+)p([0-9]+)"
    part = lambda k: F.when(seq_id.rlike(pattern), F.regexp_extract(seq_id, pattern, k).cast("long")).otherwise(F.raise_error(F.concat(F.lit("no read count in id "), seq_id)).cast("long"))
    return part(1), part(2)


def with_counts(links: DataFrame, report: DataFrame | None) -> DataFrame:
    """links with fl and nfl from the report, or from the ids where the report has none."""
    in_id = counts_in_id(F.col("seq_id"))
    if report is None:
        return links.withColumns({"fl": in_id[0], "nfl": in_id[1]})
    counts = cluster_counts(report).withColumnRenamed("cluster_id", "seq_id").withColumnsRenamed({"fl": "__fl", "nfl": "__nfl"})
    return links.join(counts, READ, "left").withColumns({"fl": F.coalesce("__fl", in_id[0]), "nfl": F.coalesce("__nfl", in_id[1])}).drop("__fl", "__nfl")


def support(links: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Sum of fl by transcript and sample over reads with one transcript."""
    return unique_only(links).groupBy(*(by or TX), "sample").agg(F.sum("fl").alias("count_fl"))


def matrix(rows: DataFrame, by: list[str], value: str, samples: list[str], fill=0) -> DataFrame:
    """One column per listed sample, also for those without rows."""
    agg = F.max(value) if isinstance(fill, bool) else F.sum(value)
    return rows.groupBy(*by).pivot("sample", samples).agg(agg).fillna(fill, samples)


def presence(links: DataFrame, multi_exon: DataFrame) -> DataFrame:
    """(gene, transcript, sample) with support: exact chain reads of multi-exon transcripts, unique reads of the others."""
    multi = links.join(multi_exon.select("transcript_id"), "transcript_id", "left_semi").filter("type = 'intronic_match_include'")
    mono = unique_only(links).join(multi_exon.select("transcript_id"), "transcript_id", "left_anti")
    return multi.select(*TX, "sample").unionByName(mono.select(*TX, "sample")).distinct().withColumn("present", F.lit(True))


def multi_exon_ids(exons: DataFrame) -> DataFrame:
    """Transcripts of two exons or more."""
    return exons.groupBy("transcript_id").agg(F.count(F.lit(1)).alias("__n")).filter("__n >= 2").select("transcript_id")


def range_links(links: DataFrame, variant_rows: DataFrame) -> DataFrame:
    """Links of spliced reads with the read's own place and ends (1-based closed)."""
    place = variant_rows.filter("type = '~'").select(*READ, "chr", "strand", (F.col("tx_start") + 1).alias("start"), F.col("tx_end").alias("end")).distinct()
    return links.join(place, READ)


def expression(quants: DataFrame, value: str, samples: list[str]) -> DataFrame:
    """Name by sample matrix of text values, joined by Name, never by row order."""
    return quants.groupBy("Name").pivot("sample", samples).agg(F.first(value))


def number_report(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """(name, n): distinct keys of each table."""
    out = None
    for name, (df, keys) in tables.items():
        row = df.agg(F.countDistinct(*keys).alias("n")).select(F.lit(name).alias("name"), "n")
        out = row if out is None else out.unionByName(row)
    return out
