"""Writers: tables with tabs, one folder per sample, annotation, sequences, filtered alignment lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_tsv(df: DataFrame, path: str, single: bool = False) -> None:
    """Tab-separated with a header; booleans as TRUE and FALSE. single: one file, for small results."""
    text = df.select(*[F.upper(F.col(c).cast("string")).alias(c) if t == "boolean" else F.col(c) for c, t in df.dtypes])
    (text.coalesce(1) if single else text).write.mode("error").csv(path, sep="\t", header=True)


def write_by_sample(df: DataFrame, path: str) -> None:
    """One folder per sample; a large sample is as many files as it needs, small ones share tasks."""
    df.hint("rebalance", "sample").write.partitionBy("sample").csv(path, sep="\t", header=True)


def write_matrix(df: DataFrame, key: str, path: str) -> None:
    """Tab-separated with the key as row names: the header names the other columns alone. Files in the order of their names
    make one table by key; null is NA."""
    rest = [c for c in df.columns if c != key]
    line = F.concat_ws("\t", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("NA")) for c in (key, *rest)])
    head = df.sparkSession.range(1).select(F.lit(0).alias("o"), F.lit("").alias("k"), F.lit("\t".join(rest)).alias("value"))
    rows = head.unionByName(df.select(F.lit(1).alias("o"), F.col(f"`{key}`").cast("string").alias("k"), line.alias("value")))
    rows.repartitionByRange("o", "k").sortWithinPartitions("o", "k").select("value").write.text(path)


def gtf_lines(df: DataFrame, rename: dict[str, str] | None = None, default: str = ".") -> DataFrame:
    """GTF lines (value): absent columns get the default, a null strand `*`, other columns become attributes, nulls left out."""
    df = df.withColumnsRenamed(rename or {})
    fixed = ["seqname", "source", "feature", "start", "end", "score", "strand", "frame"]
    col = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("*" if c == "strand" else default)) if c in df.columns else F.lit(default)
    extra: list[Column] = [F.concat(F.lit(f'{c} "'), F.col(c).cast("string"), F.lit('";')) for c in df.columns if c not in fixed]
    return df.select(F.concat_ws("\t", *[col(c) for c in fixed], F.concat_ws(" ", *extra)).alias("value"))


def write_gtf(df: DataFrame, path: str, **more) -> None:
    gtf_lines(df, **more).write.text(path)


def fasta_lines(df: DataFrame, width: int = 80) -> DataFrame:
    """FASTA text (value) of id and sequence, wrapped."""
    return df.select(_fasta("id", "sequence", width).alias("value"))


def write_fasta(df: DataFrame, path: str, width: int = 80) -> None:
    fasta_lines(df, width).write.text(path)


def write_sequences_apart(df: DataFrame, path: str) -> None:
    """One folder per sequence id."""
    df.select(F.col("id").alias("chr"), _fasta("id", "sequence", 80).alias("value")).write.partitionBy("chr").text(path)


def _fasta(name: str, sequence: str, width: int) -> Column:
    return F.concat(F.lit(">"), F.col(name), F.lit("\n"), F.regexp_replace(sequence, f"(.{{{width}}})(?=.)", "$1\n"))


def kept_lines(lines: DataFrame, ids: DataFrame) -> DataFrame:
    """Header lines and the lines of kept ids, in their old order."""
    head = lines.filter("seq_id IS NULL")
    return head.unionByName(lines.filter("seq_id IS NOT NULL").join(ids.select("seq_id"), "seq_id", "left_semi").select(*lines.columns)).orderBy("file", "line")


def concatenated_sam(lines: DataFrame) -> DataFrame:
    """Lines of several SAM files (read_sam_lines) as one: each distinct header line where it first stands, then all alignment
    lines in the order of files. Sequence lines of one name must agree in length, or this raises."""
    head = lines.filter("seq_id IS NULL").groupBy("value").agg(F.min(F.struct("file", "line")).alias("at"))
    name = F.regexp_extract("value", "\tSN:([^\t]*)", 1)
    clash = head.filter(F.col("value").startswith("@SQ")).groupBy(name.alias("name")).agg(F.countDistinct(F.regexp_extract("value", "\tLN:([0-9]+)", 1)).alias("n")).filter("n > 1").limit(1).collect()
    if clash:
        raise ValueError(f"the files differ in the length of sequence {clash[0]['name']}")
    head = head.select(F.col("at.file").alias("file"), F.col("at.line").alias("line"), F.lit(None).cast("string").alias("seq_id"), "value", F.lit(0).alias("part"))
    body = lines.filter("seq_id IS NOT NULL").select("file", "line", "seq_id", "value", F.lit(1).alias("part"))
    return head.unionByName(body).orderBy("part", "file", "line").drop("part")
