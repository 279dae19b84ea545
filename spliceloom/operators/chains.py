"""Exon structures: gathering, stripping, splitting, counting and collapsing.

A structure is `start-end start-end ...` with exons in ascending order; a chain is a structure without its outer ends.
Positions are integers throughout. Null positions drop out of a structure.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONO = "-"


def gather_exons(exons: DataFrame, by: list[str]) -> DataFrame:
    """One row for each `by` key: its sorted exons as structs and as a structure string."""
    g = exons.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end")))).alias("exons"))
    return g.withColumn("structure", structure(F.col("exons")))


def structure(exons: Column) -> Column:
    """Structure string of sorted exon structs."""
    return F.concat_ws(" ", F.transform(exons, lambda x: F.concat_ws("-", x["start"].cast("string"), x["end"].cast("string"))))


def remove_ends(s: Column) -> Column:
    """Chain of a structure."""
    return F.regexp_replace(F.regexp_replace(s, "^[0-9]+", ""), "[0-9]+$", "")


def separate_ends(df: DataFrame, column: str = "structure") -> DataFrame:
    """df with chain, tx_start and tx_end instead of the structure."""
    s = F.col(column)
    return df.withColumns({"tx_start": F.regexp_extract(s, "^([0-9]+)", 1).cast("long"), "tx_end": F.regexp_extract(s, "([0-9]+)$", 1).cast("long"), "chain": remove_ends(s)}).drop(column)


def exon_rows(df: DataFrame, column: str = "structure") -> DataFrame:
    """One row per exon of a structure, with start and end."""
    e = df.withColumn("__exon", F.explode(F.split(column, " "))).drop(column)
    return e.withColumns({"start": F.split_part("__exon", F.lit("-"), F.lit(1)).cast("long"), "end": F.split_part("__exon", F.lit("-"), F.lit(2)).cast("long")}).drop("__exon")


def count_exons(exons: DataFrame, by: list[str]) -> DataFrame:
    """Number of exons of each key."""
    return exons.groupBy(*by).agg(F.count(F.lit(1)).alias("n_exons"))


def is_multi(chain: str = "chain") -> Column:
    """Whether a chain has a splice site."""
    return F.col(chain) != MONO


def shape() -> Column:
    """What transcripts of one structure have in common: the chain, or both ends of a mono-exon one."""
    return F.when(is_multi(), F.col("chain")).otherwise(F.concat_ws("-", F.col("tx_start").cast("string"), F.col("tx_end").cast("string")))


def structures(tx: DataFrame, by: list[str]) -> DataFrame:
    """The dictionary of structures: by, shape, chain, tx_start, tx_end (widest ends), n (transcripts). Which transcripts
    have a structure is told by their own by and shape, so no row grows with the number of members."""
    return tx.groupBy(*by, shape().alias("shape"), "chain").agg(F.min("tx_start").alias("tx_start"), F.max("tx_end").alias("tx_end"), F.count(F.lit(1)).alias("n"))


def chain_sizes(tx: DataFrame, member: str, by: list[str]) -> DataFrame:
    """Multi-exon transcripts of equal chain in one row: widest ends, the number n of members and the least, k."""
    return tx.filter(is_multi()).groupBy(*by, "chain").agg(F.min("tx_start").alias("tx_start"), F.max("tx_end").alias("tx_end"), F.count(member).alias("n"), F.min(member).alias("k"))


def mono_sizes(tx: DataFrame, member: str, by: list[str]) -> DataFrame:
    """Mono-exon transcripts of equal ends in one row: the number n of members and the least, k."""
    return tx.filter(~is_multi()).groupBy(*by, "tx_start", "tx_end").agg(F.count(member).alias("n"), F.min(member).alias("k"))


def equal_to_all(df: DataFrame, values: dict[str, object]) -> DataFrame:
    """Rows whose columns equal all the given values."""
    for name, value in values.items():
        df = df.filter(F.col(name) == F.lit(value))
    return df


def introns_in(chain: str) -> Column:
    """Introns of the chains in a column, such as `-110 200-210 300-`."""
    return F.split(F.expr(f"substr({chain}, 2, length({chain}) - 2)"), "-")
