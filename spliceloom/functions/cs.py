"""Difference strings of spliced alignments: tokens and variants.

Tokens are `n` (match), `+bases`, `-bases`, `*rq` and `~ddNaa` (intron of N bases). Variants have 0-based half-open
reference coordinates: an insertion has start = end, a substitution is 1 wide, an intron N wide.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: the token pattern.
TOKEN = "([0-9]+|[-+*][a-z]+|~[a-z]{2}[0-9]+[a-z]{2})"


def tokens(df: DataFrame, by: list[str], cs: str = "cs") -> DataFrame:
    """One row per token: by, pos (0 and up), token. Case is folded; null or empty strings give no rows."""
    found = F.regexp_extract_all(F.lower(F.col(cs)), F.lit(TOKEN), F.lit(1))
    return df.select(*by, F.posexplode(found).alias("pos", "token"))


def width(token: Column) -> Column:
    """Reference bases that a token takes up."""
    kind = F.substr(token, F.lit(1), F.lit(1))
    size = (
        F.when(kind == "+", 0)
        .when(kind == "-", F.length(token) - 1)
        .when(kind == "*", 1)
        .when(kind == "~", F.regexp_extract(token, "([0-9]+)", 1).cast("long"))
        .otherwise(F.regexp_extract(token, "^([0-9]+)$", 1).cast("long"))
    )
    return size.cast("long")


def span(cs: Column) -> Column:
    """Reference bases that a difference string takes up; null for null."""
    found = F.regexp_extract_all(F.lower(cs), F.lit(TOKEN), F.lit(1))
    return F.aggregate(found, F.lit(0).cast("long"), lambda total, token: total + width(token))


def variants(df: DataFrame, by: list[str], cs: str = "cs", start: str = "start") -> DataFrame:
    """One row per token that is no match: by, pos, type (+ - * ~), start, end, ref, alt. `by` must tell alignments apart."""
    t = tokens(df, [*by, start], cs)
    kind = F.substr("token", F.lit(1), F.lit(1))
    rest = F.substr("token", F.lit(2))
    order = Window.partitionBy(*by, start).orderBy("pos")
    w = t.withColumn("__w", width(F.col("token")))
    w = w.withColumn("__end", F.col(start).cast("long") + F.sum("__w").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    ref = F.when(kind == "*", F.substr(rest, F.lit(1), F.lit(1))).when(kind == "-", rest)
    alt = F.when(kind == "*", F.substr(rest, F.lit(2), F.lit(1))).when(kind == "+", rest)
    real = w.filter(~F.col("token").rlike("^[0-9]"))
    return real.select(*by, "pos", kind.alias("type"), (F.col("__end") - F.col("__w")).alias("var_start"), F.col("__end").alias("var_end"), ref.alias("ref"), alt.alias("alt"))
