"""SAM text of transcripts: CIGAR and sequence from exons, variants and the genome."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranges import numbered
from .sequences import subsequences


def _ops(state: Column, at: Column, more: list[tuple[Column, str]], bases: Column, used: Column, last: Column) -> Column:
    """The next state: position, operations with those of `more` that are not empty, bases, last used variant, end of the last exon."""
    new = F.filter(F.array(*[F.struct(n.cast("long").alias("n"), F.lit(op).alias("op")) for n, op in more]), lambda x: x["n"] > 0)
    return F.struct(at.cast("long").alias("at"), F.concat(state["ops"], new).alias("ops"), F.concat(state["seq"], bases).alias("seq"), used.cast("int").alias("used"), last.cast("long").alias("last"))


def _with_variant(state: Column, v: Column, exon: Column) -> Column:
    """State after a variant, or as it was if the variant does not lie on what is left of the exon."""
    gap, kind, alt = v["start"] - state["at"], v["type"], F.upper(F.coalesce(v["alt"], F.lit("")))
    fits = (v["nth"] > state["used"]) & (v["start"] >= state["at"]) & (v["start"] <= exon["end"]) & ((kind == "+") | (v["end"] <= exon["end"]))
    before = F.substr(exon["seq"], (state["at"] - exon["start"] + 2).cast("int"), gap.cast("int"))
    width = v["end"] - v["start"]
    more = [(gap, "M"), (F.when(kind == "+", F.length(alt)).otherwise(0), "I"), (F.when(kind == "-", width).otherwise(0), "D"), (F.when(kind == "*", 1).otherwise(0), "M")]
    placed = _ops(state, F.when(kind == "+", v["start"]).otherwise(v["end"]), more, F.concat(before, F.when(kind == "-", "").otherwise(alt)), v["nth"], state["last"])
    return F.when(fits, placed).otherwise(state)


def cigar_and_sequence(exons: Column, variants: Column) -> tuple[Column, Column]:
    """CIGAR and bases of a transcript, as expressions over its arrays.

    exons: array of (start, end, seq), 1-based closed, ascending. variants: array of (start, end, type, alt), 0-based half-open,
    in any order. Matches and substitutions are M, gaps between exons N, deletions D, insertions I. An insertion at an exon's edge
    belongs to the exon that it follows. Variants off the exons, over an edge, or inside an earlier one are left out.
    """
    order = F.transform(F.filter(variants, lambda v: v["type"].isin("+", "-", "*")), lambda v: F.struct(v["start"].alias("start"), F.when(v["type"] == "+", 0).otherwise(1).alias("o"), v["end"].alias("end"), v["type"].alias("type"), v["alt"].alias("alt")))
    todo = F.transform(F.array_sort(order), lambda v, i: F.struct(v["start"].alias("start"), v["end"].alias("end"), v["type"].alias("type"), v["alt"].alias("alt"), (i + 1).alias("nth")))
    none = F.expr("cast(array() as array<struct<n:bigint,op:string>>)")
    start = F.struct(F.lit(0).cast("long").alias("at"), none.alias("ops"), F.lit("").alias("seq"), F.lit(0).alias("used"), F.lit(None).cast("long").alias("last"))

    def exon(state: Column, x: Column) -> Column:
        begun = _ops(state, x["start"] - 1, [(F.coalesce(x["start"] - state["last"] - 1, F.lit(0)), "N")], F.lit(""), state["used"], state["last"])
        return F.aggregate(todo, begun, lambda t, v: _with_variant(t, v, x), lambda t: _ops(t, x["end"], [(x["end"] - t["at"], "M")], F.substr(x["seq"], (t["at"] - x["start"] + 2).cast("int")), t["used"], x["end"]))

    whole = F.aggregate(exons, start, exon)
    runs = F.aggregate(
        whole["ops"],
        F.struct(F.lit("").alias("text"), F.lit(0).cast("long").alias("n"), F.lit("").alias("op")),
        lambda s, x: F.when(s["op"] == x["op"], F.struct(s["text"].alias("text"), (s["n"] + x["n"]).alias("n"), s["op"].alias("op"))).otherwise(F.struct(_said(s).alias("text"), x["n"].alias("n"), x["op"].alias("op"))),
        _said,
    )
    return runs, whole["seq"]


def _said(s: Column) -> Column:
    return F.when(s["n"] > 0, F.concat(s["text"], s["n"].cast("string"), s["op"])).otherwise(s["text"])


def sam_body(exons: DataFrame, variants: DataFrame, genome: DataFrame, by: str, width: int) -> DataFrame:
    """One line (value) per key: flag 16 on -, mapping quality 255. exons: by, chr, strand, start, end. variants: by, start, end, type, alt."""
    parts = subsequences(exons.select(by, "chr", "strand", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end")), genome, width)
    rows = parts.groupBy(by, "chr", "strand").agg(F.array_sort(F.collect_list(F.struct("start", "end", F.coalesce("seq", F.lit("")).alias("seq")))).alias("e"))
    v = variants.groupBy(by).agg(F.collect_list(F.struct(F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), "type", "alt")).alias("v"))
    none = F.expr("cast(array() as array<struct<start:bigint,end:bigint,type:string,alt:string>>)")
    full = rows.join(v, by, "left").withColumn("v", F.coalesce("v", none))
    cigar, bases = cigar_and_sequence(F.col("e"), F.col("v"))
    flag = F.when(F.col("strand") == "-", "16").otherwise("0")
    first = F.get("e", F.lit(0))["start"].cast("string")
    return full.select(F.concat_ws("\t", F.col(by).cast("string"), flag, "chr", first, F.lit("255"), cigar, F.lit("*"), F.lit("0"), F.lit("0"), bases, F.lit("*")).alias("value"))


def sam_header(fasta: DataFrame, order: list[str] | None = None, program: str = "spliceloom") -> DataFrame:
    """@SQ line per sequence (id, and length or sequence), then a @PG line, as o, n and value: sort by o and n.

    order: columns that tell the order of sequences, such as file and record of read_fasta_index; without it they go by id."""
    length = F.col("length") if "length" in fasta.columns else F.length("sequence")
    rank = F.struct(*[F.col(c) for c in order or ["id"]])
    sq = fasta.select(rank.alias("n"), F.concat(F.lit("@SQ\tSN:"), "id", F.lit("\tLN:"), length.cast("string")).alias("value"))
    sq = numbered(sq, ["n"], "nth").select(F.lit(1).alias("o"), F.col("nth").alias("n"), "value")
    pg = fasta.sparkSession.range(1).select(F.lit(2).alias("o"), F.lit(0).cast("long").alias("n"), F.lit(f"@PG\tID:{program}\tPN:{program}").alias("value"))
    return sq.unionByName(pg)


def write_sam(body: DataFrame, fasta: DataFrame, path: str, order: list[str] | None = None) -> None:
    """Header and lines (value) as text files that make one SAM file in the order of their names: lines go by the place of
    their sequence in the header, then by position; those of unknown sequences come last."""
    head = sam_header(fasta, order)
    named = F.split_part(F.col("value"), F.lit("\t"), F.lit(2))
    ranks = head.filter("o = 1").select(F.substr(named, F.lit(4)).alias("chr"), F.col("n").alias("rank"))
    field = lambda i: F.split_part(F.col("value"), F.lit("\t"), F.lit(i))
    lines = body.select("value", field(3).alias("chr"), field(4).cast("long").alias("at"), field(1).alias("id")).join(ranks, "chr", "left")
    lines = lines.select(F.lit(3).alias("o"), F.coalesce("rank", F.lit((1 << 62))).alias("n"), "at", "id", "value")
    every = head.select("o", "n", F.lit(0).cast("long").alias("at"), F.lit("").alias("id"), "value").unionByName(lines)
    by = ["o", "n", "at", "id", "value"]
    every.repartitionByRange(*by).sortWithinPartitions(*by).select("value").write.text(path)


def known_chromosomes(rows: DataFrame, fasta: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows on sequences that exist, names of those that do not)."""
    names = fasta.select(F.col("id").alias("chr"))
    return rows.join(names, "chr", "left_semi"), rows.select("chr").distinct().join(names, "chr", "left_anti")
