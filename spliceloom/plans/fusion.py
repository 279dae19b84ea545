"""The fusion phase: candidate reads with several alignments to classed fusions, their junctions, exons and variants."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import alignments as A
from ..operators import fusions as FU
from ..session import settled


@dataclass
class Fusions:
    """Result tables. reads has every candidate read with its class or the reason why it has none; the others hold classed reads.

    reads: sample, seq_id, read_class, match_class, dropout, salvaged. junctions: with matched structural variants.
    exons: match_class, idx, chr, strand, start, end (1-based closed), exon_number. variants: match_class, idx and variant columns.
    """

    reads: DataFrame
    junctions: DataFrame
    exons: DataFrame
    variants: DataFrame


def find_fusions(candidates: DataFrame, genome: DataFrame, width: int, known: list[DataFrame], sv: DataFrame) -> Fusions:
    """Every step from alignments of candidate reads to the result.

    candidates: sample, seq_id, query_length, query_start, query_end, strand, chr, start, end, cs, one row an alignment;
    reads with one alignment drop out. known: tables of introns (chr, strand, start, end; 1-based closed). sv: structural
    variants. Undetermined reads keep their places and are salvaged where a structural variant explains them.
    """
    blocks = settled(FU.blocks(candidates))
    offsets = settled(FU.junction_offsets(blocks, genome, width))
    classes = settled(FU.read_classes(offsets))
    moved = settled(FU.refined(blocks, offsets))
    found = settled(A.read_variants(blocks.withColumn("aln", F.col("idx"))).withColumn("idx", F.col("aln")))
    inside, crossing = FU.bounded_variants(found, moved)
    edges = moved.select(*A.READ, "idx", F.col("start").alias("tx_start"), F.col("end").alias("tx_end"))
    inside = settled(inside.drop("tx_start", "tx_end").join(edges, [*A.READ, "idx"]))
    introns = A.introns(inside)
    improper = FU.novel_noncanonical(introns.select(*A.READ, "chr", "strand", (F.col("var_start") + 1).alias("start"), F.col("var_end").alias("end")), known, genome, width)
    junctions, pairs = FU.structural_pairs(FU.breakpoints(moved), classes, sv)
    pairs = settled(pairs)
    reads = settled(FU.judged(FU.evidence(junctions, pairs, classes, crossing, improper)))
    kept = reads.filter("match_class IS NOT NULL").select(*A.READ, "match_class")
    exons = A.exons_of(moved.withColumn("aln", F.col("idx")), introns).withColumnRenamed("aln", "idx").join(kept, A.READ)
    variants = inside.drop("aln").join(kept, A.READ)
    return Fusions(reads, FU.junctions_for_output(junctions, pairs, reads), FU.exon_numbers(exons, A.READ, ["idx"]), variants)


def write_fusions(result: Fusions, folder: str) -> None:
    """The result as four Parquet tables; those of classed reads are partitioned by match_class."""
    result.reads.write.parquet(f"{folder}/reads")
    for name in ("junctions", "exons", "variants"):
        getattr(result, name).write.partitionBy("match_class").parquet(f"{folder}/{name}")
