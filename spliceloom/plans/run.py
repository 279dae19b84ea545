"""The whole run from a manifest: alignments in, transcripts, links, counts, presence, explained variants, fusions and reports out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import alignments as A
from ..operators import counts as C
from ..operators import fusions as FU
from ..operators import mutations as M
from ..session import settled
from ..sources.sinks import write_by_sample, write_gtf, write_tsv
from ..sources.places import write_by_place
from ..sources.tables import CLUSTER, STRUCTURAL, read_clusters, read_manifest, read_mutations, read_samples, read_structural
from ..sources.text import read_paf
from . import assembly as AS
from .fusion import Fusions, find_fusions, write_fusions


@dataclass
class Assembly:
    """Tables of a run."""

    samples: list[str]
    reads: DataFrame
    chimeras: DataFrame
    variants: DataFrame
    sample_links: DataFrame
    transcripts: DataFrame
    exons: DataFrame
    links: DataFrame
    counts: DataFrame
    presence: DataFrame
    ranges: DataFrame


def assemble(spark: SparkSession, manifest_path: str, alignments: str = "long_read_hq", threshold: int = 50, accepted: DataFrame | None = None) -> Assembly:
    """The phases up to counts. alignments: the manifest column with PAF paths. accepted: transcript ids to keep (column isoform)."""
    manifest = read_manifest(spark, manifest_path, ("sample", alignments))
    samples = sorted(r["sample"] for r in manifest.select("sample").collect())
    paf = A.quality_filter(read_samples(spark, manifest, alignments, read_paf), threshold)
    paf = settled(paf.withColumn("aln", F.row_number().over(Window.partitionBy(*A.READ).orderBy("query_start", "chr", "start"))))
    single, several = A.split_chimeras(paf)
    variants = settled(A.read_variants(single))
    exons = A.exons_of(single, A.introns(variants)).withColumnRenamed("chr", "seqname")
    tx, sample_links = AS.within_samples(exons)
    sample_links = settled(sample_links)
    inner = AS.transcript_exons(tx, ["sample", "gene_id", "transcript_id", "seqname", "strand"])
    transcripts, links = AS.across_samples(inner, sample_links)
    if accepted is not None:
        keep = accepted.select(F.col("isoform").alias("transcript_id"))
        transcripts, links = transcripts.join(keep, "transcript_id", "left_semi"), links.join(keep, "transcript_id", "left_semi")
    transcripts, links = settled(transcripts), settled(links)
    merged = AS.transcript_exons(transcripts, [*C.TX, "seqname", "strand"])
    clusters = read_samples(spark, manifest, "cluster_report", read_clusters, CLUSTER)
    all_tx = transcripts.select(*C.TX)
    counts = C.matrix(C.support(C.with_counts(links, clusters)).join(all_tx, C.TX, "right"), C.TX, "count_fl", samples)
    there = C.presence(links, C.multi_exon_ids(merged)).join(all_tx, C.TX, "right")
    return Assembly(samples, paf, several, variants, sample_links, transcripts, merged, links, counts, C.matrix(there, C.TX, "present", samples, fill=False), C.range_links(links, variants))


@dataclass
class Outcome:
    """What a whole run gives; phases whose manifest column is empty are None."""

    assembly: Assembly
    explained: DataFrame | None
    fusions: Fusions | None
    summary: DataFrame | None
    placed: DataFrame


def run(spark: SparkSession, manifest_path: str, genome: DataFrame, width: int, annotation: DataFrame | None = None, junctions: DataFrame | None = None, gene_names: DataFrame | None = None, accepted: DataFrame | None = None, alignments: str = "long_read_hq", low: str = "long_read_lq", threshold: int = 50) -> Outcome:
    """Every phase. genome: chr, chunk, seq of `width` bases. annotation: exons (transcript_id, chr, strand, start, end) of known
    transcripts; junctions: known introns; gene_names: sample, seq_id, idx, name of fusion blocks, as external tools give them.

    Variants of spliced reads that stayed are explained by the calls in `mutation`; reads with several alignments become
    fusions where the manifest names `sv`. Alignments of low quality take part in the table by place alone."""
    a = assemble(spark, manifest_path, alignments, threshold, accepted)
    manifest = read_manifest(spark, manifest_path, ("sample", alignments))
    named = {c for c, n in manifest.agg(*[F.count(c).alias(c) for c in ("mutation", "sv", low)]).first().asDict().items() if n}
    explained = found = summary = None
    if "mutation" in named:
        calls = read_samples(spark, manifest, "mutation", read_mutations)
        kept = a.variants.join(a.links.select(*A.READ).distinct(), A.READ, "left_semi").join(A.spliced_reads(a.variants), A.READ, "left_semi")
        variants = kept.withColumnsRenamed({"var_start": "start", "var_end": "end"})
        explained = settled(M.explain_variants(variants, calls, genome, width, [*A.ALN, "chr"]))
    if "sv" in named:
        known = [A.introns_of_exons(annotation, ["transcript_id", "chr", "strand"])] if annotation is not None else []
        known += [junctions] if junctions is not None else []
        found = find_fusions(a.chimeras, genome, width, known, read_samples(spark, manifest, "sv", read_structural, STRUCTURAL))
        clusters = read_samples(spark, manifest, "cluster_report", read_clusters, CLUSTER)
        blocks = found.exons.select(*A.READ, "idx").distinct()
        names = gene_names if gene_names is not None else blocks.select(*A.READ, "idx", F.lit(None).cast("string").alias("name"))
        summary = FU.fusion_summary(blocks, names, C.with_counts(blocks.select(*A.READ).distinct(), clusters))
    placed = a.reads
    if low in named:
        more = A.quality_filter(read_samples(spark, manifest, low, read_paf), threshold)
        placed = placed.unionByName(more, allowMissingColumns=True)
    return Outcome(a, explained, found, summary, placed)


def write_run(outcome: Outcome, folder: str) -> None:
    """All results of a run: those of the assembly, variants, fusions with their summary, and alignments by place.

    session.release removes the tables that a run leaves in the shared folder; the outcome cannot be used after it."""
    write(outcome.assembly, folder)
    if outcome.explained is not None:
        write_tsv(outcome.explained, f"{folder}/explained_variants")
    if outcome.fusions is not None:
        write_fusions(outcome.fusions, f"{folder}/fusions")
        write_tsv(outcome.summary, f"{folder}/fusion_summary")
        write_gtf(FU.fusion_annotation(outcome.fusions.exons, outcome.summary), f"{folder}/fusions.gtf")
    write_by_place(outcome.placed, f"{folder}/alignments")


def write(a: Assembly, folder: str) -> None:
    """Result files of a run, as tab-separated tables and GTF."""
    write_gtf(a.exons.withColumn("feature", F.lit("exon")), f"{folder}/transcripts.gtf")
    for name, df in {"links": a.links, "counts": a.counts, "presence": a.presence, "ranges": a.ranges, "variants": a.variants, "fusion_candidates": a.chimeras}.items():
        write_tsv(df, f"{folder}/{name}")
    write_by_sample(a.sample_links, f"{folder}/sample_links")


def number_report(a: Assembly) -> DataFrame:
    """Distinct reads and transcripts by phase."""
    return C.number_report({"aligned_reads": (a.reads, A.READ), "sample_transcripts": (a.sample_links, ["sample", "transcript_id"]), "transcripts": (a.transcripts, ["transcript_id"]), "linked_reads": (a.links, A.READ)})
