"""Assembly: reads to transcripts within each sample, then across samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.chains import exon_rows, gather_exons, separate_ends, shape, structures
from ..operators.include import include_truncated, mono_in_exons
from ..operators.ranges import contained, islands, largest, numbered, terminal_exons
from ..session import settled

MATCH, MONO, INCLUDE = "intronic_match_include", "monoex_match", "include"


def transcripts_of(exons: DataFrame, by: list[str], member: list[str]) -> DataFrame:
    """One row per member: by, member (struct), chain, tx_start, tx_end, shape."""
    tx = separate_ends(gather_exons(exons, [*by, *member]).drop("exons"))
    return tx.select(*by, F.struct(*member).alias("member"), "chain", "tx_start", "tx_end", shape().alias("shape"))


def collapsed(tx: DataFrame, by: list[str]) -> DataFrame:
    """The dictionary of structures with an index: by, shape, chain, tx_start, tx_end, n, index.

    The index runs through multi-exon rows upwards from 1, ordered by place and chain, and through mono-exon rows downwards
    from -1, ordered by place and range, inside each `by` prefix before seqname.
    """
    scope = [c for c in by if c not in ("seqname", "strand")]
    rows = settled(structures(tx, by).withColumn("__multi", F.col("shape") == F.col("chain")))
    # `+` sorts before `-`; all chains begin with `-`, mono-exon rows have that alone and are told apart by their ends
    out = numbered(rows, ["seqname", "strand", "chain", "tx_start", "tx_end"], "index", [*scope, "__multi"])
    return out.withColumn("index", F.when(F.col("__multi"), F.col("index")).otherwise(-F.col("index"))).drop("__multi")


def structure_exons(rows: DataFrame, keep: list[str]) -> DataFrame:
    """Exon rows of collapsed transcripts."""
    s = F.concat(F.col("tx_start").cast("string"), F.col("chain"), F.col("tx_end").cast("string"))
    return exon_rows(rows.select(*keep, s.alias("structure")))


def with_ids(rows: DataFrame, scope: list[str], prefix: str = "PB") -> DataFrame:
    """rows with gene_id and transcript_id: loci are islands in order of place, transcripts follow the index inside a locus."""
    key = [*scope, "seqname", "strand"]
    ranged = settled(islands(rows, key, "tx_start", "tx_end"))
    genes = numbered(ranged.select(*key, "island").distinct(), ["seqname", "strand", "island"], "__gene", scope)
    out = numbered(ranged.join(genes, [*key, "island"]), ["index"], "__nth", [*scope, "__gene"])
    gene = F.concat_ws(".", F.lit(prefix), F.col("__gene").cast("string"))
    return out.withColumn("gene_id", gene).withColumn("transcript_id", F.concat_ws(".", gene, F.col("__nth").cast("string"))).drop("island", "__gene", "__nth")


def assemble(exons: DataFrame, by: list[str], member: list[str], truncation: bool) -> tuple[DataFrame, DataFrame]:
    """(transcripts, links). Transcripts: scope, gene_id, transcript_id, seqname, strand, chain, tx_start, tx_end, index. Links: scope, transcript ids, member, type.

    With truncation (within samples) chains that end a larger chain go into it and mono-exon rows into terminal exons;
    without (across samples) chains merge only when equal and mono-exon rows go into any exon. Structures are linked with
    each other first; members, one row each, meet the links of their structure at the end.
    """
    scope = [c for c in by if c not in ("seqname", "strand")]
    on = [*scope, "seqname", "strand"]
    tx = settled(transcripts_of(exons, by, member))
    rows = settled(collapsed(tx, by).withColumn("__key", F.struct(*scope, "index") if scope else F.col("index")))
    multi, mono = rows.filter("index > 0"), rows.filter("index < 0")
    cut = settled(include_truncated(multi, "__key", tuple(on))) if truncation else None
    kept_multi = multi.join(cut.select(F.col("query").alias("__key")).distinct(), "__key", "left_anti") if truncation else multi
    targets = structure_exons(kept_multi, [*on, "__key"])
    if truncation:
        targets = terminal_exons(targets, [*on, "__key"])
    in_multi = settled(mono_in_exons(mono, targets, "__key", tuple(on)))
    gone = in_multi.select(F.col("query").alias("__key")).distinct()
    free = settled(mono.join(gone, "__key", "left_anti"))
    kept_mono = free.join(largest(free, on, "tx_start", "tx_end"), [*on, "tx_start", "tx_end"], "left_semi")
    q = mono.select(*on, F.col("__key").alias("query"), F.col("tx_start").alias("i_start"), F.col("tx_end").alias("i_end"))
    s = kept_mono.select(*on, F.col("__key").alias("subject"), F.col("tx_start").alias("o_start"), F.col("tx_end").alias("o_end"))
    in_mono = contained(q, s, on).filter("query <> subject").select("query", "subject")
    named = settled(with_ids(kept_multi.unionByName(kept_mono), scope))
    own = named.select(F.col("__key").alias("query"), F.col("__key").alias("subject"), F.when(F.col("index") > 0, MATCH).otherwise(MONO).alias("type"))
    for pairs in ([cut] if truncation else []) + [in_multi, in_mono]:
        own = own.unionByName(pairs.withColumn("type", F.lit(INCLUDE)))
    named_links = own.join(named.select(F.col("__key").alias("subject"), "gene_id", "transcript_id"), "subject")
    of_shape = named_links.join(rows.select(F.col("__key").alias("query"), *by, "shape"), "query").select(*by, "shape", "gene_id", "transcript_id", "type")
    links = tx.select(*by, "shape", "member").join(of_shape, [*by, "shape"]).select(*scope, "gene_id", "transcript_id", "member", "type")
    return named.drop("__key", "shape", "n"), links


def within_samples(exons: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Transcripts and read links (sample, gene_id, transcript_id, seq_id, type) of each sample. exons: sample, seq_id, seqname, strand, start, end."""
    tx, links = assemble(exons, ["sample", "seqname", "strand"], ["seq_id"], truncation=True)
    return tx, links.select("sample", "gene_id", "transcript_id", F.col("member.seq_id").alias("seq_id"), "type")


def across_samples(exons: DataFrame, read_links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Transcripts over all samples, and read links with both levels of ids and types.

    exons: transcripts within samples (sample, gene_id, transcript_id, seqname, strand, start, end).
    """
    tx, links = assemble(exons, ["seqname", "strand"], ["sample", "gene_id", "transcript_id"], truncation=False)
    inter = links.select("gene_id", "transcript_id", F.col("member.sample").alias("sample"), F.col("member.gene_id").alias("g_id_sample"), F.col("member.transcript_id").alias("tx_id_sample"), F.col("type").alias("inter_type"))
    intra = read_links.select("sample", F.col("gene_id").alias("g_id_sample"), F.col("transcript_id").alias("tx_id_sample"), "seq_id", F.col("type").alias("intra_type"))
    both = inter.join(intra, ["sample", "g_id_sample", "tx_id_sample"], "full")
    return tx, both.withColumn("type", joined_type(F.col("intra_type"), F.col("inter_type")))


def joined_type(intra, inter):
    """The common type if both agree, else include."""
    return F.when(intra == inter, intra).otherwise(F.lit(INCLUDE))


def transcript_exons(tx: DataFrame, keep: list[str]) -> DataFrame:
    """Exon rows of assembled transcripts."""
    return structure_exons(tx, keep)
