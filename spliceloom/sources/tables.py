"""Readers of tabular inputs, with fixed schemas, and the sample manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Columns of the input files.
MANIFEST = ["sample", "long_read_hq", "long_read_lq", "short_read_1", "short_read_2", "cluster_report", "SJ", "mutation", "sv"]
WHOLE = ["cluster_report", "SJ"]
INTRA_LINKS = "gene_id string, transcript_id string, seq_id string, type string"
INTER_LINKS = "gene_id string, transcript_id string, sample string, g_id_sample string, tx_id_sample string, seq_id string, type string, intra_type string, inter_type string"
VARIANT = "seq_id string, chr string, type string, start int, end int, ref string, alt string, tx_start int, tx_end int, tx_strand string, sample string"
FUSION = "seq_id string, query_length int, query_start int, query_end int, strand string, chr string, start int, end int, cs string"
CLUSTER = "cluster_id string, read_id string, read_type string"
STRUCTURAL = "Chr_1 string, Pos_1 int, Dir_1 string, Chr_2 string, Pos_2 int, Dir_2 string, Inserted_Seq string, Variant_Type string, Tumor_VAF double"


def read_manifest(spark: SparkSession, path, required: tuple[str, ...] = ("sample", "long_read_hq")) -> DataFrame:
    """All-text manifest with known columns (absent ones null). Raises for absent required columns, null values in them, optional
    columns that must be whole and are not, or repeated samples."""
    raw = spark.read.csv(path, header=True, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)
    absent = [c for c in required if c not in raw.columns]
    if absent:
        raise ValueError(f"the manifest lacks {', '.join(absent)}")
    out = raw.select(*[F.col(c).cast("string") if c in raw.columns else F.lit(None).cast("string").alias(c) for c in MANIFEST])
    # an optional column names files for all samples or for none, but for calls, which some samples may lack
    some = [c for c in WHOLE if c not in required]
    nulls = out.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in (*required, *some)], F.count(F.lit(1)).alias("n"), F.countDistinct("sample").alias("d")).first()
    if bad := [c for c in required if nulls[c]]:
        raise ValueError(f"the manifest has empty values in {', '.join(bad)}")
    if bad := [c for c in some if 0 < nulls[c] < nulls["n"]]:
        raise ValueError(f"the manifest names {', '.join(bad)} for some samples only")
    if nulls["n"] != nulls["d"]:
        raise ValueError("the manifest repeats a sample")
    return out


def read_samples(spark: SparkSession, manifest: DataFrame, column: str, read, schema: str | None = None) -> DataFrame | None:
    """One table of all samples: read(spark, path) of each file named in a manifest column, with its sample. The manifest is small.

    If no sample names a file the result is an empty table of the schema with a sample column, or None without a schema."""
    out = None
    for r in manifest.select("sample", column).filter(F.col(column).isNotNull()).collect():
        part = read(spark, r[column]).withColumn("sample", F.lit(r["sample"]))
        out = part if out is None else out.unionByName(part)
    if out is None and schema:
        return spark.createDataFrame([], f"{schema}, sample string")
    return out


def _tsv(spark: SparkSession, path, schema: str, **more) -> DataFrame:
    return spark.read.schema(schema).csv(path, sep="\t", header=True, nullValue=more.pop("nullValue", ""), **more)


def read_intra_links(spark: SparkSession, path) -> DataFrame:
    return _tsv(spark, path, INTRA_LINKS)


def read_inter_links(spark: SparkSession, path) -> DataFrame:
    return _tsv(spark, path, INTER_LINKS)


def read_variants(spark: SparkSession, path) -> DataFrame:
    """Variant table; empty fields are null."""
    return _tsv(spark, path, VARIANT)


def read_fusions(spark: SparkSession, path, with_sample: bool = False) -> DataFrame:
    return _tsv(spark, path, FUSION + ", sample string" * with_sample)


def read_clusters(spark: SparkSession, path) -> DataFrame:
    return spark.read.schema(CLUSTER).csv(path, header=True)


def mutations(calls: DataFrame) -> DataFrame:
    """Calls (Chr, Start, End, Ref, Alt; `-` absent) as 0-based variants: chr, type, start, end, ref, alt in lower case."""
    none = lambda c: F.lower(F.nullif(F.col(c), F.lit("-")))
    kind = F.when(F.col("Ref") == "-", "+").when(F.col("Alt") == "-", "-").otherwise("*")
    start = F.when(F.col("Ref") == "-", F.col("Start")).otherwise(F.col("Start") - 1).cast("long")
    return calls.select(F.col("Chr").alias("chr"), kind.alias("type"), start.alias("start"), F.col("End").cast("long").alias("end"), none("Ref").alias("ref"), none("Alt").alias("alt"))


def read_mutations(spark: SparkSession, path) -> DataFrame:
    return mutations(spark.read.csv(path, sep="\t", header=True, comment="#"))


def point_mutations(calls: DataFrame) -> DataFrame:
    """Point calls (Chr, Pos, Ref, Alt) as substitutions."""
    return calls.select(F.col("Chr").alias("chr"), F.lit("*").alias("type"), (F.col("Pos") - 1).cast("long").alias("start"), F.col("Pos").cast("long").alias("end"), F.lower("Ref").alias("ref"), F.lower("Alt").alias("alt"))


def indel_mutations(calls: DataFrame) -> DataFrame:
    """Somatic indels (Chr, Pos, Ref, Alt, Somatic) whose first base is an anchor. Equal lengths raise."""
    d = F.length("Alt") - F.length("Ref")
    kind = F.when(d > 0, "+").when(d < 0, "-").otherwise(F.raise_error(F.lit("an indel has equal lengths")).cast("string"))
    rest = lambda c: F.lower(F.nullif(F.substr(F.col(c), F.lit(2)), F.lit("")))
    out = calls.filter("Somatic").select(F.col("Chr").alias("chr"), kind.alias("type"), F.col("Pos").cast("long").alias("start"), rest("Ref").alias("ref"), rest("Alt").alias("alt"))
    return out.withColumn("end", F.when(F.col("type") == "+", F.col("start")).otherwise(F.col("start") + F.length("ref")))


def structural(calls: DataFrame) -> DataFrame:
    """Structural variants with `---` as an empty inserted sequence."""
    return calls.withColumn("Inserted_Seq", F.when(F.col("Inserted_Seq") == "---", "").otherwise(F.col("Inserted_Seq")))


def read_structural(spark: SparkSession, path) -> DataFrame:
    return structural(spark.read.schema(STRUCTURAL).csv(path, sep="\t", header=True, comment="#"))


def accepted_isoforms(spark: SparkSession, path) -> DataFrame:
    """isoform of rows that the external filter calls Isoform."""
    return spark.read.csv(path, sep="\t", header=True).filter("SQANTI_filter = 'Isoform'").select("isoform")


def read_junctions(spark: SparkSession, path) -> DataFrame:
    """chr, strand, start, end of introns."""
    raw = spark.read.csv(path, sep="\t", header=True)
    return raw.select(F.col("chrom").alias("chr"), "strand", F.col("genomic_start_coord").cast("long").alias("start"), F.col("genomic_end_coord").cast("long").alias("end"))


def read_classes(spark: SparkSession, path) -> DataFrame:
    """Isoform classes with the packed id taken apart: seq_id, idx and the classes."""
    raw = spark.read.csv(path, sep="\t", header=True)
    names = ["isoform", "length", "exons", "structural_category", "associated_gene", "associated_transcript", "subcategory"]
    out = raw.select(*names)
    return out.withColumns({"seq_id": F.regexp_extract("isoform", r"^(.*?)(?:___[0-9]+)?$", 1), "idx": F.regexp_extract("isoform", r"___([0-9]+)$", 1).try_cast("int")})


def read_quants(spark: SparkSession, path) -> DataFrame:
    """Quantification rows with values as text."""
    return spark.read.csv(path, sep="\t", header=True)
