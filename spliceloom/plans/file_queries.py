"""Registered queries that write the tables as text files of several formats and read them back, each with its SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import sam as SAM
from ..session import shared_dir, table
from ..sources import sinks, tables, text
from .catalog import query
from .views import C_SQL, T_SQL, cs_rows, exons


def _place(spark: SparkSession, kind: str) -> str:
    return f"{shared_dir(spark)}/{kind}-{uuid.uuid4().hex}"


_PAF = f"""WITH {C_SQL}, p AS (SELECT id, "start" AS s, cs FROM cs)"""


def _paf(spark, sf) -> str:
    path = _place(spark, "paf")
    n, tag = F.col("id"), F.when(F.col("id") % 9 == 0, "cs:Z:*").otherwise(F.concat(F.lit("cs:Z::"), "cs"))
    cols = [F.concat(F.lit("r"), n.cast("string")), F.lit("99"), F.lit("0"), F.lit("99"), F.when(n % 2 == 0, "+").otherwise("-"), F.concat(F.lit("c"), (n % 5).cast("string")), F.lit("9999"), F.col("start").cast("string"), (F.col("start") + 50).cast("string"), F.lit("9"), F.lit("9"), (n % 61).cast("string"), F.lit("tp:A:P"), tag]
    cs_rows(spark, sf).select(F.concat_ws("\t", *cols).alias("value")).write.text(path)
    return path


@query(_PAF + """ SELECT 'r' || CAST(id AS VARCHAR) AS seq_id, CASE WHEN id % 2 = 0 THEN '+' ELSE '-' END AS strand, 'c' || CAST(id % 5 AS VARCHAR) AS chr, CAST(s AS INT) AS "start", CAST(s + 50 AS INT) AS "end", CAST(id % 61 AS INT) AS mapq, cs FROM p WHERE id % 9 <> 0""")
def paf_rows(spark, sf) -> DataFrame:
    return text.read_paf(spark, _paf(spark, sf)).select("seq_id", "strand", "chr", "start", "end", "mapq", "cs")


@query(_PAF + " SELECT 'r' || CAST(id AS VARCHAR) AS seq_id, CAST(id % 61 AS INT) AS mapq FROM p")
def paf_quality_rows(spark, sf) -> DataFrame:
    return text.read_paf_quality(spark, _paf(spark, sf))


@query(f"""WITH {C_SQL} SELECT 'r' || CAST(id AS VARCHAR) AS seq_id, CAST([0, 16, 2048, 2064][CAST(id % 4 + 1 AS INT)] AS INT) AS flag, 'c' || CAST(id % 5 AS VARCHAR) AS chr, CAST("start" + 1 AS INT) AS "start", CASE WHEN id % 2 = 1 THEN '-' ELSE '+' END AS strand, id % 4 >= 2 AS chimera, cs FROM cs""")
def sam_rows(spark, sf) -> DataFrame:
    path, n = _place(spark, "sam"), F.col("id")
    flag = F.get(F.array(*map(F.lit, (0, 16, 2048, 2064))), (n % 4).cast("int")).cast("string")
    head = spark.range(5).select(F.concat(F.lit("@SQ\tSN:c"), F.col("id").cast("string"), F.lit("\tLN:9999")).alias("value"))
    body = cs_rows(spark, sf).select(F.concat_ws("\t", F.concat(F.lit("r"), n.cast("string")), flag, F.concat(F.lit("c"), (n % 5).cast("string")), (F.col("start") + 1).cast("string"), F.lit("60"), F.lit("*"), F.concat(F.lit("cs:Z::"), "cs")).alias("value"))
    head.unionByName(body).write.text(path)
    return text.read_sam(spark, path).select("seq_id", "flag", "chr", "start", "strand", "chimera", "cs")


@query("SELECT 'd' || CAST(doc_id AS VARCHAR) AS id, 'from ' || source AS description, regexp_replace(COALESCE(text, ''), '[^A-Za-z]', '', 'g') AS sequence FROM documents")
def fasta_rows(spark, sf) -> DataFrame:
    path = _place(spark, "fasta")
    d = table(spark, sf, "documents").select(F.concat(F.lit("d"), F.col("doc_id").cast("string"), F.lit(" from "), "source").alias("id"), F.regexp_replace(F.coalesce("text", F.lit("")), "[^A-Za-z]", "").alias("sequence"))
    sinks.write_fasta(d, path)
    return text.read_fasta(spark, path)


_GENOME = 1000


@query(f"""WITH d AS (SELECT 'd' || CAST(doc_id AS VARCHAR) AS chr, regexp_replace(COALESCE(text, ''), '[^A-Za-z]', '', 'g') AS s FROM documents),
e AS (SELECT chr, s, unnest(range(0, (length(s) + {_GENOME - 1}) // {_GENOME})) AS chunk FROM d WHERE length(s) > 0)
SELECT chr, chunk, substr(s, CAST(chunk * {_GENOME} + 1 AS INT), {_GENOME}) AS seq FROM e""")
def genome_rows(spark, sf) -> DataFrame:
    path = _place(spark, "fasta")
    d = table(spark, sf, "documents").select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"), F.regexp_replace(F.coalesce("text", F.lit("")), "[^A-Za-z]", "").alias("sequence"))
    sinks.write_fasta(d, path)
    return text.read_genome(spark, path, _GENOME)


@query("SELECT 'd' || CAST(doc_id AS VARCHAR) AS id, source AS description, regexp_replace(COALESCE(text, ''), '[^A-Za-z]', '', 'g') AS sequence, CAST(doc_id % 7 AS VARCHAR) AS quality FROM documents")
def fastq_rows(spark, sf) -> DataFrame:
    path, key = _place(spark, "fastq"), F.col("doc_id")
    table(spark, sf, "documents").select(F.concat_ws("\n", F.concat(F.lit("@d"), key.cast("string"), F.lit(" "), "source"), F.regexp_replace(F.coalesce("text", F.lit("")), "[^A-Za-z]", ""), F.lit("+"), (key % 7).cast("string")).alias("value")).write.text(path)
    return text.read_fastq(spark, path).select("id", "description", "sequence", "quality")


@query(f"""WITH {T_SQL} SELECT CAST(tx AS VARCHAR) AS transcript_id, seqname, strand, "start", "end", sample FROM ex""")
def gtf_rows(spark, sf) -> DataFrame:
    path = _place(spark, "gtf")
    sinks.write_gtf(exons(spark, sf).withColumnRenamed("tx", "transcript_id").withColumn("feature", F.lit("exon")), path)
    return text.read_gtf(spark, path, ["transcript_id", "sample"]).select("transcript_id", "seqname", "strand", "start", "end", "sample")


@query("""SELECT 'c' || CAST(p_size AS VARCHAR) AS chr, CASE p_partkey % 3 WHEN 0 THEN '+' WHEN 1 THEN '-' ELSE '*' END AS type, CAST(p_partkey - CASE WHEN p_partkey % 3 = 0 THEN 0 ELSE 1 END AS BIGINT) AS "start",
CAST(p_partkey AS BIGINT) AS "end", CASE p_partkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 'tt' ELSE 'a' END AS ref, CASE p_partkey % 3 WHEN 0 THEN 'gg' WHEN 1 THEN NULL ELSE 'c' END AS alt FROM part""")
def mutation_rows(spark, sf) -> DataFrame:
    path, n = _place(spark, "calls"), F.col("p_partkey")
    pick = lambda values: F.get(F.array(*map(F.lit, values)), (n % 3).cast("int"))
    calls = table(spark, sf, "part").select(F.concat(F.lit("c"), F.col("p_size").cast("string")).alias("Chr"), n.alias("Start"), n.alias("End"), pick(["-", "TT", "A"]).alias("Ref"), pick(["GG", "-", "C"]).alias("Alt"))
    sinks.write_tsv(calls, path)
    return tables.read_mutations(spark, path)


@query(f"""WITH {T_SQL}, l AS (SELECT tx, strand, seqname, MIN("start") AS s, string_agg(n, '' ORDER BY "start") AS cigar FROM (
  SELECT tx, strand, seqname, "start", COALESCE(CAST("start" - LAG("end") OVER w - 1 AS VARCHAR) || 'N', '') || CAST("end" - "start" + 1 AS VARCHAR) || 'M' AS n FROM ex WINDOW w AS (PARTITION BY tx ORDER BY "start")) GROUP BY 1, 2, 3)
SELECT CAST(tx AS VARCHAR) AS seq_id, CAST(CASE WHEN strand = '-' THEN 16 ELSE 0 END AS INT) AS flag, seqname AS chr, CAST(s AS INT) AS "start", cigar FROM l""")
def sam_lines(spark, sf) -> DataFrame:
    letters = spark.range(3).select(F.concat(F.lit("c"), F.col("id").cast("string")).alias("chr"), F.lit(0).cast("long").alias("chunk"), F.repeat(F.lit("ACGT"), F.lit(400)).alias("seq"))
    none = spark.createDataFrame([], "tx long, start long, end long, type string, ref string, alt string")
    body = SAM.sam_body(exons(spark, sf).withColumnRenamed("seqname", "chr"), none, letters, "tx", 1600)
    f = lambda i: F.get(F.split("value", "\t"), F.lit(i))
    return body.select(f(0).alias("seq_id"), f(1).cast("int").alias("flag"), f(2).alias("chr"), f(3).cast("int").alias("start"), f(5).alias("cigar"))


def _back(spark, df: DataFrame, kind: str, **options) -> str:
    """df as a table of text at a new place."""
    path = _place(spark, kind)
    df.write.csv(path, **({"sep": "\t", "header": True, "quote": "", "emptyValue": ""} | options))
    return path


@query("""SELECT 'c' || CAST(o_custkey % 5 AS VARCHAR) AS "Chr_1", CAST(o_orderkey AS INT) AS "Pos_1", CASE WHEN o_orderkey % 2 = 0 THEN '+' ELSE '-' END AS "Dir_1", 'c' || CAST(o_custkey % 7 AS VARCHAR) AS "Chr_2",
CAST(o_custkey AS INT) AS "Pos_2", CASE WHEN o_custkey % 2 = 0 THEN '+' ELSE '-' END AS "Dir_2", CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'ACG' END AS "Inserted_Seq", o_orderpriority AS "Variant_Type", CAST(o_orderkey % 8 AS DOUBLE) / 8 AS "Tumor_VAF" FROM orders""")
def structural_rows(spark, sf) -> DataFrame:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    sign = lambda x: F.when(x % 2 == 0, "+").otherwise("-")
    name = lambda x, n: F.concat(F.lit("c"), (x % n).cast("string"))
    calls = table(spark, sf, "orders").select(name(c, 5).alias("Chr_1"), k.alias("Pos_1"), sign(k).alias("Dir_1"), name(c, 7).alias("Chr_2"), c.alias("Pos_2"), sign(c).alias("Dir_2"), F.when(k % 3 == 0, "---").otherwise("ACG").alias("Inserted_Seq"), F.col("o_orderpriority").alias("Variant_Type"), ((k % 8).cast("double") / 8).alias("Tumor_VAF"))
    return tables.read_structural(spark, _back(spark, calls, "sv"))


@query("""SELECT 'c' || CAST(p_size AS VARCHAR) AS chr, CASE WHEN p_partkey % 2 = 0 THEN '+' ELSE '-' END AS type, CAST(p_partkey AS BIGINT) AS "start", CASE WHEN p_partkey % 2 = 0 THEN NULL ELSE 'tt' END AS ref,
CASE WHEN p_partkey % 2 = 0 THEN 'gg' END AS alt, CAST(p_partkey + CASE WHEN p_partkey % 2 = 0 THEN 0 ELSE 2 END AS BIGINT) AS "end" FROM part WHERE p_partkey % 3 <> 0""")
def indel_rows(spark, sf) -> DataFrame:
    n = F.col("p_partkey")
    calls = table(spark, sf, "part").select(F.concat(F.lit("c"), F.col("p_size").cast("string")).alias("Chr"), n.alias("Pos"), F.when(n % 2 == 0, "A").otherwise("ATT").alias("Ref"), F.when(n % 2 == 0, "AGG").otherwise("A").alias("Alt"), (n % 3 != 0).alias("Somatic"))
    return tables.indel_mutations(calls)


@query("""SELECT 'c' || CAST(p_size AS VARCHAR) AS chr, '*' AS type, CAST(p_partkey - 1 AS BIGINT) AS "start", CAST(p_partkey AS BIGINT) AS "end", lower(substr(p_name, 1, 1)) AS ref, lower(substr(p_brand, 1, 1)) AS alt FROM part""")
def point_rows(spark, sf) -> DataFrame:
    calls = table(spark, sf, "part").select(F.concat(F.lit("c"), F.col("p_size").cast("string")).alias("Chr"), F.col("p_partkey").alias("Pos"), F.substr("p_name", F.lit(1), F.lit(1)).alias("Ref"), F.substr("p_brand", F.lit(1), F.lit(1)).alias("Alt"))
    return tables.point_mutations(calls)


@query("SELECT 'PB.' || CAST(o_orderkey AS VARCHAR) AS isoform FROM orders WHERE o_orderkey % 3 <> 0")
def accepted_rows(spark, sf) -> DataFrame:
    k = F.col("o_orderkey")
    rows = table(spark, sf, "orders").select(F.concat(F.lit("PB."), k.cast("string")).alias("isoform"), F.when(k % 3 == 0, "Artifact").otherwise("Isoform").alias("SQANTI_filter"))
    return tables.accepted_isoforms(spark, _back(spark, rows, "isoforms"))


@query("""SELECT 'r' || CAST(o_orderkey AS VARCHAR) || CASE WHEN o_orderkey % 2 = 0 THEN '___' || CAST(o_custkey AS VARCHAR) ELSE '' END AS isoform, CAST(o_custkey AS VARCHAR) AS length, '3' AS exons, o_orderstatus AS structural_category, o_orderpriority AS associated_gene,
'novel' AS associated_transcript, 'x' AS subcategory, 'r' || CAST(o_orderkey AS VARCHAR) AS seq_id, CAST(CASE WHEN o_orderkey % 2 = 0 THEN o_custkey END AS INT) AS idx FROM orders""")
def class_rows(spark, sf) -> DataFrame:
    read = F.concat(F.lit("r"), F.col("o_orderkey").cast("string"))
    packed = F.when(F.col("o_orderkey") % 2 == 0, F.concat_ws("___", read, F.col("o_custkey").cast("string"))).otherwise(read)
    rows = table(spark, sf, "orders").select(packed.alias("isoform"), F.col("o_custkey").alias("length"), F.lit("3").alias("exons"), F.col("o_orderstatus").alias("structural_category"), F.col("o_orderpriority").alias("associated_gene"), F.lit("novel").alias("associated_transcript"), F.lit("x").alias("subcategory"))
    return tables.read_classes(spark, _back(spark, rows, "classes"))


@query("""SELECT 'c' || CAST(o_custkey % 5 AS VARCHAR) AS chr, CASE WHEN o_orderkey % 2 = 0 THEN '+' ELSE '-' END AS strand, CAST(o_custkey AS BIGINT) AS "start", CAST(o_custkey + o_orderkey AS BIGINT) AS "end" FROM orders""")
def junction_rows(spark, sf) -> DataFrame:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    rows = table(spark, sf, "orders").select(k.alias("isoform"), F.concat(F.lit("c"), (c % 5).cast("string")).alias("chrom"), F.when(k % 2 == 0, "+").otherwise("-").alias("strand"), c.alias("genomic_start_coord"), (c + k).alias("genomic_end_coord"))
    return tables.read_junctions(spark, _back(spark, rows, "junctions"))


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS seq_id, 'c' AS chr, CASE WHEN o_orderkey % 2 = 0 THEN '+' ELSE '-' END AS type, CAST(o_custkey AS INT) AS "start", CAST(o_custkey + 2 AS INT) AS "end", CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE 'ac' END AS ref,
CASE WHEN o_orderkey % 2 = 0 THEN 'gt' END AS alt, CAST(0 AS INT) AS tx_start, CAST(9 AS INT) AS tx_end, '+' AS tx_strand, 's' AS sample FROM orders""")
def variant_rows(spark, sf) -> DataFrame:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    rows = table(spark, sf, "orders").select(k.alias("seq_id"), F.lit("c").alias("chr"), F.when(k % 2 == 0, "+").otherwise("-").alias("type"), c.alias("start"), (c + 2).alias("end"), F.when(k % 2 != 0, "ac").alias("ref"), F.when(k % 2 == 0, "gt").alias("alt"), F.lit(0).alias("tx_start"), F.lit(9).alias("tx_end"), F.lit("+").alias("tx_strand"), F.lit("s").alias("sample"))
    return tables.read_variants(spark, _back(spark, rows, "variants"))


@query("""SELECT CAST(doc_id AS BIGINT) AS record, m AS mate, 'd' || CAST(doc_id AS VARCHAR) || '/' || CAST(m AS VARCHAR) AS id, CASE WHEN m = 1 THEN lang ELSE source END AS sequence FROM documents, (SELECT unnest([1, 2]) AS m)""")
def mate_rows(spark, sf) -> DataFrame:
    d = table(spark, sf, "documents")
    side = lambda n, c: d.select(F.col("doc_id").cast("long").alias("record"), F.concat(F.lit("d"), F.col("doc_id").cast("string"), F.lit(f"/{n}")).alias("id"), F.col(c).alias("sequence"))
    return text.interleaved(side(1, "lang"), side(2, "source")).select("record", "mate", "id", "sequence")


@query(f"WITH {C_SQL} SELECT 'r' || CAST(id AS VARCHAR) AS seq_id FROM cs WHERE id % 4 = 1 UNION ALL SELECT NULL")
def kept_sam_lines(spark, sf) -> DataFrame:
    path, n = _place(spark, "sam"), F.col("id")
    head = spark.range(1).select(F.lit("@HD\tVN:1.6").alias("value"))
    head.unionByName(cs_rows(spark, sf).select(F.concat(F.lit("r"), n.cast("string"), F.lit("\t0\tc\t1")).alias("value"))).write.text(path)
    ids = cs_rows(spark, sf).filter("id % 4 = 1").select(F.concat(F.lit("r"), n.cast("string")).alias("seq_id"))
    return sinks.kept_lines(text.read_sam_lines(spark, path), ids).select("seq_id")


@query("SELECT p_brand AS id, CAST(p_partkey AS VARCHAR) AS member FROM part")
def group_rows(spark, sf) -> DataFrame:
    path = _place(spark, "groups")
    rows = table(spark, sf, "part").groupBy("p_brand", (F.col("p_partkey") % 16).alias("k")).agg(F.array_join(F.collect_list(F.col("p_partkey").cast("string")), ",").alias("m"))
    rows.select(F.concat_ws("\t", "p_brand", "m").alias("value")).write.text(path)
    return text.collapsed_groups(spark, path)
