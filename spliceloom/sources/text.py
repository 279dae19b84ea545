"""Readers of line-based alignment, annotation and sequence files.

Every reader takes one path or many and keeps lines apart by their file; `sample` columns come from the manifest. Empty
files give typed empty tables. Files are split wherever Spark splits them: lines are numbered by their block of a file and
the blocks' line counts, and nothing needs a whole file or sequence in one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F


#: Lines that are looked at before a file is read.
SNIFF = 20


def _lines(spark: SparkSession, path) -> DataFrame:
    return spark.read.text(path).filter(F.length("value") > 0)


def _field(i: int) -> Column:
    return F.get(F.split("value", "\t"), F.lit(i))


def read_paf(spark: SparkSession, path, strict: bool = False, observation: Observation | None = None) -> DataFrame:
    """Alignments: seq_id, query_length, query_start, query_end, strand, chr, start, end, mapq, cs.

    The cs tag may stand anywhere. Rows whose cs does not begin with a digit drop out, or raise if strict; an observation
    counts them as `dropped`, of `rows`, in the pass that reads them. Files whose first 20 lines all lack the tag raise.
    """
    head = _lines(spark, path).limit(SNIFF).select(F.contains("value", F.lit("cs:Z:")).alias("tag")).collect()
    if len(head) == SNIFF and not any(r.tag for r in head):
        raise ValueError(f"no cs tag in the first {SNIFF} lines of {path}")
    names = {"seq_id": (0, "string"), "query_length": (1, "int"), "query_start": (2, "int"), "query_end": (3, "int"), "strand": (4, "string"), "chr": (5, "string"), "start": (7, "int"), "end": (8, "int"), "mapq": (11, "int")}
    rows = _lines(spark, path).filter(F.size(F.split("value", "\t")) >= 10).withColumn("__tag", F.try_element_at(F.filter(F.split("value", "\t"), lambda x: x.startswith("cs:Z:")), F.lit(1)))
    cs = F.regexp_replace("__tag", "^cs:Z::?", "")
    out = rows.select(*[_field(i).cast(kind).alias(name) for name, (i, kind) in names.items()], cs.alias("cs"))
    good = F.coalesce(F.col("cs").rlike("^[0-9]"), F.lit(False))
    if observation is not None:
        out = out.observe(observation, F.count_if(~good).alias("dropped"), F.count(F.lit(1)).alias("rows"))
    if strict:
        return out.withColumn("cs", F.when(good, F.col("cs")).otherwise(F.raise_error(F.concat(F.lit("no usable cs tag: "), "seq_id")).cast("string")))
    return out.filter(good)


def read_paf_quality(spark: SparkSession, path) -> DataFrame:
    """seq_id and mapq."""
    return _lines(spark, path).select(_field(0).alias("seq_id"), _field(11).cast("int").alias("mapq"))


def read_paf_ids(spark: SparkSession, path) -> DataFrame:
    """seq_id."""
    return _lines(spark, path).select(_field(0).alias("seq_id"))


def _blocks(spark: SparkSession, path) -> DataFrame:
    """Lines with file, block (where their part of the file begins) and at, which ascends inside a block."""
    return spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))


def _before(rows: DataFrame, name: str) -> Column:
    """Sum of `name` over the blocks of a file before each."""
    return F.coalesce(F.sum(name).over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def _numbered(spark: SparkSession, path) -> DataFrame:
    """Lines of files with their number (line, 0 and up) in each file: blocks are counted, their counts give the offsets."""
    rows = _blocks(spark, path)
    sizes = rows.groupBy("file", "block").agg(F.count(F.lit(1)).alias("__n"), F.min("at").alias("__first"))
    offsets = sizes.select("file", "block", "__first", _before(sizes, "__n").alias("__offset"))
    return rows.join(offsets, ["file", "block"]).select("value", "file", (F.col("__offset") + F.col("at") - F.col("__first")).alias("line"))


def read_sam_lines(spark: SparkSession, path) -> DataFrame:
    """file, line (in order), seq_id (null for header lines), value."""
    return _numbered(spark, path).filter(F.length("value") > 0).select("file", "line", F.when(~F.col("value").startswith("@"), F.substring_index("value", "\t", 1)).alias("seq_id"), "value")


def read_sam(spark: SparkSession, path) -> DataFrame:
    """seq_id, flag, chr, start (1-based), cs, strand, chimera of alignment lines."""
    rows = read_sam_lines(spark, path).filter("seq_id IS NOT NULL")
    tag = F.try_element_at(F.filter(F.split("value", "\t"), lambda x: x.startswith("cs:Z:")), F.lit(1))
    out = rows.select("seq_id", _field(1).cast("int").alias("flag"), _field(2).alias("chr"), _field(3).cast("int").alias("start"), F.regexp_replace(tag, "^cs:Z::?", "").alias("cs"))
    bit = lambda n: F.col("flag").bitwiseAND(F.lit(n)) != 0
    return out.withColumns({"strand": F.when(bit(16), "-").otherwise("+"), "chimera": bit(2048)})


def attributes(c: Column) -> Column:
    """GTF attributes as a map; values of a repeated key are joined with `; `."""
    found = F.regexp_extract_all(c, F.lit(r'([A-Za-z0-9_.]+) +"?([^";]*)"?'), F.lit(0))
    pairs = F.transform(found, lambda x: F.struct(F.regexp_extract(x, r"^([A-Za-z0-9_.]+)", 1).alias("k"), F.regexp_extract(x, r'^[A-Za-z0-9_.]+ +"?([^";]*)"?$', 1).alias("v")))
    keys = F.array_distinct(F.transform(pairs, lambda p: p["k"]))
    return F.map_from_arrays(keys, F.transform(keys, lambda k: F.array_join(F.transform(F.filter(pairs, lambda p: p["k"] == k), lambda p: p["v"]), "; ")))


def read_gtf(spark: SparkSession, path, columns: list[str] | None = None) -> DataFrame:
    """Nine columns with attributes as a map, and the attributes named in `columns` as columns too."""
    rows = _lines(spark, path).filter(~F.col("value").startswith("#"))
    names = ["seqname", "source", "feature", "start", "end", "score", "strand", "frame"]
    out = rows.select(*[_field(i).alias(n) for i, n in enumerate(names)], attributes(_field(8)).alias("attributes"))
    out = out.withColumns({"start": F.col("start").cast("long"), "end": F.col("end").cast("long")})
    return out.withColumns({c: F.col("attributes")[c] for c in columns or []})


def _fasta_lines(spark: SparkSession, path) -> tuple[DataFrame, DataFrame]:
    """(headers: file, record, id, description; sequence lines: file, record, offset in the record, bases).

    Inside a block running sums tell the record of a line and how many bases of it came before; what earlier blocks hold
    of a record that goes on is carried from block to block, one row each."""
    rows = _blocks(spark, path)
    head = F.col("value").startswith(">")
    rows = rows.withColumns({"__head": head.cast("long"), "__bases": F.when(head, F.lit("")).otherwise(F.regexp_replace("value", r"\s", ""))}).withColumn("__len", F.length("__bases").cast("long"))
    inside = Window.partitionBy("file", "block").orderBy("at")
    rows = rows.withColumns({"__nth": F.sum("__head").over(inside), "__seen": F.sum("__len").over(inside) - F.col("__len")})
    rows = rows.withColumn("__from", F.max(F.when(head, F.col("__seen"))).over(inside))
    sums = rows.groupBy("file", "block").agg(F.sum("__head").alias("__heads"), F.sum("__len").alias("__total"), F.max("__from").alias("__last"))
    order = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumns({"__records": _before(sums, "__heads"), "__bases_before": _before(sums, "__total")})
    sums = sums.withColumn("__carry", F.col("__bases_before") - F.coalesce(F.max(F.col("__bases_before") + F.col("__last")).over(order), F.lit(0)))
    rows = rows.join(sums.select("file", "block", "__records", "__carry"), ["file", "block"]).withColumn("record", F.col("__records") + F.col("__nth"))
    title = F.regexp_replace("value", "[\r\n]", "")
    names = rows.filter(head).select("file", "record", F.regexp_extract(title, r"^>(\S*)", 1).alias("id"), F.regexp_extract(title, r"^>\S*\s+(.*)$", 1).alias("description"))
    offset = F.when(F.col("__nth") > 0, F.col("__seen") - F.col("__from")).otherwise(F.col("__seen") + F.col("__carry"))
    return names, rows.filter("__len > 0 AND record > 0").select("file", "record", offset.alias("offset"), F.col("__bases").alias("bases"))


def _joined(pieces: DataFrame, by: list[str], name: str) -> DataFrame:
    """Pieces (offset, bases) of each key put together in order."""
    return pieces.groupBy(*by).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("offset", "bases"))), lambda x: x["bases"]), "").alias(name))


def read_fasta(spark: SparkSession, path) -> DataFrame:
    """id (to the first white space), description, sequence, one row a record; sequences may span lines and may be empty.

    For records that fit a row; genomes go through read_genome."""
    names, lines = _fasta_lines(spark, path)
    whole = names.join(_joined(lines, ["file", "record"], "sequence"), ["file", "record"], "left")
    return whole.select("id", "description", F.coalesce("sequence", F.lit("")).alias("sequence"))


def read_fasta_index(spark: SparkSession, path) -> DataFrame:
    """id, length, file and record (the place in the file) of every record."""
    names, lines = _fasta_lines(spark, path)
    sizes = lines.groupBy("file", "record").agg(F.sum(F.length("bases").cast("long")).alias("length"))
    return names.join(sizes, ["file", "record"], "left").select("id", F.coalesce("length", F.lit(0)).alias("length"), "file", "record")


def read_genome(spark: SparkSession, path, width: int = 1_000_000) -> DataFrame:
    """FASTA records as (chr, chunk, seq) of `width` bases each, cut while they are read: no row holds more than a chunk or a line."""
    names, lines = _fasta_lines(spark, path)
    first, last = F.floor(F.col("offset") / width), F.floor((F.col("offset") + F.length("bases") - 1) / width)
    cut = lines.withColumn("chunk", F.explode(F.sequence(first, last)))
    lo = F.greatest(F.col("chunk") * width - F.col("offset"), F.lit(0))
    hi = F.least((F.col("chunk") + 1) * width - F.col("offset"), F.length("bases"))
    parts = cut.select("file", "record", "chunk", (F.col("offset") + lo).alias("offset"), F.substr("bases", (lo + 1).cast("int"), (hi - lo).cast("int")).alias("bases"))
    chunks = _joined(parts, ["file", "record", "chunk"], "seq")
    return chunks.join(names, ["file", "record"]).select(F.col("id").alias("chr"), "chunk", "seq")


def read_fastq(spark: SparkSession, path) -> DataFrame:
    """file, record, id, description, sequence, quality of four-line records; .gz goes by suffix."""
    rows = _numbered(spark, path).withColumn("__k", F.col("line") % 4)
    at = lambda k: F.max(F.when(F.col("__k") == k, F.col("value")))
    out = rows.groupBy("file", F.floor(F.col("line") / 4).alias("record")).agg(at(0).alias("__h"), at(1).alias("sequence"), at(3).alias("quality")).filter(F.col("__h").startswith("@"))
    return out.select("file", "record", F.regexp_extract("__h", r"^@(\S*)", 1).alias("id"), F.regexp_extract("__h", r"^@\S*\s+(.*)$", 1).alias("description"), "sequence", "quality")


def interleaved(first: DataFrame, second: DataFrame) -> DataFrame:
    """Mates of two read tables (record, id, sequence) in turn: record, mate, id, sequence."""
    return first.withColumn("mate", F.lit(1)).unionByName(second.withColumn("mate", F.lit(2)), allowMissingColumns=True).orderBy("record", "mate")


def genome_chunks(fasta: DataFrame, width: int = 1_000_000) -> DataFrame:
    """Sequences as (chr, chunk, seq) of `width` bases each."""
    n = F.floor((F.length("sequence") - 1) / width)
    cut = fasta.filter(F.length("sequence") > 0).select(F.col("id").alias("chr"), "sequence", F.explode(F.sequence(F.lit(0).cast("long"), n)).alias("chunk"))
    return cut.select("chr", "chunk", F.substr("sequence", (F.col("chunk") * width + 1).cast("int"), F.lit(width)).alias("seq"))


def collapsed_groups(spark: SparkSession, path) -> DataFrame:
    """id and member of lines `id <tab> member,member`."""
    return _lines(spark, path).select(_field(0).alias("id"), F.explode(F.split(_field(1), ",")).alias("member"))
