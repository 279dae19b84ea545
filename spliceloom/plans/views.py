"""Interval and transcript views over the driver's tables, in DataFrame form and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.chains import gather_exons, separate_ends
from ..session import table


def intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as ranges: id, g, st, s, e."""
    s = F.unix_timestamp(F.col("ts").cast("timestamp"))
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.col("user_id").alias("g"), F.col("event_type").alias("st"), s.alias("s"), (s + F.floor(F.col("value") * 600)).alias("e"))


def exons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as transcripts with an exon per line number: tx, sample, seqname, strand, start, end."""
    line, order = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    n = F.col("l_linenumber").cast("long") * 100
    ex = (
        line.select("l_orderkey", "l_linenumber", "l_partkey")
        .join(order.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("l_orderkey", "o_custkey", "l_linenumber")
        .agg(F.min(F.col("l_partkey") % 2).alias("wide"), F.min(F.col("l_partkey") % 5).alias("nud"))
    )
    ex = ex.select(
        F.col("l_orderkey").alias("tx"),
        F.concat(F.lit("s"), (F.col("l_orderkey") % 4).cast("string")).alias("sample"),
        F.concat(F.lit("c"), (F.col("o_custkey") % 3).cast("string")).alias("seqname"),
        F.when(F.col("o_custkey") % 2 == 0, "+").otherwise("-").alias("strand"),
        n.alias("start"), (n + 10 + 10 * F.col("wide")).alias("end"), "nud",
    )
    w = Window.partitionBy("tx")
    start = F.col("start") + F.when(F.col("start") == F.min("start").over(w), F.col("nud")).otherwise(0)
    end = F.col("end") + F.when(F.col("start") == F.max("start").over(w), F.col("nud")).otherwise(0)
    return ex.select("tx", "sample", "seqname", "strand", start.alias("start"), end.alias("end"))


TX = ["tx", "sample", "seqname", "strand"]


def transcripts(spark: SparkSession, sf_dir: str, with_exons: bool = False) -> DataFrame:
    """tx, sample, seqname, strand, tx_start, tx_end, chain (and exons)."""
    t = separate_ends(gather_exons(exons(spark, sf_dir), TX))
    return t if with_exons else t.drop("exons")


def cs_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Difference strings made from orders: id, start, cs."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    cs = F.concat((k % 97 + 1).cast("string"), F.lit("~gt"), F.col("o_custkey").cast("string"), F.lit("ag"), F.lit(":5*ac:"), (k % 13 + 1).cast("string"), F.lit("+gg-tt:7"))
    return o.select(k.alias("id"), (k % 1000).alias("start"), cs.alias("cs"))



I_SQL = """
iv AS (
  SELECT event_id AS id, user_id AS g, event_type AS st, CAST(floor(epoch(ts)) AS BIGINT) AS s,
         CAST(floor(epoch(ts)) AS BIGINT) + CAST(floor(value * 600) AS BIGINT) AS e FROM events)"""
T_SQL = """
ex0 AS (
  SELECT l_orderkey AS tx, 's' || CAST(l_orderkey % 4 AS VARCHAR) AS sample, 'c' || CAST(o_custkey % 3 AS VARCHAR) AS seqname,
         CASE WHEN o_custkey % 2 = 0 THEN '+' ELSE '-' END AS strand, CAST(l_linenumber AS BIGINT) * 100 AS s,
         CAST(l_linenumber AS BIGINT) * 100 + 10 + 10 * MIN(l_partkey % 2) AS e, MIN(l_partkey % 5) AS nud
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY l_orderkey, o_custkey, l_linenumber),
ex AS (
  SELECT tx, sample, seqname, strand,
         CAST(s + CASE WHEN s = MIN(s) OVER (PARTITION BY tx) THEN nud ELSE 0 END AS BIGINT) AS "start",
         CAST(e + CASE WHEN s = MAX(s) OVER (PARTITION BY tx) THEN nud ELSE 0 END AS BIGINT) AS "end" FROM ex0),
st AS (
  SELECT tx, sample, seqname, strand, string_agg(CAST("start" AS VARCHAR) || '-' || CAST("end" AS VARCHAR), ' ' ORDER BY "start") AS structure,
         MIN("start") AS tx_start, MAX("end") AS tx_end, COUNT(*) AS n_exons FROM ex GROUP BY ALL),
t AS (
  SELECT tx, sample, seqname, strand, tx_start, tx_end, n_exons, structure,
         regexp_replace(regexp_replace(structure, '^[0-9]+', ''), '[0-9]+$', '') AS chain FROM st)"""
C_SQL = """
cs AS (
  SELECT o_orderkey AS id, o_orderkey % 1000 AS "start",
         CAST(o_orderkey % 97 + 1 AS VARCHAR) || '~gt' || CAST(o_custkey AS VARCHAR) || 'ag:5*ac:' || CAST(o_orderkey % 13 + 1 AS VARCHAR) || '+gg-tt:7' AS cs FROM orders)"""
TOK_SQL = C_SQL + """,
tok0 AS (SELECT id, "start", regexp_extract_all(cs, '([0-9]+|[-+*][a-z]+|~[a-z]{2}[0-9]+[a-z]{2})', 1) AS ts FROM cs),
tok AS (SELECT id, "start", unnest(range(len(ts))) AS pos, unnest(ts) AS token FROM tok0)"""
COLLAPSED_SQL = T_SQL + """,
multi AS (
  SELECT seqname, strand, chain, MIN(tx_start) AS tx_start, MAX(tx_end) AS tx_end, COUNT(*) AS n, MIN(tx) AS k,
         CAST(CASE WHEN strand = '-' THEN regexp_extract(chain, '^-([0-9]+) ', 1) ELSE regexp_extract(chain, ' ([0-9]+)-$', 1) END AS BIGINT) AS last
  FROM t WHERE chain <> '-' GROUP BY seqname, strand, chain),
mono AS (SELECT seqname, strand, tx_start, tx_end, COUNT(*) AS n, MIN(tx) AS k FROM t WHERE chain = '-' GROUP BY seqname, strand, tx_start, tx_end)"""
