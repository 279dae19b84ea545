"""Plans of queries whose groups may be large."""

import re

import pytest
from pyspark.sql import functions as F

from spliceloom.operators import chains as CH
from spliceloom.operators import include as I
from spliceloom.operators import mutations as M
from spliceloom.operators import ranges as R
from spliceloom.operators import txjoin as TJ
from spliceloom.plans import assembly as AS
from spliceloom.plans import catalog

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["chain_collapse", "mono_collapse"])
def test_no_row_holds_a_whole_group(spark, name):
    plan = catalog.QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "members" not in plan


def test_structures_count_their_transcripts(spark):
    rows = [("a", "-5 9-", 1, 12), ("b", "-5 9-", 2, 14), ("c", "-6 9-", 1, 12), ("d", "-", 3, 8), ("e", "-", 3, 8), ("f", "-", 3, 9)]
    tx = spark.createDataFrame(rows, "tx string, chain string, tx_start long, tx_end long").withColumn("seqname", F.lit("c"))
    got = sorted((r.shape, r.tx_start, r.tx_end, r.n) for r in CH.structures(tx, ["seqname"]).collect())
    assert got == [("-5 9-", 1, 14, 2), ("-6 9-", 1, 12, 1), ("3-8", 3, 8, 2), ("3-9", 3, 9, 1)]
    assert sorted((r.chain, r.tx_start, r.tx_end, r.n, r.k) for r in CH.chain_sizes(tx, "tx", ["seqname"]).collect()) == [("-5 9-", 1, 14, 2, "a"), ("-6 9-", 1, 12, 1, "c")]
    assert sorted((r.tx_start, r.tx_end, r.n, r.k) for r in CH.mono_sizes(tx, "tx", ["seqname"]).collect()) == [(3, 8, 2, "d"), (3, 9, 1, "f")]


def test_one_structure_of_all_reads(spark):
    exons = spark.range(20_000).select(F.lit("s").alias("sample"), F.col("id").cast("string").alias("seq_id"), F.lit("c").alias("seqname"), F.lit("+").alias("strand"), F.explode(F.array(F.lit(0).cast("long"), F.lit(100).cast("long"))).alias("start"))
    exons = exons.withColumn("end", F.col("start") + 50)
    tx, links = AS.within_samples(exons)
    assert [(r.gene_id, r.transcript_id, r.chain) for r in tx.collect()] == [("PB.1", "PB.1.1", "-50 100-")] and "members" not in tx.columns
    assert links.count() == links.select("seq_id").distinct().count() == 20_000


def test_many_ranges_of_one_place(spark):
    n = 100_000
    mono = spark.range(n).select(F.lit("c").alias("seqname"), F.lit("+").alias("strand"), F.col("id").alias("k"), (5000 + F.col("id") % 1000).alias("tx_start"), (6500 - F.col("id") % 500 - F.col("id") % 7).alias("tx_end"))
    rows = mono.groupBy("seqname", "strand", "tx_start", "tx_end").agg(F.min("k").alias("k"))
    pairs = I.mono_in_mono(rows, "k")
    ranges = {(r.tx_start, r.tx_end): r.k for r in rows.collect()}
    top, reach = {}, -1
    for s, e in sorted(ranges, key=lambda r: (r[0], -r[1])):
        if e > reach:
            top[(s, e)], reach = ranges[(s, e)], e
    want = {(k, t) for (s, e), k in ranges.items() for (a, b), t in top.items() if a <= s and e <= b and k != t}
    assert {tuple(r) for r in pairs.collect()} == want and len(want) >= len(ranges) - len(top)


def test_no_range_is_cut_into_many_bins(spark):
    long = spark.createDataFrame([(1, "a", 0, 2_000_000_000)], "y int, k string, o_start long, o_end long")
    points = spark.createDataFrame([(1, "a", 5, 6), (2, "a", 1_999_999_999, 2_000_000_001)], "x int, k string, i_start long, i_end long")
    got = R.contained(points, long, ["k"])
    assert [(r.x, r.y) for r in got.collect()] == [(1, 1)] and "sequence(" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_chunks_made_on_the_way_are_not_broadcast(spark, monkeypatch):
    """A genome of few bytes on disk that is long once it is made: its estimate is that of the rows it comes from."""
    genome = spark.range(8).select(F.concat(F.lit("p"), F.col("id").cast("string")).alias("chr"), F.repeat(F.lit("ac"), 320).alias("seq"))
    chunks = genome.select("chr", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(9).cast("long"))).alias("chunk"), F.substr("seq", F.lit(1), F.lit(64)).alias("seq"))
    indels = spark.range(8).select(F.concat(F.lit("p"), F.col("id").cast("string")).alias("chr"), F.lit("-").alias("type"), F.lit(2).cast("long").alias("start"), F.lit(4).cast("long").alias("end"), F.lit("ac").alias("ref"), F.lit(None).cast("string").alias("alt"))
    plans, settled = [], M.settled
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(M, "settled", lambda df: plans.append(plan(df)) or settled(df))
    out = M.repeat_shift(indels, chunks, 64)
    assert [r.repeat_start for r in out.collect()] == [0] * 8
    joins = [line for p in [*plans, plan(out)] for line in p.split("\n") if "Join [chr#" in line and (re.search(r"Join \[chr#\d+\],", line) or any(k in line for k in ("chunk#", "__at#", "__bin#")))]
    assert all(any(k in j for j in joins) for k in ("chunk#", "__at#", "__bin#")) and all("SortMergeJoin" in j for j in joins), joins


def _alike(spark, n):
    """n transcripts of one spliced structure and n of one mono-exon structure, on both sides."""
    spliced = (F.lit("-20 30-").alias("chain"), F.lit(5).cast("long").alias("tx_start"), F.lit(40).cast("long").alias("tx_end"), F.array(*[F.struct(F.lit(a).cast("long").alias("start"), F.lit(b).cast("long").alias("end")) for a, b in ((5, 20), (30, 40))]).alias("exons"))
    mono = (F.lit("-").alias("chain"), F.lit(7).cast("long").alias("tx_start"), F.lit(12).cast("long").alias("tx_end"), F.array(F.struct(F.lit(7).cast("long").alias("start"), F.lit(12).cast("long").alias("end"))).alias("exons"))
    one = lambda shape: spark.range(n).select(F.lit("c").alias("seqname"), F.col("id").alias("tx"), *shape)
    return one(spliced).unionByName(one(mono).withColumn("tx", F.col("tx") + n))


@pytest.mark.parametrize(("name", "kinds"), [("include", 3), ("intronic_match", 1), ("intronic_include", 2), ("singleexon_overlap", 1), ("edge_tolerate_match", 2)])
def test_pairs_of_large_groups_are_made_behind_the_last_shuffle(spark, name, kinds):
    n = 300
    y = _alike(spark, n)
    x = y.drop("exons")
    got = getattr(TJ, name)(x, y if name == "include" else x, ["seqname"]).select("tx", "tx_y")
    top = got._jdf.queryExecution().executedPlan().toString().split("Exchange ")[0]
    assert top.count("Generate explode") >= 2
    assert got.count() == got.distinct().count() == kinds * n * n


def test_packed_rows_are_bounded(spark):
    rows = spark.range(5000).select(F.lit("c").alias("k"), F.col("id").alias("tx"), F.lit(None).cast("string").alias("z")).unionByName(spark.createDataFrame([(None, 1, "z")], "k string, tx long, z string"))
    got = TJ.packed(rows, ["k"], "m", most=500).collect()
    assert sum(len(r.m) for r in got) == 5000 and len(got) == 10 and max(len(r.m) for r in got) < 700
    assert sum(len(r.m) for r in TJ.packed(rows.drop("tx"), ["k"], "m").collect()) == 5000
