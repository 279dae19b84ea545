"""A whole run from a manifest."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from spliceloom.operators import fusions as FU
from spliceloom.plans import run
from spliceloom.sources import places, tables, text
from spliceloom.sources.text import read_gtf

G = Path(__file__).parent / "golden"


def test_run(spark, tmp_path):
    lines = ["sample, long_read_hq, cluster_report"] + [f"sample{i}, {G}/s{i}.paf, {G}/s{i}.clusters.csv" for i in range(1, 5)]
    (tmp_path / "m.csv").write_text("\n".join(lines))
    a = run.assemble(spark, str(tmp_path / "m.csv"))
    assert a.samples == ["sample1", "sample2", "sample3", "sample4"]
    run.write(a, str(tmp_path / "out"))
    assert read_gtf(spark, str(tmp_path / "out/transcripts.gtf"), ["transcript_id"]).select("transcript_id").distinct().count() == 8
    report = {r["name"]: r["n"] for r in run.number_report(a).collect()}
    assert report["transcripts"] == 8 and report["linked_reads"] == 25
    counts = spark.read.csv(str(tmp_path / "out/counts"), sep="\t", header=True)
    assert counts.columns == ["gene_id", "transcript_id", *a.samples] and counts.count() == 8


def test_every_phase(spark, tmp_path):
    genome = text.read_genome(spark, f"{G}/genome.fa", 700)
    plain = ["sample, long_read_hq, cluster_report"] + [f"sample{i}, {G}/s{i}.paf, {G}/s{i}.clusters.csv" for i in range(1, 5)]
    (tmp_path / "p.csv").write_text("\n".join(plain))
    first = run.run(spark, str(tmp_path / "p.csv"), genome, 700)
    assert first.explained is None and first.fusions is None and first.placed.count() == first.assembly.reads.count()
    # calls and structural variants that fit what is there
    a = first.assembly
    linked = a.variants.filter("type = '*'").join(a.links.select("sample", "seq_id").distinct(), ["sample", "seq_id"], "left_semi").join(a.variants.filter("type = '~'").select("sample", "seq_id").distinct(), ["sample", "seq_id"], "left_semi")
    v = linked.filter("sample = 'sample1'").orderBy("seq_id", "pos").first()
    (tmp_path / "calls.tsv").write_text(f"Chr\tStart\tEnd\tRef\tAlt\n{v.chr}\t{v.var_start + 1}\t{v.var_end}\t{v.ref.upper()}\t{v.alt.upper()}\n")
    blocks = FU.blocks(a.chimeras)
    junctions = FU.breakpoints(FU.refined(blocks, FU.junction_offsets(blocks, genome, 700))).filter("sample = 'sample3'").collect()
    cols = ["Chr_1", "Pos_1", "Dir_1", "Chr_2", "Pos_2", "Dir_2", "Inserted_Seq", "Variant_Type", "Tumor_VAF"]
    rows = [(j.up_chr, j.up_pos, j.up_strand, j.down_chr, j.down_pos, "-" if j.down_strand == "+" else "+", "---", "x", 0.5) for j in junctions]
    (tmp_path / "sv.tsv").write_text("\n".join("\t".join(map(str, r)) for r in [cols, *rows]) + "\n")
    full = ["sample,long_read_hq,cluster_report,mutation,sv,long_read_lq"] + [f"sample{i},{G}/s{i}.paf,{G}/s{i}.clusters.csv," + (f"{tmp_path}/calls.tsv,," if i == 1 else f",{tmp_path}/sv.tsv,{G}/s1.paf" if i == 3 else ",,") for i in range(1, 5)]
    (tmp_path / "f.csv").write_text("\n".join(full))
    out = run.run(spark, str(tmp_path / "f.csv"), genome, 700)
    found = {(r.sample, r.seq_id, r.start, r.status) for r in out.explained.collect()}
    assert ("sample1", v.seq_id, v.var_start, "match") in found and {x[0] for x in found} == {"sample1"}
    reads = out.fusions.reads.collect()
    assert reads and {(r.sample, r.seq_id) for r in reads} == {(r.sample, r.seq_id) for r in blocks.select("sample", "seq_id").distinct().collect()}
    assert all((r.match_class is None) != (r.dropout is None) for r in reads) and {r.match_class for r in reads if r.sample != "sample3"} <= {None}
    assert out.placed.count() > first.placed.count()
    run.write_run(out, str(tmp_path / "out"))
    held = out.placed.filter("chr = '18' AND start <= 12000 AND end >= 11900")
    assert places.read_region(spark, str(tmp_path / "out/alignments"), "18", 11900, 12000).count() == held.count() > 0


def test_regions_open_only_their_files(spark, tmp_path):
    df = spark.range(2000).select(F.concat(F.lit("c"), (F.col("id") % 3).cast("string")).alias("chr"), (F.col("id") * 37 % 5000).alias("start"), "id").withColumn("end", F.col("start") + F.col("id") % 90)
    odd = spark.createDataFrame([(None, None, -1, None)], "chr string, start long, id long, end long")
    places.write_by_place(df.unionByName(odd), str(tmp_path / "t"), files=8)
    every = spark.read.parquet(str(tmp_path / "t/rows"))
    got = places.read_region(spark, str(tmp_path / "t"), "c1", 700, 800)
    want = df.filter("chr = 'c1' AND start <= 800 AND end >= 700")
    assert sorted(map(str, got.select("id").collect())) == sorted(map(str, want.select("id").collect())) and got.count() > 20
    assert len(got.inputFiles()) < len(every.inputFiles()) == 8 and every.count() == 2001
    assert places.read_region(spark, str(tmp_path / "t"), "c9", 1, 2).count() == 0


def test_sam_file_in_the_order_of_its_sequences(spark, tmp_path):
    from spliceloom.operators.sam import write_sam

    (tmp_path / "g.fa").write_text(">z\nACGT\nAC\n>a\nAC\n>m\n")
    index = text.read_fasta_index(spark, str(tmp_path / "g.fa"))
    lines = [("r1", "a", 5), ("r2", "z", 9), ("r3", "z", 2), ("r4", "q", 1), ("r5", "a", 1)]
    body = spark.createDataFrame([(f"{i}\t0\t{c}\t{p}\t255\t1M\t*\t0\t0\tA\t*",) for i, c, p in lines], "value string")
    write_sam(body, index, str(tmp_path / "s"), ["file", "record"])
    files = sorted(p for p in (tmp_path / "s").iterdir() if p.name.startswith("part"))
    got = [x.split("\t")[:2] for p in files for x in p.read_text().splitlines()]
    assert [x[1] for x in got[:3]] == ["SN:z", "SN:a", "SN:m"] and got[3][0] == "@PG" and [x[0] for x in got[4:]] == ["r3", "r2", "r5", "r1", "r4"]


def test_manifest_rules(spark, tmp_path):
    (tmp_path / "m.csv").write_text("sample,long_read_hq,cluster_report\na,x,y\nb,x,\n")
    with pytest.raises(ValueError, match="for some samples only"):
        tables.read_manifest(spark, str(tmp_path / "m.csv"))
    (tmp_path / "n.csv").write_text("sample,long_read_hq,mutation\na,x,y\nb,x,\n")
    m = tables.read_manifest(spark, str(tmp_path / "n.csv"))
    none = tables.read_samples(spark, m, "sv", tables.read_structural, tables.STRUCTURAL)
    assert none.count() == 0 and none.columns[-1] == "sample" and tables.read_samples(spark, m, "sv", tables.read_structural) is None


def test_written_tables_are_released(spark):
    from spliceloom import session

    session.release(spark)
    kept = session.settled(spark.range(5))
    path = kept.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file:")
    assert Path(path).is_dir() or Path("/" + path.lstrip("/")).is_dir()
    assert session.release(spark) == 1 and session.release(spark) == 0 and not Path("/" + path.lstrip("/")).exists()
