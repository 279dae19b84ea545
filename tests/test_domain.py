"""Hand-made cases for mutations, fusions, readers, writers and SAM text."""

import random

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from spliceloom.functions.cs import tokens, variants
from spliceloom.functions.text import canonical_offsets, is_canonical, repeat_unit, reverse_complement
from spliceloom.operators import fusions as FU
from spliceloom.operators import mutations as M
from spliceloom.operators.sam import cigar_and_sequence, known_chromosomes, sam_body, sam_header
from spliceloom.operators.sequences import subsequences
from spliceloom.sources import sinks, tables, text
from spliceloom.streaming.reads import stream_tokens


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=str)


def one(spark, *cols):
    return tuple(spark.range(1).select(*cols).first())


def test_text_functions(spark):
    assert one(spark, reverse_complement(F.lit("ACgtN"))) == ("NacGT",)
    assert one(spark, repeat_unit(F.lit("aaaa")), repeat_unit(F.lit("atatat")), repeat_unit(F.lit("acg"))) == ("aa", "at", "acg")
    assert one(spark, is_canonical(F.lit("gt"), F.lit("AG")), is_canonical(F.lit("AG"), F.lit("GT")), is_canonical(F.lit(None).cast("string"), F.lit("AG"))) == (True, False, None)
    assert one(spark, canonical_offsets(F.lit("AGTA"), F.lit("CAGC"), F.lit(2)), canonical_offsets(F.lit("GT"), F.lit("AG"), F.lit(-1))) == ([2], [])


def test_adjacent_operators(spark):
    df = spark.createDataFrame([(1, 10, "3+gg-tt*ac2~gt100ag1"), (2, 0, None), (3, 0, "")], "id int, start int, cs string")
    assert [r["token"] for r in tokens(df, ["id"]).orderBy("pos").collect()] == ["3", "+gg", "-tt", "*ac", "2", "~gt100ag", "1"]
    assert rows(variants(df, ["id"]).drop("pos"), "type", "var_start", "var_end", "ref", "alt") == sorted([("+", 13, 13, None, "gg"), ("-", 13, 15, "tt", None), ("*", 15, 16, "a", "c"), ("~", 18, 118, None, None)], key=str)


def test_subsequences_cross_chunks(spark):
    g = text.genome_chunks(spark.createDataFrame([("c", "ACGTACGTAC")], "id string, sequence string"), 4)
    r = spark.createDataFrame([("c", 3, 9), ("c", 5, 4), ("x", 1, 2)], "chr string, start long, end long")
    assert rows(subsequences(r, g, 4), "chr", "seq") == [("c", "GTACGTA"), ("c", None), ("x", None)]


VAR = "id int, pos int, chr string, type string, start long, end long, ref string, alt string, sample string"
CALL = "chr string, type string, start long, end long, ref string, alt string, sample string"


def test_mutation_matching(spark):
    v = spark.createDataFrame(
        [
            (1, 0, "1", "*", 5, 6, "a", "c", "s"), (2, 0, "1", "+", 9, 9, None, "gg", "s"), (3, 0, "1", "-", 20, 22, "tt", None, "s"),
            (4, 0, "1", "+", 30, 30, None, "agga", "s"), (5, 0, "1", "-", 40, 46, "acgtac", None, "s"), (6, 0, "1", "-", 40, 46, "aaaaaa", None, "s"),
            (7, 0, "1", "+", 50, 50, None, "t", "s"), (7, 1, "1", "~", 50, 90, None, None, "s"), (8, 0, "1", "*", 5, 6, "a", "c", "other"), (9, 0, "1", "*", 5, 6, "a", "c", "none"),
        ],
        VAR,
    )
    c = spark.createDataFrame([("1", "*", 5, 6, "a", "c", "s"), ("1", "+", 9, 9, None, "gg", "s"), ("1", "-", 20, 22, "tt", None, "s"), ("1", "+", 30, 30, None, "gg", "s"), ("1", "-", 42, 44, "gt", None, "s"), ("1", "+", 90, 90, None, "t", "s")], CALL)
    got = M.match_calls(M.another_start(v, ["id"]), c)
    assert rows(got, "id", "start", "end", "ref", "alt", "status") == sorted([
        (1, 5, 6, "a", "c", "match"), (2, 9, 9, None, "gg", "match"), (3, 20, 22, "tt", None, "match"), (4, 30, 30, None, "gg", "ambiguous"), (5, 42, 44, "gt", None, "ambiguous"), (7, 90, 90, None, "t", "match"),
    ], key=str)


def test_repeat_shift(spark):
    g = text.genome_chunks(spark.createDataFrame([("c", "CCATATATGG")], "id string, sequence string"), 4)
    d = spark.createDataFrame([("c", "+", 8, 8, None, "at"), ("c", "+", 2, 2, None, "at"), ("c", "+", 1, 1, None, "g")], "chr string, type string, start long, end long, ref string, alt string")
    assert rows(M.repeat_shift(d, g, 4), "start", "repeat_start") == [(1, None), (2, 8), (8, 2)]
    assert rows(M.repeat_shift(d.withColumns({"last_gap": F.lit(1), "next_gap": F.lit(2)}), g, 4), "start", "repeat_start") == [(1, None), (2, 8), (8, None)]
    assert M.repeat_shift(d.filter("false"), g, 4).count() == 0


def test_repeats_of_any_length(spark):
    seq = "g" + "a" * 3000 + "c" + "acg" * 700 + "t"
    g = text.genome_chunks(spark.createDataFrame([("c", seq)], "id string, sequence string"), 100)
    some = [("+", 1, 1, None, "a"), ("+", 3001, 3001, None, "a"), ("-", 1, 3, "aa", None), ("+", 3002, 3002, None, "acg"), ("-", 3002 + 2097, 3002 + 2100, "acg", None)]
    d = spark.createDataFrame([("c", *x) for x in some], "chr string, type string, start long, end long, ref string, alt string")
    assert rows(M.repeat_shift(d, g, 100), "start", "end", "repeat_start") == sorted([(1, 1, 3001), (3001, 3001, 1), (1, 3, 2999), (3002, 3002, 5102), (5099, 5102, 3002)], key=str)


def repeat_by_hand(seq, start, end, bases):
    n = len(bases)
    unit = next((bases[: n // m] for m in range(2, n + 1) if n % m == 0 and bases[: n // m] * m == bases), bases)
    k, left, right = len(unit), 0, 0
    while start - (left + 1) * k >= 0 and seq[start - (left + 1) * k : start - left * k] == unit:
        left += 1
    while seq[end + right * k : end + (right + 1) * k] == unit:
        right += 1
    return start - left * k if left else start + right * k if right else None


def test_repeats_equal_a_slow_walk(spark):
    rng = random.Random(8)
    chroms = {f"c{i}": "".join(rng.choice(["a", "t", "at", "aat", "c" * 5]) * rng.randrange(1, 9) for _ in range(12)) for i in range(6)}
    g = spark.createDataFrame([(c, s.upper()) for c, s in chroms.items()], "id string, sequence string")
    indels = []
    for i in range(300):
        c = rng.choice(sorted(chroms))
        start, bases = rng.randrange(len(chroms[c])), rng.choice(["a", "t", "at", "ta", "aat", "cc"]) * rng.randrange(1, 4)
        deleted = rng.random() < 0.5
        indels.append((i, c, "-" if deleted else "+", start, start + len(bases) * deleted, bases if deleted else None, None if deleted else bases))
    d = spark.createDataFrame(indels, "id int, chr string, type string, start long, end long, ref string, alt string")
    want = {i: repeat_by_hand(chroms[c], s, e, r or a) for i, c, _, s, e, r, a in indels}
    for width in (3, 1000):
        assert {r["id"]: r["repeat_start"] for r in M.repeat_shift(d, text.genome_chunks(g, width), width).collect()} == want
    assert sum(x is not None for x in want.values()) > 100


def test_gaps_and_explained_variants(spark):
    v = spark.createDataFrame(
        [(1, 0, "c", "+", 4, 4, None, "a", "s", 0, 20), (1, 1, "c", "*", 5, 6, "a", "g", "s", 0, 20), (2, 0, "c", "+", 4, 4, None, "a", "s", 0, 20), (3, 0, "c", "-", 8, 9, "a", None, "s", 2, 20)],
        VAR + ", tx_start long, tx_end long",
    )
    assert rows(M.neighbour_gaps(v, ["id"]), "id", "pos", "last_gap", "next_gap") == [(1, 0, 4, 1), (1, 1, 1, 14), (2, 0, 4, 16), (3, 0, 6, 11)]
    g = text.genome_chunks(spark.createDataFrame([("c", "cgggaaaaaacgg")], "id string, sequence string"), 3)
    calls = spark.createDataFrame([("c", "+", 10, 10, None, "a", "s"), ("c", "-", 4, 5, "a", None, "s")], CALL)
    got = M.explain_variants(v, calls, g, 3, ["id", "sample", "chr"])
    assert rows(got, "id", "pos", "start", "end", "status") == [(1, 0, 10, 10, "match"), (2, 0, 10, 10, "match"), (3, 0, 4, 5, "match")]
    both = M.match_calls(v.filter("id = 2").withColumn("another_start", F.lit(10).cast("long")), calls.unionByName(calls.filter("type = '+'").withColumns({"start": F.lit(4).cast("long"), "end": F.lit(4).cast("long")})))
    assert rows(both, "start", "status") == [(4, "match")]


def test_variants_on_exons(spark):
    v = spark.createDataFrame(
        [(1, "~", 5, 50, None, None, None), (2, "+", 20, 20, None, "g", 3), (3, "-", 8, 14, "acgtac", None, None), (4, "*", 9, 10, "a", "c", 40), (5, "*", 10, 11, "a", "c", None), (6, "-", 12, 15, "acg", None, 9), (7, "-", 0, 4, "acgt", None, None), (8, "+", 4, 4, None, "g", 7)],
        "id int, type string, start long, end long, ref string, alt string, another_start long",
    ).withColumns({"tx": F.lit("t"), "chr": F.lit("c")})
    e = spark.createDataFrame([("t", "c", 1, 10), ("u", "c", 1, 100), ("t", "d", 1, 100)], "tx string, chr string, start int, end int")
    assert rows(M.on_exons(v, e, ["tx"]), "id", "start", "end", "ref", "another_start", "rescue") == sorted([
        (2, 3, 3, None, None, "moved"), (3, 8, 10, "ac", None, "cut"), (4, 9, 10, "a", None, "inside"), (6, 9, 10, "a", None, "moved"), (7, 0, 4, "acgt", None, "cut"), (8, 4, 4, None, 7, "inside"),
    ], key=str)


def test_callers(spark):
    calls = spark.createDataFrame([("1", 10, 10, "A", "C"), ("1", 10, 10, "-", "GG"), ("1", 10, 11, "TT", "-")], "Chr string, Start int, End int, Ref string, Alt string")
    assert rows(tables.mutations(calls)) == sorted([("1", "*", 9, 10, "a", "c"), ("1", "+", 10, 10, None, "gg"), ("1", "-", 9, 11, "tt", None)], key=str)
    indels = spark.createDataFrame([("1", 10, "A", "AGG", True), ("1", 10, "ATT", "A", True), ("1", 1, "A", "AC", False)], "Chr string, Pos int, Ref string, Alt string, Somatic boolean")
    assert rows(tables.indel_mutations(indels), "type", "start", "end", "ref", "alt") == sorted([("+", 10, 10, None, "gg"), ("-", 10, 12, "tt", None)], key=str)
    with pytest.raises(Exception, match="equal lengths"):
        tables.indel_mutations(spark.createDataFrame([("1", 1, "A", "C", True)], "Chr string, Pos int, Ref string, Alt string, Somatic boolean")).collect()


BLOCK = "sample string, seq_id string, query_length int, query_start long, query_end long, strand string, chr string, start long, end long"
SV = "sample string, Chr_1 string, Pos_1 long, Dir_1 string, Chr_2 string, Pos_2 long, Dir_2 string, Inserted_Seq string"


def test_fusion_blocks_and_junctions(spark):
    # donor GT after 10 bases of c1; acceptor AG before base 21 of c2; no overlap
    fa = spark.createDataFrame([("c1", "A" * 10 + "GT" + "A" * 20), ("c2", "C" * 18 + "AG" + "C" * 20)], "id string, sequence string")
    g = text.genome_chunks(fa, 7)
    b = FU.blocks(spark.createDataFrame([("s", "r", 20, 0, 10, "+", "c1", 0, 10), ("s", "r", 20, 10, 20, "+", "c2", 20, 30), ("t", "r", 20, 0, 10, "+", "c1", 0, 10)], BLOCK))
    assert rows(b, "sample", "idx", "acceptor_overlap", "donor_overlap") == [("s", 1, None, 0), ("s", 2, 0, None)]
    j = FU.junction_offsets(b, g, 7)
    assert rows(j, "ov", "offsets", "determined") == [(0, [1], True)]
    assert rows(FU.read_classes(j), "read_class") == [("full",)]
    bp = FU.breakpoints(FU.refined(b, j))
    assert rows(bp, "up_chr", "up_pos", "down_chr", "down_pos", "sv_type", "sv_number") == [("c1", 10, "c2", 20, "sj_confirmed", 1)]
    sv = spark.createDataFrame([("s", "c1", 60, "+", "c2", 5, "-", ""), ("s", "c2", 5, "-", "c1", 60, "+", ""), ("s", "c1", 60, "-", "c2", 5, "-", ""), ("u", "c1", 60, "+", "c2", 5, "-", "")], SV)
    assert len(rows(FU.match_structural(bp, sv, "internal"))) == 2  # either breakpoint first
    assert rows(FU.match_classes(bp, FU.read_classes(j), sv), "match_class") == [("uni",)]


def test_structural_distance(spark):
    j = spark.createDataFrame([("s", "r", 1, "a", "+", 1000, "b", "+", 2000)], "sample string, seq_id string, sv_number int, up_chr string, up_strand string, up_pos long, down_chr string, down_strand string, down_pos long")
    near = lambda d: spark.createDataFrame([("s", "a", 1000 + d, "+", "b", 2000, "-", "")], SV)
    assert FU.match_structural(j, near(100), "ambiguity").count() == 1
    assert FU.match_structural(j, near(101), "ambiguity").count() == 0
    assert FU.match_structural(j, near(100_000), "internal").count() == 1
    assert FU.match_structural(j, near(-101), "internal").count() == 0


def test_novel_introns_know_their_strand(spark):
    g = text.genome_chunks(spark.createDataFrame([("c", "AAGTCCAGAACTCCACAA")], "id string, sequence string"), 5)
    i = spark.createDataFrame([("s", "plus", "c", "+", 3, 8), ("s", "minus", "c", "-", 11, 16), ("s", "bad", "c", "+", 11, 16), ("s", "known", "c", "+", 1, 5)], "sample string, seq_id string, chr string, strand string, start long, end long")
    known = spark.createDataFrame([("c", "+", 1, 5)], "chr string, strand string, start long, end long")
    assert rows(FU.novel_noncanonical(i, [known], g, 5)) == [("s", "bad")]  # CT..AC on - reads GT..AG


def test_summary(spark):
    b = spark.createDataFrame([("s", "r", 1), ("s", "r", 2), ("s", "q", 1), ("s", "q", 2), ("s", "q", 3)], "sample string, seq_id string, idx int")
    names = spark.createDataFrame([("s", "r", 1, "A_1"), ("s", "q", 2, "B")], "sample string, seq_id string, idx int, name string")
    counts = spark.createDataFrame([("s", "r", 2, 1)], "sample string, seq_id string, fl long, nfl long")
    assert [tuple(r) for r in FU.fusion_summary(b, names, counts).collect()] == [("s", "q", "novel_B_novel", None, None, 2), ("s", "r", "A_1_novel", 2, 1, 1)]


def cigar_by_hand(exons, variants):
    ops, bases, last, used = [], "", None, set()

    def put(n, op):
        if n > 0:
            ops[-1:] = [(ops[-1][0] + n, op)] if ops and ops[-1][1] == op else [*ops[-1:], (n, op)]

    todo = sorted((v for v in variants if v[2] in "+-*"), key=lambda v: (v[0], v[2] != "+", v[1], v[2], v[3] or ""))
    for start, end, seq in exons:
        put(start - last - 1 if last is not None else 0, "N")
        at = start - 1
        for k, (a, b, kind, alt) in enumerate(todo):
            if k in used or a < at or a > end or (kind != "+" and b > end):
                continue
            put(a - at, "M")
            bases += seq[at - start + 1 : a - start + 1] + ((alt or "").upper() if kind != "-" else "")
            put(*{"+": (len(alt or ""), "I"), "-": (b - a, "D"), "*": (1, "M")}[kind])
            at = a if kind == "+" else b
            used.add(k)
        put(end - at, "M")
        bases += seq[at - start + 1 :]
        last = end
    return "".join(f"{n}{op}" for n, op in ops), bases


def test_cigar(spark):
    exons = [(1, 10, "ACGTACGTAC"), (21, 30, "GGGGGCCCCC")]
    v = [(2, 3, "*", "t"), (5, 5, "+", "aa"), (22, 24, "-", None), (50, 51, "*", "a")]
    assert cigar_by_hand(exons, v) == ("5M2I5M10N2M2D6M", "ACTTAAACGTACGGGCCCCC")
    rng, cases = random.Random(6), []
    for i in range(300):
        e, at = [], rng.randrange(1, 5)
        for _ in range(rng.randrange(1, 5)):
            n = rng.randrange(1, 12)
            e.append((at, at + n - 1, "".join(rng.choices("ACGT", k=n))))
            at += n + rng.choice([0, 1, 5])
        vs = []
        for _ in range(rng.randrange(7)):
            s, kind = rng.randrange(at + 3), rng.choice("+-*~")
            vs.append((s, s + {"+": 0, "-": rng.randrange(1, 5), "*": 1, "~": 3}[kind], kind, {"+": rng.choice(["a", "gg", None]), "-": None, "*": "t", "~": None}[kind]))
        cases.append((i, e, vs))
    cases.append((300, exons, v))
    df = spark.createDataFrame(cases, "id int, e array<struct<start:long,end:long,seq:string>>, v array<struct<start:long,end:long,type:string,alt:string>>")
    cigar, bases = cigar_and_sequence(F.col("e"), F.col("v"))
    got = {r["id"]: (r["c"], r["s"]) for r in df.select("id", cigar.alias("c"), bases.alias("s")).collect()}
    for i, e, vs in cases:
        assert got[i] == cigar_by_hand(e, vs), (e, vs)


def test_matrix_and_fusion_annotation(spark, tmp_path):
    m = spark.createDataFrame([("t2", "1.50", None), ("t1", "0", "3")], "Name string, s1 string, s2 string")
    sinks.write_matrix(m, "Name", str(tmp_path / "m"))
    files = sorted(p for p in (tmp_path / "m").iterdir() if p.name.startswith("part"))
    assert [x for p in files for x in p.read_text().splitlines()] == ["s1\ts2", "t1\t0\t3", "t2\t1.50\tNA"]
    e = spark.createDataFrame([("s", "r", "c", "+", 1, 5, 1), ("s", "q", "c", "+", 1, 5, 1)], "sample string, seq_id string, chr string, strand string, start long, end long, exon_number long")
    g = FU.fusion_annotation(e, spark.createDataFrame([("s", "r", "A_B")], "sample string, seq_id string, gene_combination string"))
    assert [r.value for r in sinks.gtf_lines(g).collect()] == ['c\ts\texon\t1\t5\t.\t+\t.\tgene_id "A_B"; transcript_id "r"; exon_number "1";']


def test_sam_lines(spark):
    fa = spark.createDataFrame([("c", "ACGTACGTAC")], "id string, sequence string")
    e = spark.createDataFrame([("t1", "c", "+", 1, 3), ("t1", "c", "+", 6, 8), ("t2", "x", "-", 1, 2)], "tx string, chr string, strand string, start long, end long")
    v = spark.createDataFrame([("t1", 1, 2, "*", "a")], "tx string, start long, end long, type string, alt string")
    on, off = known_chromosomes(e, fa)
    assert rows(off) == [("x",)]
    assert rows(sam_body(on, v, text.genome_chunks(fa, 4), "tx", 4)) == [("t1\t0\tc\t1\t255\t3M2N3M\t*\t0\t0\tAAGCGT\t*",)]
    assert [r["value"] for r in sam_header(fa).orderBy("o", "n").collect()] == ["@SQ\tSN:c\tLN:10", "@PG\tID:spliceloom\tPN:spliceloom"]


def test_readers(spark, tmp_path):
    p = tmp_path / "a.paf"
    p.write_text("r1\t10\t0\t10\t+\tc\t99\t5\t15\t9\t10\t60\tcs:Z::10\tx:i:1\nr2\t10\t0\t10\t+\tc\t99\t5\t15\t9\t10\t50\tcs:Z:*ag9\nr3\t1\t0\t1\t+\tc\t9\t0\t1\t1\t1\t60\n")
    assert rows(text.read_paf(spark, str(p)), "seq_id", "start", "mapq", "cs") == [("r1", 5, 60, "10")]
    assert rows(text.read_paf_quality(spark, str(p))) == [("r1", 60), ("r2", 50), ("r3", 60)]
    s = tmp_path / "a.sam"
    s.write_text("@HD\tVN:1\nr1\t16\tc\t5\t60\t5M\nr2\t2048\tc\t6\t60\t5M\tcs:Z::5\n")
    assert rows(text.read_sam(spark, str(s)), "seq_id", "strand", "chimera", "cs") == [("r1", "-", False, None), ("r2", "+", True, "5")]
    kept = sinks.kept_lines(text.read_sam_lines(spark, str(s)), spark.createDataFrame([("r2",)], "seq_id string"))
    assert [r["value"].split("\t")[0] for r in kept.collect()] == ["@HD", "r2"]
    q = tmp_path / "a.fq"
    q.write_text("@x1 d\nACGT\n+\nIIII\n@x2\nGG\n+\nII\n")
    assert rows(text.read_fastq(spark, str(q)), "record", "id", "sequence", "quality") == [(0, "x1", "ACGT", "IIII"), (1, "x2", "GG", "II")]
    m = tmp_path / "m.csv"
    m.write_text("sample, long_read_hq\na, x\nb, y\n")
    assert rows(tables.read_manifest(spark, str(m)), "sample", "long_read_hq", "sv") == [("a", "x", None), ("b", "y", None)]
    m.write_text("sample, long_read_hq\na, x\na, y\n")
    with pytest.raises(ValueError, match="repeats"):
        tables.read_manifest(spark, str(m))
    empty = tmp_path / "e.paf"
    empty.write_text("")
    assert text.read_paf(spark, str(empty)).count() == 0


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([("c", 1, 2, None, "g", None)], "seqname string, start int, end int, strand string, gene_id string, note string")
    assert rows(sinks.gtf_lines(df)) == [('c\t.\t.\t1\t2\t.\t*\t.\tgene_id "g";',)]
    sinks.write_gtf(df, str(tmp_path / "g"))
    assert rows(text.read_gtf(spark, str(tmp_path / "g"), ["gene_id"]), "seqname", "start", "gene_id") == [("c", 1, "g")]
    fa = spark.createDataFrame([("a", "ACGTACG")], "id string, sequence string")
    sinks.write_fasta(fa, str(tmp_path / "f"), 3)
    assert rows(text.read_fasta(spark, str(tmp_path / "f")), "id", "sequence") == [("a", "ACGTACG")]
    sinks.write_tsv(spark.createDataFrame([("a", True)], "x string, y boolean"), str(tmp_path / "t"), single=True)
    assert [tuple(r) for r in spark.read.csv(str(tmp_path / "t"), sep="\t", header=True).collect()] == [("a", "TRUE")]


def test_stream(spark, tmp_path):
    spark.createDataFrame([(1, "3+g2")], "id int, cs string").write.parquet(str(tmp_path / "in"))
    s = stream_tokens(spark.readStream.schema("id int, cs string").parquet(str(tmp_path / "in")), ["id"])
    q = s.writeStream.format("memory").queryName("tok").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp")).start()
    q.awaitTermination(60)
    assert spark.sql("SELECT token FROM tok ORDER BY pos").toPandas().token.tolist() == ["3", "+g", "2"]


def test_sequence_files_in_many_blocks(spark, tmp_path):
    rng = random.Random(3)
    files = {}
    for n in range(3):
        records = [(f"r{n}_{i}", rng.choice(["", "a note > here"]), "".join(rng.choices("ACGTN", k=rng.choice([0, 1, 79, 80, 700, 5000])))) for i in range(12)]
        lines = [x for i, d, q in records for x in [f">{i} {d}".strip(), *[q[k : k + 80] for k in range(0, len(q), 80)]]]
        files[n] = records
        (tmp_path / "fa").mkdir(exist_ok=True)
        (tmp_path / "fa" / f"{n}.fa").write_text(rng.choice(["\n", "\r\n"]).join(lines))
        reads = [x for i, _, q in records for x in (f"@{i} d", q, "+", "I" * len(q))]
        (tmp_path / "fq").mkdir(exist_ok=True)
        (tmp_path / "fq" / f"{n}.fq").write_text("\n".join(reads) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500b")
    try:
        every = sorted(r for x in files.values() for r in x)
        assert sorted(map(tuple, text.read_fasta(spark, str(tmp_path / "fa")).collect())) == every
        chunks = {}
        for r in text.read_genome(spark, str(tmp_path / "fa"), 333).collect():
            chunks[r.chr, r.chunk] = r.seq
        assert chunks == {(i, k // 333): q[k : k + 333] for i, _, q in every for k in range(0, len(q), 333)}
        fq = text.read_fastq(spark, str(tmp_path / "fq"))
        assert sorted((r.id, r.description, r.sequence, r.quality) for r in fq.collect()) == [(i, "d", q, "I" * len(q)) for i, _, q in every]
        assert fq.select("file", "record").distinct().count() == len(every) and fq.agg(F.max("record")).first()[0] == 11
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_records_without_a_sequence(spark, tmp_path):
    (tmp_path / "f.fa").write_text(">a\n>b desc\nAC\nGT\n>c")
    assert sorted(map(tuple, text.read_fasta(spark, str(tmp_path / "f.fa")).collect())) == [("a", "", ""), ("b", "desc", "ACGT"), ("c", "", "")]
    (tmp_path / "e.fa").write_text("")
    assert text.read_fasta(spark, str(tmp_path / "e.fa")).count() == text.read_genome(spark, str(tmp_path / "e.fa")).count() == 0


def test_paf_counts_what_it_drops(spark, tmp_path):
    line = "r{}\t9\t0\t9\t+\tc\t99\t0\t9\t9\t9\t60\t{}"
    (tmp_path / "a.paf").write_text("\n".join(line.format(i, "cs:Z::9" if i % 3 else "cs:Z:*ac") for i in range(9)))
    seen = Observation("paf")
    assert text.read_paf(spark, str(tmp_path / "a.paf"), observation=seen).count() == 6
    assert seen.get == {"dropped": 3, "rows": 9}
    (tmp_path / "b.paf").write_text("\n".join(line.format(i, "tp:A:P") for i in range(20)))
    with pytest.raises(ValueError, match="no cs tag"):
        text.read_paf(spark, str(tmp_path / "b.paf"))
    (tmp_path / "c.paf").write_text("\n".join(line.format(i, "tp:A:P") for i in range(19)))
    assert text.read_paf(spark, str(tmp_path / "c.paf")).count() == 0


def test_fasta_marks_inside_descriptions(spark, tmp_path):
    (tmp_path / "f").mkdir()
    (tmp_path / "f" / "a.fa").write_text(">a kinase A>B\nAC\nGT\n>b\r\nTT\r\n>c\nGG")
    assert sorted(map(tuple, text.read_fasta(spark, str(tmp_path / "f")).collect())) == [("a", "kinase A>B", "ACGT"), ("b", "", "TT"), ("c", "", "GG")]


def test_inclusion_of_ends_in_different_exons(spark):
    from spliceloom.operators import txjoin

    kind = "tx string, seqname string, strand string, chain string, tx_start long, tx_end long, exons array<struct<start:long,end:long>>"
    y = spark.createDataFrame([("y", "c", "+", "-200 300-", 100, 400, [(100, 200), (300, 400)])], kind)
    rows = [("over", "-", 150, 350), ("in", "-", 310, 350), ("gap", "-", 150, 250), ("spliced", "-200 300-", 120, 380), ("long", "-200 300-", 90, 380), ("other", "-210 300-", 120, 380)]
    x = spark.createDataFrame([(n, "c", "+", c, a, b, [(a, b)]) for n, c, a, b in rows], kind)
    assert sorted(r.tx for r in txjoin.include(x, y, ["seqname", "strand"]).collect()) == ["in", "over", "spliced"]


def test_partly_matched_partial_reads(spark):
    junctions = spark.createDataFrame([("s", "r", i, "c", p, "+", "c", 90_000, "+", "sj_not_confirmed") for i, p in ((1, 1_000), (2, 50_000))], "sample string, seq_id string, sv_number int, up_chr string, up_pos long, up_strand string, down_chr string, down_pos long, down_strand string, sv_type string")
    classes = spark.createDataFrame([("s", "r", "partial")], "sample string, seq_id string, read_class string")
    sv = spark.createDataFrame([("s", "c", 1_050, "+", "c", 90_010, "-", "---")], "sample string, Chr_1 string, Pos_1 long, Dir_1 string, Chr_2 string, Pos_2 long, Dir_2 string, Inserted_Seq string")
    assert [tuple(r) for r in FU.match_classes(junctions, classes, sv).collect()] == [("s", "r", "partial")]


def test_sam_files_as_one(spark, tmp_path):
    for n, (size, reads) in {"a": (9, "xy"), "b": (9, "z"), "c": (8, "w")}.items():
        (tmp_path / f"{n}.sam").write_text(f"@HD\tVN:1.6\n@SQ\tSN:c\tLN:{size}\n" + "".join(f"{r}\t0\tc\t1\n" for r in reads))
    lines = text.read_sam_lines(spark, [str(tmp_path / "a.sam"), str(tmp_path / "b.sam")])
    assert [r.value for r in sinks.concatenated_sam(lines).collect()] == ["@HD\tVN:1.6", "@SQ\tSN:c\tLN:9", "x\t0\tc\t1", "y\t0\tc\t1", "z\t0\tc\t1"]
    with pytest.raises(ValueError, match="length of sequence c"):
        sinks.concatenated_sam(text.read_sam_lines(spark, str(tmp_path / "*.sam")))
