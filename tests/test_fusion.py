"""The fusion phase: structural matches against a slow version, every class and every reason for dropping a read, the result tables."""

import random

from pyspark.sql import functions as F

from spliceloom.operators import fusions as FU
from spliceloom.plans import catalog
from spliceloom.plans import fusion
from spliceloom.sources import text

CAND = "sample string, seq_id string, query_length int, query_start long, query_end long, strand string, chr string, start long, end long, cs string"
SV = "sample string, Chr_1 string, Pos_1 long, Dir_1 string, Chr_2 string, Pos_2 long, Dir_2 string, Inserted_Seq string"
JUNCTION = "id long, sample string, up_chr string, up_strand string, up_pos long, down_chr string, down_strand string, down_pos long"
FLIP = {"+": "-", "-": "+"}


def matches_by_hand(junctions, sv, tolerance, reach):
    out = []
    for i, s, uc, us, up, dc, ds, dp in junctions:
        for k, (t, c1, p1, d1, c2, p2, d2, _) in enumerate(sv):
            for e1, e2 in ((d1, FLIP[d2]), (FLIP[d1], d2)):
                for a, b in (((c1, p1, e1), (c2, p2, e2)), ((c2, p2, e2), (c1, p1, e1))):
                    if s == t and (a[0], a[2], b[0], b[2]) == (uc, us, dc, ds):
                        x, y = (a[1] - up) * (1 if us == "+" else -1), (dp - b[1]) * (1 if ds == "+" else -1)
                        if -tolerance <= x <= reach and -tolerance <= y <= reach:
                            out.append((i, k))
    return sorted(out)


def test_structural_matches(spark):
    rng = random.Random(12)
    place = lambda: rng.choice([0, 3, 250_000]) + rng.choice([rng.randrange(300), rng.randrange(150_000), 261 * 64 * rng.randrange(4)])
    js = [(i, rng.choice("st"), rng.choice("ab"), rng.choice("+-"), place(), "b", rng.choice("+-"), place()) for i in range(150)]
    js += [(200, "s", "a", "+", None, "b", "+", 1), (201, "s", "a", "+", -5, "b", "-", 0)]
    vs = [(rng.choice("st"), rng.choice("ab"), place(), rng.choice("+-"), "b", place(), rng.choice("+-"), "") for _ in range(150)]
    near = [("s" if j[1] == "s" else "t", j[2], j[4] + d, j[3], j[5], j[7] + e, FLIP[j[6]], "") for j in js[:40] for d, e in ((100, -100), (-100, 100), (101, 0), (0, -101))]
    vs += near
    j, v = spark.createDataFrame(js, JUNCTION), spark.createDataFrame([(*x[:7], str(k)) for k, x in enumerate(vs)], SV).withColumnRenamed("Inserted_Seq", "k").withColumn("Inserted_Seq", F.lit(""))
    real = [x for x in js if x[4] is not None]
    for mode, reach in (("ambiguity", 100), ("internal", 100_000)):
        got = sorted((r.id, int(r.k)) for r in FU.match_structural(j, v, mode).select("id", "k").collect())
        want = matches_by_hand(real, vs, 100, reach)
        assert got == want and len(want) > 50
        hit = FU.matched(j, v, mode)
        assert hit.columns == j.columns and sorted(r.id for r in hit.collect()) == sorted({i for i, _ in want})


def test_whether_a_variant_matches_is_told_without_pairs(spark):
    """Variants around the four corners of the range, which begins, ends or lies across blocks; and plans of queries that only ask whether."""
    rng = random.Random(5)
    width = 100_101
    edge = lambda: rng.choice([0, 1, 2]) * width + rng.choice([-201, -101, -100, -1, 0, 1, 100, 101, 5000])
    js = [(i, "s", "a", rng.choice("+-"), edge() + 200, "b", rng.choice("+-"), edge() + 200) for i in range(300)]
    vs = [("s", "a", edge(), rng.choice("+-"), "b", edge(), rng.choice("+-"), "") for _ in range(12)]
    want = {i for i, _ in matches_by_hand(js, vs, 100, 100_000)}
    got = [r.id for r in FU.matched(spark.createDataFrame(js, JUNCTION), spark.createDataFrame(vs, SV), "internal").collect()]
    assert sorted(got) == sorted(want) and 30 < len(want) < 270
    for name in ("sv_triage", "fusion_reads"):
        assert "__cell" not in catalog.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()


def case(name, chroms, blocks):
    """Rows of one read over chromosomes of its own."""
    return {f"{name}_{c}": s for c, s in chroms.items()}, [("s", name, 99, a, b, "+", f"{name}_{c}", s, e, cs) for c, a, b, s, e, cs in blocks]


def world():
    plain = lambda left, right: {"x": "A" * 10 + left + "A" * 30, "y": "C" * 18 + right + "C" * 30}
    two = [("x", 0, 10, 0, 10, "10"), ("y", 10, 20, 20, 30, "10")]
    # an overlap of two query bases; donor bases stand at 1-based 9 to 12, acceptor bases at 19 to 22
    over = lambda d, a: {"x": "A" * 8 + d + "A" * 30, "y": "C" * 18 + a + "C" * 30}
    lap = lambda cs="10": [("x", 0, 10, 0, 10, cs), ("y", 8, 18, 20, 30, "10")]
    cases = [
        case("uni", plain("GT", "AG"), two),
        case("none", plain("AA", "CC"), two),
        case("saved", plain("AA", "CC"), two),
        case("many", over("GTGT", "AGAG"), lap()),
        case("cross", over("GTAA", "AGCC"), lap("5~gt4ag1")),
        case("bad", plain("GT", "AG"), [("x", 0, 10, 0, 10, "3~gt3ag4"), two[1]]),
        case("known", plain("GT", "AG"), [("x", 0, 10, 0, 10, "3~gt3ag4"), two[1]]),
        case("alone", plain("GT", "AG"), two),
        case("multi", {"x": "A" * 10 + "GT" + "A" * 30, "y": "C" * 18 + "AG" + "C" * 10 + "GT" + "C" * 30, "z": "C" * 18 + "AG" + "C" * 30}, [*two, ("z", 20, 30, 20, 30, "10")]),
        case("half", {"x": "A" * 10 + "GT" + "A" * 30, "y": "C" * 18 + "AG" + "C" * 10 + "CC" + "C" * 30, "z": "C" * 60}, [*two, ("z", 20, 30, 20, 30, "10")]),
    ]
    link = lambda n, a="x", b="y", p=15, q=15: ("s", f"{n}_{a}", p, "+", f"{n}_{b}", q, "-", "---")
    sv = [link("uni"), link("saved", p=10, q=20), link("many", p=5000), link("cross"), link("bad"), link("known"), link("multi"), link("multi", "y", "z", 35), link("half", "y", "z", 30, 20), ("other", "alone_x", 15, "+", "alone_y", 15, "-", "---")]
    genome = [x for g, _ in cases for x in g.items()]
    return genome, [r for _, rows in cases for r in rows] + [("s", "single", 9, 0, 9, "+", "uni_x", 0, 9, "9")], sv


def test_fusions(spark, tmp_path):
    genome, rows, sv = world()
    chunks = text.genome_chunks(spark.createDataFrame(genome, "id string, sequence string"), 7)
    known = spark.createDataFrame([("known_x", "+", 4, 6)], "chr string, strand string, start long, end long")
    out = fusion.find_fusions(spark.createDataFrame(rows, CAND), chunks, 7, [known], spark.createDataFrame(sv, SV))
    reads = {r.seq_id: tuple(r)[2:] for r in out.reads.collect()}
    assert reads == {
        "uni": ("full", "uni", None, False), "none": ("undetermined", None, "no_sj_candidate", False), "saved": ("undetermined", "uni", None, True),
        "many": ("undetermined", None, "multi_sj_candidate", False), "cross": ("full", None, "sv_sj_overlap", False), "bad": ("full", None, "improper_sj", False),
        "known": ("full", "uni", None, False), "alone": ("full", None, "sv_unmatch", False), "multi": ("full", "multi", None, False), "half": ("partial", "partial", None, False),
    }
    j = {(r.seq_id, r.sv_number): r for r in out.junctions.collect()}
    assert set(j) == {("uni", 1), ("saved", 1), ("known", 1), ("multi", 1), ("multi", 2), ("half", 1), ("half", 2)}
    assert (j["uni", 1].up_strand, j["uni", 1].down_strand, j["uni", 1].sv_up_pos, j["uni", 1].sv_type) == ("+", "-", 15, "sj_confirmed")
    assert (j["saved", 1].sv_type, j["half", 1].sv_up_pos, j["half", 2].sv_up_pos) == ("sj_not_confirmed", None, 30)
    exons = sorted((r.seq_id, r.exon_number, r.idx, r.start, r.end) for r in out.exons.collect())
    assert [e for e in exons if e[0] in ("uni", "known")] == [("known", 1, 1, 1, 3), ("known", 2, 1, 7, 10), ("known", 3, 2, 21, 30), ("uni", 1, 1, 1, 10), ("uni", 2, 2, 21, 30)]
    assert sorted((r.seq_id, r.type, r.var_start, r.var_end) for r in out.variants.collect()) == [("known", "~", 3, 6)]
    fusion.write_fusions(out, str(tmp_path / "f"))
    assert spark.read.parquet(str(tmp_path / "f/junctions")).filter("match_class = 'multi'").count() == 2
    assert spark.read.parquet(str(tmp_path / "f/reads")).count() == 10


def test_no_candidates(spark):
    genome, _, sv = world()
    chunks = text.genome_chunks(spark.createDataFrame(genome, "id string, sequence string"), 7)
    out = fusion.find_fusions(spark.createDataFrame([], CAND), chunks, 7, [], spark.createDataFrame(sv, SV))
    assert out.reads.count() == out.junctions.count() == out.exons.count() == 0
