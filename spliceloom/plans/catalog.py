"""Registered queries over the driver's tables, each with its SQL counterpart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import cs as CS
from ..functions import text as X
from ..operators import alignments as A
from ..operators import chains as CH
from ..operators import counts as CO
from ..operators import include as I
from ..operators import ranges as R
from ..operators import txjoin as TJ
from ..session import settled, table
from . import assembly as AS
from .views import COLLAPSED_SQL, I_SQL, T_SQL, TOK_SQL, TX, cs_rows, exons, intervals, transcripts

QUERIES: dict[str, Callable] = {}
SQL: dict[str, str] = {}
SAMPLES = ["s0", "s1", "s2", "s3"]
PLACE = ["seqname", "strand"]


def query(sql: str | None = None):
    """Registers a query under its function's name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


@query(f"WITH {TOK_SQL} SELECT id, pos, token FROM tok")
def cs_tokenize(spark, sf) -> DataFrame:
    return CS.tokens(cs_rows(spark, sf), ["id"]).select("id", F.col("pos").cast("long").alias("pos"), "token")


VAR_SQL = TOK_SQL + """,
w AS (SELECT *, CAST(CASE left(token, 1) WHEN '+' THEN 0 WHEN '-' THEN length(token) - 1 WHEN '*' THEN 1
        WHEN '~' THEN CAST(regexp_extract(token, '([0-9]+)', 1) AS BIGINT) ELSE CAST(token AS BIGINT) END AS BIGINT) AS width FROM tok),
v AS (SELECT *, "start" + CAST(SUM(width) OVER (PARTITION BY id ORDER BY pos) AS BIGINT) AS var_end FROM w),
va AS (SELECT id, pos, left(token, 1) AS type, var_end - width AS var_start, var_end,
       CASE left(token, 1) WHEN '*' THEN substr(token, 2, 1) WHEN '-' THEN substr(token, 2) END AS ref,
       CASE left(token, 1) WHEN '*' THEN substr(token, 3, 1) WHEN '+' THEN substr(token, 2) END AS alt
       FROM v WHERE NOT regexp_matches(token, '^[0-9]'))"""


@query(f"WITH {VAR_SQL} SELECT * FROM va")
def cs_variants(spark, sf) -> DataFrame:
    return CS.variants(cs_rows(spark, sf), ["id"]).withColumn("pos", F.col("pos").cast("long"))


@query("SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_orderkey IN (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING bool_and(l_quantity > 10))")
def mapq_all_pass(spark, sf) -> DataFrame:
    return A.quality_filter(table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity"), 10, ["l_orderkey"], "l_quantity")


_L = "SELECT l_orderkey, l_linenumber, l_partkey, COUNT(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem"


@query(f"SELECT l_orderkey, l_linenumber, l_partkey FROM ({_L}) WHERE n > 1")
def chimera_split(spark, sf) -> DataFrame:
    return A.split_chimeras(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), ["l_orderkey", "l_linenumber"])[1]


@query(f"SELECT l_orderkey, l_linenumber, l_partkey FROM ({_L}) WHERE n = 1")
def unique_only(spark, sf) -> DataFrame:
    return A.unique_only(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), ["l_orderkey", "l_linenumber"])


@query("SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING COUNT(DISTINCT (l_returnflag, l_linestatus)) > 1")
def chimeric_ids(spark, sf) -> DataFrame:
    return A.chimeric_ids(table(spark, sf, "lineitem"), ["l_orderkey"], ["l_returnflag", "l_linestatus"])


_INTRON = T_SQL + """,
i AS (SELECT tx, sample, seqname, strand, "end" + 1 AS "start", LEAD("start") OVER (PARTITION BY tx ORDER BY "start") - 1 AS "end" FROM ex)"""


@query(f'WITH {_INTRON} SELECT * FROM i WHERE "end" IS NOT NULL')
def introns_from_exons(spark, sf) -> DataFrame:
    return A.introns_of_exons(exons(spark, sf), TX)


@query(f'WITH {T_SQL} SELECT tx, "start", "end" FROM ex')
def exons_from_introns(spark, sf) -> DataFrame:
    e = exons(spark, sf).withColumnsRenamed({"tx": "seq_id", "seqname": "chr"}).withColumn("aln", F.lit(1))
    key = [*A.ALN, "chr", "strand"]
    whole = R.extents(e, key).select(*key, (F.col("start") - 1).alias("start"), "end")
    gaps = A.introns_of_exons(e, key).select(*key, (F.col("start") - 1).alias("var_start"), F.col("end").alias("var_end"))
    gaps = gaps.join(whole.withColumnsRenamed({"start": "tx_start", "end": "tx_end"}), key)
    return A.exons_of(whole, gaps).select(F.col("seq_id").alias("tx"), "start", "end")


@query(f"WITH {T_SQL} SELECT tx, sample, seqname, strand, structure FROM t")
def gather_exon(spark, sf) -> DataFrame:
    return CH.gather_exons(exons(spark, sf), TX).drop("exons")


@query(f"WITH {T_SQL} SELECT tx, sample, seqname, strand, tx_start, tx_end, chain FROM t")
def separate_ends(spark, sf) -> DataFrame:
    return transcripts(spark, sf)


@query(f'WITH {T_SQL} SELECT tx, sample, seqname, strand, "start", "end" FROM ex')
def gtf_longer(spark, sf) -> DataFrame:
    return CH.exon_rows(CH.gather_exons(exons(spark, sf), TX).drop("exons"))


@query(f"WITH {T_SQL} SELECT tx, sample, seqname, strand, n_exons FROM t")
def count_exon(spark, sf) -> DataFrame:
    return CH.count_exons(exons(spark, sf), TX)


@query(f"WITH {T_SQL} SELECT tx FROM t WHERE n_exons >= 2")
def multi_exon_list(spark, sf) -> DataFrame:
    return CO.multi_exon_ids(exons(spark, sf).withColumnRenamed("tx", "transcript_id")).withColumnRenamed("transcript_id", "tx")


def _collapsed(spark, sf) -> tuple[DataFrame, DataFrame]:
    t = transcripts(spark, sf)
    multi = CH.chain_sizes(t, "tx", PLACE).select(*PLACE, "chain", "tx_start", "tx_end", "n", "k")
    mono = CH.mono_sizes(t, "tx", PLACE).select(*PLACE, "tx_start", "tx_end", "n", "k")
    return multi, mono


@query(f"WITH {COLLAPSED_SQL} SELECT seqname, strand, chain, tx_start, tx_end, n, k FROM multi")
def chain_collapse(spark, sf) -> DataFrame:
    return _collapsed(spark, sf)[0]


@query(f"WITH {COLLAPSED_SQL} SELECT * FROM mono")
def mono_collapse(spark, sf) -> DataFrame:
    return _collapsed(spark, sf)[1]


def _include_sql(on: str) -> str:
    return f"""WITH {COLLAPSED_SQL},
j AS (SELECT q.k AS query, s.k AS subject, q.tx_start AS qs, q.tx_end AS qe, q.chain AS qc,
        CAST(s.tx_start AS VARCHAR) || s.chain || CAST(s.tx_end AS VARCHAR) AS f
      FROM multi q JOIN multi s ON q.seqname = s.seqname AND q.strand = s.strand {on} AND q.chain <> s.chain AND contains(s.chain, q.chain)),
p AS (SELECT query, subject FROM j
      WHERE CAST(regexp_extract(substr(f, 1, instr(f, qc) - 1), '([0-9]+)$', 1) AS BIGINT) <= qs
        AND qe <= CAST(regexp_extract(substr(f, instr(f, qc) + length(qc)), '^([0-9]+)', 1) AS BIGINT))
SELECT query, subject FROM p WHERE subject NOT IN (SELECT query FROM p)"""


@query(_include_sql("AND q.last = s.last"))
def include_5prime(spark, sf) -> DataFrame:
    return I.include_truncated(_collapsed(spark, sf)[0], "k")


@query(_include_sql(""))
def include_nested(spark, sf) -> DataFrame:
    return I.include_truncated(_collapsed(spark, sf)[0], "k", same_end=False)


@query(f"""WITH {COLLAPSED_SQL},
te AS (SELECT tx, seqname, strand, CASE WHEN strand = '-' THEN arg_min("start", "start") ELSE arg_max("start", "start") END AS s,
       CASE WHEN strand = '-' THEN arg_min("end", "start") ELSE arg_max("end", "start") END AS e FROM ex GROUP BY tx, seqname, strand HAVING COUNT(*) > 1)
SELECT m.k AS query, te.tx AS subject FROM mono m JOIN te ON m.seqname = te.seqname AND m.strand = te.strand AND te.s <= m.tx_start AND m.tx_end <= te.e""")
def mono_in_last_exon(spark, sf) -> DataFrame:
    e = exons(spark, sf)
    multi = e.join(CH.count_exons(e, ["tx"]).filter("n_exons > 1").select("tx"), "tx", "left_semi")
    last = R.terminal_exons(multi, ["tx", *PLACE]).withColumnRenamed("tx", "k")
    return I.mono_in_exons(_collapsed(spark, sf)[1], last, "k")


@query(f"""WITH {I_SQL},
p AS (SELECT a.id AS query, b.id AS subject FROM iv a JOIN iv b ON a.g = b.g AND a.st = b.st AND b.s <= a.s AND a.e <= b.e AND (a.s <> b.s OR a.e <> b.e))
SELECT query, subject FROM p WHERE subject NOT IN (SELECT query FROM p)""")
def mono_in_mono(spark, sf) -> DataFrame:
    return I.mono_in_mono(intervals(spark, sf).withColumnsRenamed({"s": "tx_start", "e": "tx_end"}), "id", ("g", "st"))


def _two(spark, sf, with_exons: bool = False) -> tuple[DataFrame, DataFrame]:
    """The transcripts of samples 0 and 1, and those of samples 2 and 3."""
    t = transcripts(spark, sf, with_exons)
    early = F.col("sample").isin("s0", "s1")
    return t.filter(early).drop("sample"), t.filter(~early).drop("sample")


def _pairs(df: DataFrame) -> DataFrame:
    return df.select("tx", "tx_y")


_XY = T_SQL + ", x AS (SELECT * FROM t WHERE sample IN ('s0', 's1')), y AS (SELECT * FROM t WHERE sample NOT IN ('s0', 's1'))"
_ON = "x.seqname = y.seqname AND x.strand = y.strand"
_MATCH = f"SELECT x.tx, y.tx AS tx_y FROM x JOIN y ON {_ON} AND x.chain = y.chain WHERE x.chain <> '-'"
_OVER = f"SELECT x.tx, y.tx AS tx_y FROM x JOIN y ON {_ON} AND x.tx_start <= y.tx_end AND y.tx_start <= x.tx_end WHERE x.chain = '-' AND y.chain = '-'"


@query(f"WITH {_XY} {_MATCH}")
def tx_join_intronic_match(spark, sf) -> DataFrame:
    x, y = _two(spark, sf)
    return _pairs(TJ.intronic_match(x.drop("tx_start", "tx_end"), y.drop("tx_start", "tx_end"), PLACE))


@query(f"WITH {_XY} SELECT x.tx, y.tx AS tx_y FROM x JOIN y ON {_ON} AND x.chain = y.chain WHERE y.tx_start <= x.tx_start AND x.tx_end <= y.tx_end")
def tx_join_intronic_include(spark, sf) -> DataFrame:
    return _pairs(TJ.intronic_include(*_two(spark, sf), PLACE))


@query(f"WITH {_XY} {_OVER}")
def tx_join_singleexon_overlap(spark, sf) -> DataFrame:
    return _pairs(TJ.singleexon_overlap(*_two(spark, sf), PLACE))


@query(f"WITH {_XY} {_MATCH} UNION ALL {_OVER}")
def tx_join_edge_tolerate(spark, sf) -> DataFrame:
    return _pairs(TJ.edge_tolerate_match(*_two(spark, sf), PLACE))


@query(f"""WITH {_XY},
c AS (SELECT x.tx, y.tx AS tx_y, x.tx_start AS s, x.tx_end AS e, x.chain AS c FROM x JOIN y ON {_ON} AND contains(y.chain, x.chain) AND y.tx_start <= x.tx_start AND x.tx_end <= y.tx_end),
h AS (SELECT c.tx, c.tx_y, c.c, bool_or(ex."start" <= c.s AND c.s <= ex."end") AS hs, bool_or(ex."start" <= c.e AND c.e <= ex."end") AS he FROM c JOIN ex ON ex.tx = c.tx_y GROUP BY 1, 2, 3)
SELECT tx, tx_y FROM h WHERE hs AND he""")
def tx_join_include(spark, sf) -> DataFrame:
    x, y = _two(spark, sf, True)
    return _pairs(TJ.include(x.drop("exons"), y, PLACE))


_SHAPES = "x.seqname, x.strand, x.chain, x.tx_start, x.tx_end, y.chain AS chain_y, y.tx_start AS tx_start_y, y.tx_end AS tx_end_y"


@query(f"""WITH {_XY},
c AS (SELECT x.tx, y.tx AS tx_y, x.tx_start AS s, x.tx_end AS e FROM x JOIN y ON {_ON} AND contains(y.chain, x.chain) AND y.tx_start <= x.tx_start AND x.tx_end <= y.tx_end),
h AS (SELECT c.tx, c.tx_y, bool_or(ex."start" <= c.s AND c.s <= ex."end") AS hs, bool_or(ex."start" <= c.e AND c.e <= ex."end") AS he FROM c JOIN ex ON ex.tx = c.tx_y GROUP BY 1, 2)
SELECT DISTINCT 'include' AS kind, {_SHAPES} FROM h JOIN x ON x.tx = h.tx JOIN y ON y.tx = h.tx_y WHERE hs AND he
UNION ALL SELECT DISTINCT 'match', {_SHAPES} FROM x JOIN y ON {_ON} AND x.chain = y.chain WHERE x.chain <> '-'
UNION ALL SELECT DISTINCT 'overlap', {_SHAPES} FROM x JOIN y ON {_ON} AND x.tx_start <= y.tx_end AND y.tx_start <= x.tx_end WHERE x.chain = '-' AND y.chain = '-'""")
def tx_join_structures(spark, sf) -> DataFrame:
    x, y = _two(spark, sf, True)
    kinds = {"include": (TJ.include, y), "match": (TJ.intronic_match, y.drop("exons")), "overlap": (TJ.singleexon_overlap, y.drop("exons"))}
    out = [TJ.of_structures(f, x, right, PLACE).withColumn("kind", F.lit(k)) for k, (f, right) in kinds.items()]
    return out[0].unionByName(out[1]).unionByName(out[2])


_ISLANDS = I_SQL + """,
a AS (SELECT *, MAX(e) OVER (PARTITION BY g, st ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pe FROM iv),
b AS (SELECT *, SUM(CASE WHEN pe IS NULL OR s > pe + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY g, st ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island FROM a),
r AS (SELECT g, st, CAST(island AS BIGINT) AS island, MIN(s) AS "start", MAX(e) AS "end" FROM b GROUP BY 1, 2, 3)"""


@query(f"WITH {_ISLANDS} SELECT * FROM r")
def locus_reduce(spark, sf) -> DataFrame:
    return R.reduced(intervals(spark, sf), ["g", "st"], "s", "e")


@query(f'WITH {_ISLANDS} SELECT g, st, island, "start", "end", row_number() OVER (ORDER BY g, st, island) AS locus FROM r')
def locus_ids(spark, sf) -> DataFrame:
    return R.numbered(settled(R.reduced(intervals(spark, sf), ["g", "st"], "s", "e")), ["g", "st", "island"], "locus")


_MERGED = COLLAPSED_SQL + """,
te AS (SELECT m.k, ex.seqname, ex.strand, ex."start" AS s, ex."end" AS e FROM ex JOIN (SELECT MIN(tx) AS k, MIN(tx_start) AS a, MAX(tx_end) AS b, seqname, strand, chain FROM t WHERE chain <> '-' GROUP BY seqname, strand, chain) m ON ex.tx = m.k),
f AS (SELECT k, seqname, strand, CASE WHEN s = MIN(s) OVER (PARTITION BY k) THEN (SELECT tx_start FROM multi WHERE multi.k = te.k) ELSE s END AS s,
      CASE WHEN e = MAX(e) OVER (PARTITION BY k) THEN (SELECT tx_end FROM multi WHERE multi.k = te.k) ELSE e END AS e FROM te),
im AS (SELECT DISTINCT mono.k FROM mono JOIN f ON mono.seqname = f.seqname AND mono.strand = f.strand AND f.s <= mono.tx_start AND mono.tx_end <= f.e),
fr AS (SELECT * FROM mono WHERE k NOT IN (SELECT k FROM im)),
fm AS (SELECT DISTINCT a.k FROM fr a JOIN fr b ON a.seqname = b.seqname AND a.strand = b.strand AND b.tx_start <= a.tx_start AND a.tx_end <= b.tx_end AND a.k <> b.k)
SELECT seqname, strand, '-' AS chain, tx_start, tx_end FROM fr WHERE k NOT IN (SELECT k FROM fm)
UNION ALL SELECT seqname, strand, chain, tx_start, tx_end FROM multi"""


@query(f"WITH {_MERGED}")
def inter_merge(spark, sf) -> DataFrame:
    tx, _ = AS.assemble(exons(spark, sf), PLACE, ["sample", "tx"], truncation=False)
    return tx.select("seqname", "strand", "chain", "tx_start", "tx_end")


_SAME = lambda a, b: f"{a}.sample = {b}.sample AND {a}.seqname = {b}.seqname AND {a}.strand = {b}.strand"
_WITHIN = T_SQL + f""",
m AS (SELECT sample, seqname, strand, chain, MIN(tx_start) AS s, MAX(tx_end) AS e FROM t WHERE chain <> '-' GROUP BY ALL),
mi AS (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY seqname, strand, chain) AS i, CAST(CASE WHEN strand = '-' THEN regexp_extract(chain, '^-([0-9]+) ', 1) ELSE regexp_extract(chain, ' ([0-9]+)-$', 1) END AS BIGINT) AS last FROM m),
o AS (SELECT DISTINCT sample, seqname, strand, tx_start AS s, tx_end AS e FROM t WHERE chain = '-'),
oi AS (SELECT *, -row_number() OVER (PARTITION BY sample ORDER BY seqname, strand, s, e) AS i FROM o),
j AS (SELECT q.sample, q.i AS q, u.i AS u, q.s AS qs, q.e AS qe, q.chain AS qc, CAST(u.s AS VARCHAR) || u.chain || CAST(u.e AS VARCHAR) AS f
      FROM mi q JOIN mi u ON {_SAME("q", "u")} AND q.last = u.last AND q.chain <> u.chain AND contains(u.chain, q.chain)),
p AS (SELECT sample, q, u FROM j WHERE CAST(regexp_extract(substr(f, 1, instr(f, qc) - 1), '([0-9]+)$', 1) AS BIGINT) <= qs
      AND qe <= CAST(regexp_extract(substr(f, instr(f, qc) + length(qc)), '^([0-9]+)', 1) AS BIGINT)),
c AS (SELECT * FROM p WHERE (sample, u) NOT IN (SELECT (sample, q) FROM p)),
km AS (SELECT * FROM mi WHERE (sample, i) NOT IN (SELECT (sample, q) FROM c)),
te AS (SELECT sample, seqname, strand, i, CASE WHEN strand = '-' THEN s ELSE last END AS a, CASE WHEN strand = '-' THEN last ELSE e END AS b FROM km),
im AS (SELECT DISTINCT oi.sample, oi.i AS q, te.i AS u FROM oi JOIN te ON {_SAME("oi", "te")} AND te.a <= oi.s AND oi.e <= te.b),
fr AS (SELECT * FROM oi WHERE (sample, i) NOT IN (SELECT (sample, q) FROM im)),
ko AS (SELECT * FROM fr x WHERE NOT EXISTS (SELECT 1 FROM fr y WHERE {_SAME("x", "y")} AND y.s <= x.s AND x.e <= y.e AND x.i <> y.i)),
io AS (SELECT oi.sample, oi.i AS q, ko.i AS u FROM oi JOIN ko ON {_SAME("oi", "ko")} AND ko.s <= oi.s AND oi.e <= ko.e AND oi.i <> ko.i),
n AS (SELECT sample, seqname, strand, s, e, i FROM km UNION ALL SELECT sample, seqname, strand, s, e, i FROM ko),
il AS (SELECT *, MAX(e) OVER (PARTITION BY sample, seqname, strand ORDER BY s, e, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pe FROM n),
isl AS (SELECT *, SUM(CASE WHEN pe IS NULL OR s > pe + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY sample, seqname, strand ORDER BY s, e, i ROWS UNBOUNDED PRECEDING) AS island FROM il),
g AS (SELECT *, dense_rank() OVER (PARTITION BY sample ORDER BY seqname, strand, island) AS gene FROM isl),
d AS (SELECT sample, i, 'PB.' || CAST(gene AS VARCHAR) AS gene_id, 'PB.' || CAST(gene AS VARCHAR) || '.' || CAST(row_number() OVER (PARTITION BY sample, gene ORDER BY i) AS VARCHAR) AS transcript_id FROM g),
lk AS (SELECT sample, i AS q, i AS u, CASE WHEN i > 0 THEN 'intronic_match_include' ELSE 'monoex_match' END AS type FROM n
       UNION ALL SELECT sample, q, u, 'include' FROM c UNION ALL SELECT sample, q, u, 'include' FROM im UNION ALL SELECT sample, q, u, 'include' FROM io),
r AS (SELECT t.sample, CAST(t.tx AS VARCHAR) AS seq_id, COALESCE(mi.i, oi.i) AS i FROM t LEFT JOIN mi ON {_SAME("t", "mi")} AND t.chain = mi.chain
      LEFT JOIN oi ON {_SAME("t", "oi")} AND t.chain = '-' AND t.tx_start = oi.s AND t.tx_end = oi.e)"""


@query(f"WITH {_WITHIN} SELECT r.sample, d.gene_id, d.transcript_id, r.seq_id, lk.type FROM r JOIN lk ON r.sample = lk.sample AND r.i = lk.q JOIN d ON d.sample = lk.sample AND d.i = lk.u")
def intra_merge(spark, sf) -> DataFrame:
    return AS.within_samples(exons(spark, sf).withColumn("seq_id", F.col("tx").cast("string")).drop("tx"))[1]


@query("""SELECT o_orderkey, CASE WHEN a = b THEN a ELSE 'include' END AS type FROM (
  SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'include' WHEN 1 THEN 'monoex_match' ELSE 'intronic_match_include' END AS a,
         CASE o_custkey % 3 WHEN 0 THEN 'include' WHEN 1 THEN 'monoex_match' ELSE 'intronic_match_include' END AS b FROM orders)""")
def type_lattice(spark, sf) -> DataFrame:
    kind = lambda c: F.when(F.col(c) % 3 == 0, AS.INCLUDE).when(F.col(c) % 3 == 1, AS.MONO).otherwise(AS.MATCH)
    return table(spark, sf, "orders").select("o_orderkey", AS.joined_type(kind("o_orderkey"), kind("o_custkey")).alias("type"))


def _links(spark, sf) -> DataFrame:
    """Line items as read links: gene by part, transcript by part and supplier, read by order."""
    return table(spark, sf, "lineitem").select(
        (F.col("l_partkey") % 50).alias("gene_id"), F.concat_ws(".", (F.col("l_partkey") % 50).cast("string"), (F.col("l_suppkey") % 3).cast("string")).alias("transcript_id"),
        F.concat(F.lit("s"), (F.col("l_orderkey") % 4).cast("string")).alias("sample"), F.concat_ws("/", F.lit("f"), F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("seq_id"),
        F.floor("l_quantity").alias("fl"), F.when(F.col("l_tax") > 0.04, AS.MATCH).otherwise(AS.INCLUDE).alias("type"),
    )


_LINKS = """
k AS (SELECT l_partkey % 50 AS gene_id, CAST(l_partkey % 50 AS VARCHAR) || '.' || CAST(l_suppkey % 3 AS VARCHAR) AS transcript_id,
      's' || CAST(l_orderkey % 4 AS VARCHAR) AS sample, 'f/' || CAST(l_orderkey AS VARCHAR) || '/' || CAST(l_linenumber AS VARCHAR) AS seq_id,
      CAST(floor(l_quantity) AS BIGINT) AS fl, CASE WHEN l_tax > 0.04 THEN 'intronic_match_include' ELSE 'include' END AS type FROM lineitem),
u AS (SELECT *, COUNT(*) OVER (PARTITION BY sample, seq_id) AS n FROM k)"""
_WIDE = ", ".join(f"CAST(COALESCE(SUM(fl) FILTER (WHERE sample = '{s}'), 0) AS BIGINT) AS {s}" for s in SAMPLES)
_PRESENT = ", ".join(f"COALESCE(bool_or(sample = '{s}'), FALSE) AS {s}" for s in SAMPLES)


@query(f"WITH {_LINKS} SELECT gene_id, transcript_id, {_WIDE} FROM u WHERE n = 1 GROUP BY 1, 2")
def pbcount_matrix(spark, sf) -> DataFrame:
    return CO.matrix(CO.support(_links(spark, sf)), CO.TX, "count_fl", SAMPLES)


@query(f"WITH {_LINKS} SELECT gene_id, {_WIDE} FROM u WHERE n = 1 GROUP BY 1")
def gene_count_matrix(spark, sf) -> DataFrame:
    return CO.matrix(CO.support(_links(spark, sf), ["gene_id"]), ["gene_id"], "count_fl", SAMPLES)


@query(f"""WITH {_LINKS},
p AS (SELECT DISTINCT gene_id, transcript_id, sample FROM u WHERE CASE WHEN gene_id % 2 = 0 THEN type = 'intronic_match_include' ELSE n = 1 END)
SELECT gene_id, transcript_id, {_PRESENT} FROM p GROUP BY 1, 2""")
def existence_matrix(spark, sf) -> DataFrame:
    links = _links(spark, sf)
    multi = links.filter("gene_id % 2 = 0").select("transcript_id").distinct()
    return CO.matrix(CO.presence(links, multi), CO.TX, "present", SAMPLES, fill=False)


_TYPES = ["click", "view", "purchase"]


_EVERY = [*_TYPES, "signup", "error"]


@query('SELECT user_id AS "Name", ' + ", ".join(f"CAST(NULLIF(COUNT(*) FILTER (WHERE event_type = '{t}'), 0) AS VARCHAR) AS {t}" for t in _EVERY) + " FROM events GROUP BY 1")
def expression_matrix(spark, sf) -> DataFrame:
    e = table(spark, sf, "events").groupBy(F.col("user_id").alias("Name"), F.col("event_type").alias("sample")).agg(F.count(F.lit(1)).cast("string").alias("n"))
    return CO.expression(e, "n", _EVERY)


@query("""SELECT sample, cluster_id, COUNT(*) FILTER (WHERE l_returnflag = 'R') AS fl, COUNT(*) FILTER (WHERE l_returnflag IN ('A', 'N')) AS nfl
FROM (SELECT l_returnflag, 's' || CAST(l_orderkey % 4 AS VARCHAR) AS sample, CAST(l_partkey AS VARCHAR) AS cluster_id FROM lineitem) GROUP BY 1, 2""")
def cluster_report_counts(spark, sf) -> DataFrame:
    flag = F.col("l_returnflag")
    r = table(spark, sf, "lineitem").select(
        F.concat(F.lit("s"), (F.col("l_orderkey") % 4).cast("string")).alias("sample"), F.col("l_partkey").cast("string").alias("cluster_id"),
        F.when(flag == "R", "FL").when(flag == "A", "nFL").when(flag == "N", "nonFL").alias("read_type"),
    )
    return CO.cluster_counts(r)


@query("SELECT l_orderkey, l_linenumber, CAST(l_linenumber AS BIGINT) AS fl, CAST(floor(l_quantity) AS BIGINT) AS nfl FROM lineitem")
def counts_from_ids(spark, sf) -> DataFrame:
    line = table(spark, sf, "lineitem").withColumn("id", F.format_string("c%d/f%dp%d", "l_orderkey", F.col("l_linenumber").cast("long"), F.floor("l_quantity").cast("long")))
    fl, nfl = CO.counts_in_id(F.col("id"))
    return line.select("l_orderkey", "l_linenumber", fl.alias("fl"), nfl.alias("nfl"))


@query(f"""WITH {T_SQL} SELECT sample, tx AS seq_id, chain, seqname AS chr, strand, tx_start AS "start", tx_end AS "end" FROM t WHERE chain <> '-'""")
def range_link(spark, sf) -> DataFrame:
    t = transcripts(spark, sf).withColumnsRenamed({"tx": "seq_id", "seqname": "chr"})
    rows = t.withColumns({"type": F.when(CH.is_multi(), "~").otherwise("*"), "tx_start": F.col("tx_start") - 1})
    return CO.range_links(t.select("sample", "seq_id", "chain"), rows)


@query("SELECT p_partkey, reverse(translate(upper(p_name), 'ACGT', 'TGCA')) AS rc FROM part")
def reverse_complement(spark, sf) -> DataFrame:
    return table(spark, sf, "part").select("p_partkey", X.reverse_complement(F.upper("p_name")).alias("rc"))


@query("""SELECT o_orderkey, (d = 'GT' AND a = 'AG') OR (d = 'GC' AND a = 'AG') OR (d = 'AT' AND a = 'AC') AS canonical FROM (
SELECT o_orderkey, ['GT', 'GC', 'AT', 'CC'][CAST(o_orderkey % 4 + 1 AS INT)] AS d, ['AG', 'AC', 'TT'][CAST(o_custkey % 3 + 1 AS INT)] AS a FROM orders)""")
def canonical_sites(spark, sf) -> DataFrame:
    pick = lambda values, c: F.get(F.array(*map(F.lit, values)), (F.col(c) % len(values)).cast("int"))
    return table(spark, sf, "orders").select("o_orderkey", X.is_canonical(pick(["GT", "GC", "AT", "CC"], "o_orderkey"), pick(["AG", "AC", "TT"], "o_custkey")).alias("canonical"))


_GTF = """SELECT p_partkey, p_brand AS gene_id, p_name AS note, p_type AS kind FROM part"""


@query(_GTF)
def gtf_attributes(spark, sf) -> DataFrame:
    from ..sources.text import attributes

    p = table(spark, sf, "part").select("p_partkey", attributes(F.format_string('gene_id "%s"; note "%s"; kind "%s";', "p_brand", "p_name", "p_type")).alias("m"))
    return p.select("p_partkey", F.col("m")["gene_id"].alias("gene_id"), F.col("m")["note"].alias("note"), F.col("m")["kind"].alias("kind"))


@query("SELECT o_custkey AS k, 'both' AS side FROM orders INTERSECT SELECT c_custkey, 'both' FROM customer UNION ALL (SELECT c_custkey, 'only' FROM customer EXCEPT SELECT o_custkey, 'only' FROM orders)")
def set_ops(spark, sf) -> DataFrame:
    o, c = table(spark, sf, "orders").select(F.col("o_custkey").alias("k")), table(spark, sf, "customer").select(F.col("c_custkey").alias("k"))
    both = o.intersect(c).withColumn("side", F.lit("both"))
    return both.unionByName(c.distinct().join(o, "k", "left_anti").withColumn("side", F.lit("only")))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey) AS r FROM lineitem) WHERE r = 1")
def distinct_first(spark, sf) -> DataFrame:
    return A.first_of(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey"])


@query("SELECT 'reads' AS name, COUNT(DISTINCT l_orderkey) AS n FROM lineitem UNION ALL SELECT 'parts', COUNT(DISTINCT p_partkey) FROM part UNION ALL SELECT 'users', COUNT(DISTINCT user_id) FROM events")
def number_report(spark, sf) -> DataFrame:
    return CO.number_report({"reads": (table(spark, sf, "lineitem"), ["l_orderkey"]), "parts": (table(spark, sf, "part"), ["p_partkey"]), "users": (table(spark, sf, "events"), ["user_id"])})


@query(f"""WITH {I_SQL} SELECT id, g, row_number() OVER w AS idx, LAG(e) OVER w - s AS acceptor_overlap, e - LEAD(s) OVER w AS donor_overlap FROM iv WINDOW w AS (PARTITION BY g ORDER BY s, e, id)""")
def block_overlap(spark, sf) -> DataFrame:
    from ..operators.fusions import overlaps

    return overlaps(intervals(spark, sf), ["g"], "s", "e", ["id"]).select("id", "g", F.col("idx").cast("long").alias("idx"), "acceptor_overlap", "donor_overlap")


@query(f"""WITH {I_SQL}, b AS (SELECT g, e AS up_pos, st AS up_chr, LEAD(s) OVER w AS down_pos, LEAD(st) OVER w AS down_chr, row_number() OVER w AS sv_number FROM iv WINDOW w AS (PARTITION BY g ORDER BY s, e, id))
SELECT * FROM b WHERE down_chr IS NOT NULL""")
def breakpoint_pairs(spark, sf) -> DataFrame:
    from ..operators.fusions import next_pairs

    w = intervals(spark, sf)
    out = next_pairs(w, ["g"], ["s", "e", "id"], {"up_pos": "e", "up_chr": "st"}, {"down_pos": "s", "down_chr": "st"}, "sv_number")
    return out.select("g", "up_pos", "up_chr", "down_pos", "down_chr", F.col("sv_number").cast("long").alias("sv_number"))


@query(f"""WITH {T_SQL} SELECT tx, "start", row_number() OVER (PARTITION BY tx ORDER BY CASE WHEN strand = '+' THEN "start" ELSE -"start" END) AS exon_number FROM ex""")
def exon_number(spark, sf) -> DataFrame:
    from ..operators.fusions import exon_numbers

    return exon_numbers(exons(spark, sf), ["tx"]).select("tx", "start", "exon_number")


_CALLS = f"""WITH {VAR_SQL},
c AS (SELECT DISTINCT id, type, var_start + id % 3 AS var_start, var_end + id % 3 AS var_end, ref, alt FROM va WHERE type <> '~')"""


def _variant_sets(spark, sf) -> tuple[DataFrame, DataFrame]:
    v = cs_variants(spark, sf).drop("pos").filter("type <> '~'").withColumnsRenamed({"var_start": "start", "var_end": "end"})
    calls = v.withColumns({"start": F.col("start") + F.col("id") % 3, "end": F.col("end") + F.col("id") % 3}).distinct()
    return v, calls


@query(f"{_CALLS} SELECT id, type, var_start AS \"start\", var_end AS \"end\", ref, alt FROM va WHERE type <> '~' AND EXISTS (SELECT 1 FROM c WHERE c.id = va.id AND c.type = va.type AND c.var_start = va.var_start AND c.var_end = va.var_end AND c.ref IS NOT DISTINCT FROM va.ref AND c.alt IS NOT DISTINCT FROM va.alt)")
def variant_exact(spark, sf) -> DataFrame:
    from ..operators.mutations import exact

    v, c = _variant_sets(spark, sf)
    return exact(v, c, ["id", "type", "start", "end"])


_INS = """WITH a AS (SELECT o_orderkey AS id, o_custkey % 50 AS "start", repeat(['g', 'at', 'c'][CAST(o_orderkey % 3 + 1 AS INT)], CAST(o_orderkey % 4 + 1 AS INT)) AS alt FROM orders),
b AS (SELECT DISTINCT p_partkey % 50 AS "start", ['g', 'at', 'c'][CAST(p_size % 3 + 1 AS INT)] AS alt FROM part)"""


@query(_INS + ' SELECT id, a."start", b.alt FROM a JOIN b ON a."start" = b."start" AND contains(a.alt, b.alt)')
def variant_ins_inclusion(spark, sf) -> DataFrame:
    from ..operators.mutations import insertion_inclusion

    pick = lambda c: F.get(F.array(F.lit("g"), F.lit("at"), F.lit("c")), (F.col(c) % 3).cast("int"))
    a = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), (F.col("o_custkey") % 50).alias("start"), F.repeat(pick("o_orderkey"), (F.col("o_orderkey") % 4 + 1).cast("int")).alias("alt"))
    b = table(spark, sf, "part").select((F.col("p_partkey") % 50).alias("start"), pick("p_size").alias("alt")).distinct()
    return insertion_inclusion(a, b, ["start"]).select("id", "start", "alt")


@query("""WITH a AS (SELECT o_orderkey AS id, o_custkey % 200 AS "start", o_custkey % 200 + 6 AS "end", substr('acgtacgtacgt', CAST(o_orderkey % 4 + 1 AS INT), 6) AS ref FROM orders),
b AS (SELECT DISTINCT p_partkey % 200 AS "start", p_partkey % 200 + 2 AS "end", substr('acgtac', CAST(p_size % 4 + 1 AS INT), 2) AS ref FROM part)
SELECT id, b."start", b."end", b.ref FROM a JOIN b ON a."start" <= b."start" AND b."end" <= a."end" AND substr(a.ref, CAST(b."start" - a."start" + 1 AS INT), 2) = b.ref""")
def variant_del_inclusion(spark, sf) -> DataFrame:
    from ..operators.mutations import deletion_inclusion

    a = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), (F.col("o_custkey") % 200).alias("start"), (F.col("o_custkey") % 200 + 6).alias("end"), F.substr(F.lit("acgtacgtacgt"), (F.col("o_orderkey") % 4 + 1).cast("int"), F.lit(6)).alias("ref"))
    b = table(spark, sf, "part").select((F.col("p_partkey") % 200).alias("start"), (F.col("p_partkey") % 200 + 2).alias("end"), F.substr(F.lit("acgtac"), (F.col("p_size") % 4 + 1).cast("int"), F.lit(2)).alias("ref")).distinct()
    return deletion_inclusion(a, b, []).select("id", "start", "end", "ref")


@query(f"""WITH {VAR_SQL}, n AS (SELECT *, LEAD(type) OVER w AS nt, LEAD(var_start) OVER w AS ns, LEAD(var_end) OVER w AS ne, LAG(type) OVER w AS pt, LAG(var_start) OVER w AS ps, LAG(var_end) OVER w AS pe FROM va WINDOW w AS (PARTITION BY id ORDER BY pos))
SELECT id, pos, type, var_start AS "start", CASE WHEN type = '+' AND nt = '-' AND ns = var_start THEN ne WHEN type = '+' AND pt = '-' AND pe = var_start THEN ps END AS another_start FROM n""")
def variant_alt_start(spark, sf) -> DataFrame:
    from ..operators.mutations import another_start

    v = cs_variants(spark, sf).withColumnsRenamed({"var_start": "start", "var_end": "end"})
    return another_start(v, ["id"], gap="-").select("id", "pos", "type", "start", "another_start")


_SV = f"""WITH {I_SQL},
j AS (SELECT id, 's' || CAST(g % 4 AS VARCHAR) AS sample, st AS up_chr, CASE WHEN g % 2 = 0 THEN '+' ELSE '-' END AS up_strand, s // 5000 % 5 * 1000000 + s % 5000 AS up_pos, 'c' || CAST(g % 2 AS VARCHAR) AS down_chr, CASE WHEN id % 2 = 0 THEN '+' ELSE '-' END AS down_strand, e // 5000 % 5 * 1000000 + e % 5000 AS down_pos FROM iv),
v AS (SELECT o_orderkey AS sv, 's' || CAST(o_custkey % 4 AS VARCHAR) AS sample, ['click', 'view', 'purchase'][CAST(o_orderkey % 3 + 1 AS INT)] AS c1, o_custkey * 7 // 5000 % 5 * 1000000 + o_custkey * 7 % 5000 AS p1, CASE WHEN o_custkey % 2 = 0 THEN '+' ELSE '-' END AS d1,
      'c' || CAST(o_orderkey % 2 AS VARCHAR) AS c2, o_orderkey * 11 // 5000 % 5 * 1000000 + o_orderkey * 11 % 5000 AS p2, CASE WHEN o_orderkey % 5 < 2 THEN '+' ELSE '-' END AS d2 FROM orders),
f AS (SELECT sv, sample, c1, p1, d1, c2, p2, CASE d2 WHEN '+' THEN '-' ELSE '+' END AS d2 FROM v UNION ALL SELECT sv, sample, c1, p1, CASE d1 WHEN '+' THEN '-' ELSE '+' END, c2, p2, d2 FROM v),
o AS (SELECT sv, sample, c1 AS uc, p1 AS up, d1 AS ud, c2 AS dc, p2 AS dp, d2 AS dd FROM f UNION ALL SELECT sv, sample, c2, p2, d2, c1, p1, d1 FROM f),
m AS (SELECT j.*, sv, up, dp FROM j JOIN o ON j.sample = o.sample AND up_chr = uc AND down_chr = dc AND up_strand = ud AND down_strand = dd)"""


def _sv_sets(spark, sf) -> tuple[DataFrame, DataFrame]:
    sign = lambda even: F.when(even, "+").otherwise("-")
    s = lambda c: F.concat(F.lit("s"), (F.col(c) % 4).cast("string"))
    place = lambda c: F.floor(c / 5000) % 5 * 1_000_000 + c % 5000
    j = intervals(spark, sf).select(
        "id", s("g").alias("sample"), F.col("st").alias("up_chr"), sign(F.col("g") % 2 == 0).alias("up_strand"), place(F.col("s")).alias("up_pos"),
        F.concat(F.lit("c"), (F.col("g") % 2).cast("string")).alias("down_chr"), sign(F.col("id") % 2 == 0).alias("down_strand"), place(F.col("e")).alias("down_pos"),
    )
    v = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("sv"), s("o_custkey").alias("sample"), F.get(F.array(*map(F.lit, _TYPES)), (F.col("o_orderkey") % 3).cast("int")).alias("Chr_1"), place(F.col("o_custkey") * 7).alias("Pos_1"), sign(F.col("o_custkey") % 2 == 0).alias("Dir_1"),
        F.concat(F.lit("c"), (F.col("o_orderkey") % 2).cast("string")).alias("Chr_2"), place(F.col("o_orderkey") * 11).alias("Pos_2"), sign(F.col("o_orderkey") % 5 < 2).alias("Dir_2"), F.lit("").alias("Inserted_Seq"),
    )
    return j, v


@query(f"{_SV} SELECT id, sv FROM m WHERE abs(up - up_pos) <= 100 AND abs(dp - down_pos) <= 100")
def sv_match_ambiguity(spark, sf) -> DataFrame:
    from ..operators.fusions import match_structural

    return match_structural(*_sv_sets(spark, sf), "ambiguity").select("id", "sv")


_INTERNAL = "CASE up_strand WHEN '+' THEN up - up_pos ELSE up_pos - up END BETWEEN -100 AND 100000 AND CASE down_strand WHEN '+' THEN down_pos - dp ELSE dp - down_pos END BETWEEN -100 AND 100000"


@query(f"{_SV} SELECT id, sv FROM m WHERE {_INTERNAL}")
def sv_match_internal(spark, sf) -> DataFrame:
    from ..operators.fusions import match_structural

    return match_structural(*_sv_sets(spark, sf), "internal").select("id", "sv")


@query(f"""{_SV}, h AS (SELECT DISTINCT id FROM m WHERE {_INTERNAL}),
r AS (SELECT g, bool_and(h.id IS NOT NULL) AS all_hit, bool_or(h.id IS NOT NULL) AS any_hit FROM iv LEFT JOIN h USING (id) GROUP BY g)
SELECT g, CASE WHEN all_hit THEN 'match' WHEN any_hit THEN 'partial' ELSE 'unmatch' END AS status FROM r""")
def sv_triage(spark, sf) -> DataFrame:
    from ..operators.fusions import matched, triage

    j, v = _sv_sets(spark, sf)
    hit = matched(j, v, "internal").select("id").distinct().withColumn("hit", F.lit(True))
    junctions = intervals(spark, sf).select("id", "g").join(hit, "id", "left").withColumn("hit", F.coalesce("hit", F.lit(False)))
    return triage(junctions, ["g"], "hit").select("g", "status")


@query(f"""WITH {I_SQL} SELECT g, string_agg(COALESCE(CASE WHEN st <> 'view' THEN st END, 'novel'), '_' ORDER BY s, e, id) AS gene_combination, COUNT(*) - 1 AS n_sv FROM iv GROUP BY g""")
def gene_combination(spark, sf) -> DataFrame:
    from ..operators.fusions import gene_combinations

    iv = intervals(spark, sf).withColumn("name", F.when(F.col("st") != "view", F.col("st"))).withColumn("idx", F.struct("s", "e", "id"))
    return gene_combinations(iv, ["g"], "idx", "name").select("g", "gene_combination", "n_sv")


from . import file_queries, variant_queries  # noqa: E402, F401  (they register themselves)
