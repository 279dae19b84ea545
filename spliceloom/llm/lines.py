"""Line dedup: lines that many documents share are dropped from all of them.

Each text is cut at line feeds; a line's key is the line without white space (U+0020, U+0009 to U+000D) at both ends and
with A to Z in lower case. Keys are hashed to 128 bits, documents are counted once per hash, and lines whose key stands
in `min_docs` documents or more go; the others are put together again by position. Empty keys always stay.

Counting distinct documents spreads over (hash, document) first, so a line that a third of all rows hold is counted by
many tasks. Lines meet the frequent hashes by a join on the hash; the few hashes with at least 1/1024 of all frequent
lines each (1,024 at most) are broadcast instead, and their lines go to the join under keys of their own, so no key is hot.

Null texts count as empty: one empty line. Rows that repeat an id are one document when counted, and each has its own
row in results; rows without an id count as one document for each distinct text. Input columns may have any names.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

WHITE = " \t\n\x0b\x0c\r"
#: Hashes with at least this share of the frequent lines are broadcast; so many there are at most.
HEAVY = 1024
_HASH = ["h1", "h2"]


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A to Z in lower case."""
    bare = F.btrim(line, F.lit(WHITE))
    return F.when(F.octet_length(bare) == F.length(bare), F.lower(bare)).otherwise(F.translate(bare, string.ascii_uppercase, string.ascii_lowercase))


def _rows(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """One row per input row: row (all its columns), id, its text's hash, and text (null: empty)."""
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"), F.col(f"`{doc_id}`").alias("id"), F.xxhash64(whole).alias("t"), whole.alias("text"))


def _lines(rows: DataFrame, min_length: int) -> DataFrame:
    """One row per line whose key is long enough: id, t, pos, h1, h2."""
    cut = rows.select("id", "t", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    keys = cut.select("id", "t", "pos", line_key(F.col("line")).alias("key")).filter(F.length("key") >= max(1, min_length))
    return keys.select("id", "t", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), "key").alias("h2"))


def frequent(lines: DataFrame, min_docs: int) -> DataFrame:
    """Hashes that min_docs documents or more hold: h1, h2, n_docs, n_lines."""
    doc = F.struct("id", F.when(F.col("id").isNull(), F.col("t")))
    counts = lines.groupBy(*_HASH).agg(F.count_distinct(doc).alias("n_docs"), F.count(F.lit(1)).alias("n_lines"))
    return counts.filter(F.col("n_docs") >= min_docs)


def _judged(df: DataFrame, min_docs: int, min_length: int, doc_id: str, text: str) -> DataFrame:
    """Per input row: row, id, n_lines, n_dropped and kept, the text that stays."""
    rows = _rows(df, doc_id, text)
    lines = _lines(rows, min_length)
    often = written(frequent(lines, min_docs), "lines")
    total = often.agg(F.sum("n_lines")).first()[0] or 0
    is_heavy = F.col("n_lines") * HEAVY >= total
    heavy = often.filter(is_heavy).select(*_HASH, F.lit(True).alias("heavy"))
    light = often.filter(~is_heavy).select(F.col("h1").alias("k1"), F.col("h2").alias("k2"), F.lit(True).alias("light"))
    some = lines.join(F.broadcast(heavy), _HASH, "left")
    spread = F.when(F.col("heavy"), F.xxhash64("id", "t", "pos")).otherwise(F.col("h1"))
    met = some.withColumn("k1", spread).withColumn("k2", F.col("h2")).join(light, ["k1", "k2"], "left")
    gone = met.filter("heavy OR light").groupBy("id", "t").agg(F.collect_set("pos").alias("gone"))
    gone = gone.select(F.col("id").alias("g_id"), F.col("t").alias("g_t"), "gone")
    whole = rows.select("row", "id", "t", F.split("text", "\n", -1).alias("lines"))
    both = whole.join(gone, F.col("id").eqNullSafe(F.col("g_id")) & (F.col("t") == F.col("g_t")), "left")
    both = both.withColumn("gone", F.coalesce("gone", F.array().cast("array<int>")))
    left = F.transform(F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone")), lambda i: F.get("lines", i))
    return both.select("row", "id", F.size("lines").cast("long").alias("n_lines"), F.size("gone").cast("long").alias("n_dropped"), F.array_join(left, "\n").alias("kept"))


def drop_shared_lines(df: DataFrame, min_docs: int = 10, min_length: int = 1, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """df, all its columns, with texts free of shared lines; a text that loses no line stays as it is, null too."""
    done = _judged(df, min_docs, min_length, doc_id, text)
    cols = [F.when(F.col("n_dropped") > 0, F.col("kept")).otherwise(F.col("row").getField(c)).alias(c) if c == text else F.col("row").getField(c).alias(c) for c in df.columns]
    return done.select(*cols)


def line_digest(df: DataFrame, min_docs: int = 10, min_length: int = 1, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_lines before dropping, n_dropped, kept_sha256. An empty table gives no rows."""
    done = _judged(df, min_docs, min_length, doc_id, text)
    return done.select(F.col("id").alias("doc_id"), "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


SQL = f"""
WITH l AS (SELECT doc_id, unnest(s) AS line, generate_subscripts(s, 1) AS pos FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents)),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS key FROM l),
f AS (SELECT key AS often FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(often) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE often IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN f ON key = often GROUP BY doc_id
"""
