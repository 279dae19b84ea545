"""Columns named like the operators' own, and the pipeline over odd rows."""

import corpus_pipeline as P
import pytest
from pyspark.sql import functions as F

from spliceloom.llm import exact, lines, minhash, quality, repeats, secrets

ODD = ["__gone", "__sha", "__d", "__t", "__spans", "__score", "__kept", "row", "gone", "id", "__GONE_"]
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def odd(spark):
    words = " ".join(f"word{i}" for i in range(60))
    rows = [(1, words), (2, words), (3, words + " more"), (4, None), (5, ""), (None, words), (6, "key = AKIA" + "ABCDEFGH" * 3), (6, "key = AKIA" + "ABCDEFGH" * 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.length("text").cast("long")})
    return df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(ODD)])


@pytest.mark.parametrize("name", ["exact", "near", "repeats", "quality", "lines", "secrets"])
def test_columns_may_have_any_names(spark, odd, name):
    work = {
        "exact": exact.drop_exact_copies, "near": minhash.drop_near_copies, "repeats": repeats.remove_repeats, "lines": lambda d: lines.drop_shared_lines(d, 2),
        "secrets": secrets.redact_secrets, "quality": lambda d: quality.keep_quality(d, quality.train(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")), 0.0),
    }[name]
    out = work(odd)
    assert out.columns == odd.columns
    rows = out.collect()
    assert rows and all(tuple(r)[5:] == tuple(range(len(ODD))) for r in rows)
    if name in ("lines", "secrets", "quality", "repeats"):
        assert len(rows) == odd.count()


def test_pipeline_stages_on_odd_rows(spark, odd):
    for docs in (odd, odd.filter("false"), odd.select("doc_id", "text", "lang", "source", "n_chars").unionByName(odd.select("doc_id", "text", "lang", "source", "n_chars"))):
        kept = docs
        for name, stage in P.STAGES[1:-1]:
            kept = stage(spark, kept, SF)
            assert kept.columns == docs.columns, name
        pieces = P.pack(spark, kept, SF).collect()
        assert bool(pieces) == (docs.count() > 0)
        assert sum(r.doc_id == 1 for r in pieces) == sum(bin(pieces_of).count("1") for pieces_of in {r.doc_tokens for r in pieces if r.doc_id == 1})
