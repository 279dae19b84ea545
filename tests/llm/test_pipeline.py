"""The pipeline's stages on small tables."""

import corpus_pipeline as P
from pyspark.sql import functions as F

from spliceloom.llm import exact, minhash, secrets

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = docs
    for name, stage in P.STAGES[:-1]:
        before, kept = kept, stage(spark, kept, SF).cache()
        assert kept.columns == docs.columns and 0 < kept.count() <= before.count(), name
    assert exact.exact_groups(kept).filter("NOT kept").isEmpty()
    assert secrets.digest(kept).filter(F.col("spans") != "").isEmpty()
    assert minhash.near_duplicates(kept, width=5).filter("NOT kept").isEmpty()
    packed = P.pack(spark, kept, SF)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {r.doc_id for r in kept.select("doc_id").collect()}
