"""Measured recall of near-duplicate components."""

from pyspark.sql import functions as F

from spliceloom.llm import audit, minhash

SF = "/root/testdata/sf0.01"


def test_recall_over_a_sample(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    result = minhash.near_duplicates(docs, width=2).cache()
    recall, links = audit.component_recall(docs, result, width=2, sample=1000)
    assert recall == 1.0 and links > 50
    apart = result.withColumn("component_id", F.col("doc_id"))
    assert audit.component_recall(docs, apart, width=2, sample=1000) == (0.0, links)
    few, some = audit.component_recall(docs, result, width=2, sample=100)
    assert few == 1.0 and 0 < some < links
    odd = spark.createDataFrame([(1, None), (None, "a b c"), (2, "")], "doc_id long, text string")
    assert audit.component_recall(odd, minhash.near_duplicates(odd)) == (1.0, 0) == audit.component_recall(odd.filter("false"), result)


def test_links_equal_a_slow_count(spark):
    texts = ["a b c d e f", "a b c d e f", "a b c d e f g", "x y z", "a b", None, "a b c d x f"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [{tuple((t or "").split()[i : i + 2]) for i in range(len((t or "").split()) - 1)} for t in texts]
    want = sum(i != j and len(sets[i]) > 0 and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]) for i in range(7) for j in range(7))
    assert audit.component_recall(docs, docs.withColumn("component_id", F.lit(0)), width=2)[1] == want == 6
