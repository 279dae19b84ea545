"""Connected components over link tables of any size: minimum labels with pointer jumping, one table per round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(links: DataFrame, rounds: int | None = None) -> DataFrame:
    """(id, component) of every id in links (a, b); component is the smallest id reachable. Loops and repeats do no harm.

    Each round every id takes the least label among its own, its neighbours' and its label's label; rounds end when
    nothing changes. Aggregation runs before each exchange, so that an id with very many links costs one entry a task.
    """
    ends = links.select("a", "b").union(links.select("b", "a")).filter("a <> b").distinct()
    edges = written(ends, "edges")
    state = written(edges.groupBy(F.col("a").alias("id")).agg(F.least(F.col("id"), F.min("b")).alias("label")), "labels")
    done = 0
    while True:
        near = edges.join(state.select(F.col("id").alias("b"), "label"), "b").groupBy(F.col("a").alias("id")).agg(F.min("label").alias("near"))
        step = state.join(near, "id").select("id", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        hop = state.select(F.col("id").alias("label"), F.col("label").alias("next"))
        after = step.join(hop, "label").select("id", "was", F.least("label", "next").alias("label"))
        after = written(after, "labels")
        state, done = after.select("id", "label"), done + 1
        if done == rounds or rounds is None and after.filter("was <> label").isEmpty():
            return state.withColumnRenamed("label", "component")
