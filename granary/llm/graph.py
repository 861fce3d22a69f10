"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.session import cut, release


def _forest(batches):
    """Of a partition's links, those of a spanning forest: each node with the least node it reaches here."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (p := parent.setdefault(top, top)) != top:
            top = p
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            x, y = root(a), root(b)
            if x != y:
                parent[max(x, y)] = min(x, y)
    nodes = [x for x in parent if root(x) != x]
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([root(x) for x in nodes], pa.int64())], ["u", "v"])


#: Links that one task takes into its spanning forest (some 200 bytes each).
TASK_LINKS = 500_000


def components(links: DataFrame, task_links: int = TASK_LINKS) -> DataFrame:
    """node, component (least node reached) of all nodes of ``links`` (columns a, b, longs) that aren't their component's least.

    Links first shrink to a forest in each task, tasks being as many as the links need; the forest of a single task is
    the result. They are read twice and not written again, so whatever they took should be cut (``session.cut``)
    before; a checkpoint is a file a partition. Otherwise every round hangs nodes onto smaller neighbours; minima are pre-aggregated, so a node with
    very many links costs no task more than its share.
    """
    pair = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    tasks = max(1, -(-pair.count() // task_links))
    now = cut(pair.coalesce(tasks).mapInArrow(_forest, "u long, v long"))
    seen = None
    while tasks > 1:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % (1 << 40))).first()
        if mark == seen:
            break
        seen = mark
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = cut(small.union(least.select("u", "m")).distinct())
    release(now.sparkSession)
    return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
