"""Sharding by a minimax contiguous partition.

Groups (equal texts) lie in the order of a 64-bit hash and are the atomic units.
The smallest capacity is found by binary search, a greedy walk over prefix sums
says whether a capacity is feasible, and the cuts of the walk at that capacity
are the shards' bounds.

The driver never sees all groups. It starts with ``CELLS`` ranges of the hash,
whose partition bounds the capacity from above, as equal shares and the largest
group do from below. Between these bounds a cut can only lie in a few ranges
about its place; those are split further, until the ranges that a cut can lie in
are single groups. Then the search over what is known is the search over groups.

Slots are numbered without a global sort: a shard's rows are dealt into
``PARTS`` by a hash of id and text, counts of shards and parts give each part
its first slot, and rows are ranked by id within a part.

Defined cases: a null text counts as an empty one; rows that repeat get slots
of their own; slots follow part, then id, equal ids in any order; an empty table
gives an empty result; extra columns are kept, and added ones replace columns of
the same name.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from granary.llm.session import cut

#: Hash ranges to begin with, into how many of them one is split, and groups from which on splitting goes on.
CELLS, SPLIT, MOST_GROUPS = 1 << 16, 1 << 10, 200_000
#: Parts of a shard in which slots are ranked.
PARTS = 4096


def feasible(prefix: np.ndarray, capacity: int, shards: int) -> bool:
    return len(greedy_cuts(prefix, capacity, shards)) <= shards


def greedy_cuts(prefix: np.ndarray, capacity: int, shards: int) -> list[int]:
    """Ends (exclusive) of the parts when each takes as many units as fit; over ``shards`` parts mean failure."""
    cuts, at, n = [], 0, len(prefix) - 1
    while at < n and len(cuts) <= shards:
        end = int(np.searchsorted(prefix, prefix[at] + capacity, "right")) - 1
        if end == at:
            return [*cuts, *[n] * (shards + 1)]
        cuts.append(at := end)
    return cuts


def minimax_cuts(sizes: np.ndarray, shards: int) -> tuple[list[int], int]:
    """Ends of the contiguous parts whose largest is as small as can be, and that size."""
    prefix = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    low, high = int(max(sizes.max(initial=0), -(-prefix[-1] // shards))), int(prefix[-1])
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if feasible(prefix, mid, shards) else (mid + 1, high)
    return greedy_cuts(prefix, low, shards), low


def open_runs(sizes: np.ndarray, single: np.ndarray, low: int, high: int, shards: int) -> list[tuple[int, int]]:
    """Runs of units (first, last) that may hold a cut of a greedy walk at a capacity from ``low`` to ``high``; about one a cut.

    A run begins and ends with a unit of several groups; single groups between them belong to it.
    """
    prefix = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    out = np.zeros(len(sizes), bool)
    first = last = 0
    for _ in range(shards - 1):
        # where a walk may at the earliest and at the latest have cut
        first = max(first, int(np.searchsorted(prefix, prefix[first] + low, "right")) - 1)
        last = min(int(np.searchsorted(prefix, prefix[last] + high, "right")), len(sizes))
        out[first : last + 1] = True
    edges = np.flatnonzero(np.diff(np.concatenate([[0], out.astype(np.int8), [0]])))
    inner = [a + np.flatnonzero(~single[a:b]) for a, b in zip(edges[::2], edges[1::2], strict=True)]
    return [(int(x[0]), int(x[-1])) for x in inner if len(x)]


def bounds(groups: DataFrame, shards: int, *, cells: int = CELLS, split: int = SPLIT, most_groups: int = MOST_GROUPS) -> tuple[list[int], int]:
    """Least hashes of the shards after the first, and the capacity, for groups (g: a hash as a long, size)."""
    shift = 64 - (cells.bit_length() - 1)
    step = split.bit_length() - 1

    def units(rows: DataFrame, shift: int) -> np.ndarray:
        """Least hash (of the range), size, groups, largest group and shift of each range, ascending; few rows whatever the input."""
        cell = F.shiftright("g", shift)
        found = rows.groupBy(cell.alias("cell")).agg(F.sum("size"), F.count("*"), F.max("size")).collect()
        return np.array(sorted((r[0] << shift, r[1], r[2], r[3], shift) for r in found), np.int64).reshape(-1, 5)

    known = units(groups, shift)
    while True:
        sizes, single = known[:, 1], known[:, 2] == 1
        _, high = minimax_cuts(sizes, shards)
        low = int(max(known[:, 3].max(initial=0), -(-int(sizes.sum()) // shards)))
        runs = open_runs(sizes, single, low, high, shards)
        if not runs:
            break
        wanted = np.zeros(len(known), bool)
        for first, last in runs:
            wanted[first : last + 1] = True
        chosen, n = known[wanted], int(known[wanted, 2].sum())
        shift = 0 if n <= most_groups else max(0, int(chosen[:, 4].max()) - step)
        # nothing lies in the empty ranges within a run
        ranges = [(int(known[first, 0]), int(known[last, 0]) + (1 << int(known[last, 4])) - 1) for first, last in runs]
        inside = reduce(or_, [F.col("g").between(a, b) for a, b in ranges])
        finer = units(groups.where(inside), shift)
        known = np.concatenate([known[~wanted], finer])
        known = known[np.argsort(known[:, 0])]
    cuts, capacity = minimax_cuts(known[:, 1], shards)
    return [int(known[c, 0]) for c in cuts[:-1]], capacity


def shard(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shards: int = 16, **options) -> DataFrame:
    """Adds size, text_crc32, shard and slot to ``docs``; options are those of ``bounds``."""
    spark = docs.sparkSession
    content = F.coalesce(F.col(text), F.lit(""))
    keyed = docs.drop("shard", "slot").withColumns(
        {
            "size": F.octet_length(content).cast("long") + 1,
            "text_crc32": F.crc32(content),
            "__g": F.xxhash64(content),
            "__part": F.pmod(F.xxhash64(F.col(doc_id), content), F.lit(PARTS)).cast("int"),
        }
    )
    narrow = cut(keyed.select(F.col("__g").alias("g"), "size", F.col("__part").alias("part")))
    starts, _ = bounds(cut(narrow.groupBy("g").agg(F.sum("size").alias("size"))), shards, **options)
    place = lambda g: sum((F.when(g >= start, 1).otherwise(0) for start in starts), F.lit(0)).cast("int")
    counted = narrow.groupBy(place(F.col("g")).alias("shard"), "part").count().collect()
    rows, next_slot = [], [0] * shards
    for k, part, n in sorted(tuple(r) for r in counted):
        rows.append((k, part, next_slot[k]))
        next_slot[k] += n
    # at most shards * PARTS rows, whatever the input
    table = F.broadcast(spark.createDataFrame(rows, "__shard int, __part_ int, __first long"))
    placed = keyed.withColumn("shard", place(F.col("__g")))
    order = Window.partitionBy("shard", "__part").orderBy(doc_id)
    return (
        placed.join(table, (F.col("shard") == F.col("__shard")) & (F.col("__part") == F.col("__part_")))
        .withColumn("slot", F.col("__first") + F.row_number().over(order) - 1)
        .drop("__g", "__part", "__shard", "__part_", "__first")
    )
