"""Differences between snapshots of a table, and the history that follows from them.

Both sides are reduced to one 64-bit hash of a row's values, so the meeting of
two snapshots shuffles keys and hashes only where values aren't asked for. Null
keys are equal, as in deduplication. Within one snapshot a key is unique.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def row_hash(columns: list[str]) -> Column:
    """A hash of values and of which of them are null."""
    return F.xxhash64(*columns, F.concat(*[F.isnull(c).cast("int").cast("string") for c in columns]))


def difference(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Key, change (added, removed or changed), and the values before (old_*) and after (new_*), of rows that aren't the same."""
    values = [c for c in new.columns if c not in key]
    if sorted(old.columns) != sorted(new.columns):
        raise ValueError("both snapshots need the same columns")

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(*[F.col(k).alias(f"__{name}_{k}") for k in key], *[F.col(v).alias(f"{name}_{v}") for v in values], row_hash(values or key).alias(f"__{name}"))

    same = reduce(and_, [F.col(f"__old_{k}").eqNullSafe(F.col(f"__new_{k}")) for k in key])
    met = side(old, "old").join(side(new, "new"), same, "full").where(~F.col("__old").eqNullSafe(F.col("__new")))
    change = F.when(F.col("__old").isNull(), "added").when(F.col("__new").isNull(), "removed").otherwise("changed")
    keys = [F.when(F.col("__new").isNull(), F.col(f"__old_{k}")).otherwise(F.col(f"__new_{k}")).alias(k) for k in key]
    return met.select(*keys, change.alias("change"), *[f"{n}_{v}" for v in values for n in ("old", "new")])


def validity(snapshots: DataFrame, key: list[str], at: str, all_days: list) -> DataFrame:
    """Key, values, valid_from and valid_to (exclusive, null: still valid) of each state that a key was in.

    ``snapshots`` holds whole snapshots under their day ``at``; ``all_days`` are the days of all of them, so that a key
    that is missing on a day ends there, and one that returns unchanged begins anew.
    """
    values = [c for c in snapshots.columns if c not in (*key, at)]
    number = F.array_position(F.array(*[F.lit(d).cast(snapshots.schema[at].dataType) for d in sorted(all_days)]), F.col(at))
    own = Window.partitionBy(*key).orderBy(at)
    seen = snapshots.withColumns({"__hash": row_hash(values or key), "__number": number})
    kept = F.lag("__hash").over(own).eqNullSafe(F.col("__hash")) & (F.col("__number") - F.lag("__number").over(own) == 1)
    marked = seen.withColumn("__state", F.sum(F.when(kept, 0).otherwise(1)).over(own.rowsBetween(Window.unboundedPreceding, 0)))
    days = F.array(*[F.lit(d).cast(snapshots.schema[at].dataType) for d in sorted(all_days)])
    states = marked.groupBy(*key, "__state").agg(*[F.first(v).alias(v) for v in values], F.min(at).alias("valid_from"), F.max("__number").alias("__last"))
    return states.withColumn("valid_to", F.get(days, F.col("__last").cast("int"))).drop("__state", "__last")
