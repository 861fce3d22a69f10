"""Features kept up to date from changed rows alone.

A sale changes its product's history for as many days as the longest window
looks back, and through that the shares of every product of the store on these
days. So the (store, day) pairs from each change to that many days later are
recomputed, from rows that reach as far back again; all others stay. Stored
features are rewritten by partition: only months with such a day are read and
replaced, and one manifest makes the new state visible.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.operators.features import FeatureConfig
from granary.operators.sizes import small
from granary.sources.snapshots import Dataset, Manifest

AT = ["date", "store_id"]


def touched(changes: DataFrame, c: FeatureConfig) -> DataFrame:
    """date, store_id whose features may differ once the changed (added, replaced or deleted) rows are in the fact."""
    days = F.sequence(F.col("date"), F.date_add("date", c.reach))
    return changes.select(*AT).distinct().select(F.explode(days).alias("date"), "store_id").distinct()


def refresh(fact: DataFrame, old: DataFrame, days: DataFrame, c: FeatureConfig, compute: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``old`` with the features of ``days`` (see ``touched``) computed anew from ``fact``, the whole fact with its changes.

    Only rows of ``fact`` that a window from one of these days can see are computed; ``compute`` gives the columns of ``old``.
    Rows without a store or date belong to no day: they are recomputed with none and stay as they are.
    """
    days = small(days)
    seen = small(days.select(F.explode(F.sequence(F.date_sub("date", c.reach), F.col("date"))).alias("date"), "store_id").distinct())
    anew = compute(fact.join(seen, AT, "left_semi")).join(days, AT, "left_semi")
    return old.join(days, AT, "left_anti").unionByName(anew)


def refresh_stored(features: Dataset, fact: Dataset, changes: DataFrame, c: FeatureConfig, compute: Callable[[DataFrame], DataFrame], run_id: str, **options) -> Manifest | None:
    """Brings stored features (by year and month) up to date with a stored fact whose bounds column is ``date``; None without changes.

    ``fact`` is read between the first day that a window needs and the last that changes, ``features`` in the months touched.
    """
    days = small(touched(changes, c))
    first, last = days.agg(F.min("date"), F.max("date")).first()
    if first is None:
        return None
    base = features.manifest()
    months = [r.asDict() for r in days.select(F.year("date").alias("year"), F.month("date").alias("month")).distinct().collect()]
    rows = fact.read(between=(first - timedelta(days=c.reach), last))
    new = refresh(rows, features.read(base.version, partitions=months), days, c, compute)
    return features.commit(new, run_id, base=base.version, replace=months, **options)

