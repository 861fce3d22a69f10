"""Windows over a key's history in slices of days, so that no key is one task.

A window that looks back a bounded number of days needs no more of a key's past
than that. A key of many rows is cut into ranges of days of about as many rows
each; a slice holds its own days, and before them a halo: the days that windows
of its first day still see. Each row is at home in one slice and a guest in the
slices whose halo it lies in. Windows over (key, slice) are then the windows over
the key for the rows at home: range frames see the same days, and what lies n
rows back matters only where it is n days old, so within the halo.

Keys of few rows stay whole and have no copies. The ranges come from one count
by key and day; a day is never cut, so a slice has at most a day's rows too many.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def ranges(rows: DataFrame, key: tuple[str, ...], most_rows: int, halo: int, day: str = "date") -> DataFrame:
    """key, __slice, __first and __last day of the slices of keys with more than ``most_rows`` rows.

    Slices grow beyond ``most_rows`` where they would otherwise be shorter than the halo, so rows are at most doubled on average.
    """
    daily = rows.where(F.col(day).isNotNull()).groupBy(*key, day).agg(F.count("*").alias("__n"))
    whole = Window.partitionBy(*key)
    so_far = whole.orderBy(day).rowsBetween(Window.unboundedPreceding, 0)
    placed = daily.withColumns(
        {
            "__before": F.sum("__n").over(so_far) - F.col("__n"),
            "__total": F.sum("__n").over(whole),
            "__days": F.date_diff(F.max(day).over(whole), F.min(day).over(whole)) + 1,
        }
    )
    size = F.greatest(F.lit(most_rows), F.ceil(F.col("__total") * halo / F.col("__days")))
    cut = placed.where(F.col("__total") > most_rows).withColumn("__slice", F.floor(F.col("__before") / size))
    return cut.groupBy(*key, "__slice").agg(F.min(day).alias("__first"), F.max(day).alias("__last"))


def deal(rows: DataFrame, key: tuple[str, ...], halo: int, slices: DataFrame, day: str = "date") -> DataFrame:
    """``rows`` once for each slice that needs them, with __slice, and __home where they are the slice's own."""
    names = {k: f"__{k}" for k in key}
    side = slices.withColumnsRenamed(names)
    meets = [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()] + [F.col(day).between(F.date_sub("__first", halo), F.col("__last"))]
    joined = rows.join(side, reduce(and_, meets), "left")
    return joined.withColumn("__home", F.col("__slice").isNull() | (F.col(day) >= F.col("__first"))).drop(*names.values(), "__first", "__last")
