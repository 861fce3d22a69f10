"""Running totals and neighbours in one order of all rows, without one ordered task.

A window without a partition, or with a partition of very many rows, sorts in one
task. Here the order is cut into ranges at bounds from a sample. Each range is
windowed alone; one summary row a range (its sum, its first and last non-null
values) goes to the driver, which adds up what each range inherits from those
before and after it; that comes back as one broadcast row a range. Within
partitions (``by``) only those that lie in several ranges have anything to
inherit, which are fewer than there are ranges.

Bounds only decide how rows are dealt, never a result. Rows equal in all ``by``
and ``order`` columns share a range; order columns ascend, nulls first.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

#: Sampled rows a range.
SAMPLE = 60


def bounds(rows: DataFrame, columns: list[str], parts: int) -> list:
    """At most ``parts`` - 1 ascending values of the columns that cut the rows into ranges of about equal size."""
    n = rows.count()
    some = rows.select(*columns).sample(min(1.0, 2 * SAMPLE * parts / max(n, 1)), seed=7).orderBy(*columns).collect()
    step = max(1, -(-len(some) // parts))
    return list(dict.fromkeys(tuple(r) for r in some[step::step]))


def part_of(rows: DataFrame, columns: list[str], cuts: list) -> Column:
    """The number of bounds at or below a row's own values, by bisection."""
    if not cuts:
        return F.lit(0)
    kinds = [rows.schema[c].dataType for c in columns]
    value = lambda values: F.struct(*[F.lit(v).cast(k).alias(f"c{i}") for i, (v, k) in enumerate(zip(values, kinds, strict=True))])
    table, mine = F.array(*map(value, cuts)), F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)])
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(cuts).bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda low, step: F.when(F.get(table, low + step - 1) <= mine, low + step).otherwise(low))


def running(
    rows: DataFrame,
    order: list[str],
    *,
    by: tuple[str, ...] = (),
    total: dict[str, str] | None = None,
    last: dict[str, str] | None = None,
    following: dict[str, str] | None = None,
    parts: int | None = None,
) -> DataFrame:
    """``rows`` with new columns, each of a column named: the running ``total`` up to the row, the ``last`` value that isn't null
    up to it, the first such value from it on (``following``). ``parts``: ranges, by default the shuffle's partitions.
    """
    spark = rows.sparkSession
    total, last, following = total or {}, last or {}, following or {}
    columns = [*by, *order]
    cuts = bounds(rows, columns, parts or int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = rows.withColumn("__part", part_of(rows, columns, cuts))
    place = F.struct(*order)
    summed = dealt.groupBy("__part", *by).agg(
        F.count("*").alias("__rows"),
        *[F.sum(c).alias(n) for n, c in total.items()],
        *[F.max_by(c, F.when(F.col(c).isNotNull(), place)).alias(n) for n, c in last.items()],
        *[F.min_by(c, F.when(F.col(c).isNotNull(), place)).alias(n) for n, c in following.items()],
    )
    if by:
        summed = summed.withColumn("__ranges", F.count("*").over(Window.partitionBy(*by))).where("__ranges > 1")
    made = spark.createDataFrame(_inherited(summed.orderBy(*by, "__part").collect(), by, total, last, following), _schema(summed, by, total, last, following))
    names = {c: f"__{c}_" for c in ("__part", *by)}
    side = made.withColumnsRenamed(names | {n: f"__{n}_" for n in (*total, *last, *following)})
    local, so_far = Window.partitionBy("__part", *by), (Window.unboundedPreceding, 0)
    # what follows is what came before in the reverse order: a frame that only grows, where one to the end is computed anew for each row
    up, down = local.orderBy(*order).rowsBetween(*so_far), local.orderBy(*[F.desc_nulls_last(c) for c in order]).rowsBetween(*so_far)
    own = dealt.select(
        "*",
        *[F.sum(c).over(up).alias(f"__{n}_own") for n, c in total.items()],
        *[F.last(c, ignorenulls=True).over(up).alias(f"__{n}_own") for n, c in last.items()],
        *[F.last(c, ignorenulls=True).over(down).alias(f"__{n}_own") for n, c in following.items()],
    )
    joined = own.join(F.broadcast(side), reduce(and_, [F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()]), "left")
    added = {n: F.coalesce(F.col(f"__{n}_own") + F.col(f"__{n}_"), F.col(f"__{n}_own"), F.col(f"__{n}_")) for n in total}
    near = {n: F.coalesce(f"__{n}_own", f"__{n}_") for n in (*last, *following)}
    return joined.select(*rows.columns, *[c.alias(n) for n, c in (added | near).items()])


def _schema(summed: DataFrame, by, total, last, following) -> T.StructType:
    return T.StructType([T.StructField(n, summed.schema[n].dataType) for n in ("__part", *by, *total, *last, *following)])


def _inherited(found: list, by, total, last, following) -> list[tuple]:
    """For each range: the sum of those before it, the last value of these, the first value of those after it; of the same ``by``."""
    out, key, seen = [], None, {}
    for r in found:
        if (mine := tuple(r[c] for c in by)) != key:
            key, seen = mine, {}
        out.append([r["__part"], *mine, *(seen.get(n) for n in (*total, *last))])
        for n in total:
            if r[n] is not None:
                seen[n] = r[n] if seen.get(n) is None else seen[n] + r[n]
        seen |= {n: r[n] for n in last if r[n] is not None}
    key, seen = None, {}
    for k in reversed(range(len(found))):
        r = found[k]
        if (mine := tuple(r[c] for c in by)) != key:
            key, seen = mine, {}
        out[k] += [seen.get(n) for n in following]
        seen |= {n: r[n] for n in following if r[n] is not None}
    return [tuple(x) for x in out]
