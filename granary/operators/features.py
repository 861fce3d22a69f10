"""Point-in-time demand and inventory features.

A feature is a name and an expression, kept in catalogues by the window it
needs. ``features`` evaluates them in three projections: everything over a
product's own history (one sort of store and product by day), then the share of
a day's portfolio in a store, then what follows from these without a window.
Demand of the day itself never enters a history window.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from granary.functions.scalar import ratio
from granary.operators import slices
from granary.operators.sizes import small


# fixed values: default windows and thresholds here, class labels and severities in the catalogues below
@dataclass(frozen=True)
class FeatureConfig:
    """Windows in days, and thresholds. Windows are made ascending and distinct."""

    lags: tuple[int, ...] = (1, 7, 14, 28)
    rolling: tuple[int, ...] = (7, 28)
    abc_days: int = 90
    xyz_days: int = 90
    abc: tuple[float, float] = (0.80, 0.95)
    cv: tuple[float, float] = (0.50, 1.00)
    parity: tuple[float, float] = (0.98, 1.02)
    least_history: int = 7

    def __post_init__(self):
        for name in ("lags", "rolling"):
            object.__setattr__(self, name, tuple(sorted(set(getattr(self, name)))))
        problems = [
            text
            for bad, text in (
                (not self.lags or self.lags[0] < 1, "lags must be positive"),
                (not self.rolling or self.rolling[0] < 2, "rolling windows must be at least 2"),
                (self.least_history < 2, "the least history must be at least 2"),
                (min(self.abc_days, self.xyz_days) < self.least_history, "lookbacks must cover the least history"),
                (not 0 < self.abc[0] < self.abc[1] < 1, "ABC thresholds must rise between 0 and 1"),
                (not 0 < self.cv[0] < self.cv[1], "variation thresholds must rise above 0"),
                (not 0 < self.parity[0] < self.parity[1], "price thresholds must rise above 0"),
            )
            if bad
        ]
        if problems:
            raise ValueError("; ".join(problems))


    @property
    def reach(self) -> int:
        """Days that a feature of a product's own history looks back at most."""
        return max(*self.lags, *self.rolling, self.abc_days, self.xyz_days)


Features = dict[str, Column]
Key = tuple[str, ...]
KEY: Key = ("store_id", "product_id")


def _own(key: Key) -> WindowSpec:
    return Window.partitionBy(*key).orderBy("__day")


def _past(days: int, key: Key) -> WindowSpec:
    return _own(key).rangeBetween(-days, -1)


def lag_features(c: FeatureConfig, key: Key = KEY) -> Features:
    """The value n rows back where that row is exactly n days old: no day between is missing."""
    gap = lambda n: F.col("__day") - F.lag("__day", n).over(_own(key))
    return {f"{x}_lag_{n}d": F.when(gap(n) == n, F.lag(x, n).over(_own(key))) for n in c.lags for x in ("units_sold", "revenue")}


class OfRows:
    """Demand of a window over rows."""

    @staticmethod
    def units(past: WindowSpec) -> tuple[Column, Column, Column]:
        """Count, mean and deviation."""
        units = F.col("units_sold")
        return F.count(units).over(past), F.avg(units).over(past), F.stddev_samp(units).over(past)

    @staticmethod
    def revenue(past: WindowSpec) -> Column:
        return F.sum("revenue").over(past)


class OfDays:
    """The same of a window over one row a key and day (``daily``), whatever the number of rows of a day."""

    @staticmethod
    def daily(rows: DataFrame, key: Key) -> DataFrame:
        units = F.col("units_sold")
        of_day = F.struct(F.count(units).alias("n"), F.avg(units).cast("double").alias("mean"), (F.var_pop(units) * F.count(units)).alias("m2"))
        return rows.groupBy(*key, "date").agg(F.sum(units).alias("__units"), F.sum("revenue").alias("__revenue"), of_day.alias("__of_day")).withColumn("__n", F.col("__of_day.n"))

    @staticmethod
    def units(past: WindowSpec) -> tuple[Column, Column, Column]:
        n = F.coalesce(F.sum("__n").over(past), F.lit(0).cast("long"))
        return n, F.sum("__units").over(past) / n, _deviation(F.collect_list("__of_day").over(past))

    @staticmethod
    def revenue(past: WindowSpec) -> Column:
        return F.sum("__revenue").over(past)


def _deviation(days: Column) -> Column:
    """The sample deviation of days' moments, merged one after another as ``stddev_samp`` takes single values and partial moments:
    no difference of large sums, and the same digits where days have one row.
    """

    def merged(a: Column, b: Column) -> Column:
        n, apart = a["n"] + b["n"], b["mean"] - a["mean"]
        step = apart / n
        made = lambda mean, m2: F.struct(n.alias("n"), mean.alias("mean"), m2.alias("m2"))
        one = made(a["mean"] + step, a["m2"] + apart * (apart - step))
        both = made(a["mean"] + step * b["n"], a["m2"] + b["m2"] + apart * step * a["n"] * b["n"])
        return F.when(b["n"] == 0, a).when(b["n"] == 1, one).when(a["n"] == 0, b).otherwise(both)

    none = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
    return F.aggregate(days, none, merged, lambda x: F.when(x["n"] > 1, F.sqrt(x["m2"] / (x["n"] - 1))))


def _history(prefix: tuple[str, str, str], days: int, key: Key, of: type) -> Features:
    return dict(zip(prefix, of.units(_past(days, key)), strict=True))


def rolling_features(c: FeatureConfig, key: Key = KEY, of: type = OfRows) -> Features:
    out: Features = {}
    for w in c.rolling:
        out |= _history((f"demand_observation_count_{w}d", f"units_sold_rolling_mean_{w}d", f"units_sold_rolling_std_{w}d"), w, key, of)
    return out


def lookback_features(c: FeatureConfig, key: Key = KEY, of: type = OfRows) -> Features:
    names = tuple(f"xyz_{x}_{c.xyz_days}d" for x in ("observation_count", "demand_mean", "demand_std"))
    return {f"abc_revenue_{c.abc_days}d": of.revenue(_past(c.abc_days, key))} | _history(names, c.xyz_days, key, of)


def portfolio_features(c: FeatureConfig) -> Features:
    """Share of the store's revenue, and the share of what sold better; equal revenues rank by product."""
    mine = F.col(f"abc_revenue_{c.abc_days}d")
    store = Window.partitionBy("date", "store_id")
    total = F.sum(mine).over(store)
    ranked = store.orderBy(mine.desc_nulls_last(), "product_id").rowsBetween(Window.unboundedPreceding, 0)
    return {f"abc_revenue_share_{c.abc_days}d": ratio(mine, total), "__better": ratio(F.sum(mine).over(ranked) - mine, total)}


def class_features(c: FeatureConfig) -> Features:
    better = F.col("__better")
    count, mean, std = (F.col(f"xyz_{x}_{c.xyz_days}d") for x in ("observation_count", "demand_mean", "demand_std"))
    cv = ratio(std, mean)
    w = c.rolling[-1]
    n, m = F.col(f"demand_observation_count_{w}d"), F.col(f"units_sold_rolling_mean_{w}d")
    wide = ratio(F.col(f"units_sold_rolling_std_{w}d"), m)
    few = F.coalesce(count, F.lit(0)) < c.least_history
    return {
        "abc_class": F.when(better.isNull(), None).when(better < c.abc[0], "A").when(better < c.abc[1], "B").otherwise("C"),
        f"xyz_demand_cv_{c.xyz_days}d": cv,
        "xyz_class": F.when(few, None).when(mean <= 0, "Z").when(cv <= c.cv[0], "X").when(cv <= c.cv[1], "Y").otherwise("Z"),
        f"demand_cv_{w}d": wide,
        "volatility_segment": F.when(n < c.least_history, "Insufficient_History")
        .when(m <= 0, "No_Demand")
        .when(wide <= c.cv[0], "Stable")
        .when(wide <= c.cv[1], "Variable")
        .otherwise("Highly_Variable"),
    }


def cycle_features() -> Features:
    year, month = F.dayofyear("date") * (2 * math.pi / 365.25), F.month("date") * (2 * math.pi / 12)
    return {
        "day_of_year_sin": F.sin(year),
        "day_of_year_cos": F.cos(year),
        "month_sin": F.sin(month),
        "month_cos": F.cos(month),
        "is_month_start": F.dayofmonth("date") == 1,
        "is_month_end": F.col("date") == F.last_day("date"),
    }


def holiday_features() -> Features:
    ahead, behind = F.col("days_to_next_holiday"), F.col("days_since_previous_holiday")
    return {
        "is_pre_holiday_7d": ahead.between(1, 7),
        "is_post_holiday_7d": behind.between(1, 7),
        "holiday_proximity_days": F.least(ahead, behind),
    }


def weather_features() -> Features:
    sky = F.col("weather_condition")
    severity = {3: ["Storm"], 2: ["Cold Wave", "Heat Wave"], 1: ["Fog", "Rainy"]}
    score = F.when(sky.isNull(), None)
    for points, kinds in severity.items():
        score = score.when(sky.isin(kinds), points)
    return {
        "is_precipitation": (F.col("weather_rainfall") > 0) | sky.isin("Rainy", "Storm"),
        "is_extreme_weather": sky.isin("Cold Wave", "Heat Wave", "Storm"),
        "weather_severity_score": score.otherwise(0),
        "weather_humidity_ratio": F.col("weather_humidity") / 100,
        "temperature_source_delta": F.col("weather_temperature") - F.col("sales_temperature"),
    }


def promotion_features() -> Features:
    depth = F.coalesce("promotion_discount_pct", "discount", F.lit(0.0))
    return {
        "is_promotion": F.col("promotion_id").isNotNull() | (F.col("discount") > 0),
        "promotion_discount_depth": depth,
        "promotion_discount_variance": F.col("discount") - F.col("promotion_discount_pct"),
        "theoretical_discounted_price": F.round(F.col("price") * (1 - depth), 2),
    }


def competitor_features(c: FeatureConfig) -> Features:
    mine, theirs = F.col("price"), F.col("competitor_price")
    index = ratio(mine, theirs)
    return {
        "competitor_price_gap": theirs - mine,
        "competitor_price_gap_pct": ratio(theirs - mine, theirs),
        "competitor_price_index": index,
        "price_position": F.when(index.isNull(), None)
        .when(index < c.parity[0], "Below_Competitor")
        .when(index > c.parity[1], "Above_Competitor")
        .otherwise("At_Parity"),
        "is_price_competitive": mine <= theirs,
    }


def inventory_features(c: FeatureConfig) -> Features:
    opening, closing = F.col("opening_stock"), F.col("closing_stock")
    return {
        "is_stockout": closing <= 0,
        "is_safety_stock_breach": closing <= F.col("safety_stock"),
        "is_reorder_required": closing <= F.col("reorder_point"),
        "days_of_supply": ratio(closing, F.col(f"units_sold_rolling_mean_{c.rolling[0]}d")),
        "sell_through_rate": ratio(F.col("sold"), opening + F.col("received_stock")),
        "inventory_turnover_proxy": ratio(F.col("units_sold"), (opening + closing) / 2),
        "inventory_position": closing + F.col("units_ordered"),
    }


def history(rows: DataFrame, c: FeatureConfig, *catalogues: Features) -> DataFrame:
    """``rows`` with features over a product's own history."""
    wanted = {k: v for part in catalogues for k, v in part.items()}
    # one order for all history windows, so they share a sort
    return rows.select("*", F.unix_date("date").alias("__day")).select("*", *[v.alias(k) for k, v in wanted.items()])


def own_history(rows: DataFrame, c: FeatureConfig, *makers: Callable[[FeatureConfig, Key], Features], most_rows: int | None = None) -> DataFrame:
    """``rows`` with the features that ``makers`` give.

    With ``most_rows``, keys may have very many rows: features of ranges of days are taken over sums by day, so a window holds no
    more rows than a key has days, and those that look rows back are windowed in slices of about ``most_rows``.
    """
    if most_rows is None:
        return history(rows, c, *[make(c, KEY) for make in makers])
    sums = [make for make in makers if make in BY_DAY]
    each = [make for make in makers if make not in BY_DAY]
    own = rows.withColumn("__day", F.unix_date("date"))
    if each:
        dealt = slices.deal(rows, KEY, c.reach, small(slices.ranges(rows, KEY, most_rows, c.reach)))
        own = history(dealt, c, *[make(c, (*KEY, "__slice")) for make in each]).where("__home").drop("__slice", "__home")
    if not sums:
        return own
    names = {k: f"__{k}" for k in (*KEY, "date")}
    wanted = [k for make in sums for k in make(c)]
    kinds = dict(history(rows, c, *[make(c) for make in sums]).dtypes)
    of_days = history(OfDays.daily(rows, KEY), c, *[make(c, KEY, OfDays) for make in sums])
    side = of_days.select(*[F.col(k).alias(n) for k, n in names.items()], *[F.col(k).cast(kinds[k]).alias(k) for k in wanted])
    joined = own.join(side, reduce(and_, [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()]), "left")
    return joined.select(*rows.columns, "__day", *[k for make in makers for k in make(c)])


#: Features of ranges of days, which need no more of a day than its sums.
BY_DAY = (rolling_features, lookback_features)
HISTORY = (lag_features, rolling_features, lookback_features)


def demand_features(rows: DataFrame, c: FeatureConfig | None = None, store_partitions: int | None = None, most_rows: int | None = None) -> DataFrame:
    """All features of a demand base.

    ``store_partitions`` deals rows by store first, which serves every later window without another shuffle; it pays
    where there are at least twice as many stores as cores. ``most_rows`` slices the history of larger keys.
    """
    c = c or FeatureConfig()
    rows = rows.repartition(store_partitions, "store_id") if store_partitions else rows
    own = own_history(rows, c, *HISTORY, most_rows=most_rows)
    shared = own.select("*", *[v.alias(k) for k, v in portfolio_features(c).items()])
    plain = (cycle_features(), holiday_features(), weather_features(), promotion_features(), competitor_features(c), inventory_features(c), class_features(c))
    return shared.select("*", *[v.alias(k) for part in plain for k, v in part.items()]).drop("__day", "__better")
