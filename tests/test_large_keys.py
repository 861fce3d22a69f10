"""Hot keys, many offers and global orders: equal to the plain plans, and no task or row that holds a whole key."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from granary.operators import enrich, features, history, scan, sizes, slices
from granary.sources import buckets

DAY = dt.date(2024, 1, 1)
day = lambda k: None if k is None else DAY + dt.timedelta(days=k)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def values(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


@pytest.fixture(scope="module")
def hot(spark):
    """One key of 3,000 rows, several a day, among 60 of some 20; null keys and days."""
    r = random.Random(4)
    rows = [(n, r.randint(0, 500), "S", "HOT") for n in range(3000)]
    rows += [(3000 + n, r.randint(0, 500), "S", f"P{n % 60}") for n in range(1200)]
    rows += [(5000 + n, r.randint(0, 500), None, "HOT") for n in range(900)] + [(6000, None, "S", "HOT"), (6001, None, "S", "HOT"), (6002, 3, None, None)]
    out = [(n, day(d), s, p, None if n % 17 == 0 else n % 23, float(n % 31)) for n, d, s, p in rows]
    return spark.createDataFrame(out, "n long, date date, store_id string, product_id string, units_sold long, revenue double")


def test_sliced_histories_equal_whole_ones(hot):
    c = features.FeatureConfig()
    makers = (features.rolling_features, features.lookback_features)
    rounded = lambda df: df.select("n", *[F.round(x, 9) if t == "double" else F.col(x) for x, t in df.dtypes if x not in hot.columns and x != "__day"])
    whole = features.own_history(hot, c, *makers)
    sliced = features.own_history(hot, c, *makers, most_rows=300)
    assert whole.columns == sliced.columns and values(rounded(whole), "n") == values(rounded(sliced), "n")


def test_windows_of_ranges_hold_days_not_rows(spark):
    """However many rows a day has, a window has one for it; equal values deviate by 0 and days without values count nothing."""
    c = features.FeatureConfig()
    rows = spark.range(6000).select("id", F.date_add(F.lit(DAY), (F.col("id") % 100).cast("int")).alias("date"), F.lit("S").alias("store_id"), F.lit("P").alias("product_id"),
        F.when(F.col("id") % 100 != 40, F.when(F.col("id") % 100 < 50, 7).otherwise(8)).cast("long").alias("units_sold"), F.lit(0.5).cast("decimal(18, 2)").alias("revenue"))
    out = features.own_history(rows, c, features.rolling_features, features.lookback_features, most_rows=100)
    assert out.dtypes == features.own_history(rows, c, features.rolling_features, features.lookback_features).dtypes
    whole = plan(out)
    assert "RangeFrame" in whole and whole.index("RangeFrame") < whole.index("HashAggregate") and "__slice" not in whole
    of = lambda k: out.where(F.col("id") == k).first()
    assert of(0).units_sold_rolling_mean_7d is None and of(0).demand_observation_count_7d == 0 and of(0).abc_revenue_90d is None
    assert (of(45).demand_observation_count_7d, of(45).units_sold_rolling_mean_7d, of(45).units_sold_rolling_std_7d, str(of(45).abc_revenue_90d)) == (360, 7.0, 0.0, "1350.00")
    assert (of(53).units_sold_rolling_mean_7d, round(of(53).units_sold_rolling_std_7d, 9)) == ((4 * 7 + 3 * 8) / 7, round((420 * 12 / 49 / 419) ** 0.5, 9))


def test_slices_are_flat_and_rows_at_most_doubled(hot):
    found = slices.ranges(hot, features.KEY, 300, 30)
    dealt = slices.deal(hot, features.KEY, 30, found)
    assert dealt.where("__home").count() == hot.count() and dealt.count() < 2 * hot.count()
    size = [r[0] for r in dealt.where("product_id = 'HOT' and __slice is not null").groupBy("store_id", "__slice").count().select("count").collect()]
    assert len(size) >= 10 and max(size) <= 2 * sorted(size)[len(size) // 2]
    assert slices.ranges(hot, features.KEY, 10_000, 30).count() == 0


@pytest.mark.parametrize("most_rows", [1, 40, 100])
def test_gated_lags_hold_across_slices(spark, most_rows):
    """Days with gaps, one row a day: rows n back are n days old or don't count."""
    r = random.Random(most_rows)
    days = sorted(r.sample(range(700), 600))
    rows = spark.createDataFrame([(day(d), "S", p, d, float(d)) for d in days for p in "AB"], "date date, store_id string, product_id string, units_sold long, revenue double")
    c = features.FeatureConfig(lags=(1, 2, 28, 40), rolling=(2, 5), abc_days=9, xyz_days=8, least_history=2)
    order = ("date", "product_id")
    assert c.reach == 40
    assert values(features.own_history(rows, c, *features.HISTORY, most_rows=most_rows), *order) == values(features.own_history(rows, c, *features.HISTORY), *order)


def test_all_features_with_sliced_histories(spark):
    from granary.plans import queries

    base = queries.base(spark, "/root/testdata/sf0.001").where("store_id in ('S000', 'S001')").cache()
    names = ("units_sold_lag_7d", "demand_observation_count_28d", "abc_class", "xyz_class", "volatility_segment")
    pick = lambda df: values(df.select("date", *features.KEY, *names), "date", *features.KEY)
    assert pick(features.demand_features(base, most_rows=50)) == pick(features.demand_features(base))
    base.unpersist()


@pytest.mark.parametrize("width", [1, 7, 32])
def test_offers_of_one_label_equal_brute_force(spark, width):
    r = random.Random(width)
    offers = []
    for k in range(1500):
        start = r.randint(-200, 400)
        end = start + r.choice([-1, 0, 0, 3, 20, 63, 64, 65, 300])
        offers.append((f"O{k:05d}", "Spring" if k % 20 else "Other", day(start), day(end), None if k % 3 else 0.5))
    offers += [("X1", None, DAY, DAY, 0.1), ("X2", "Spring", None, DAY, 0.1), ("X3", "Spring", DAY, None, 0.1), ("A0", "Spring", day(10), day(10), 0.2), ("A1", "Spring", day(10), day(12), 0.2)]
    sales = [(k, day(k % 400), label) for k, label in enumerate(["Spring", "Other", None, "None"] * 250)] + [(2000, None, "Spring"), (2001, day(5000), "Spring")]
    rows = spark.createDataFrame(sales, "k long, date date, sales_promotion string")
    side = spark.createDataFrame(offers, "promotion_id string, promotion_name string, start_date date, end_date date, discount_pct double")
    out = enrich.attach_promotion(rows, side, lambda d: d, width)
    assert "collect" not in plan(out)

    def best(date, label):
        on = [o for o in offers if label and o[1] == label and date and o[2] and o[3] and o[2] <= date <= o[3]]
        return min(on, key=lambda o: (-o[2].toordinal(), o[0]), default=None)

    for x in out.collect():
        want = best(x.date, x.sales_promotion)
        assert (x.promotion_id, x.promotion_name, x.start_date, x.end_date, x.promotion_discount_pct) == (want or (None,) * 5)
    assert enrich.attach_promotion(rows, side.limit(0), lambda d: d).where("promotion_id is null").count() == len(sales)


def test_an_offer_has_few_bins_however_long(spark):
    side = spark.createDataFrame([("P", "L", dt.date(1000, 1, 1), dt.date(3000, 1, 1), 0.5)], "promotion_id string, promotion_name string, start_date date, end_date date, discount_pct double")
    by_day, by_bin = enrich.offer_bins(side)
    assert by_day.count() < 2 * 32 and by_bin.count() == pytest.approx(2000 * 365.25 / 32, abs=3)


@pytest.mark.parametrize(("by", "parts"), [((), 1), ((), 7), ((), 500), (("g",), 7), (("g", "h"), 20)])
def test_running_equals_windows(spark, by, parts):
    r = random.Random(parts)
    rows = [(n, r.choice([None, r.randint(0, 300)]), r.choice(["x", "x", "x", "y", None]), r.choice([1, None]), r.choice([None, r.randint(-9, 9)]), r.choice([None, None, f"v{n}"])) for n in range(1500)]
    df = spark.createDataFrame(rows, "n long, at int, g string, h int, v long, w string").repartition(5)
    order = ["at", "n"]
    out = scan.running(df, order, by=by, total={"total": "v"}, last={"last_v": "v", "last_w": "w"}, following={"next_w": "w"}, parts=parts)
    own = Window.partitionBy(*by, F.lit(1)).orderBy(*order)
    up, down = own.rowsBetween(Window.unboundedPreceding, 0), own.rowsBetween(0, Window.unboundedFollowing)
    want = df.withColumns({"total": F.sum("v").over(up), "last_v": F.last("v", True).over(up), "last_w": F.last("w", True).over(up), "next_w": F.first("w", True).over(down)})
    assert out.columns == want.columns and values(out, "n") == values(want, "n")


def test_running_has_no_single_task_and_takes_hot_and_empty_orders(spark):
    df = spark.range(5000).select("id", F.lit(1).alias("at"), (F.col("id") % 7).alias("v"))
    out = scan.running(df, ["at", "id"], total={"total": "v"}, parts=8)
    assert "SinglePartition" not in plan(out)
    assert out.groupBy(F.spark_partition_id()).count().count() > 1
    last = out.orderBy(F.desc("id")).first()
    assert last.total == sum(k % 7 for k in range(5000))
    assert scan.running(df.limit(0), ["at", "id"], total={"total": "v"}).count() == 0
    # all rows equal in the order: they share a range, and each is summed once
    assert scan.running(df.withColumn("id", F.lit(0)), ["at", "id"], total={"total": "v"}).agg(F.max("total")).first()[0] == last.total


@pytest.mark.parametrize("by", [(), ("g",)])
def test_running_frames_only_grow(spark, by):
    """A frame from the row to the end of its range is computed anew for each row: the square of a range's rows."""
    df = spark.range(100).select("id", F.lit(1).alias("g"), F.when(F.col("id") % 3 == 0, F.col("id")).alias("v"))
    out = scan.running(df, ["id"], by=by, total={"total": "v"}, last={"last": "v"}, following={"next": "v"}, parts=2)
    assert "unboundedfollowing" not in plan(out).lower()
    assert [(r["last"], r["next"]) for r in out.orderBy("id").collect()] == [(k - k % 3, k + -k % 3) for k in range(100)]


def test_differences_and_states_by_hand(spark):
    kind = "k int, a string, b int"
    old = spark.createDataFrame([(1, "x", 1), (2, "x", None), (3, None, None), (None, "n", 0)], kind)
    new = spark.createDataFrame([(1, "x", 1), (2, None, None), (4, "y", 2), (None, "n", 1)], kind)
    assert {tuple(r) for r in history.difference(old, new, ["k"]).collect()} == {
        (2, "changed", "x", None, None, None), (3, "removed", None, None, None, None), (4, "added", None, "y", None, 2), (None, "changed", "n", "n", 0, 1),
    }
    assert history.difference(old, old, ["k"]).count() == 0
    assert {r.change for r in history.difference(old.limit(0), new, ["k"]).collect()} == {"added"}
    with pytest.raises(ValueError, match="same columns"):
        history.difference(old, new.drop("b"), ["k"])
    days = [day(0), day(1), day(5), day(9)]
    seen = [(1, "x", 0), (1, "x", 1), (1, "y", 5), (1, "y", 9), (2, "z", 0), (2, "z", 5), (None, "n", 1), (3, None, 9)]
    states = history.validity(spark.createDataFrame([(k, v, day(d)) for k, v, d in seen], "k int, v string, at date"), ["k"], "at", days)
    assert {tuple(r) for r in states.collect()} == {
        (1, "x", day(0), day(5)), (1, "y", day(5), None), (2, "z", day(0), day(1)), (2, "z", day(5), day(9)), (None, "n", day(1), day(5)), (3, None, day(9), None),
    }


def test_small_tables_run_once_and_large_ones_go_on_as_they_are(spark):
    ran = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            ran.add(b.num_rows)
            yield b

    side = spark.range(50).repartition(1).mapInArrow(count, "id long")
    joined = spark.range(100).join(sizes.small(side), "id")
    assert joined.count() == 50 and "BroadcastHashJoin" in plan(joined) and ran.value == 50
    big = spark.range(200)
    assert sizes.small(big, 100) is big
    assert sizes.small(spark.range(0)).count() == 0


def test_facts_by_key_join_without_an_exchange(spark):
    left = spark.range(3000).select((F.col("id") % 700).alias("a"), F.when(F.col("id") % 9 != 0, F.col("id") % 5).alias("b"), F.col("id").alias("x"))
    right = spark.range(900).select((F.col("id") % 800).alias("a"), (F.col("id") % 5).alias("b"), F.col("id").alias("y"))
    one, two = buckets.store(left, "test_left", ["a", "b"], 4), buckets.store(right, "test_right", ["a", "b"], 4)
    out = buckets.joined(one, two, ["a", "b"])
    assert "Exchange" not in plan(out) and "SortMergeJoin" in plan(out)
    assert values(out, "x", "y") == values(left.join(right, ["a", "b"], "left"), "x", "y")
    assert buckets.store(left.limit(5), "test_left", ["a", "b"], 4).count() == 5
    for bad in ("1x", "a.b", "a;b"):
        with pytest.raises(ValueError):
            buckets.store(left, bad, ["a"])
    with pytest.raises(ValueError, match="lacks"):
        buckets.store(left, "test_left", ["z"])
    spark.sql("drop table test_left")
    spark.sql("drop table test_right")
