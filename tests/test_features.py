import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from granary.operators import enrich, features
from granary.plans import queries


def fact(spark, rows):
    day = lambda k: dt.date(2024, 1, 1) + dt.timedelta(days=k)
    return spark.createDataFrame([(day(k), s, p, u, float(r)) for k, s, p, u, r in rows], "date date, store_id string, product_id string, units_sold long, revenue double")


def by_day(df, *names):
    return [tuple(r[n] for n in names) for r in df.orderBy("date", "store_id", "product_id").collect()]


def test_lag_needs_every_day_between(spark):
    out = queries._windows(fact(spark, [(k, "S", "P", k, k) for k in (0, 1, 2, 3, 4, 5, 6, 7, 9)]))
    assert [r[0] for r in by_day(out, "units_sold_lag_1d")] == [None, 0, 1, 2, 3, 4, 5, 6, None]
    assert [r[0] for r in by_day(out, "units_sold_lag_7d")] == [None] * 7 + [0, None]


def test_rolling_excludes_the_day_and_includes_the_edge(spark):
    out = queries._windows(fact(spark, [(0, "S", "P", 4, 1), (7, "S", "P", 8, 1), (8, "S", "P", 1, 1)]))
    got = by_day(out, "demand_observation_count_7d", "units_sold_rolling_mean_7d", "units_sold_rolling_std_7d")
    assert got == [(0, None, None), (1, 4.0, None), (1, 8.0, None)]


def test_abc_thresholds_and_ties(spark):
    rows = [(0, "S", p, 1, r) for p, r in (("A", 80), ("B", 15), ("C", 5), ("D", 0))] + [(1, "S", p, 1, 1) for p in "ABCD"]
    out = queries._windows(fact(spark, rows)).where(F.col("date") == dt.date(2024, 1, 2))
    assert by_day(out, "product_id", "abc_class") == [("A", "A"), ("B", "B"), ("C", "C"), ("D", "C")]
    zero = queries._windows(fact(spark, [(0, "S", "A", 1, 0), (1, "S", "A", 1, 1)]))
    assert by_day(zero, "abc_class") == [(None,), (None,)]


def test_segments_need_seven_observations(spark):
    out = queries._windows(fact(spark, [(k, "S", "P", 5, 1) for k in range(9)]))
    assert [r[0] for r in by_day(out, "volatility_segment")] == ["Insufficient_History"] * 7 + ["Stable"] * 2
    assert [r[0] for r in by_day(out, "xyz_class")] == [None] * 7 + ["X"] * 2
    none = queries._windows(fact(spark, [(k, "S", "P", 0, 1) for k in range(9)]))
    assert by_day(none, "volatility_segment", "xyz_class")[-1] == ("No_Demand", "Z")


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 40), st.integers(0, 20)), min_size=2, max_size=15, unique_by=lambda x: x[0]), st.integers(1, 9))
def test_no_leakage(spark, series, bump):
    """Changing a day's demand changes no history feature of that day or before."""
    last = max(k for k, _ in series)
    rows = [(k, "S", "P", u, u) for k, u in series]
    other = [(k, "S", "P", u + (bump if k == last else 0), u + (bump if k == last else 0)) for k, u in series]
    names = [n for n in queries._windows(fact(spark, rows)).columns if n not in ("units_sold", "revenue", "date", "store_id", "product_id", "__day", "__better")]
    assert by_day(queries._windows(fact(spark, rows)), *names) == by_day(queries._windows(fact(spark, other)), *names)


def test_holiday_distance(spark):
    dates = spark.sql("select date'2024-01-01' + k as date from (select explode(sequence(0, 4)) as k)")
    holidays = spark.sql("select date'2024-01-03' as date, 'B' as holiday_name union all select date'2024-01-03', 'A'")
    got = [tuple(r) for r in enrich.calendar(dates, holidays).orderBy("date").select("holiday_name", "days_since_previous_holiday", "days_to_next_holiday").collect()]
    assert got == [(None, None, 2), (None, None, 1), ("A", 0, 0), (None, 1, None), (None, 2, None)]


def test_promotion_choice(spark):
    sales = spark.sql("select date'2024-01-05' as date, 'S' as store_id, 'P' as product_id, 'X' as sales_promotion union all select date'2024-03-05', 'S', 'P', 'X' union all select date'2024-01-05', 'S', 'Q', null")
    promos = spark.sql("""select * from values ('P1', 'X', date'2024-01-01', date'2024-01-31', 0.1D), ('P3', 'X', date'2024-01-04', date'2024-01-06', 0.3D),
      ('P2', 'X', date'2024-01-04', date'2024-01-05', 0.2D) as t(promotion_id, promotion_name, start_date, end_date, discount_pct)""")
    got = enrich.attach_promotion(sales, promos).orderBy("date", "product_id")
    assert [(r.promotion_id, r.promotion_discount_pct) for r in got.collect()] == [("P2", 0.2), (None, None), (None, None)]


@pytest.mark.parametrize("bad", [{"lags": ()}, {"rolling": (1,)}, {"abc": (0.9, 0.8)}, {"cv": (1.0, 0.5)}, {"parity": (1.1, 1.0)}, {"abc_days": 3}])
def test_config_is_checked(bad):
    with pytest.raises(ValueError):
        features.FeatureConfig(**bad)


def test_history_windows_share_one_sort(spark):
    plan = queries._windows(fact(spark, [(0, "S", "P", 1, 1)]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(store_id") + plan.count("Exchange hashpartitioning(date") == 2
