import datetime

import pytest
from pyspark.sql import functions as F

from granary.functions.scalar import blank, matches, ratio, snake, strict, trimmed


def values(spark, expr, cells):
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(cells)], "k int, c string").select("k", expr(F.col("c")).alias("v"))
    return [r.v for r in rows.orderBy("k").collect()]


@pytest.mark.parametrize(
    ("name", "out"),
    [("PO_ID", "po_id"), ("MOQ", "moq"), ("IsWeekend", "is_weekend"), ("Lead_Time_Days", "lead_time_days"), ("a-b c", "a_b_c"), ("HTTPServer__X", "http_server_x")],
)
def test_snake(name, out):
    assert snake(name) == out


def test_strict_numbers(spark):
    cells = ["1.0", " 7 ", "1e3", "1.5", "inf", "NaN", "0x1F", "1d", "1_000", "", None, "-12", "9007199254740993", "1e400"]
    assert values(spark, lambda c: strict(c, "integer"), cells) == [1, 7, 1000, None, None, None, None, None, None, None, None, -12, 9007199254740993, None]
    assert values(spark, lambda c: strict(c, "decimal"), cells)[:4] == [1.0, 7.0, 1000.0, 1.5]
    assert values(spark, lambda c: strict(c, "decimal"), cells)[4:11] == [None] * 7


def test_strict_dates_and_flags(spark):
    day = datetime.date(2024, 1, 5)
    cells = ["2024-01-05", "2024-1-5", "2024-02-30", " 2024-01-05", "2024-01-05T00:00:00", None]
    assert values(spark, lambda c: strict(c, "date"), cells) == [day, day, None, None, None, None]
    assert values(spark, lambda c: strict(c, "boolean"), ["True", "False", "true", "1", "t"]) == [True, False, None, None, None]


def test_blank_and_trim_differ_on_tabs(spark):
    cells = ["", "  ", "\t", " a ", None, " "]
    assert values(spark, blank, cells) == [True, True, True, False, True, True]
    assert values(spark, trimmed, cells) == [None, None, "\t", "a", None, " "]


def test_whole_match(spark):
    assert values(spark, lambda c: matches(c, r"S\d{3}"), ["S001", "S001\n", "S1", "xS001"]) == [True, False, False, False]


def test_ratio_of_zero_is_null(spark):
    r = spark.sql("select 1 as a, 0 as b, cast(null as int) as c").select(ratio(F.col("a"), F.col("b")), ratio(F.col("a"), F.col("c")), ratio(F.col("b"), F.col("a"))).first()
    assert tuple(r) == (None, None, 0.0)
