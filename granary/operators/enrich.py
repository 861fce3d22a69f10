"""Cleaned tables to the enriched calendar, the demand base and purchase orders.

Dimensions have one row a key, so every sale keeps exactly one row. Small
dimensions are hinted for broadcast only where their size is checked by
``small``; beyond that the planner's own size rules decide.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from granary.functions.scalar import same, snake, trimmed
from granary.operators.sizes import small

#: Days of the wider of the two bins that offers are filed in.
BIN_DAYS = 32

Tables = dict[str, DataFrame]


def clean(rows: DataFrame) -> DataFrame:
    """Snake-case names; text without spaces around, blanks as null. One projection."""
    return rows.select(
        *[
            (trimmed(F.col(f"`{f.name}`")) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")).alias(
                f.name if f.name.startswith("_") else snake(f.name)
            )
            for f in rows.schema
        ]
    )


def calendar(dates: DataFrame, holidays: DataFrame, hint: Callable[[DataFrame], DataFrame] = small) -> DataFrame:
    """Dates with holiday_name, is_holiday and the days since the previous and to the next holiday.

    The calendar has one row a day, so its global order is a small sort. Of several holidays on a day, the least name.
    """
    named = holidays.groupBy("date").agg(F.min("holiday_name").alias("holiday_name"))
    joined = dates.join(hint(named), "date", "left")
    day = Window.orderBy("date")
    holiday = F.when(F.col("holiday_name").isNotNull(), F.col("date"))
    before = F.last(holiday, ignorenulls=True).over(day.rowsBetween(Window.unboundedPreceding, 0))
    after = F.first(holiday, ignorenulls=True).over(day.rowsBetween(0, Window.unboundedFollowing))
    return joined.withColumns(
        {
            "is_holiday": F.col("holiday_name").isNotNull(),
            "days_since_previous_holiday": F.date_diff("date", before),
            "days_to_next_holiday": F.date_diff(after, "date"),
        }
    )


def pick(rows: DataFrame, *names: str, **renamed: str) -> DataFrame:
    """Columns as they are, and others under a new name (new=old)."""
    return rows.select(*names, *[F.col(old).alias(new) for new, old in renamed.items()])


# The columns that each side brings, and the names they get, are fixed values, here and below.
def sales_side(sales: DataFrame) -> DataFrame:
    """The fact's columns; those that a dimension has too get the prefix sales_."""
    return pick(
        sales,
        *("date", "store_id", "product_id", "inventory_level", "units_sold", "units_ordered", "price", "discount", "competitor_price", "revenue"),
        **{f"sales_{c}": c for c in ("promotion", "holiday", "weather", "temperature", "humidity", "rainfall")},
    )


def attach_inventory(sales: DataFrame, inventory: DataFrame) -> DataFrame:
    return sales.join(inventory, ["date", "store_id", "product_id"], "left")


def attach_dimensions(rows: DataFrame, t: Tables, hint: Callable[[DataFrame], DataFrame] = small) -> DataFrame:
    """Product, store, the product's supplier, the store's warehouse."""
    store = pick(t["Dim_Store"], "store_id", "store_name", "store_size", "warehouse_id", store_city="city", store_state="state", store_region="region")
    supplier = pick(
        t["Dim_Supplier"],
        *("supplier_id", "supplier_name", "lead_time_days", "moq", "reliability", "supplier_city", "country"),
        supplier_state="state",
    )
    warehouse = pick(
        t["Dim_Warehouse"], "warehouse_id", "warehouse_name", "capacity_units", warehouse_city="city", warehouse_state="state", warehouse_region="region"
    )
    for side, key in ((t["Dim_Product"], "product_id"), (store, "store_id"), (supplier, "supplier_id"), (warehouse, "warehouse_id")):
        rows = rows.join(hint(side), key, "left")
    return rows


def attach_weather(rows: DataFrame, weather: DataFrame, hint: Callable[[DataFrame], DataFrame] = small) -> DataFrame:
    """The day's weather in the store's city."""
    side = pick(
        weather,
        date="date",
        store_city="city",
        weather_temperature="temperature",
        weather_humidity="humidity",
        weather_rainfall="rainfall",
        weather_condition="weather",
    )
    return rows.join(hint(side), ["date", "store_city"], "left")


def offer_bins(promotions: DataFrame, width: int = BIN_DAYS) -> tuple[DataFrame, DataFrame]:
    """Of each label, the first offer of every single day, and of every whole bin of ``width`` days, that some offer covers.

    An offer is filed under the bins that it covers whole and the days left at its ends, so under few entries however long
    it is; of each entry the offer that is latest to start, then of the least id, is found by an aggregate that combines
    before the shuffle. A label's offers never meet in one row or task.
    """
    first, last = F.unix_date("start_date"), F.unix_date("end_date")
    offer = F.struct((-first).alias("rank"), "promotion_id", "start_date", "end_date", F.col("discount_pct").alias("promotion_discount_pct"))
    whole_first, whole_last = F.ceil(first / width).cast("int"), (F.floor((last + 1) / width) - 1).cast("int")
    some = whole_first <= whole_last
    span = lambda a, b: F.when(a <= b, F.sequence(a, b)).otherwise(F.array().cast("array<int>"))
    days = F.when(some, F.concat(span(first, whole_first * width - 1), span((whole_last + 1) * width, last))).otherwise(span(first, last))
    usable = promotions.where("promotion_name is not null and start_date <= end_date")

    def best(entries: Column) -> DataFrame:
        filed = usable.select("promotion_name", F.explode(entries).alias("bin"), offer.alias("offer"))
        return filed.groupBy("promotion_name", "bin").agg(F.min("offer").alias("offer"))

    return best(days), best(F.when(some, span(whole_first, whole_last)))


def attach_promotion(rows: DataFrame, promotions: DataFrame, hint: Callable[[DataFrame], DataFrame] = small, width: int = BIN_DAYS) -> DataFrame:
    """The promotion of the sale's label that was on that day: of several, the latest to start, then the least id.

    A sale meets at most one offer filed under its day and one filed under its bin, so the fact is neither multiplied
    nor sorted, however many offers its label has.
    """
    joined, day = rows, F.unix_date("date")
    for name, table, at in zip(("__by_day", "__by_bin"), offer_bins(promotions, width), (day, F.floor(day / width)), strict=True):
        side = table.select(F.col("promotion_name").alias(f"{name}_label"), F.col("bin").alias(f"{name}_at"), F.col("offer").alias(name))
        joined = joined.join(hint(side), (F.col("sales_promotion") == F.col(f"{name}_label")) & (at == F.col(f"{name}_at")), "left")
    joined = joined.withColumn("__offer", F.least("__by_day", "__by_bin"))
    found = F.col("__offer").isNotNull()
    return joined.select(
        *rows.columns,
        F.when(found, F.col("sales_promotion")).alias("promotion_name"),
        *[F.col(f"__offer.{c}").alias(c) for c in ("promotion_id", "start_date", "end_date", "promotion_discount_pct")],
    )


def label_flags() -> dict[str, Column]:
    """Whether the fact's own labels agree with what was joined; never null."""
    pairs = {
        "inventory_snapshot": ("inventory_level", "closing_stock"),
        "holiday_label": ("sales_holiday", "holiday_name"),
        "weather_label": ("sales_weather", "weather_condition"),
        "promotion_label": ("sales_promotion", "promotion_name"),
    }
    return {f"{name}_matches": same(F.col(a), F.col(b)) for name, (a, b) in pairs.items()}


def demand_base(t: Tables, days: DataFrame, hint: Callable[[DataFrame], DataFrame] = small) -> DataFrame:
    """One row a sale: date, store_id, product_id with everything known about it."""
    rows = attach_inventory(sales_side(t["Fact_Sales"]), t["Fact_Inventory"])
    rows = attach_dimensions(rows, t, hint).join(hint(days), "date", "left")
    rows = attach_weather(rows, t["Weather"], hint)
    rows = attach_promotion(rows, t["Promotion"], hint)
    return rows.withColumns(label_flags())


def order_columns() -> dict[str, Column]:
    lead = F.date_diff("expected_delivery_date", "order_date")
    return {
        "expected_lead_time_days": lead,
        "lead_time_variance_days": lead - F.col("lead_time_days"),
        "order_value_at_cost": F.round(F.col("quantity") * F.col("unit_cost"), 2),
        "is_pending": F.col("status") == "Pending",
        "is_delivered": F.col("status") == "Delivered",
        "order_year": F.year("order_date"),
        "order_month": F.month("order_date"),
    }


def purchase_orders(t: Tables, hint: Callable[[DataFrame], DataFrame] = small) -> DataFrame:
    """Orders with their product, supplier and store."""
    product = pick(t["Dim_Product"], "product_id", "product_name", "category", "sub_category", "brand", "unit_cost", "selling_price")
    supplier = pick(t["Dim_Supplier"], "supplier_id", "supplier_name", "lead_time_days", "moq", "reliability")
    store = pick(t["Dim_Store"], "store_id", "store_name", "warehouse_id", store_city="city", store_region="region")
    rows = t["Fact_PurchaseOrders"]
    for side, key in ((product, "product_id"), (supplier, "supplier_id"), (store, "store_id")):
        rows = rows.join(hint(side), key, "left")
    return rows.withColumns(order_columns())
