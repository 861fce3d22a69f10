"""Data-quality rules as named predicates, counted in one aggregate a table.

A predicate that comes out null counts as a failure.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions.scalar import blank, matches
from granary.sources.contracts import TableSpec

#: Largest difference between revenue and units times price.
REVENUE_SLACK = 0.011

# fixed values: the season of each month
SEASONS = {12: "Winter", 1: "Winter", 2: "Winter", 3: "Summer", 4: "Summer", 5: "Summer", 6: "Monsoon", 7: "Monsoon", 8: "Monsoon",
           9: "Monsoon", 10: "Post-Monsoon", 11: "Post-Monsoon"}

Rules = dict[str, Column]


# The names of rules are fixed values, here and in the tables' rules below.
def column_rules(spec: TableSpec) -> Rules:
    """required, minimum, maximum, domain and format of each column, in contract order."""
    rules: Rules = {}
    for f in spec.schema:
        c, meta = F.col(f.name), f.metadata
        filled = c.isNotNull()
        text = c.cast("string")
        if meta["required"]:
            rules[f"{f.name}.required"] = blank(c) if meta["logical"] == "string" else c.isNull()
        if "minimum" in meta:
            rules[f"{f.name}.minimum"] = filled & (c < meta["minimum"])
        if "maximum" in meta:
            rules[f"{f.name}.maximum"] = filled & (c > meta["maximum"])
        if "allowed" in meta:
            rules[f"{f.name}.domain"] = filled & ~text.isin(meta["allowed"])
        if "pattern" in meta:
            rules[f"{f.name}.format"] = filled & ~matches(text, meta["pattern"])
    return rules


def _text(name: str) -> Column:
    """A missing optional text reads as an empty one."""
    return F.trim(F.coalesce(F.col(name), F.lit("")))


def _sales() -> Rules:
    price, discount = F.col("Price"), F.col("Discount")
    return {
        "sales.revenue_calculation": ~(F.abs(F.col("Revenue") - F.col("Units_Sold") * price) <= REVENUE_SLACK),
        "sales.discount_requires_promotion": (discount > 0) & (_text("Promotion") == ""),
        "sales.promotion_requires_discount": (discount == 0) & (_text("Promotion") != ""),
        "sales.positive_price": price <= 0,
        "sales.positive_competitor_price": F.col("Competitor_Price") <= 0,
    }


def _inventory() -> Rules:
    # received stock takes no part in the balance
    return {"inventory.stock_balance": F.col("Closing_Stock") != F.col("Opening_Stock") - F.col("Sold") - F.col("Damaged")}


def _orders() -> Rules:
    return {"purchase_order.delivery_sequence": F.col("Expected_Delivery_Date") < F.col("Order_Date")}


def _products() -> Rules:
    positive = {f"product.{c}.positive": F.col(c) <= 0 for c in ("Unit_Cost", "Selling_Price", "Weight", "Volume")}
    return positive | {
        "product.positive_margin": F.col("Selling_Price") < F.col("Unit_Cost"),
        "product.reorder_threshold": F.col("Reorder_Point") < F.col("Safety_Stock"),
    }


def _dates() -> Rules:
    day = F.col("Date")
    season = F.create_map(*[F.lit(x) for pair in SEASONS.items() for x in pair])
    expected = {
        "year": ("Year", F.year(day)),
        "month": ("Month", F.month(day)),
        "day": ("Day", F.dayofmonth(day)),
        "weekday": ("Weekday", F.date_format(day, "EEEE")),
        "quarter": ("Quarter", F.quarter(day)),
        "weekend": ("IsWeekend", F.weekday(day) >= 5),
        "season": ("Season", season[F.col("Month").cast("int")]),
    }
    return {f"date.{rule}": F.col(c) != value for rule, (c, value) in expected.items()}


def _promotions() -> Rules:
    return {"promotion.date_sequence": F.col("End_Date") < F.col("Start_Date")}


BUSINESS = {
    "Fact_Sales": _sales,
    "Fact_Inventory": _inventory,
    "Fact_PurchaseOrders": _orders,
    "Dim_Product": _products,
    "Dim_Date": _dates,
    "Promotion": _promotions,
}


def rules(spec: TableSpec) -> Rules:
    business = BUSINESS.get(spec.name)
    return column_rules(spec) | (business() if business else {})


def failures(named: Rules, only: Column | None = None) -> dict[str, Column]:
    """Aggregates that count each rule's failures, among ``only`` some of the rows."""
    some = F.lit(True) if only is None else only
    return {name: F.count_if(some & F.coalesce(violation, F.lit(True))) for name, violation in named.items()}


def report(rows: DataFrame, table: str, named: Rules, n_rows: bool = False) -> DataFrame:
    """table, rule, severity, failed_rows of the rules that fail, and ``n_rows`` if asked for, from one pass over ``rows``."""
    counted = rows.agg(*[c.alias(f"r{k}") for k, c in enumerate(failures(named).values())], F.count("*").alias("n_rows"))
    pairs = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"r{k}").alias("failed_rows")) for k, n in enumerate(named)])
    each = counted.select("n_rows", F.explode(pairs).alias("x")).where("x.failed_rows > 0")
    return each.select(F.lit(table).alias("table"), "x.rule", F.lit("ERROR").alias("severity"), "x.failed_rows", *["n_rows"] * n_rows)


def verdict(found: dict[str, int], table: str) -> str | None:
    failed = [f"{rule}={n}" for rule, n in found.items() if n]
    return f"{table}: " + "; ".join(failed) if failed else None
