"""The retail queries on fixtures, each with the columns it returns."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.functions.scalar import blank, matches, snake, strict
from granary.operators import dedup, enrich, features, history, incremental, missing, quality, scan
from granary.plans import ingest, refresh
from granary.plans.fixtures import frame
from granary.sources import buckets, key_index, ledger
from granary.sources.contracts import CONTRACTS, TableSpec, column

#: Types of result columns: text, long, double (rounded to 6 places), boolean, date
KINDS = {"s": "string", "l": "bigint", "d": "double", "b": "boolean", "t": "date"}

KEY = "date:t store_id:s product_id:s"
Spec = list[tuple[str, str]]


def spec(text: str) -> Spec:
    return [tuple(x.split(":")) for x in text.split()]


def shaped(df: DataFrame, columns: Spec) -> DataFrame:
    """Columns under their stated types, doubles rounded so that engines agree."""

    def one(name: str, kind: str) -> Column:
        c = F.col(name).cast(KINDS[kind])
        return (F.round(c, 6) + F.lit(0.0) if kind == "d" else c).alias(name)

    return df.select(*[one(n, k) for n, k in columns])


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Fixtures under their contracts' names, columns in snake case."""
    built: dict[str, DataFrame] = {}
    of = {
        "Fact_Sales": "sales", "Fact_Inventory": "inventory", "Fact_PurchaseOrders": "purchase", "Dim_Product": "product", "Dim_Store": "store",
        "Dim_Date": "dates", "Dim_Supplier": "vendor", "Dim_Warehouse": "warehouse", "Weather": "sky", "Promotion": "promotion", "Holiday": "holiday",
    }
    return {name: frame(spark, sf_dir, fixture, built) for name, fixture in of.items()}


def contracted(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A fixture with its contract's own column names and types."""
    rows = tables(spark, sf_dir)[table]
    have = set(rows.columns)
    return rows.select(*[F.col(snake(f.name)).cast(f.dataType).alias(f.name) for f in CONTRACTS[table].schema if snake(f.name) in have])


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    return enrich.demand_base(t, enrich.calendar(t["Dim_Date"], t["Holiday"], lambda d: d), hint=lambda d: d)


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.purchase_orders(tables(spark, sf_dir), hint=lambda d: d)


def days(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir)
    return enrich.calendar(t["Dim_Date"], t["Holiday"])


def _windows(rows: DataFrame) -> DataFrame:
    """History, portfolio and class features of a bare fact."""
    c = features.FeatureConfig()
    own = features.history(rows, c, features.lag_features(c), features.rolling_features(c), features.lookback_features(c))
    shared = own.select("*", *[v.alias(k) for k, v in features.portfolio_features(c).items()])
    return shared.select("*", *[v.alias(k) for k, v in features.class_features(c).items()])


def _fact(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: _windows(frame(spark, sf_dir, name).select("date", "store_id", "product_id", "units_sold", "revenue"))


def _plain(*catalogues: Callable[[], features.Features]) -> Callable[[SparkSession, str], DataFrame]:
    """Features that need no window, on the demand base."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = base(spark, sf_dir)
        return rows.select("*", *[v.alias(k) for make in catalogues for k, v in make().items()])

    return run


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.demand_features(base(spark, sf_dir))


def _report(table: str, pick: Callable[[str], bool], add: Callable[[DataFrame], DataFrame] = lambda d: d) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = add(contracted(spark, sf_dir, table))
        have = set(rows.columns)
        named = {k: v for k, v in quality.rules(CONTRACTS[table]).items() if pick(k) and (k.split(".")[0] in have or not k.endswith(COLUMN_RULES))}
        return quality.report(rows, table, named)

    return run


COLUMN_RULES = (".required", ".minimum", ".maximum", ".domain", ".format")


def _business(table: str):
    return _report(table, lambda rule: not rule.endswith(COLUMN_RULES))


def _missing_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = frame(spark, sf_dir, "cells")
    return cells.agg(*[F.count_if(blank(F.col(c))).alias(f"missing_{c}") for c in ("number", "day", "flag", "code", "note")])


def _policy(strategy: missing.OnMissing) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = contracted(spark, sf_dir, "Fact_Sales").select(*[F.col(c).cast("string").alias(c) for c in CONTRACTS["Fact_Sales"].columns])
        policy = missing.MissingPolicy({"Promotion": strategy, "Holiday": missing.OnMissing.PRESERVE}, {"Promotion": "None"})
        kept = missing.apply(rows, CONTRACTS["Fact_Sales"], policy)
        return kept.select(*[F.col(c).alias(snake(c)) for c in ("Date", "Store_ID", "Product_ID", "Promotion", "Holiday")])

    return run


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frame(spark, sf_dir, "lineitem").withColumn(
        "position", F.concat_ws("|", F.date_format("l_shipdate", "yyyy-MM-dd"), F.col("l_extendedprice").cast("decimal(18,2)"), "l_partkey", "l_suppkey")
    )


def _keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.keep_first(_lines(spark, sf_dir), ["l_orderkey", "l_linenumber"], "position")


def _duplicate_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frame(spark, sf_dir, "lineitem").agg(
        F.count("*").alias("n_rows"), dedup.duplicates(["l_orderkey", "l_linenumber"]).alias("n_duplicates")
    )


def _watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.newer(contracted(spark, sf_dir, "Fact_PurchaseOrders"), CONTRACTS["Fact_PurchaseOrders"], "2000-01-01").select(
        F.col("PO_ID").alias("po_id"), F.col("Order_Date").alias("order_date")
    )


def _max_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = CONTRACTS["Fact_PurchaseOrders"]
    return contracted(spark, sf_dir, s.name).agg(incremental.highest(s).alias("watermark"), incremental.late(s, "2000-01-01").alias("late_rows"))


def _promotion_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every promotion of a sale's label on its day, before one is chosen."""
    t = tables(spark, sf_dir)
    on = (F.col("sales_promotion") == F.col("promotion_name")) & F.col("date").between(F.col("start_date"), F.col("end_date"))
    return enrich.sales_side(t["Fact_Sales"]).join(t["Promotion"], on)


def _whole_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rule of every table with rules of its own, with the rows it was put to."""
    out = None
    for table in quality.BUSINESS:
        rows = contracted(spark, sf_dir, table)
        found = quality.report(rows, table, quality.rules(CONTRACTS[table]), n_rows=True)
        out = found if out is None else out.union(found)
    return out


def _null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.keep_first(frame(spark, sf_dir, "runs"), ["store_key", "kind"], "event_id")


def _latest_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.keep_latest(frame(spark, sf_dir, "runs"), ["store_key", "kind"])


def _as_text(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    rows = contracted(spark, sf_dir, table)
    return rows.select(*[F.col(c).cast("string").alias(c) for c in rows.columns])


def _cells(number: str) -> TableSpec:
    """The text cells as a table of their own."""
    return TableSpec("Cells", T.StructType([column("number", number), column("day", "date"), column("flag", "boolean"), column("code", "string")]), ("number",))


def _cast_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole, fraction = (ingest.cast_failures(_cells(kind)) for kind in ("integer", "decimal"))
    counts = {"cast_integer": whole["cast.number"], "cast_decimal": fraction["cast.number"], "cast_day": whole["cast.day"], "cast_flag": whole["cast.flag"]}
    return frame(spark, sf_dir, "cells").agg(*[c.alias(n) for n, c in counts.items()])


def _policy_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = CONTRACTS["Fact_Sales"]
    policy = missing.MissingPolicy({"Promotion": missing.OnMissing.FILL, "Holiday": missing.OnMissing.DROP_ROW}, {"Promotion": "None"})
    found, kept = missing.counters(sales, policy), missing.counters(sales, missing.MissingPolicy())
    every = {k: found[k] for k in ("dropped_rows", "filled_values")} | {"preserved_values": kept["preserved_values"], "missing_promotion": found["missing.Promotion"]}
    return _as_text(spark, sf_dir, "Fact_Sales").agg(*[c.alias(k) for k, c in every.items()])


def _broadcast_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The joins as curation runs them: small dimensions are counted, then broadcast."""
    t = tables(spark, sf_dir)
    return enrich.demand_base(t, enrich.calendar(t["Dim_Date"], t["Holiday"]))


def _hot_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Histories of order lines, the larger keys in slices."""
    return features.own_history(frame(spark, sf_dir, "skewed"), _C, features.rolling_features, features.lookback_features, most_rows=HOT_ROWS)


def _many_offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    built: dict[str, DataFrame] = {}
    sales = enrich.sales_side(frame(spark, sf_dir, "sales", built))
    return enrich.attach_promotion(sales, frame(spark, sf_dir, "offers", built), hint=lambda d: d)


def _running_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = {"running_amount": "amount"}, {"last_purchase": "purchase"}, {"next_purchase": "purchase"}
    return scan.running(frame(spark, sf_dir, "ordered_events"), ["ts", "event_id"], total=named[0], last=named[1], following=named[2])


def _running_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Within event types, few and large, so that each lies in several ranges."""
    return scan.running(
        frame(spark, sf_dir, "ordered_events"), ["ts", "event_id"], by=("event_type",), total={"running_amount": "amount"}, last={"last_user": "user_id"}, following={"next_purchase": "purchase"}
    )


def _customers(spark: SparkSession, sf_dir: str, day: str) -> DataFrame:
    return frame(spark, sf_dir, "customer_days").where(F.col("as_of") == F.lit(day).cast("date")).drop("as_of")


def _customer_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.difference(_customers(spark, sf_dir, "2024-01-01"), _customers(spark, sf_dir, "2024-02-01"), ["customer_key"])


def _customer_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.validity(frame(spark, sf_dir, "customer_days"), ["customer_key"], "as_of", [dt.date(2024, m, 1) for m in (1, 2, 3)])


def _refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of the fact as it first was, brought up to date with late and corrected rows and the last months."""
    columns = ("date", "store_id", "product_id", "units_sold", "revenue")
    built: dict[str, DataFrame] = {}
    whole = frame(spark, sf_dir, "priced", built).select(*columns)
    early = frame(spark, sf_dir, "early_fact", built).select(*columns)
    changes = history.difference(early, whole, list(columns[:3])).select(*columns[:3])
    return refresh.refresh(whole, _windows(early), refresh.touched(changes, _C), _C, _windows)


#: Lines of orders as a table of their own.
ORDER_LINES = TableSpec(
    "Orders",
    T.StructType(
        [
            column("order_key", "integer"), column("customer", "integer"), column("total", "decimal", minimum=0), column("day", "date"),
            column("status", "string", allowed=["Open", 'Part, "P"']),
        ]
    ),
    ("order_key",),
)


def _ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ledger.judged(frame(spark, sf_dir, "order_lines"), ORDER_LINES)
    good = F.size("reasons") == 0
    return found.select("n", F.array_join("reasons", ",").alias("reasons"), *[F.when(good, F.col(c)).alias(c) for c in ORDER_LINES.columns])


def _unseen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of the last days whose user, type and hour no earlier day has had."""
    user = F.when(F.col("user_id") % 50 != 0, F.col("user_id"))
    events = frame(spark, sf_dir, "events").select("event_id", "event_type", user.alias("user_id"), F.hour("ts").alias("hour"), "ts")
    key, split = ["user_id", "event_type", "hour"], F.col("ts") < F.lit("2024-01-20").cast("timestamp")
    old, new = events.where(split), events.where(~split)
    maybe = key_index.maybe_known(new, key_index.filter_words(old, key), key)
    return key_index.without(new, key_index.among(old, maybe, key), key)


def _bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales and their inventory, both stored by key."""
    built: dict[str, DataFrame] = {}
    key = ["date", "store_id", "product_id"]
    sales, inventory = (buckets.store(frame(spark, sf_dir, name, built), f"granary_{name}_by_key", key, 16) for name in ("sales", "inventory"))
    return buckets.joined(sales, inventory, key)


#: Rows of a key from which on its history is sliced.
HOT_ROWS = 5_000
ROLL = "demand_observation_count_7d:l units_sold_rolling_mean_7d:d demand_observation_count_28d:l units_sold_rolling_mean_28d:d"
LAGS = " ".join(f"{x}_lag_{n}d:{k}" for n in (1, 7, 14, 28) for x, k in (("units_sold", "l"), ("revenue", "d")))
REPORT = "table:s rule:s severity:s failed_rows:l"
CYCLE = "day_of_year_sin:d day_of_year_cos:d month_sin:d month_cos:d"
MONTH = "is_month_start:b is_month_end:b"
CALENDAR = "date:t holiday_name:s is_holiday:b days_since_previous_holiday:l days_to_next_holiday:l"
HOLIDAY = "is_pre_holiday_7d:b is_post_holiday_7d:b holiday_proximity_days:l"
SKY = "is_precipitation:b is_extreme_weather:b weather_humidity_ratio:d temperature_source_delta:d"
PROMO = "is_promotion:b promotion_discount_depth:d promotion_discount_variance:d theoretical_discounted_price:d"
RIVAL = "competitor_price_gap:d competitor_price_gap_pct:d competitor_price_index:d is_price_competitive:b"
STOCK = "is_stockout:b is_safety_stock_breach:b is_reorder_required:b inventory_position:l"
STOCK_RATIOS = "days_of_supply:d sell_through_rate:d inventory_turnover_proxy:d"
XYZ = "xyz_observation_count_90d:l xyz_demand_mean_90d:d xyz_demand_std_90d:d xyz_demand_cv_90d:d xyz_class:s"
FLAGS = "inventory_snapshot_matches:b holiday_label_matches:b weather_label_matches:b promotion_label_matches:b"
_C = features.FeatureConfig()

#: name: how its frame is built, the columns it returns
QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str]] = {
    "rolling_demand": (_fact("priced"), f"{KEY} {ROLL}"),
    "rolling_std": (_fact("priced"), f"{KEY} units_sold_rolling_std_7d:d units_sold_rolling_std_28d:d"),
    "contiguous_lags": (_fact("event_fact"), f"{KEY} {LAGS}"),
    "contiguous_lags_dense_whole": (_fact("dense_whole"), f"{KEY} {LAGS}"),
    "abc_class": (_fact("priced"), f"{KEY} abc_class:s"),
    "abc_revenue_share": (_fact("priced"), f"{KEY} abc_revenue_90d:d abc_revenue_share_90d:d"),
    "xyz_class": (_fact("priced"), f"{KEY} {XYZ}"),
    "volatility_segment_whole": (_fact("dense_whole"), f"{KEY} demand_cv_28d:d volatility_segment:s"),
    "calendar_cycle": (_plain(features.cycle_features), f"{KEY} {CYCLE}"),
    "month_boundary_flags": (_plain(features.cycle_features), f"{KEY} {MONTH}"),
    "holiday_distance": (days, CALENDAR),
    "holiday_flags": (_plain(features.holiday_features), f"{KEY} {HOLIDAY}"),
    "weather_join": (base, f"{KEY} weather_temperature:d weather_humidity:d weather_rainfall:d weather_condition:s"),
    "weather_flags": (_plain(features.weather_features), f"{KEY} {SKY}"),
    "weather_severity": (_plain(features.weather_features), f"{KEY} weather_severity_score:l"),
    "promotion_interval_join": (_promotion_pairs, f"{KEY} promotion_id:s promotion_name:s start_date:t end_date:t discount_pct:d"),
    "promotion_top1": (base, f"{KEY} promotion_id:s promotion_name:s promotion_discount_pct:d"),
    "promotion_features": (_plain(features.promotion_features), f"{KEY} {PROMO}"),
    "competitor_features": (_plain(lambda: features.competitor_features(_C)), f"{KEY} {RIVAL}"),
    "price_position": (_plain(lambda: features.competitor_features(_C)), f"{KEY} price_position:s"),
    "inventory_flags": (wide, f"{KEY} {STOCK}"),
    "inventory_ratios": (wide, f"{KEY} {STOCK_RATIOS}"),
    "demand_base_joins": (
        base,
        f"{KEY} opening_stock:l closing_stock:l product_name:s unit_cost:d store_name:s supplier_name:s lead_time_days:l warehouse_name:s "
        "year:l season:s is_holiday:b",
    ),
    "label_match_flags": (base, f"{KEY} {FLAGS}"),
    "po_dim_joins": (orders, "po_id:s product_name:s brand:s supplier_name:s moq:l reliability:d store_name:s store_city:s warehouse_id:s"),
    "po_features": (
        orders,
        "po_id:s expected_lead_time_days:l lead_time_variance_days:l order_value_at_cost:d is_pending:b is_delivered:b order_year:l order_month:l",
    ),
    "dedup_keep_first": (_keep_first, "l_orderkey:l l_linenumber:l position:s"),
    "duplicate_counts": (_duplicate_counts, "n_rows:l n_duplicates:l"),
    "missing_counts": (_missing_counts, "missing_number:l missing_day:l missing_flag:l missing_code:l missing_note:l"),
    "missing_fill": (_policy(missing.OnMissing.FILL), f"{KEY} promotion:s holiday:s"),
    "missing_drop": (_policy(missing.OnMissing.DROP_ROW), f"{KEY} promotion:s holiday:s"),
    "trim_blank_to_null": (lambda s, d: enrich.clean(frame(s, d, "cells")), "id:l note:s code:s"),
    "quality_column_rules": (_report("Fact_Sales", lambda rule: rule.endswith(COLUMN_RULES)), REPORT),
    "quality_sales_rules": (_business("Fact_Sales"), REPORT),
    "quality_product_rules": (_business("Dim_Product"), REPORT),
    "quality_date_rules": (_business("Dim_Date"), REPORT),
    "quality_promotion_rules": (_business("Promotion"), REPORT),
    "quality_inventory_rules": (_business("Fact_Inventory"), REPORT),
    "quality_po_rules": (_business("Fact_PurchaseOrders"), REPORT),
    "domain_rule": (_report("Dim_Product", lambda rule: rule.endswith(".domain")), REPORT),
    "format_rule": (lambda s, d: frame(s, d, "cells").select("id", (F.col("code").isNotNull() & ~matches(F.col("code"), r"S\d{3}")).alias("bad")), "id:l bad:b"),
    "strict_integer_cast": (lambda s, d: frame(s, d, "cells").select("id", strict(F.col("number"), "integer").alias("value")), "id:l value:l"),
    "strict_decimal_cast": (lambda s, d: frame(s, d, "cells").select("id", strict(F.col("number"), "decimal").alias("value")), "id:l value:d"),
    "strict_date_cast": (lambda s, d: frame(s, d, "cells").select("id", strict(F.col("day"), "date").alias("value")), "id:l value:t"),
    "strict_boolean_cast": (lambda s, d: frame(s, d, "cells").select("id", strict(F.col("flag"), "boolean").alias("value")), "id:l value:b"),
    "watermark_filter": (_watermark, "po_id:s order_date:t"),
    "max_watermark": (_max_watermark, "watermark:s late_rows:l"),
    "demand_base_broadcast": (_broadcast_base, f"{KEY} closing_stock:l product_name:s store_name:s supplier_name:s warehouse_name:s season:s weather_condition:s promotion_id:s"),
    "po_joins_broadcast": (lambda s, d: enrich.purchase_orders(tables(s, d)), "po_id:s product_name:s supplier_name:s store_name:s lead_time_variance_days:l"),
    "quality_every_rule": (_whole_report, f"{REPORT} n_rows:l"),
    "dedup_null_keys": (_null_keys, "store_key:l kind:s event_id:l"),
    "dedup_latest_version": (_latest_versions, "store_key:l kind:s ingestion_date:t _modified:t run_id:s"),
    "snake_case_names": (lambda s, d: enrich.clean(contracted(s, d, "Dim_Date")), "date:t year:l month:l day:l weekday:s quarter:l is_weekend:b season:s"),
    "cast_failure_counts": (_cast_failures, "cast_integer:l cast_decimal:l cast_day:l cast_flag:l"),
    "missing_policy_counters": (_policy_counters, "dropped_rows:l filled_values:l preserved_values:l missing_promotion:l"),
    "bucketed_inventory_join": (_bucketed, f"{KEY} units_sold:l opening_stock:l received_stock:l closing_stock:l"),
    "malformed_order_lines": (_ledger, "n:l reasons:s order_key:l customer:l total:d day:t status:s"),
    "unseen_keys": (_unseen, "event_id:l event_type:s user_id:l hour:l"),
    "features_refreshed": (_refreshed, f"{KEY} {ROLL} {LAGS} abc_revenue_90d:d abc_revenue_share_90d:d abc_class:s xyz_class:s volatility_segment:s"),
    "rolling_hot_key": (_hot_key, f"order_key:l line:l {ROLL} abc_revenue_90d:d xyz_observation_count_90d:l xyz_demand_mean_90d:d"),
    "promotion_many_offers": (_many_offers, f"{KEY} promotion_id:s promotion_name:s start_date:t end_date:t promotion_discount_pct:d"),
    "events_running": (_running_events, "event_id:l running_amount:d last_purchase:l next_purchase:l"),
    "events_running_by_type": (_running_types, "event_id:l running_amount:d last_user:l next_purchase:l"),
    "snapshot_difference": (_customer_changes, "customer_key:l change:s old_name:s new_name:s old_nation:l new_nation:l old_segment:s new_segment:s"),
    "snapshot_history": (_customer_history, "customer_key:l name:s nation:l segment:s valid_from:t valid_to:t"),
    "demand_features_wide": (
        wide,
        f"{KEY} {ROLL} {LAGS} abc_class:s xyz_class:s volatility_segment:s price_position:s {HOLIDAY} {PROMO} {STOCK} {STOCK_RATIOS} "
        "weather_severity_score:l is_precipitation:b is_extreme_weather:b",
    ),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(build, columns):
        return lambda spark, sf_dir: shaped(build(spark, sf_dir), spec(columns))

    return {name: bound(*q) for name, q in QUERIES.items()}
