"""DuckDB SQL for every retail query, written from the definitions and not from the Spark plans."""

from __future__ import annotations

from granary.functions.scalar import snake
from granary.plans.fixtures import ctes, duck
from granary.plans.queries import COLUMN_RULES, QUERIES, spec
from granary.sources.contracts import CONTRACTS

TYPES = {"s": "VARCHAR", "l": "BIGINT", "d": "DOUBLE", "b": "BOOLEAN", "t": "DATE"}


def _div(a: str, b: str) -> str:
    return f"(cast({a} as double) / nullif(cast({b} as double), 0))"


def _lag(n: int) -> str:
    return ", ".join(
        f"case when dn - lag(dn, {n}) over k = {n} then lag({x}, {n}) over k end as {x}_lag_{n}d" for x in ("units_sold", "revenue")
    )


def _past(w: int) -> str:
    return f"over (partition by store_id, product_id order by dn range between {w} preceding and 1 preceding)"


def _windows(source: str) -> str:
    """The window features of a fact, in three steps."""
    rolled = ", ".join(
        f"count(units_sold) {_past(w)} as demand_observation_count_{w}d, avg(units_sold) {_past(w)} as units_sold_rolling_mean_{w}d, "
        f"stddev_samp(units_sold) {_past(w)} as units_sold_rolling_std_{w}d"
        for w in (7, 28)
    )
    cv90, cv28 = _div("xyz_demand_std_90d", "xyz_demand_mean_90d"), _div("units_sold_rolling_std_28d", "units_sold_rolling_mean_28d")
    return duck(f"""
      numbered as (select *, DAYNO(date) as dn from {source}),
      own as (select *, {", ".join(_lag(n) for n in (1, 7, 14, 28))}, {rolled},
        sum(revenue) {_past(90)} as abc_revenue_90d, count(units_sold) {_past(90)} as xyz_observation_count_90d,
        avg(units_sold) {_past(90)} as xyz_demand_mean_90d, stddev_samp(units_sold) {_past(90)} as xyz_demand_std_90d
        from numbered window k as (partition by store_id, product_id order by dn)),
      shared as (select *, sum(abc_revenue_90d) over (partition by date, store_id) as total,
        sum(abc_revenue_90d) over (partition by date, store_id order by abc_revenue_90d desc nulls last, product_id
          rows between unbounded preceding and current row) as running from own),
      windowed as (select *, {_div("abc_revenue_90d", "total")} as abc_revenue_share_90d, {cv90} as xyz_demand_cv_90d, {cv28} as demand_cv_28d,
        case when {_div("running - abc_revenue_90d", "total")} < 0.80 then 'A' when {_div("running - abc_revenue_90d", "total")} < 0.95 then 'B'
          when {_div("running - abc_revenue_90d", "total")} is not null then 'C' end as abc_class,
        case when xyz_observation_count_90d < 7 then null when xyz_demand_mean_90d <= 0 then 'Z' when {cv90} <= 0.5 then 'X'
          when {cv90} <= 1 then 'Y' else 'Z' end as xyz_class,
        case when demand_observation_count_28d < 7 then 'Insufficient_History' when units_sold_rolling_mean_28d <= 0 then 'No_Demand'
          when {cv28} <= 0.5 then 'Stable' when {cv28} <= 1 then 'Variable' else 'Highly_Variable' end as volatility_segment
        from shared)""")


_CALENDAR = """
      calendar as (select d.*, h.holiday_name, h.holiday_name is not null as is_holiday,
        date_diff('day', (select max(x.date) from holiday_ x where x.date <= d.date), d.date) as days_since_previous_holiday,
        date_diff('day', d.date, (select min(x.date) from holiday_ x where x.date >= d.date)) as days_to_next_holiday
        from dates_ d left join (select date, min(holiday_name) as holiday_name from holiday_ group by date) h on h.date = d.date)"""

_BASE = f"""{_CALENDAR},
      offered as (select s.date, s.store_id, s.product_id, p.*,
        row_number() over (partition by s.date, s.store_id, s.product_id order by p.start_date desc, p.promotion_id) as place
        from sales_ s join promotion_ p on s.promotion = p.promotion_name and s.date between p.start_date and p.end_date),
      base as (select s.date, s.store_id, s.product_id, s.inventory_level, s.units_sold, s.units_ordered, s.price, s.discount, s.competitor_price,
        s.revenue, s.temperature as sales_temperature, s.weather as sales_weather, s.holiday as sales_holiday, s.promotion as sales_promotion,
        i.opening_stock, i.received_stock, i.sold, i.damaged, i.closing_stock, p.product_name, p.unit_cost, p.safety_stock, p.reorder_point,
        g.store_name, v.supplier_name, v.lead_time_days, w.warehouse_name, c.year, c.season, c.is_holiday, c.holiday_name,
        c.days_since_previous_holiday, c.days_to_next_holiday, y.temperature as weather_temperature, y.humidity as weather_humidity,
        y.rainfall as weather_rainfall, y.weather as weather_condition, o.promotion_id, o.promotion_name, o.discount_pct as promotion_discount_pct
        from sales_ s left join inventory_ i on i.date = s.date and i.store_id = s.store_id and i.product_id = s.product_id
          left join product_ p on p.product_id = s.product_id left join store_ g on g.store_id = s.store_id
          left join vendor_ v on v.supplier_id = p.supplier_id left join warehouse_ w on w.warehouse_id = g.warehouse_id
          left join calendar c on c.date = s.date left join sky_ y on y.date = s.date and y.city = g.city
          left join offered o on o.date = s.date and o.store_id = s.store_id and o.product_id = s.product_id and o.place = 1)"""

_DEPTH = "coalesce(promotion_discount_pct, discount, 0)"
_INDEX = _div("price", "competitor_price")
_DERIVED = f"""
        sin(2 * pi() * dayofyear(date) / 365.25) as day_of_year_sin, cos(2 * pi() * dayofyear(date) / 365.25) as day_of_year_cos,
        sin(2 * pi() * month(date) / 12) as month_sin, cos(2 * pi() * month(date) / 12) as month_cos,
        day(date) = 1 as is_month_start, date = last_day(date) as is_month_end,
        days_to_next_holiday between 1 and 7 as is_pre_holiday_7d, days_since_previous_holiday between 1 and 7 as is_post_holiday_7d,
        least(days_to_next_holiday, days_since_previous_holiday) as holiday_proximity_days,
        weather_rainfall > 0 or weather_condition in ('Rainy', 'Storm') as is_precipitation,
        weather_condition in ('Cold Wave', 'Heat Wave', 'Storm') as is_extreme_weather,
        case when weather_condition is null then null when weather_condition = 'Storm' then 3 when weather_condition in ('Cold Wave', 'Heat Wave') then 2
          when weather_condition in ('Fog', 'Rainy') then 1 else 0 end as weather_severity_score,
        weather_humidity / 100 as weather_humidity_ratio, weather_temperature - sales_temperature as temperature_source_delta,
        promotion_id is not null or discount > 0 as is_promotion, {_DEPTH} as promotion_discount_depth,
        discount - promotion_discount_pct as promotion_discount_variance, round(price * (1 - {_DEPTH}), 2) as theoretical_discounted_price,
        competitor_price - price as competitor_price_gap, {_div("competitor_price - price", "competitor_price")} as competitor_price_gap_pct,
        {_INDEX} as competitor_price_index, case when {_INDEX} is null then null when {_INDEX} < 0.98 then 'Below_Competitor'
          when {_INDEX} > 1.02 then 'Above_Competitor' else 'At_Parity' end as price_position, price <= competitor_price as is_price_competitive,
        inventory_level is not distinct from closing_stock as inventory_snapshot_matches,
        sales_holiday is not distinct from holiday_name as holiday_label_matches,
        sales_weather is not distinct from weather_condition as weather_label_matches,
        sales_promotion is not distinct from promotion_name as promotion_label_matches"""
_STOCK = f"""
        closing_stock <= 0 as is_stockout, closing_stock <= safety_stock as is_safety_stock_breach, closing_stock <= reorder_point as is_reorder_required,
        closing_stock + units_ordered as inventory_position, {_div("closing_stock", "units_sold_rolling_mean_7d")} as days_of_supply,
        {_div("sold", "opening_stock + received_stock")} as sell_through_rate,
        {_div("units_sold", "(opening_stock + closing_stock) / 2.0")} as inventory_turnover_proxy"""
_SIDES = ("sales", "inventory", "product", "store", "vendor", "warehouse", "dates", "holiday", "sky", "promotion")


def _on(fixture: str) -> str:
    return f"{ctes(fixture)}, {_windows(fixture + '_')}, result as (select * from windowed)"


def _derived() -> str:
    return f"{ctes(*_SIDES)}, {_BASE}, result as (select *, {_DERIVED} from base)"


def _wide() -> str:
    return f"{ctes(*_SIDES)}, {_BASE}, {_windows('base')}, result as (select *, {_DERIVED}, {_STOCK} from windowed)"


_PO = f"""{ctes("purchase", "product", "vendor", "store")}, result as (
  select o.*, p.product_name, p.brand, v.supplier_name, v.moq, v.reliability, s.store_name, s.city as store_city, s.warehouse_id,
    date_diff('day', order_date, expected_delivery_date) as expected_lead_time_days,
    date_diff('day', order_date, expected_delivery_date) - v.lead_time_days as lead_time_variance_days,
    round(o.quantity * p.unit_cost, 2) as order_value_at_cost, status = 'Pending' as is_pending, status = 'Delivered' as is_delivered,
    year(order_date) as order_year, month(order_date) as order_month
  from purchase_ o left join product_ p on p.product_id = o.product_id left join vendor_ v on v.supplier_id = o.supplier_id
    left join store_ s on s.store_id = o.store_id)"""


def _rules(table: str, fixture: str, named: dict[str, str]) -> str:
    each = " union all ".join(
        f"select '{rule}' as rule, count(*) filter (where coalesce({bad}, true)) as failed_rows from {fixture}_" for rule, bad in named.items()
    )
    return f"""{ctes(fixture)}, counted as ({each}),
      result as (select '{table}' as "table", rule, 'ERROR' as severity, failed_rows from counted where failed_rows > 0)"""


def _whole_report() -> str:
    """All rules of all tables with rules of their own."""
    parts = []
    for table, (fixture, business) in _BUSINESS.items():
        each = " union all ".join(
            f"select '{rule}' as rule, count(*) filter (where coalesce({bad}, true)) as failed_rows, count(*) as n_rows from {fixture}_" for rule, bad in (_column_rules(table) | business).items()
        )
        parts.append(f"""select '{table}' as "table", rule, 'ERROR' as severity, failed_rows, n_rows from ({each}) where failed_rows > 0""")
    return f"{ctes(*(f for f, _ in _BUSINESS.values()))}, result as ({' union all '.join(parts)})"


def _column_rules(table: str, *, only: tuple[str, ...] = COLUMN_RULES) -> dict[str, str]:
    out = {}
    for f in CONTRACTS[table].schema:
        c, meta = snake(f.name), f.metadata
        tests = {
            ".required": (meta["required"], f"{c} is null or regexp_full_match(cast({c} as varchar), '\\s*')"),
            ".minimum": ("minimum" in meta, f"{c} is not null and {c} < {meta.get('minimum')}"),
            ".maximum": ("maximum" in meta, f"{c} is not null and {c} > {meta.get('maximum')}"),
            ".domain": ("allowed" in meta, f"{c} is not null and {c} not in ({', '.join(repr(v) for v in meta.get('allowed', ()))})"),
            ".format": ("pattern" in meta, f"{c} is not null and not regexp_full_match({c}, '{meta.get('pattern')}')"),
        }
        out |= {f"{f.name}{k}": sql for k, (has, sql) in tests.items() if has and k in only}
    return out


#: Fixture and own rules of each table that has some.
_BUSINESS: dict[str, tuple[str, dict[str, str]]] = {
    "Fact_Sales": ("sales", {
        "sales.revenue_calculation": "not abs(cast(revenue as double) - units_sold * price) <= 0.011",
        "sales.discount_requires_promotion": "discount > 0 and trim(coalesce(promotion, '')) = ''",
        "sales.promotion_requires_discount": "discount = 0 and trim(coalesce(promotion, '')) <> ''",
        "sales.positive_price": "price <= 0",
        "sales.positive_competitor_price": "competitor_price <= 0",
    }),
    "Fact_Inventory": ("inventory", {"inventory.stock_balance": "closing_stock <> opening_stock - sold - damaged"}),
    "Fact_PurchaseOrders": ("purchase", {"purchase_order.delivery_sequence": "expected_delivery_date < order_date"}),
    "Dim_Product": ("product", {
        **{f"product.{c}.positive": f"{c.lower()} <= 0" for c in ("Unit_Cost", "Selling_Price", "Weight", "Volume")},
        "product.positive_margin": "selling_price < unit_cost",
        "product.reorder_threshold": "reorder_point < safety_stock",
    }),
    "Dim_Date": ("dates", {
        "date.year": "year <> year(date)",
        "date.month": "month <> month(date)",
        "date.day": "day <> day(date)",
        "date.weekday": "weekday <> dayname(date)",
        "date.quarter": "quarter <> quarter(date)",
        "date.weekend": "is_weekend <> (isodow(date) >= 6)",
        "date.season": "season <> case when month in (12, 1, 2) then 'Winter' when month between 3 and 5 then 'Summer' "
                       "when month between 6 and 9 then 'Monsoon' when month in (10, 11) then 'Post-Monsoon' end",
    }),
    "Promotion": ("promotion", {"promotion.date_sequence": "end_date < start_date"}),
}


def _running(by: str, value: str, name: str) -> str:
    up = f"over ({by} order by ts, event_id rows between unbounded preceding and current row)"
    down = f"over ({by} order by ts, event_id rows between current row and unbounded following)"
    return f"""{ctes("ordered_events")}, result as (select event_id, sum(amount) {up} as running_amount, last_value({value} ignore nulls) {up} as {name},
      first_value(purchase ignore nulls) {down} as next_purchase from ordered_events_)"""


_NUMBER = r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"
_CELLS = ctes("cells")
_DOUBLE = f"case when regexp_full_match(trim(number), '{_NUMBER}') then try_cast(trim(number) as double) end"

_FILLED = "{0} is not null and not regexp_full_match({0}, '\\s*')"

ORACLES: dict[str, str] = {
    "rolling_demand": _on("priced"),
    "rolling_std": _on("priced"),
    "contiguous_lags": _on("event_fact"),
    "contiguous_lags_dense_whole": _on("dense_whole"),
    "abc_class": _on("priced"),
    "abc_revenue_share": _on("priced"),
    "xyz_class": _on("priced"),
    "volatility_segment_whole": _on("dense_whole"),
    "holiday_distance": f"{ctes('dates', 'holiday')}, {_CALENDAR}, result as (select * from calendar)",
    **dict.fromkeys(
        ("calendar_cycle", "month_boundary_flags", "holiday_flags", "weather_join", "weather_flags", "weather_severity", "promotion_top1",
         "promotion_features", "competitor_features", "price_position", "demand_base_joins", "label_match_flags"),
        _derived(),
    ),
    "promotion_interval_join": f"""{ctes("sales", "promotion")}, result as (select * from sales_ s join promotion_ p
      on s.promotion = p.promotion_name and s.date between p.start_date and p.end_date)""",
    **dict.fromkeys(("inventory_flags", "inventory_ratios", "demand_features_wide"), _wide()),
    "po_dim_joins": _PO,
    "po_features": _PO,
    "dedup_keep_first": """with lines as (select l_orderkey, l_linenumber, concat_ws('|', strftime(l_shipdate, '%Y-%m-%d'),
      cast(cast(l_extendedprice as decimal(18, 2)) as varchar), cast(l_partkey as varchar), cast(l_suppkey as varchar)) as position from lineitem),
      result as (select l_orderkey, l_linenumber, min(position) as position from lines group by l_orderkey, l_linenumber)""",
    "duplicate_counts": """with result as (select count(*) as n_rows, count(*) - (select count(*) from (select distinct l_orderkey, l_linenumber
      from lineitem)) as n_duplicates from lineitem)""",
    "missing_counts": _CELLS + ", result as (select " + ", ".join(
        f"count(*) filter (where {c} is null or regexp_full_match({c}, '\\s*')) as missing_{c}" for c in ("number", "day", "flag", "code", "note")
    ) + " from cells_)",
    "missing_fill": f"{ctes('sales')}, result as (select * replace (coalesce(promotion, 'None') as promotion) from sales_)",
    "missing_drop": f"{ctes('sales')}, result as (select * from sales_ where promotion is not null)",
    "trim_blank_to_null": _CELLS + ", result as (select id, nullif(trim(note, ' '), '') as note, nullif(trim(code, ' '), '') as code from cells_)",
    "quality_column_rules": _rules("Fact_Sales", "sales", _column_rules("Fact_Sales")),
    "domain_rule": _rules("Dim_Product", "product", _column_rules("Dim_Product", only=(".domain",))),
    **{f"quality_{name}_rules": _rules(table, *_BUSINESS[table]) for name, table in (
        ("sales", "Fact_Sales"), ("product", "Dim_Product"), ("date", "Dim_Date"), ("promotion", "Promotion"), ("inventory", "Fact_Inventory"), ("po", "Fact_PurchaseOrders"),
    )},
    "quality_every_rule": _whole_report(),
    "demand_base_broadcast": _derived(),
    "po_joins_broadcast": _PO,
    "dedup_null_keys": f"{ctes('runs')}, result as (select store_key, kind, min(event_id) as event_id from runs_ group by store_key, kind)",
    "dedup_latest_version": f"""{ctes("runs")}, placed as (select *, row_number() over (partition by store_key, kind
      order by ingestion_date desc nulls last, _modified desc nulls last, run_id desc nulls last) as place from runs_), result as (select * from placed where place = 1)""",
    "snake_case_names": f"{ctes('dates')}, result as (select * from dates_)",
    "cast_failure_counts": _CELLS + f""", result as (select
      count(*) filter (where {_FILLED.format("number")} and (case when regexp_full_match(trim(number), '[+-]?[0-9]+') then try_cast(trim(number) as bigint)
        when {_DOUBLE} % 1 = 0 then cast({_DOUBLE} as bigint) end) is null) as cast_integer,
      count(*) filter (where {_FILLED.format("number")} and ({_DOUBLE}) is null) as cast_decimal,
      count(*) filter (where {_FILLED.format("day")} and (case when regexp_full_match(day, '\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}') then try_cast(day as date) end) is null) as cast_day,
      count(*) filter (where {_FILLED.format("flag")} and flag not in ('True', 'False')) as cast_flag from cells_)""",
    "missing_policy_counters": f"""{ctes("sales")}, result as (select count(*) filter (where holiday is null) as dropped_rows,
      count(*) filter (where promotion is null and holiday is not null) as filled_values,
      count(*) filter (where promotion is null) + count(*) filter (where holiday is null) as preserved_values,
      count(*) filter (where promotion is null) as missing_promotion from sales_)""",
    "bucketed_inventory_join": f"""{ctes("sales", "inventory")}, result as (select s.*, i.opening_stock, i.received_stock, i.closing_stock from sales_ s
      left join inventory_ i on i.date = s.date and i.store_id = s.store_id and i.product_id = s.product_id)""",
    "malformed_order_lines": f"""{ctes("order_lines")}, told as (select o_orderkey as n, o_custkey, o_orderstatus, case o_orderkey % 23 when 3 then 'width' when 5 then 'width' when 15 then 'width'
        when 7 then 'cast.order_key,cast.day' when 9 then 'missing.customer,missing.status' when 11 then 'total.minimum,status.domain' else '' end as reasons from orders),
      result as (select n, reasons, case when reasons = '' then n end as order_key, case when reasons = '' then o_custkey end as customer,
        case when n % 23 = 13 then 1.5 when reasons = '' then n % 1000 + 0.25 end as total, case when n % 23 = 13 then date '2024-01-05' when reasons = '' then date '1997-03-04' end as day,
        case when n % 23 = 13 then 'Open' when reasons = '' then case when o_orderstatus = 'P' then 'Part, "P"' else 'Open' end end as status from told)""",
    "unseen_keys": """with e as (select event_id, event_type, case when user_id % 50 <> 0 then user_id end as user_id, hour(ts) as hour, ts from events),
      result as (select * from e where ts >= timestamp '2024-01-20' and not exists (select 1 from e o where o.ts < timestamp '2024-01-20' and o.user_id is not distinct from e.user_id and o.event_type = e.event_type and o.hour = e.hour))""",
    "features_refreshed": _on("priced"),
    "rolling_hot_key": f"{ctes('skewed')}, {_windows('skewed_')}, result as (select * from own)",
    "promotion_many_offers": f"""{ctes("sales", "offers")}, met as (select s.date, s.store_id, s.product_id, p.*, row_number() over (
        partition by s.date, s.store_id, s.product_id order by p.start_date desc, p.promotion_id) as place
      from sales_ s join offers_ p on s.promotion = p.promotion_name and s.date between p.start_date and p.end_date),
      result as (select s.date, s.store_id, s.product_id, m.promotion_id, m.promotion_name, m.start_date, m.end_date, m.discount_pct as promotion_discount_pct
        from sales_ s left join met m on m.date = s.date and m.store_id = s.store_id and m.product_id = s.product_id and m.place = 1)""",
    "events_running": _running("", "purchase", "last_purchase"),
    "events_running_by_type": _running("partition by event_type", "user_id", "last_user"),
    "snapshot_difference": f"""{ctes("customer_days")}, a as (select * from customer_days_ where as_of = date '2024-01-01'), b as (select * from customer_days_ where as_of = date '2024-02-01'),
      met as (select coalesce(a.customer_key, b.customer_key) as customer_key, a.as_of is not null as was, b.as_of is not null as is_, a.name as old_name, b.name as new_name,
        a.nation as old_nation, b.nation as new_nation, a.segment as old_segment, b.segment as new_segment from a full join b on a.customer_key is not distinct from b.customer_key),
      result as (select *, case when not was then 'added' when not is_ then 'removed' else 'changed' end as change from met
        where not (was and is_ and old_name is not distinct from new_name and old_nation is not distinct from new_nation and old_segment is not distinct from new_segment))""",
    "snapshot_history": f"""{ctes("customer_days")}, d as (select *, month(as_of) as m from customer_days_),
      result as (select a.customer_key, a.name, a.nation, a.segment, a.as_of as valid_from, (
          select min(x.day) from (values (date '2024-01-01'), (date '2024-02-01'), (date '2024-03-01')) x(day) where x.day > a.as_of and not exists (
            select 1 from d b where b.as_of = x.day and b.customer_key is not distinct from a.customer_key and b.name is not distinct from a.name
              and b.nation is not distinct from a.nation and b.segment is not distinct from a.segment)) as valid_to
        from d a where not exists (select 1 from d b where b.m = a.m - 1 and b.customer_key is not distinct from a.customer_key and b.name is not distinct from a.name
          and b.nation is not distinct from a.nation and b.segment is not distinct from a.segment))""",
    "format_rule": _CELLS + r", result as (select id, code is not null and not regexp_full_match(code, 'S\d{3}') as bad from cells_)",
    "strict_decimal_cast": _CELLS + f", result as (select id, {_DOUBLE} as value from cells_)",
    "strict_integer_cast": _CELLS + f""", result as (select id, case when regexp_full_match(trim(number), '[+-]?[0-9]+') then try_cast(trim(number) as bigint)
      when {_DOUBLE} % 1 = 0 then cast({_DOUBLE} as bigint) end as value from cells_)""",
    "strict_date_cast": _CELLS + r", result as (select id, case when regexp_full_match(day, '\d{4}-\d{1,2}-\d{1,2}') then try_cast(day as date) end as value from cells_)",
    "strict_boolean_cast": _CELLS + ", result as (select id, case flag when 'True' then true when 'False' then false end as value from cells_)",
    "watermark_filter": f"{ctes('purchase')}, result as (select po_id, order_date from purchase_ where order_date > date '2000-01-01')",
    "max_watermark": f"""{ctes("purchase")}, result as (select strftime(max(order_date), '%Y-%m-%d') as watermark,
      count(*) filter (where order_date <= date '2000-01-01') as late_rows from purchase_)""",
}


def oracle_sql() -> dict[str, str]:
    def one(name: str, kind: str) -> str:
        cast = f'cast("{name}" as {TYPES[kind]})'
        return f'round({cast}, 6) + 0.0 as "{name}"' if kind == "d" else f'{cast} as "{name}"'

    return {n: f"{ORACLES[n]} select {', '.join(one(*c) for c in spec(QUERIES[n][1]))} from result" for n in QUERIES}
