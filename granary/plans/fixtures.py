"""Retail-shaped tables derived from the driver's star schema, as SQL that Spark and DuckDB share.

``{name}`` refers to another fixture or a driver table; ``DAYNO(x)`` is the number of a date since 1970-01-01;
``SPAN(a, b)`` makes a row of each day from a to b.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

DRIVER = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark",
          "labels", "conversations")

WEATHER = ("Cloudy", "Cold Wave", "Fog", "Heat Wave", "Rainy", "Storm", "Sunny")


def _case(expr: str, *values: str, other: str = "null") -> str:
    whens = " ".join(f"when {k} then {v}" for k, v in enumerate(values))
    return f"case {expr} {whens} else {other} end"


_SKY = [f"'{w}'" for w in WEATHER]

FIXTURES = {
    # a product is a brand, a store a region: gaps in most series
    "fact": """
        select cast(l.l_shipdate as date) as date, n.n_regionkey as r, cast(substr(p.p_brand, 7) as int) as b,
          cast(sum(l.l_quantity) as bigint) as units_sold, sum(cast(l.l_extendedprice as decimal(18, 2))) as revenue
        from {lineitem} l join {part} p on l.l_partkey = p.p_partkey join {supplier} s on l.l_suppkey = s.s_suppkey
          join {nation} n on s.s_nationkey = n.n_nationkey
        group by cast(l.l_shipdate as date), n.n_regionkey, cast(substr(p.p_brand, 7) as int)""",
    "keyed": "select *, cast(dayofyear(date) * 7 + r * 13 + b * 3 as int) as k from {fact}",
    "priced": """
        select *, concat('S00', cast(r as string)) as store_id, concat('P000', lpad(cast(b as string), 2, '0')) as product_id,
          cast(10 + k % 90 as double) + 0.5 as price from {keyed}""",
    # some rows break each rule of sales: a price of nothing or less, humidity above 100, revenue that isn't units times price
    "sales": f"""
        select date, store_id, product_id, cast(100 + k % 50 as bigint) as inventory_level, units_sold, cast(k % 20 as bigint) as units_ordered,
          cast(price as double) as price, cast(cast(k % 4 as double) * 0.125 as double) as discount,
          {_case("k % 5", "null", "'Spring'", "'Clearance'", "'Festive'", other="'None'")} as promotion,
          case when k % 9 = 0 then 'New Year' end as holiday, {_case("k % 7", *_SKY)} as weather,
          cast({_case("k % 7", "null", "cast(0 as double)", "price", "price * 1.25", "price * 0.75", "price * 1.0078125", other="price * 0.984375")}
            as double) as competitor_price,
          cast(k % 40 as double) as temperature, cast(k % 103 as double) as humidity, cast(k % 3 as double) * 0.5 as rainfall,
          case when k % 3 = 0 then revenue else cast(units_sold * price as decimal(18, 2)) end as revenue
        from (select date, store_id, product_id, units_sold, revenue, k,
          case when k % 101 = 0 then cast(0 as double) when k % 107 = 0 then cast(-1 as double) else price end as price from {{priced}}) x""",
    "inventory": """
        select date, store_id, product_id, cast(100 + k % 60 as bigint) as opening_stock, cast(k % 13 as bigint) as received_stock,
          units_sold as sold, cast(k % 3 as bigint) as damaged,
          100 + k % 60 - units_sold - k % 3 + case when k % 17 = 0 then 1 else 0 end as closing_stock
        from {priced} where k % 11 <> 0""",
    "product": f"""
        select concat('P000', lpad(cast(b as string), 2, '0')) as product_id, concat('Product ', cast(b as string)) as product_name,
          'Base' as base_product_name, {_case("b % 6", "'Clothing'", "'Electronics'", "'Furniture'", "'Groceries'", "'Toys'", other="'Other'")} as category,
          'Sub' as sub_category, concat('Brand#', cast(b as string)) as brand, cast(case when b % 7 = 4 then 0 else 5 + b end as double) as unit_cost,
          cast(case when b % 7 = 5 then 0 else 6 + b - case when b % 6 = 0 then 3 else 0 end end as double) as selling_price, cast(b * 2 as bigint) as safety_stock,
          cast(b * 3 - (b % 4) * b as bigint) as reorder_point, cast(b * 10 as bigint) as shelf_life,
          concat('SUP0', lpad(cast(b as string), 2, '0')) as supplier_id, cast(b % 11 - 1 as double) * 0.25 as weight, cast(b % 11 as double) * 0.5 as volume
        from (select distinct b from {{fact}}) x""",
    "store": f"""
        select concat('S00', cast(r_regionkey as string)) as store_id, concat('Store ', r_name) as store_name, r_name as city, 'State' as state,
          {_case("r_regionkey", "'Central'", "'East'", "'North'", "'South'", other="'West'")} as region, 'Large' as store_size,
          concat('WH0', cast(r_regionkey as string)) as warehouse_id from {{region}}""",
    "vendor": """
        select concat('SUP0', lpad(cast(n_nationkey as string), 2, '0')) as supplier_id, n_name as supplier_name,
          cast(1 + n_nationkey % 20 as bigint) as lead_time_days, cast(10 + n_nationkey as bigint) as moq,
          cast(0.5 as double) + cast(n_nationkey % 4 as double) * 0.125 as reliability, n_name as supplier_city, 'State' as state, 'IN' as country
        from {nation}""",
    "warehouse": """
        select concat('WH0', cast(r_regionkey as string)) as warehouse_id, concat('Warehouse ', r_name) as warehouse_name, r_name as city,
          'State' as state, 'East' as region, cast(1000 + r_regionkey as bigint) as capacity_units from {region} where r_regionkey < 4""",
    # some days break each rule of the calendar
    "dates": f"""
        select date, cast(year(date) + case when DAYNO(date) % 89 = 0 then 1 else 0 end as bigint) as year,
          cast(case when DAYNO(date) % 83 = 0 then month(date) % 12 + 1 when DAYNO(date) % 61 = 0 then 13 else month(date) end as bigint) as month,
          cast(day(date) + case when DAYNO(date) % 97 = 0 then 1 else 0 end as bigint) as day,
          case when DAYNO(date) % 79 = 0 then 'Noday' else {_case("(DAYNO(date) + 3) % 7", "'Monday'", "'Tuesday'", "'Wednesday'", "'Thursday'", "'Friday'", "'Saturday'", "'Sunday'")} end as weekday,
          cast(quarter(date) % 4 + case when DAYNO(date) % 73 = 0 then 1 else 0 end + case when quarter(date) = 4 then 4 else 0 end as bigint) as quarter,
          case when DAYNO(date) % 71 = 0 then (DAYNO(date) + 3) % 7 < 5 else (DAYNO(date) + 3) % 7 >= 5 end as is_weekend,
          case when month(date) in (12, 1, 2) then 'Winter' when month(date) <= 5 then 'Summer' when month(date) <= 9 then 'Monsoon'
            else case when DAYNO(date) % 31 = 0 then 'Winter' else 'Post-Monsoon' end end as season
        from (select distinct date from {{fact}} where DAYNO(date) % 50 <> 0) x""",
    "holiday": """
        select date, holiday_name from (
          select date, case when month = 1 and day(date) = 1 then 'New Year' when month = 1 and day(date) = 26 then 'Republic Day'
            when month = 8 and day(date) = 15 then 'Independence Day' when month = 10 and day(date) = 2 then 'Gandhi Jayanti'
            when month = 12 and day(date) = 25 then 'Christmas' end as holiday_name from {dates}) x where holiday_name is not null""",
    "sky": f"""
        select d.date, g.r_name as city, cast((dayofyear(d.date) * 7 + g.r_regionkey * 13) % 45 as double) as temperature,
          cast((dayofyear(d.date) + g.r_regionkey) % 101 as double) as humidity, cast((dayofyear(d.date) + g.r_regionkey) % 4 as double) * 0.5 as rainfall,
          {_case("(dayofyear(d.date) * 7 + g.r_regionkey * 13) % 8", *_SKY)} as weather
        from (select distinct date from {{fact}}) d cross join {{region}} g where (dayofyear(d.date) + g.r_regionkey) % 10 <> 0""",
    "promotion": """
        select 'PROMO0001' as promotion_id, 'Spring' as promotion_name, date '1996-01-01' as start_date, date '1998-12-31' as end_date,
          cast(0.25 as double) as discount_pct
        union all select 'PROMO0002', 'Spring', date '1997-01-01', date '1997-12-31', 0.5
        union all select 'PROMO0003', 'Spring', date '1997-01-01', date '1999-06-30', 0.125
        union all select 'PROMO0004', 'Clearance', date '1995-06-01', date '1996-05-31', 0.75
        union all select 'PROMO0005', 'Festive', date '1999-01-01', date '2001-12-31', null
        union all select 'PROMO0006', 'Festive', date '2000-01-01', date '1999-12-31', 0.5""",
    "purchase": """
        select concat(case when o.o_orderkey % 41 = 0 then 'PX' else 'PO' end, lpad(cast(o.o_orderkey as string), 7, '0')) as po_id, concat('SUP0', lpad(cast(x.s % 27 as string), 2, '0')) as supplier_id,
          concat('S00', cast(o.o_custkey % 6 as string)) as store_id, concat('P000', lpad(cast(x.p % 27 as string), 2, '0')) as product_id,
          cast(o.o_orderdate as date) as order_date, cast(o.o_orderdate as date) + cast(o.o_orderkey % 15 - 1 as int) as expected_delivery_date,
          cast(x.q as bigint) as quantity, case when o.o_orderstatus = 'P' then 'Pending' else 'Delivered' end as status
        from {orders} o join (select l_orderkey, min(l_partkey) as p, min(l_suppkey) as s, max(l_quantity) as q from {lineitem} group by l_orderkey) x
          on o.o_orderkey = x.l_orderkey""",
    # the same fact from events: short, nearly gapless series
    "event_fact": """
        select cast(ts as date) as date, concat('S00', cast(user_id % 5 as string)) as store_id, event_type as product_id,
          count(*) as units_sold, sum(cast(value as decimal(18, 2))) as revenue
        from {events} group by cast(ts as date), concat('S00', cast(user_id % 5 as string)), event_type""",
    "all_days": "select SPAN(least_date, greatest_date) as date from (select min(date) as least_date, max(date) as greatest_date from {fact}) x",
    # every day from the fact's first to its last for every key, zero where nothing was sold
    "dense_whole": """
        select d.date, k.store_id, k.product_id, coalesce(f.units_sold, cast(0 as bigint)) as units_sold,
          coalesce(f.revenue, cast(0 as decimal(18, 2))) as revenue
        from {all_days} d cross join (select distinct store_id, product_id from {priced}) k
          left join {priced} f on f.date = d.date and f.store_id = k.store_id and f.product_id = k.product_id""",
    # the fact before its last months came, a store's days of one spring, a correction, and with a row that is deleted later
    "early_fact": """
        select date, store_id, product_id, case when date = date '1997-06-15' and b = 3 then units_sold + 5 else units_sold end as units_sold, revenue from {priced}
          where date < date '2001-08-01' and not (r = 1 and date between date '1998-03-01' and date '1998-03-09')
        union all select date '1999-05-05', 'S002', 'P00099', cast(7 as bigint), cast(70 as decimal(28, 2))""",
    # orders as lines of a feed, with a fault of each kind at places
    "order_lines": """
        select o_orderkey as n, case o_orderkey % 23
            when 3 then concat(cast(o_orderkey as string), ',', cast(o_custkey as string))
            when 5 then concat(cast(o_orderkey as string), ',', cast(o_custkey as string), ',1.5,2024-01-05,Open,more')
            when 7 then concat('x', cast(o_orderkey as string), ',', cast(o_custkey as string), ',1.5,2024-02-30,Open')
            when 9 then concat(cast(o_orderkey as string), ',,1.5,2024-01-05, ')
            when 11 then concat(cast(o_orderkey as string), ',', cast(o_custkey as string), ',-1.5,2024-01-05,Lost')
            when 13 then concat(cast(o_orderkey as string), ',', cast(o_custkey as string), ',1.5,2024-1-5,"Open"')
            when 15 then concat(cast(o_orderkey as string), ',', cast(o_custkey as string), ',"1.5,2024-01-05,Open')
            else concat(cast(o_orderkey as string), ', ', cast(o_custkey as string), ' ,', cast(o_orderkey % 1000 as string), '.25,1997-03-04,', case when o_orderstatus = 'P' then concat('"Part, ""P"', '""') else 'Open' end)
          end as value from {orders}""",
    # order lines as sales, half of them of one store and product
    "skewed": """
        select cast(l_shipdate as date) as date, 'S000' as store_id, case when l_orderkey % 2 = 0 then 'P00000' else concat('P', lpad(cast(l_partkey % 40 as string), 5, '0')) end as product_id,
          l_orderkey as order_key, l_linenumber as line, cast(l_quantity as bigint) as units_sold, cast(l_extendedprice as decimal(18, 2)) as revenue from {lineitem}""",
    # an offer an order, nearly all under one label, from one day to some years long; some end before they start
    "offers": """
        select concat('PROMO', lpad(cast(o_orderkey as string), 9, '0')) as promotion_id, case when o_orderkey % 10 = 0 then 'Clearance' when o_orderkey % 77 = 0 then null else 'Spring' end as promotion_name,
          cast(o_orderdate as date) as start_date, cast(o_orderdate as date) + cast(case when o_orderkey % 50 = 0 then 900 else o_orderkey % 97 - 2 end as int) as end_date,
          cast(case when o_orderkey % 9 = 0 then null else cast(o_orderkey % 8 as double) * 0.125 end as double) as discount_pct from {orders}""",
    "ordered_events": "select event_id, ts, user_id, event_type, cast(value as decimal(18, 2)) as amount, case when event_type = 'purchase' then event_id end as purchase from {events}",
    # three snapshots of the customers: some gone, some changed, some new, a null key
    "customer_days": """
        select case when c_custkey % 500 = 7 then null else c_custkey end as customer_key, c_name as name, c_nationkey as nation, c_mktsegment as segment, date '2024-01-01' as as_of from {customer} where c_custkey % 11 <> 0 and (c_custkey % 500 <> 7 or c_custkey = 7)
        union all select case when c_custkey % 500 = 7 then null else c_custkey end, c_name, case when c_custkey % 13 = 0 then null else c_nationkey end, case when c_custkey % 17 = 0 then 'NEW' else c_mktsegment end, date '2024-02-01'
          from {customer} where c_custkey % 7 <> 0 and (c_custkey % 500 <> 7 or c_custkey = 507)
        union all select c_custkey, c_name, c_nationkey, case when c_custkey % 17 = 0 then 'NEW' else c_mktsegment end, date '2024-03-01' from {customer} where c_custkey % 5 <> 0""",
    # text cells of every shape that the strict casts tell apart
    "cells": f"""
        select event_id as id, {_case("event_id % 14", "'1.0'", "' 7 '", "'1e3'", "'1.5'", "'inf'", "'NaN'", "'0x1F'", "'1d'", "'1_000'", "'-12'", "''", "'+.5'", "'9007199254740993'", other="null")} as number,
          {_case("event_id % 10", "'2024-01-05'", "'2024-1-5'", "'2024-02-30'", "' 2024-01-05'", "'2024-01-05T00:00:00'", "'20240105'", "'2024-12-31'", "'2023-02-29'", "''", other="null")} as day,
          {_case("event_id % 7", "'True'", "'False'", "'true'", "'1'", "'t'", "' True'", other="null")} as flag,
          {_case("event_id % 6", "'S001'", "'S1'", "'xS001'", "'S0012'", "''", other="null")} as code,
          {_case("event_id % 6", "'  a b '", "' '", "''", "'x'", "concat('y', chr(9))", other="null")} as note
        from {{events}}""",
    # rows of several runs of a raw table, keys null at times
    "runs": """
        select case when user_id % 40 = 0 then null else user_id % 40 end as store_key, case when event_id % 5 = 0 then null else event_type end as kind,
          event_id, cast(ts as date) as ingestion_date, concat('r', cast(event_id % 9 as string)) as run_id,
          cast(ts as date) + cast(event_id % 3 as int) as _modified from {events}""",
}


def _needs(sql: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"\{(\w+)\}", sql)))


def frame(spark: SparkSession, sf_dir: str, name: str, built: dict[str, DataFrame] | None = None) -> DataFrame:
    """A fixture, or a driver table, as a DataFrame."""
    built = {} if built is None else built
    if name not in built:
        if name in DRIVER:
            built[name] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        else:
            sql = re.sub(r"DAYNO\(([\w.]+)\)", r"unix_date(\1)", FIXTURES[name])
            sql = re.sub(r"SPAN\((\w+), (\w+)\)", r"explode(sequence(\1, \2))", sql)
            built[name] = spark.sql(sql, **{n: frame(spark, sf_dir, n, built) for n in _needs(sql)})
    return built[name]


def ctes(*names: str) -> str:
    """DuckDB's WITH clause of some fixtures and all they need."""
    order: list[str] = []

    def add(name: str) -> None:
        if name in DRIVER or name in order:
            return
        for n in _needs(FIXTURES[name]):
            add(n)
        order.append(name)

    for n in names:
        add(n)
    return "with " + ",\n".join(f"{n}_ as ({duck(FIXTURES[n])})" for n in order)


def duck(sql: str) -> str:
    sql = re.sub(r"DAYNO\(([\w.]+)\)", r"date_diff('day', date '1970-01-01', \1)", sql)
    sql = re.sub(r"SPAN\((\w+), (\w+)\)", r"cast(unnest(generate_series(\1, \2, interval 1 day)) as date)", sql)
    return re.sub(r"\{(\w+)\}", lambda m: m[1] if m[1] in DRIVER else f"{m[1]}_", sql)
