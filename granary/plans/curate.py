"""The raw layer to curated datasets."""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.operators import dedup, enrich, features
from granary.plans.settings import Settings, log
from granary.sources.contracts import CONTRACTS
from granary.sources.csv import raw_bundle
from granary.sources.publish import publish


@dataclass(frozen=True)
class CurateRun:
    run_id: str
    seconds: float
    path: str
    datasets: tuple[str, ...]


def latest(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The newest version of each key, cleaned, without technical columns."""
    return {
        name: enrich.clean(dedup.keep_latest(rows, list(CONTRACTS[name].key)).select(*CONTRACTS[name].columns)) for name, rows in raw.items()
    }


def curated(raw: dict[str, DataFrame], settings: Settings) -> dict[str, DataFrame]:
    """All curated datasets of a raw bundle, lazily."""
    t = latest(raw)
    days = enrich.calendar(t["Dim_Date"], t["Holiday"])
    demand = features.demand_features(enrich.demand_base(t, days), settings.features, settings.store_partitions)
    # a sale outside the calendar still has a year and a month
    demand = demand.withColumns({"year": F.coalesce("year", F.year("date")), "month": F.coalesce("month", F.month("date"))})
    return {
        "demand_features": demand,
        "purchase_order_features": enrich.purchase_orders(t),
        "dim_product": t["Dim_Product"],
        "dim_store": t["Dim_Store"],
        "dim_supplier": t["Dim_Supplier"],
        "dim_warehouse": t["Dim_Warehouse"],
        "dim_date": days,
        "weather": t["Weather"],
        "promotions": t["Promotion"],
        "holidays": t["Holiday"],
    }


def curate(spark: SparkSession, settings: Settings) -> CurateRun:
    began, run_id = time.monotonic(), uuid.uuid4().hex
    bundle = settings.retry.call(lambda: curated(raw_bundle(spark, settings.raw_root), settings))
    path = settings.retry.call(lambda: publish(bundle, settings.curated_root, run_id, settings.write))
    run = CurateRun(run_id, time.monotonic() - began, path, tuple(bundle))
    log.info("curated", extra={"fields": run.__dict__})
    return run
