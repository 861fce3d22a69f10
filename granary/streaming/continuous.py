"""Continuous ingestion of a fact from a folder of CSV files (an extension of the batch feed).

Files already there are taken in one go, each once; rows that can't be cast or
break a rule go to a rejects folder instead of stopping the stream. A key is
stored once, whenever its rows come: each batch meets the stored keys (of its own
days, where days are part of the key), so rows of long ago are taken too, and no state grows with the stream.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from granary.functions.scalar import blank, strict
from granary.operators import quality
from granary.sources.contracts import TableSpec
from granary.sources.csv import DIALECT, _fs, joined


def typed(text: DataFrame, spec: TableSpec) -> DataFrame:
    """Cast rows with _bad: whether a value can't be cast or a rule fails."""
    uncastable = [~blank(F.col(f.name)) & strict(F.col(f.name), f.metadata["logical"]).isNull() for f in spec.schema if f.metadata["logical"] != "string"]
    cast = text.select(*[strict(F.col(f.name), f.metadata["logical"]).alias(f.name) for f in spec.schema], reduce(lambda a, b: a | b, uncastable).alias("_uncast"))
    broken = [F.coalesce(v, F.lit(True)) for v in quality.rules(spec).values()]
    return cast.withColumn("_bad", F.col("_uncast") | reduce(lambda a, b: a | b, broken)).drop("_uncast")


def unseen(rows: DataFrame, stored: str, spec: TableSpec, number: int) -> DataFrame:
    """One row of each key that no earlier batch has stored."""
    once = rows.dropDuplicates(list(spec.key))
    fs, p = _fs(rows.sparkSession, stored)
    if not fs.exists(p):
        return once
    schema = rows.select(*spec.key).withColumn("batch", F.lit(0)).schema
    seen = rows.sparkSession.read.schema(schema).parquet(stored).where(F.col("batch") < number)
    if spec.watermark in spec.key:
        first, last = rows.agg(F.min(spec.watermark), F.max(spec.watermark)).first()
        seen = seen.where(F.col(spec.watermark).between(F.lit(first), F.lit(last)))
    return once.join(seen.select(*spec.key).distinct(), list(spec.key), "left_anti")


def follow(spark: SparkSession, source: str, target: str, spec: TableSpec) -> StreamingQuery:
    """Starts the stream; it ends by itself when all present files are read."""
    text = spark.readStream.schema(spec.text_schema()).options(**DIALECT | {"enforceSchema": True}).csv(source)

    by = [spec.watermark] if spec.watermark in spec.key else []

    def store(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            good = unseen(batch.where(~F.col("_bad")).drop("_bad"), joined(target, "rows"), spec, number)
            # a batch that comes again after a failure replaces its own folder; rows lie by day, so that later batches open their own days only
            good.write.mode("overwrite").partitionBy(*by).parquet(joined(target, "rows", f"batch={number}"))
            batch.where("_bad").drop("_bad").write.mode("overwrite").parquet(joined(target, "rejects", f"batch={number}"))
        finally:
            batch.unpersist()

    return (
        typed(text, spec).writeStream.foreachBatch(store)
        .option("checkpointLocation", joined(target, "_checkpoint"))
        .trigger(availableNow=True)
        .start()
    )


def promoted(sales: DataFrame, offers: DataFrame, delay: str = "2 days", ahead_days: int = 90) -> DataFrame:
    """A stream of sales with every offer of a stream of offers that was on that day: both sides wait for each other.

    Sales have date and sales_promotion, offers promotion_id, promotion_name, start_date and end_date. An offer must be
    known by its start and last ``ahead_days`` days at most: then state of both sides ends once the watermark has passed,
    and rows later than ``delay`` are dropped and counted (``late_rows``). Of offers on one day all come out; which one
    counts is the batch join's choice.
    """
    left = sales.withColumn("_sold", F.col("date").cast("timestamp")).withWatermark("_sold", delay)
    right = offers.where(F.date_diff("end_date", "start_date").between(0, ahead_days - 1)).withColumn("_starts", F.col("start_date").cast("timestamp")).withWatermark("_starts", delay)
    on = (
        (F.col("sales_promotion") == F.col("promotion_name"))
        & F.col("date").between(F.col("start_date"), F.col("end_date"))
        # what bounds the state: a sale lies less than ``ahead_days`` behind its offer's start
        & (F.col("_sold") >= F.col("_starts"))
        & (F.col("_sold") < F.col("_starts") + F.expr(f"interval {int(ahead_days)} days"))
    )
    return left.join(right, on).drop("_sold", "_starts")


def late_rows(query: StreamingQuery) -> int:
    """Rows that a query's state operators have dropped for being late, in all progress that Spark still keeps."""
    return sum(o.numRowsDroppedByWatermark for p in query.recentProgress for o in p.stateOperators)


def daily_demand(rows: DataFrame, delay: str = "2 days") -> DataFrame:
    """Units and revenue by day, store and product of a stream of sales (date, store_id, product_id, units_sold, revenue)."""
    timed = rows.withColumn("_time", F.col("date").cast("timestamp")).withWatermark("_time", delay)
    return timed.groupBy(F.window("_time", "1 day"), "store_id", "product_id").agg(F.sum("units_sold").alias("units_sold"), F.sum("revenue").alias("revenue"))
