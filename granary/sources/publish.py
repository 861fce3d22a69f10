"""Publication: staged writes that appear under their final path in one rename.

A run's manifest is staged with its data, so the rename publishes both or
neither. Where a store's rename of a folder copies its files, a run is written
in place instead, and its manifest, written last, is what makes it readable.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession

from granary.sources.csv import _fs, joined

CODECS = ("gzip", "lz4", "none", "snappy", "zstd")
MODES = ("errorifexists", "overwrite")
MANIFEST = "_MANIFEST.json"


class PublishError(RuntimeError):
    pass


@dataclass(frozen=True)
class Output:
    """A dataset's partition columns."""

    partition_by: tuple[str, ...] = ()


# fixed values: the curated datasets and their partition columns
CURATED = {
    "demand_features": Output(("year", "month")),
    "purchase_order_features": Output(("order_year", "order_month")),
    "dim_product": Output(),
    "dim_store": Output(),
    "dim_supplier": Output(),
    "dim_warehouse": Output(),
    "dim_date": Output(),
    "weather": Output(),
    "promotions": Output(),
    "holidays": Output(),
}


@dataclass(frozen=True)
class WriteOptions:
    codec: str = "snappy"
    mode: str = "errorifexists"
    target_partitions: int | None = None
    in_place: bool = False

    def __post_init__(self):
        if self.codec not in CODECS or self.mode not in MODES:
            raise ValueError(f"codec is one of {CODECS}, mode one of {MODES}")
        if self.target_partitions is not None and self.target_partitions < 1:
            raise ValueError("target_partitions must be at least 1")


def today() -> str:
    return datetime.now(UTC).strftime("%Y-%m-%d")


def run_path(root: str, run_id: str, day: str | None = None) -> str:
    return joined(root, f"processing_date={day or today()}", f"run_id={_safe(run_id)}")


def raw_path(root: str, table: str, run_id: str, day: str | None = None) -> str:
    return joined(root, f"table={table}", f"ingestion_date={day or today()}", f"run_id={_safe(run_id)}")


def _safe(run_id: str) -> str:
    if not re.fullmatch(r"[A-Za-z0-9_-]+", run_id):
        raise ValueError(f"bad run id: {run_id!r}")
    return run_id


def check_bundle(bundle: dict[str, DataFrame], outputs: dict[str, Output] = CURATED) -> None:
    """Exactly the expected datasets, each with its partition columns."""
    missing, unexpected = sorted(outputs.keys() - bundle.keys()), sorted(bundle.keys() - outputs.keys())
    if missing or unexpected:
        raise PublishError(f"datasets missing: {missing}, unexpected: {unexpected}")
    for name, out in outputs.items():
        if absent := [c for c in out.partition_by if c not in bundle[name].columns]:
            raise PublishError(f"{name} lacks partition columns {absent}")


def write(df: DataFrame, path: str, out: Output, options: WriteOptions) -> None:
    """One dataset as Parquet. Partitioned ones are dealt by their columns only where a number of files is asked for."""
    if out.partition_by and options.target_partitions:
        df = df.repartition(options.target_partitions, *out.partition_by)
    writer = df.write.mode(options.mode).option("compression", options.codec)
    (writer.partitionBy(*out.partition_by) if out.partition_by else writer).parquet(path)


def _move(spark: SparkSession, staged: str, target: str) -> None:
    fs, source = _fs(spark, staged)
    _, to = _fs(spark, target)
    if fs.exists(to):
        raise PublishError(f"{target} exists already")
    fs.mkdirs(to.getParent())
    if not fs.rename(source, to):
        raise PublishError(f"{staged} couldn't be moved to {target}")


def _abort(spark: SparkSession, root: str, staged: str) -> None:
    """Deletes a staging folder, and nothing that isn't one."""
    if not staged.startswith(joined(root, "_staging") + "/"):
        raise PublishError(f"{staged} isn't a staging folder of {root}")
    fs, p = _fs(spark, staged)
    if fs.exists(p):
        fs.delete(p, True)


def _put(spark: SparkSession, path: str, value: dict) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, False)
    out.write(bytearray(json.dumps(value, sort_keys=True).encode()))
    out.close()


def publish_raw(
    df: DataFrame, root: str, table: str, run_id: str, codec: str = "snappy", check: Callable[[int], None] = lambda rows: None
) -> tuple[str | None, int]:
    """A table's rows of one run into the raw layer; no path, and nothing published, if there are none. Returns the path and the rows.

    ``check`` gets the number of staged rows and may raise before they are published.
    """
    spark = df.sparkSession
    staged, target = joined(root, "_staging", _safe(run_id), table), raw_path(root, table, run_id)
    fs, p = _fs(spark, staged)
    if fs.exists(p):
        raise PublishError(f"{staged} exists: another run with this id is writing")
    try:
        df.write.option("compression", codec).parquet(staged)
        check(rows := spark.read.parquet(staged).count())  # from the files' footers
        if not rows:
            _abort(spark, root, staged)
            return None, 0
        _move(spark, staged, target)
    except BaseException:
        _abort(spark, root, staged)
        raise
    return target, rows


def publish(bundle: dict[str, DataFrame], root: str, run_id: str, options: WriteOptions | None = None) -> str:
    """All curated datasets of one run, sealed by a manifest: by a rename of the staged run, or in place with the manifest last.

    It may be called again after a fault at any step: a run that is sealed already is left as it is, what an unsealed
    attempt wrote in place is replaced.
    """
    options = options or WriteOptions()
    check_bundle(bundle)
    spark = next(iter(bundle.values())).sparkSession
    staged, target = joined(root, "_staging", _safe(run_id), "run"), run_path(root, run_id)
    if sealed(spark, target):
        return target
    fs, to = _fs(spark, target)
    if fs.exists(to):
        if not options.in_place:
            raise PublishError(f"{target} exists already, without a manifest")
        fs.delete(to, True)
    where = target if options.in_place else staged
    try:
        if not options.in_place:
            _abort(spark, root, staged)
        for name, df in bundle.items():
            write(df, joined(where, f"dataset={name}"), CURATED[name], options)
        _put(spark, joined(where, MANIFEST), {"run_id": run_id, "datasets": sorted(bundle)})
        if not options.in_place:
            _move(spark, staged, target)
    except BaseException:
        if options.in_place:
            if fs.exists(to) and not sealed(spark, target):
                fs.delete(to, True)
        else:
            _abort(spark, root, staged)
        raise
    return target


def sealed(spark: SparkSession, target: str) -> bool:
    fs, p = _fs(spark, joined(target, MANIFEST))
    return fs.exists(p)
