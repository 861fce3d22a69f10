"""Incremental loads: what to read again, and how far the watermark goes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.sources.checkpoints import Checkpoint
from granary.sources.contracts import TableSpec
from granary.sources.csv import Identity


@dataclass(frozen=True)
class Decision:
    load: bool
    reason: str
    watermark: str | None = None


def decide(spec: TableSpec, source: Identity, last: Checkpoint | None, full: bool = False) -> Decision:
    if last is None:
        return Decision(True, "initial_load")
    if full:
        return Decision(True, "full_reload")
    if source == last.source:
        return Decision(False, "source_unchanged", last.watermark)
    if spec.watermark is None:
        return Decision(True, "changed_snapshot")
    return Decision(True, "watermark_increment", last.watermark)


def is_newer(spec: TableSpec, watermark: str | None) -> Column:
    """Whether a row lies strictly after the watermark; all do if either side has none."""
    if watermark is None or spec.watermark is None:
        return F.lit(True)
    return F.coalesce(F.col(spec.watermark) > F.lit(watermark).cast("date"), F.lit(False))


def newer(rows: DataFrame, spec: TableSpec, watermark: str | None) -> DataFrame:
    """Rows strictly after the watermark; all if either side has none."""
    if watermark is None or spec.watermark is None:
        return rows
    return rows.where(F.col(spec.watermark) > F.lit(watermark).cast("date"))


def late(spec: TableSpec, watermark: str | None) -> Column:
    """An aggregate: rows that the watermark leaves out."""
    return F.count_if(~is_newer(spec, watermark))


def highest(spec: TableSpec, only: Column | None = None) -> Column:
    """An aggregate: the rows' own watermark as year-month-day, of ``only`` some of them."""
    if spec.watermark is None:
        return F.lit(None).cast("string")
    day = F.col(spec.watermark) if only is None else F.when(only, F.col(spec.watermark))
    return F.date_format(F.max(day), "yyyy-MM-dd")


def advanced(old: str | None, new: str | None) -> str | None:
    return max((x for x in (old, new) if x is not None), default=None)
