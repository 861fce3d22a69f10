"""Missing values of text rows under a policy for each table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from enum import Enum

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions.scalar import blank
from granary.sources.contracts import TableSpec


class OnMissing(Enum):
    PRESERVE = "preserve"
    DROP_ROW = "drop_row"
    FILL = "fill"
    ERROR = "error"


@dataclass(frozen=True)
class MissingPolicy:
    """What happens to optional columns; those not named are preserved."""

    strategies: dict[str, OnMissing] = field(default_factory=dict)
    fills: dict[str, str] = field(default_factory=dict)

    def of(self, column: str) -> OnMissing:
        return self.strategies.get(column, OnMissing.PRESERVE)


def optional(spec: TableSpec) -> list[str]:
    return [f.name for f in spec.schema if not f.metadata["required"]]


def counters(spec: TableSpec, policy: MissingPolicy, at: Callable[[str], Column] = F.col) -> dict[str, Column]:
    """Aggregates for one pass: missing values by column, and dropped, filled and preserved totals. ``at`` gives a column's text."""
    by_column = {f"missing.{c}": F.count_if(blank(at(c))) for c in spec.columns}
    of = lambda s: [c for c in optional(spec) if policy.of(c) is s]
    drop = dropped(spec, policy, at)
    total = lambda names: sum((F.count_if(blank(at(c)) & ~drop) for c in names), F.lit(0))
    return by_column | {"dropped_rows": F.count_if(drop), "filled_values": total(of(OnMissing.FILL)), "preserved_values": total(of(OnMissing.PRESERVE))}


def dropped(spec: TableSpec, policy: MissingPolicy, at: Callable[[str], Column] = F.col) -> Column:
    """Whether the policy drops the row."""
    out = F.lit(False)
    for c in optional(spec):
        if policy.of(c) is OnMissing.DROP_ROW:
            out = out | blank(at(c))
    return out


def verdict(found: dict[str, int], spec: TableSpec, policy: MissingPolicy) -> str | None:
    """The first column, in contract order, that may not be missing but is."""
    for f in spec.schema:
        n = found[f"missing.{f.name}"]
        if n and (f.metadata["required"] or policy.of(f.name) is OnMissing.ERROR):
            return f"{spec.name}.{f.name}: {n} missing values"
    return None


def filled(rows: DataFrame, spec: TableSpec, policy: MissingPolicy) -> DataFrame:
    """The rows after fills."""
    fill = [c for c in optional(spec) if policy.of(c) is OnMissing.FILL]
    if unset := [c for c in fill if c not in policy.fills]:
        raise ValueError(f"no fill value for {spec.name}: {', '.join(unset)}")
    return rows.withColumns({c: F.when(blank(F.col(c)), F.lit(policy.fills[c])).otherwise(F.col(c)) for c in fill})


def apply(rows: DataFrame, spec: TableSpec, policy: MissingPolicy) -> DataFrame:
    """The rows after drops and fills."""
    return filled(rows.where(~dropped(spec, policy)), spec, policy)
