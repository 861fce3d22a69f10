"""CSV to the raw layer in two scans: of the lines, and for the write.

The first tells whether the file can be split, and how many rows it has. All
counts of the verdict (missing, uncastable, rule failures, late rows, highest
watermark) are observed while rows pass on to the staged write; the verdict then
publishes the staged files or deletes them. Duplicates are what the write's
deduplication leaves out. A task that runs twice, as after the loss of an
executor, is observed twice: where the observed rows aren't the file's, the
counts are taken again by an aggregate of their own.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from granary.functions.scalar import blank, strict
from granary.operators import dedup, incremental, missing, quality
from granary.plans.settings import Settings, log
from granary.sources import csv
from granary.sources.checkpoints import Checkpoint, CheckpointStore
from granary.sources.contracts import CONTRACTS, TableSpec
from granary.sources.publish import publish_raw


class IngestError(RuntimeError):
    pass


@dataclass(frozen=True)
class TableRun:
    table: str
    status: str
    reason: str
    rows: int = 0
    duplicates: int = 0
    late_rows: int = 0
    watermark: str | None = None
    path: str | None = None


@dataclass(frozen=True)
class IngestRun:
    run_id: str
    seconds: float
    tables: tuple[TableRun, ...]
    failures: dict[str, str] = field(default_factory=dict)

    def audit(self, spark: SparkSession) -> DataFrame:
        rows = [(self.run_id, t.table, t.status, t.reason, t.rows, t.duplicates, t.late_rows, t.watermark, t.path) for t in self.tables]
        return spark.createDataFrame(
            rows, "run_id string, table string, status string, reason string, rows long, duplicates long, late_rows long, watermark string, path string"
        )


def _text(name: str) -> F.Column:
    return F.col(f"__text_{name}")


def cast_rows(text: DataFrame, spec: TableSpec, policy: missing.MissingPolicy, watermark: str | None) -> DataFrame:
    """Typed columns after fills, blanks of optional ones as null, beside their text (__text_*).

    Adds __dropped (by the policy), __live (not dropped, and after the watermark) and the row's place in its file.
    """
    both = missing.filled(text.withColumns({f"__text_{c}": F.col(c) for c in spec.columns}), spec, policy)
    typed = [
        (F.when(~blank(F.col(f.name)), strict(F.col(f.name), f.metadata["logical"])) if f.metadata["logical"] != "string" else F.col(f.name)).alias(f.name)
        for f in spec.schema
    ]
    place = F.struct("_source_file", "_block", F.monotonically_increasing_id().alias("row")).alias("_position")
    rows = both.select(*typed, *[_text(c) for c in spec.columns], place).withColumn("__dropped", missing.dropped(spec, policy, _text))
    return rows.withColumn("__live", ~F.col("__dropped") & incremental.is_newer(spec, watermark))


def cast_failures(spec: TableSpec, at=F.col) -> dict[str, F.Column]:
    """Aggregates over text: values that aren't of their column's type."""
    return {
        f"cast.{f.name}": F.count_if(~blank(at(f.name)) & strict(at(f.name), f.metadata["logical"]).isNull())
        for f in spec.schema
        if f.metadata["logical"] != "string"
    }


def _named(counts: dict) -> list[F.Column]:
    return [c.alias(f"c{k}") for k, c in enumerate(counts.values())]


def _told(observed: Observation, counts: dict) -> dict:
    found = observed.get
    return {name: found[f"c{k}"] for k, name in enumerate(counts)}


def judge(found: dict, spec: TableSpec, policy: missing.MissingPolicy) -> None:
    """Raises what stops a table: missing values, uncastable ones, failed rules, in this order."""
    if problem := missing.verdict(found, spec, policy):
        raise IngestError(problem)
    if bad := {k: n for k, n in found.items() if k.startswith("cast.") and n}:
        kinds = {f.name: f.metadata["logical"] for f in spec.schema}
        raise IngestError("; ".join(f"invalid {kinds[k[5:]]} values in {spec.name}.{k[5:]}: count={n}" for k, n in bad.items()))
    if problem := quality.verdict({k[2:]: n for k, n in found.items() if k.startswith("q.")}, spec.name):
        raise IngestError(problem)


def ingest_table(
    spark: SparkSession,
    spec: TableSpec,
    path: str,
    settings: Settings,
    store: CheckpointStore,
    run_id: str,
    *,
    policy: missing.MissingPolicy | None = None,
    full: bool = False,
    reject_duplicates: bool = False,
) -> TableRun:
    policy = policy or missing.MissingPolicy()
    call = settings.retry.call
    source = call(lambda: csv.identity(spark, path))
    choice = incremental.decide(spec, source, last := call(lambda: store.load(spec.name)), full)
    if not choice.load:
        call(lambda: csv.check_header(csv.header(spark, path, settings.csv), spec))
        return TableRun(spec.name, "skipped", choice.reason, watermark=choice.watermark)
    seen = call(lambda: csv.lines(spark, path, settings.csv))
    rows = cast_rows(call(lambda: csv.scan(spark, path, spec, settings.csv, seen.breaks)), spec, policy, choice.watermark)
    live = F.col("__live")
    counts = (
        missing.counters(spec, policy, _text)
        | cast_failures(spec, _text)
        | {"all": F.count("*"), "late": F.count_if(~F.col("__dropped") & ~live), "rows": F.count_if(live), "watermark": incremental.highest(spec, live)}
        | {f"q.{k}": v for k, v in quality.failures(quality.rules(spec), live).items()}
    )
    found: dict = {}

    def load() -> tuple[str | None, int]:
        observed = Observation()

        def check(written: int) -> None:
            found.update(_told(observed, counts))
            if found["all"] != seen.rows and (seen.rows is not None or written != found["rows"]):
                found.update(zip(counts, rows.agg(*_named(counts)).first(), strict=True))
            judge(found, spec, policy)
            if reject_duplicates and written < found["rows"]:
                raise IngestError(f"{spec.name}: {found['rows'] - written} rows repeat a key")
            if csv.identity(spark, path) != source:
                raise IngestError(f"{spec.name}: {path} changed while it was read")

        kept = dedup.keep_first(rows.observe(observed, *_named(counts)).where(live), list(spec.key), "_position").select(*spec.columns)
        return publish_raw(kept, settings.raw_root, spec.name, run_id, settings.write.codec, check)

    target, written = call(load)
    mark = incremental.advanced(last.watermark if last and not full else None, found["watermark"])
    # the checkpoint follows the publication: after a crash in between, rows come again and the newest version of a key wins
    call(lambda: store.save(Checkpoint(spec.name, source, mark, run_id, datetime.now(UTC).isoformat())))
    return TableRun(spec.name, "loaded" if target else "empty", choice.reason, written, found["rows"] - written, found["late"], mark, target)


def ingest(
    spark: SparkSession,
    settings: Settings,
    *,
    tables: list[str] | None = None,
    overrides: dict[str, str] | None = None,
    policies: dict[str, missing.MissingPolicy] | None = None,
    full: bool = False,
    reject_duplicates: bool = False,
) -> IngestRun:
    """All tables, or those named; with ``fail_fast`` the first error ends the run, else errors are collected."""
    began, run_id = time.monotonic(), uuid.uuid4().hex
    specs = {n: CONTRACTS[n] for n in tables or CONTRACTS}
    paths = settings.retry.call(lambda: csv.discover(spark, settings.source_root, specs, overrides))
    store = CheckpointStore(spark, settings.checkpoint_root)
    done, failures = [], {}
    for name, spec in specs.items():
        try:
            run = ingest_table(
                spark, spec, paths[name], settings, store, run_id,
                policy=(policies or {}).get(name), full=full, reject_duplicates=reject_duplicates,
            )
        except Exception as e:
            if settings.fail_fast:
                raise IngestError(f"run {run_id}, {name}: {e}") from e
            failures[name] = str(e)
            done.append(TableRun(name, "failed", str(e)))
            continue
        log.info("ingested", extra={"fields": {"run_id": run_id, **run.__dict__}})
        done.append(run)
    return IngestRun(run_id, time.monotonic() - began, tuple(done), failures)
