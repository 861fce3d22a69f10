"""CSV sources: discovery, identity, text scans and the raw layer."""

from __future__ import annotations

import codecs
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.sources.contracts import CONTRACTS, TableSpec

#: A quote is doubled inside quotes, a row of another width is an error; lines are rows, so one large file makes many tasks.
DIALECT = {"header": True, "mode": "FAILFAST", "enforceSchema": False, "quote": '"', "escape": '"', "encoding": "UTF-8"}
#: Encodings in which a byte isn't a character of its own wherever ASCII has it; their files can't be split.
WIDE = ("UTF-16", "UTF-16BE", "UTF-16LE", "UTF-32", "UTF-32BE", "UTF-32LE")


class SourceError(ValueError):
    pass


@dataclass(frozen=True)
class Identity:
    path: str
    size: int
    modified_ms: int


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def joined(root: str, *parts: str) -> str:
    """A path below a local folder or a URI of any scheme."""
    return "/".join([root.rstrip("/"), *(p.strip("/") for p in parts)])


def identity(spark: SparkSession, path: str) -> Identity:
    """What tells whether a source has changed, from any file system that Spark reads."""
    fs, p = _fs(spark, path)
    status = fs.getFileStatus(p)
    return Identity(status.getPath().toString(), status.getLen(), status.getModificationTime())


def discover(spark: SparkSession, root: str, specs: dict[str, TableSpec] = CONTRACTS, overrides: dict[str, str] | None = None) -> dict[str, str]:
    """Paths of all tables in contract order; unknown overrides and missing files are errors."""
    overrides = overrides or {}
    if unknown := sorted(set(overrides) - set(specs)):
        raise SourceError(f"overrides for unknown tables: {', '.join(unknown)}")
    paths = {name: overrides.get(name, joined(root, spec.file_name)) for name, spec in specs.items()}
    absent = [f"{name} ({path})" for name, path in paths.items() if not (lambda f: f[0].exists(f[1]))(_fs(spark, path))]
    if absent:
        raise SourceError(f"no file for: {', '.join(absent)}")
    return paths


@dataclass(frozen=True)
class Format:
    """How a feed's files are written."""

    sep: str = ","
    encoding: str = "UTF-8"

    def __post_init__(self):
        if len(self.sep) != 1 or self.sep in "\"\r\n":
            raise SourceError(f"a delimiter is one character, no quote and no line end: {self.sep!r}")
        try:
            codecs.lookup(self.encoding)
        except LookupError as e:
            raise SourceError(f"unknown encoding: {self.encoding}") from e

    @property
    def wide(self) -> bool:
        return self.encoding.upper().replace("_", "-") in WIDE

    @property
    def options(self) -> dict:
        return DIALECT | {"sep": self.sep, "encoding": self.encoding}


PLAIN = Format()


def header(spark: SparkSession, path: str, form: Format = PLAIN) -> list[str]:
    # a scan of one row: Spark's reader names the columns
    return spark.read.options(**form.options | {"enforceSchema": True, "multiLine": form.wide}).csv(path).columns


@dataclass(frozen=True)
class Lines:
    """What a scan of the lines tells: rows, if each is a line, and whether a quoted value holds a line break."""

    rows: int | None
    breaks: bool


def lines(spark: SparkSession, path: str, form: Format = PLAIN) -> Lines:
    """A quoted value holds a line break if, and only if, some line has an odd number of quotes; empty lines are no rows."""
    if form.wide:
        return Lines(None, True)
    text = F.col("value")
    odd = (F.length("value") - F.length(F.replace(text, F.lit('"'), F.lit("")))) % 2 == 1
    found = spark.read.text(path).agg(F.count_if(text.rlike(r"[^\x00-\x20]")), F.coalesce(F.bool_or(odd), F.lit(False))).first()
    return Lines(None if found[1] else max(0, found[0] - 1), found[1])


def check_header(found: list[str], spec: TableSpec) -> None:
    """Names and order must be the contract's."""
    if found != spec.columns:
        missing = [c for c in spec.columns if c not in found]
        unexpected = [c for c in found if c not in spec.columns]
        raise SourceError(f"header of {spec.name} differs: missing {missing}, unexpected {unexpected}, order {found}")


def scan(spark: SparkSession, path: str, spec: TableSpec, form: Format = PLAIN, line_breaks: bool | None = None) -> DataFrame:
    """The table as text, its header checked, with the file in _source_file and the start of the file's part in _block.

    Files whose quoted values hold line breaks can't be split and are one task each; ``line_breaks`` says so, or is found out
    by a scan of the lines. Where it is said wrongly, the next line is a row of another width, which is an error.
    """
    check_header(header(spark, path, form), spec)
    whole = lines(spark, path, form).breaks if line_breaks is None else line_breaks
    rows = spark.read.schema(spec.text_schema()).options(**form.options | {"multiLine": whole}).csv(path)
    return rows.withColumns({"_source_file": F.col("_metadata.file_path"), "_block": F.col("_metadata.file_block_start")})


def raw(spark: SparkSession, root: str, spec: TableSpec) -> DataFrame:
    """All published runs of a table's raw layer, with ingestion_date and run_id from their folders.

    The text columns keep the contract's types: raw files are Parquet.
    """
    path = joined(root, f"table={spec.name}")
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        raise SourceError(f"no raw files for {spec.name} in {path}")
    kept = T.StructType([T.StructField(f.name, f.dataType) for f in spec.schema])
    kept.add("ingestion_date", T.DateType()).add("run_id", T.StringType())
    rows = spark.read.schema(kept).option("basePath", path).parquet(path)
    return rows.withColumns({"_source_file": F.col("_metadata.file_path"), "_modified": F.col("_metadata.file_modification_time")})


def raw_bundle(spark: SparkSession, root: str, specs: dict[str, TableSpec] = CONTRACTS) -> dict[str, DataFrame]:
    return {name: raw(spark, root, spec) for name, spec in specs.items()}
