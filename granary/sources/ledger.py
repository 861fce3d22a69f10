"""Feeds whose bad rows are written down instead of stopping the load.

Each line is parsed on its own; what is wrong with it becomes a list of reasons,
and good rows go on. The ledger names file and line, so that whoever wrote the
feed can find the row. Lines are numbered without an ordered task: a count a
part of the file, added up on the driver, gives each part its first number.

A row is a line here. Feeds whose quoted values hold line breaks aren't: their
pieces would each be of a wrong width, so they are refused.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from granary.functions.scalar import blank, strict
from granary.operators import quality
from granary.sources.contracts import TableSpec
from granary.sources.csv import PLAIN, Format, SourceError, check_header, header, lines

CORRUPT = "__corrupt"


def judged(text: DataFrame, spec: TableSpec, form: Format = PLAIN, line: str = "value") -> DataFrame:
    """Other columns of ``text``, the contract's columns, typed, and ``reasons``: empty for a good row, whose values alone count.

    Reasons, in contract order: ``width`` (fields too few or too many, quotes left open; then no other), ``missing.Column``,
    ``cast.Column``, and the names of the table's rules that fail.
    """
    ddl = ", ".join(f"`{c}` string" for c in [*spec.columns, CORRUPT])
    options = {k: str(v) for k, v in form.options.items() if k in ("sep", "quote", "escape")} | {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    others = [c for c in text.columns if c != line]
    parsed = text.select(*others, F.from_csv(F.col(line), ddl, options).alias("__p"))
    cell = lambda c: F.col(f"__p.`{c}`")
    typed = parsed.select(
        *others,
        "__p",
        *[(F.when(~blank(cell(f.name)), strict(cell(f.name), f.metadata["logical"])) if f.metadata["logical"] != "string" else cell(f.name)).alias(f.name) for f in spec.schema],
    )
    wide = cell(CORRUPT).isNotNull()
    wrong = []
    for f in spec.schema:
        if f.metadata["required"]:
            wrong.append(F.when(blank(cell(f.name)), F.lit(f"missing.{f.name}")))
        if f.metadata["logical"] != "string":
            wrong.append(F.when(~blank(cell(f.name)) & F.col(f.name).isNull(), F.lit(f"cast.{f.name}")))
    # a rule speaks of values: not of missing or uncastable ones
    whole = ~F.exists(F.array(*wrong), lambda x: x.isNotNull()) if wrong else F.lit(True)
    broken = [F.when(whole & F.coalesce(bad, F.lit(True)), F.lit(name)) for name, bad in quality.rules(spec).items() if not name.endswith(".required")]
    reasons = F.when(wide, F.array(F.lit("width"))).otherwise(F.array_compact(F.array(*wrong, *broken)))
    return typed.withColumn("reasons", reasons).drop("__p")


def numbered(spark: SparkSession, path: str) -> DataFrame:
    """file, line (from 1), value of every line of the files at ``path``."""
    rows = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("__block"), F.monotonically_increasing_id().alias("__id"), "value"
    )
    # a row a part of a file
    parts = rows.groupBy("file", "__block").agg(F.count("*").alias("n"), F.min("__id").alias("__least"))
    before = F.sum("n").over(Window.partitionBy("file").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1))
    table = spark.createDataFrame(parts.withColumn("__before", F.coalesce(before, F.lit(0))).drop("n").toArrow())
    joined = rows.join(F.broadcast(table), ["file", "__block"])
    return joined.select("file", (F.col("__before") + F.col("__id") - F.col("__least") + 1).alias("line"), "value")


def split(spark: SparkSession, path: str, spec: TableSpec, form: Format = PLAIN) -> tuple[DataFrame, DataFrame]:
    """Good rows, typed, and the ledger: file, line, reasons and text of the others."""
    check_header(header(spark, path, form), spec)
    if form.encoding.upper() not in ("UTF-8", "UTF8", "US-ASCII", "ASCII") or lines(spark, path, form).breaks:
        raise SourceError(f"{path}: a ledger needs UTF-8 and rows of one line")
    rows = numbered(spark, path).where((F.col("line") > 1) & F.col("value").rlike(r"[^\x00-\x20]")).withColumn("text", F.col("value"))
    found = judged(rows, spec, form)
    good = found.where(F.size("reasons") == 0).select(*spec.columns)
    return good, found.where(F.size("reasons") > 0).select("file", "line", "reasons", "text")
