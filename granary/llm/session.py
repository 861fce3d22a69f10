"""What operators ask of the Spark session."""

from __future__ import annotations

import gc
import io
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


_shipped: set[str] = set()


#: Rows of a batch that goes to Python: documents may be long, and a batch is held several times on its way.
BATCH_ROWS = 1000


def ship(spark: SparkSession) -> None:
    """Sends this package's source to the executors, once for each Spark application, and bounds Arrow batches."""
    context = spark.sparkContext
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[2]
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        for p in sorted((root / "granary").rglob("*.py")):
            z.write(p, p.relative_to(root))
    folder = Path(tempfile.mkdtemp(prefix="granary-"))
    (folder / "granary_source.zip").write_bytes(packed.getvalue())
    context.addPyFile(str(folder / "granary_source.zip"))
    _shipped.add(context.applicationId)


def shared_folder(spark: SparkSession) -> str:
    """This application's part of the folder of ``spark.checkpoint.dir``, which outlives executors.

    Only where the setting is absent and Spark runs on one machine (tests) a folder is chosen here.
    """
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not context._jsc.sc().isLocal():
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="granary-"))
    return context._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """``df`` with its lineage cut by files in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again: later reads take only the columns they need."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Lets Spark delete shuffle files of plans that nothing refers to any more.

    Checkpoint files go with them only where ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set. It does so only when the driver collects garbage, which long iterative jobs would otherwise do too late.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def training(doc_id: Column, mod: int, held: int) -> Column:
    """Whether the row's fold is the held-out one; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % mod == held, F.lit(False))


def global_rank(df: DataFrame, *order: Column, name: str) -> DataFrame:
    """Adds each row's place (from 0) in a total order without passing all rows through one task.

    Rows are range-partitioned and sorted; the driver adds up one count for each partition.
    """
    spark = df.sparkSession
    n = partitions(spark)
    ranged = cut(
        df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("__place", F.monotonically_increasing_id())
    )
    part = F.shiftright("__place", 33)
    counts = sorted((r[0], r[1]) for r in ranged.groupBy(part.alias("p")).count().collect())
    before, offsets = 0, []
    for p, c in counts:
        offsets += [F.lit(p), F.lit(before)]
        before += c
    start = F.create_map(*offsets)[part] if offsets else F.lit(0)
    within = F.col("__place").bitwiseAND(F.lit((1 << 33) - 1))
    return ranged.withColumn(name, (start + within).cast("long")).drop("__place")


def sized(df: DataFrame, most: int = 500_000) -> DataFrame:
    """A small-rowed, materialised table: broadcast up to ``most`` rows, else left to a shuffled join."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df
