"""Facts stored by key, so that joins of them at each run shuffle nothing.

Tables that are written once and joined many times by the same key are dealt into
buckets by its hash and sorted within them, when they are written. Spark then
joins bucket with bucket. Both sides need the same number of buckets, and the
join all columns of the key; tables live in the session's catalogue, their files
in its warehouse.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame

from granary.sources.csv import joined as of_root

#: Files of a bucket are read by one task: some 0.5 GB of the larger fact each.
BUCKETS = 200


def store(df: DataFrame, name: str, key: list[str], buckets: int = BUCKETS) -> DataFrame:
    """``df`` as the table ``name``, in place of an older one of this session, and read from it.

    Rows are dealt to the buckets' tasks before the write, so that each bucket is one file. Each version has a folder of
    its own in the warehouse: plans that still read the older one do so until they are done, so its files stay.
    """
    if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", name):
        raise ValueError(f"bad table name: {name!r}")
    if missing := [k for k in key if k not in df.columns]:
        raise ValueError(f"{name} lacks columns of its key: {missing}")
    path = of_root(df.sparkSession.conf.get("spark.sql.warehouse.dir"), f"{name}-{uuid.uuid4().hex}")
    writer = df.repartition(buckets, *key).write.mode("overwrite").option("path", path)
    writer.bucketBy(buckets, *key).sortBy(*key).saveAsTable(name)
    return df.sparkSession.table(name)


def joined(left: DataFrame, right: DataFrame, key: list[str], how: str = "left") -> DataFrame:
    """Joins two tables of ``store`` by their key, bucket by bucket, whatever their sizes."""
    return left.join(right.hint("merge"), key, how)
