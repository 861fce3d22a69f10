"""Tables that are broadcast only once their size is known."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows and bytes up to which a table is broadcast.
SMALL_ROWS, SMALL_BYTES = 100_000, 64 << 20


def small(df: DataFrame, most: int = SMALL_ROWS) -> DataFrame:
    """``df`` broadcast if it has at most ``most`` rows and ``SMALL_BYTES``; its plan then runs once, here.

    Rows are fetched up to one more than that. A small table goes on as what was fetched, so neither its joins nor its
    deduplication run again; of a larger one only the limit's share is lost.
    """
    found = df.limit(most + 1).toArrow()
    if found.num_rows > most or found.nbytes > SMALL_BYTES:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(found, df.schema))
