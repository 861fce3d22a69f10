"""Mixing sources to target weights.

Sizes are summed by source, the sums give each source a target and so a
repetition rate, and each document is emitted ``floor(rate)`` times plus once
more where a hash of its id falls below the rate's fraction. All of it is
DataFrame expressions: one pass that pre-aggregates sizes by source, then one
that joins the (few) rates back; documents themselves are never shuffled when
the rates fit the broadcast bound.

Defined cases: a null text has size 0; null is a source of its own; rows without
an id draw by their text; rows that repeat are taken the same number of times each; a source or table without words
gets rate 0; an empty table gives an empty result. Only columns named here are
read, and added ones replace columns of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm.session import cut, global_rank

WORD = r"[^\x20\x09-\x0D]+"
#: Sources up to this many are sent to every executor (some 100 bytes each); more are joined by a shuffle.
BROADCAST_SOURCES = 20_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...] = (3.0, 1.0, 2.0), share: float = 1.5, most: float = 2.0
) -> tuple[DataFrame, int]:
    """Targets from one row (source, source_size) a source: weights go round by source name, nulls last.

    Targets are the source's weight times a common level, but at most ``most`` times its size. The level is
    found by sharing out again what capped sources leave over until none is above its cap.
    Returns source, source_size, target and the number of sources.
    """
    ranked = global_rank(sizes, F.col("source").asc_nulls_last(), name="place")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    table = cut(ranked.withColumn("weight", weight.cast("double")))
    n, total = table.agg(F.count("*"), F.sum("source_size")).first()
    cap = F.col("source_size") * F.lit(float(most))
    left, level = share * (total or 0), 0.0
    while True:
        # sources whose cap lies under the level keep their cap; the rest share what is left
        capped = cap <= F.col("weight") * level
        spent, open_weight = table.agg(
            F.sum(F.when(capped, cap).otherwise(0.0)), F.sum(F.when(capped, 0.0).otherwise(F.col("weight")))
        ).first()
        if not open_weight:
            break
        new = max(0.0, (left - spent) / open_weight)
        if new <= level:
            break
        level = new
    return table.select("source", "source_size", F.least(cap, F.col("weight") * level).alias("target")), n


def mix(
    docs: DataFrame,
    *,
    source: str = "source",
    doc_id: str = "doc_id",
    text: str = "text",
    seed: int = 17,
    weights: tuple[float, ...] = (3.0, 1.0, 2.0),
    share: float = 1.5,
    most: float = 2.0,
) -> DataFrame:
    """Adds size, source_size, target, rate and copies (how often the mix takes the row)."""
    sized = docs.withColumn("size", word_count(F.col(text)))
    sums = sized.groupBy(F.col(source).alias("source")).agg(F.sum("size").alias("source_size"))
    targets, n = source_targets(sums, weights, share, most)
    key = targets.withColumnsRenamed({"source": "__source"})
    if n <= BROADCAST_SOURCES:
        key = F.broadcast(key)
    clash = [c for c in ("source_size", "target", "rate", "copies") if c in docs.columns]
    joined = sized.drop(*clash).join(key, F.col(source).eqNullSafe(F.col("__source")), "left").drop("__source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    # texts without an id have a draw of their own
    of = F.coalesce(F.col(doc_id).cast("string"), F.concat(F.lit("text "), F.md5(F.coalesce(F.col(text), F.lit("")))))
    draw = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), of)), 1, 8), 16, 10).cast("double") / float(1 << 32)
    return joined.withColumn("rate", rate).withColumn(
        "copies", (F.floor("rate") + F.when(draw < F.col("rate") - F.floor("rate"), 1).otherwise(0)).cast("int")
    )


def emit(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """The mix itself: every row of ``mix`` as often as it says."""
    return mixed.where("copies > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*columns)
