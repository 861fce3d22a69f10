"""The corpus pipeline: five operators, each working on what the stage before kept.

Every stage keeps the columns of its documents; the last adds the shard and the
slot in it. Rows keep their order nowhere.

Defined cases: texts that are null or without letters have no language and go;
null ids, languages and sources are kept (a null language becomes the predicted
one, a null source is one of its own); rows that repeat, as any near copies,
leave one of their group; documents that hold a benchmark passage for a
twentieth of their words or more go; an empty table gives an empty result;
columns of the documents that share a name with an operator's are kept as they
are, and the last stage's then begin with ``shard_``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.llm import decontaminate, langid, mixing, near_text, sharding
from granary.llm.session import cut, ship

#: A text whose best language has a smaller share of the words' posteriors is no text of one language. With four languages even a
#: text of two in equal parts keeps some 0.4 to 0.5 for its best; below 0.3 no language leads.
LEAST_LANGUAGE_SHARE = 0.3
#: Texts are near copies from this Jaccard similarity of their 5-word shingle sets on, in per cent (op8's own contract says 85).
NEAR_PERCENT = 80


def set_aside(docs: DataFrame, added: tuple[str, ...]) -> dict[str, str]:
    """Other names for columns of the documents that an operator's own would replace."""
    return {c: f"__own_{c}" for c in docs.columns if c in added}


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts of no learned language; a null lang becomes the predicted one."""
    ship(spark)
    model = langid.train(docs)
    aside = set_aside(docs, ("lang_pred", "score"))
    judged = langid.predict(docs.withColumnsRenamed(aside), model, keep=tuple(aside.get(c, c) for c in docs.columns))
    known = judged.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE_SHARE))
    return known.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*[F.col(aside.get(c, c)).alias(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the least id of each near-duplicate group."""
    ship(spark)
    return near_text.one_each(docs, percent=NEAR_PERCENT)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which benchmark windows cover a twentieth or more."""
    ship(spark)
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or drops documents so that sources come near their target shares."""
    aside = set_aside(docs, ("size", "source_size", "target", "rate", "copies"))
    mixed = mixing.emit(mixing.mix(docs.withColumnsRenamed(aside)), [aside.get(c, c) for c in docs.columns])
    return mixed.withColumnsRenamed({new: old for old, new in aside.items()})


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds size, text_crc32, shard and slot."""
    added = ("size", "text_crc32", "shard", "slot")
    aside = set_aside(docs, added)
    placed = sharding.shard(docs.withColumnsRenamed(aside))
    new = {c: f"shard_{c}" if c in aside else c for c in added}
    return placed.select(*[F.col(aside.get(c, c)).alias(c) for c in docs.columns], *[F.col(c).alias(new[c]) for c in added])


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", assign_shards),
]

#: Learned labels and hash-seeded draws aren't expressible in SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
