"""The operators' queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from granary.llm import decontaminate, langid, lexical, license_scan, mixing, near_text, near_vectors, oracles, pitman_yor, repeats, resample, secrets, sharding, url_lists
from granary.llm.session import ship, training


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pitman_yor_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return pitman_yor.score(table(spark, sf_dir, "documents"))


#: A fixed choice of captured hosts makes the list: host patterns change on two days, domains and first path segments on one.
LISTED_SQL = """
with seen as (
  select distinct lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#:]+)', 1)) as host, regexp_extract(url, '^[a-zA-Z]+://[^/?#]+/([^/?#]+)', 1) as segment from pages
), named as (
  select host, segment, regexp_extract(host, '([^.]+[.][^.]+[.][^.]+)$', 1) as domain from seen where host <> ''
), entries as (
  select 'host' as kind, host as pattern, 'block' as action, date '2024-01-01' + cast(length(host) * 7 % 120 as int) as listed_on from named
  union all select 'host', host, 'allow', date '2024-01-01' + cast(length(host) * 7 % 120 + 150 as int) from named
  union all select 'domain', domain, 'block', date '2024-01-01' + cast(length(domain) * 11 % 300 as int) from named where domain <> ''
  union all select 'prefix', concat(host, '/', segment), 'allow', date '2024-06-01' from named where segment = 'de'
)
select distinct kind, pattern, action, listed_on from entries
"""


def op2_temporal_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    captures = pages.withColumn("fetched_on", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") * 37 % 365).cast("int")))
    return url_lists.evaluate(captures, spark.sql(LISTED_SQL.replace("from pages", "from {pages}"), pages=pages))


def op4_license_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return license_scan.summary(license_scan.scan(table(spark, sf_dir, "documents")))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "rate", "copies")


def op5_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op6_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans", "n_live", "n_example"
    )


def op7_grid_order_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return near_vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


def op8_chosen_path_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return near_text.near_duplicates(table(spark, sf_dir, "documents"))


def op9_positional_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    index = decontaminate.build_index(table(spark, sf_dir, "documents"))
    found = decontaminate.judged(decontaminate.search(index, table(spark, sf_dir, "benchmark")))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        "contaminated",
        F.size("near").cast("long").alias("n_near_items"),
    )


def op10_crf_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs)
    held = training(F.col("doc_id"), 3, 1).alias("held_out")
    return langid.predict(docs, model).select("doc_id", held, "lang_pred", "score")


def op11_lexical_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    index = lexical.build_index(table(spark, sf_dir, "documents"))
    return lexical.search(index, table(spark, sf_dir, "benchmark"), k=10)


def op12_importance_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    drawn = resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op13_repeated_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    found = repeats.removed(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"), F.size("spans").cast("long").alias("n_spans"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    operators = (
        op1_pitman_yor_score,
        op2_temporal_url_lists,
        op3_mix_sources,
        op4_license_templates,
        op5_minimax_shards,
        op6_secret_ownership,
        op7_grid_order_near_vectors,
        op8_chosen_path_near_duplicates,
        op9_positional_decontamination,
        op10_crf_language,
        op11_lexical_product,
        op12_importance_resample,
        op13_repeated_windows,
    )
    return {f.__name__: f for f in operators} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    """SQL for the queries that it can express; models, hash-ordered shards and automata are tested by brute force."""
    return oracles.oracle_sql(LISTED_SQL)
