"""Resampling documents towards a target by hashed n-gram importance weights.

A task counts its documents' features with a DuckDB of its own, a bounded chunk
of texts at a time: SQL unnests the words, windows over them make the n-grams,
and a registered function gives each distinct feature its CRC. The counts of a
document's buckets, its words and features go to Parquet in the shared folder.
Spark merges them to counts of the corpus and of the target, whose ratio is each
bucket's gain, and scores the stored counts: a document's weight is the sum of
its features' gains, a hash of its id adds Gumbel noise, and the highest scores
are a draw without replacement in proportion to the weights' exponentials.

The texts are read once. What is sent around is one number a bucket.

Defined cases: null and empty texts have no features and the weight 0; documents
of fewer than ``least_words`` words get weight and score but are never drawn; a
null id has the noise of an empty one and comes after the others among equal
scores; rows that repeat have equal scores, and which comes first is open; an
empty corpus gives an empty result; an empty target has no counts, its gains
follow from the same formula; extra columns are not read.
"""

from __future__ import annotations

import math
import zlib

import duckdb
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm import text as tx
from granary.llm.session import cut, global_rank, stored

#: Bytes of text that one SQL statement takes; a longer text stands alone.
CHUNK_BYTES = 4 << 20
PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
COUNTS = "doc_id long, n_words long, n_features long, buckets array<int>, counts array<long>"


def feature_sql(shortest: int, longest: int) -> str:
    """(doc, feature) of every run of ``shortest`` to ``longest`` words of the table ``worded`` (doc, words)."""
    ahead = lambda n: ", ".join(["word", *(f"lead(word, {k}) over text" for k in range(1, n))])
    runs = [
        "select doc, word as feature from listed" if n == 1 else f"select doc, concat_ws(' ', {ahead(n)}) as feature from listed window text as (partition by doc order by place) "
        f"qualify lead(word, {n - 1}) over text is not null"
        for n in range(shortest, longest + 1)
    ]
    return f"with listed as (select doc, unnest(words) as word, unnest(range(len(words))) as place from worded) {' union all '.join(runs)}"


def crc(features: pa.Array) -> pa.Array:
    """The unsigned CRC-32 of each feature's UTF-8 bytes."""
    return pa.array([zlib.crc32(x.encode()) for x in features.to_pylist()], pa.int64())


def _count(shortest: int, longest: int, buckets: int):
    summed = f"""with features as ({feature_sql(shortest, longest)}),
      counted as (select doc, feature, count(*) as n from features group by doc, feature),
      coded as (select feature, feature_crc(feature) % {buckets} as bucket from (select distinct feature from counted))
      select doc, bucket, cast(sum(n) as bigint) as n from counted join coded using (feature) group by doc, bucket order by doc, bucket"""

    def run(batches):
        with duckdb.connect(config={"threads": 1, "memory_limit": "1GB", "temp_directory": ""}) as con:
            con.create_function("feature_crc", crc, ["VARCHAR"], "BIGINT", type="arrow")
            for batch in batches:
                texts, offsets = tx.lowered(batch.column("text")), tx.buffers(batch.column("text"))[1]
                for i, j in tx.slices(offsets, CHUNK_BYTES):
                    con.register("chunk", pa.table({"doc": pa.array(np.arange(j - i)), "text": texts.slice(i, j - i)}))
                    con.execute(f"create or replace temp table worded as select doc, regexp_extract_all(text, '{PATTERN}') as words from chunk")
                    n_words = con.execute("select len(words) as n from worded order by doc").fetchnumpy()["n"]
                    at, bucket, n = con.execute(summed).fetchnumpy().values()
                    bounds = np.concatenate([[0], np.cumsum(np.bincount(at, minlength=j - i))]).astype(np.int32)
                    lists = [pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.asarray(x), kind)) for x, kind in ((bucket.astype(np.int32), pa.int32()), (n, pa.int64()))]
                    total = np.bincount(at, n, j - i).astype(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").slice(i, j - i), pa.array(np.asarray(n_words, np.int64)), pa.array(total), *lists],
                        ["doc_id", "n_words", "n_features", "buckets", "counts"],
                    )

    return run


def count_features(docs: DataFrame, *, doc_id: str | None = "doc_id", text="text", ngrams=(1, 1), buckets=10_000) -> DataFrame:
    """The stored table of each document's words, features and bucket counts."""
    ids = F.col(doc_id).cast("long") if doc_id else F.lit(None).cast("long")
    rows = docs.select(ids.alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return stored(rows.mapInArrow(_count(*ngrams, buckets), COUNTS))


def bucket_totals(counted: DataFrame, buckets: int) -> list[int]:
    """The corpus' features in each bucket."""
    each = counted.select(F.explode(F.arrays_zip("buckets", "counts")).alias("x")).groupBy("x.buckets").agg(F.sum("x.counts"))
    totals = [0] * buckets
    for bucket, n in each.collect():
        totals[bucket] = n
    return totals


def gains(corpus: list[int], target: list[int]) -> np.ndarray:
    """floor(1000 ln) of each bucket's share of the target over its share of the corpus, one feature added to each."""
    n, s, t = len(corpus), sum(corpus), sum(target)
    return np.array([math.floor(1000 * math.log(float(b + 1) * float(s + n) / (float(a + 1) * float(t + n)))) for a, b in zip(corpus, target, strict=True)], np.int64)


def _weigh(shared):
    def run(batches):
        for batch in batches:
            bucket, counts = batch.column("buckets"), batch.column("counts")
            sums = np.concatenate([[0], np.cumsum(shared.value[bucket.flatten().to_numpy()] * counts.flatten().to_numpy())])
            ends = np.concatenate([[0], np.cumsum(bucket.value_lengths().to_numpy())])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "n_words", "n_features")), pa.array(np.diff(sums[ends]))], ["doc_id", "n_words", "n_features", "weight"])

    return run


def resample(
    docs: DataFrame, target: DataFrame, *, doc_id="doc_id", text="text", target_text="text", ngrams=(1, 1), buckets=10_000, seed=2024, least_words=20, percent=10
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, and the rank of those drawn, for every document."""
    counted = count_features(docs, doc_id=doc_id, text=text, ngrams=ngrams, buckets=buckets)
    wanted = count_features(target, doc_id=None, text=target_text, ngrams=ngrams, buckets=buckets)
    shared = docs.sparkSession.sparkContext.broadcast(gains(bucket_totals(counted, buckets), bucket_totals(wanted, buckets)))
    weighed = counted.mapInArrow(_weigh(shared), "doc_id long, n_words long, n_features long, weight long")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = cut(weighed.withColumn("score", (F.col("weight") + noise).cast("long")))
    able = F.col("n_words") >= least_words
    drawn = scored.where(able).count() * percent // 100
    ranked = global_rank(scored.where(able), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), name="place")
    rank = F.when(F.col("place") < drawn, F.col("place") + 1)
    return ranked.withColumn("rank", rank).drop("place").unionByName(scored.where(~able).withColumn("rank", F.lit(None).cast("long")))
