"""Keys of all earlier runs, so that an increment drops what repeats them without reading them all.

Keys lie in buckets by hash. Each bucket has a Bloom filter, kept as rows of
words of bits, which each run adds to. An increment first meets the filters, by
an equality join on bucket and word; only buckets that may hold one of its keys
are opened, and only keys that may be there meet the stored ones, exactly and
null-safe. A filter never hides a stored key; where it is wrong the other way,
a bucket is opened in vain.

Both tables are sealed snapshots: a run's keys count for later runs once they are
added, and a run that fails adds none.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.sources.csv import joined
from granary.sources.snapshots import Dataset

#: Buckets, bits of a bucket's filter, bits a key sets. At a million keys a bucket one in some 500 strangers looks known.
BUCKETS, BITS, HASHES = 1024, 1 << 24, 5
WORDS = "bucket int, word int, bits long"


def bucket_of(key: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def _places(key: list[str], bits: int, hashes: int) -> Column:
    """Bits of a key: two hashes, added up some times."""
    first, second = F.xxhash64(F.lit(1), *key), F.xxhash64(F.lit(2), *key)
    return F.array(*[F.pmod(F.shiftright(first, 1) + k * F.shiftright(second, 4), F.lit(bits)).cast("int") for k in range(hashes)])


def filter_words(keys: DataFrame, key: list[str], *, buckets=BUCKETS, bits=BITS, hashes=HASHES) -> DataFrame:
    """bucket, word, bits of the filters of some keys; bits of a word are or-ed wherever it comes up again."""
    places = keys.select(bucket_of(key, buckets).alias("bucket"), F.explode(_places(key, bits, hashes)).alias("place"))
    word, bit = F.shiftright("place", 6), F.expr("shiftleft(1L, place & 63)")
    return places.select("bucket", word.alias("word"), bit.alias("bit")).groupBy("bucket", "word").agg(F.bit_or("bit").alias("bits"))


def maybe_known(keys: DataFrame, words: DataFrame, key: list[str], *, buckets=BUCKETS, bits=BITS, hashes=HASHES) -> DataFrame:
    """The distinct keys that the filters don't rule out, with their bucket."""
    once = keys.select(*key).distinct().withColumn("bucket", bucket_of(key, buckets))
    asked = once.withColumn("place", F.explode(_places(key, bits, hashes))).withColumns({"word": F.shiftright("place", 6), "bit": F.col("place").bitwiseAND(63)})
    merged = words.groupBy("bucket", "word").agg(F.bit_or("bits").alias("bits"))
    met = asked.join(merged, ["bucket", "word"], "left")
    has = F.coalesce(F.expr("(shiftrightunsigned(bits, bit) & 1) = 1"), F.lit(False))
    return met.groupBy("bucket", *key).agg(F.bool_and(has).alias("known")).where("known").drop("known")


def _met(rows: DataFrame, keys: DataFrame, key: list[str], how: str) -> DataFrame:
    side = keys.select(*[F.col(k).alias(f"__{k}") for k in key]).distinct()
    return rows.join(side, reduce(and_, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in key]), how)


def among(rows: DataFrame, keys: DataFrame, key: list[str]) -> DataFrame:
    """Rows whose key is among ``keys``; null keys are equal."""
    return _met(rows, keys, key, "left_semi")


def without(rows: DataFrame, keys: DataFrame, key: list[str]) -> DataFrame:
    """Rows whose key isn't among ``keys``."""
    return _met(rows, keys, key, "left_anti")


class KeyIndex:
    """The keys of a table below ``root``."""

    def __init__(self, spark: SparkSession, root: str, key: list[str], **sizes):
        self.spark, self.key, self.sizes = spark, key, {"buckets": BUCKETS, "bits": BITS, "hashes": HASHES} | sizes
        self.keys, self.words = Dataset(spark, joined(root, "keys"), ("bucket",)), Dataset(spark, joined(root, "words"))

    def unseen(self, rows: DataFrame) -> tuple[DataFrame, list[int]]:
        """Rows whose key no earlier run has added, and the buckets that were opened to tell."""
        manifest = self.keys.manifest()
        if manifest is None:
            return rows, []
        maybe = maybe_known(rows, self.words.read(), self.key, **self.sizes)
        found = sorted(r[0] for r in maybe.select("bucket").distinct().collect())
        if not found:
            return rows, []
        stored = self.keys.read(manifest.version, partitions=[{"bucket": b} for b in found])
        return without(rows, among(stored, maybe, self.key), self.key), found

    def add(self, rows: DataFrame, run_id: str) -> None:
        """Adds the keys of ``rows``. The filters come first: a run that fails in between has only added bits."""
        once = rows.select(*self.key).distinct().withColumn("bucket", bucket_of(self.key, self.sizes["buckets"]))
        words = filter_words(once, self.key, **self.sizes)
        if not self.words._sealed_by(run_id, len(self.words.versions())):
            self.words.commit(words.select(*[F.col(f.name).cast(f.dataType) for f in T._parse_datatype_string(WORDS)]), run_id, append=True)
        self.keys.commit(once, run_id, append=True)
