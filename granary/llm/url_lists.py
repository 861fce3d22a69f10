"""URL filters by a temporal list join.

Dated entries of a list (block or allow a pattern from a day on) become
intervals: an entry holds until the next one for the same pattern. Every
capture is evaluated against the entries that were active when it was fetched.
A domain pattern covers the domain and all below it, a host pattern one host, a
prefix pattern a host and leading path segments. Of the active entries the most
specific decides: prefix (longer first), host, domain (longer first).

Captures expand to the patterns that could cover them, of those depths only that
occur in the list, so a long URL costs what its length does, and meet the
intervals by equality of pattern; intervals travel in runs of up to ``RUN``
whose time range is tested first, so each pattern's history costs a capture one
run, however long it is. Intervals within the broadcast bound are sent to all
executors; beyond it the join is shuffled and skewed hosts are split at run time.

Defined cases: a null or unparsable URL and a null time match nothing and are
allowed; entries with a null in pattern, kind or day are ignored; of entries for
one pattern and day, block wins; patterns are compared with their host in lower
case, prefixes without empty segments; captures that repeat are judged once and
kept as often; empty tables work; extra columns are not read. A pattern has one
entry a day at most, which bounds its history.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from granary.llm.session import cut, sized

RUN = 1024
HOST = r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"
PATH = r"(?i)^[a-z][a-z0-9+.-]*://[^/?#]*([^?#]*)"
DOMAIN_RANK, HOST_RANK, PREFIX_RANK = 0, 1 << 32, 2 << 32


def host(url: Column) -> Column:
    return F.nullif(F.lower(F.regexp_extract(url, HOST, 1)), F.lit(""))


def segments(path: Column) -> Column:
    return F.filter(F.split(path, "/"), lambda x: x != "")


def normal(kind: Column, pattern: Column) -> Column:
    """A pattern as captures are asked for it."""
    lower = F.lower(F.substring_index(pattern, "/", 1))
    rest = F.when(F.contains(pattern, F.lit("/")), F.regexp_extract(pattern, r"(?s)^[^/]*(/.*)$", 1)).otherwise("")
    return F.when(kind == "prefix", F.array_join(F.concat(F.array(lower), segments(rest)), "/")).otherwise(F.lower(pattern))


def depths(entries: DataFrame) -> tuple[list[int], list[int]]:
    """Numbers of labels of the domains and of segments of the prefixes in a list; different ones are few, as each needs a longer pattern."""
    size = F.when(F.col("kind") == "domain", F.size(F.split("pattern", r"\."))).when(F.col("kind") == "prefix", F.size(F.split("pattern", "/")) - 1)
    found = entries.select("kind", size.alias("depth")).where("depth > 0").distinct().collect()
    return tuple(sorted(d for k, d in found if k == kind) for kind in ("domain", "prefix"))


def asked(captures: DataFrame, url: str, domain_depths: list[int], prefix_depths: list[int]) -> DataFrame:
    """A row for each pattern (kind, pattern, rank) that could cover a capture."""
    split = captures.withColumn("__host", host(F.col(url))).where("__host is not null")
    split = split.withColumns({"__labels": F.size(F.split("__host", r"\.")), "__segments": segments(F.regexp_extract(url, PATH, 1))})
    item = lambda kind, pattern, rank: F.struct(F.lit(kind).alias("kind"), pattern.alias("pattern"), rank.cast("long").alias("rank"))
    of = lambda sizes, most: F.filter(F.array(*map(F.lit, sizes)).cast("array<int>"), lambda d: d <= most)
    domains = F.transform(
        of(domain_depths, F.col("__labels")), lambda d: item("domain", F.call_function("substring_index", F.col("__host"), F.lit("."), -d), d + F.lit(DOMAIN_RANK))
    )
    prefixes = F.transform(
        of(prefix_depths, F.size("__segments")),
        lambda d: item("prefix", F.concat("__host", F.lit("/"), F.array_join(F.slice("__segments", F.lit(1), d), "/")), d + F.lit(PREFIX_RANK)),
    )
    every = F.concat(domains, F.array(item("host", F.col("__host"), F.lit(HOST_RANK))), prefixes)
    return split.select(*captures.columns, F.inline(every))


def intervals(entries: DataFrame) -> DataFrame:
    """kind, pattern, action, since, until (exclusive, null: open) of entries (kind, pattern, action, listed_on)."""
    order = Window.partitionBy("kind", "pattern").orderBy("since")
    days = (
        entries.where("kind is not null and pattern is not null and listed_on is not null")
        .groupBy("kind", normal(F.col("kind"), F.col("pattern")).alias("pattern"), F.col("listed_on").alias("since"))
        .agg(F.max("action").alias("action"))  # 'block' after 'allow'
    )
    return days.withColumn("until", F.lead("since").over(order))


def evaluate(captures: DataFrame, entries: DataFrame, *, page_id="page_id", url="url", fetched="fetched_on") -> DataFrame:
    """page_id, url, fetched_on, decision, n_active, pattern and since of each capture."""
    held = intervals(entries)
    numbered = held.withColumn("run", F.floor((F.row_number().over(Window.partitionBy("kind", "pattern").orderBy("since")) - 1) / RUN))
    runs = numbered.groupBy("kind", "pattern", "run").agg(
        F.array_sort(F.collect_list(F.struct("since", "until", "action"))).alias("held"),
        F.min("since").alias("run_since"),
        F.max(F.coalesce("until", F.lit("9999-12-31").cast("date"))).alias("run_until"),
    )
    runs = cut(runs)
    kinds = depths(runs)
    runs = sized(runs)
    seen = captures.groupBy(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(fetched).alias("fetched_on")).agg(F.count("*").alias("times"))
    met = asked(seen.select("page_id", "url", "fetched_on"), "url", *kinds).join(runs, ["kind", "pattern"]).where("fetched_on >= run_since and fetched_on < run_until")
    active = F.element_at(
        F.filter("held", lambda x: (x["since"] <= F.col("fetched_on")) & (x["until"].isNull() | (F.col("fetched_on") < x["until"]))), 1
    )
    best = (
        met.withColumn("entry", active)
        .where("entry is not null")
        .groupBy("page_id", "url", "fetched_on")
        .agg(F.count("*").alias("n_active"), F.max_by(F.struct("pattern", "entry.since", "entry.action"), F.struct("rank", "kind", "pattern")).alias("top"))
        .toDF("p", "u", "f", "n_active", "top")
    )
    same = F.col("page_id").eqNullSafe(F.col("p")) & (F.col("url") == F.col("u")) & (F.col("fetched_on") == F.col("f"))
    judged = seen.join(best, same, "left")
    return judged.withColumn("__time", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).select(
        "page_id",
        "url",
        "fetched_on",
        F.coalesce("top.action", F.lit("allow")).alias("decision"),
        F.coalesce("n_active", F.lit(0)).cast("long").alias("n_active"),
        F.col("top.pattern").alias("pattern"),
        F.col("top.since").alias("since"),
    )
