"""Secret scans with corpus-wide ownership frequency.

Patterns find candidates in whole texts. The candidates' hashes are aggregated
over the corpus by distinct repositories and owners: a value that many of them
hold is a copied example, one that a single owner holds looks live. Detectors
of the base set always stay; those of ``EXTRA`` count only where the value
belongs to one owner.

Everything is SQL expressions. Texts are read once: a plain substring that every
match of a pattern holds is looked for before the pattern is, and what is found
is stored. A match's place follows from the lengths of the pieces between
matches (``split``) and of the matches before it, summed up by blocks of matches
so that a text with very many of them costs no more each. Counting is two-phase
by hash and repository, so a value in a third of all rows spreads over tasks
until only its partial counts are left.

Defined cases: a null text is empty; a null owner or repository counts as one
more; rows that repeat have the same spans; an empty table gives an empty
result.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm.session import cut

#: kind: pattern, group that holds the value, fewest characters of it
BASE = {
    "assign": (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]{24,}", 0, 24),
}
EXTRA = {
    "jwt": (r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1),
    "hub": (r"gh[opsu]_[A-Za-z0-9]{30,}", 0, 1),
    "chat": (r"xox[abp]-[A-Za-z0-9-]{10,}", 0, 1),
    "pem": (r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----[A-Za-z0-9+/=\s]{16,}", 0, 1),
    "bearer": (r"[Bb]earer\x20+[A-Za-z0-9._~+/-]{16,}=*", 0, 1),
    "userinfo": (r"[a-z][a-z0-9+]{1,9}://[^\s:/@]{1,64}:[^\s:/@]{6,64}@", 0, 1),
}
#: Substrings of which every match of a kind holds one, and whether in either case.
CUES = {
    "assign": (("passw", "secret", "token", "apikey", "api_key"), True),
    "access": (("AKIA",), False),
    "jwt": (("eyJ",), False),
    "hub": (("gho_", "ghp_", "ghs_", "ghu_"), False),
    "chat": (("xoxa-", "xoxb-", "xoxp-"), False),
    "pem": (("PRIVATE KEY-----",), False),
    "bearer": (("earer ",), False),
    "userinfo": (("://",), False),
}
#: Matches whose spans are gathered one by one.
BLOCK = 64
SPAN = "struct<start: long, place: int, kind: string, end: long, value: long>"


def named(value: Column, body) -> Column:
    """``body`` of a value that is evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def cued(text: Column, kind: str) -> Column:
    """Whether a text may hold a match of the kind."""
    if kind not in CUES:
        return F.lit(True)
    cues, either = CUES[kind]
    any_of = lambda t: reduce(or_, [F.contains(t, F.lit(c)) for c in cues])
    return named(F.lower(text), any_of) if either else any_of(text)


def spans(text: Column, kind: str, pattern: str, group: int, least: int, place: int) -> Column:
    """Leftmost non-overlapping matches whose value has ``least`` characters, as an array of SPAN."""
    rx = F.lit(pattern)
    empty = F.array().cast(f"array<{SPAN}>")
    zero = F.lit(0).cast("long")
    pieces = F.arrays_zip(
        F.transform(F.split(text, pattern, -1), F.length).alias("gap"),
        F.transform(F.regexp_extract_all(text, rx, F.lit(0)), F.length).alias("length"),
        F.regexp_extract_all(text, rx, F.lit(group)).alias("value"),
    )
    width = lambda x: x["gap"] + F.coalesce(x["length"], F.lit(0))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["gap"]
        end = acc["at"] + width(x)
        span = F.struct(
            begin.alias("start"), F.lit(place).alias("place"), F.lit(kind).alias("kind"), end.alias("end"), F.xxhash64(x["value"]).alias("value")
        )
        good = F.coalesce(F.length(x["value"]) >= least, F.lit(False))
        return F.struct(end.alias("at"), F.when(good, F.array_append(acc["found"], span)).otherwise(acc["found"]).alias("found"))

    def placed(blocks: Column) -> Column:
        sums = F.transform(blocks, lambda b: F.aggregate(b, zero, lambda acc, x: acc + width(x)))
        firsts = F.aggregate(
            sums,
            F.struct(zero.alias("at"), F.array().cast("array<bigint>").alias("all")),
            lambda acc, x: F.struct((acc["at"] + x).alias("at"), F.array_append(acc["all"], acc["at"]).alias("all")),
            lambda acc: acc["all"],
        )
        within = lambda z: F.aggregate(z["block"], F.struct(z["first"].alias("at"), empty.alias("found")), step, lambda acc: acc["found"])
        return F.flatten(F.transform(F.arrays_zip(firsts.alias("first"), blocks.alias("block")), within))

    blocks = lambda all_: F.transform(
        F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / BLOCK).cast("int")), lambda i: F.slice(all_, i * BLOCK + 1, F.lit(BLOCK))
    )
    found = named(named(pieces, blocks), placed)
    return F.when(cued(text, kind) & text.rlike(pattern), found).otherwise(empty)


def shown(found: Column) -> Column:
    """Spans as kind:start:end by start, then kind as listed."""
    return F.concat_ws(
        ",", F.transform(F.array_sort(found), lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string")))
    )


def candidates(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds base and extra, arrays of SPAN; ``value`` is the hash of what the match hides."""
    t = F.coalesce(F.col(text), F.lit(""))

    def of(kinds: dict, first: int) -> Column:
        return F.concat(*[spans(t, k, *v, first + i) for i, (k, v) in enumerate(kinds.items())])

    return docs.withColumns({"base": of(BASE, 0), "extra": of(EXTRA, len(BASE))})


def ownership(found: DataFrame, repository: Column, owner: Column) -> DataFrame:
    """value, n_repositories, n_owners of all candidates in the columns base and extra."""
    each = found.select(
        repository.cast("string").alias("repository"), owner.cast("string").alias("owner"), F.explode(F.concat("base", "extra")).alias("s")
    ).select(F.col("s.value").alias("value"), F.struct("repository").alias("r"), F.struct("owner").alias("o"))
    by_pair = each.groupBy("value", "r", "o").agg(F.lit(1).alias("x")).select("value", F.to_json("r").alias("r"), F.to_json("o").alias("o"))
    return by_pair.groupBy("value").agg(F.countDistinct("r").alias("n_repositories"), F.countDistinct("o").alias("n_owners"))


def scan(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    owner: str = "source",
    repository: str = "doc_id",
    most_owners: int = 1,
    most_repositories: int = 100,
) -> DataFrame:
    """doc_id, base spans and spans with owner-specific extras, and counts of live-looking and copied values.

    A value is live-looking with at most ``most_owners`` owners and ``most_repositories`` repositories.
    """
    found = cut(
        candidates(docs, text).select(
            F.col(doc_id).alias("doc_id"),
            F.col(repository).alias("__repository"),
            F.col(owner).alias("__owner"),
            F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text_hash"),
            "base",
            "extra",
        )
    )
    some = found.where(F.size("base") + F.size("extra") > 0)
    owned = ownership(some, F.col("__repository"), F.col("__owner"))
    live = (F.col("n_owners") <= most_owners) & (F.col("n_repositories") <= most_repositories)
    # rows with equal id and text have equal spans, so these two name a row's findings
    judged = (
        some.dropDuplicates(["doc_id", "text_hash"])
        .select("doc_id", "text_hash", F.explode(F.concat("base", "extra")).alias("s"))
        .select("doc_id", "text_hash", "s", F.col("s.value").alias("value"))
        .join(owned, "value")
        .groupBy("doc_id", "text_hash")
        .agg(
            F.collect_list(F.when(live & (F.col("s.place") >= len(BASE)), F.col("s"))).alias("live_extra"),
            F.count_if(live).alias("n_live"),
            F.count_if(~live).alias("n_example"),
        )
        .withColumnsRenamed({"doc_id": "__id", "text_hash": "__hash"})
    )
    joined = found.join(judged, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("text_hash") == F.col("__hash")), "left")
    added = F.coalesce(F.col("live_extra"), F.array().cast(f"array<{SPAN}>"))
    number = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return joined.select(
        "doc_id",
        *[number(k) for k in BASE],
        shown(F.col("base")).alias("base_spans"),
        shown(F.concat("base", added)).alias("spans"),
        F.coalesce("n_live", F.lit(0)).cast("long").alias("n_live"),
        F.coalesce("n_example", F.lit(0)).cast("long").alias("n_example"),
    )
