"""Ranked lexical search as a blocked sparse matrix product.

A query set is a sparse matrix of items by terms, its entries the terms' numbers
of occurrences in the item. The corpus is one of terms by documents, stored in
blocks of whole documents (the index): its entries follow from term frequencies
and, at search time, become int64 impacts. A task multiplies the query matrix
with one block after another by Gustavson's method: each item's row is the sum
of the block's rows of its terms, merged in a dense accumulator of one block's
documents. Only an item's best ``k`` of a block survive, only its best of a
task leave it, and Spark ranks these few.

Query sets of any size are dealt by hash into parts of about ``PART_TERMS``
distinct terms and items' entries; each part is sent to the tasks whole, and
takes a pass over the index for its terms' document frequencies and one for the
product. The corpus' own vocabulary never leaves its blocks.

Scores are sums in 64-bit integers, so they don't depend on any order. Terms are
compared by 64-bit hashes: two different ones collide with odds of 2**-64 a pair.

Defined cases: null and empty texts have no terms and are never found; items
without terms find nothing; rows of one item id and text are one item, one id
with several texts is several items, each ranked alone; document rows that
repeat are found as often; of equal scores the smaller doc_id comes first, a null
one last; empty tables give an empty result; extra columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from granary.llm import text as tx
from granary.llm.session import cut

#: Bytes of text of a block of documents; a longer text stands alone.
BLOCK_BYTES = 4 << 20
#: Entries (item, term) of a part of the query set, some 30 bytes each.
PART_TERMS = 500_000
#: Cells of the dense accumulator, 8 bytes each: items at once times a block's documents.
CELLS = 1 << 21
INDEX = "n_docs long, n_terms long, ids binary, known binary, lengths binary, terms binary, holders binary, docs binary, often binary"


def _index(block_bytes: int):
    """Blocks of documents: by term, ascending, how many documents hold it, which, and how often."""

    def run(batches):
        for batch in batches:
            data, offsets = tx.buffers(batch.column("text"))
            ids = batch.column("doc_id").to_pylist()
            for i, j in tx.slices(offsets, block_bytes):
                lo = offsets[i]
                hashes, text, lengths = [], [], []
                for a, b in tx.slices(offsets[i : j + 1] - lo):
                    at = offsets[i + a]
                    w = tx.words(data[at : offsets[i + b]], offsets[i + a : i + b + 1] - at, tx.ALNUM)
                    hashes.append(w.hash)
                    text.append(w.text + a)
                    lengths.append(w.count)
                hashes, text, lengths = (np.concatenate(x) for x in (hashes, text, lengths))
                terms, of = np.unique(hashes, return_inverse=True)
                key, often = np.unique(of.astype(np.uint64) << np.uint64(32) | text.astype(np.uint64), return_counts=True)
                term = (key >> np.uint64(32)).astype(np.int64)
                some = [x is not None for x in ids[i:j]]
                packed = {
                    "ids": tx.planes(np.array([x or 0 for x in ids[i:j]], np.int64)),
                    "known": tx.pack(np.array(some)),
                    "lengths": tx.planes(lengths.astype(np.int64)),
                    "terms": tx.planes(np.diff(terms, prepend=np.uint64(0))),
                    "holders": tx.planes(np.bincount(term, minlength=len(terms)).astype(np.uint32)),
                    "docs": tx.planes((key & np.uint64(0xFFFFFFFF)).astype(np.uint32)),
                    "often": tx.planes(often.astype(np.uint32)),
                }
                head = [pa.array([int((lengths > 0).sum())], pa.int64()), pa.array([int(lengths.sum())], pa.int64())]
                yield pa.RecordBatch.from_arrays([*head, *(pa.array([v], pa.binary()) for v in packed.values())], ["n_docs", "n_terms", *packed])

    return run


def build_index(docs: DataFrame, *, doc_id="doc_id", text="text", block_bytes=BLOCK_BYTES) -> DataFrame:
    """The stored index of all documents."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return cut(rows.mapInArrow(_index(block_bytes), INDEX))


def _terms(row: dict) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumsum(tx.unplanes(row["terms"], np.uint64))


@dataclass
class Queries:
    """Items by terms in rows: ``bounds`` of each item's entries in ``term`` (a number in ``terms``) and ``times``."""

    terms: np.ndarray
    bounds: np.ndarray
    term: np.ndarray
    times: np.ndarray
    names: list
    keys: list[int]
    weight: np.ndarray | None = None

    @classmethod
    def of(cls, rows: list) -> Queries:
        hashes = [tx.unplanes(r["terms"], np.uint64) for r in rows]
        times = [tx.unplanes(r["times"], np.int64) for r in rows]
        flat = np.concatenate([*hashes, np.zeros(0, np.uint64)])
        terms, term = np.unique(flat, return_inverse=True)
        bounds = np.concatenate([[0], np.cumsum([len(h) for h in hashes], dtype=np.int64)])
        return cls(terms, bounds, term, np.concatenate([*times, np.zeros(0, np.int64)]), [r["item_id"] for r in rows], [r["key"] for r in rows])


def _items(batches):
    """Each item's distinct terms and how often each occurs."""
    for batch in batches:
        data, offsets = tx.buffers(batch.column("text"))
        out = []
        for i, j in tx.slices(offsets):
            w = tx.words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], tx.ALNUM)
            for k, (a, n) in enumerate(zip(w.first, w.count, strict=True)):
                terms, times = np.unique(w.hash[a : a + n], return_counts=True)
                out.append((len(terms), tx.planes(terms), tx.planes(times.astype(np.int64))))
        n, terms, times = zip(*out, strict=True) if out else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [batch.column("item_id"), batch.column("key"), pa.array(n, pa.int64()), pa.array(terms, pa.binary()), pa.array(times, pa.binary())],
            ["item_id", "key", "n", "terms", "times"],
        )


def _holders(shared):
    """In how many documents of a task's blocks each term of the queries occurs."""

    def run(batches):
        q: Queries = shared.value
        total = np.zeros(len(q.terms), np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                terms = _terms(row)
                if len(terms) and len(q.terms):
                    at = np.minimum(np.searchsorted(terms, q.terms), len(terms) - 1)
                    total += np.where(terms[at] == q.terms, tx.unplanes(row["holders"], np.uint32)[at], 0)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["term", "n"])

    return run


def impacts(weight: np.ndarray, often: np.ndarray, length: np.ndarray) -> np.ndarray:
    """w * ((10**9 tf) div (1000 tf + 8 m)) for each entry; all int64."""
    return weight * ((1_000_000_000 * often) // (1000 * often + 8 * length))


def product(q: Queries, terms: np.ndarray, holders: np.ndarray, docs: np.ndarray, often: np.ndarray, length: np.ndarray, cells: int = CELLS):
    """Yields (first item, scores of some items by documents) of the queries times one block."""
    first = np.concatenate([[0], np.cumsum(holders, dtype=np.int64)])
    at = np.minimum(np.searchsorted(terms, q.terms), max(len(terms) - 1, 0))
    there = terms[at] == q.terms if len(terms) else np.zeros(len(q.terms), bool)
    n_docs, n_items = len(length), len(q.names)
    step = max(1, cells // max(n_docs, 1))
    for lo in range(0, n_items, step):
        hi = min(lo + step, n_items)
        entry = np.arange(q.bounds[lo], q.bounds[hi])
        entry = entry[there[q.term[entry]]]
        item = np.searchsorted(q.bounds, entry, "right") - 1 - lo
        row = at[q.term[entry]]
        size = first[row + 1] - first[row]
        scores = np.zeros((hi - lo) * n_docs, np.int64)
        # entries are merged some at a time, so that what they expand to is bounded as well
        ends = np.cumsum(size)
        edges = [0, *np.searchsorted(ends, np.arange(cells, int(ends[-1]) if len(ends) else 0, cells)).tolist(), len(entry)]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            if a == b:
                continue
            of = np.repeat(np.arange(a, b), size[a:b])
            post = np.arange(len(of)) - np.repeat(ends[a:b] - size[a:b] - (ends[a] - size[a]), size[a:b]) + first[row[of]]
            value = q.times[entry[of]] * impacts(q.weight[q.term[entry[of]]], often[post], length[docs[post]])
            np.add.at(scores, item[of] * n_docs + docs[post], value)
        yield lo, scores.reshape(hi - lo, n_docs)


def best(scores: np.ndarray, ids: np.ndarray, known: np.ndarray, k: int) -> list[tuple[int, bool, int]]:
    """(-score, no id, id) of the ``k`` best documents with a score above 0, in their order."""
    least = 1
    if len(scores) > k:
        least = max(1, int(np.partition(scores, len(scores) - k)[len(scores) - k]))
    at = np.flatnonzero(scores >= least)
    return sorted(zip((-scores[at]).tolist(), (~known[at]).tolist(), ids[at].tolist(), strict=True))[:k]


def _search(shared, n_docs: int, n_terms: int, k: int, kind: pa.DataType):
    def run(batches):
        q: Queries = shared.value
        found: list[list] = [[] for _ in q.names]
        for batch in batches:
            for row in batch.to_pylist():
                lengths = tx.unplanes(row["lengths"], np.int64)
                big = 75 * int(lengths.max(initial=0)) * n_docs >= 1 << 63
                m = 25 + (np.array([75 * n * n_docs // n_terms for n in lengths.tolist()], np.int64) if big else 75 * lengths * n_docs // max(n_terms, 1))
                ids, known = tx.unplanes(row["ids"], np.int64), tx.unpack(row["known"], bool)
                holders = tx.unplanes(row["holders"], np.uint32)
                docs, often = (tx.unplanes(row[c], np.uint32).astype(np.int64) for c in ("docs", "often"))
                for lo, scores in product(q, _terms(row), holders, docs, often, m):
                    for i, one in enumerate(scores):
                        if one.any():
                            found[lo + i] = sorted(found[lo + i] + best(one, ids, known, k))[:k]
        flat = [(q.names[i], q.keys[i], None if none else doc, -score) for i, rows in enumerate(found) for score, none, doc in rows]
        names, keys, docs, scores = zip(*flat, strict=True) if flat else ((), (), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, kind), pa.array(keys, pa.int64()), pa.array(docs, pa.int64()), pa.array(scores, pa.int64())], ["item_id", "key", "doc_id", "score"]
        )

    return run


def search(index: DataFrame, items: DataFrame, *, item_id="item_id", text="text", k: int = 10, part_terms: int = PART_TERMS) -> DataFrame:
    """item_id, rank (from 1), doc_id and score of each item's ``k`` best documents."""
    context = index.sparkSession.sparkContext
    n_docs, n_terms = (x or 0 for x in index.agg(F.sum("n_docs"), F.sum("n_terms")).first())
    kind = items.schema[item_id].dataType
    of = T.StructType([T.StructField("item_id", kind), *T._parse_datatype_string("key long, n long, terms binary, times binary").fields])
    rows = items.select(F.col(item_id).alias("item_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    matrix = cut(rows.distinct().withColumn("key", F.xxhash64("item_id", "text")).mapInArrow(_items, of).where("n > 0"))
    parts = max(1, -(-(matrix.agg(F.sum("n")).first()[0] or 0) // part_terms))
    result = T.StructType([of[0], of[1], *T._parse_datatype_string("doc_id long, score long").fields])

    def searched(part: int) -> DataFrame:
        q = Queries.of([r.asDict() for r in matrix.where(F.pmod("key", F.lit(parts)) == part).collect()])
        shared = context.broadcast(q)
        holders = np.zeros(len(q.terms), np.int64)
        for term, n in index.mapInArrow(_holders(shared), "term long, n long").groupBy("term").agg(F.sum("n")).collect():
            holders[term] = n
        shared.destroy()
        q.weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for n in holders.tolist()], np.int64)
        return index.mapInArrow(_search(context.broadcast(q), n_docs, n_terms, k, to_arrow_type(kind)), result)

    found = searched(0)
    if parts > 1:
        found = cut(found)
        for part in range(1, parts):
            found = found.union(cut(searched(part)))
    order = Window.partitionBy("item_id", "key").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
