"""Substring dedup: passages that an earlier document has already.

Every run of ``width`` words gets a Rabin-Karp hash. Documents are stored in
blocks of about ``BLOCK_BYTES``; a block sends each of its distinct hashes once,
with the least doc_id that it has there, to the bucket of the hash's range. So a
passage of a third of all documents costs a bucket one entry a block, not one a
document. A bucket finds the least doc_id of all and tells each block which of
its hashes start in an earlier document elsewhere. What is left the block decides
alone: there a run goes where its document isn't the first of the block to have
it. Runs that go merge into maximal intervals of words, and the words outside
them are what is kept.

Equal runs have equal hashes; a run equals another's by chance with odds of
about the number of runs in 2**64.

Defined cases: null and empty texts have no words; a text of fewer words than
the width keeps them all; a null doc_id is neither smaller nor larger than
others, so its text keeps its words and takes none from others; rows of one
doc_id take nothing from each other, however often they repeat; an empty table
gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm import text as tx
from granary.llm.session import cut, partitions

WIDTH = 13
#: Bytes of text of a block; a longer text stands alone. Packed, a block stays below what a JVM's collector treats as huge.
BLOCK_BYTES = 1 << 20
#: Hashes of several blocks that a task sends at once.
SENT_HASHES = 2 << 20
#: Bytes of text that are split into words at once.
STEP_BYTES = 1 << 19
#: Bytes of text for which there is a bucket, about a sixth as many hashes; buckets are counted in whole 64s.
BUCKET_BYTES = 32 << 20
#: Bytes of text of a task that cuts, and the most partitions of either shuffle, of which each then holds several buckets or blocks.
TASK_BYTES, MOST_PARTITIONS = 32 << 20, 20_000
_BITS = 24

BLOCKS = "block long, ids binary, known binary, ends binary, texts binary"
HASHES = "bucket int, blocks binary, sizes binary, hashes binary, least binary"
MARKS = "block long, bucket int, marks binary"
KEPT = "doc_id long, n_words long, n_removed long, spans array<struct<start: long, end: long>>, kept string"


def _rows(columns: dict[str, tuple[list, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in columns.values()], list(columns))


def _each(batch: pa.RecordBatch):
    """A batch's rows one after another: blocks are large."""
    for k in range(batch.num_rows):
        yield {name: column[k].as_py() for name, column in zip(batch.schema.names, batch.columns, strict=True)}


def _blocks(most: int):
    """Documents packed into blocks: ids, whether there is one, where texts end, texts end to end."""

    def run(batches):
        number = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32
        ids, held, size = [], [], 0

        def one():
            some = np.array([x is not None for x in ids])
            packed = {
                "ids": tx.planes(np.array([x or 0 for x in ids], np.int64)),
                "known": tx.pack(some),
                "ends": tx.planes(np.cumsum([len(x) for x in held], dtype=np.int64)),
                "texts": tx.pack(np.concatenate(held)),
            }
            return _rows({"block": ([number], pa.int64())} | {k: ([v], pa.binary()) for k, v in packed.items()})

        for batch in batches:
            data, offsets = tx.buffers(batch.column("text"))
            for doc_id, a, b in zip(batch.column("doc_id").to_pylist(), offsets[:-1], offsets[1:], strict=True):
                if held and size + b - a > most:
                    yield one()
                    ids, held, size, number = [], [], 0, number + 1
                ids.append(doc_id)
                held.append(data[a:b])
                size += b - a
        if held:
            yield one()

    return run


class Block:
    """A stored block's documents, words and runs; distinct hashes in ascending order."""

    def __init__(self, row: dict, width: int):
        self.ids, self.known = tx.unplanes(row["ids"], np.int64), tx.unpack(row["known"], bool)
        self.data = tx.unpack(row["texts"], np.uint8)
        self.offsets = np.concatenate([[0], tx.unplanes(row["ends"], np.int64)])
        self.words = self._words()
        hashes, at = tx.rolling(self.words, width)
        ok = self.known[self.words.text[at]]
        hashes, self.at = hashes[ok], at[ok]
        order = np.argsort(hashes)
        ranked = hashes[order]
        new = np.concatenate([[True], ranked[1:] != ranked[:-1]]) if len(ranked) else np.zeros(0, bool)
        starts = np.flatnonzero(new)
        self.hashes = ranked[starts]
        self.of = np.empty(len(order), np.int64)
        self.of[order] = np.cumsum(new) - 1
        self.doc = self.ids[self.words.text[self.at]]
        self.least = np.minimum.reduceat(self.doc[order], starts) if len(starts) else np.zeros(0, np.int64)

    def _words(self) -> tx.Words:
        parts = []
        for i, j in tx.slices(self.offsets, STEP_BYTES):
            lo, hi = self.offsets[i], self.offsets[j]
            w = tx.words(self.data[lo:hi], self.offsets[i : j + 1] - lo, fold=False)
            parts.append((w.hash, w.start + lo, w.end + lo, w.text + i, w.count))
        return tx.Words(self.data, *(np.concatenate(x) for x in zip(*parts, strict=True)))

    def ranges(self, buckets: int):
        """(bucket, first, end) of the distinct hashes that fall in each."""
        bucket = ((self.hashes >> np.uint64(64 - _BITS)) * np.uint64(buckets) >> np.uint64(_BITS)).astype(np.int64)
        edges = np.flatnonzero(np.diff(bucket, prepend=-1, append=buckets)) if len(bucket) else np.zeros(1, np.int64)
        return zip(bucket[edges[:-1]].tolist(), edges[:-1].tolist(), edges[1:].tolist(), strict=True)

    def covered(self, earlier: np.ndarray, width: int) -> np.ndarray:
        """Whether each word goes, if the distinct hashes ``earlier`` have an earlier document elsewhere."""
        first = self.at[earlier[self.of] | (self.doc > self.least[self.of])]
        steps = np.zeros(len(self.words.hash) + 1, np.int32)
        steps[first] += 1
        steps[first + width] -= 1
        return np.cumsum(steps[:-1]) > 0

    def kept(self, gone: np.ndarray) -> pa.RecordBatch:
        """Each document's intervals of words that go, and its other words joined by one space."""
        w, n = self.words, len(self.ids)
        total = np.bincount(w.text, gone, n).astype(np.int64)
        edge = np.concatenate([[True], w.text[1:] != w.text[:-1], [True]])
        before, after = np.concatenate([[False], gone]), np.concatenate([gone, [False]])
        starts = np.flatnonzero(gone & (~before[:-1] | edge[:-1]))
        ends = np.flatnonzero(gone & (~after[1:] | edge[1:])) + 1
        of, first = w.text[starts], w.first
        bounds = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=n))]).astype(np.int32)
        spans = pa.ListArray.from_arrays(pa.array(bounds), pa.StructArray.from_arrays([pa.array(starts - first[of]), pa.array(ends - first[of])], ["start", "end"]))
        # a kept word takes the byte behind it along as its space, unless it is its document's last
        stay = np.flatnonzero(~gone)
        last = np.concatenate([w.text[stay][1:] != w.text[stay][:-1], [True]]) if len(stay) else np.zeros(0, bool)
        out = self.data.copy()
        out[w.end[stay[~last]]] = 0x20
        mask = np.zeros(len(out) + 1, np.int8)
        mask[w.start[stay]] += 1
        mask[w.end[stay] + ~last] -= 1
        mask = np.cumsum(mask[:-1], dtype=np.int8).astype(bool)
        ends = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])[self.offsets].astype(np.int32)
        texts = pa.Array.from_buffers(pa.string(), n, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(out[mask].tobytes())])
        return pa.RecordBatch.from_arrays(
            [pa.array(self.ids, mask=~self.known), pa.array(w.count.astype(np.int64)), pa.array(total), spans, texts], ["doc_id", "n_words", "n_removed", "spans", "kept"]
        )


def _send(buckets: int, width: int, most: int):
    """The distinct hashes of some blocks, a row a bucket: each block's in ascending order, one block after another."""

    def run(batches):
        held, size = {}, 0

        def sent():
            parts = [(bucket, *zip(*found, strict=True)) for bucket, found in sorted(held.items())]
            binary = lambda values: (values, pa.binary())
            return _rows(
                {
                    "bucket": ([p[0] for p in parts], pa.int32()),
                    "blocks": binary([tx.planes(np.array(p[1], np.int64)) for p in parts]),
                    "sizes": binary([tx.planes(np.array([len(x) for x in p[2]], np.int64)) for p in parts]),
                    "hashes": binary([tx.planes(np.concatenate([np.diff(x, prepend=np.uint64(0)) for x in p[2]])) for p in parts]),
                    "least": binary([tx.planes(np.concatenate(p[3])) for p in parts]),
                }
            )

        for batch in batches:
            for row in _each(batch):
                b = Block(row, width)
                for bucket, i, j in b.ranges(buckets):
                    held.setdefault(bucket, []).append((row["block"], b.hashes[i:j], b.least[i:j]))
                size += len(b.hashes)
                if size >= most:
                    yield sent()
                    held, size = {}, 0
        if held:
            yield sent()

    return run


def _earlier(batches):
    """Of each bucket and block, the places of the hashes that another block has in an earlier document."""
    bucket, held = None, []

    def told():
        blocks, hashes, least = zip(*held, strict=True)
        all_hashes, all_least = np.concatenate(hashes), np.concatenate(least)
        order = np.argsort(all_hashes)
        ranked = all_hashes[order]
        new = np.concatenate([[True], ranked[1:] != ranked[:-1]])
        first = np.minimum.reduceat(all_least[order], np.flatnonzero(new))
        earlier = np.empty(len(order), bool)
        earlier[order] = first[np.cumsum(new) - 1] < all_least[order]
        out, at = [], 0
        for block, h in zip(blocks, hashes, strict=True):
            places = np.flatnonzero(earlier[at : at + len(h)])
            at += len(h)
            if len(places):
                out.append((block, tx.planes(np.diff(places, prepend=0).astype(np.uint32))))
        return _rows({"block": ([b for b, _ in out], pa.int64()), "bucket": ([bucket] * len(out), pa.int32()), "marks": ([m for _, m in out], pa.binary())})

    for batch in batches:
        for row in _each(batch):
            if row["bucket"] != bucket and held:
                yield told()
                held = []
            bucket = row["bucket"]
            ends = np.cumsum(tx.unplanes(row["sizes"], np.int64))[:-1]
            with np.errstate(over="ignore"):
                hashes = [np.cumsum(x) for x in np.split(tx.unplanes(row["hashes"], np.uint64), ends)]
            held += zip(tx.unplanes(row["blocks"], np.int64).tolist(), hashes, np.split(tx.unplanes(row["least"], np.int64), ends), strict=True)
    if held:
        yield told()


def _cut(buckets: int, width: int):
    """Cuts each block; its stored row comes first, then what the buckets say."""

    def run(batches):
        block = marks = None

        def done():
            earlier = np.zeros(len(block.hashes), bool)
            for k, i, _ in block.ranges(buckets):
                if k in marks:
                    earlier[i + np.cumsum(tx.unplanes(marks[k], np.uint32), dtype=np.int64)] = True
            return block.kept(block.covered(earlier, width))

        for batch in batches:
            for row in _each(batch):
                if row["bucket"] < 0:
                    if block is not None:
                        yield done()
                    block, marks = Block(row, width), {}
                else:
                    marks[row["bucket"]] = row["marks"]
        if block is not None:
            yield done()

    return run


def removed(
    docs: DataFrame, *, doc_id="doc_id", text="text", width=WIDTH, block_bytes=BLOCK_BYTES, bucket_bytes=BUCKET_BYTES, task_bytes=TASK_BYTES, sent_hashes=SENT_HASHES
) -> DataFrame:
    """doc_id, n_words, n_removed, spans (maximal intervals of words that go, from 0) and kept (the text left) of each document."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = 64 * max(1, -(-size // (64 * bucket_bytes)))
    blocks = cut(rows.mapInArrow(tx.lean(_blocks(block_bytes)), BLOCKS))
    marks = (
        blocks.mapInArrow(tx.lean(_send(buckets, width, sent_hashes)), HASHES)
        .repartition(min(buckets, MOST_PARTITIONS), "bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(tx.lean(_earlier), MARKS)
    )
    tasks = min(max(partitions(docs.sparkSession), -(-size // task_bytes)), MOST_PARTITIONS)
    both = blocks.withColumn("bucket", F.lit(-1)).withColumn("marks", F.lit(None).cast("binary")).unionByName(marks, allowMissingColumns=True)
    return both.repartition(tasks, "block").sortWithinPartitions("block", "bucket").mapInArrow(tx.lean(_cut(buckets, width)), KEPT)
