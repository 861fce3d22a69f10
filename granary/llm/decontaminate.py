"""Benchmark decontamination over a distributed positional inverted index.

The index is partitioned by document: each row holds a block of whole documents
and, term by term, the ascending positions of its words. Benchmark passages are
windows of consecutive words. A block answers all windows of a stated, bounded
part of the benchmark at once: windows with a term that the block lacks drop
out; for the others the posting lists are intersected, shifted by the terms'
offsets, from the rarest term of the block on. What is left are exact phrase
matches. A proximity match needs every term of a window within ``slop`` words of
one occurrence of its first term.

Windows are made and deduplicated as a table of one row for each window and item.
Its rows are dealt by hash to parts of about ``PART_WINDOWS``, whatever the
items' number and length, and tasks pack each part. A benchmark of one part is
searched in one pass over the stored index; of more, in one pass each, one after
another, each storing its hits and giving its broadcast back.

Defined cases: null or empty texts have no words and no hits; an item of fewer
words than a window is one window; a null item id reads as an empty string;
rows that repeat are judged one by one; an empty benchmark hits nothing; empty
documents give an empty result; extra columns are not read.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm import text as tx
from granary.llm.session import cut, sized

WIDTH = 13
#: Rows (window, item) of the benchmark that are held in memory at once, some 100 bytes each.
PART_WINDOWS = 250_000
#: Windows that a task hands on at once.
SENT_WINDOWS = 1 << 16
BLOCK_BYTES = 1 << 20
#: Positions between documents, so that no match crosses from one to the next.
GAP = 64
INDEX = "block long, doc_id array<long>, tag array<long>, words binary, terms binary, counts binary, steps binary"
FOUND = (
    "block long, at int, doc_id long, tag long, n_words long, spans array<struct<start: long, end: long>>, items array<string>, near array<string>"
)


def _planes(values: np.ndarray) -> bytes:
    return tx.pack(values.view(np.uint8).reshape(-1, values.itemsize).T)


def _unplanes(raw: bytes, kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(tx.unpack(raw, np.uint8).reshape(width, -1).T).view(kind).ravel()


def post(w: tx.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Terms in ascending order, how often each occurs, and the positions by term, each term's ascending."""
    position = (np.arange(len(w.hash)) + GAP * w.text).astype(np.uint64)
    order = np.argsort(w.hash)
    h = w.hash[order]
    new = np.concatenate([[True], h[1:] != h[:-1]]) if len(h) else np.zeros(0, bool)
    key = ((np.cumsum(new) - 1).astype(np.uint64) << np.uint64(32)) | position[order]
    key.sort()
    terms = h[new]
    return terms, np.diff(np.append(np.flatnonzero(new), len(h))).astype(np.uint32), key & np.uint64(0xFFFFFFFF)


def _index(batches):
    number = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32
    for batch in batches:
        data, offsets = tx.buffers(batch.column("text"))
        for i, j in tx.slices(offsets, BLOCK_BYTES):
            w = tx.words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], tx.ALNUM)
            terms, counts, positions = post(w)
            steps = np.diff(positions, prepend=np.uint64(0)).astype(np.int64)
            if len(terms):
                first = np.concatenate([[0], np.cumsum(counts[:-1], dtype=np.int64)])
                steps[first] = positions[first]
            columns = [
                [number],
                [batch.column("doc_id")[i:j].to_pylist()],
                [batch.column("tag")[i:j].to_pylist()],
                [tx.pack(w.count.astype(np.int64))],
                [_planes(terms)],
                [tx.pack(counts)],
                [_planes(steps.astype(np.uint32))],
            ]
            kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), *[pa.binary()] * 4]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["block", "doc_id", "tag", "words", "terms", "counts", "steps"]
            )
            number += 1


def build_index(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", tag: Column | None = None) -> DataFrame:
    """The stored index of all documents; ``tag`` is a long that is handed on with each."""
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        (F.lit(0).cast("long") if tag is None else tag.cast("long")).alias("tag"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    return cut(rows.mapInArrow(tx.lean(_index), INDEX))


@dataclass
class Windows:
    """Distinct windows as numbers of terms (-1 where a window is shorter), and the items of each."""

    terms: np.ndarray
    of: np.ndarray
    length: np.ndarray
    bounds: np.ndarray  # of each window's items in ``item``
    item: np.ndarray
    names: list[str]

    @classmethod
    def packed(cls, rows: list[tuple[bytes, str]], width: int) -> Windows:
        """Of (window, item), with rows of one window side by side."""
        first = [k for k, (run, _) in enumerate(rows) if not k or run != rows[k - 1][0]]
        runs = [np.frombuffer(rows[k][0], np.uint64) for k in first]
        terms = np.unique(np.concatenate([*runs, np.zeros(0, np.uint64)]))
        of = np.full((len(runs), width), -1, np.int32)
        for k, run in enumerate(runs):
            of[k, : len(run)] = np.searchsorted(terms, run)
        names = sorted({item for _, item in rows})
        number = {x: k for k, x in enumerate(names)}
        return cls(terms, of, np.array([len(r) for r in runs], np.int64), np.array([*first, len(rows)]), np.array([number[x] for _, x in rows], np.int64), names)

    def items(self, k: int) -> list[str]:
        return [self.names[x] for x in self.item[self.bounds[k] : self.bounds[k + 1]]]


def _windows(width: int):
    def run(batches):
        for batch in batches:
            data, offsets = tx.buffers(batch.column("text"))
            for i, j in tx.slices(offsets):
                w = tx.words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], tx.ALNUM)
                wide = np.minimum(w.count, width)
                n = np.where(w.count > 0, w.count - wide + 1, 0)
                of = np.repeat(np.arange(j - i), n)
                at = np.arange(len(of)) - (np.cumsum(n) - n)[of] + w.first[of]
                for lo in range(0, len(of), SENT_WINDOWS):
                    some = of[lo : lo + SENT_WINDOWS]
                    size = wide[some]
                    ends = np.cumsum(size)
                    flat = w.hash[np.arange(ends[-1]) + np.repeat(at[lo : lo + SENT_WINDOWS] - (ends - size), size)]
                    bounds = np.concatenate([[0], ends * 8]).astype(np.int32)
                    runs = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(bounds.tobytes()), pa.py_buffer(flat.tobytes())])
                    yield pa.RecordBatch.from_arrays([batch.column("item_id").take(pa.array(some + i)), runs], ["item_id", "run"])

    return run


def _pack(width: int):
    """Each part's windows as one row; rows come by part and window."""

    def run(batches):
        part, rows = None, []
        one = lambda: pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int64()), pa.array([pickle.dumps(Windows.packed(rows, width))], pa.binary())], ["part", "windows"]
        )
        for batch in batches:
            for p, *row in zip(*(batch.column(c).to_pylist() for c in ("part", "run", "item_id")), strict=True):
                if p != part and rows:
                    yield one()
                    rows = []
                part = p
                rows.append(tuple(row))
        if rows:
            yield one()

    return run


def probe(q: Windows, terms: np.ndarray, counts: np.ndarray, positions: np.ndarray, slop: int):
    """Yields (window, positions of exact matches, positions of the first term in proximity matches)."""
    if not len(q.of) or not len(terms):
        return
    at = np.minimum(np.searchsorted(terms, q.terms), len(terms) - 1)
    there = np.append(terms[at] == q.terms, True)
    first = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
    often = np.append(counts[at].astype(np.int64), np.iinfo(np.int64).max)
    for k in np.flatnonzero(there[q.of].all(1)):
        of = q.of[k, : q.length[k]]
        lists = [positions[first[at[t]] : first[at[t] + 1]] for t in of]
        order = np.argsort(often[of], kind="stable")
        exact = lists[order[0]] - order[0]
        near = lists[0]
        for o in order:
            p = lists[o]
            if len(exact):
                x = np.minimum(np.searchsorted(p, exact + o), len(p) - 1)
                exact = exact[p[x] == exact + o]
            if len(near):
                x = np.searchsorted(p, near - slop)
                near = near[(x < len(p)) & (p[np.minimum(x, len(p) - 1)] <= near + slop)]
            if not len(exact) and not len(near):
                break
        if len(exact) or len(near):
            yield int(k), exact, near


def _search(shared, slop: int, every: bool):
    """Hits of each document; without ``every`` only of those that have some."""

    def run(batches):
        q: Windows = shared.value
        for batch in batches:
            for row in batch.to_pylist():
                words = tx.unpack(row["words"], np.int64)
                terms, counts = _unplanes(row["terms"], np.uint64), tx.unpack(row["counts"], np.uint32)
                steps = _unplanes(row["steps"], np.uint32).astype(np.int64)
                total = np.cumsum(steps)
                first = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])[:-1]
                base = total[first] - steps[first] if len(first) else first
                positions = total - np.repeat(base, counts)
                starts = np.cumsum(words) - words + GAP * np.arange(len(words))
                spans: dict[int, list] = {}
                names: dict[int, set] = {}
                close: dict[int, set] = {}
                for k, exact, near in probe(q, terms, counts, positions, slop):
                    doc = np.searchsorted(starts, exact, "right") - 1
                    for d, s in zip(doc.tolist(), (exact - starts[doc]).tolist(), strict=True):
                        spans.setdefault(d, []).append((s, s + int(q.length[k])))
                        names.setdefault(d, set()).update(q.items(k))
                    for d in set((np.searchsorted(starts, near, "right") - 1).tolist()):
                        close.setdefault(d, set()).update(q.items(k))
                docs = range(len(words)) if every else sorted({*spans, *close})
                merged = []
                for d in docs:
                    out: list[dict] = []
                    for s, e in sorted(spans.get(d, ())):
                        if out and s <= out[-1]["end"]:
                            out[-1]["end"] = max(e, out[-1]["end"])
                        else:
                            out.append({"start": s, "end": e})
                    merged.append(out)
                span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["block"]] * len(docs), pa.int64()),
                        pa.array(docs, pa.int32()),
                        pa.array([row["doc_id"][d] for d in docs], pa.int64()),
                        pa.array([row["tag"][d] for d in docs], pa.int64()),
                        pa.array([words[d] for d in docs], pa.int64()),
                        pa.array(merged, span),
                        pa.array([sorted(names.get(d, ())) for d in docs], pa.list_(pa.string())),
                        pa.array([sorted(close.get(d, ())) for d in docs], pa.list_(pa.string())),
                    ],
                    ["block", "at", "doc_id", "tag", "n_words", "spans", "items", "near"],
                )

    return run


def parts_of(benchmark: DataFrame, *, item_id="item_id", text="text", width=WIDTH, part_windows=PART_WINDOWS) -> tuple[DataFrame, int]:
    """part, windows (a packed ``Windows``) of the benchmark, and the number of parts; a part may have no row."""
    pairs = cut(
        benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
        .mapInArrow(tx.lean(_windows(width)), "item_id string, run binary")
        .distinct()
    )
    parts = -(-pairs.count() // part_windows) or 1
    dealt = pairs.withColumn("part", F.pmod(F.xxhash64("item_id", "run"), F.lit(parts)))
    return cut(dealt.repartition(parts, "part").sortWithinPartitions("part", "run", "item_id").mapInArrow(tx.lean(_pack(width)), "part long, windows binary")), parts


def search(index: DataFrame, benchmark: DataFrame, *, item_id="item_id", text="text", width=WIDTH, slop=26, part_windows=PART_WINDOWS) -> DataFrame:
    """One row a document: doc_id, tag, n_words, spans (merged hits, words from 0), items, near (items with a proximity match)."""
    context = index.sparkSession.sparkContext
    packed, parts = parts_of(benchmark, item_id=item_id, text=text, width=width, part_windows=part_windows)
    nothing = Windows.packed([], width)

    def shared(part: int):
        row = packed.where(F.col("part") == part).select("windows").first()
        return context.broadcast(pickle.loads(row[0]) if row else nothing)

    if parts == 1:
        found = index.mapInArrow(tx.lean(_search(shared(0), slop, True)), FOUND)
    else:
        none = context.broadcast(nothing)
        found = index.mapInArrow(tx.lean(_search(none, slop, True)), FOUND)
        for part in range(parts):
            now = shared(part)
            found = found.union(cut(index.mapInArrow(tx.lean(_search(now, slop, False)), FOUND)))
            now.destroy()
        found = found.groupBy("block", "at").agg(
            *[F.max(c).alias(c) for c in ("doc_id", "tag", "n_words")], *[F.flatten(F.collect_list(c)).alias(c) for c in ("spans", "items", "near")]
        )
    distinct = lambda c: F.array_sort(F.array_distinct(c)).alias(c)
    return found.select("doc_id", "tag", "n_words", F.array_sort("spans").alias("spans"), distinct("items"), distinct("near"))


def judged(found: DataFrame, least_share: float = 0.05) -> DataFrame:
    """Adds n_hit and contaminated (hits cover at least ``least_share`` of the words) to what ``search`` gives."""
    start = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("hit"))
    covered = F.aggregate(
        "spans",
        start,
        lambda acc, x: F.struct(
            F.greatest(acc["end"], x["end"]).alias("end"),
            (acc["hit"] + F.greatest(F.lit(0).cast("long"), x["end"] - F.greatest(x["start"], acc["end"]))).alias("hit"),
        ),
        lambda acc: acc["hit"],
    )
    parts = round(1 / least_share)
    return found.withColumn("n_hit", covered).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * parts >= F.col("n_words"))
    )


def clean(docs: DataFrame, benchmark: DataFrame, *, doc_id="doc_id", text="text", least_share: float = 0.05) -> DataFrame:
    """The rows of ``docs`` that aren't contaminated."""
    index = build_index(docs, doc_id=doc_id, text=text, tag=F.xxhash64(text))
    bad = judged(search(index, benchmark), least_share).where("contaminated")
    bad = sized(cut(bad.select(F.col("doc_id").alias("id_"), F.col("tag").alias("tag_")).distinct()))
    return docs.join(bad, F.col(doc_id).cast("long").eqNullSafe(bad["id_"]) & (F.xxhash64(text) == bad["tag_"]), "left_anti")
