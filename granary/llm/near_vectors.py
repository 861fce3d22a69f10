"""Embedding near-duplicates by an epsilon grid order join.

Unit vectors at cosine ``c`` lie ``eps = sqrt(2 - 2 c)`` apart. Distinct vectors
are projected on leading principal directions (an orthonormal basis, so
projections are never farther apart than vectors), sorted by the grid cells of
side eps there, and cut into blocks of the sequence with a bounding box each.
Intervals of the sequence then join recursively, from whole partitions over
runs of blocks to single blocks: a pair of intervals whose boxes are more than
eps apart is skipped with all below it. Vectors of the block pairs that remain
meet once, in double precision.

Of the links only what the result needs leaves a task: numbers of links, and a
spanning forest. The basis comes from at most ``SAMPLE`` vectors; it decides how
much is skipped, never what is found.

Defined cases: vectors that are null, zero, or hold null or non-finite
components, and those without a label, link with nothing; equal vectors of a
label are one with a multiplicity; only vectors of one length link; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm import text as tx
from granary.llm.graph import components
from granary.llm.session import cut, partitions

SAMPLE = 10_000
LEADING = 6
BLOCK, RUN = 512, 8
#: Blocks that one task compares with another before a salt deals out the rest.
PARTNERS = 16

LO = [f"lo{k}" for k in range(LEADING)]
HI = [f"hi{k}" for k in range(LEADING)]


def _units(rows: list) -> np.ndarray:
    """Unit vectors, in double precision."""
    x = np.array(rows, np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # squares of very large or small components stay finite
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def basis(sample: list) -> dict[int, np.ndarray]:
    """Principal directions, by length of the vectors."""
    found = {}
    for d in {len(v) for v in sample}:
        x = _units([v for v in sample if len(v) == d])
        _, vectors = np.linalg.eigh(x.T @ x - len(x) * np.outer(x.mean(0), x.mean(0)))
        found[d] = vectors[:, ::-1][:, :LEADING]
    return found


def _project(shared, eps: float):
    def run(batches):
        bases = shared.value
        for batch in batches:
            rows = batch.column("v").to_pylist()
            if not rows:
                continue
            at = np.zeros((len(rows), LEADING))
            unit = [b""] * len(rows)
            for d in {len(r) for r in rows}:
                those = [i for i, r in enumerate(rows) if len(r) == d]
                x = _units([rows[i] for i in those])
                axes = bases.get(d, np.eye(d)[:, :LEADING])
                at[those, : axes.shape[1]] = x @ axes
                for i, u in zip(those, x, strict=True):
                    unit[i] = u.tobytes()
            cells = np.floor(at / eps).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("node", "label", "dim", "copies")),
                    *(pa.array(cells[:, k]) for k in range(LEADING)),
                    pa.array([a.tobytes() for a in at], pa.binary()),
                    pa.array(unit, pa.binary()),
                ],
                ["node", "label", "dim", "copies", *(f"c{k}" for k in range(LEADING)), "at", "unit"],
            )

    return run


def _blocks(most: int):
    """Blocks of up to ``most`` vectors of a partition's sorted sequence."""

    def run(batches):
        part = TaskContext.get().partitionId() if TaskContext.get() else 0
        held, key, number = [], None, 0

        def block():
            at = np.stack([np.frombuffer(r["at"]) for r in held])
            columns = [
                [(part << 32) + number], [part], [number // RUN], [held[0]["label"]], [held[0]["dim"]],
                *([x] for x in at.min(axis=0)), *([x] for x in at.max(axis=0)),
                [tx.pack(np.array([r["node"] for r in held]))], [tx.pack(np.array([r["copies"] for r in held]))],
                [tx.pack(np.frombuffer(b"".join(r["unit"] for r in held)))],
            ]
            names = ["block", "part", "run", "label", "dim", *LO, *HI, "nodes", "copies", "units"]
            kinds = [pa.int64(), pa.int32(), pa.int32(), held_kind, pa.int32(), *[pa.float64()] * (2 * LEADING), *[pa.binary()] * 3]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        for batch in batches:
            held_kind = batch.schema.field("label").type
            for row in batch.select(["node", "label", "dim", "copies", "at", "unit"]).to_pylist():
                if held and (len(held) == most or key != (row["label"], row["dim"])):
                    yield block()
                    held, number = [], number + 1
                key = (row["label"], row["dim"])
                held.append(row)
        if held:
            yield block()

    return run


def near_boxes(eps: float, other: str = "_b") -> Column:
    """Whether the boxes in LO, HI and in those names with a suffix are within eps."""
    gap = [F.greatest(F.col(lo + other) - F.col(hi), F.col(lo) - F.col(hi + other), F.lit(0.0)) for lo, hi in zip(LO, HI, strict=True)]
    return reduce(lambda a, b: a + b, [g * g for g in gap]) <= eps * eps * (1 + 1e-9)


def block_pairs(blocks: DataFrame, eps: float) -> DataFrame:
    """Pairs a <= b of blocks that may hold a link."""
    whole = ["label", "dim"]
    leaf = blocks.select(*whole, "part", "run", "block", *LO, *HI)
    wide = [*(F.min(c).alias(c) for c in LO), *(F.max(c).alias(c) for c in HI)]
    level = {"part": leaf.groupBy(*whole, "part").agg(*wide), "run": leaf.groupBy(*whole, "part", "run").agg(*wide), "block": leaf}
    under = {"part": whole, "run": [*whole, "part"], "block": [*whole, "part", "run"]}
    other = lambda df: df.toDF(*(f"{c}_b" for c in df.columns))
    pairs = None
    for name, keys in under.items():
        a = level[name]
        b = other(a)
        if pairs is None:
            joined = a.join(b, (a["label"] == b["label_b"]) & (a["dim"] == b["dim_b"]))
        else:
            joined = pairs.join(a, keys).join(b, [f"{k}_b" for k in keys])
        ids = [*keys[2:], name]
        ordered = F.struct(*ids) <= F.struct(*(F.col(f"{c}_b").alias(c) for c in ids))
        pairs = joined.where(ordered & near_boxes(eps)).select(*whole, *(f"{c}_b" for c in whole), *ids, *(f"{c}_b" for c in ids))
    return pairs.select(F.col("block").alias("a"), F.col("block_b").alias("b"))


def compare(units_a, copies_a, nodes_a, units_b, copies_b, nodes_b, cosine: float, same: bool):
    """(kind, u, v) of two blocks: kind 0, links v of node u; kind 1, a link of the spanning forest."""
    linked = units_a @ units_b.T >= cosine
    if same:
        np.fill_diagonal(linked, False)
    counts = [(nodes_a, linked @ copies_b)]
    if not same:
        counts.append((nodes_b, linked.T @ copies_a))
    nodes = np.concatenate([nodes_a, nodes_b])
    label = np.concatenate([np.arange(len(nodes_a)), np.arange(len(nodes_a)) if same else len(nodes_a) + np.arange(len(nodes_b))])
    n, far = len(nodes_a), len(nodes)
    while True:
        old = label.copy()
        up = np.where(linked, label[None, n:], far).min(axis=1, initial=far)
        label[:n] = np.minimum(label[:n], up)
        down = np.where(linked, label[:n, None], far).min(axis=0, initial=far)
        label[n:] = np.minimum(label[n:], down)
        label = label[label]
        if (label == old).all():
            break
    out = [(0, u[c > 0], c[c > 0]) for u, c in counts]
    moved = np.flatnonzero(label != np.arange(far)) if not same else np.flatnonzero(label[:n] != np.arange(n))
    return [*out, (1, nodes[moved], nodes[label[moved]])]


def _meet(cosine: float):
    def run(batches):
        key, own = None, None
        for batch in batches:
            for row in batch.to_pylist():
                copies, nodes = tx.unpack(row["copies"], np.int64), tx.unpack(row["nodes"], np.int64)
                side = (tx.unpack(row["units"], np.float64).reshape(len(nodes), -1), copies, nodes)
                if row["role"] == 0:
                    key, own = (row["key"], row["salt"]), side
                    continue
                assert key == (row["key"], row["salt"])
                for kind, u, v in compare(*own, *side, cosine, row["key"] == row["block"]):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(u), kind, np.int32)), pa.array(u.astype(np.int64)), pa.array(v.astype(np.int64))], ["kind", "u", "v"]
                    )

    return run


def near_duplicates(vectors: DataFrame, *, vec_id="vec_id", embedding="embedding", label="label", cosine: float = 0.93, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id and kept of each vector."""
    spark = vectors.sparkSession
    n = partitions(spark)
    eps = float(np.sqrt(2 - 2 * cosine))
    v = F.col("v")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(label).alias("label"), F.col(embedding).cast("array<double>").alias("v")
    ).withColumns(
        {
            "good": F.coalesce(F.col("label").isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False)),
            "node": F.xxhash64("label", "v"),
        }
    )
    kind = dict(rows.dtypes)["label"]
    reps = cut(
        rows.where("good").groupBy("node").agg(
            F.min("vec_id").alias("least"), F.count("*").alias("copies"), F.first("label").alias("label"), F.first("v").alias("v")
        )
    )
    sample = [r[0] for r in reps.orderBy(F.xxhash64(F.lit(1), "node")).limit(SAMPLE).select("v").collect()]
    shared = spark.sparkContext.broadcast(basis(sample))
    cells = [f"c{k}" for k in range(LEADING)]
    projected = reps.select("node", "label", F.size("v").alias("dim"), "copies", "v").mapInArrow(
        _project(shared, eps),
        f"node long, label {kind}, dim int, copies long, {', '.join(f'{c} int' for c in cells)}, at binary, unit binary",
    )
    order = ["label", "dim", *cells, "node"]
    boxes = ", ".join(f"{c} double" for c in [*LO, *HI])
    blocks = cut(
        projected.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .mapInArrow(_blocks(block), f"block long, part int, run int, label {kind}, dim int, {boxes}, nodes binary, copies binary, units binary")
    )
    pairs = block_pairs(blocks, eps)
    salts = pairs.groupBy("a").agg(F.ceil(F.count("*") / PARTNERS).alias("salts"))
    dealt = cut(pairs.join(salts, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int")))
    wants = dealt.select(F.col("b").alias("block"), F.col("a").alias("key"), "salt", F.lit(1).alias("role")).union(
        dealt.select("a", "a", "salt", F.lit(0)).distinct()
    )
    found = cut(
        wants.join(blocks.select("block", "nodes", "copies", "units"), "block")
        .repartition(n, "key", "salt")
        .sortWithinPartitions("key", "salt", "role")
        .mapInArrow(_meet(cosine), "kind int, u long, v long")
    )
    links = found.where("kind = 0").groupBy(F.col("u").alias("node")).agg(F.sum("v").alias("links"))
    labels = components(found.where("kind = 1").select(F.col("u").alias("a"), F.col("v").alias("b")))
    known = reps.select("node", "least", "copies").join(labels, "node", "left").withColumn("of", F.coalesce("component", "node"))
    least = known.groupBy("of").agg(F.min("least").alias("component_id"))
    each = cut(
        known.join(least, "of")
        .join(links, "node", "left")
        .select("node", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    )
    out = rows.select("vec_id", F.when(F.col("good"), F.col("node")).alias("node")).join(each, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
