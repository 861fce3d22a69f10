"""MinHash near-duplicates by a chosen-path set similarity join.

Documents are sets of word shingles with a MinHash signature; equal sets
collapse to one representative. Independent trees then branch the
representatives: a node picks one signature coordinate, and a second one at
times so that a pair at the threshold shares one child on average, and deals
documents to children by their value there, until nodes have few members.

Work stays linear in a node's size because components, not pairs, are asked
for. Before any node branches on, members are compared with their node's pivot,
each with its most alike one, then the most alike pair of every two components
found so. At every level nodes that hold one component only are done. Of the
others, those of few members are compared exhaustively across components, and
large ones branch on for as long as that separates their members and comparing
all would be more work than small nodes are. Children that keep over ``SHRINK``
of a large node's members are as alike as links nearly are; they form families
where they share members, and those outside a family's largest component are
compared with all of it in blocks, so no link is lost to a cap.

Candidates that agree in too few coordinates go (at 64 coordinates and a
similarity of 0.85, fewer than 40 have odds of 2e-6 a pair; at 0.80, fewer than
37 have odds of 1.4e-5); the rest are confirmed on the full shingle sets.

Defined cases: null or blank texts have an empty set and link with nothing;
texts of fewer words than a shingle are one shingle; rows that repeat are in one
component; a null id takes part through its text, but is never a component's
id (a component of null ids only has none, and ``one_each`` keeps one of its
rows); an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from granary.llm import text as tx
from granary.llm.graph import components
from granary.llm.session import cut, partitions, release, sized

COORDINATES = 64
_SET_BITS = np.uint64(50)
_rng = np.random.default_rng(7)
_ODD = _rng.integers(1, 2**63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Wanted texts up to this many rows (8 to 40 bytes each) are sent to every executor; more are joined by a shuffle.
BROADCAST_ROWS = 500_000
#: Orders by which nodes choose their pivots.
ORDERS = 8
#: Share of a large node's members above which a child isn't branched on.
SHRINK = 0.6
#: Documents of a family that one task holds, and about how many it compares with them.
ODD_BLOCK, ALL_BLOCK = 512, 2048
#: Comparisons with one pivot that one task makes before a salt deals out the rest.
PIVOT_ROWS = 128
#: Packed sets that a task hands on at once.
SENT_BYTES = 4 << 20


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int):
    """Distinct shingles of each text: values grouped by text in ascending order, and the n + 1 bounds.

    At most 2**14 texts at once. Values have 50 bits.
    """
    n = len(offsets) - 1
    runs, of = tx.windows(tx.words(data, offsets), width)
    key = (of.astype(np.uint64) << _SET_BITS) | (runs >> np.uint64(64 - int(_SET_BITS)))
    key.sort()
    if len(key):
        key = key[np.concatenate([[True], key[1:] != key[:-1]])]
    bounds = np.searchsorted(key, np.arange(n + 1, dtype=np.uint64) << _SET_BITS)
    return key & np.uint64((1 << int(_SET_BITS)) - 1), bounds


def _slices(offsets: np.ndarray):
    for i, j in tx.slices(offsets):
        for k in range(i, j, 1 << 14):
            yield k, min(j, k + (1 << 14))


def signatures(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each set that isn't empty: minima of all hash functions, and a 128-bit hash of the set."""
    some = np.flatnonzero(np.diff(bounds))
    at = bounds[:-1][some]
    out = np.zeros((len(some), COORDINATES), np.uint32)
    ids = np.zeros((len(some), 2), np.uint64)
    if len(some):
        with np.errstate(over="ignore"):
            for k in range(COORDINATES):
                out[:, k] = np.minimum.reduceat(((values + np.uint64(k)) * _ODD[k]) >> np.uint64(32), at)
            ids[:, 0] = np.add.reduceat(tx.mix(values), at)
            ids[:, 1] = np.add.reduceat(tx.mix(values ^ np.uint64(0x5851F42D4C957F2D)), at)
    return out, ids


def _sign(width: int):
    def run(batches):
        for batch in batches:
            data, offsets = tx.buffers(batch.column("text"))
            for i, j in _slices(offsets):
                values, bounds = shingle_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], width)
                sizes = np.diff(bounds)
                some = sizes > 0
                sig, ids = signatures(values, bounds)
                full = np.zeros((j - i, 2), np.uint64)
                full[some] = ids
                rows = np.full(j - i, None, object)
                rows[some] = [r.tobytes() for r in sig]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id")[i:j],
                        batch.column("tag")[i:j],
                        pa.array(sizes, pa.int64()),
                        pa.array(full[:, 0].view(np.int64)),
                        pa.array(full[:, 1].view(np.int64)),
                        pa.array(rows, pa.binary()),
                    ],
                    ["doc_id", "tag", "n_shingles", "lo", "hi", "sig"],
                )

    return run


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, COORDINATES)


def _branch(node: np.ndarray, sig: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Children of each row's node, and the row of each child."""
    rows = np.arange(len(node))
    out, of = [], []
    with np.errstate(over="ignore"):
        twice = (tx.mix(node ^ np.uint64(0xA5A5A5A5)) >> np.uint64(11)).astype(float) / 2.0**53 < 1 / similarity - 1
        for k, take in ((1, rows), (2, rows[twice])):
            pick = tx.mix(node[take] + np.uint64(k))
            at = (pick % np.uint64(COORDINATES)).astype(np.int64)
            out.append(tx.mix(pick ^ (sig[take, at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))))
            of.append(take)
    return np.concatenate(out), np.concatenate(of)


def _plant(trees: int, similarity: float):
    def run(batches):
        for batch in batches:
            sig, rep = _matrix(batch.column("sig")), batch.column("rep").to_numpy()
            for tree in range(trees):
                node, of = _branch(np.full(len(rep), tree << 8, np.uint64), sig, similarity)
                yield pa.RecordBatch.from_arrays([pa.array(node.view(np.int64)), pa.array(rep[of]), pa.array(np.zeros(len(of), np.int64))], ["node", "rep", "parent"])

    return run


def _grow(similarity: float):
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                rep = batch.column("rep").to_numpy()
                node, of = _branch(batch.column("node").to_numpy().view(np.uint64), _matrix(batch.column("sig")), similarity)
                parent = batch.column("members").take(pa.array(of))
                yield pa.RecordBatch.from_arrays([pa.array(node.view(np.int64)), pa.array(rep[of]), parent], ["node", "rep", "parent"])

    return run


def _agree(batches):
    for batch in batches:
        if batch.num_rows:
            same = (_matrix(batch.column("sig")) == _matrix(batch.column("sig_b"))).sum(1)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("a", "b")), pa.array(same.astype(np.int32))], ["a", "b", "agree"]
            )


def _sets(width: int):
    """One row for each place (an element of ``at``) where a document's set is wanted; the set is taken once."""
    columns = ["rep", "key", "salt", "role", "of", "shingles"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        parts = zip(*rows, strict=True) if rows else [()] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(parts, kinds, strict=True)], columns)

    def run(batches):
        for batch in batches:
            data, offsets = tx.buffers(batch.column("text"))
            lo, rep, at = batch.column("lo").to_numpy(), batch.column("rep").to_pylist(), batch.column("at")
            rows, held = [], 0
            for i, j in _slices(offsets):
                values, bounds = shingle_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], width)
                _, ids = signatures_of_sets(values, bounds)
                for k in np.flatnonzero(ids.view(np.int64) == lo[i:j]).tolist():
                    step = np.diff(values[bounds[k] : bounds[k + 1]], prepend=np.uint64(0))
                    packed = tx.pack(step.view(np.uint8).reshape(-1, 8).T)
                    for place in at[i + k].as_py():
                        rows.append((rep[i + k], place["key"], place["salt"], place["role"], place["of"], packed))
                        held += len(packed)
                        if held > SENT_BYTES:
                            yield batch_of(rows)
                            rows, held = [], 0
            yield batch_of(rows)

    return run


def signatures_of_sets(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sizes and the first half of the set hashes (0 for an empty set)."""
    sizes = np.diff(bounds)
    ids = np.zeros(len(sizes), np.uint64)
    if len(values):
        some = sizes > 0
        with np.errstate(over="ignore"):
            ids[some] = np.add.reduceat(tx.mix(values), bounds[:-1][some])
    return sizes, ids


def _values(raw: bytes) -> np.ndarray:
    planes = tx.unpack(raw, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def _family(percent: int):
    """Links between the sets of role 0 and those of role 1 of another component; one for each pair of set and component."""

    def run(batches):
        key, held, postings = None, [], None
        for batch in batches:
            a, b = [], []
            columns = (batch.column(c).to_pylist() for c in ("key", "salt", "role", "rep", "of", "shingles"))
            for k, salt, role, rep, of, raw in zip(*columns, strict=True):
                if key != (k, salt):
                    key, held, postings, seen = (k, salt), [], None, set()
                values = _values(raw)
                if role == 0:
                    held.append((rep, of, values))
                    continue
                if not held:
                    continue
                if postings is None:
                    every = np.concatenate([v for _, _, v in held])
                    order = np.argsort(every, kind="stable")
                    size = np.array([len(v) for _, _, v in held])
                    postings = (every[order], np.repeat(np.arange(len(held)), size)[order], size, np.array([o for _, o, _ in held]))
                every, owner, size, labels = postings
                lo, hi = np.searchsorted(every, values, "left"), np.searchsorted(every, values, "right")
                n = hi - lo
                at = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
                both = np.bincount(owner[at], minlength=len(held))
                for i in np.flatnonzero((100 * both >= percent * (size + len(values) - both)) & (labels != of)).tolist():
                    if (i, of) not in seen:
                        seen.add((i, of))
                        a.append(held[i][0])
                        b.append(rep)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def _confirm(percent: int):
    def run(batches):
        key, pivot = None, None
        for batch in batches:
            a, b = [], []
            columns = (batch.column(c).to_pylist() for c in ("key", "salt", "role", "rep", "shingles"))
            for k, salt, role, rep, raw in zip(*columns, strict=True):
                values = _values(raw)
                if role == 0:
                    key, pivot = (k, salt), values
                elif key == (k, salt):
                    at = np.minimum(np.searchsorted(pivot, values), len(pivot) - 1)
                    both = int((pivot[at] == values).sum())
                    if 100 * both >= percent * (len(pivot) + len(values) - both):
                        a.append(k)
                        b.append(rep)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


class ChosenPath:
    """One run of the join; ``documents()`` gives one row a document."""

    def __init__(self, docs: DataFrame, *, doc_id="doc_id", text="text", width=5, percent=85, trees=16, small=32, depth=64):
        self.docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("tag"))
        self.width, self.percent, self.trees, self.small = width, percent, trees, small
        self.depth = depth
        self.similarity = percent / 100
        self.least_agreement = int((self.similarity - 0.21) * COORDINATES)
        self.n = partitions(docs.sparkSession)

    def documents(self) -> DataFrame:
        """doc_id, tag (hash of the text), n_shingles, label (a number of the component), component_id, kept."""
        signed = cut(self.docs.mapInArrow(tx.lean(_sign(self.width)), "doc_id long, tag long, n_shingles long, lo long, hi long, sig binary"))
        # what repeats of a set carry is equal, so any one signature serves; a set without an id is known by its hash
        self.sets = cut(
            signed.where("n_shingles > 0")
            .groupBy("lo", "hi")
            .agg(F.min("doc_id").alias("id"), F.min("tag").alias("tag"), F.first("n_shingles").alias("size"), F.first("sig").alias("sig"))
            .withColumn("rep", F.coalesce("id", "lo"))
        )
        self.reps = self.sets.select("rep", "size", "lo", "sig")
        self.n_sets = self.sets.count()
        self.nameless = self.sets.where("id is null").select("rep", "tag")
        self.named = self.nameless.isEmpty()
        labels = self.labels()
        classes = self.sets.select("lo", "hi", "rep").join(labels.withColumnRenamed("node", "rep"), "rep", "left")
        classes = classes.select("lo", "hi", F.coalesce("component", "rep").alias("label")).withColumn("component_id", F.col("label"))
        if not self.named:
            classes = classes.drop("component_id").join(self.least_ids(labels), "label", "left")
            classes = classes.select("lo", "hi", "label", F.when(F.col("renamed"), F.col("least")).otherwise(F.col("label")).alias("component_id"))
        component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
        return (
            signed.select("doc_id", "tag", "n_shingles", "lo", "hi")
            .join(classes, ["lo", "hi"], "left")
            .select("doc_id", "tag", "n_shingles", "label", component.alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
        )

    def least_ids(self, labels: DataFrame) -> DataFrame:
        """label, least (id or null), renamed (true) of components whose label is the hash of a set without an id."""
        every = labels.toDF("rep", "label").union(self.nameless.select("rep", F.col("rep").alias("label")))
        own = every.join(sized(self.nameless.select(F.col("rep").alias("label"))), "label", "left_semi").distinct()
        ids = own.join(self.sets.where("id is not null").select("rep", "id"), "rep", "left")
        return sized(cut(ids.groupBy("label").agg(F.min("id").alias("least")).withColumn("renamed", F.lit(True))))

    def labels(self) -> DataFrame:
        """node, component of the sets that are linked with one of a smaller number."""
        rows = self.reps.select("rep", "sig").mapInArrow(tx.lean(_plant(self.trees, self.similarity)), "node long, rep long, parent long")
        none = self.docs.sparkSession.createDataFrame([], "a long, b long")
        self.tried = none
        members = self.level(rows)
        stars = self.alike(members.where("rep <> pivot").select("pivot", "rep"))
        labels = self.pivoted(stars, components(none))
        few = left = None
        joined = lambda a, b: b if a is None else a.union(b)
        for depth in range(1, self.depth + 1):
            mixed = cut(self.mixed(members, labels))
            few = joined(few, mixed.where(F.col("members") <= self.small))
            large = mixed.where(F.col("members") > self.small)
            stuck = (F.col("members") > SHRINK * F.col("parent")) & (F.col("parent") > 0) if depth < self.depth else F.lit(True)
            left = joined(left, large.where(stuck))
            large = large.where(~stuck)
            if (large.where("odd").agg(F.sum("members")).first()[0] or 0) <= self.small * self.n_sets:
                left = left.union(large)
                break
            members = self.level(self.branched(large))
        across = self.alike(self.across(self.mixed(few, labels)))
        labels = self.linked(self.apart(stars.union(across), labels).distinct(), labels)
        return self.family_links(left, labels)

    def linked(self, pairs: DataFrame, labels: DataFrame) -> DataFrame:
        """Labels after the pairs (a, b) that haven't been tried before are confirmed."""
        new = cut(pairs.select("a", "b").join(self.tried, ["a", "b"], "left_anti"))
        if new.isEmpty():
            return labels
        self.tried = self.tried.union(new)
        return components(self.joined(labels, self.confirmed(new)))

    @staticmethod
    def joined(labels: DataFrame, links: DataFrame) -> DataFrame:
        """Links (a, b) that connect what the labels and new links do: earlier links count by their labels, one for each set."""
        return labels.toDF("a", "b").union(cut(links))

    def pivoted(self, near: DataFrame, labels: DataFrame) -> DataFrame:
        """Labels after each member's most alike pivot, then the most alike pair of every two components."""
        score = F.struct("agree", "a", "b")
        first = self.apart(near, labels).groupBy("b").agg(F.max_by("a", score).alias("a"))
        labels = self.linked(first, labels)
        best = self.apart(near, labels).groupBy("x", "y").agg(F.max_by(F.struct("a", "b"), score).alias("p"))
        return self.linked(best.select("p.a", "p.b"), labels)

    def level(self, rows: DataFrame) -> DataFrame:
        """rows (node, rep, parent) with the members and the pivot of their nodes, without lone ones.

        Pivots are chosen by one of ``ORDERS`` orders of all documents, so nodes of alike members share few, whatever
        their tree, of which one that stands at the group's edge does no harm.
        """
        rows = cut(rows)
        sizes = rows.groupBy("node").agg(F.count("*").alias("members"), F.min_by("rep", F.xxhash64("rep", F.pmod("node", F.lit(ORDERS)))).alias("pivot"))
        return cut(rows.join(sizes.where("members > 1"), "node"))

    def branched(self, members: DataFrame) -> DataFrame:
        signed = members.select("node", "rep", "members").join(self.reps.select("rep", "sig"), "rep").select("node", "rep", "members", "sig")
        return signed.mapInArrow(tx.lean(_grow(self.similarity)), "node long, rep long, parent long")

    def mixed(self, members: DataFrame, labels: DataFrame) -> DataFrame:
        """node, rep, members, parent, of (component), odd (not of the node's largest one): members of nodes of several components."""
        of = members.select("node", "rep", "members", "parent").join(labels.toDF("rep", "of"), "rep", "left").withColumn("of", F.coalesce("of", "rep"))
        parts = of.groupBy("node", "of").count().groupBy("node").agg(F.count("*").alias("parts"), F.max_by("of", F.struct("count", "of")).alias("main"))
        joined = of.join(parts.where("parts > 1"), "node")
        return joined.select("node", "rep", "members", "parent", "of", (F.col("of") != F.col("main")).alias("odd"))

    def across(self, mixed: DataFrame) -> DataFrame:
        """Pairs of members of different components, in nodes of few members."""
        mixed = mixed.select("node", "rep", "of")
        other = mixed.toDF("node", "b", "of_b")
        return mixed.join(other, "node").where("of <> of_b and rep < b").select(F.col("rep").alias("a"), "b")

    def families(self, mixed: DataFrame) -> DataFrame:
        """main, rep, of: members of nodes that share components or members, each once, with the family's largest component.

        A node's members always stay together; how many nodes join one family only decides how often a pair is met.
        """
        of_node = mixed.groupBy("node").agg(F.min("of").alias("family"))
        # a document is in few nodes, some for each tree
        shared = mixed.join(of_node, "node").withColumn("family", F.min("family").over(Window.partitionBy("rep")))
        of_node = shared.groupBy("node").agg(F.min("family").alias("family"))
        each = cut(mixed.join(of_node, "node").groupBy("family", "rep").agg(F.first("of").alias("of")))
        parts = each.groupBy("family", "of").count()
        main = parts.groupBy("family").agg(F.max_by("of", F.struct("count", "of")).alias("main"))
        return each.join(main, "family").select(F.col("family"), "main", "rep", "of")

    def family_links(self, large: DataFrame, labels: DataFrame) -> DataFrame:
        """Labels after links that cross components in large nodes that branching doesn't separate.

        Documents outside a family's largest component meet all of the family, in blocks, on the full sets; what
        leaves a task are links.
        """
        mixed = cut(self.mixed(large, labels))
        if mixed.isEmpty():
            return labels
        release(mixed.sparkSession)
        family = self.families(mixed)
        odd = F.col("of") != F.col("main")
        sizes = family.groupBy("family").agg(
            F.ceil(F.count_if(odd) / ODD_BLOCK).cast("int").alias("across"), F.ceil(F.count("*") / ALL_BLOCK).cast("int").alias("down")
        )
        placed = cut(family.join(sizes, "family"))
        block = lambda n, seed: F.pmod(F.xxhash64("rep", F.lit(seed)), F.col(n)).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        left = placed.where(odd).select("family", "rep", "of", block("across", 0).alias("i"), every("down").alias("salt"), F.lit(0).alias("role"))
        right = placed.select("family", "rep", "of", every("across").alias("i"), block("down", 1).alias("salt"), F.lit(1).alias("role"))
        wants = left.union(right).select("rep", F.xxhash64("family", "i").alias("key"), "salt", "role", "of")
        return components(self.joined(labels, self.met(wants).mapInArrow(tx.lean(_family(self.percent)), "a long, b long")))

    def alike(self, pairs: DataFrame) -> DataFrame:
        """a, b, agree of the pairs whose sizes and signatures allow a link."""
        side = self.reps.select("rep", "size", "sig")
        near = (
            pairs.toDF("a", "b").where("a <> b").distinct()
            .join(side.toDF("a", "size", "sig"), "a")
            .join(side.toDF("b", "size_b", "sig_b"), "b")
            .where(100 * F.least("size", "size_b") >= self.percent * F.greatest("size", "size_b"))
            .select("a", "b", "sig", "sig_b")
            .mapInArrow(tx.lean(_agree), "a long, b long, agree int")
        )
        return cut(near.where(F.col("agree") >= self.least_agreement))

    def apart(self, pairs: DataFrame, labels: DataFrame) -> DataFrame:
        """Pairs (a, b, agree) of different components, with these (x < y)."""
        of = lambda c: labels.toDF(c, f"of_{c}")
        joined = pairs.join(of("a"), "a", "left").join(of("b"), "b", "left")
        x, y = F.coalesce("of_a", "a"), F.coalesce("of_b", "b")
        return joined.where(x != y).select("a", "b", "agree", F.least(x, y).alias("x"), F.greatest(x, y).alias("y"))

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """The pairs that are links on the full sets. Each set travels once for each pivot (a) it is compared with."""
        pairs = pairs.select("a", "b")
        counts = pairs.groupBy("a").agg(F.ceil(F.count("*") / PIVOT_ROWS).alias("salts"))
        dealt = pairs.join(counts, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int"))
        none = F.lit(0).cast("long")
        wants = dealt.select(F.col("b").alias("rep"), F.col("a").alias("key"), "salt", F.lit(1).alias("role"), none.alias("of")).union(
            dealt.select("a", "a", "salt", F.lit(0), none).distinct()
        )
        return self.met(wants).mapInArrow(tx.lean(_confirm(self.percent)), "a long, b long")

    def met(self, wants: DataFrame) -> DataFrame:
        """The shingle sets of documents (rep) where they are wanted: by key and salt, role 0 before role 1.

        A document's places are gathered first (one for each of its pivots and blocks), so its text is joined and
        its set is taken once.
        """
        places = wants.groupBy("rep").agg(F.collect_list(F.struct("key", "salt", "role", "of")).alias("at"))
        places = cut(places.join(self.reps.select("rep", "lo"), "rep"))
        few = (places.agg(F.sum(F.size("at"))).first()[0] or 0) <= BROADCAST_ROWS
        wanted = F.broadcast(places) if few else places
        texts = self.docs.where("doc_id is not null").select(F.col("doc_id").alias("rep"), "text").join(wanted, "rep")
        if not self.named:
            # each task brings one text at most for a set, however many rows without an id share it
            same = self.nameless.join(wanted, "rep")
            without = self.docs.where("doc_id is null").select("tag", "text").join(F.broadcast(same) if few else same, "tag")
            texts = texts.unionByName(without.select("rep", "text", "at", "lo").dropDuplicates(["rep"]))
        sets = texts.select("rep", "at", "lo", "text").mapInArrow(
            tx.lean(_sets(self.width)), "rep long, key long, salt int, role int, of long, shingles binary"
        )
        return sets.repartition(self.n, "key", "salt").sortWithinPartitions("key", "salt", "role")


def near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of each document; options are those of ``ChosenPath``."""
    return ChosenPath(docs, **options).documents().drop("tag", "label")


def one_each(docs: DataFrame, *, doc_id="doc_id", text="text", **options) -> DataFrame:
    """The rows of ``docs`` with one document of each component: that of the least id; of repeated rows, one."""
    found = cut(ChosenPath(docs, doc_id=doc_id, text=text, **options).documents())
    same = lambda keys: (F.col(doc_id).cast("long").eqNullSafe(keys["id_"])) & (F.xxhash64(text) == keys["tag_"])
    keys = lambda rows: cut(rows.select(F.col("doc_id").alias("id_"), F.col("tag").alias("tag_")).distinct())
    nobody = found.where(F.col("component_id").isNull() & (F.col("n_shingles") > 0))
    first = sized(cut(nobody.groupBy(F.col("label").alias("label_")).agg(F.min("tag").alias("first_"))))
    found = found.join(first, F.col("label") == F.col("label_"), "left")
    alone = F.col("component_id").isNull() & ((F.col("n_shingles") == 0) | (F.col("tag") == F.col("first_")))
    stays = F.col("kept") | alone
    gone = sized(keys(found.where(~stays)))
    again = sized(keys(found.where(stays & (F.col("n_shingles") > 0)).groupBy("doc_id", "tag").count().where("count > 1")))
    left = docs.join(gone, same(gone), "left_anti")
    single = left.join(again, same(again), "left_anti")
    # rows that occur more than once under one id and text: usually none
    return single.union(left.join(again, same(again), "left_semi").dropDuplicates([doc_id, text]))
