"""Near-duplicates of texts and vectors, and components, against brute force."""

import random
from pathlib import Path
from urllib.parse import urlparse

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from granary.llm import graph, near_text, near_vectors, session


class Forest:
    def __init__(self, nodes):
        self.up = {n: n for n in nodes}

    def root(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def classes(rows):
    """Component of each (id, text) by comparing all."""
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    f = Forest({i for i, _ in sets})
    for k, (a, s) in enumerate(sets):
        for b, t in sets[:k]:
            if s and t and 100 * len(s & t) >= 85 * len(s | t):
                f.join(a, b)
    return {i: f.root(i) for i, _ in sets}


def test_components_of_any_task_size(spark):
    r = random.Random(1)
    links = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(1000 + k, 1001 + k) for k in range(40)] + [(2000, 2000 + k) for k in range(50)]
    f = Forest({x for e in links for x in e})
    for a, b in links:
        f.join(a, b)
    expected = {x: f.root(x) for x in f.up if f.root(x) != x}
    df = spark.createDataFrame(links, "a long, b long").repartition(5)
    for most in (10**6, 40):
        assert {r.node: r.component for r in graph.components(df, most).collect()} == expected
    assert graph.components(df.limit(0)).count() == 0


def test_components_write_forests_only(spark):
    """Links that are in the shared folder already aren't written again, a file for each of their partitions."""
    links = session.cut(spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).repartition(40))
    files = lambda: {str(p) for p in Path(urlparse(session.shared_folder(spark)).path).rglob("part-*")}
    before = files()
    assert len(before) >= 40
    assert graph.components(links).agg(F.count("*"), F.max("component")).first() == (300, 0)
    assert 1 <= len(files() - before) <= 2


def test_near_texts_equal_brute_force(spark, corpus):
    expected = classes([(r.doc_id, r.text) for r in corpus.collect()])
    # small nodes and shallow trees as well, so that every way through the recursion is used
    for options in ({}, {"small": 3, "depth": 1}, {"small": 2, "depth": 3}):
        rows = near_text.near_duplicates(corpus, **options).collect()
        assert len(rows) == corpus.count()
        assert {r.doc_id: r.component_id for r in rows if r.doc_id is not None} == expected
        assert all(r.kept == (r.doc_id is not None and r.doc_id == r.component_id) for r in rows)
        assert all(r.n_shingles == len(shingles(t)) for r in rows for t in [dict((x.doc_id, x.text) for x in corpus.collect())[r.doc_id]])


def test_families_below_the_threshold_stay_apart(spark):
    r = random.Random(5)
    base = [f"t{k}" for k in range(200)]
    rows = []
    for k in range(90):
        words = list(base)
        for at in r.sample(range(200), (k % 3) * 6):
            words[at] = f"new{k}_{at}"
        rows.append((k, " ".join(words)))
    got = near_text.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), small=4, depth=2)
    assert {x.doc_id: x.component_id for x in got.collect()} == classes(rows)


def varied(r, base, most, k):
    words = list(base)
    for at in r.sample(range(len(base)), r.randrange(most + 1)):
        words[at] = f"new{k}_{at}"
    return " ".join(words)


def test_one_large_group_of_near_copies(spark, monkeypatch):
    """Equal to brute force, and a large group that its pivots hold together isn't branched on."""
    r = random.Random(6)
    base = [f"t{k}" for k in range(300)]
    rows = [(k, varied(r, base, 1, k)) for k in range(400)] + [(1000 + k, " ".join(f"o{k}_{x}" for x in range(50))) for k in range(20)]
    branched = []
    grow = near_text.ChosenPath.branched
    monkeypatch.setattr(near_text.ChosenPath, "branched", lambda self, members: branched.append(members.count()) or grow(self, members))
    got = near_text.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {x.doc_id: x.component_id for x in got.collect()} == classes(rows)
    assert sum(branched) < 400


def test_documents_without_an_id_link_through_their_texts(spark):
    r = random.Random(9)
    a, b, c = ([f"{n}{k}" for k in range(120)] for n in "abc")
    chain = [[f"z{k}" for k in range(120)]]
    chain.append([f"q{k}" for k in range(8)] + chain[0][8:])
    chain.append(chain[1][:-8] + [f"q{k}" for k in range(8)])
    rows = [(7, " ".join(a)), (None, varied(r, a, 1, 1)), (None, " ".join(b)), (None, varied(r, b, 1, 2)), (None, varied(r, b, 1, 2)), (None, " ".join(b).upper())]
    rows += [(20, " ".join(chain[0])), (None, " ".join(chain[1])), (21, " ".join(chain[2])), (30, " ".join(c)), (None, " ".join(c)), (None, " "), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((str(x.doc_id), x.n_shingles > 0, str(x.component_id)) for x in near_text.near_duplicates(docs).collect())
    expected = [("7", True, "7"), ("20", True, "20"), ("21", True, "20"), ("30", True, "30")]
    expected += [("None", True, x) for x in ("7", "20", "30", *["None"] * 4)] + [("None", False, "None")] * 2
    assert got == sorted(expected)
    kept = [x.text for x in near_text.one_each(docs).collect()]
    assert sum(t is None or not t.strip() for t in kept) == 2
    assert len(kept) == 4 + 2 and sum("b5 " in (t or "").lower() for t in kept) == 1


def test_one_each(spark, corpus):
    kept = near_text.one_each(corpus)
    assert kept.columns == corpus.columns
    expected = classes([(r.doc_id, r.text) for r in corpus.collect()])
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted({i for i, c in expected.items() if i == c}) and ids.count(None) == 1


def test_pipeline_links_from_0_80_on(spark):
    """The stage against brute force, with pairs and a chain between 0.80 and 0.85, one at 0.80 itself and pairs below."""
    r = random.Random(8)
    rows = []
    for k in range(24):
        words = [f"d{k}_{at}" for at in range(200)]
        rows.append((10 * k, " ".join(words)))
        for step in range(3):  # four new words far apart leave 176 of 216 shingles, five 171 of 221
            for at in range(15 * step + 4, 200, 50) if k % 2 else range(15 * step + 4, 200, 40):
                words[at] = f"new{r.random()}"
            rows.append((10 * k + 1 + step, " ".join(words)))
    short = [f"s{at}" for at in range(13)]
    rows += [(1000, " ".join(short)), (1001, " ".join([*short[:-1], "other"]))]
    sets = {i: shingles(t) for i, t in rows}
    f = Forest(sets)
    between = 0
    for a, s in sets.items():
        for b, t in sets.items():
            if a < b and 100 * len(s & t) >= 80 * len(s | t):
                f.join(a, b)
                between += 100 * len(s & t) < 85 * len(s | t)
    expected = sorted({f.root(i) for i in sets})
    assert between == 12 * 3 + 1 and len(expected) == 12 + 12 * 4 + 1
    kept = corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    assert sorted(x.doc_id for x in kept.collect()) == expected


def test_empty_tables(spark, corpus):
    assert near_text.near_duplicates(corpus.limit(0)).count() == 0
    v = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert near_vectors.near_duplicates(v).count() == 0


def test_near_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(30, 16))
    x = np.concatenate([x, x[:20] + rng.normal(size=(20, 16)) * 0.15, np.repeat(x[:1], 60, axis=0), x[:6] * 3, x[:10] + 0.25])
    rows = [(k, [float(v) for v in row], [1, 2][k % 2]) for k, row in enumerate(x)]
    rows += [(900, None, 1), (901, [0.0] * 16, 1), (902, [float("nan")] * 16, 1), (903, [None] * 16, 2), (904, rows[0][1], None), (905, [1.0, 2.0], 1), (906, [], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("node", F.lit(1))
    usable = {k: (np.float32(v).astype(float), lab) for k, v, lab in rows if lab and v and k not in (901, 902, 903)}
    f, links = Forest([r[0] for r in rows]), {r[0]: 0 for r in rows}
    for a, (u, la) in usable.items():
        for b, (v, lb) in usable.items():
            if a < b and la == lb and len(u) == len(v) and u @ v / np.linalg.norm(u) / np.linalg.norm(v) >= 0.93:
                f.join(a, b)
                links[a] += 1
                links[b] += 1
    for block in (512, 7):
        got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_vectors.near_duplicates(df, block=block).collect()}
        assert got == {k: (links[k], f.root(k), f.root(k) == k) for k in links}
    assert sum(links.values()) > 1000


def test_repeated_vector_ids(spark):
    """Each row is a vector: equal ones link, others of one id don't."""
    v = [1.0, 0.0, 0.0]
    rows = [(1, v, 1), (1, v, 1), (2, v, 1), (3, [0.0, 1.0, 0.0], 1), (3, [0.0, 0.0, 1.0], 1), (None, v, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumns({"copies": F.lit("x"), "block": F.lit(1)})
    got = sorted((str(r.vec_id), r.n_links, r.component_id, r.kept) for r in near_vectors.near_duplicates(df).collect())
    assert got == sorted([("1", 3, 1, True)] * 2 + [("2", 3, 1, False), ("None", 3, 1, False)] + [("3", 0, 3, True)] * 2)
