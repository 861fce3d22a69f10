"""Ranked search, resampling and repeated passages against brute force, on small, awkward tables."""

import collections
import hashlib
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from granary.llm import lexical, repeats, resample
from granary.llm import text as tx


def lower(x):
    return re.sub("[A-Z]", lambda m: m[0].lower(), x or "")


def alnum(x):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(x))


def blank(x):
    return re.findall(r"[^\x20\x09-\x0D]+", x or "")


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]


def text_key(r, *names):
    return tuple("~" if r[n] is None else r[n] if isinstance(r[n], int) else str(r[n]) for n in names)


# --- ranked search


def ranked(docs, items, k):
    """(item, rank, doc, score) by the definition."""
    terms = [(i, collections.Counter(alnum(t))) for i, t in docs]
    n = sum(bool(c) for _, c in terms)
    total = sum(sum(c.values()) for _, c in terms)
    held = collections.Counter(x for _, c in terms for x in c)
    out = []
    for item, text in dict.fromkeys(items):
        asked, scored = alnum(text), []
        for i, c in terms:
            m = 25 + (75 * sum(c.values()) * n) // total if total else 0
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * held[x] + 1))) * (10**9 * c[x] // (1000 * c[x] + 8 * m)) for x in asked if x in c)
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scored)[:k])]
    return out


@pytest.mark.parametrize(("part_terms", "block_bytes", "k"), [(500_000, 4 << 20, 10), (7, 300, 3)])
def test_search_equals_brute_force(spark, corpus, part_terms, block_bytes, k):
    docs = [(r.doc_id, r.text) for r in corpus.collect()]
    r = random.Random(5)
    words = [f"W{x}" for x in range(400)]
    items = [(x, " ".join(r.choices(words, k=r.randint(1, 12)))) for x in range(25)]
    items += [(90, None), (91, ""), (92, "nowhere at all"), (93, docs[0][1]), (None, "w1 w1, w2"), (94, "w3"), (94, "w4 w3"), (94, "w3"), (95, "a b É c")]
    asked = spark.createDataFrame([(i, t, -7) for i, t in items], "item_id long, text string, score int")
    got = rows(lexical.search(lexical.build_index(corpus, block_bytes=block_bytes), asked, k=k, part_terms=part_terms))
    assert sorted(map(str, (tuple(x.values()) for x in got))) == sorted(map(str, ranked(docs, items, k)))


def test_equal_scores_and_hot_terms(spark):
    """A third of all documents are one text and most hold one term: ranks go by id, over blocks and partitions."""
    docs = [(k, "common words here") for k in range(300, 0, -1)] + [(1000 + k, f"common x{k}") for k in range(500)] + [(None, "common words here")]
    index = lexical.build_index(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), block_bytes=200)
    got = rows(lexical.search(index, spark.createDataFrame([("q", "words words"), ("c", "common")], "item_id string, text string"), k=20))
    assert [r["doc_id"] for r in sorted((x for x in got if x["item_id"] == "q"), key=lambda r: r["rank"])] == list(range(1, 21))
    assert sorted((x["item_id"], x["rank"], x["doc_id"], x["score"]) for x in got) == sorted(ranked(docs, [("q", "words words"), ("c", "common")], 20))


def test_search_of_empty_tables(spark, corpus):
    nothing, items = corpus.limit(0), spark.createDataFrame([(1, "w1")], "item_id long, text string")
    assert lexical.search(lexical.build_index(nothing), items).collect() == []
    got = lexical.search(lexical.build_index(corpus), items.limit(0))
    assert got.collect() == [] and got.columns == ["item_id", "rank", "doc_id", "score"]
    assert lexical.search(lexical.build_index(spark.createDataFrame([(1, None), (2, " ")], "doc_id long, text string")), items).collect() == []


@settings(deadline=None, max_examples=60)
@given(st.lists(st.dictionaries(st.integers(0, 8), st.integers(1, 3), max_size=5), max_size=6), st.lists(st.dictionaries(st.integers(0, 8), st.integers(1, 3), min_size=1, max_size=5), min_size=1, max_size=5), st.integers(1, 9))
def test_product_equals_a_dense_one(items, docs, cells):
    """However few cells the accumulator has."""
    q = lexical.Queries.of([{"item_id": k, "key": k, "terms": tx.planes(np.array(sorted(i), np.uint64)), "times": tx.planes(np.array([i[x] for x in sorted(i)], np.int64))} for k, i in enumerate(items)])
    q.weight = (q.terms.astype(np.int64) + 1) * 10**9
    terms = np.array(sorted({x for d in docs for x in d}), np.uint64)
    post = [(d, docs[d][int(x)]) for x in terms for d in range(len(docs)) if int(x) in docs[d]]
    holders = np.array([sum(int(x) in d for d in docs) for x in terms], np.uint32)
    length = np.arange(1, len(docs) + 1)
    got = np.zeros((len(items), len(docs)), np.int64)
    for lo, part in lexical.product(q, terms, holders, np.array([d for d, _ in post]), np.array([n for _, n in post], np.int64), length, cells):
        got[lo : lo + len(part)] = part
    want = [[sum(n * ((x + 1) * 10**9 * (10**9 * d[x] // (1000 * d[x] + 8 * (j + 1)))) for x, n in i.items() if x in d) for j, d in enumerate(docs)] for i in items]
    assert [[x % 2**64 for x in r] for r in want] == [[int(x) % 2**64 for x in r] for r in got]


# --- resampling


def drawn(docs, target, buckets, least, percent, ngrams):
    """{row: (features, weight, score)} and the ranks in order, by the definition."""

    def features(t):
        w = alnum(t)
        return [" ".join(w[i : i + n]) for n in range(ngrams[0], ngrams[1] + 1) for i in range(len(w) - n + 1)]

    code = lambda f: zlib.crc32(f.encode()) % buckets
    s = collections.Counter(code(f) for _, t in docs for f in features(t))
    goal = collections.Counter(code(f) for t in target for f in features(t))
    S, T = sum(s.values()), sum(goal.values())
    gain = lambda b: math.floor(1000 * math.log((goal[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets))))
    out = []
    for i, t in docs:
        f = features(t)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain(code(x)) for x in f)
        out.append((i, len(alnum(t)), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((x for x in out if x[1] >= least), key=lambda x: (-x[4], x[0] is None, x[0] or 0))
    n = len(able) * percent // 100
    return sorted([*((*x, k + 1) for k, x in enumerate(able[:n])), *((*x, None) for x in able[n:]), *((*x, None) for x in out if x[1] < least)], key=str)


@pytest.mark.parametrize(("ngrams", "buckets", "percent"), [((1, 1), 10_000, 10), ((1, 3), 64, 50), ((2, 2), 1000, 100)])
def test_resample_equals_brute_force(spark, corpus, ngrams, buckets, percent):
    docs = [(r.doc_id, r.text) for r in corpus.collect()]
    target = ["w1 w2 W3 w4", None, "", "w1 w2 é x" * 5]
    aim = spark.createDataFrame([(t, 5) for t in target], "text string, n_words int")
    got = rows(resample.resample(corpus.withColumnRenamed("size", "weight"), aim, ngrams=ngrams, buckets=buckets, percent=percent))
    assert sorted(map(str, (tuple(r.values()) for r in got))) == sorted(map(str, drawn(docs, target, buckets, 20, percent, ngrams)))


def test_resample_of_empty_tables_and_stored_counts(spark, corpus):
    aim = spark.createDataFrame([("w1",)], "text string")
    assert resample.resample(corpus.limit(0), aim).count() == 0
    got = resample.resample(corpus, aim.limit(0))
    assert got.count() == corpus.count()
    counted = resample.count_features(corpus)
    assert counted.inputFiles() and all(spark.conf.get("spark.checkpoint.dir") in f for f in counted.inputFiles())
    assert counted.where("doc_id = 5").distinct().count() == 1


@given(st.lists(st.text(alphabet="abé", min_size=1, max_size=3), max_size=8), st.integers(1, 3), st.integers(0, 2))
@settings(deadline=None, max_examples=40)
def test_ngrams_are_runs_of_words(words, shortest, more):
    con = duckdb.connect()
    con.execute("create table worded (doc int, words varchar[])")
    con.execute("insert into worded values (1, $w), (2, ['z', 'y']), (3, [])", {"w": words})
    got = con.execute(resample.feature_sql(shortest, shortest + more)).fetchall()
    runs = lambda w: [" ".join(w[i : i + n]) for n in range(shortest, shortest + more + 1) for i in range(len(w) - n + 1)]
    assert sorted(got) == sorted([(1, f) for f in runs(words)] + [(2, f) for f in runs(["z", "y"])])


# --- repeated passages


def cut_by_hand(docs, width):
    """(id, words, removed, spans, kept) of each row."""
    first = {}
    runs = lambda t: [tuple(w[i : i + width]) for w in [blank(t)] for i in range(len(w) - width + 1)]
    for i, t in docs:
        for run in runs(t) if i is not None else ():
            first[run] = min(first.get(run, i), i)
    out = []
    for i, t in docs:
        w = blank(t)
        gone = {x for k, run in enumerate(runs(t)) if i is not None and first[run] < i for x in range(k, k + width)}
        spans = []
        for x in sorted(gone):
            if spans and spans[-1][1] == x:
                spans[-1][1] = x + 1
            else:
                spans.append([x, x + 1])
        out.append((i, len(w), len(gone), [{"start": a, "end": b} for a, b in spans], " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(map(str, out))


@pytest.mark.parametrize(("width", "options"), [(13, {}), (4, {"block_bytes": 500, "bucket_bytes": 64, "task_bytes": 2000, "sent_hashes": 300}), (1, {"block_bytes": 1})])
def test_removed_equals_brute_force(spark, corpus, width, options):
    docs = [(r.doc_id, r.text) for r in corpus.collect()]
    got = rows(repeats.removed(corpus.withColumnRenamed("size", "kept"), width=width, **options))
    assert sorted(str(tuple(r.values())) for r in got) == cut_by_hand(docs, width)


def test_passages_of_a_third_of_all_documents(spark):
    """A passage in the middle, at the start, twice, back to back with another, across case and blanks of all kinds."""
    r = random.Random(9)
    word = lambda: f"x{r.randint(0, 10**9)}"
    own = lambda n: [word() for _ in range(n)]
    a, b = own(60), own(20)
    docs = [(k, " \t".join(own(r.randint(0, 30)) + a + own(r.randint(0, 30)))) for k in range(200, 0, -1)]
    docs += [(300 + k, "\n".join(own(20))) for k in range(300)]
    docs += [(900, " ".join(a + b)), (901, " ".join(b + a + own(3) + a)), (902, " ".join(a).upper()), (903, " ".join(a[:12])), (904, " ".join(a[20:33])), (0, " ".join(b))]
    docs += [(905, " ".join(own(13) * 2)), (None, " ".join(a)), (906, "é" + "\x0b".join(a)), (7, docs[5][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for d, o in ((df.repartition(6), {"block_bytes": 3000}), (df.coalesce(1), {})):
        got = rows(repeats.removed(d, **o))
        assert sorted(str(tuple(x.values())) for x in got) == cut_by_hand(docs, 13)
    of = {x["doc_id"]: x for x in got}
    assert of[1]["n_removed"] == 0 and of[2]["n_removed"] == 60 and of[900]["n_removed"] == 80 and of[902]["n_removed"] == 0 and of[None]["n_removed"] == 0
    assert of[905]["n_removed"] == 0  # what a document repeats of itself stays


def test_removed_of_empty_tables(spark, corpus):
    assert repeats.removed(corpus.limit(0)).collect() == []
    got = rows(repeats.removed(spark.createDataFrame([(1, None), (2, ""), (3, " \n")], "doc_id long, text string")))
    assert sorted((r["doc_id"], r["n_words"], r["kept"]) for r in got) == [(1, 0, ""), (2, 0, ""), (3, 0, "")]


@given(st.lists(st.one_of(st.none(), st.text(alphabet=st.sampled_from("aB é\t"), max_size=20)), max_size=6), st.integers(1, 4))
def test_rolling_hashes_are_of_runs(texts, width):
    w = tx.words(*tx.buffers(pa.array(texts, pa.string())), fold=False)
    hashes, at = tx.rolling(w, width)
    found = [blank(t) for t in texts]
    runs = [tuple(f[i : i + width]) for f in found for i in range(len(f) - width + 1)]
    assert len(hashes) == len(runs) and len(dict(zip(hashes.tolist(), runs, strict=True))) == len(set(runs)) == len(set(zip(hashes.tolist(), runs, strict=True)))
    starts = [s + i for s, f in zip(np.cumsum([0, *map(len, found)]), found, strict=False) for i in range(len(f) - width + 1)]
    assert at.tolist() == starts
