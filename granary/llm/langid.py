"""Language identification of code-switched text by a linear-chain CRF.

Every word of a text is a step of the chain and every language a label. A
word's emission sums learned weights of its character n-grams (those that touch
a word boundary are its affixes), of the word itself and of its membership in
each language's lexicon (the frequent words of the labelled sample); learned
transitions join neighbours. Training maximises the conditional likelihood on
sequences spliced from pieces of labelled documents in different languages, so
transitions see switches. Forward-backward gives each word's posterior; a
text's language is the one with the largest sum, its score that sum's share.

The model is fitted on at most ``per_language`` labelled documents of each
language, chosen by hash of the id, none over ``most_chars`` characters; all
documents are labelled in whole.

Defined cases: null texts and texts without a letter are ``und`` with score 0,
as is everything if nothing is labelled; ties go to the language first in code
point order; rows that repeat get equal labels; a null id is neither held out
nor trained on; an empty table gives an empty result.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from granary.llm import text as tx
from granary.llm.session import cut, sized, training

UNKNOWN = "und"
PER_LANGUAGE, MOST_CHARS = 200, 20_000
#: Hashed n-gram weights; n-grams of these lengths, over bytes with a mark at each end of a word.
SLOTS, GRAMS = 1 << 17, (1, 2, 3, 4)
LEXICON = 400
#: Distinct words whose n-grams are held at once (some 5 kB each).
CHUNK = 10_000
_EDGE = 0x20


@dataclass
class Model:
    languages: list[str]
    grams: np.ndarray  # SLOTS x L: n-grams and whole words
    lexicon: np.ndarray  # hashes, ascending
    member: np.ndarray  # lexicon x L, 0 or 1
    by_lexicon: np.ndarray  # L x L
    bias: np.ndarray
    trans: np.ndarray  # log weights
    start: np.ndarray


@dataclass
class Features:
    """Of distinct words: n-gram slots with the bounds of each word's, own slot, lexicon membership."""

    slots: np.ndarray
    bounds: np.ndarray
    own: np.ndarray
    entry: np.ndarray  # index in the lexicon or -1


def vocabulary(w: tx.Words) -> tuple[np.ndarray, np.ndarray]:
    """First places of the distinct words, and each word's number among them."""
    _, first, of = np.unique(w.hash, return_index=True, return_inverse=True)
    return first, of


def features(w: tx.Words, pick: np.ndarray, lexicon: np.ndarray) -> Features:
    size = (w.end - w.start)[pick]
    wide = size + 2
    ends = np.cumsum(wide)
    low = w.buffer.copy()
    # É to é and so on: the second byte of U+00C0..U+00DE but for the sign U+00D7
    up = np.flatnonzero((low[1:] >= 0x80) & (low[1:] <= 0x9E) & (low[1:] != 0x97) & (low[:-1] == 0xC3)) + 1
    low[up] += 0x20
    flat = np.full(int(ends[-1]) if len(ends) else 0, _EDGE, np.uint64)
    inner = np.repeat(ends - wide + 1, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    source = np.repeat(w.start[pick], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    flat[inner] = low[source]
    word = np.repeat(np.arange(len(pick)), wide)
    slots, of = [], []
    with np.errstate(over="ignore"):
        for n in GRAMS:
            if len(flat) < n:
                continue
            code = np.full(len(flat) - n + 1, n, np.uint64)
            for k in range(n):
                code = (code << np.uint64(8)) | flat[k : k + len(code)]
            same = word[: len(code)] == word[n - 1 :]
            slots.append((tx.mix(code[same]) % np.uint64(SLOTS)).astype(np.int32))
            of.append(word[: len(code)][same])
    slots, of = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (slots, of))
    order = np.argsort(of, kind="stable")
    hashes = w.hash[pick]
    at = np.minimum(np.searchsorted(lexicon, hashes), max(len(lexicon) - 1, 0))
    entry = np.where(lexicon[at] == hashes, at, -1) if len(lexicon) else np.full(len(pick), -1)
    bounds = np.searchsorted(of[order], np.arange(len(pick)))
    return Features(slots[order], bounds, (tx.mix(hashes) % np.uint64(SLOTS)).astype(np.int64), entry)


def chunks(w: tx.Words, pick: np.ndarray, lexicon: np.ndarray):
    """Features of the distinct words, a chunk of them at a time."""
    for k in range(0, len(pick), CHUNK):
        yield features(w, pick[k : k + CHUNK], lexicon)


def _scale(f: Features) -> np.ndarray:
    return 1 / np.sqrt(np.diff(np.append(f.bounds, len(f.slots))))


def emissions(m: Model, f: Features) -> np.ndarray:
    if not len(f.own):
        return np.zeros((0, len(m.languages)))
    out = np.add.reduceat(m.grams[f.slots], f.bounds, axis=0) * _scale(f)[:, None] + m.grams[f.own] + m.bias
    known = f.entry >= 0
    out[known] += m.member[f.entry[known]] @ m.by_lexicon
    return out


def marginals(log_e: np.ndarray, count: np.ndarray, trans: np.ndarray, start: np.ndarray):
    """Posteriors of every step by forward-backward, and the expected number of each transition.

    Sequences of ``count`` steps follow each other in ``log_e``. One step of all of them is taken at a time, longest
    sequences first, so those still running are always the leading ones.
    """
    if not len(log_e):
        return log_e, np.zeros_like(trans)
    used = np.flatnonzero(count)
    order = used[np.argsort(-count[used], kind="stable")]
    first = (np.cumsum(count) - count)[order]
    running = np.searchsorted(-count[order], -np.arange(count.max()), "left")
    offset = np.cumsum(running) - running
    rank = np.arange(len(log_e)) - np.repeat(offset, running)
    at = first[rank] + np.repeat(np.arange(len(running)), running)
    e = np.exp(log_e - log_e.max(axis=1, keepdims=True))[at]
    go, back = np.exp(trans), np.exp(trans).T
    alpha, norm = np.empty_like(e), np.empty((len(e), 1))
    a = None
    for t, (lo, n) in enumerate(zip(offset.tolist(), running.tolist(), strict=True)):
        a = (a[:n] @ go if t else np.exp(start)) * e[lo : lo + n]
        s = a.sum(axis=1, keepdims=True)
        a /= s
        alpha[lo : lo + n], norm[lo : lo + n] = a, s
    e /= norm
    expected = np.zeros_like(trans)
    beta = e[:0]
    for lo, n in zip(offset[::-1].tolist(), running[::-1].tolist(), strict=True):
        m = len(beta)
        now = np.ones((n, e.shape[1]))
        if m:
            ahead = e[lo + n : lo + n + m] * beta
            now[:m] = ahead @ back
            expected += alpha[lo : lo + m].T @ ahead
        alpha[lo : lo + n] *= now
        beta = now
    out = np.empty_like(alpha)
    out[at] = alpha
    return out, expected * go


def spliced(w: tx.Words, label: np.ndarray, rng: np.random.Generator, piece: int = 30, pieces: int = 8):
    """Words in a new order, cut into sequences of pieces from different documents: word indices, sequence lengths.

    Only the order is new: every word of the sample stays, once.
    """
    cut_here = rng.random(len(w.hash)) < 1 / piece
    cut_here |= w.within() == 0
    begin = np.flatnonzero(cut_here)
    size = np.diff(np.append(begin, len(w.hash)))
    order = rng.permutation(len(begin))
    begin, size = begin[order], size[order]
    words = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())
    return words, np.add.reduceat(size, np.arange(0, len(size), pieces)) if len(size) else size


def fit(texts: list[str], labels: list[str], *, rounds: int = 45, rate: float = 0.15, decay: float = 1e-3, seed: int = 5) -> Model | None:
    """Maximises the conditional likelihood of the labels by Adam; None without words or labels."""
    languages = sorted(set(labels))
    data, offsets = tx.buffers(pa.array(texts, pa.string()))
    w = tx.words(data, offsets, tx.LETTERS)
    if not languages or not len(w.hash):
        return None
    n = len(languages)
    gold_of_text = np.array([languages.index(x) for x in labels])
    pick, of = vocabulary(w)
    often = np.bincount(of * n + gold_of_text[w.text], minlength=len(pick) * n).reshape(-1, n)
    top = [np.argsort(-often[:, k], kind="stable")[:LEXICON] for k in range(n)]
    listed = [w.hash[pick[t[often[t, k] > 1]]] for k, t in enumerate(top)]
    lexicon = np.unique(np.concatenate(listed))
    member = np.stack([np.isin(lexicon, x) for x in listed], axis=1).astype(float)
    m = Model(languages, np.zeros((SLOTS, n)), lexicon, member, np.zeros((n, n)), np.zeros(n), np.zeros((n, n)), np.zeros(n))
    parts = list(chunks(w, pick, lexicon))
    words, count = spliced(w, gold_of_text, np.random.default_rng(seed))
    gold = gold_of_text[w.text][words]
    first = np.cumsum(count) - count
    inside = np.ones(len(gold), bool)
    inside[first] = False
    seen = np.bincount(gold[:-1][inside[1:]] * n + gold[1:][inside[1:]], minlength=n * n).reshape(n, n)
    hot = np.eye(n)[gold]
    names = ("grams", "by_lexicon", "bias", "trans", "start")
    moment = {k: (np.zeros_like(getattr(m, k)), np.zeros_like(getattr(m, k))) for k in names}
    for step in range(1, rounds + 1):
        every = np.concatenate([emissions(m, f) for f in parts])
        posterior, expected = marginals(every[of[words]], count, m.trans, m.start)
        miss = hot - posterior
        by_word = np.stack([np.bincount(of[words], miss[:, k], len(pick)) for k in range(n)], axis=1)
        grams, listed_in = np.zeros((SLOTS, n)), np.zeros((n, n))
        for k, f in enumerate(parts):
            mine = by_word[k * CHUNK : (k + 1) * CHUNK]
            spread = np.repeat(mine * _scale(f)[:, None], np.diff(np.append(f.bounds, len(f.slots))), axis=0)
            for j in range(n):
                grams[:, j] += np.bincount(f.slots, spread[:, j], SLOTS) + np.bincount(f.own, mine[:, j], SLOTS)
            known = f.entry >= 0
            listed_in += m.member[f.entry[known]].T @ mine[known]
        slope = {
            "grams": grams,
            "by_lexicon": listed_in,
            "bias": by_word.sum(axis=0),
            "trans": seen - expected,
            "start": miss[first].sum(axis=0),
        }
        for k in names:
            g = slope[k] / len(gold) - decay / 100 * getattr(m, k)
            one, two = moment[k]
            one += 0.1 * (g - one)
            two += 0.01 * (g * g - two)
            getattr(m, k)[...] += rate * (one / (1 - 0.9**step)) / (np.sqrt(two / (1 - 0.99**step)) + 1e-7)
    return m


def sample(docs: DataFrame, *, doc_id="doc_id", text="text", lang="lang", mod=3, held=1, per_language=PER_LANGUAGE, most_chars=MOST_CHARS):
    """The bounded training sample: lang and text of some documents that aren't held out.

    Ids are chosen without reading texts; twice as many as wanted, as some texts may be too long.
    """
    mark = F.xxhash64("doc_id")
    place = Window.partitionBy("lang").orderBy(F.pmod(mark, F.lit(1 << 30)), "doc_id")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    fold = rows.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~training(F.col("doc_id"), mod, held))
    # of a frequent language only ids with a small enough hash are ranked: some four times as many as wanted
    counts = fold.groupBy(F.col("lang").alias("lang_")).count()
    share = F.least(F.lit(1.0), (4 * per_language + 100) / F.col("count"))
    few = fold.select("doc_id", "lang").join(sized(cut(counts)), F.col("lang") == F.col("lang_"))
    few = few.where(F.pmod(mark, F.lit(1 << 30)) < share * (1 << 30)).select("doc_id", "lang")
    chosen = few.withColumn("place", F.row_number().over(place)).where(F.col("place") <= 2 * per_language)
    # at most 2 * per_language ids for each language
    texts = fold.join(F.broadcast(chosen.select("doc_id", "place").distinct()), "doc_id").where(F.length("text") <= most_chars)
    best = texts.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("place", "text"))).where(F.col("n") <= per_language)
    return best.select("lang", "text")


def _fit(batches):
    rows = sorted(pair for batch in batches for pair in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True))
    model = fit([t for _, t in rows], [x for x, _ in rows])
    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])


def train(docs: DataFrame, **options) -> Model | None:
    """The model of the sample, which is small enough for one task."""
    fitted = sample(docs, **options).repartition(1).mapInArrow(tx.lean(_fit), "model binary").first()
    return pickle.loads(fitted[0]) if fitted else None


def _label(shared, text: str):
    def run(batches):
        m: Model | None = shared.value
        for batch in batches:
            data, offsets = tx.buffers(batch.column(text))
            for i, j in tx.slices(offsets, 1 << 20):
                w = tx.words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], tx.LETTERS)
                label, score = [UNKNOWN] * (j - i), np.zeros(j - i)
                if m is not None and len(w.hash):
                    pick, of = vocabulary(w)
                    every = np.concatenate([emissions(m, f) for f in chunks(w, pick, m.lexicon)])
                    posterior, _ = marginals(every[of], w.count, m.trans, m.start)
                    total = np.zeros((j - i, len(m.languages)))
                    some = np.flatnonzero(w.count)
                    total[some] = np.add.reduceat(posterior, w.first[some], axis=0) / w.count[some, None]
                    plain = np.zeros(j - i, bool)
                    plain[w.text[w.buffer[w.start] < 0x80]] = True
                    best = total.argmax(axis=1)
                    for k in some:
                        # words that begin with a byte of a longer character may hold no letter
                        if plain[k] or any(c.isalpha() for c in batch.column(text)[i + int(k)].as_py()):
                            label[k], score[k] = m.languages[best[k]], min(1.0, total[k, best[k]])
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c)[i:j] for c in batch.schema.names if c != "__text"), pa.array(label), pa.array(score)],
                    [*(c for c in batch.schema.names if c != "__text"), "lang_pred", "score"],
                )

    return run


def predict(docs: DataFrame, model: Model | None, *, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` of each document with lang_pred and score, which replace columns of these names."""
    keep = [c for c in keep if c not in ("lang_pred", "score")]
    name = text if text in keep else "__text"
    rows = docs.select(*keep, *([] if text in keep else [F.col(text).alias(name)]))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "__text")
    return rows.mapInArrow(tx.lean(_label(shared, name)), f"{kinds}, lang_pred string, score double")
