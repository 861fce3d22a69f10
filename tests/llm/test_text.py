import re

import numpy as np
import pyarrow as pa
from hypothesis import given
from hypothesis import strategies as st

from granary.llm import text as tx

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet=st.sampled_from("aB zé\t\n\x0b\x1c\xa0-9_€😀"), max_size=30)), max_size=8)


def lower(x):
    return re.sub("[A-Z]", lambda m: m[0].lower(), x or "")


@given(TEXTS)
def test_words_equal_the_patterns(texts):
    for pattern, member in ((r"[^\x20\x09-\x0D]+", tx.BLANK_SPLIT), (r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", tx.ALNUM)):
        w = tx.words(*tx.buffers(pa.array(texts, pa.string())), member)
        found = [re.findall(pattern, lower(t)) for t in texts]
        assert w.count.tolist() == [len(f) for f in found]
        flat = [x for f in found for x in f]
        assert [w.buffer[s:e].tobytes().decode() for s, e in zip(w.start, w.end, strict=True)] == flat
        assert len(set(w.hash.tolist())) == len(set(flat))


@given(TEXTS)
def test_windows_are_runs(texts):
    w = tx.words(*tx.buffers(pa.array(texts, pa.string())))
    runs, of = tx.windows(w, 3)
    expected = []
    for k, t in enumerate(texts):
        f = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
        expected += [(k, tuple(f[i : i + 3])) for i in range(max(len(f) - 2, 1)) if f]
    got = dict(zip(map(int, runs), [None] * len(runs), strict=True))
    assert len(runs) == len(expected) and len(got) == len({x for _, x in expected})
    assert sorted(of.tolist()) == sorted(k for k, _ in expected)


def test_slices_and_packing():
    offsets = np.array([0, 5, 5, 20, 21, 40])
    parts = list(tx.slices(offsets, 10))
    assert parts[0][0] == 0 and parts[-1][1] == 5 and all(a[1] == b[0] for a, b in zip(parts, parts[1:], strict=False))
    for x in (np.arange(7, dtype=np.uint32), np.zeros(0, np.float64)):
        assert tx.unpack(tx.pack(x), x.dtype).tolist() == x.tolist()


def test_slices_of_an_array_with_an_offset():
    column = pa.array(["skip", None, "a b", "c"]).slice(1)
    w = tx.words(*tx.buffers(column))
    assert w.count.tolist() == [0, 2, 1]
