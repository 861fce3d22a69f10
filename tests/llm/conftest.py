import random

import pytest


@pytest.fixture(scope="session")
def corpus(spark):
    """Rows of every awkward kind: nulls, blanks, ties, copies, near copies, a long text, an extra clashing column."""
    r = random.Random(3)
    words = [f"w{k}" for k in range(400)]
    texts = [" ".join(r.choices(words, k=r.randint(1, 60))) for _ in range(60)]
    base = r.choices(words, k=120)
    near = []
    for k in range(40):
        t = list(base)
        for _ in range(k % 4):
            t[r.randrange(len(t))] = r.choice(words)
        near.append(" ".join(t))
    texts += near + [texts[0]] * 12 + [None, "", " \t\n", "a b c", "A B  C", "x" * 5000, " ".join(r.choices(words, k=20000)), "Éa  B\xa0c"]
    rows = [(k, t, ["en", "de", None][k % 3], ["s1", "s2", None, "Ω"][k % 4], -1) for k, t in enumerate(texts)]
    rows += [(5, texts[5], "de", "s2", -1), (5, texts[5], "de", "s2", -1), (None, "a null id", None, None, -1)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, size long").repartition(3)
