"""License scans by template markup.

A template is wording with regions in ``<<...>>``: what stands between
``<<optional>>`` and ``<</optional>>`` may be absent, and ``<<any n>>`` stands for
zero to n words of any kind. It compiles to an automaton over word hashes; a
text matches where a run of its words takes the automaton to its end, so all
mandatory wording must be there exactly, in order. Documents that lack a
mandatory word of every template are never walked. Of template matches that lie
within a longer one only the longer counts, so a licence that quotes another's
wording and goes on isn't taken for it.

Plain phrases are found beside this, at every place where their words stand
consecutively.

Defined cases: null and empty texts match nothing; matches may overlap, and two
templates that accept the same run both count;
rows that repeat match equally; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm import text as tx

# fixed values: phrases and their labels
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# public license wording with its optional and replaceable regions
_BSD_CONDITIONS = (
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met "
    "<<optional>>1<</optional>> redistributions of source code must retain the above copyright notice this list of conditions and the following "
    "disclaimer <<optional>>2<</optional>> redistributions in binary form must reproduce the above copyright notice this list of conditions and the "
    "following disclaimer in the documentation and or other materials provided with the distribution "
)
_BSD_NAMES = (
    "<<optional>>3<</optional>> neither the name of <<any 8>> nor the names of its contributors may be used to endorse or promote products derived "
    "from this software without specific prior written permission "
)
_BSD_DISCLAIMER = (
    "this software is provided by <<any 6>> as is and any express or implied warranties including but not limited to the implied warranties of "
    "merchantability and fitness for a particular purpose are disclaimed in no event shall <<any 8>> be liable for any direct indirect incidental "
    "special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits "
    "or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or "
    "otherwise arising in any way out of the use of this software even if advised of the possibility of such damage"
)
_GNU_NOTICE = (
    "<<optional>>this <<any 4>> is<</optional>> free software you can redistribute it and or modify it under the terms of the gnu {} as published by the free software foundation "
    "<<optional>>either<</optional>> version <<any 2>> of the license <<optional>>or at your option any later version<</optional>>"
)
_GNU_ONE_VERSION = (
    "<<optional>>this <<any 4>> is<</optional>> free software you can redistribute it and or modify it under the terms of <<optional>>version <<any 2>> of<</optional>> "
    "the gnu {} <<optional>>version <<any 2>><</optional>> as published by the free software foundation"
)
_GNU_SHORT = "<<optional>>this <<any 4>> is<</optional>> licensed under the gnu {} <<optional>>version <<any 1>><</optional>>"
def _creative_commons(terms: str, short: str) -> tuple[str, ...]:
    """The names of one Creative Commons licence; a licence of more terms is longer, so it counts where both match."""
    version = "<<optional>><<any 1>> 0<</optional>> <<optional>>international<</optional>> <<optional>>unported<</optional>>"
    named = f"<<optional>>this <<any 4>> is<</optional>> licensed under <<optional>>a<</optional>> <<optional>>the<</optional>> creative commons attribution {terms} {version} <<optional>>public<</optional>>"
    return (
        f"{named} license" if not terms else f"{named} <<optional>>license<</optional>>",
        f"<<optional>>this <<any 4>> is<</optional>> licensed under <<optional>>a<</optional>> cc by {short} {version}",
    )


TEMPLATES = {
    "mit": (
        "<<optional>>copyright <<any 12>><</optional>> permission is hereby granted free of charge to any person obtaining a copy of this "
        "software and associated documentation files the software to deal in the software without restriction including without limitation "
        "the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom "
        "the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice "
        "<<optional>>including the next paragraph<</optional>> shall be included in all copies or substantial portions of the software "
        "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of "
        "merchantability fitness for a particular purpose and noninfringement in no event shall <<any 8>> be liable for any claim damages or "
        "other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use "
        "or other dealings in the software",
    ),
    "isc": (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that "
        "the above copyright notice and this permission notice appear in all copies the software is provided as is and <<any 8>> disclaims all "
        "warranties with regard to this software including all implied warranties of merchantability and fitness in no event shall <<any 8>> be "
        "liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits "
        "whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of "
        "this software",
    ),
    "bsd-2": (_BSD_CONDITIONS + _BSD_DISCLAIMER,),
    "bsd-3": (_BSD_CONDITIONS + _BSD_NAMES + _BSD_DISCLAIMER,),
    "apache-2": (
        "licensed under the apache license version 2 <<optional>>0<</optional>> <<optional>>the license you may not use <<any 8>> except in "
        "compliance with the license<</optional>>",
    ),
    "gpl": (_GNU_NOTICE.format("general public license"), _GNU_ONE_VERSION.format("general public license"), _GNU_SHORT.format("general public license")),
    "lgpl": (
        _GNU_NOTICE.format("lesser general public license"), _GNU_ONE_VERSION.format("lesser general public license"), _GNU_NOTICE.format("library general public license"),
        _GNU_SHORT.format("lesser general public license"),
    ),
    "agpl": (_GNU_NOTICE.format("affero general public license"), _GNU_ONE_VERSION.format("affero general public license"), _GNU_SHORT.format("affero general public license")),
    "mpl-2": (
        "this source code form is subject to the terms of the mozilla public license v 2 0 <<optional>>if a copy of the mpl was not distributed "
        "with this file you can obtain one at <<any 1>> mozilla org mpl 2 0<</optional>>",
        "licensed under the mozilla public license <<optional>>version<</optional>> 2 0",
    ),
    "cc-by": _creative_commons("", ""),
    "cc-by-sa": _creative_commons("sharealike", "sa"),
    "cc-by-nd": _creative_commons("noderivatives", "nd") + _creative_commons("noderivs", "nd"),
    "cc-by-nc": _creative_commons("noncommercial", "nc"),
    "cc-by-nc-sa": _creative_commons("noncommercial sharealike", "nc sa"),
    "cc-by-nc-nd": _creative_commons("noncommercial noderivatives", "nc nd") + _creative_commons("noncommercial noderivs", "nc nd"),
}
#: What follows "SPDX-License-Identifier:" for each label; versions and "or later" stand behind it.
IDENTIFIERS = {
    "mit": "mit", "isc": "isc", "bsd-2": "bsd 2 clause", "bsd-3": "bsd 3 clause", "apache-2": "apache 2 0", "gpl": "gpl", "lgpl": "lgpl", "agpl": "agpl", "mpl-2": "mpl 2 0",
    "cc-by": "cc by", "cc-by-sa": "cc by sa", "cc-by-nd": "cc by nd", "cc-by-nc": "cc by nc", "cc-by-nc-sa": "cc by nc sa", "cc-by-nc-nd": "cc by nc nd",
}
TEMPLATES = {label: (*wordings, f"spdx license identifier {IDENTIFIERS[label]}") for label, wordings in TEMPLATES.items()}


class Automaton:
    """States with word edges, any-word edges and empty edges; state 0 starts, ``end`` accepts."""

    def __init__(self, template: str):
        self.words: list[dict[int, list[int]]] = []
        self.anyword: list[list[int]] = []
        self.empty: list[list[int]] = []
        self.mandatory: set[int] = set()
        parts = re.split(r"<<(.*?)>>", template)
        at, opened = self._state(), []
        for k, part in enumerate(parts):
            if k % 2 == 0:
                for h in tx.hash_words(part, tx.ALNUM).tolist():
                    new = self._state()
                    self.words[at].setdefault(h, []).append(new)
                    if not opened:
                        self.mandatory.add(h)
                    at = new
            elif part == "optional":
                opened.append(at)
            elif part == "/optional":
                self.empty[opened.pop()].append(at)
            elif m := re.fullmatch(r"any (\d+)", part):
                steps = [at]
                for _ in range(int(m[1])):
                    new = self._state()
                    self.anyword[steps[-1]].append(new)
                    steps.append(new)
                at = self._state()
                for s in steps:
                    self.empty[s].append(at)
            else:
                raise ValueError(f"unknown markup: {part}")
        if opened:
            raise ValueError("an optional region isn't closed")
        self.end = at
        if any(self.anyword[x] for x in self.closed({0})):
            raise ValueError("a template can't begin with words of any kind")
        self.first = set().union(*(self.words[s] for s in self.closed({0})))

    def _state(self) -> int:
        self.words.append({})
        self.anyword.append([])
        self.empty.append([])
        return len(self.words) - 1

    def closed(self, states: set[int]) -> set[int]:
        out, todo = set(states), list(states)
        while todo:
            for s in self.empty[todo.pop()]:
                if s not in out:
                    out.add(s)
                    todo.append(s)
        return out

    def longest(self, hashes: list[int], start: int) -> int:
        """End (exclusive) of the longest accepted run from ``start``, or -1."""
        states, end = self.closed({0}), -1
        for k in range(start, len(hashes)):
            states = self.closed({n for s in states for n in (*self.words[s].get(hashes[k], ()), *self.anyword[s])})
            if not states:
                return end
            if self.end in states:
                end = k + 1
        return end


def phrase_places(w: tx.Words, phrase: np.ndarray) -> np.ndarray:
    """Words at which the phrase's words stand consecutively in one text."""
    n = len(w.hash) - len(phrase) + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    ok = w.text[:n] == w.text[len(phrase) - 1 :]
    for k, h in enumerate(phrase):
        ok &= w.hash[k : k + n] == h
    return np.flatnonzero(ok)


MATCHES = "array<struct<start: long, end: long, label: string, base: boolean>>"


def outermost(found: list[dict]) -> list[dict]:
    """Template matches without those that lie within a longer one."""
    out, top = [], None
    for x in sorted(found, key=lambda x: (x["start"], -x["end"])):
        if top is None or x["end"] > top["end"]:
            top = x
        elif (x["start"], x["end"]) != (top["start"], top["end"]):
            continue
        out.append(x)
    return out


def _scan(phrases: dict[str, str], templates: dict[str, tuple[str, ...]]):
    def run(batches):
        known = [(tx.hash_words(p, tx.ALNUM), label) for p, label in phrases.items()]
        machines = [(label, Automaton(t)) for label, wordings in templates.items() for t in wordings]
        needed = [np.array(sorted(m.mandatory), np.uint64) for _, m in machines]
        every = np.unique(np.concatenate([*needed, np.zeros(0, np.uint64)]))
        for batch in batches:
            data, offsets = tx.buffers(batch.column("text"))
            for i, j in tx.slices(offsets):
                w = tx.words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], tx.ALNUM)
                first = w.first
                found: dict[int, list] = {}
                wording: dict[int, list] = {}
                for phrase, label in known:
                    for p in phrase_places(w, phrase).tolist():
                        d = int(w.text[p])
                        s = p - int(first[d])
                        found.setdefault(d, []).append({"start": s, "end": s + len(phrase), "label": label, "base": True})
                if len(every) and len(w.hash):
                    at = np.minimum(np.searchsorted(every, w.hash), len(every) - 1)
                    hit = every[at] == w.hash
                    has = np.zeros((j - i, len(every)), bool)
                    has[w.text[hit], at[hit]] = True
                    for (label, m), need in zip(machines, needed, strict=True):
                        for d in np.flatnonzero(has[:, np.searchsorted(every, need)].all(axis=1)).tolist():
                            hashes = w.hash[first[d] : first[d] + w.count[d]].tolist()
                            k = 0
                            while k < len(hashes):
                                if hashes[k] in m.first and (end := m.longest(hashes, k)) > k:
                                    wording.setdefault(d, []).append({"start": k, "end": end, "label": label, "base": False})
                                    k = end
                                else:
                                    k += 1
                for d, matches in wording.items():
                    found.setdefault(d, []).extend(outermost(matches))
                order = lambda x: (x["start"], x["end"], x["label"])
                kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("label", pa.string()), ("base", pa.bool_())]))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id")[i:j],
                        pa.array(w.count.astype(np.int64)),
                        pa.array([sorted(found.get(d, ()), key=order) for d in range(j - i)], kind),
                    ],
                    ["doc_id", "n_words", "matches"],
                )

    return run


def scan(docs: DataFrame, *, doc_id="doc_id", text="text", phrases=PHRASES, templates=TEMPLATES) -> DataFrame:
    """doc_id, n_words and matches (start and end in words, label, base: whether a plain phrase) of each document."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(_scan(phrases, templates), f"doc_id long, n_words long, matches {MATCHES}")


def summary(found: DataFrame) -> DataFrame:
    """Counts, labels and the share of words within matches."""
    base = F.filter("matches", lambda x: x["base"])
    labels = lambda m: F.concat_ws(",", F.array_sort(F.array_distinct(F.transform(m, lambda x: x["label"]))))
    zero = F.lit(0).cast("long")
    covered = F.aggregate(
        "matches",
        F.struct(zero.alias("end"), zero.alias("hit")),
        lambda acc, x: F.struct(
            F.greatest(acc["end"], x["end"]).alias("end"),
            (acc["hit"] + F.greatest(zero, x["end"] - F.greatest(x["start"], acc["end"]))).alias("hit"),
        ),
        lambda acc: acc["hit"],
    )
    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda x: x["start"])).alias("first_word"),
        F.array_max(F.transform(base, lambda x: x["start"])).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("matches")).alias("labels"),
        F.when(F.col("n_words") > 0, covered / F.col("n_words")).otherwise(0.0).alias("score"),
    )
