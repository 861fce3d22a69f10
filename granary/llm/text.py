"""Vectorised word splitting over Arrow string columns, for use inside tasks.

Texts stay UTF-8 bytes in one buffer. Both word patterns of this library are
byte-wise (every byte from 0x80 up belongs to a word), so a 256-entry table
finds the words and a prefix sum of ``table[byte] * M**position`` hashes all of
them at once. Words with equal bytes have equal 64-bit hashes; different words
collide with odds of about 2**-64 a pair.
"""

from __future__ import annotations

import ctypes
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SPACES = bytes([0x20, *range(0x09, 0x0E)])
#: Bytes of one step over a buffer; bounds the temporaries to about 40 times this.
SLICE_BYTES = 2 << 20

_rng = np.random.default_rng(20240521)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_M = np.uint64(0x9E3779B97F4A7C15 | 1)
_M_INV = np.uint64(pow(int(_M), -1, 2**64))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_powers = {"m": np.ones(1, np.uint64), "inv": np.ones(1, np.uint64)}


def _table(member) -> np.ndarray:
    return np.array([member(b) for b in range(256)], dtype=bool)


#: ``[^\x20\x09-\x0D]+``
BLANK_SPLIT = _table(lambda b: b not in SPACES)
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` once A-Z is lower-cased
ALNUM = _table(lambda b: b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A)
#: Letters as bytes: a-z and all of UTF-8's multi-byte characters
LETTERS = _table(lambda b: b >= 0x80 or 0x61 <= b <= 0x7A)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _power(kind: str, n: int) -> np.ndarray:
    if len(_powers[kind]) < n:
        base = np.full(max(n, SLICE_BYTES), _M if kind == "m" else _M_INV, np.uint64)
        base[0] = 1
        _powers[kind] = np.multiply.accumulate(base)
    return _powers[kind][:n]


@dataclass
class Words:
    """Words of several texts: hash, first byte, byte after the last, and text of each; n by text."""

    buffer: np.ndarray
    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    count: np.ndarray

    @property
    def first(self) -> np.ndarray:
        """Index of each text's first word."""
        return np.concatenate([[0], np.cumsum(self.count)[:-1]]).astype(np.int64)

    def within(self) -> np.ndarray:
        """Each word's number in its text, from 0."""
        return np.arange(len(self.hash)) - self.first[self.text]


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its n + 1 offsets; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    large = pa.types.is_large_string(column.type)
    kind = np.int64 if large else np.int32
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, most: int = SLICE_BYTES):
    """Ranges of whole texts of about ``most`` bytes; a longer text stands alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def words(data: np.ndarray, offsets: np.ndarray, member: np.ndarray = BLANK_SPLIT, *, fold: bool = True) -> Words:
    """Words of texts that lie in ``data`` between ``offsets`` (from 0), A-Z lower-cased unless ``fold`` is false."""
    n = len(offsets) - 1
    low = _LOWER[data] if fold else data
    if not len(low):
        none = np.zeros(0, np.int64)
        return Words(low, none.astype(np.uint64), none, none, none, np.zeros(n, np.int64))
    inside = member[low]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    edge = offsets[1:-1]
    edge = edge[(edge > 0) & (edge < len(low))]
    starts[edge] |= inside[edge]
    ends[edge - 1] |= inside[edge - 1]
    s, e = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    with np.errstate(over="ignore"):
        sums = np.zeros(len(low) + 1, np.uint64)
        np.cumsum(_BYTE[low] * _power("m", len(low)), out=sums[1:])
        h = mix((sums[e] - sums[s]) * _power("inv", len(low))[s])
    text = np.searchsorted(offsets, s, "right") - 1
    return Words(low, h, s, e, text, np.bincount(text, minlength=n))


def hash_words(phrase: str, member: np.ndarray = BLANK_SPLIT) -> np.ndarray:
    """Hashes of one text's words, as ``words`` gives them."""
    raw = np.frombuffer(phrase.encode(), np.uint8)
    return words(raw, np.array([0, len(raw)]), member).hash


def windows(w: Words, width: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words and their texts; a text of fewer words, but some, has its whole sequence as one run."""
    n = len(w.hash)
    with np.errstate(over="ignore"):
        odd = np.uint64(0xD6E8FEB86659FD93)
        salt = np.uint64(seed)
        full = np.zeros(max(0, n - width + 1), np.uint64)
        for k in range(width):
            full = (full ^ w.hash[k : k + len(full)]) * odd + salt
        ok = w.text[: len(full)] == w.text[width - 1 :] if len(full) else np.zeros(0, bool)
        runs, of = mix(full[ok]), w.text[: len(full)][ok]
        short = np.flatnonzero((w.count > 0) & (w.count < width))
        if len(short):
            first = w.first
            h = np.full(len(short), np.uint64(width), np.uint64)
            for k in range(width - 1):
                has = w.count[short] > k
                at = np.minimum(first[short] + k, n - 1)
                h = np.where(has, (h ^ w.hash[at]) * odd + salt + np.uint64(1), h)
            runs, of = np.concatenate([runs, mix(h)]), np.concatenate([of, short])
    return runs, of


def rolling(w: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Rabin-Karp hashes of all runs of ``width`` words within a text, and each run's first word by number.

    The polynomial of a run comes from two prefix sums, so the cost doesn't depend on the width.
    """
    n = len(w.hash)
    if n < width:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(w.hash * _power("m", n), out=sums[1:])
        runs = mix((sums[width:] - sums[:-width]) * _power("inv", n)[: n - width + 1])
    at = np.flatnonzero(w.text[: n - width + 1] == w.text[width - 1 :])
    return runs[at], at


def planes(values: np.ndarray) -> bytes:
    """``pack`` with all values' first bytes before their second ones: for numbers of few significant bytes."""
    return pack(np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T)


def unplanes(raw: bytes, kind) -> np.ndarray:
    return np.ascontiguousarray(unpack(raw, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def lowered(column: pa.Array) -> pa.Array:
    """The column with A-Z lower-cased; nulls are empty."""
    data, offsets = buffers(column)
    return pa.Array.from_buffers(pa.large_string(), len(offsets) - 1, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(_LOWER[data].tobytes())])


def give_back() -> None:
    """Returns freed memory to the system."""
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)


def lean(run):
    """A task's function that gives freed memory back when it ends: its worker stays and waits for other tasks."""

    def wrapped(batches):
        yield from run(batches)
        give_back()

    return wrapped


def pack(values: np.ndarray) -> bytes:
    """An array as compressed bytes; ``unpack`` gives it back."""
    raw = np.ascontiguousarray(values).tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def unpack(raw: bytes, kind) -> np.ndarray:
    size = int.from_bytes(raw[:8], "little")
    if not size:
        return np.zeros(0, kind)
    return np.frombuffer(pa.decompress(raw[8:], size, "zstd"), kind)
