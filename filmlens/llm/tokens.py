"""Words and hashes of many texts at once, as arrays.

Texts are handled as UTF-8 bytes in slices of bounded size, so a task needs the
same memory however many rows it has; only a single text longer than a slice
makes a larger one. White space and ``A-Z`` are ASCII, so words by bytes are
words by characters.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

_B = np.uint64(0x9E3779B97F4A7C15)
_B_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_C = np.uint64(0xD1342543DE82EF95)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _symbols(lower: bool) -> np.ndarray:
    values = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))
    if lower:
        values[65:91] = values[97:123]
    return values


_PLAIN, _LOWER = _symbols(False), _symbols(True)
_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(kind: str, n: int) -> np.ndarray:
    if len(_powers[kind]) < n:
        base = _B if kind == "up" else _B_INVERSE
        out = np.full(n, base, np.uint64)
        out[0] = 1
        _powers[kind] = np.multiply.accumulate(out)
    return _powers[kind][:n]


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """S with hash(values[a:b]) = (S[b] - S[a]) * inverse power a."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _power("up", len(values)), out=out[1:])
    return out


def range_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The same number for the same values, wherever they stand."""
    return (sums[end] - sums[start]) * _power("down", len(sums))[start]


@dataclass
class Words:
    """All words of the texts of one slice, in order.

    ``start`` and ``end`` are byte places in ``data``; ``first`` has, for each
    text and past the last one, the index of its first word.
    """

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    hashes: np.ndarray
    sums: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


_NO_LETTER = np.ones(256, bool)
_NO_LETTER[65:91] = _NO_LETTER[97:123] = _NO_LETTER[128:] = False


def find_words(texts: Sequence[bytes | None], lower: bool = False, letters: bool = False) -> Words:
    """Runs of characters other than white space, or with ``letters`` runs of ASCII letters and non-ASCII characters."""
    data = np.frombuffer(b" ".join(t or b"" for t in texts) + b" ", np.uint8)
    lengths = np.array([len(t or b"") + 1 for t in texts], np.int64)
    inside = np.concatenate(([False], ~(_NO_LETTER if letters else _SPACE)[data], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edges[0::2], edges[1::2]
    text_start = np.concatenate(([0], np.cumsum(lengths)))
    first = np.searchsorted(start, text_start)
    sums = prefix_sums((_LOWER if lower else _PLAIN)[data])
    return Words(data, start, end, first, byte_hashes(sums, start, end), sums)


def byte_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix64(range_hash(sums, start, end) + (end - start).astype(np.uint64))


def shingles(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``k``-word windows, and for each text (and past the last) the index of its first window.

    A text with 1 to ``k - 1`` words has one window, all of it.
    """
    n = len(words.hashes)
    full = np.zeros(max(n - k + 1, 0), np.uint64)
    for j in range(k):
        full = full * _C + words.hashes[j : j + len(full)]
    counts = words.counts
    windows = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    first = np.concatenate(([0], np.cumsum(windows)))
    owner = np.repeat(np.arange(len(counts)), windows)
    at = words.first[owner] + np.arange(len(owner)) - first[owner]
    out = np.empty(len(owner), np.uint64)
    long = counts[owner] >= k
    out[long] = full[at[long]] + np.uint64(k)
    for i in np.flatnonzero(~long):
        value = np.uint64(0)
        count = counts[owner[i]]
        for h in words.hashes[at[i] : at[i] + count]:
            value = np.uint64((int(value) * int(_C) + int(h)) & 0xFFFFFFFFFFFFFFFF)
        out[i] = np.uint64((int(value) + int(count)) & 0xFFFFFFFFFFFFFFFF)
    return mix64(out), first


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", size: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    """Parts of the batches, with their texts as bytes, of about ``size`` bytes each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(text)
        lengths = np.asarray(pc.fill_null(pc.binary_length(column), 0)).astype(np.int64)
        group = (np.cumsum(lengths) - lengths) // size
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(group)) + 1, [batch.num_rows]))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            part = batch.slice(a, b - a)
            kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
            yield part, part.column(text).cast(kind).to_pylist()
