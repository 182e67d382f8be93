"""Words of digits, ASCII letters and non-ASCII characters, of many texts at once, as arrays.

A word is a run ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with ``A-Z``
lower-cased. All bytes of a non-ASCII character are above 127, so words by bytes
are words by characters. Texts come in slices of bounded size (``tokens.slices``);
only a single longer text needs more memory.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

from filmlens.llm.tokens import byte_hashes, mix64, prefix_sums

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LONG_BYTES = 64
"""Longer runs are checksummed one by one."""

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_INSIDE = np.zeros(256, bool)
_INSIDE[48:58] = _INSIDE[97:123] = _INSIDE[128:] = True


@dataclass
class Words:
    """``data`` holds the texts, lower-cased and each followed by a zero byte; word i is ``data[start[i]:end[i]]``.

    ``first`` has, for each text and past the last one, the index of its first
    word, and ``text_start`` the place of its first byte.
    """

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    text_start: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """64 bits a word, the same for the same word in every slice."""
        return byte_hashes(prefix_sums(_SYMBOLS[self.data]), self.start, self.end)


_SYMBOLS = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))


def find_words(texts: Sequence[bytes | None]) -> Words:
    """All words of the texts, in order; a null text has none."""
    data = _LOWER[np.frombuffer(b"\0".join(t or b"" for t in texts) + b"\0", np.uint8)]
    inside = np.concatenate(([False], _INSIDE[data], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edges[0::2], edges[1::2]
    text_start = np.concatenate(([0], np.cumsum([len(t or b"") + 1 for t in texts], dtype=np.int64)))
    return Words(data, start, end, np.searchsorted(start, text_start), text_start)


def word_hash(word: str) -> int:
    """The hash that ``Words.hashes`` gives this word."""
    return int(find_words([word.encode()]).hashes()[0])


def runs(words: Words, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The runs of ``n`` consecutive words of one text, joined by one space.

    Gives bytes, starts, ends and, for each text and past the last one, the index
    of its first run.
    """
    keep = _INSIDE[words.data]
    keep[words.end] = True
    place = np.concatenate(([0], np.cumsum(keep)))
    joined = np.where(_INSIDE[words.data], words.data, np.uint8(32))[keep]
    per_text = np.maximum(words.counts - n + 1, 0)
    first = np.concatenate(([0], np.cumsum(per_text)))
    owner = np.repeat(np.arange(len(per_text)), per_text)
    at = words.first[owner] + np.arange(len(owner)) - first[owner]
    return joined, place[words.start[at]], place[words.end[at + n - 1]], first


def _crc_table() -> np.ndarray:
    value = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        value = np.where(value & 1, (value >> 1) ^ np.uint32(0xEDB88320), value >> 1)
    return value


_CRC = _crc_table()


def crc32(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Unsigned CRC-32 of every ``data[start:end]``."""
    length = end - start
    short = np.minimum(length, LONG_BYTES + 1).astype(np.uint8)
    order = np.argsort(short, kind="stable")
    at, size = start[order], short[order]
    value = np.full(len(order), 0xFFFFFFFF, np.uint32)
    some = np.searchsorted(size, LONG_BYTES, side="right")
    # The runs still going on at byte j stand at the end of the order.
    for j, begin in enumerate(np.searchsorted(size, np.arange(LONG_BYTES, dtype=np.uint8), side="right")):
        if begin >= some:
            break
        part = value[begin:some]
        value[begin:some] = _CRC[(part ^ data[at[begin:some] + j]) & np.uint32(255)] ^ (part >> np.uint32(8))
    value ^= np.uint32(0xFFFFFFFF)
    for i in range(some, len(order)):
        value[i] = zlib.crc32(data[at[i] : end[order[i]]].tobytes())
    out = np.empty(len(order), np.uint32)
    out[order] = value
    return out
