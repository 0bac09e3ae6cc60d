"""Words of many texts at once as 64-bit hashes, by array operations on the texts' bytes."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Odd multipliers of the rolling hashes: of the letters of a word, and two of the words of a sequence.
LETTERS, FIRST, SECOND = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F
#: Bytes of text that are worked on at a time, if there is more than one text.
CHUNK = 1 << 20


class Words(NamedTuple):
    """Of some texts: the words' hashes in order, and for each text the place of its first word and its number of words."""

    hashes: np.ndarray
    first: np.ndarray
    count: np.ndarray


@cache
def powers(base: int, size: int) -> np.ndarray:
    out = np.full(size, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out)


def rolling(values: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums before each place, and what they are multiplied by, so that `slices` gives equal hashes for equal runs."""
    size = 1 << max(12, int(len(values)).bit_length())  # few sizes, so that few powers are kept
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(base, size)[: len(values)], out=sums[1:])
    return sums, powers(pow(base, -1, 1 << 64), size)


def slices(rolled: tuple[np.ndarray, np.ndarray], start: np.ndarray, end: np.ndarray) -> np.ndarray:
    sums, back = rolled
    return mixed((sums[end] - sums[start]) * back[start])


def mixed(x: np.ndarray) -> np.ndarray:
    """The finalizer of a common 64-bit hash: every bit of the input changes about half the output's."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def letters(inside: str | bytes, fold: bool = False) -> np.ndarray:
    """Table of what each byte counts as in a word; 0 separates. `inside` names the ASCII bytes of words; others are."""
    ascii_bytes = set(inside.encode() if isinstance(inside, str) else inside)
    values = np.array([b + 1 if b > 127 or b in ascii_bytes else 0 for b in range(256)], np.uint64)
    if fold:
        values[65:91] = values[97:123]
    return values


def chunks(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most CHUNK bytes together, or one text."""
    sizes = np.r_[0, np.cumsum(np.diff(offsets_of(texts)))]
    start = 0
    while start < len(texts):
        end = max(start + 1, int(np.searchsorted(sizes, sizes[start] + CHUNK, "right")) - 1)
        yield start, end
        start = end


def offsets_of(texts: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else np.int32
    return np.frombuffer(texts.buffers()[1], kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)


def words_of(texts: pa.Array, table: np.ndarray) -> Words:
    """Words of each text; a null text has none."""
    texts = texts.fill_null("")
    at = offsets_of(texts)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[at[0] : at[-1]] if at[-1] > at[0] else np.zeros(0, np.uint8)
    at = at - at[0]
    values = table[data]
    inside = values > 0
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    before = np.r_[False, inside[:-1]] if len(data) else inside
    after = np.r_[inside[1:], False] if len(data) else inside
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    first = np.searchsorted(start, at)
    return Words(slices(rolling(values, LETTERS), start, end), first[:-1], np.diff(first))
