"""Word shingles of whole texts as 63-bit hashes, worked out on Arrow buffers with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WORDS_PER_SHINGLE = 5
AT_ONCE = 1 << 18


def _random_words(seed: int, n: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE_VALUES = _random_words(11, 256)
_BYTE_VALUES[0x41:0x5B] = _BYTE_VALUES[0x61:0x7B]  # A-Z count as a-z
_BASE = np.uint64(0x9E3779B97F4A7C15)
_PLACES = _random_words(12, 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of unsigned 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column, one after the other, and where each text starts (null: empty)."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return whole[offsets[0]:offsets[-1]], offsets - offsets[0]


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of every word, and how many words come before each text (and in all)."""
    if not len(data):
        return np.zeros(0, dtype=np.uint64), np.zeros(len(offsets), dtype=np.int64)
    space = _SPACE[data]
    first = ~space
    first[1:] &= space[:-1]
    cuts = offsets[:-1][offsets[:-1] < len(data)]
    first[cuts] = ~space[cuts]
    starts = np.flatnonzero(first)
    words_before = np.searchsorted(starts, offsets).astype(np.int64)
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), words_before
    index = np.flatnonzero(~space)
    word = np.cumsum(first)[index] - 1
    place = index - starts[word]
    powers = np.cumprod(np.full(int(place.max()) + 1, _BASE, dtype=np.uint64))
    sums = _BYTE_VALUES[data[index]] * powers[place]
    at = np.searchsorted(index, starts)
    lengths = np.diff(np.append(at, len(index))).astype(np.uint64)
    return mix(np.add.reduceat(sums, at) + lengths), words_before


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """For each text its distinct shingle hashes, ascending.

    A text of fewer words than a shingle has one, the whole of it; a text without words has none. Texts are worked on
    ``AT_ONCE`` bytes at a time, or one by one if they are longer, since that takes some 60 bytes for each of theirs.
    """
    if not len(texts):
        return
    share = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64) // AT_ONCE
    cuts = [0, *(np.flatnonzero(np.diff(share)) + 1).tolist(), len(texts)]
    for start, end in zip(cuts[:-1], cuts[1:], strict=True):
        yield from _shingle_sets(texts.slice(start, end - start))


def _shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    words, before = word_hashes(*text_bytes(texts))
    n = max(0, len(words) - WORDS_PER_SHINGLE + 1)
    rolled = np.zeros(n, dtype=np.uint64)
    for i in range(WORDS_PER_SHINGLE):
        rolled += words[i:i + n] * _PLACES[i]
    rolled = mix(rolled) >> np.uint64(1)
    for start, end in zip(before[:-1], before[1:], strict=True):
        size = end - start
        if size >= WORDS_PER_SHINGLE:
            yield np.unique(rolled[start:end - WORDS_PER_SHINGLE + 1])
        elif size:
            short = (words[start:end] * _PLACES[8:8 + size]).sum(dtype=np.uint64, keepdims=True) + np.uint64(size)
            yield mix(short) >> np.uint64(1)
        else:
            yield np.zeros(0, dtype=np.uint64)
