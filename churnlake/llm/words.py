"""Words of Arrow text columns as 64-bit hashes, whole columns at a time in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Bytes of words that white space (blank, tab to carriage return) separates.
SPACED = np.ones(256, bool)
SPACED[[32, *range(9, 14)]] = False
#: Bytes of words of digits, letters and all that is not ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True
_CHUNK = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits all depend on all input bits."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


# Random values of (place in the word, byte) for the first places; further ones are mixed.
_PLACES = 48
with np.errstate(over="ignore"):
    _TABLE = mix(np.arange(_PLACES * 256, dtype=U) * U(0x9E3779B97F4A7C15) + U(1))


def _chunk(data: np.ndarray, ends: np.ndarray, is_word: np.ndarray):
    """Hashes of the words in ``data``, the number of words up to each text's end, and spans.

    Spans are the lower-cased bytes, and each word's first byte and length in them.
    """
    low = _LOWER[data]
    inside = is_word[low]
    cut = np.zeros(len(data) + 1, bool)
    cut[ends] = True
    cut[0] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | cut[1:-1]
    starts = np.flatnonzero(begins)
    if not len(starts):
        none = np.empty(0, np.int64)
        return np.empty(0, U), np.zeros(len(ends), np.int64), (low, none, none)
    word = np.cumsum(begins) - 1
    place = np.arange(len(data)) - starts[np.maximum(word, 0)]
    if place.max() < _PLACES:
        value = _TABLE[place * 256 + low]
    else:
        value = _TABLE[np.minimum(place, _PLACES - 1) * 256 + low]
        far = np.flatnonzero(place >= _PLACES)
        value[far] = mix((place[far].astype(U) * U(256) + low[far]) * U(0x9E3779B97F4A7C15) + U(1))
    value[~inside] = 0
    hashes = mix(np.add.reduceat(value, starts))
    lengths = np.add.reduceat(inside, starts, dtype=np.int64)
    return hashes, np.searchsorted(starts, ends), (low, starts, lengths)


def word_hashes(texts: pa.Array, is_word: np.ndarray = SPACED
                ) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Yield (first row, hashes, word count up to each row's end) for runs of rows."""
    for row, hashes, ends, _ in word_spans(texts, is_word):
        yield row, hashes, ends


def word_spans(texts: pa.Array, is_word: np.ndarray = SPACED) -> Iterator[tuple]:
    """Yield (first row, hashes, word count up to each row's end, spans) for runs of rows.

    Upper-case ASCII letters count as lower-case; nulls have no words. A run has about a
    megabyte of text, or one longer text.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:
                                                          texts.offset + len(texts) + 1]
    whole = texts.buffers()[2]
    data = np.frombuffer(whole, np.uint8) if whole is not None else np.empty(0, np.uint8)
    row = 0
    with np.errstate(over="ignore"):
        while row < len(texts):
            stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + _CHUNK)))
            stop = min(stop, len(texts))
            part = data[offsets[row]:offsets[stop]]
            yield (row, *_chunk(part, offsets[row + 1:stop + 1] - offsets[row], is_word))
            row = stop


def shingle_hashes(hashes: np.ndarray, ends: np.ndarray, words: int = 5
                   ) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted shingle hashes of each text, flat, and the number up to each's end.

    A text of fewer words than a shingle has one of all its words; one of none has none.
    """
    with np.errstate(over="ignore"):
        n = len(hashes)
        counts = np.diff(ends, prepend=0)
        owner = np.repeat(np.arange(len(ends)), counts)
        runs = np.zeros(max(0, n - words + 1), U)
        for k in range(words):
            runs += mix(hashes[k:n - words + 1 + k] + U(k + 1) * U(0x9E3779B97F4A7C15))
        runs = mix(runs)
        good = owner[:len(runs)] == owner[words - 1:] if len(runs) else np.zeros(0, bool)
        of, value = owner[:len(runs)][good], runs[good]
        short = np.flatnonzero((counts > 0) & (counts < words))
        if len(short):
            lone = np.zeros(len(short), U)
            for k in range(words - 1):
                has = counts[short] > k
                at = (ends[short] - counts[short] + k)[has]
                lone[has] += mix(hashes[at] + U(k + 1) * U(0x9E3779B97F4A7C15))
            of = np.concatenate([of, short])
            value = np.concatenate([value, mix(lone + counts[short].astype(U))])
        order = np.lexsort((value, of))
        of, value = of[order], value[order]
        fresh = np.ones(len(of), bool)
        fresh[1:] = (of[1:] != of[:-1]) | (value[1:] != value[:-1])
        of, value = of[fresh], value[fresh]
        return value, np.searchsorted(of, np.arange(len(ends)), side="right")
