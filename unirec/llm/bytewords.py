"""Words of a column of texts as positions in its bytes, and hashes of them, in numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = 32
# A-Z to a-z; what is neither a letter, a digit nor beyond ASCII becomes a space.
CONTENT = np.array([b if b >= 128 or chr(b).isalnum() else SPACE for b in range(256)], np.uint8)
CONTENT[65:91] += 32
# A-Z to a-z; tab to carriage return become spaces.
SPACED = np.arange(256, dtype=np.uint8)
SPACED[65:91] += 32
SPACED[9:14] = SPACE

_RANDOM = np.random.default_rng(20240229).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_spans(texts: pa.Array, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(data, begin, end, counts)``: the bytes after ``table``, where each word begins and ends in them, and the
    number of words of each text.  Null texts have none."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = table[np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]]
    offsets = offsets - offsets[0]
    inside = data != SPACE
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    firsts = offsets[:-1][offsets[:-1] < offsets[1:]]
    starts[firsts] = inside[firsts]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    ends[firsts[firsts > 0] - 1] = inside[firsts[firsts > 0] - 1]
    begin, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return data, begin, end, np.diff(np.searchsorted(begin, offsets))


def word_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words: each byte's random number times a power of an odd base, shifted to the word's start."""
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(len(data) + 1, _BASE, np.uint64))
        sums = np.append(np.uint64(0), np.cumsum(_RANDOM[data] * powers[:-1], dtype=np.uint64))
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        back = np.cumprod(np.full(len(data) + 1, inverse, np.uint64))
        return mixed((sums[end] - sums[begin]) * back[begin] + (end - begin).astype(np.uint64))


def shingles(hashes: np.ndarray, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``n`` words and the text each belongs to; a text of fewer words, but not none, is one run."""
    with np.errstate(over="ignore"):
        first = np.cumsum(counts) - counts
        owner = np.repeat(np.arange(len(counts)), counts)
        place = np.arange(len(hashes)) - np.repeat(first, counts)
        left = np.repeat(counts, counts) - place
        padded = np.append(hashes, np.zeros(n, np.uint64))
        total = np.zeros(len(hashes), np.uint64)
        for k in range(n):
            factor = mixed(np.array([k + 1], np.uint64))[0] | np.uint64(1)
            total += np.where(left > k, padded[k:k + len(hashes)], np.uint64(0)) * factor
        used = (left >= n) | (place == 0)
        return mixed(total[used] + np.minimum(left[used], n).astype(np.uint64)), owner[used]


def sequence_digests(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """128 bits per text from its words in order (two columns)."""
    with np.errstate(over="ignore"):
        first = np.cumsum(counts) - counts
        place = (np.arange(len(hashes)) - np.repeat(first, counts)).astype(np.uint64)
        out = np.zeros((len(counts), 2), np.uint64)
        filled = counts > 0
        for k, salt in enumerate((0x5851F42D4C957F2D, 0x14057B7EF767814F)):
            values = mixed(hashes ^ mixed(place + np.uint64(salt)))
            if len(values):
                out[filled, k] = mixed(np.add.reduceat(values, first[filled], dtype=np.uint64) + counts[filled].astype(np.uint64))
        return out
