"""Hashed word shingles of a text, with NumPy inside tasks."""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash

WIDTH = 5
BLANK = b" \t\n\x0b\f\r"
IN_WORD = bytes(byte not in BLANK for byte in range(256))


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit over all of them."""
    x = x + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) % 2**64)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def words_in(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the words between ASCII white space start and end in ``data``."""
    word = np.frombuffer(b"\0" + data.translate(IN_WORD) + b"\0", np.int8)
    edges = np.flatnonzero(word[1:] != word[:-1])
    return edges[::2], edges[1::2]


def hashes_of_words(data: bytes, sizes: np.ndarray) -> np.ndarray:
    """``word_hashes`` of the words of ``data``, which have these sizes; equal words are hashed once."""
    ends = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=ends[1:])
    words = pa.Array.from_buffers(pa.large_binary(), len(sizes), [
        None, pa.py_buffer(ends), pa.py_buffer(data.translate(None, BLANK))]).dictionary_encode()
    _, places, held = words.dictionary.buffers()
    places = np.frombuffer(places, np.int64)[:len(words.dictionary) + 1].tolist()
    held = held.to_pybytes() if held else b""
    return word_hashes([held[a:b] for a, b in zip(places, places[1:])])[words.indices.to_numpy()]


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of each ``width`` words in a row, by the place of the first."""
    last = len(hashes) - width + 1
    found = mix(hashes[:last], width)
    for j in range(1, width):
        found = mix(found * np.uint64(0xD6E8FEB86659FD93) + hashes[j:last + j], width)
    return found


def shingles(hashes: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct hashes of all windows of ``width`` words; of all words if there are fewer."""
    return _distinct(windows(hashes, min(width, len(hashes)))) if len(hashes) else hashes


def shingles_of(texts: list[list[bytes]], width: int = WIDTH) -> list[np.ndarray]:
    """``shingles`` of each text, given as words; all are hashed together."""
    hashes = word_hashes([word for words in texts for word in words])
    wide = windows(hashes, width) if len(hashes) >= width else hashes[:0]
    found, start = [], 0
    for end in accumulate(map(len, texts)):
        whole = end - start >= width
        found.append(_distinct(wide[start:end - width + 1]) if whole else shingles(hashes[start:end], width))
        start = end
    return found


def _distinct(values: np.ndarray) -> np.ndarray:
    """``values``, at least one, sorted and once each."""
    values = np.sort(values)
    new = np.ones(len(values), bool)
    np.not_equal(values[1:], values[:-1], out=new[1:])
    return values[new]


def words_of(text: str) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case, other letters as they are."""
    return text.encode().lower().split()
