"""Sets of word shingles as sorted 64-bit hashes, in numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

#: Texts whose words are held at once.
_AT_ONCE = 512
_LOWER = bytes(range(256)).lower()
_ODD = np.uint64(0x9E3779B97F4A7C15)


class _Hashes(dict):
    """Places of words in a list of their hashes, each computed once."""

    def __init__(self) -> None:
        self.values: list[int] = []

    def __missing__(self, word: bytes) -> int:
        place = self[word] = len(self.values)
        self.values.append(xxhash.xxh3_64_intdigest(word))
        return place


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its shingles.

    Words are runs without white space (space, tab to carriage return), A-Z lower-cased.
    A text of fewer words than a shingle has one, its whole sequence; without words none.
    """
    hashes, sets = _Hashes(), []
    for start in range(0, len(texts), _AT_ONCE):
        sets += _sets_of(texts.slice(start, _AT_ONCE), width, hashes)
    return sets


def _sets_of(texts: pa.Array, width: int, hashes: _Hashes) -> list[np.ndarray]:
    flat: list[int] = []
    sizes = []
    for text in texts.cast(pa.binary()).to_pylist():
        words = text.translate(_LOWER).split() if text else []
        sizes.append(len(words))
        flat += [hashes[w] for w in words]
    values = _mixed(np.array(hashes.values, np.uint64))[np.array(flat, np.int64)]
    rolled = np.zeros(len(values), np.uint64)
    for k in range(min(width, len(values))):
        full = len(values) - k
        rolled[:full] = rolled[:full] * _ODD + values[k:]
    rolled = _mixed(rolled)
    sets, start = [], 0
    for n in sizes:
        if 0 < n < width:
            short = values[start : start + n]
            whole = np.uint64(xxhash.xxh3_64_intdigest(short.tobytes()))
            sets.append(np.array([whole], np.uint64))
        elif n:
            found = np.sort(rolled[start : start + n - width + 1])
            first = np.empty(len(found), bool)
            first[0] = True
            np.not_equal(found[1:], found[:-1], out=first[1:])
            sets.append(found[first])
        else:
            sets.append(np.empty(0, np.uint64))
        start += n
    return sets


def node_of(keys: np.ndarray) -> int:
    """A signed 64-bit number for a set; equal sets have equal numbers."""
    value = xxhash.xxh3_64_intdigest(keys.tobytes())
    return value - (1 << 64) if value >> 63 else value


def sketch_of(keys: np.ndarray) -> bytes:
    """Counts of a set's hashes by their last bits, four to eight hashes to a count."""
    size = 64
    while size * 8 < len(keys):
        size *= 2
    places = (keys & np.uint64(size - 1)).astype(np.int64)
    return np.minimum(np.bincount(places, minlength=size), 255).astype(np.uint8).tobytes()


def least_distance(a: bytes, n_a: int, b: bytes, n_b: int) -> float:
    """A Jaccard distance that two sets of these sketches and sizes have at least.

    Counts differ by no more than the sets do, also after halves are added up.
    """
    x, y = (np.frombuffer(s, np.uint8).astype(np.int64) for s in (a, b))
    while len(x) > len(y):
        x = x.reshape(2, -1).sum(axis=0)
    while len(y) > len(x):
        y = y.reshape(2, -1).sum(axis=0)
    apart = int(np.abs(x - y).sum())
    return 2 * apart / (n_a + n_b + apart)


def parities_of(keys: np.ndarray) -> bytes:
    """Whether a set has an odd number of hashes with each ending; 8 to 16 bits per hash.

    Two sets differ in at least as many hashes as these bits differ, and in few more.
    """
    size = 512
    while size < 8 * len(keys):
        size *= 2
    counts = np.bincount((keys & np.uint64(size - 1)).astype(np.int64), minlength=size)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()
