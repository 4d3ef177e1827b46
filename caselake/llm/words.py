"""Words of whole Arrow batches at once: where they start and end, and a 64-bit hash of each.

A text without marks, digits or other scripts is bytes in which a word is a run of word
bytes, so numpy finds and hashes the words of a batch without a Python step per word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

SEED = 42
_LANES = 8          # words of up to 64 bytes are hashed eight bytes at a time, longer ones one by one
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32  # only A-Z

SPACED = np.ones(256, dtype=bool)  # words between ASCII white space: [^\x20\x09-\x0D]+
SPACED[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

TERMS = np.zeros(256, dtype=bool)  # runs of ASCII letters and digits and of all beyond ASCII
TERMS[0x30:0x3A] = TERMS[0x41:0x5B] = TERMS[0x61:0x7B] = TERMS[0x80:] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of unsigned 64-bit integers that spreads every bit."""
    x = (x ^ x >> np.uint64(30)) * _MIX[1]
    x = (x ^ x >> np.uint64(27)) * _MIX[2]
    return x ^ x >> np.uint64(31)


def text_bytes(column: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, bounds) of a string column: text i is bytes[bounds[i]:bounds[i + 1]], empty where null.
    Eight zero bytes follow the last text. ``lower``: A-Z are lower-cased."""
    column = column.cast(pa.large_string()).fill_null("")
    bounds = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    size = int(bounds[-1] - bounds[0])
    data = np.zeros(size + 8, dtype=np.uint8)
    if size:
        data[:size] = np.frombuffer(column.buffers()[2], dtype=np.uint8)[bounds[0]:bounds[-1]]
        if lower:
            data = LOWER[data]
    return data, bounds - bounds[0]


def find_words(data: np.ndarray, bounds: np.ndarray, kind: np.ndarray = SPACED) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): the words in order; those of text i are first[i] to first[i + 1] - 1."""
    size = int(bounds[-1])
    inside = kind[data[:size]]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    edge = bounds[(bounds > 0) & (bounds < size)]  # a word never goes on in the next text
    opens[edge] = inside[edge]
    closes[edge - 1] = inside[edge - 1]
    starts = np.flatnonzero(opens)
    return starts, np.flatnonzero(closes) + 1, np.searchsorted(starts, bounds)


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    size = ends - starts
    out = mix(size.astype(np.uint64) + _MIX[0])
    eight = np.ndarray((max(0, data.size - 7),), dtype="<u8", buffer=data, strides=(1,))
    at = np.flatnonzero(size <= 8 * _LANES) if size.size and size.max() > 8 * _LANES else np.arange(size.size)
    for lane in range(_LANES):
        at = at[size[at] > 8 * lane]
        if not at.size:
            break
        left = np.minimum(size[at] - 8 * lane, 8)
        value = eight[starts[at] + 8 * lane] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (64 - 8 * left).astype(np.uint64))
        out[at] = mix((out[at] ^ value) * _MIX[0] + np.uint64(lane + 1))
    for i in np.flatnonzero(size > 8 * _LANES):
        out[i] = xxhash.xxh64_intdigest(data[starts[i]:ends[i]], SEED)
    return out


def hash_word(word: str) -> int:
    """What ``hash_words`` gives for one word."""
    data = np.frombuffer(word.encode("utf-8", "surrogatepass") + bytes(8), dtype=np.uint8)
    return int(hash_words(data, np.zeros(1, np.int64), np.array([data.size - 8]))[0])
