"""Words of a batch of texts as 64-bit hashes, without a Python loop over words.

A batch is the byte buffer of an Arrow string column and its offsets.  A word is
read eight bytes at a time and its hash is mixed after each of these steps; long
words go through xxh3.  Equal words get equal hashes on every executor.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

_STEP = np.uint64(0x9E3779B97F4A7C15)
#: Bytes up to which a word is read by steps.
BY_STEPS = 32

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: Words are what white space (blank, tab to carriage return) leaves.
SPACED = np.ones(256, bool)
SPACED[[32, 9, 10, 11, 12, 13]] = False
#: Words are runs of ASCII letters and digits and of all bytes beyond ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True

CHUNK = 1 << 18


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(chars: np.ndarray, begin: np.ndarray, lengths: np.ndarray, key: int = 0) -> np.ndarray:
    """The hash of each word, given its first byte and its length; bytes in small form.

    Without the ``key`` nobody can tell which words have one hash.
    """
    padded = np.append(chars, np.zeros(8, np.uint8))
    eight = np.ndarray(len(chars) + 1, "<u8", padded, strides=(1,))
    h = lengths.astype(np.uint64) * _STEP
    if key:
        h = mix(h + np.uint64(key))
    at = np.arange(len(begin))
    for done in range(0, BY_STEPS, 8):
        at = at[lengths[at] > done]
        if not len(at):
            break
        left = np.minimum(lengths[at] - done, 8).astype(np.uint64)
        own = eight[begin[at] + done] & (~np.uint64(0) >> (np.uint64(64) - np.uint64(8) * left))
        h[at] = mix((h[at] ^ own) * _STEP)
    for i in np.flatnonzero(lengths > BY_STEPS):
        h[i] = xxhash.xxh3_64_intdigest(chars[begin[i] : begin[i] + lengths[i]].tobytes(), key)
    return h


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null texts are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("") if column.null_count else column
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def words(data: np.ndarray, off: np.ndarray, is_word: np.ndarray, key: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and for each text the index of its first word (one more at the end)."""
    at = is_word[data]
    before = np.zeros(len(data), bool)
    before[1:] = at[:-1]
    before[off[:-1][off[:-1] < len(data)]] = False
    start = at & ~before
    first = np.zeros(len(off), np.int64)
    begun = np.cumsum(start)
    inside = off > 0
    first[inside] = begun[off[inside] - 1]
    n = int(begun[-1]) if len(begun) else 0
    if not n:
        return np.zeros(0, np.uint64), first
    chars = _LOWER[data[at]]
    begin = np.flatnonzero(start[at])
    lengths = np.diff(np.append(begin, len(chars)))
    return word_hashes(chars, begin, lengths, key), first


def chunks(off: np.ndarray):
    """Ranges of texts of about CHUNK bytes; a longer text is a range of its own."""
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + CHUNK, side="right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)
