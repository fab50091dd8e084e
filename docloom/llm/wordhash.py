"""Words of many texts at once, as numpy arrays of hashes.

A batch of texts is laid out as one byte buffer. Words are found by a table of
byte classes, so every rule here must be one on UTF-8 bytes: all bytes of a
non-ASCII character belong to words. A-Z count as a-z. Hashes are polynomial in
the bytes (words) or words (grams) modulo 2^64, mixed at the end, and equal on
every machine.
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa

_BASE, _GRAM, _ONE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), np.uint64(1)
_IDENTITY = np.arange(256, dtype=np.uint8)
LOWERED = np.where((_IDENTITY >= 65) & (_IDENTITY <= 90), _IDENTITY + 32, _IDENTITY).astype(np.uint64)

#: Anything but ASCII white space.
SPACED = ~((_IDENTITY == 0x20) | ((_IDENTITY >= 0x09) & (_IDENTITY <= 0x0D)))
#: ASCII letters and digits, and everything that is not ASCII.
ALNUM = (_IDENTITY >= 0x80) | ((_IDENTITY >= 48) & (_IDENTITY <= 57)) | ((_IDENTITY >= 65) & (_IDENTITY <= 90)) | ((_IDENTITY >= 97) & (_IDENTITY <= 122))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit values (the finalizer of splitmix64)."""
    x = x.copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: Bytes that are hashed at a time, some fifty bytes of memory for each; only a longer word makes a longer block.
BLOCK = 1 << 17
_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse modulo 2^64; kept for blocks of the usual size."""
    if len(_powers[0]) >= n:
        return _powers[0][:n], _powers[1][:n]
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    size, made = max(n, min(2 * n, BLOCK)), []
    for base in (_BASE, inverse):
        steps = np.full(size, base, dtype=np.uint64)
        steps[0] = 1
        made.append(np.cumprod(steps, dtype=np.uint64))
    if size <= 2 * BLOCK:
        _powers[:] = made
    return made[0][:n], made[1][:n]


def block_words(block: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and place of every word of a block of bytes that ends outside a word.

    With prefix sums of byte * base^place, a word's polynomial is the difference
    of two sums, moved to place 0 by the inverse base.
    """
    word = inside[block]
    edges = np.flatnonzero(word[1:] != word[:-1]) + 1
    if len(word) and word[0]:
        edges = np.r_[0, edges]
    first, last = edges[0::2], edges[1::2]
    up, down = powers(len(block))
    sums = np.empty(len(block) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum((LOWERED[block] + _ONE) * up, dtype=np.uint64, out=sums[1:])
    return mixed((sums[last] - sums[first]) * down[first] + (last - first).astype(np.uint64)), first


def words(texts: list[bytes], inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of every text, and the number of words in each text. Beside the texts themselves memory grows with the number of words only."""
    joined = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts)))
    hashes, firsts, at = [], [], 0
    while at < len(joined):
        end = min(at + BLOCK, len(joined))
        while inside[joined[end - 1]]:  # on to the end of the word that the block would cut; the last byte is in none
            out = np.flatnonzero(~inside[joined[end : end + BLOCK]])
            end = end + int(out[0]) + 1 if len(out) else end + BLOCK
        h, first = block_words(joined[at:end], inside)
        hashes.append(h)
        firsts.append(first + at)
        at = end
    counts = np.diff(np.searchsorted(np.concatenate(firsts), ends, side="left"), prepend=0)
    return np.concatenate(hashes), counts


def grams(hashes: np.ndarray, counts: np.ndarray, size: int, factor: np.uint64 = _GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all runs of size words within a text: hash, text, place of its first word in the text. Other factors give independent hashes."""
    starts = np.cumsum(counts) - counts
    owner = np.repeat(np.arange(len(counts)), np.maximum(counts - size + 1, 0))
    many = np.maximum(counts - size + 1, 0)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)
    at = starts[owner] + place
    h = np.zeros(len(at), dtype=np.uint64)
    for k in range(size):
        h = h * factor + hashes[at + k]
    return mixed(h + np.uint64(size)), owner, place


def release() -> None:
    """Hands freed memory back to the system; Python workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def byte_strings(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column; null counts as empty."""
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]


def batches(columns, rows: int, most_bytes: int = 1_000_000):
    """Cuts the rows of a list of byte strings into runs of at most most_bytes (a longer text stands alone)."""
    start = total = 0
    for i in range(rows):
        size = len(columns[i])
        if total and total + size > most_bytes:
            yield start, i
            start, total = i, 0
        total += size
    if rows > start:
        yield start, rows
