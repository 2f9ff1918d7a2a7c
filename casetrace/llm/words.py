"""Words of whole texts as 64-bit hashes, computed on Arrow buffers.

A word is a run of bytes other than ``[\\x20\\x09-\\x0D]``.  All words of a
slice of documents are found and hashed with a handful of array operations,
without a Python object per word.  Two different words share a hash with a
probability of about 2**-64; nothing here checks for that.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
SLICE_BYTES = 2_000_000

_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    global _powers
    if len(_powers[0]) >= n:
        return _powers[0][:n], _powers[1][:n]
    made = []
    for base in (_BASE, _BASE_INVERSE):
        steps = np.full(max(n, 1), base, dtype=np.uint64)
        steps[0] = 1
        made.append(np.cumprod(steps))
    if n <= 4 * SLICE_BYTES:  # a very long text's tables are not kept
        _powers = (made[0], made[1])
    return made[0], made[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (the published SplitMix64 constants)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Slice(NamedTuple):
    """Some neighbouring documents of a batch."""

    first: int            # index of the first document in the batch
    data: np.ndarray      # their UTF-8 bytes, one after the other
    offsets: np.ndarray   # byte offsets, one more than documents


def text_slices(texts: pa.Array, slice_bytes: int = SLICE_BYTES) -> Iterator[Slice]:
    """Cut a string array (null: empty) into slices of about ``slice_bytes``;
    a longer text is a slice of its own, never cut."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    if len(texts) == 0:
        return
    _, ends, body = texts.buffers()
    offsets = np.frombuffer(ends, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + slice_bytes, "right")) - 1
        last = min(max(last, first + 1), len(texts))
        yield Slice(first, data[offsets[first]:offsets[last]],
                    offsets[first:last + 1] - offsets[first])
        first = last


def is_space(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return data + ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32)


def find_words(part: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the index of each document's
    first word (one more entry than documents)."""
    data, offsets = part.data, part.offsets
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    space = is_space(data)
    before = np.empty(n, bool)
    before[0] = True
    before[1:] = space[:-1]
    before[offsets[:-1][offsets[:-1] < n]] = True
    after = np.empty(n, bool)
    after[-1] = True
    after[:-1] = space[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = True
    starts = np.flatnonzero(~space & before)
    ends = np.flatnonzero(~space & after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of data[start:end] for every span."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    power, inverse = _power_tables(len(data))
    running = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power, out=running[1:])
    raw = (running[ends] - running[starts]) * inverse[starts]
    return mix(raw ^ ((ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every window of ``size`` consecutive word hashes."""
    out = np.zeros(len(words) - size + 1, np.uint64)
    for k in range(size):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + words[k:len(words) - size + 1 + k])
    return out
