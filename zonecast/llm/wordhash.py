"""Word hashes of many texts at once, with numpy on the Arrow buffers.

A word's hash is a polynomial of its bytes' random 64-bit values, finished by
a mixer that also takes its length: equal words have equal hashes everywhere,
different ones differ but for a chance of about 2 ** -64.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
_BASE = U(0x9E3779B97F4A7C15)


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit mixer (splitmix64), salted."""
    x = x + U((salt * 0xD1B54A32D192ED03 + 0x9E3779B97F4A7C15) % 2 ** 64)
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


@cache
def _bytes(lower: bool) -> tuple[np.ndarray, np.ndarray]:
    space = np.zeros(256, bool)
    space[[32, 9, 10, 11, 12, 13]] = True
    value = mix(np.arange(256, dtype=U), 77)
    if lower:
        value[65:91] = value[97:123]
    value[space] = 0
    return space, value


@dataclass
class Words:
    """The words of texts laid end to end: byte ranges in ``data``, text and hash of each; text t has first[t]:first[t + 1]."""
    data: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    text: np.ndarray
    first: np.ndarray
    hash: np.ndarray


def words_of(texts: pa.Array, lower: bool = False) -> Words:
    """Words (runs of anything but ASCII white space) of an array of strings; null as empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0]:offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    space, value = _bytes(lower)
    visible = ~space[data]
    edge = np.zeros(len(data) + 1, bool)                     # a text begins here, or all end
    edge[offsets] = True
    begin = np.flatnonzero(visible & (edge[:-1] | np.concatenate([[True], ~visible[:-1]])[:len(data)]))
    end = np.flatnonzero(visible & (edge[1:] | np.concatenate([~visible[1:], [True]])[:len(data)])) + 1
    first = np.searchsorted(begin, offsets)
    text = np.repeat(np.arange(len(texts)), np.diff(first))
    if not len(begin):
        return Words(data, begin, end, text, first, np.zeros(0, U))
    size = end - begin
    power = np.cumprod(np.full(int(size.max()), _BASE, U))
    place = np.arange(begin[0], len(data)) - np.repeat(begin, np.diff(np.append(begin, len(data))))
    term = value.take(data[begin[0]:])
    term *= power.take(place, mode="clip")
    h = mix(np.add.reduceat(term, begin - begin[0]) + size.astype(U) * _BASE)
    return Words(data, begin, end, text, first, h)


def windows(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, hash) of each window of ``size`` words inside one text.

    Hashes of 1, 2, 4, ... words are combined to the size's binary parts.
    """
    n = len(w.hash) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, U)
    part, span, taken, h = w.hash, 1, 0, None
    while True:
        if size & span:
            piece = part[taken:taken + n]
            h = piece if h is None else mix(h * _BASE + piece)
            taken += span
        if 2 * span > size:
            break
        part, span = mix(part[:-span] * _BASE + part[span:], span), 2 * span
    at = np.flatnonzero(w.text[:n] == w.text[size - 1:])
    return at, h[at]


def least(values: np.ndarray, size: int) -> np.ndarray:
    """Place of the (leftmost) smallest of each ``size`` values in a row."""
    best, place, span = values, np.arange(len(values)), 1
    while span < size:
        step = min(span, size - span)
        later = best[step:] < best[:-step]
        best, place = np.where(later, best[step:], best[:-step]), np.where(later, place[step:], place[:-step])
        span += step
    return place


def slices(batch: pa.RecordBatch, column: int, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with at most ``most`` bytes in a string column (one row at least)."""
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    upto, begin = np.cumsum(size), 0
    while begin < batch.num_rows:
        base = upto[begin - 1] if begin else 0
        stop = max(begin + 1, int(np.searchsorted(upto, base + most, "right")))
        yield batch.slice(begin, stop - begin)
        begin = stop
