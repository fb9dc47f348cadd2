"""Whole Arrow batches of text as one byte array, with words found and hashed by NumPy.

Words, lines and long stretches are hashed by BLAKE2b, each distinct word of a block once, so no
text makes two of them collide but by chance. Windows of a fixed width are put together from such
hashes by a mix that is not linear. Where only equality inside a block matters, words and lines
get exact numbers from a dictionary instead.

What is as long as the text is a byte or a flag; anything wider is made for a piece of it, or for
its words, so that a long document takes a bounded multiple of its size.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 256 << 10  # text worked on at a time; a longer document is a block of its own
PIECE = 1 << 18  # elements of a sequence for which 64-bit values are held at once
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
OTHER = np.uint64(0xC2B2AE3D27D4EB4F)

WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
NEWLINE = np.zeros(256, bool)
NEWLINE[0x0A] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """Finisher that spreads every bit over all 64."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hashes of two neighbouring windows as those of their union."""
    both = left * GOLDEN
    both ^= right + OTHER
    return mix(both)


def digests(values: Iterable[bytes]) -> np.ndarray:
    """64-bit hashes of byte strings."""
    return np.frombuffer(b"".join([blake2b(v, digest_size=8).digest() for v in values]), "<u8")


def stretch_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of stretches of any length of a sequence."""
    size, data = values.dtype.itemsize, memoryview(np.ascontiguousarray(values)).cast("B")
    pairs = zip((starts * size).tolist(), (ends * size).tolist())
    return digests(data[a:b] for a, b in pairs)


def window_hashes(values: np.ndarray, width: int) -> np.ndarray:
    """Hash of the window of this width that starts at each place, as far as there is one, of
    hashes or of bytes. Windows are put together by doubling."""
    n = len(values) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    rest = None
    if values.dtype == np.uint8:  # eight bytes are one number
        padded = np.concatenate([values, np.zeros(8, np.uint8)])
        eights = np.ndarray(len(values), "<u8", padded, strides=(1,))
        unit, over = 8, width % 8
        if over:
            rest = mix((eights[width - over : width - over + n] & np.uint64((1 << 8 * over) - 1)) ^ OTHER)
        own = mix(eights ^ GOLDEN) if width >= 8 else eights
    else:
        unit, own = 1, values
    done, found, size = 0, None, unit
    while size <= width:
        if width // unit * unit & size:
            part = own[done : done + n]
            found, done = (part if found is None else joined(found, part)), done + size
        size *= 2
        if size <= width:
            own = joined(own[: len(own) - size // 2], own[size // 2 :])
    if rest is not None:
        found = rest if found is None else joined(found, rest)
    return mix(found ^ OTHER)


class Texts:
    """Some whole texts as bytes; a null is an empty text."""

    def __init__(self, column: pa.Array):
        column = pc.fill_null(column, "").cast(pa.large_string())
        _, offsets, data = column.buffers()
        offsets = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
        self.data = (
            np.frombuffer(data, np.uint8, offsets[-1] - offsets[0], offsets[0])
            if data is not None and offsets[-1] > offsets[0]
            else np.empty(0, np.uint8)
        )
        self.offsets = offsets - offsets[0]
        self.rows = len(column)

    def lowered(self) -> Texts:
        """The texts with A-Z in lower case."""
        out = Texts.__new__(Texts)
        out.data, out.offsets, out.rows = LOWER[self.data], self.offsets, self.rows
        return out

    def words(self, separators: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end byte of every word, and the number of words before each text."""
        n = len(self.data)
        bounds = self.offsets[self.offsets < n]
        starts, ends = [], []
        for a in range(0, n, PIECE):
            b = min(a + PIECE, n)
            near = ~separators[self.data[max(a - 1, 0) : min(b + 1, n)]]  # with a neighbour on either side
            if a == 0:
                near = np.concatenate([[False], near])
            if b == n:
                near = np.concatenate([near, [False]])
            inside = near[1:-1]
            begins, stops = inside & ~near[:-2], inside & ~near[2:]
            own = bounds[np.searchsorted(bounds, a) : np.searchsorted(bounds, b + 1)]
            at = own[own < b] - a
            begins[at] = inside[at]
            last = own[own > a] - 1 - a
            stops[last] = inside[last]
            starts.append(np.flatnonzero(begins) + a)
            ends.append(np.flatnonzero(stops) + a + 1)
        none = [np.empty(0, np.int64)]
        starts, ends = np.concatenate(starts or none), np.concatenate(ends or none)
        return starts, ends, np.searchsorted(starts, self.offsets)

    def parts(self, starts: np.ndarray, ends: np.ndarray, separators: np.ndarray = WHITE) -> pa.LargeBinaryArray:
        """The words, or lines, as an array without what separates them."""
        n = len(self.data)
        pieces = (self.data[a : a + PIECE] for a in range(0, n, PIECE))
        kept = np.concatenate([np.empty(0, np.uint8), *(p[~separators[p]] for p in pieces)])
        offsets = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(ends - starts, out=offsets[1:])
        return pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(kept)]
        )

    def word_hashes(self, separators: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray]:
        """Hash of every word, and the number of words before each text."""
        starts, ends, offsets = self.words(separators)
        numbers, distinct = numbered(self.parts(starts, ends, separators))
        return digests(distinct.to_pylist())[numbers], offsets

    def sums(self, flags: np.ndarray) -> np.ndarray:
        """How many bytes of each text are flagged."""
        return spans_sum(flags, self.offsets)

    def hashes(self) -> np.ndarray:
        """Hash of each text."""
        return stretch_hashes(self.data, self.offsets[:-1], self.offsets[1:])


def numbered(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """For each value the number of its like among the distinct ones, and those."""
    found = values.dictionary_encode()
    return found.indices.to_numpy(zero_copy_only=False), found.dictionary


def window_numbers(numbers: np.ndarray, width: int) -> np.ndarray:
    """Exact numbers of windows: equal ones have equal numbers."""
    n = len(numbers) - width + 1
    if n <= 0:
        return np.empty(0, np.int64)
    own, size, found, done = numbers.astype(np.int64), 1, None, 0

    def pairs(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        code = left * (int(right.max()) + 1) + right
        return numbered(pa.array(code))[0].astype(np.int64)

    while size <= width:
        if width & size:
            part = own[done : done + n]
            found, done = (part if found is None else pairs(found, part)), done + size
        size *= 2
        if size <= width:
            own = pairs(own[: len(own) - size // 2], own[size // 2 :])
    return found


def spans_sum(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of the values of each text; the offsets cover all values."""
    out = np.zeros(len(offsets) - 1, np.int64)
    full = np.diff(offsets) > 0
    if full.any():
        out[full] = np.add.reduceat(values, offsets[:-1][full], dtype=np.int64)
    return out


def owners(offsets: np.ndarray) -> np.ndarray:
    """For every element, the number of the text that has it."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def window_starts(offsets: np.ndarray, width: int, first: int = 0, end: int | None = None) -> np.ndarray:
    """Elements, of those from ``first`` to before ``end``, at which a window of this width fits
    into the text."""
    end = int(offsets[-1]) if end is None else end
    low, high = np.clip(offsets[:-1], first, end), np.clip(offsets[1:] - width + 1, first, end)
    fits = high > low
    room = np.zeros(end - first + 1, np.int32)
    np.add.at(room, low[fits] - first, 1)
    np.add.at(room, high[fits] - first, -1)
    return np.flatnonzero(np.cumsum(room[:-1], dtype=np.int32)) + first


def covered(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of n elements lie in any of the stretches."""
    change = np.zeros(n + 1, np.int8)
    if len(starts):
        order = np.argsort(starts, kind="stable")
        starts, ends = starts[order], np.maximum.accumulate(ends[order])
        apart = starts[1:] > ends[:-1]
        change[starts[np.concatenate([[True], apart])]] = 1
        change[ends[np.concatenate([apart, [True]])]] -= 1
    return np.cumsum(change[:n], dtype=np.int8).view(bool)


def repeated(numbers: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which numbers occur twice or more in their own text, and by how many each text exceeds its
    distinct numbers."""
    rows = len(offsets) - 1
    if not len(numbers):
        return np.zeros(0, bool), np.zeros(rows, np.int64)
    owner = owners(offsets)
    own, distinct = numbered(pa.array(owner * (int(numbers.max()) + 1) + numbers))
    times = np.bincount(own)
    holder = distinct.to_numpy() // (int(numbers.max()) + 1)
    return times[own] > 1, np.diff(offsets) - np.bincount(holder, minlength=rows)


def blocks(batch: pa.RecordBatch, column: str, size: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about this many bytes of text; rows are never cut."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths.astype(np.int64))
    at, n = 0, batch.num_rows
    while at < n:
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + size, side="right")))
        yield batch.slice(at, to - at)
        at = to
