"""Words, windows and their hashes over whole Arrow batches of texts, without a Python loop over words.

Functions that run inside ``mapInArrow`` use these. A hash is 64 bits: within one document two different
windows share one with a chance of about words^2 / 2^65.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that one step of a task holds in numpy arrays; a longer text is a step of its own.
STEP_BYTES = 1_000_000

MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(MULTIPLIER, -1, 1 << 64)

#: ``[^\x20\x09-\x0D]+`` on UTF-8 bytes.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` on lower-cased UTF-8 bytes: digits, letters and all beyond ASCII.
ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[0x30:0x3A] = ALPHANUMERIC[0x61:0x7B] = ALPHANUMERIC[0x80:] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_powers = {}


def _power_table(base: int, n: int) -> np.ndarray:
    if base not in _powers or len(_powers[base]) < n:
        table = np.full(max(n, STEP_BYTES + 1), base, np.uint64)
        table[0] = 1
        _powers[base] = np.multiply.accumulate(table)
    return _powers[base][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values; one to one."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def steps(batch: pa.RecordBatch, column: str, most: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batch with about ``most`` bytes in ``column``, and one row at least.

    Behind the last one the memory that Arrow keeps for later goes back to the system: workers outlive their tasks.
    """
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    at = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        done = at[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(at, done + most, "right")))
        yield batch.slice(start, end - start)
        start = end
    pa.default_memory_pool().release_unused()


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, and where each begins, with the end last. NULL is an empty text."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


class Words:
    """The words of a column of texts.

    ``starts`` and ``ends`` are byte positions in ``data``; the words of text ``i`` are those from ``first[i]``
    up to ``first[i + 1]``.
    """

    def __init__(self, column: pa.Array, keep: np.ndarray, lower: bool = False):
        self.data, self.offsets = utf8(column)
        if lower:
            self.data = LOWER[self.data]
        inside = keep[self.data]
        edge = np.zeros(len(inside) + 1, bool)
        edge[self.offsets] = True
        begins, finishes = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1] | edge[1:-1]
        finishes[:-1] &= ~inside[1:] | edge[1:-1]
        self.starts, self.ends = np.flatnonzero(begins), np.flatnonzero(finishes) + 1
        self.first = np.searchsorted(self.starts, self.offsets)
        self.counts = np.diff(self.first)

    def __len__(self) -> int:
        return len(self.starts)

    def texts(self) -> np.ndarray:
        """The number of the text that each word is in."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def hashes(self) -> np.ndarray:
        terms = (self.data.astype(np.uint64) + np.uint64(1)) * _power_table(MULTIPLIER, len(self.data))
        sums = np.zeros(len(terms) + 1, np.uint64)
        np.cumsum(terms, out=sums[1:])
        inverse = _power_table(_INVERSE, len(self.data) + 1)
        return mix((sums[self.ends] - sums[self.starts]) * inverse[self.starts])

    def left(self) -> np.ndarray:
        """How many words its text has from each word on, itself included."""
        return np.repeat(self.first[1:], self.counts) - np.arange(len(self))

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i]:self.ends[i]].tobytes()


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each position on; the last ``size - 1`` positions are missing."""
    n = max(0, len(words) - size + 1)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out *= np.uint64(MULTIPLIER)
        out += words[k:k + n]
    return mix(out + np.uint64(size))


def segment_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between the positions in ``first``; 0 for an empty segment."""
    total = np.zeros(len(values) + 1, np.result_type(values.dtype, np.int64) if values.dtype != np.uint64 else np.uint64)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def repeated(keys: np.ndarray) -> np.ndarray:
    """Whether each key occurs twice or more."""
    ordered = np.sort(keys)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
    return twice[at] == keys


def first_of_each(keys: np.ndarray) -> np.ndarray:
    """Whether each key is the first of its value."""
    out = np.ones(len(keys), bool)
    again = np.flatnonzero(repeated(keys))
    if len(again):
        out[again] = False
        out[again[np.unique(keys[again], return_index=True)[1]]] = True
    return out


def per_text(hashes: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """The hashes made different between texts, so that equal ones are of one text."""
    return hashes ^ mix(texts.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019))
