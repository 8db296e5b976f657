"""Periodic runs of words: minimizers at several scales seed them, lag scans find those of short periods.

A run is a stretch of words with smallest period q that no neighbouring word extends, ``TIMES * q`` words long or
more and ``LEAST`` at least. Periods up to ``LEAST // TIMES`` are found by direct scans: words equal to the word q
before them. Longer ones are taken scale by scale. A scale looks for periods q from ``low`` to ``high``:

* Its k-grams have ``high`` words, so in a run no two of them are equal but those a multiple of q apart (equal ones
  closer together would give the run a smaller period).
* A run has ``TIMES * q`` words, so ``(TIMES - 1) * q - high + 1`` or more k-grams in a row have an equal one q later.
  A window of as many k-grams for ``q = low`` fits in. Its leftmost least hash is a minimizer, and so is its image q
  later, and there is no equal minimizer between them.

So each run has a pair of neighbouring equal minimizers exactly q apart. Each such pair with a distance of the scale is
a seed. It is extended to both sides as far as words repeat, by binary search over hashes of prefixes, and a stretch
that is long enough is compared word by word before it counts. A stretch found with several periods has the smallest.
A text takes steps in proportion to its words times the number of scales, whatever it repeats.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txn_analytics.llm.words import MULTIPLIER, NOT_SPACE, Words, mix, steps

LEAST = 24         # words of the shortest run
TIMES = 3          # periods of the shortest run
SCALE = 1.5        # longest by shortest period of a scale, below 2

_INVERSE = pow(MULTIPLIER, -1, 1 << 64)


def scales(longest: int) -> list[tuple[int, int]]:
    """(low, high) periods of each scale, up to ``longest``."""
    out, low = [], LEAST // TIMES + 1
    while low <= longest:
        out.append((low, int(low * SCALE)))
        low = out[-1][1] + 1
    return out


class Prefixes:
    """Sums over the words up to each place, from which the hash of any stretch follows."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        self.inverse = np.full(n + 1, _INVERSE, np.uint64)
        power = np.full(n, MULTIPLIER, np.uint64)
        self.inverse[:1] = power[:1] = 1
        self.inverse = np.multiply.accumulate(self.inverse)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(words * np.multiply.accumulate(power), out=self.sums[1:])

    def hashes(self, start: np.ndarray, size) -> np.ndarray:
        return (self.sums[start + size] - self.sums[start]) * self.inverse[start]


def _minimizers(hashes: np.ndarray, window: int) -> np.ndarray:
    """Places of the leftmost least hash of every ``window`` hashes in a row."""
    n = len(hashes) - window + 1
    # Least of 1, 2, 4, ... in a row, and of two such stretches that overlap; the leftmost of equals wins.
    at, size = np.arange(len(hashes), dtype=np.int64), 1
    while 2 * size <= window:
        left, right = at[:-size], at[size:]
        at = np.where(hashes[right] < hashes[left], right, left)
        size *= 2
    left, right = at[:n], at[window - size:window - size + n]
    at = np.where(hashes[right] < hashes[left], right, left)
    return at[np.r_[True, at[1:] != at[:-1]]]


def _seeds(low: int, high: int, prefixes: Prefixes, first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, distance) of neighbouring equal minimizers ``low`` to ``high`` words apart, in texts that can hold a run."""
    window = (TIMES - 1) * low - high + 1
    long = np.flatnonzero(count >= TIMES * low)
    grams = np.maximum(count[long] - high + 1, 0)
    long, grams = long[grams >= window], grams[grams >= window]
    if not len(long):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    before = np.cumsum(grams) - grams
    place = np.repeat(first[long] - before, grams) + np.arange(grams.sum())
    owner = np.repeat(np.arange(len(long)), grams)
    hashes = mix(prefixes.hashes(place, high))
    # Windows that reach into the next text only give more minimizers.
    at = np.unique(_minimizers(hashes, window))
    order = at[np.lexsort((at, hashes[at], owner[at]))]
    same = (hashes[order[1:]] == hashes[order[:-1]]) & (owner[order[1:]] == owner[order[:-1]])
    start, distance = order[:-1][same], np.diff(order)[same]
    fits = (distance >= low) & (distance <= high)
    return place[start[fits]], distance[fits]


def _reach(prefixes: Prefixes, start: np.ndarray, lag: np.ndarray, most: np.ndarray, step: int) -> np.ndarray:
    """How many words from ``start`` on (backwards, before it, if ``step`` is -1) equal those ``lag`` later, up to ``most``."""
    low, high = np.zeros(len(start), np.int64), most.copy()
    while np.any(low < high):
        middle = (low + high + 1) // 2
        begin = start if step > 0 else start - middle
        same = prefixes.hashes(begin, middle) == prefixes.hashes(begin + lag, middle)
        low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
    return low


def _short(words: np.ndarray, ends: np.ndarray, lag: int) -> tuple[np.ndarray, np.ndarray]:
    """Stretches with period ``lag``: start and length of those that are long enough."""
    if len(words) <= lag:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    equal = (words[lag:] == words[:-lag]) & (ends[:-lag] == ends[lag:])
    edge = np.flatnonzero(np.diff(np.r_[False, equal, False].astype(np.int8)))
    start, size = edge[::2], edge[1::2] - edge[::2] + lag
    long = size >= max(LEAST, TIMES * lag)
    return start[long], size[long]


def runs(words: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All runs in texts of ``count`` words, whose hashes ``words`` are: text, start in it, length and period.

    They are in order of text, start and period.
    """
    first = np.cumsum(count) - count
    owner = np.repeat(np.arange(len(count)), count)
    prefixes = Prefixes(words)
    found = []
    for lag in range(1, LEAST // TIMES + 1):
        start, size = _short(words, owner, lag)
        found.append((start, size, np.full(len(start), lag, np.int64)))
    for low, high in scales(int(count.max(initial=0)) // TIMES):
        start, lag = _seeds(low, high, prefixes, first, count)
        text = owner[start]
        left = _reach(prefixes, start, lag, start - first[text], -1)
        right = _reach(prefixes, start, lag, first[text] + count[text] - lag - start, 1)
        size = left + right + lag
        long = size >= np.maximum(LEAST, TIMES * lag)
        found.append((start[long] - left[long], size[long], lag[long]))
    start, size, lag = (np.concatenate([x[k] for x in found]) for k in range(3))
    # Of one stretch the smallest period comes first.
    order = np.lexsort((lag, size, start))
    start, size, lag = start[order], size[order], lag[order]
    new = np.r_[True, (start[1:] != start[:-1]) | (size[1:] != size[:-1])][:len(start)]
    start, size, lag = start[new], size[new], lag[new]
    sure = np.array([np.array_equal(words[s:s + n - q], words[s + q:s + n]) for s, n, q in zip(start, size, lag)], bool)
    start, size, lag = start[sure], size[sure], lag[sure]
    order = np.lexsort((lag, start))
    start, size, lag = start[order], size[order], lag[order]
    text = owner[start]
    return text, start - first[text], size, lag


def kept_words(count: np.ndarray, text: np.ndarray, start: np.ndarray, size: np.ndarray, lag: np.ndarray) -> np.ndarray:
    """Whether each word is in no run, or in the first period of every run that it is in."""
    first = np.cumsum(count) - count
    cover = np.zeros(int(count.sum()) + 1, np.int64)
    np.add.at(cover, first[text] + start + lag, 1)
    np.add.at(cover, first[text] + start + size, -1)
    return np.cumsum(cover[:-1]) == 0


def _joined(words: Words, keep: np.ndarray) -> pa.Array:
    """The words that stay, one space between them, as one text each."""
    starts, size = words.starts[keep], (words.ends - words.starts)[keep] + 1
    total = np.r_[0, np.cumsum(size)]
    out = np.full(int(total[-1]), 0x20, np.uint8)
    place = np.repeat(starts - total[:-1], size) + np.arange(total[-1])
    inside = np.ones(len(out), bool)
    inside[total[1:] - 1] = False
    out[inside] = words.data[place[inside]]
    first = np.r_[0, np.cumsum(keep)][words.first]
    begin, end = total[first[:-1]], np.maximum(total[first[1:]] - 1, total[first[:-1]])
    # The space behind the last word of a text is left out.
    last = np.ones(len(out), bool)
    last[total[first[1:]][first[1:] > first[:-1]] - 1] = False
    offsets = np.r_[0, np.cumsum(end - begin)]
    return pa.LargeStringArray.from_buffers(len(words.counts), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(out[last].tobytes()))


def periodic_runs(docs: DataFrame, columns: list[str], text: str = "text") -> DataFrame:
    """``columns`` of each document with ``runs`` (start, length and period of each, in words) and ``collapsed``.

    ``collapsed`` is the text without the words that a run repeats after its first period, the others joined by one
    space. A NULL or empty text has no words: no runs, an empty ``collapsed``. Rows are judged one by one, repeated ones
    alike; an empty table gives no rows. The words of one text are in memory together, however long it is. ``columns``
    may be any but the added names; other columns are not read.
    """
    read = docs.select(*columns, F.col(text).alias("_text"))
    kept = [f for f in read.schema.fields if f.name != "_text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in steps(whole, "_text")):
            words = Words(batch.column("_text"), NOT_SPACE)
            owner, start, size, lag = runs(words.hashes(), words.counts)
            keep = kept_words(words.counts, owner, start, size, lag)
            structs = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, size, lag)], ["start", "length", "period"])
            lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(len(words.counts) + 1)), pa.int32()), structs)
            yield pa.RecordBatch.from_arrays(
                [batch.column(f.name) for f in kept] + [lists, _joined(words, keep).cast(pa.string())],
                [f.name for f in kept] + ["runs", "collapsed"])
    return read.mapInArrow(run, ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in kept]
        + ["runs array<struct<start:bigint,length:bigint,period:bigint>>", "collapsed string"]))


def strongest(runs_column: str = "runs") -> Column:
    """The run with the greatest length by period, exactly; of equal ones the one with the smallest start, then period."""
    return F.expr(f"""aggregate(`{runs_column}`, cast(NULL AS struct<start:bigint,length:bigint,period:bigint>),
        (best, r) -> CASE WHEN best IS NULL OR r.length * best.period > best.length * r.period THEN r ELSE best END)""")
