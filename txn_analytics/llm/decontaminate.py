"""Benchmark decontamination: a broadcast hash set of test n-grams, scanned over the words of the training texts.

Words are runs of digits, letters and characters beyond ASCII, with A-Z lower-cased. A window is ``size``
consecutive words of an item; an item with fewer words, but not none, is one window. The windows of a block of
items are broadcast; each document window whose hash is in the set is compared word by word before it counts.
Documents are never shuffled. A benchmark of more than one block is scanned block after block, with the rows written
in between.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from txn_analytics.cluster import saved
from txn_analytics.llm.words import ALPHANUMERIC, Words, segment_sums, steps, window_hashes

WINDOW = 10
#: Bytes of item text in one broadcast set. A larger benchmark is scanned in several blocks. The set of a block takes
#: about 4.6 times that in every worker (measured: 73 MB for 16 MB of text), and building it some 50 times on the driver.
BLOCK_BYTES = 8_000_000

SPANS = "array<struct<start:bigint,end:bigint>>"
_FILTER_BITS = 20


def normalised(text: str | None) -> list[bytes]:
    """The words of one text."""
    words = Words(pa.array([text], pa.string()), ALPHANUMERIC, lower=True)
    return [words.word(i) for i in range(len(words))]


class NgramSet:
    """Windows of a block of items, as flat arrays.

    The words of all items lie in one byte array. For each number of words there are the sorted hashes of the
    windows, and beside each its first word and the number of its item; a window that an item repeats is held
    once. That is about 33 bytes a word beside the text. Equal hashes of two different windows of one item, at a
    chance of about words^2 / 2^65, would hide the later one.
    """

    def __init__(self, items: list[tuple[object, str]], size: int = WINDOW):
        self.ids = [item for item, _ in items]
        words = Words(pa.array([text for _, text in items], pa.large_string()), ALPHANUMERIC, lower=True)
        self.data, self.starts, self.ends = words.data.tobytes(), words.starts.astype(np.int32), words.ends.astype(np.int32)
        of_word, left, texts = words.hashes(), words.left(), words.texts()
        least = np.minimum(words.counts, size)
        self.windows: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        self.filters: dict[int, np.ndarray] = {}
        for n in np.unique(least[least > 0]).tolist():
            at = np.flatnonzero((least[texts] == n) & (left >= n)).astype(np.int32)
            hashes, item = window_hashes(of_word, n)[at], texts[at].astype(np.int32)
            order = np.lexsort((at, item, hashes))
            hashes, at, item = hashes[order], at[order], item[order]
            new = np.ones(len(at), bool)
            new[1:] = (hashes[1:] != hashes[:-1]) | (item[1:] != item[:-1])
            self.windows[n] = hashes[new], at[new], item[new]
            self.filters[n] = np.zeros(1 << _FILTER_BITS, bool)
            self.filters[n][hashes >> np.uint64(64 - _FILTER_BITS)] = True

    def _words(self, first: int, n: int) -> list[bytes]:
        return [self.data[a:b] for a, b in zip(self.starts[first:first + n].tolist(), self.ends[first:first + n].tolist())]

    def occurrences(self, words: Words) -> Iterator[tuple[int, int, list]]:
        """First word, number of words and items of each window that occurs, verified on the words themselves."""
        of_word, left = words.hashes(), words.left()
        for n, (hashes, first, item) in self.windows.items():
            found = window_hashes(of_word, n)
            at = np.flatnonzero(self.filters[n][found >> np.uint64(64 - _FILTER_BITS)])
            at = at[left[at] >= n]
            low = np.searchsorted(hashes, found[at], "left")
            high = np.searchsorted(hashes, found[at], "right")
            held: dict[int, tuple[list[bytes], list]] = {}
            for i, a, b in zip(*(x[high > low].tolist() for x in (at, low, high))):
                own = [words.word(k) for k in range(i, i + n)]
                if a not in held or held[a][0] != own:
                    held[a] = own, [self.ids[item[k]] for k in range(a, b) if self._words(first[k], n) == own]
                if held[a][1]:
                    yield i, n, held[a][1]


def _scan(held: Broadcast, name: str, item_type: DataType):
    """Adds what the items of the block hit to what earlier blocks hit."""
    item_list = pa.list_(to_arrow_type(item_type))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = held.value
        for batch in (part for whole in batches for part in steps(whole, name)):
            words = Words(batch.column(name), ALPHANUMERIC, lower=True)
            hit = np.zeros(len(words) + 1, np.int64)
            items = [set(x or ()) for x in batch.column("hit_items").to_pylist()]
            for i, spans in enumerate(batch.column("hit_words").to_pylist()):
                for span in spans or ():
                    hit[words.first[i] + span["start"]] += 1
                    hit[words.first[i] + span["end"]] -= 1
            found = list(block.occurrences(words))
            if found:
                at, n = np.array([x[0] for x in found]), np.array([x[1] for x in found])
                np.add.at(hit, at, 1)
                np.add.at(hit, at + n, -1)
                for i, (_, _, ids) in zip(np.searchsorted(words.first, at, "right") - 1, found):
                    items[i].update(ids)
            inside = np.cumsum(hit[:-1]) > 0
            spans, flank = [], np.diff(np.r_[0, inside.astype(np.int8), 0])
            # A run of hit words ends where its text ends.
            cut = words.first[1:-1][(words.first[1:-1] > 0) & (words.first[1:-1] < len(words))]
            begins = np.union1d(np.flatnonzero(flank > 0), cut[inside[cut]] if len(cut) else cut)
            ends = np.union1d(np.flatnonzero(flank < 0), cut[inside[cut - 1]] if len(cut) else cut)
            first = np.searchsorted(begins, words.first)
            for i in range(batch.num_rows):
                own = slice(first[i], first[i + 1])
                base = words.first[i]
                spans.append([{"start": s - base, "end": e - base} for s, e in zip(begins[own].tolist(), ends[own].tolist())])
            kept = [name for name in batch.schema.names if name not in _ADDED]
            yield pa.RecordBatch.from_arrays(
                [batch.column(name) for name in kept] + [
                    pa.array(words.counts, pa.int64()), pa.array(segment_sums(inside, words.first), pa.int64()),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                    pa.array([sorted(x) for x in items], item_list)],
                kept + _ADDED)
    return scan


_ADDED = ["n_words", "n_hit", "hit_words", "hit_items"]


def _blocks(benchmark: DataFrame, item: str, text: str, most: int) -> Iterator[list[tuple[object, str]]]:
    """The items in blocks of about ``most`` bytes of text, one empty block if there are none.

    One block is on the driver at a time; an item is never cut, so the longest one is a bound too.
    """
    block, size = [], 0
    rows = benchmark.select(F.col(item), F.col(text)).filter(F.col(text).isNotNull() & F.col(item).isNotNull()).distinct()
    for row in rows.toLocalIterator():
        own = len(row[1].encode())
        if block and size + own > most:
            yield block
            block, size = [], 0
        block.append((row[0], row[1]))
        size += own
    yield block


def _through(docs: DataFrame, benchmark: DataFrame, item: str, text: str, size: int, most: int, step) -> DataFrame:
    """``step(docs, broadcast set)`` for each block of items in turn.

    With more than one block the rows are written between them, so that no stage holds two sets.
    """
    context, last = docs.sparkSession.sparkContext, None
    for block in _blocks(benchmark, item, text, most):
        if last is not None:
            docs = saved(step(docs, last), "scanned")
        last = context.broadcast(NgramSet(block, size))
    return step(docs, last)


def contamination(docs: DataFrame, benchmark: DataFrame, columns: list[str], text: str = "text", item: str = "item_id",
                  item_text: str = "text", size: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``columns`` of each document with what the benchmark hits in it.

    Adds n_words; n_hit, the words inside any occurrence of a window; hit_words, the runs of them as word numbers
    (end exclusive); hit_items, the sorted ids of items with an occurring window, of the type of the item column. A
    NULL or empty text has no words and no hits; NULL items and items without words are never hit; repeated rows are
    judged alike, an item id with two texts has the windows of both. An empty benchmark hits nothing; an empty table
    gives no rows. A text of any length is scanned whole, in one piece. ``columns`` may be any but these names.
    """
    own = [] if text in columns else [F.col(text).alias("_text")]     # a text that is kept is not sent twice
    name, item_type = "_text" if own else text, benchmark.schema[item].dataType
    items = f"array<{item_type.simpleString()}>"
    read = docs.select(*columns, *own, F.lit(None).cast(SPANS).alias("hit_words"), F.lit(None).cast(items).alias("hit_items"))
    types = {f.name: f.dataType.simpleString() for f in read.schema.fields}
    kept = [name for name in read.columns if name not in _ADDED]
    schema = ", ".join([f"`{name}` {types[name]}" for name in kept] + [
        "n_words bigint", "n_hit bigint", f"hit_words {SPANS}", f"hit_items {items}"])
    return _through(read, benchmark, item, item_text, size, block_bytes,
                    lambda rows, held: rows.mapInArrow(_scan(held, name, item_type), schema)).drop("_text")


def remove_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", size: int = WINDOW,
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents with hit words cut from their texts, from the first to the last of each run.

    What a cut joins is scanned again, until no window of any block is left: with several blocks the pass over all
    of them is repeated until it finds nothing. Texts without a hit stay as they are, NULL and empty ones too, and
    so do all other columns, whatever their names. An empty benchmark cuts nothing; an empty table gives no rows.
    """
    schema = docs.schema
    while True:
        blocks = 0

        def cut(rows: DataFrame, held: Broadcast) -> DataFrame:
            nonlocal blocks
            blocks += 1
            return rows.mapInArrow(_cut(held, text), schema)
        docs = _through(docs, benchmark, "item_id", "text", size, block_bytes, cut)
        if blocks == 1:
            return docs
        docs = saved(docs, "cut")
        rest = contamination(docs.select(F.col(text).alias("_scanned")), benchmark, ["_scanned"], "_scanned", size=size,
                             block_bytes=block_bytes)
        if rest.filter("n_hit > 0").isEmpty():
            return docs


def _cut(held: Broadcast, name: str):
    def clean(block: NgramSet, value: str) -> str:
        while True:
            words = Words(pa.array([value], pa.string()), ALPHANUMERIC, lower=True)
            raw, kept, done = value.encode(), [], 0
            spans = sorted((int(words.starts[i]), int(words.ends[i + n - 1])) for i, n, _ in block.occurrences(words))
            if not spans:
                return value
            for start, end in spans:
                kept.append(raw[done:max(start, done)])
                done = max(done, end)
            value = b"".join([*kept, raw[done:]]).decode()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = held.value
        for batch in (part for whole in batches for part in steps(whole, name)):
            at = batch.schema.get_field_index(name)
            words = Words(batch.column(at), ALPHANUMERIC, lower=True)
            hit = {int(np.searchsorted(words.first, i, "right") - 1) for i, _, _ in block.occurrences(words)}
            if hit:
                values = batch.column(at).to_pylist()
                for i in hit:
                    values[i] = clean(block, values[i])
                batch = batch.set_column(at, batch.schema.field(at), pa.array(values, batch.schema.field(at).type))
            yield batch
    return cut


def item_digest(items: str | Column = "hit_items") -> Column:
    """SHA-256 of the item ids, sorted as text and comma-joined."""
    return F.sha2(F.array_join(F.array_sort(F.col(items).cast("array<string>")), ","), 256)
