"""Byte-level BPE encoding and decoding: a queue of merge ranks over a doubly linked list of symbols.

A text is cut at added tokens and then into words by the byte-level pattern. The symbols of a word are its bytes, in a
list that is linked both ways. Every pair that has a rank waits in a priority queue, lowest rank first and leftmost
first among equals. A pair that is taken merges into its left symbol and queues the two pairs that this makes; an entry
whose pair has changed since it was queued is skipped. Each distinct word goes through the queue once for as long as a
worker remembers it. Decoding joins the byte strings of the vocabulary.
"""

import heapq
import json
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txn_analytics.llm.words import steps

#: Bytes of text that are encoded together.
SLICE_BYTES = 2_000_000
#: Words that a worker remembers; then it forgets them all. A longer word than ``LONGEST`` bytes is not remembered.
REMEMBERED = 500_000
LONGEST = 200

#: How byte-level vocabularies cut a text (a fixed value of that kind of tokenizer).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_PLACE_BITS = 40


def printable_bytes() -> dict[str, int]:
    """The character that stands for each byte in a vocabulary file: itself if it prints, else one from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class ByteVocabulary:
    """Pieces, merges and added tokens of a byte-level BPE file (JSON), and the words encoded so far.

    With ``added`` false the strings of added tokens are ordinary text.
    """

    def __init__(self, spec: bytes, added: bool = True):
        spec = json.loads(spec)
        model, cut, decoder = spec["model"], spec["pre_tokenizer"], spec["decoder"]
        plain = model["type"] == "BPE" and not any(model.get(x) for x in (
            "dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges", "byte_fallback"))
        if not (plain and spec["normalizer"] is None and spec["post_processor"] is None and cut["type"] == "ByteLevel"
                and cut["use_regex"] and not cut["add_prefix_space"] and decoder["type"] == "ByteLevel"):
            raise ValueError("only byte-level BPE without normaliser, prefix space and post-processing is supported")
        tokens = spec["added_tokens"]
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in tokens):
            raise ValueError("added tokens that strip or take whole words only are not supported")
        ids, of_char = model["vocab"], printable_bytes()
        self.size = max([*ids.values(), *(t["id"] for t in tokens)]) + 1
        texts: list[bytes] = [b""] * self.size
        for token, i in ids.items():
            texts[i] = bytes(of_char[c] for c in token)
        for t in tokens:
            texts[t["id"]] = bytes(of_char[c] for c in t["content"]) if all(c in of_char for c in t["content"]) else t["content"].encode()
        self.texts = pa.array(texts, pa.large_binary())
        self.lengths = np.array([len(x) for x in texts], np.int64)
        self.byte = [ids[c] for c, _ in sorted(of_char.items(), key=lambda x: x[1])]
        self.rank: dict[int, int] = {}
        self.made: list[int] = []
        for place, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.rank[ids[left] * self.size + ids[right]] = place
            self.made.append(ids[left + right])
        # The rank of every pair of bytes, and the numbers that the links of a word begin with.
        self.start = [[self.rank.get(a * self.size + b) for b in self.byte] for a in self.byte]
        self.numbers = list(range(-1, LONGEST + 1))
        self.split = regex.compile(PATTERN).findall
        self.added = {t["content"]: t["id"] for t in tokens} if added else {}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.mark = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if self.added else None
        self._forget()

    def _forget(self) -> None:
        """Only added tokens are known. Ids of word ``code`` lie in ``flat`` from ``first[code]`` up to ``first[code + 1]``."""
        self.code: dict[str | tuple, int] = {}
        self.flat, self.first = array("i"), array("q", [0])

    def merge(self, word: bytes) -> list[int]:
        """Ids of one word."""
        byte, start, n = self.byte, self.start, len(word)
        symbol = [byte[b] for b in word]
        queue, last, at = [], word[0], 0
        for b in word[1:]:
            found = start[last][b]
            if found is not None:
                queue.append(found << _PLACE_BITS | at)
            last = b
            at += 1
        if not queue:
            return symbol
        rank, made, size = self.rank.get, self.made, self.size
        heapq.heapify(queue)
        pop, push, places = heapq.heappop, heapq.heappush, (1 << _PLACE_BITS) - 1
        numbers = self.numbers if n <= LONGEST else list(range(-1, n + 1))
        after, before = numbers[2:n + 2], numbers[:n]
        while queue:
            entry = pop(queue)
            at, wanted = entry & places, entry >> _PLACE_BITS
            here, right = symbol[at], after[at]
            # Stale: merged into its left neighbour, or one of the pair has changed.
            if here < 0 or right >= n or rank(here * size + symbol[right]) != wanted:
                continue
            symbol[at] = here = made[wanted]
            symbol[right] = -1
            after[at] = right = after[right]
            if right < n:
                before[right] = at
                found = rank(here * size + symbol[right])
                if found is not None:
                    push(queue, found << _PLACE_BITS | at)
            left = before[at]
            if left >= 0:
                found = rank(symbol[left] * size + here)
                if found is not None:
                    push(queue, found << _PLACE_BITS | left)
        return [x for x in symbol if x >= 0]

    def _learn(self, word, ids: list[int]) -> None:
        self.code[word] = len(self.first) - 1
        self.flat.extend(ids)
        self.first.append(len(self.flat))

    def _words(self, text: str) -> list:
        """Words of a text; an added token is a tuple with its id, so that no word equals it."""
        if self.mark is None or self.mark.search(text) is None:
            return self.split(text)
        out: list = []
        for part in self.mark.split(text):
            out.extend([(self.added[part],)] if part in self.added else self.split(part))
        return out

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each text has."""
        if len(self.code) > REMEMBERED:
            self._forget()
        known, codes, count, long = self.code, [], [], False
        for text in texts:
            words = self._words(text)
            own = list(map(known.get, words))
            if None in own:
                for place, code in enumerate(own):
                    if code is None:
                        word = words[place]
                        if word not in known:
                            long |= len(word) > LONGEST
                            self._learn(word, [word[0]] if isinstance(word, tuple) else self.merge(word.encode()))
                        own[place] = known[word]
            codes.append(np.array(own, np.int64))
            count.append(len(own))
        code = np.concatenate(codes) if codes else np.zeros(0, np.int64)
        flat, first = np.array(self.flat, np.int32), np.array(self.first, np.int64)
        if long:
            self._forget()
        size = first[code + 1] - first[code]
        before = np.cumsum(size) - size
        ids = flat[np.repeat(first[code] - before, size) + np.arange(size.sum())]
        total = np.r_[0, np.cumsum(size)][np.r_[0, np.cumsum(count)]]
        return ids, np.diff(total)

    def joined(self, ids: np.ndarray) -> tuple[pa.Buffer | None, np.ndarray]:
        """The byte strings of the ids, one after the other, and where each begins, with the end last."""
        parts = self.texts.take(pa.array(ids))
        offsets = np.frombuffer(parts.buffers()[1], np.int64)[:len(ids) + 1] if len(ids) else np.zeros(1, np.int64)
        return parts.buffers()[2], offsets

    def decode(self, ids: np.ndarray, count: np.ndarray) -> pa.Array:
        """Text of each run of ``count`` ids. Ids that the vocabulary does not have give nothing."""
        known = (ids >= 0) & (ids < self.size)
        if not known.all():
            count = np.diff(np.r_[0, np.cumsum(known)][np.r_[0, np.cumsum(count)]])
            ids = ids[known]
        data, offsets = self.joined(ids)
        at = offsets[np.r_[0, np.cumsum(count)]]
        data = b"" if data is None else data.to_pybytes()[:int(at[-1])]
        try:
            data.decode()
        except UnicodeDecodeError:
            pass
        else:
            # All of it is sound, and so is each text, if none begins inside of a character.
            starts = at[:-1][at[:-1] < at[1:]]
            if not np.any((np.frombuffer(data, np.uint8)[starts] & 0xC0) == 0x80):
                return pa.LargeStringArray.from_buffers(len(count), pa.py_buffer(at.astype(np.int64)), pa.py_buffer(data))
        return pa.array([data[a:b].decode(errors="replace") for a, b in zip(at[:-1], at[1:])], pa.large_string())


@lru_cache(maxsize=4)
def vocabulary(spec: bytes, added: bool = True) -> ByteVocabulary:
    return ByteVocabulary(spec, added)


def _schema(fields, more: str) -> str:
    return ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + [more])


def encode(docs: DataFrame, spec: bytes, text: str = "text", ids: str = "ids", packed: bool = False,
           added: bool = True) -> DataFrame:
    """The documents without ``text`` and with ``ids`` of the whole text: a list, or packed, 4 bytes each, lowest first.

    A NULL or empty text has no ids. Every row is encoded by itself: repeated rows are alike, other columns stay as they
    are (but one named like ``ids``), an empty table stays empty. A word of any length is one queue.
    """
    kept = [f for f in docs.schema.fields if f.name not in (text, ids)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(spec, added)
        for batch in (part for whole in batches for part in steps(whole, text, SLICE_BYTES)):
            flat, count = words.encode(pc.fill_null(batch.column(text), "").to_pylist())
            at = np.r_[0, np.cumsum(count)]
            if packed:
                lists = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(count), [
                    None, pa.py_buffer(at * 4), pa.py_buffer(flat.astype("<u4"))]).cast(pa.binary())
            else:
                lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column(f.name) for f in kept] + [lists], [f.name for f in kept] + [ids])
    return docs.select(*[f"`{f.name}`" for f in kept], F.col(f"`{text}`")).mapInArrow(
        run, _schema(kept, f"`{ids}` {'binary' if packed else 'array<int>'}"))


def decode(docs: DataFrame, spec: bytes, ids: str = "ids", text: str = "text") -> DataFrame:
    """The rows with ``text``, what the ids (a list, or packed) stand for. NULL ids give an empty text."""
    kept = [f for f in docs.schema.fields if f.name != text]
    packed = docs.schema[ids].dataType.simpleString() == "binary"

    def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if packed:
            yield from steps(batch, ids, SLICE_BYTES)
            return
        at = np.cumsum(pc.fill_null(pc.list_value_length(batch.column(ids)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            end = max(start + 1, int(np.searchsorted(at, (at[start - 1] if start else 0) + SLICE_BYTES // 4, "right")))
            yield batch.slice(start, end - start)
            start = end

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(spec)
        for batch in (part for whole in batches for part in slices(whole)):
            column = batch.column(ids)
            if packed:
                count = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64) // 4
                flat = np.frombuffer(b"".join(x for x in column.to_pylist() if x), "<u4").astype(np.int64)
            else:
                count = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
                flat = pc.fill_null(pc.list_flatten(column), -1).to_numpy(zero_copy_only=False).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(f.name) for f in kept] + [words.decode(flat, count).cast(pa.string())],
                [f.name for f in kept] + [text])
    return docs.select(*[f"`{f.name}`" for f in kept]).mapInArrow(run, _schema(kept, f"`{text}` string"))
