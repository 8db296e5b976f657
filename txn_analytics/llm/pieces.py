"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

The distinct words of a slice of texts are encoded together: their symbols lie in one flat array, each round takes
the least pair rank of every word, merges that pair wherever it occurs in the word, from the left and without
overlap, closes the gaps and drops the words that have no pair left. No piece has a space mark behind another
character, so words can be encoded apart; runs of marks are merged last and greedily by the same rules.

A merge can make a pair of a lower or equal rank possible. In a word whose best pair can do that, one round merges
only the leftmost occurrence, as one-by-one merging does.
"""

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txn_analytics.llm.words import steps

SPACE = "▁"
#: Bytes of text whose distinct words are encoded together.
SLICE_BYTES = 3_000_000

_NONE = np.iinfo(np.int32).max
_PROBES = ["", " ", "a", " a  b ", "Hello, World\n\tx", "ﬁ é́ 你好 \U0001f600\x00", f"{SPACE}x {SPACE}{SPACE}", "<s> </s> <0x41>", " " * 15, " " * 47 + "x"]


class Vocabulary:
    """Pieces, ranks and pairs of a BPE model with byte fallback, identity normalisation and a leading space mark."""

    def __init__(self, model: bytes):
        model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.size, self.end = model.vocab_size(), model.eos_id()
        ids = range(self.size)
        normal = {model.id_to_piece(i): i for i in ids
                  if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))}
        if any(model.is_unused(i) for i in ids):
            raise ValueError("models with unused pieces are not supported")
        score = np.array([model.get_score(i) for i in ids])
        self.rank = np.unique(-score, return_inverse=True)[1].astype(np.int32)
        self.byte = np.zeros(256, np.int32)
        for i in ids:
            if model.is_byte(i):
                self.byte[int(model.id_to_piece(i)[3:5], 16)] = i
        # A character that is no piece is the symbol ``size`` + code point.
        self.symbol = np.arange(0x110000, dtype=np.int32) + self.size
        for piece, i in normal.items():
            if len(piece) == 1:
                self.symbol[ord(piece)] = i
        pairs = {}
        for piece, i in normal.items():
            for cut in range(1, len(piece)):
                left, right = (normal.get(x, self.size + ord(x) if len(x) == 1 else None) for x in (piece[:cut], piece[cut:]))
                if left is not None and right is not None:
                    pairs[left * (self.size + 0x110000) + right] = i
        self.pairs = np.array(sorted(pairs), np.int64)
        self.made = np.array([pairs[k] for k in self.pairs.tolist()], np.int32)
        # Pieces that can become part of one with a rank as low or lower.
        self.alone = np.zeros(self.size, bool)
        for key, made in pairs.items():
            for part in divmod(key, self.size + 0x110000):
                if part < self.size and self.rank[made] <= self.rank[part]:
                    self.alone[part] = True
        # Text of each piece when decoded.
        texts = [b""] * self.size
        for piece, i in normal.items():
            texts[i] = piece.replace(SPACE, " ").encode()
        for value, i in enumerate(self.byte.tolist()):
            texts[i] = bytes([value]) if i else texts[i]
        if model.unk_id() >= 0:
            texts[model.unk_id()] = " ⁇ ".encode()
        self.text_size = np.array([len(x) for x in texts], np.int64)
        self.text_start = np.cumsum(self.text_size) - self.text_size
        self.text = np.frombuffer(b"".join(texts), np.uint8)
        self._set_marks(normal)
        for probe in _PROBES:
            if self.encode(pa.array([probe])).to_pylist()[0] != model.encode(probe) + [self.end]:
                raise ValueError(f"this model encodes {probe!r} by other rules than the supported ones")

    def _set_marks(self, normal: dict[str, int]) -> None:
        """Pieces of space marks only, by length; the rules that let words be encoded apart must hold."""
        marks = {len(p): i for p, i in normal.items() if not p.strip(SPACE)}
        others = [i for p, i in normal.items() if p.strip(SPACE)]
        held = 1 in marks and len({int(self.rank[marks[n]]) for n in marks if n > 1}) <= 1 and all(
            self.rank[marks[n]] > self.rank[others].max() for n in marks if n > 1)
        if not held or any(SPACE in p.strip(SPACE) or p.startswith(SPACE * 2) for p in normal if p.strip(SPACE)):
            raise ValueError("space marks of this model do not allow to encode words apart")
        self.marks, self.longest = marks, max(marks)
        self.rest = [self._merged(n) for n in range(self.longest + 1)]

    def _merged(self, n: int) -> list[int]:
        """Ids of up to ``longest`` marks in a row. All these pairs rank alike, so the leftmost one goes first."""
        sizes, at = [1] * n, 0
        while at + 1 < len(sizes):
            if sizes[at] + sizes[at + 1] in self.marks:
                sizes[at:at + 2] = [sizes[at] + sizes[at + 1]]
                at = 0
            else:
                at += 1
        return [self.marks[x] for x in sizes]

    def run(self, n: int) -> list[int]:
        """Ids of ``n`` space marks in a row: the longest piece takes no more marks, so what follows starts anew."""
        return self.rest[self.longest] * (n // self.longest) + self.rest[n % self.longest]

    def _look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that each pair makes, or -1."""
        keys = left.astype(np.int64) * (self.size + 0x110000) + right
        at = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
        return np.where(self.pairs[at] == keys, self.made[at], -1)

    def _ranks(self, made: np.ndarray) -> np.ndarray:
        return np.where(made >= 0, self.rank[made], _NONE)

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of the words, each with a space mark before it, and how many each has."""
        points = np.frombuffer("".join([SPACE + w for w in words]).encode("utf-32-le"), np.uint32)
        count = np.array([len(w) + 1 for w in words], np.int64)
        word, symbol = np.arange(len(words)), self.symbol[points]
        last = np.cumsum(count) - 1
        made = np.full(len(symbol), -1, np.int32)
        made[:-1] = self._look_up(symbol[:-1], symbol[1:])
        made[last] = -1
        rank = self._ranks(made)
        done = []
        while len(word):
            first = np.cumsum(count) - count
            least = np.minimum.reduceat(rank, first)
            more = least < _NONE
            if not more.all():
                stay = np.repeat(more, count)
                done.append((word[~more], count[~more], symbol[~stay]))
                word, count, least = word[more], count[more], least[more]
                symbol, made, rank = symbol[stay], made[stay], rank[stay]
                first = np.cumsum(count) - count
            if not len(word):
                break
            at = np.flatnonzero(rank == np.repeat(least, count))
            # Within a chain of overlapping pairs every second one is merged, from the left.
            fresh = np.r_[True, at[1:] != at[:-1] + 1]
            start = np.flatnonzero(fresh)
            at = at[(np.arange(len(at)) - start[np.cumsum(fresh) - 1]) % 2 == 0]
            owner = np.searchsorted(first, at, "right") - 1
            alone = self.alone[made[at]]
            if alone.any():
                careful = np.zeros(len(word), bool)
                careful[owner[alone]] = True
                pick = ~careful[owner] | np.r_[True, owner[1:] != owner[:-1]]
                at, owner = at[pick], owner[pick]
            symbol[at] = made[at]
            keep = np.ones(len(symbol), bool)
            keep[at + 1] = False
            made[at] = made[at + 1]          # -1 where the word ends there
            ends = np.zeros(len(symbol), bool)
            ends[first + count - 1] = True
            ends[at] |= ends[at + 1]
            place = np.cumsum(keep) - 1
            symbol, made, rank, ends = symbol[keep], made[keep], rank[keep], ends[keep]
            count = count - np.bincount(owner, minlength=len(word))
            at = place[at]
            new = np.union1d(at, at[at > 0] - 1)
            inside = new[~ends[new]]
            made[new] = -1
            made[inside] = self._look_up(symbol[inside], symbol[inside + 1])
            rank[new] = self._ranks(made[new])
        order = np.argsort(np.concatenate([x[0] for x in done])) if done else np.zeros(0, np.int64)
        count = np.concatenate([x[1] for x in done]) if done else np.zeros(0, np.int64)
        flat = np.concatenate([x[2] for x in done]) if done else np.zeros(0, np.int32)
        return flat[_gather(np.cumsum(count) - count, count, order)], count[order]

    def _ids(self, symbols: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of symbols: characters that are no piece become their UTF-8 bytes."""
        odd = np.flatnonzero(symbols >= self.size)
        if not len(odd):
            return symbols, count
        raw = [self.byte[list(chr(c).encode())] for c in (symbols[odd] - self.size).tolist()]
        size = np.ones(len(symbols), np.int64)
        size[odd] = [len(x) for x in raw]
        out = np.repeat(symbols, size)
        start = np.cumsum(size) - size
        out[_gather(start, size, odd)] = np.concatenate(raw)
        first = np.cumsum(count) - count
        return out, np.add.reduceat(size, first) if len(first) else count

    def encode(self, column: pa.Array) -> pa.Array:
        """Lists of ids, each with the end id last. NULL is an empty text."""
        texts = pc.fill_null(column, "").cast(pa.large_string())
        lists = pc.split_pattern(pc.replace_substring(texts, SPACE, " "), " ")
        full = pc.binary_length(texts).to_numpy(zero_copy_only=False) > 0
        size = np.where(full, pc.list_value_length(lists).to_numpy(zero_copy_only=False), 0)
        words = pc.list_flatten(lists).dictionary_encode()
        code = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        code = code[np.repeat(full, pc.list_value_length(lists).to_numpy(zero_copy_only=False))]
        known = words.dictionary.to_pylist()
        symbols, count = self._ids(*self.merge(known))
        flat, first, many = [symbols], np.cumsum(count) - count, count
        first, many, extra = first.tolist(), many.tolist(), len(symbols)

        def entry(ids: list[int]) -> int:
            nonlocal extra
            flat.append(np.array(ids, np.int32))
            first.append(extra)
            many.append(len(ids))
            extra += len(ids)
            return len(first) - 1

        end, nothing = entry([self.end]), entry([])
        if "" in known:
            self._join_marks(code, size, known.index(""), nothing, entry, symbols, first, many)
        # The end id is one more word of each text.
        ends = np.cumsum(size)
        code = np.insert(code, ends, end)
        flat, first, many = np.concatenate(flat), np.array(first, np.int64), np.array(many, np.int64)
        ids = flat[_gather(first, many, code)]
        total = np.r_[0, np.cumsum(many[code])]
        offsets = total[np.r_[0, ends + np.arange(1, len(ends) + 1)]]
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))

    def _join_marks(self, code, size, empty, nothing, entry, symbols, first, many) -> None:
        """Empty words are marks in a row; they and a bare mark before the next word are merged with each other."""
        text_end = set(np.cumsum(size).tolist())
        seen: dict[tuple[int, int], int] = {}
        at = np.flatnonzero(code == empty).tolist()
        k = 0
        while k < len(at):
            start = k
            while k + 1 < len(at) and at[k + 1] == at[k] + 1 and at[k + 1] not in text_end:
                k += 1
            n, after = k - start + 1, at[k] + 1
            k += 1
            last = -1 if after in text_end else int(code[after])
            if (n, last) not in seen:
                own = symbols[first[last]:first[last] + many[last]].tolist() if last >= 0 else []
                bare = bool(own) and own[0] == self.marks[1]
                seen[n, last] = entry(self.run(n + bare) + own[bare:])
            code[at[start]:at[start] + n] = nothing
            code[after if last >= 0 else after - 1] = seen[n, last]

    def decode(self, ids: pa.Array) -> pa.Array:
        """Texts of lists of ids; control ids give nothing, bytes that are no UTF-8 the replacement character."""
        flat = pc.list_flatten(ids).to_numpy(zero_copy_only=False)
        many = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
        size = self.text_size[flat]
        data = self.text[_gather(self.text_start, self.text_size, flat)]
        total = np.r_[0, np.cumsum(size)][np.r_[0, np.cumsum(many)]]
        # The space mark before the first word is not part of the text.
        full = np.flatnonzero(np.diff(total) > 0)
        lead = total[full][data[total[full]] == 0x20]
        keep = np.ones(len(data), bool)
        keep[lead] = False
        total = np.r_[0, np.cumsum(keep)][total]
        data = data[keep].tobytes()
        try:
            data.decode()
            return pa.LargeStringArray.from_buffers(len(many), pa.py_buffer(total.astype(np.int64)), pa.py_buffer(data))
        except UnicodeDecodeError:
            return pa.array([data[a:b].decode(errors="replace") for a, b in zip(total[:-1], total[1:])], pa.large_string())


def _gather(first: np.ndarray, many: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Positions of the elements of segments ``code``, one segment after the other."""
    size = many[code]
    before = np.cumsum(size) - size
    return np.repeat(first[code] - before, size) + np.arange(size.sum())


@lru_cache(maxsize=2)
def vocabulary(model: bytes) -> Vocabulary:
    return Vocabulary(model)


def encode(docs: DataFrame, model: bytes, text: str = "text", ids: str = "ids") -> DataFrame:
    """The documents without ``text`` and with ``ids``, the piece ids of the whole text and the end id.

    A NULL or empty text has the end id only. A space mark in a text is a space, as in the library. Every row is
    encoded by itself: repeated rows are alike, other columns stay as they are, an empty table stays empty.
    """
    kept = [f for f in docs.schema.fields if f.name not in (text, ids)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(model)
        for batch in (part for whole in batches for part in steps(whole, text, SLICE_BYTES)):
            yield pa.RecordBatch.from_arrays(
                [batch.column(f.name) for f in kept] + [words.encode(batch.column(text))], [f.name for f in kept] + [ids])
    names = [f"`{f.name}`" for f in kept]
    return docs.select(*names, F.col(f"`{text}`")).mapInArrow(
        run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + f", `{ids}` array<int>" if kept
        else f"`{ids}` array<int>")


def decode(docs: DataFrame, model: bytes, ids: str = "ids", text: str = "text") -> DataFrame:
    """The rows with ``text``, what the ids stand for. NULL ids are no ids and give an empty text."""
    kept = [f for f in docs.schema.fields if f.name != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(model)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                yield pa.RecordBatch.from_arrays(
                    [part.column(f.name) for f in kept] + [words.decode(part.column(ids)).cast(pa.string())],
                    [f.name for f in kept] + [text])
    return docs.select(*[f"`{f.name}`" for f in kept]).mapInArrow(
        run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + f", `{text}` string")


def encode_and_decode(docs: DataFrame, model: bytes, text: str = "text", ids: str = "ids") -> DataFrame:
    """``decode`` of ``encode`` in one pass: ``ids`` of each text, and in ``text`` what they stand for.

    One worker does both, so the ids do not leave it in between. NULL, empty and repeated rows are as in ``encode``.
    """
    kept = [f for f in docs.schema.fields if f.name not in (text, ids)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(model)
        for batch in (part for whole in batches for part in steps(whole, text, SLICE_BYTES)):
            coded = words.encode(batch.column(text))
            yield pa.RecordBatch.from_arrays(
                [batch.column(f.name) for f in kept] + [coded, words.decode(coded).cast(pa.string())],
                [f.name for f in kept] + [ids, text])
    return docs.select(*[f"`{f.name}`" for f in kept], F.col(f"`{text}`")).mapInArrow(run, ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [f"`{ids}` array<int>", f"`{text}` string"]))


def digest(ids: str | Column = "ids") -> Column:
    """SHA-256 of the decimal ids joined by one space."""
    return F.sha2(F.array_join(F.col(ids).cast("array<string>"), " "), 256)
