"""Language-model scores: the marginal probability of a text over all segmentations into known pieces.

The pieces are those of an existing vocabulary. Its scores rank them, which gives first weights by Zipf's law; the
corpus then weighs the pieces by their expected counts over all segmentations of all training words (one or more
rounds of expectation-maximisation). Pieces hold a space mark only in front, so the lattice of a text is a row of
word lattices, and every distinct word of a chunk of documents is solved once, by the forward recursion in logs.

A unigram word model goes with it. Its counts are over the whole corpus and may be of any number: documents are
cut into chunks, each chunk sends the counts of its distinct words, sums come back to the chunks by a window over
the word, and no task holds more than a chunk with its words.
"""

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txn_analytics.cluster import saved
from txn_analytics.llm.pieces import SPACE
from txn_analytics.llm.words import MULTIPLIER, NOT_SPACE, Words, mix, segment_sums, steps

ROUNDS = 1
SMOOTHING = 0.1          # added to the expected count of each piece
CHUNK_BYTES = 24_000_000
_WORDS_AT_ONCE = 40_000
_LONG = 60                # characters of a word that is not solved side by side with others
_FILTER_BITS = 20


class Lattice:
    """Pieces of a vocabulary by the hash of their characters, and log weights by piece id."""

    def __init__(self, model: bytes):
        model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.size, self.end = model.vocab_size(), model.eos_id()
        self.byte = np.full(256, -1)
        pieces, used = {}, np.zeros(self.size, bool)
        for i in range(self.size):
            if model.is_byte(i):
                self.byte[int(model.id_to_piece(i)[3:5], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                pieces[model.id_to_piece(i)] = i
        used[list(pieces.values())] = used[self.byte[self.byte >= 0]] = used[self.end] = True
        rank = np.zeros(self.size)
        score = np.array([model.get_score(i) for i in range(self.size)])
        rank[used] = np.unique(-score[used], return_inverse=True)[1]
        self.first_weights = np.where(used, -np.log(rank + 3), -np.inf)
        self.first_weights -= np.log(np.exp(self.first_weights).sum())
        self.used = used
        self.longest = max(map(len, pieces))
        hashes = np.concatenate([self._hash(p) for p in pieces])
        order = np.argsort(hashes)
        self.hashes, self.ids = hashes[order], np.array(list(pieces.values()), np.int32)[order]
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[hashes >> np.uint64(64 - _FILTER_BITS)] = True

    @staticmethod
    def _hash(piece: str) -> np.ndarray:
        h = np.zeros(1, np.uint64)
        for character in piece:
            h = h * np.uint64(MULTIPLIER) + np.uint64(ord(character))
        return mix(h + np.uint64(len(piece)))

    def _found(self, sums: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Where strings of ``n`` characters with these hash sums are pieces, and which."""
        h = mix(sums + np.uint64(n))
        maybe = np.flatnonzero(self.filter[h >> np.uint64(64 - _FILTER_BITS)])
        place = np.minimum(np.searchsorted(self.hashes, h[maybe]), len(self.hashes) - 1)
        found = self.hashes[place] == h[maybe]
        return maybe[found], self.ids[place[found]]

    def _spelling(self, character: int) -> np.ndarray:
        """Byte pieces of a character that has no piece of its own."""
        return self.byte[list(chr(character).encode())]

    def _short(self, words: list[str], weights: np.ndarray, times: np.ndarray | None, counts: np.ndarray | None) -> np.ndarray:
        """Log probabilities of words of up to ``_LONG`` characters, which go on side by side.

        Longer words come first, so those that reach a position are in front: every step works on slices.
        """
        size = np.array([len(w) + 1 for w in words])
        order = np.argsort(-size, kind="stable")
        reach = np.searchsorted(-size[order], -np.arange(size.max() + 1), "right")     # words with that many characters
        points = np.frombuffer("".join([SPACE + words[i] for i in order]).encode("utf-32-le"), np.uint32).astype(np.uint64)
        first = np.cumsum(size[order]) - size[order]
        last = len(reach) - 1
        at = [points[first[:reach[k + 1]] + k] for k in range(last)]
        edges, spelled = {}, {}
        for k in range(last):
            sums = np.zeros(reach[k + 1], np.uint64)
            for n in range(1, min(self.longest, last - k) + 1):
                sums = sums[:reach[k + n]] * np.uint64(MULTIPLIER) + at[k + n - 1][:reach[k + n]]
                found, ids = self._found(sums, n)
                edges[k, n] = found, ids, weights[ids]
                if n == 1 and len(found) < len(sums):
                    odd = np.setdiff1d(np.arange(len(sums)), found)
                    bytes_of = [self._spelling(c) for c in at[k][odd].tolist()]
                    spelled[k] = odd, np.array([weights[x].sum() for x in bytes_of]), bytes_of
        forward = [np.zeros(len(words))]
        for t in range(1, last + 1):
            value = np.full(reach[t], -np.inf)
            for n in range(1, min(t, self.longest) + 1):
                found, _, cost = edges[t - n, n]
                value[found] = np.logaddexp(value[found], forward[t - n][found] + cost)
            if t - 1 in spelled:
                odd, cost, _ = spelled[t - 1]
                value[odd] = np.logaddexp(value[odd], forward[t - 1][odd] + cost)
            forward.append(value)
        ends = size[order]
        total = np.empty(len(words))
        for t in range(1, last + 1):
            here = slice(reach[t + 1] if t < last else 0, reach[t])
            total[here] = forward[t][here]
        if counts is not None:
            times, met, shares = times[order], [], []
            backward = [None] * (last + 1)
            for k in range(last, -1, -1):
                value = np.where(ends[:reach[k]] == k, 0.0, -np.inf)
                for n in range(1, min(self.longest, last - k) + 1):
                    found, ids, cost = edges[k, n]
                    rest = cost + backward[k + n][found]
                    value[found] = np.logaddexp(value[found], rest)
                    met.append(ids)
                    shares.append(np.exp(forward[k][found] + rest - total[found]) * times[found])
                if k in spelled:
                    odd, cost, bytes_of = spelled[k]
                    rest = cost + backward[k + 1][odd]
                    value[odd] = np.logaddexp(value[odd], rest)
                    for x, share in zip(bytes_of, np.exp(forward[k][odd] + rest - total[odd]) * times[odd]):
                        np.add.at(counts, x, share)
                backward[k] = value
            counts += np.bincount(np.concatenate(met), np.concatenate(shares), self.size)
        out = np.empty(len(words))
        out[order] = total
        return out

    def _alone(self, word: str, weights: np.ndarray, times: int, counts: np.ndarray | None) -> float:
        """Log probability of one long word, position by position."""
        points = np.frombuffer((SPACE + word).encode("utf-32-le"), np.uint32).astype(np.uint64)
        edges: list[list[tuple[int, float, np.ndarray]]] = [[] for _ in points]
        sums = np.zeros(len(points), np.uint64)
        for n in range(1, min(self.longest, len(points)) + 1):
            sums = sums[:len(points) - n + 1] * np.uint64(MULTIPLIER) + points[n - 1:]
            for i, x in zip(*(v.tolist() for v in self._found(sums, n))):
                edges[i].append((n, float(weights[x]), np.array([x])))
            if n == 1:
                for i in [i for i, held in enumerate(edges) if not held]:
                    own = self._spelling(int(points[i]))
                    edges[i].append((1, float(weights[own].sum()), own))
        forward = [-math.inf] * (len(points) + 1)
        forward[0] = 0.0
        for i, own in enumerate(edges):
            for n, cost, _ in own:
                forward[i + n] = _log_add(forward[i + n], forward[i] + cost)
        if counts is not None:
            backward = [-math.inf] * len(points) + [0.0]
            for i in range(len(points) - 1, -1, -1):
                for n, cost, ids in edges[i]:
                    rest = cost + backward[i + n]
                    backward[i] = _log_add(backward[i], rest)
                    np.add.at(counts, ids, math.exp(forward[i] + rest - forward[-1]) * times)
        return forward[-1]

    def _solve(self, words: pa.Array, weights: np.ndarray, times: np.ndarray | None) -> tuple[np.ndarray, np.ndarray | None]:
        """Log probability of each word; with ``times`` also the expected count of each piece."""
        counts = None if times is None else np.zeros(self.size)
        size = pc.utf8_length(words).to_numpy(zero_copy_only=False)
        spelled, out = words.to_pylist(), np.empty(len(words))
        long = np.flatnonzero(size > _LONG)
        for i in long.tolist():
            out[i] = self._alone(spelled[i], weights, 0 if times is None else int(times[i]), counts)
        short = np.flatnonzero(size <= _LONG)
        for k in range(0, len(short), _WORDS_AT_ONCE):
            part = short[k:k + _WORDS_AT_ONCE]
            out[part] = self._short([spelled[i] for i in part.tolist()], weights, None if times is None else times[part], counts)
        return out, counts

    def word_scores(self, words: pa.Array, weights: np.ndarray) -> np.ndarray:
        """Natural log of the marginal probability of each word."""
        return self._solve(words, weights, None)[0]

    def expected(self, words: pa.Array, times: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Expected count of each piece over all segmentations of words that occur ``times`` times."""
        return self._solve(words, weights, times)[1]


def _log_add(a: float, b: float) -> float:
    if a < b:
        a, b = b, a
    return a if b == -math.inf else a + math.log1p(math.exp(b - a))


@lru_cache(maxsize=2)
def lattice(model: bytes) -> Lattice:
    return Lattice(model)


class _Chunk:
    """Documents gathered in a task, with their words as numbers into the distinct words."""

    def __init__(self):
        self.bytes, self.batches, self.hashes, self.counts, self.known, self.spelled = 0, [], [], [], [], []

    def add(self, batch: pa.RecordBatch) -> None:
        words = Words(batch.column("text"), NOT_SPACE, lower=True)
        hashes = words.hashes()
        found, at = np.unique(hashes, return_index=True)
        self.hashes.append(hashes)
        self.counts.append(words.counts)
        self.known.append(found)
        size = words.ends[at] - words.starts[at]
        start = np.cumsum(size) - size
        data = words.data[np.repeat(words.starts[at] - start, size) + np.arange(size.sum())]
        self.spelled.append(pa.LargeStringArray.from_buffers(
            len(at), pa.py_buffer(np.r_[start, size.sum()].astype(np.int64)), pa.py_buffer(data.tobytes())))
        self.batches.append(batch.drop_columns(["text"]))
        self.bytes += len(words.data)

    def words(self) -> tuple[np.ndarray, pa.Array]:
        """Hashes of the distinct words, sorted, and the words."""
        known, at = np.unique(np.concatenate(self.known), return_index=True)
        return known, pa.concat_arrays(self.spelled).take(pa.array(at))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[_Chunk]:
    chunk = _Chunk()
    for batch in (part for whole in batches for part in steps(whole, "text")):
        if chunk.batches and chunk.bytes >= CHUNK_BYTES:
            yield chunk
            chunk = _Chunk()
        chunk.add(batch)
    if chunk.batches:
        yield chunk


def train(docs: DataFrame, model: bytes, rounds: int = ROUNDS, text: str = "text") -> np.ndarray:
    """Log weights of the pieces and the end, by id, from all documents.

    One row for each piece comes to the driver. Without documents the weights are those of the vocabulary alone.
    """
    rules = lattice(model)
    weights = rules.first_weights
    for _ in range(rounds):
        def expect(batches: Iterator[pa.RecordBatch], weights=weights) -> Iterator[pa.RecordBatch]:
            own = lattice(model)
            for chunk in _chunks(batches):
                known, words = chunk.words()
                times = np.zeros(len(known), np.int64)
                for hashes in chunk.hashes:
                    times += np.bincount(np.searchsorted(known, hashes), minlength=len(known))
                counts = own.expected(words, times, weights)
                counts[own.end] += sum(len(c) for c in chunk.counts)
                found = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(counts[found])], ["piece", "times"])
        found = docs.select(F.col(text).alias("text")).mapInArrow(expect, "piece int, times double").groupBy("piece").agg(
            F.sum("times").alias("times")).toArrow()
        counts = np.where(rules.used, SMOOTHING, 0.0)
        if found.num_rows:
            np.add.at(counts, found.column("piece").to_numpy(), found.column("times").to_numpy())
        with np.errstate(divide="ignore"):
            weights = np.log(counts) - np.log(counts.sum())
    return weights


def _packed(codes: np.ndarray) -> bytes:
    """Numbers as planes of bytes: the upper planes of small numbers are zeros, which compression removes."""
    return codes.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").reshape(-1).astype(np.int64)


_CHUNK_SCHEMA = ("chunk bigint, ids array<bigint>, held array<boolean>, words array<bigint>, model array<double>, codes binary, "
                 "hashes array<bigint>, times array<bigint>")


def _encode(model: bytes, weights: np.ndarray):
    """One row for each chunk: documents with model scores, words as numbers by falling frequency, training counts."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own, task = lattice(model), TaskContext.get().partitionId()
        for number, chunk in enumerate(_chunks(batches)):
            known, words = chunk.words()
            scores = own.word_scores(words, weights)
            docs = pa.Table.from_batches(chunk.batches)
            counts = np.concatenate(chunk.counts)
            codes = np.concatenate([np.searchsorted(known, h) for h in chunk.hashes])
            held = docs.column("held").to_numpy()
            training = np.repeat(~held, counts)
            often = np.argsort(-np.bincount(codes, minlength=len(known)), kind="stable")
            place = np.empty_like(often)
            place[often] = np.arange(len(often))
            first = np.r_[0, np.cumsum(counts)]
            total = segment_sums(scores[codes], first) + weights[own.end]
            times = np.bincount(codes[training], minlength=len(known))[often]
            row = [(task << 32) + number, docs.column("id").to_pylist(), held.tolist(), counts, total,
                   _packed(place[codes]), known[often].view(np.int64), times]
            kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.list_(pa.float64()),
                     pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x], t) for x, t in zip(row, kinds)],
                ["chunk", "ids", "held", "words", "model", "codes", "hashes", "times"])
    return encode


def _base(tokens: int, distinct: int, ends: int):
    """Rows of a chunk's documents, from its words and the corpus counts of these."""
    def base(chunk: pa.Table, found: pa.Table) -> pa.Table:
        row = {name: chunk.column(name)[0] for name in chunk.column_names}
        counts = row["words"].values.to_numpy()
        codes = _unpacked(row["codes"].as_py())
        total = np.zeros(int(codes.max()) + 1 if len(codes) else 0, np.int64)
        total[found.column("code").to_numpy()] = found.column("total").to_numpy()
        first = np.r_[0, np.cumsum(counts)]
        scale = np.log10(tokens + 0.5 * (distinct + 1))
        score = segment_sums(np.log10(total + 0.5)[codes], first) + np.log10(ends + 0.5) - (counts + 1) * scale
        known = segment_sums((total > 0)[codes], first) + (ends > 0)
        return pa.table({
            "id": row["ids"].values, "held_out": row["held"].values, "n_tokens": pa.array(counts + 1, pa.int64()),
            "n_known": pa.array(known, pa.int64()), "train_tokens": pa.array(np.full(len(counts), tokens), pa.int64()),
            "base_score": pa.array(score), "score": pa.array(row["model"].values.to_numpy() / np.log(10))})
    return base


def score(docs: DataFrame, model: bytes, doc_id: str = "doc_id", text: str = "text", held: str = "held_out",
          rounds: int = ROUNDS) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    Rows with a true ``held`` are scored but not learnt from; NULL counts as false. Tokens are the words with A-Z
    lower-cased and one end. base_score is log10 of the smoothed unigram probability, score that of the lattice.
    A NULL or empty text is its end alone. Repeated rows count and score as often as they are there; an empty
    table gives no rows. Words are told apart by 64-bit hashes.
    """
    read = docs.select(F.col(doc_id).cast("long").alias("id"), F.coalesce(F.col(held), F.lit(False)).alias("held"),
                       F.col(text).alias("text"))
    weights = train(read.filter("NOT held"), model, rounds)
    chunks = saved(read.mapInArrow(_encode(model, weights), _CHUNK_SCHEMA), "chunks")
    words = chunks.select("chunk", F.posexplode(F.arrays_zip("hashes", "times")).alias("code", "of")).select(
        "chunk", "code", F.col("of.hashes").alias("hash"), F.col("of.times").alias("times"))
    same = Window.partitionBy("hash")
    counted = saved(words.select("chunk", "code", "times", F.sum("times").over(same).alias("total"),
                                 (F.min("chunk").over(same) == F.col("chunk")).alias("first")), "words")
    sums = counted.agg(F.sum("times").alias("tokens"), F.count_if(F.expr("first AND total > 0")).alias("distinct")).first()
    ends = chunks.select(F.sum(F.expr("size(filter(held, x -> NOT x))"))).first()[0] or 0
    tokens, distinct = (sums["tokens"] or 0) + ends, sums["distinct"] + (ends > 0)
    return chunks.drop("hashes", "times").groupBy("chunk").cogroup(
        counted.select("chunk", "code", "total").groupBy("chunk")).applyInArrow(
        _base(tokens, distinct, ends),
        "id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")
