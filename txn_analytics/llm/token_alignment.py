"""Alignment of two tokenizers' tokens of the same texts, by pointer jumping over overlapping tokens.

Tokens of both kinds cut the same bytes. Each token points to the overlapping token that reaches farthest to the right;
a token of the second kind that ends where one of the first kind ends points to itself. Doubling the pointers of all
tokens of a slice at once, until none moves, brings each to the last token of its component. Components are the groups:
the stretches between bytes where both kinds end. A link is a pair of tokens that overlap.

How often two ids are linked is counted over the corpus, which takes two passes over what the first one leaves:

1. Texts are encoded and aligned in slices. A slice leaves a packed row with the figures of its documents and with the
   distinct id pairs of each document. A chunk of slices leaves one row for each distinct id pair, with the number of
   its documents that hold it.
2. Those rows are added up by id pair. The sums go back to the chunks that asked for them, and each chunk gives its
   documents their totals. A chunk asks once for a pair, so no pair has more rows than there are chunks, and no task
   holds more than a chunk.
"""

import hashlib
import io
import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txn_analytics.cluster import saved
from txn_analytics.llm.byte_pairs import PATTERN, printable_bytes
from txn_analytics.llm.words import segment_sums, steps, utf8

#: Bytes of text that are aligned together, and of a chunk.
SLICE_BYTES = 2_000_000
CHUNK_BYTES = 16_000_000

SPACE = "▁"
FIGURES = ["n_a", "n_b", "n_groups", "n_links"]


class Side:
    """The byte strings of one tokenizer's ids."""

    def __init__(self, texts: list[bytes]):
        self.texts = pa.array(texts, pa.large_binary())
        self.lengths = np.array([len(x) for x in texts], np.int64)
        self.size = len(texts)

    def bytes_of(self, ids: np.ndarray) -> bytes:
        data = self.texts.take(pa.array(ids)).buffers()[2]
        return b"" if data is None else data.to_pybytes()[:int(self.lengths[ids].sum())]


class Tokenizers:
    """Byte-level BPE (a JSON file) as the first kind and sentencepiece BPE (a model file) as the second.

    Strings of special tokens in a text are plain text to both.
    """

    def __init__(self, spec: bytes, model: bytes):
        spec = json.loads(spec)
        of_char, ids = printable_bytes(), spec["model"]["vocab"]
        texts = [b""] * (max([*ids.values(), *(t["id"] for t in spec["added_tokens"])]) + 1)
        for token, i in ids.items():
            texts[i] = bytes(of_char[c] for c in token)
        merged = [ids["".join(pair.split(" ") if isinstance(pair, str) else pair)] for pair in spec["model"]["merges"]]
        if sorted(merged) != merged:
            raise ValueError("ids of the byte-level vocabulary do not follow its merges")
        self.a = Side(texts)
        special = {t["id"] for t in spec["added_tokens"]}
        self._first = tiktoken.Encoding("first", pat_str=PATTERN, special_tokens={}, mergeable_ranks={
            x: i for i, x in enumerate(texts) if x and i not in special})
        self._second = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = [self._second.id_to_piece(i) for i in range(self._second.vocab_size())]
        self.b = Side([bytes([int(p[3:5], 16)]) if self._second.is_byte(i) else p.replace(SPACE, " ").encode()
                       for i, p in enumerate(pieces)])

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of all texts in a row and how many each text has, of both kinds; the first sees a space before each text."""
        first = [self._first.encode_ordinary(f" {x}") for x in texts]
        second = self._second.encode(texts, num_threads=1)
        return [(np.fromiter(chain.from_iterable(ids), np.int64), np.array([len(x) for x in ids], np.int64))
                for ids in (first, second)]


@lru_cache(maxsize=2)
def tokenizers(spec: bytes, model: bytes) -> Tokenizers:
    return Tokenizers(spec, model)


def terminals(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The last second-kind token of the component of each token, for the tokens of either kind that end at these bytes."""
    n = len(ends_b)
    over_b = np.searchsorted(ends_a, ends_b)        # the token of the first kind at the last byte of each of the second
    at_a = np.searchsorted(ends_b, ends_a)
    at_b = np.where(ends_a[over_b] == ends_b, np.arange(n), n + over_b)
    points = np.concatenate([at_b, at_a])
    while True:
        further = points[points]
        if np.array_equal(further, points):
            return points[n:], points[:n]
        points = further


class Aligned:
    """Groups and links of texts whose tokens of both kinds give the same bytes.

    ``group_a`` and ``group_b`` number the groups of all texts from 0; links are in order of place, ``links_a`` and
    ``links_b`` are their tokens.
    """

    def __init__(self, lengths_a: np.ndarray, lengths_b: np.ndarray):
        ends_a, ends_b = np.cumsum(lengths_a), np.cumsum(lengths_b)
        last_a, last_b = terminals(ends_a, ends_b) if len(ends_b) else (ends_a, ends_b)
        number = np.cumsum(last_b == np.arange(len(ends_b))) - 1
        self.group_a, self.group_b = number[last_a], number[last_b]
        # Between two neighbouring ends lies the overlap of just one pair.
        edge = np.zeros(int(ends_a[-1]) + 1 if len(ends_a) else 1, bool)
        edge[ends_a] = edge[ends_b] = True
        parts = np.flatnonzero(edge)
        self.links_a, self.links_b = np.searchsorted(ends_a, parts), np.searchsorted(ends_b, parts)


@lru_cache(maxsize=2)
def _labels(size: int) -> pa.Array:
    """Each id followed by each of the three separators."""
    return pa.array([f"{i}{mark}" for i in range(size) for mark in ",|;"], pa.large_string())


def _written(ids_a: np.ndarray, ids_b: np.ndarray, aligned: Aligned, size: int) -> tuple[memoryview, np.ndarray]:
    """The groups of all texts as ``a1,a2|b1;…;``, and where each token's label begins, groups one after the other."""
    group_a, group_b = aligned.group_a, aligned.group_b
    goes_on_a, goes_on_b = (np.r_[g[1:] == g[:-1], False][:len(g)] for g in (group_a, group_b))
    groups = int(group_b[-1]) + 1
    place_a = np.arange(len(ids_a)) + np.searchsorted(group_b, np.arange(groups))[group_a]
    place_b = np.arange(len(ids_b)) + np.searchsorted(group_a, np.arange(groups), "right")[group_b]
    code = np.empty(len(ids_a) + len(ids_b), np.int64)
    code[place_a] = ids_a * 3 + np.where(goes_on_a, 0, 1)
    code[place_b] = ids_b * 3 + np.where(goes_on_b, 0, 2)
    labels = _labels(size).take(pa.array(code))
    return memoryview(labels.buffers()[2]), np.frombuffer(labels.buffers()[1], np.int64)[:len(code) + 1]


def _same(texts: bytes, ends: np.ndarray, side: Side, ids: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Whether the byte strings of each text's ids are its bytes."""
    own = np.r_[0, np.cumsum(segment_sums(side.lengths[ids], np.r_[0, np.cumsum(count)]))]
    data = side.bytes_of(ids)
    return np.array([texts[a:b] == data[c:d] for a, b, c, d in zip(ends[:-1], ends[1:], own[:-1], own[1:])], bool)


def align_slice(column: pa.Array, kinds: Tokenizers) -> tuple[dict[str, np.ndarray], list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Figures and group digests of some texts, then text, key and number of links of each text's distinct id pairs.

    The key of a pair is ``a * size_b + b``.
    """
    texts = pc.fill_null(column, "").to_pylist()
    n, size_b = len(texts), kinds.b.size
    full = np.array([bool(x) for x in texts], bool)
    (ids_a, count_a), (ids_b, count_b) = kinds.encode(texts)
    data, offsets = utf8(pa.array([f" {x}" for x in texts], pa.large_string()))
    data = data.tobytes()
    sound = full & _same(data, offsets, kinds.a, ids_a, count_a) & _same(data, offsets, kinds.b, ids_b, count_b)
    if not sound.all():
        ids_a, ids_b = ids_a[np.repeat(sound, count_a)], ids_b[np.repeat(sound, count_b)]
        count_a, count_b = count_a * sound, count_b * sound
    figures = {name: np.zeros(n, np.int64) for name in FIGURES}
    figures["n_a"], figures["n_b"] = count_a, count_b
    if not len(ids_a):
        nothing = np.zeros(0, np.int64)
        return figures, [""] * n, nothing, nothing, nothing
    aligned = Aligned(kinds.a.lengths[ids_a], kinds.b.lengths[ids_b])
    first_a, first_b = np.r_[0, np.cumsum(count_a)], np.r_[0, np.cumsum(count_b)]
    owner_a = np.repeat(np.arange(n), count_a)
    figures["n_groups"] = np.bincount(owner_a[np.flatnonzero(np.r_[True, np.diff(aligned.group_a) > 0])], minlength=n)
    text = owner_a[aligned.links_a]
    figures["n_links"] = np.bincount(text, minlength=n)
    labels, at = _written(ids_a, ids_b, aligned, max(kinds.a.size, size_b))
    cut = at[first_a + first_b].tolist()
    digests = [hashlib.sha256(labels[a:b - 1]).hexdigest() if b > a else "" for a, b in zip(cut[:-1], cut[1:])]
    pair = ids_a[aligned.links_a] * size_b + ids_b[aligned.links_b]
    every = kinds.a.size * size_b
    distinct, links = np.unique(text * every + pair, return_counts=True)
    return figures, digests, distinct // every, distinct % every, links


def _packed(columns: dict[str, pa.Array]) -> bytes:
    """A table in compressed Arrow form."""
    batch = pa.RecordBatch.from_arrays(list(columns.values()), list(columns))
    sink = io.BytesIO()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(batch)
    return sink.getvalue()


def _unpacked(data: bytes) -> pa.Table:
    with pa.ipc.open_stream(data) as reader:
        return reader.read_all()


def _align(spec: bytes, model: bytes, kept: list[str]):
    """Rows of (chunk, documents, pairs) for slices and of (chunk, key, docs) for the distinct pairs of chunks."""
    def rows(chunk: int, slices=(), keys=(), docs=()) -> pa.RecordBatch:
        n = max(len(slices), len(keys))
        return pa.RecordBatch.from_arrays([
            pa.array(np.full(n, chunk)), *[pa.array([x[k] for x in slices] or [None] * n, pa.binary()) for k in (0, 1)],
            *[pa.array(x, pa.int64()) if len(keys) else pa.nulls(n, pa.int64()) for x in (keys, docs)],
        ], ["chunk", "documents", "pairs", "key", "docs"])

    def asked(chunk: int, held: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        keys, place = np.unique(np.concatenate([x[0] for x in held]), return_inverse=True)
        docs = np.bincount(place, np.concatenate([x[1] for x in held])).astype(np.int64)
        for at in range(0, len(keys), 100_000):
            yield rows(chunk, keys=keys[at:at + 100_000], docs=docs[at:at + 100_000])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = tokenizers(spec, model)
        chunk, size, held = TaskContext.get().partitionId() << 32, 0, []
        for batch in (part for whole in batches for part in steps(whole, "_text", SLICE_BYTES)):
            figures, digests, text, key, links = align_slice(batch.column("_text"), kinds)
            keys, place = np.unique(key, return_inverse=True)
            held.append((keys, np.bincount(place, minlength=len(keys)).astype(np.int64)))
            # Places of a document rise; their differences take fewer bytes.
            gaps = np.diff(place, prepend=0)
            new = np.r_[True, text[1:] != text[:-1]][:len(text)]
            gaps[new] = place[new]
            own = {name: batch.column(name) for name in kept} | {x: pa.array(figures[x]) for x in FIGURES} | {
                "groups_sha256": pa.array(digests, pa.string()),
                "distinct_pairs": pa.array(np.bincount(text, minlength=batch.num_rows))}
            lists = {"keys": np.diff(keys, prepend=0), "gaps": gaps.astype(np.int32), "links": links.astype(np.int32)}
            yield rows(chunk, slices=[(_packed(own), _packed({
                name: pa.LargeListArray.from_arrays([0, len(x)], pa.array(x)) for name, x in lists.items()}))])
            size += batch.column("_text").nbytes
            if size >= CHUNK_BYTES:
                yield from asked(chunk, held)
                chunk, size, held = chunk + 1, 0, []
        if held:
            yield from asked(chunk, held)
    return run


def _totals(kept: list[str]):
    """Documents of a chunk with the totals over their links."""
    def totals(answers: pa.Table, slices: pa.Table) -> pa.Table:
        order = np.argsort(answers.column("key").to_numpy())
        key, docs, best = (answers.column(x).to_numpy()[order] for x in ("key", "docs", "best"))
        out = []
        for row in slices.select(["documents", "pairs"]).to_pylist():
            rows = _unpacked(row["documents"])
            gaps, links, keys = (_unpacked(row["pairs"]).column(x).combine_chunks().values.to_numpy() for x in ("gaps", "links", "keys"))
            first = np.r_[0, np.cumsum(rows.column("distinct_pairs").to_numpy())]
            at = np.searchsorted(key, np.cumsum(keys))
            run = np.r_[0, np.cumsum(gaps, dtype=np.int64)]
            place = run[1:] - np.repeat(run[first[:-1]], np.diff(first))
            sums = {"n_best": segment_sums(best[at][place] * links, first).astype(np.int64),
                    "count_sum": segment_sums(docs[at][place] * links, first).astype(np.int64)}
            for name, values in sums.items():
                rows = rows.append_column(name, pa.array(values, pa.int64()))
            out.append(rows.select([*kept, *FIGURES, *sums, "groups_sha256"]))
        return pa.concat_tables(out)
    return totals


def align(docs: DataFrame, spec: bytes, model: bytes, columns: list[str], text: str = "text") -> DataFrame:
    """``columns`` of each document with its tokens, groups and links, and what the corpus says about the links.

    n_a and n_b are tokens, n_groups groups, n_links overlapping pairs; count_sum adds up over the links how many documents
    hold their id pair linked, and n_best counts the links whose pair is the most frequent of its first id (ties too).
    groups_sha256 is the digest of the groups. A NULL or empty text, or one that a tokenizer does not give back byte by
    byte, has no tokens: zeros, and an empty digest. Rows are documents of their own, repeated ones too. An empty table
    gives no rows. The tokens of one text are in memory together, however long it is. ``columns`` may be any but the
    added names; other columns are not read.
    """
    read = docs.select(*columns, F.col(text).alias("_text"))
    kept = [f for f in read.schema.fields if f.name != "_text"]
    names = [f.name for f in kept]
    work = saved(read.mapInArrow(
        _align(spec, model, names), "chunk bigint, documents binary, pairs binary, key bigint, docs bigint"), "aligned")
    size_b = sentencepiece.SentencePieceProcessor(model_proto=model).vocab_size()
    asked = work.filter("key IS NOT NULL").select("chunk", "key")
    counts = saved(work.filter("key IS NOT NULL").groupBy("key").agg(F.sum("docs").alias("docs")), "counts")
    first_id = F.expr(f"key DIV {size_b}")
    # One row for each id of the first vocabulary at most.
    best = counts.groupBy(first_id.alias("_a")).agg(F.max("docs").alias("_most"))
    answers = asked.join(counts, "key").join(F.broadcast(best), first_id == F.col("_a")).select(
        "chunk", "key", "docs", (F.col("docs") == F.col("_most")).cast("int").alias("best"))
    slices = work.filter("documents IS NOT NULL").select(F.col("chunk").alias("of"), "documents", "pairs")
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [
        f"{x} bigint" for x in [*FIGURES, "n_best", "count_sum"]] + ["groups_sha256 string"])
    return answers.groupBy("chunk").cogroup(slices.groupBy("of")).applyInArrow(_totals(names), schema)
