"""Byte pairs, periodic runs and token alignment against the libraries and against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from txn_analytics.llm import byte_pairs, periodic_runs, queries, token_alignment
from txn_analytics.llm.words import mix

SPEC, MODEL = queries.read_model(queries.BYTE_PAIRS), queries.read_model(queries.PIECES)
FOLDER = "/root/testdata/sf0.001"
STRANGE = ["<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext|>", "  \n\n  a", "don't we'll I'M 'S", "x" * 5000, " " * 3000 + "y",
           "  \x1c\x85 ​", "é́ 你好 \U0001f600\x00", "▁ ▁▁x", "<s> </s> <0x41> <unk>", "१२ ٣ⅷ²", "\r\n\t \v"]


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(queries.BYTE_PAIRS)


@pytest.fixture(scope="module")
def given(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    return {row.doc_id: row.text for row in rows}


# ---------------------------------------------------------------- byte pairs

def test_every_character_is_cut_as_in_the_library(library):
    texts = [f"a{chr(c)}b 1{chr(c)}2 .{chr(c)}. {chr(c)} {chr(c)}{chr(c)} x" for c in range(0x3100)]
    ids, count = byte_pairs.ByteVocabulary(SPEC).encode(texts)
    expected = library.encode_batch(texts, add_special_tokens=False)
    assert ids.tolist() == [i for e in expected for i in e.ids] and count.tolist() == [len(e.ids) for e in expected]


def test_random_words_and_strange_texts(library):
    rng = random.Random(5)
    texts = STRANGE + ["".join(rng.choice("abcdeth nsTH'é1 .\n") for _ in range(rng.randrange(200))) for _ in range(500)]
    words = byte_pairs.ByteVocabulary(SPEC)
    ids, count = words.encode(texts)
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert ids.tolist() == [i for e in expected for i in e]
    assert words.decode(ids, count).to_pylist() == texts
    plain = byte_pairs.ByteVocabulary(SPEC, added=False).encode(STRANGE[:1])[0]
    assert len(plain) > 1 and library.decode(plain.tolist()) == STRANGE[0]


def test_ids_that_are_no_text_decode_as_in_the_library(library):
    rng = np.random.default_rng(0)
    lists = [rng.integers(0, 50257, rng.integers(0, 30)) for _ in range(100)]
    got = byte_pairs.ByteVocabulary(SPEC).decode(np.concatenate(lists), np.array([len(x) for x in lists]))
    assert got.to_pylist() == [library.decode(x.tolist(), skip_special_tokens=False) for x in lists]
    assert byte_pairs.ByteVocabulary(SPEC).decode(np.array([-1, 64, 60000]), np.array([2, 1])).to_pylist() == ["a", ""]


def test_forgetting_words_changes_nothing(library, texts, monkeypatch):
    monkeypatch.setattr(byte_pairs, "REMEMBERED", 3)
    words = byte_pairs.ByteVocabulary(SPEC)
    for at in range(0, len(texts), 7):
        assert words.encode(texts[at:at + 7])[0].tolist() == [
            i for e in library.encode_batch(texts[at:at + 7], add_special_tokens=False) for i in e.ids]


def test_byte_pairs_of_odd_documents(odd_documents, no_documents, library):
    for packed in (False, True):
        coded = byte_pairs.decode(byte_pairs.encode(odd_documents, SPEC, packed=packed), SPEC, text="back")
        assert set(coded.columns) == {*odd_documents.columns, "back"} - {"text"}
        got = Counter((row.doc_id, row.back) for row in coded.collect())
        assert got == Counter((row.doc_id, row.text or "") for row in odd_documents.select("doc_id", "text").collect())
        assert byte_pairs.decode(byte_pairs.encode(no_documents, SPEC, packed=packed), SPEC).count() == 0
    ids = {row.doc_id: row.ids for row in byte_pairs.encode(odd_documents.limit(17), SPEC).collect()}
    text = {row.doc_id: row.text or "" for row in odd_documents.limit(17).select("doc_id", "text").collect()}
    assert all(list(ids[k]) == library.encode(text[k], add_special_tokens=False).ids for k in text)


def test_op11_query_against_the_library(spark, given, library):
    got = {row.doc_id: tuple(row)[1:] for row in queries.op11_byte_pairs(spark, FOLDER).collect()}
    assert got.keys() == given.keys()
    for doc_id, text in given.items():
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert got[doc_id] == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                               sha(library.decode(ids, skip_special_tokens=False)))


# ---------------------------------------------------------------- periodic runs

def all_runs(words: list) -> list[tuple[int, int, int]]:
    """Every stretch that no word extends, for every period; of one stretch the smallest."""
    best: dict[tuple[int, int], int] = {}
    for q in range(1, len(words) // 3 + 1):
        at = 0
        while at + q < len(words):
            end = at
            while end + q < len(words) and words[end] == words[end + q]:
                end += 1
            if end > at and end - at + q >= max(24, 3 * q):
                best.setdefault((at, end - at + q), q)
            at = max(end, at + 1)
    return sorted((start, size, q) for (start, size), q in best.items())


def some_words(rng: random.Random, kind: int) -> list[int]:
    n, words = rng.randrange(0, 350), []
    if kind == 0:
        return [rng.randrange(2) for _ in range(n)]
    if kind == 1:                                  # many stretches of many periods
        while len(words) < n:
            part = [rng.randrange(rng.choice([2, 3, 30])) for _ in range(rng.randrange(1, 60))]
            words += (part * rng.randrange(1, 6))[:rng.randrange(1, 200)]
        return words
    if kind == 2:                                  # one long run with a few changed words
        words = ([rng.randrange(3) for _ in range(rng.randrange(1, 40))] * 50)[:n]
        for _ in range(rng.randrange(3) if words else 0):
            words[rng.randrange(len(words))] = 9
        return words
    if kind == 3:                                  # runs inside the period of a run
        return [5, 6] + ([1] * rng.randrange(20, 40) + [2]) * rng.randrange(2, 6) + [7]
    a, b = [1], [1, 2]                             # Fibonacci words: a run at nearly every place
    while len(b) < n:
        a, b = b, b + a
    return (b * 3)[:rng.randrange(1, len(b) * 3)]


def test_runs_against_brute_force():
    rng, hashes = random.Random(1), mix(np.arange(1, 100, dtype=np.uint64))
    texts = [some_words(rng, k % 5) for k in range(500)] + [[], [1]]
    found = periodic_runs.runs(hashes[np.array([x for t in texts for x in t], np.int64)], np.array([len(t) for t in texts]))
    got = defaultdict(list)
    for text, *run in zip(*(x.tolist() for x in found)):
        got[text].append(tuple(run))
    assert sum(map(len, got.values())) > 500
    for k, words in enumerate(texts):
        assert got[k] == all_runs(words)


def test_scales_cover_all_periods_and_leave_a_window():
    pairs = periodic_runs.scales(10_000)
    assert pairs[0][0] == 9 and all(b[0] == a[1] + 1 for a, b in zip(pairs, pairs[1:])) and pairs[-1][1] >= 10_000
    assert all(2 * low - high + 1 >= 1 for low, high in pairs)


def planted(doc_id: int, text: str | None) -> list[str]:
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 == 0 and n:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def test_op12_query_against_brute_force(spark, given):
    got = {row.doc_id: tuple(row)[1:] for row in queries.op12_periodic_runs(spark, FOLDER).collect()}
    assert got.keys() == given.keys() and sum(row[0] > 0 for row in got.values()) > 10
    for doc_id, text in given.items():
        words = planted(doc_id, text)
        if len(words) > 3000:
            continue                               # brute force takes the square of it
        found = all_runs(words)
        drop = {i for start, size, q in found for i in range(start + q, start + size)}
        best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
        first = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
        assert got[doc_id] == (len(found), *first, sha("".join(f"{s},{n},{q}\n" for s, n, q in found)),
                               sha(" ".join(w for i, w in enumerate(words) if i not in drop)))


def test_runs_of_odd_documents(odd_documents, no_documents):
    rows = periodic_runs.periodic_runs(odd_documents, ["doc_id", "score", "ids"]).collect()
    assert len(rows) == odd_documents.count()
    by_id = {row.doc_id: row for row in rows}
    assert by_id[0].runs == [] and by_id[0].collapsed == "" and by_id[1].collapsed == "" and by_id[2].collapsed == ""
    assert [tuple(r) for r in by_id[7].runs] == [(0, 30_000, 1)] and by_id[7].collapsed == "w"
    assert [tuple(r) for r in by_id[8].runs] == [(0, 30, 1)] and by_id[8].collapsed == "line"
    assert by_id[9].collapsed == "é你😀 \x00 ﬁ"
    assert periodic_runs.periodic_runs(no_documents, ["doc_id"]).count() == 0


def test_planted_periods_take_any_id(spark, odd_documents):
    assert queries.with_planted_periods(odd_documents).count() == odd_documents.count()


# ---------------------------------------------------------------- token alignment

def by_definition(rows: list[tuple[int, str | None]], library, pieces) -> dict[int, tuple]:
    first = {i: bytes(byte_pairs.printable_bytes()[c] for c in t) for t, i in library.get_vocab().items() if t != "<|endoftext|>"}

    def second(i):
        piece = pieces.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if pieces.is_byte(i) else piece.replace("▁", " ").encode()

    out, linked, held = {}, {}, Counter()
    for key, (doc_id, text) in enumerate(rows):
        space = f" {text or ''}"
        a = byte_pairs.ByteVocabulary.encode(VOCABULARY, [space])[0].tolist()
        b = pieces.encode(text or "")
        if not text or b"".join(map(first.get, a)) != space.encode() or b"".join(map(second, b)) != space.encode():
            out[key] = (doc_id, 0, 0, 0, 0, "")
            linked[key] = []
            continue
        ends_a, ends_b = np.cumsum([len(first[x]) for x in a]).tolist(), np.cumsum([len(second(x)) for x in b]).tolist()
        starts_a, starts_b = [0, *ends_a[:-1]], [0, *ends_b[:-1]]
        links, j0 = [], 0
        for i, x in enumerate(a):
            while ends_b[j0] <= starts_a[i]:
                j0 += 1
            j = j0
            while j < len(b) and starts_b[j] < ends_a[i]:
                links.append((x, b[j]))
                j += 1
        cuts = sorted(set(ends_a) & set(ends_b))
        groups, i, j = [], 0, 0
        for cut in cuts:
            ga, gb = [], []
            while i < len(a) and ends_a[i] <= cut:
                ga.append(a[i])
                i += 1
            while j < len(b) and ends_b[j] <= cut:
                gb.append(b[j])
                j += 1
            groups.append(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)))
        out[key] = (doc_id, len(a), len(b), len(groups), len(links), sha(";".join(groups)))
        linked[key] = links
        held.update(set(links))
    most = defaultdict(int)
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    return Counter((*out[k][:5], sum(held[p] == most[p[0]] for p in linked[k]), sum(held[p] for p in linked[k]), out[k][5]) for k in out)


VOCABULARY = byte_pairs.ByteVocabulary(SPEC, added=False)


@pytest.fixture(scope="module")
def pieces_library():
    return sentencepiece.SentencePieceProcessor(model_file=queries.PIECES)


def test_op13_query_by_definition(spark, given, library, pieces_library):
    got = queries.op13_token_alignment(spark, FOLDER)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert Counter(map(tuple, got.collect())) == by_definition(list(given.items()), library, pieces_library)


def test_alignment_over_many_chunks_and_odd_documents(spark, odd_documents, no_documents, texts, library, pieces_library, monkeypatch):
    more = spark.createDataFrame(list(enumerate(texts + STRANGE, 100)), "doc_id bigint, text string")
    docs = odd_documents.select("doc_id", "text", "ids").unionByName(more, allowMissingColumns=True)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    expected = by_definition(rows, library, pieces_library)
    assert Counter(map(tuple, token_alignment.align(docs, SPEC, MODEL, ["doc_id"]).collect())) == expected
    kept = token_alignment.align(docs, SPEC, MODEL, ["ids", "doc_id"]).collect()
    assert {tuple(r.ids) for r in kept if r.ids} == {(1,)} and len(kept) == len(rows)
    assert token_alignment.align(no_documents, SPEC, MODEL, ["doc_id"]).count() == 0


def test_pointers_end_at_common_ends():
    rng = np.random.default_rng(2)
    for _ in range(50):
        n = int(rng.integers(1, 200))
        a, b = (np.unique(np.r_[rng.integers(1, n + 1, int(rng.integers(0, n))), n]) for _ in range(2))
        last_a, last_b = token_alignment.terminals(a, b)
        common = np.intersect1d(a, b)
        for ends, last in ((a, last_a), (b, last_b)):
            assert np.array_equal(b[last], common[np.searchsorted(common, ends)])
