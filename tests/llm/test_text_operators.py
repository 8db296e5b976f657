"""Rules, decontamination, personal data and encoding against plain Python over random and odd texts."""

import hashlib
import pickle
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from txn_analytics.llm import decontaminate, pieces, pii, quality_rules, queries, token_counts
from txn_analytics.llm.queries import PIECES, read_model
from txn_analytics.llm.words import NOT_SPACE, Words

MODEL = read_model(PIECES)
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PIECES)


def words_of(text):
    return [w for w in re.split("[\x20\x09-\x0D]+", text or "") if w]


def alphanumeric(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def rule_counts(text):
    words, lines, seen, again, cover = words_of(text), (text or "").split("\n"), set(), 0, set()
    for line in lines:
        if words_of(line):
            again += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    for i in range(len(words) - 7):
        if windows[tuple(words[i:i + 8])] > 1:
            cover |= set(range(i, i + 8))
    failed = len(words) < 20 or 100 * len(cover) > 30 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), again, len(cover), failed


@pytest.mark.parametrize("table", ["documents", "odd_documents"])
def test_rules_count_what_plain_python_counts(request, table):
    docs = request.getfixturevalue(table)
    judged = quality_rules.quality_rules(docs, quality_rules.learn_references(docs), ["doc_id", "text"]).collect()
    assert len(judged) == docs.count()
    for row in judged:
        assert tuple(row[x] for x in quality_rules.ADDED[:6]) == rule_counts(row.text), row.text
        assert not (row.base_failed and row.kept)


def test_rules_tell_junk_from_text(spark, documents):
    clean = " ".join(["the river of stone and a blue sky to walk"] + [f"w{i} of the" for i in range(150)])
    junk = " ".join(f"W{i}*** $$$!!" for i in range(300))
    docs = documents.unionByName(spark.createDataFrame(
        [(1000 + i, f"{clean} v{i}", "en", "s", 0) for i in range(40)] + [(2000, junk, "en", "s", 0)], documents.schema))
    judged = {r.doc_id: r for r in quality_rules.quality_rules(docs, quality_rules.learn_references(docs), ["doc_id"]).collect()}
    assert all(judged[1000 + i].kept for i in range(40))
    assert not judged[2000].base_failed and not judged[2000].kept


@pytest.mark.parametrize("tag", ["tail", "unknown", None])
def test_rules_judge_texts_of_rare_languages(spark, tag):
    """Junk is far whatever its tag is, and the verdicts do not change with the documents of other languages."""
    clean = " ".join(["the river of stone and a blue sky to walk"] + [f"w{i} of the" for i in range(150)])
    junk = " ".join(f"W{i}*** $$$!!" for i in range(300))
    tail = [(3000 + i, f"{clean} v{i}", "tail", "s", 0) for i in range(35)] + [(2000, junk, tag, "s", 0)]
    for others in (0, 40, 40_000):     # at 40,000 the tail has under 0.1 per cent of the documents
        docs = spark.createDataFrame(tail, "doc_id bigint, text string, lang string, source string, n_chars int").unionByName(
            spark.range(others).selectExpr("10000 + id AS doc_id", "concat('short text ', id) AS text", "'en' AS lang",
                                           "'s' AS source", "0 AS n_chars"))
        judged = quality_rules.quality_rules(docs, quality_rules.learn_references(docs), ["doc_id"]).filter("doc_id < 10000")
        kept = {r.doc_id: r.kept for r in judged.collect()}
        assert not kept.pop(2000) and len(kept) == 35 and all(kept.values()), others


def test_rules_judge_small_inputs(spark, documents):
    clean = " ".join(["the river of stone and a blue sky to walk"] + [f"w{i} of the" for i in range(150)])
    junk = " ".join(f"W{i}*** $$$!!" for i in range(300))
    docs = spark.createDataFrame(
        [(i, f"{clean} v{i}", f"l{i % 3}", "s", 0) for i in range(12)] + [(2000, junk, "l0", "s", 0)], documents.schema)
    kept = {r.doc_id: r.kept for r in quality_rules.quality_rules(docs, quality_rules.learn_references(docs), ["doc_id"]).collect()}
    assert not kept.pop(2000) and all(kept.values())


@pytest.mark.parametrize("good", [1, 5, 28, 29, 30, 31])
def test_rules_judge_alike_whatever_the_number_of_texts(spark, good):
    clean = " ".join(["the river of stone and a blue sky to walk"] + [f"w{i} of the" for i in range(150)])
    other = " ".join(["der Fluss und ein Stein zu gehen"] + [f"v{i} und der" for i in range(150)])
    junk = " ".join(f"W{i}*** $$$!!" for i in range(300))
    rows = [(i, f"{clean} v{i}", "few") for i in range(good)] + [(500 + i, f"{other} v{i}", "many") for i in range(60)]
    rows += [(2000 + i, f"{junk} {i}", tag) for i, tag in enumerate(("few", "many", "unknown", None))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    kept = {r.doc_id: r.kept for r in quality_rules.quality_rules(docs, quality_rules.learn_references(docs), ["doc_id"]).collect()}
    assert {k for k, v in kept.items() if not v} == {2000, 2001, 2002, 2003}


def brute_distances(text, refs):
    """Least distances to the references, from their definition."""
    def divergence(p, q):
        m = [(a + b) / 2 for a, b in zip(p, q)]
        return sum((a * np.log2(a / c) if a else 0) / 2 + (b * np.log2(b / c) if b else 0) / 2 for a, b, c in zip(p, q, m))
    words = re.split("[\x20\x09-\x0D]+", text.strip(" \t\n\v\f\r"))
    kinds = Counter()
    for c in text:
        byte = c.encode()[0]
        kinds[int(quality_rules.CLASS_OF[byte])] += 1
    p = [kinds[k] / len(text) for k in range(len(quality_rules.CLASSES))]
    code = {w: Words(pa.array([w]), NOT_SPACE).hashes()[0] for w in set(words)}
    shares = Counter(code[w] for w in words)
    by_word = []
    for places, own in refs.shares:
        common = dict(zip(refs.words[places].tolist(), own.tolist()))
        a = [shares[np.uint64(k)] / len(words) for k in common]
        by_word.append(divergence([*a, 1 - sum(a)], [*common.values(), 1 - sum(common.values())]))
    return np.sqrt([min(divergence(p, q) for q in refs.classes), min(by_word)])


def test_distances_and_verdicts_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    refs = quality_rules.learn_references(docs)
    judged = {r.doc_id: r for r in quality_rules.quality_rules(docs, refs, ["doc_id", "text", "lang"]).collect()}
    some = [r for r in judged.values() if r.n_words >= 50][:40]
    for row in some:
        assert np.allclose(brute_distances(row.text, refs), [row.char_distance, row.word_distance], atol=1e-9)
    query = {r.doc_id: tuple(r) for r in queries.op9_quality_rules(spark, "/root/testdata/sf0.001").collect()}
    assert query.keys() == judged.keys()
    for doc_id, row in judged.items():
        assert query[doc_id][1:7] == rule_counts(row.text)
        assert query[doc_id][7] == row.kept and (row.kept or row.base_failed or row.n_words >= 50)
    # What is dropped by distance is symbol junk, and no junk of the kind is left.
    noisy = {k: sum(c in "#*$%&|" for c in r.text) > 0.3 * r.n_words for k, r in judged.items() if r.text and not r.base_failed and r.n_words >= 50}
    assert {k for k, n in noisy.items() if n} == {k for k in noisy if not judged[k].kept}


def test_rules_without_references_or_rows(documents, no_documents):
    empty = quality_rules.learn_references(no_documents)
    assert empty.languages == []
    assert quality_rules.quality_rules(no_documents, empty, ["doc_id"]).count() == 0
    kept = quality_rules.quality_rules(documents, empty, ["doc_id"]).collect()
    assert all(r.kept != r.base_failed for r in kept)


def hits(text, items, size=10):
    words, inside, met = alphanumeric(text), set(), set()
    for item, value in items:
        own = alphanumeric(value)
        n = min(size, len(own))
        for window in {tuple(own[k:k + n]) for k in range(len(own) - n + 1)} if own else ():
            for i in range(len(words) - n + 1):
                if tuple(words[i:i + n]) == window:
                    inside |= set(range(i, i + n))
                    met.add(item)
    return len(words), len(inside), sorted(met)


ITEMS = [(1, "same WORDS here for all of them to see"), (2, "x1"), (30, None), (4, ""), (5, "... !"), (6, "the of and the of and the of and the of"),
         (7, " ".join(f"q{i}" for i in range(25))), (7, "second text of seven"), (8, "x1"), (None, "a")]


@pytest.mark.parametrize("table", ["documents", "odd_documents"])
@pytest.mark.parametrize("block_bytes", [1_000_000, 30])
def test_contamination_is_exact_in_one_block_and_in_many(spark, request, table, block_bytes):
    docs = request.getfixturevalue(table)
    more = [" ".join(f"Q{i}" for i in range(3, 25)) + " and x1.", "q1 q2"]
    docs = docs.select("doc_id", "text").union(spark.createDataFrame(list(enumerate(more, 5000)), "doc_id bigint, text string"))
    benchmark = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    items = [(a, b) for a, b in ITEMS if a is not None and b is not None]
    for row in decontaminate.contamination(docs, benchmark, ["doc_id", "text"], block_bytes=block_bytes).collect():
        assert (row.n_words, row.n_hit, row.hit_items) == hits(row.text, items), row.text
        assert sum(s.end - s.start for s in row.hit_words) == row.n_hit
    clean = decontaminate.remove_spans(docs, benchmark, block_bytes=block_bytes).collect()
    assert all(hits(r.text, items)[1] == 0 for r in clean) and len(clean) == docs.count()


def test_contamination_of_nothing(spark, documents, no_documents):
    benchmark = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert decontaminate.contamination(no_documents, benchmark, ["doc_id"]).count() == 0
    none = decontaminate.contamination(documents, benchmark.limit(0), ["doc_id"]).collect()
    assert all(r.n_hit == 0 and r.hit_items == [] for r in none)


def test_items_may_have_ids_of_text(spark):
    docs = spark.createDataFrame([(1, "a b c and x y"), (2, "z")], "doc_id bigint, text string")
    benchmark = spark.createDataFrame([("k2", "x y"), ("k1", "b C"), ("k10", "a b")], "name string, body string")
    found = {r.doc_id: r for r in decontaminate.contamination(docs, benchmark, ["doc_id"], item="name", item_text="body").collect()}
    assert found[1].hit_items == ["k1", "k10", "k2"] and found[1].n_hit == 5 and found[2].hit_items == []


def test_windows_that_a_cut_of_another_block_joins_go_too(spark):
    one, two, three = (" ".join(f"{x}{i}" for i in range(10)) for x in "pqr")
    inner = two.replace("q5", f"q5 {three}").split(" q5 ")
    text = one.replace("p5", f"p5 {inner[0]} q5 {inner[1]}")
    docs = spark.createDataFrame([(1, f"start {text} end"), (2, "clean"), (3, None)], "doc_id bigint, text string")
    benchmark = spark.createDataFrame([(1, one), (2, two), (3, three)], "item_id bigint, text string")
    clean = {r.doc_id: r.text for r in decontaminate.remove_spans(docs, benchmark, block_bytes=20).collect()}
    assert clean[1].split() == ["start", "end"] and clean[2] == "clean" and clean[3] is None


def test_a_set_is_small_beside_its_text():
    rng = random.Random(3)
    items = [(i, " ".join(f"w{rng.randrange(10 ** 5)}" for _ in range(200))) for i in range(2000)]
    size = sum(len(text) for _, text in items)
    assert len(pickle.dumps(decontaminate.NgramSet(items))) < 7 * size + (2 << 20)


PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                    "card": 16 <= len(digits) <= 19 and pii.luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]:
                yield kind, m.start(), m.end()


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(
    ["a", "b@", "@", ".", "c.d", "-", "+", "1", "49", "255", "256.", "10.0.0.1", "4111 1111 1111 1111", "4111-1111-1111-1112",
     " ", "(", ")", "é", "555", "x@y.z", "\n", "0000000000000000"]), max_size=14).map("".join))
def test_base_spans_are_those_of_the_patterns(text):
    assert pii.base_spans(text) == list(plain_spans(text))


def test_personal_data_of_odd_texts(odd_documents, no_documents):
    found = pii.find(odd_documents, ["doc_id", "text"]).collect()
    assert len(found) == odd_documents.count()
    for row in found:
        assert [tuple(s) for s in row.base] == list(plain_spans(row.text or ""))
        assert all(a.end <= b.start or b.end <= a.start for a in row.added for b in row.base)
    assert pii.find(no_documents, ["doc_id"]).count() == 0
    assert pii.redact(odd_documents).schema.simpleString() == odd_documents.schema.simpleString()


def test_classifier_adds_secrets_and_leaves_numbers(spark):
    rows = [f'call me: token = "{hashlib.sha1(str(i).encode()).hexdigest()}" and mail a{i}@b.com or 10.0.0.{i}' for i in range(60)]
    rows += [f"page {i} of 1234567{i} and version 1.2.3.4567{i} isbn 978316148410{i}" for i in range(60)]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string")
    found = {r.doc_id: r for r in pii.find(docs, ["doc_id"]).collect()}
    assert all([s.kind for s in found[i].added] == ["secret"] for i in range(60))
    assert all(found[i].added == [] for i in range(60, 120))
    masked = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert masked[0] == 'call me: token = "<secret>" and mail <email> or <ip>' and masked[60] == rows[60]


def test_em_trusts_the_labeler_that_agrees():
    votes = np.array([[1, 1, 1, 0, 0], [0, 0, 0, 1, 0], [1, 1, 1, 1, 0], [0, 0, 0, 0, 0]])
    table, personal = pii.reliabilities(votes, np.array([50.0, 50.0, 50.0, 50.0]))
    assert personal[0] > 0.9 and personal[2] > 0.9 and personal[1] < 0.1 and personal[3] < 0.1
    assert abs(table[3, 1, 1] - 0.5) < 0.1 and table[0, 1, 1] > 0.9


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(
    ["a", "b", "the", "in", "tion", " ", "  ", "▁", "\n", "\t", "é", "é", "你", "😀", "\x00", "<s>", "1", ".", ",", "!!", "É", "ß", "==",
     "    ", " " * 17, "//", "aaaa", "ﬁ", "http://"]), max_size=40).map("".join))
def test_encoding_is_that_of_the_library(text):
    vocabulary = pieces.vocabulary(MODEL)
    ids = vocabulary.encode(pa.array([text]))
    assert ids.to_pylist()[0] == LIBRARY.encode(text, add_eos=True)
    assert vocabulary.decode(ids).to_pylist()[0] == LIBRARY.decode(ids.to_pylist()[0])


def test_encoding_of_odd_documents(odd_documents, no_documents):
    coded = pieces.decode(pieces.encode(odd_documents.selectExpr("doc_id", "text", "text AS was"), MODEL), MODEL).collect()
    for row in coded:
        assert row.ids == LIBRARY.encode(row.was or "", add_eos=True) and row.text == LIBRARY.decode(row.ids)
    assert len(coded) == odd_documents.count()
    assert pieces.decode(pieces.encode(no_documents.select("doc_id", "text"), MODEL), MODEL).count() == 0


def test_token_histogram(spark, documents, odd_documents, no_documents):
    docs = documents.select("text").union(odd_documents.select("text"))
    lengths = sorted(len(LIBRARY.encode(r.text or "", add_eos=True)) for r in docs.collect())
    histogram = token_counts.length_histogram(token_counts.encoded_lengths(docs, MODEL))
    rows = {r.n_tokens: r for r in histogram.collect()}
    assert set(rows) == set(lengths)
    for n, r in rows.items():
        longer = [x for x in lengths if x >= n]
        assert (r.n_docs, r.docs_at_least, r.tokens_at_least) == (lengths.count(n), len(longer), sum(longer))
        assert (r.docs_up_to, r.tokens_truncated) == (sum(x <= n for x in lengths), sum(min(x, n) for x in lengths))
    cut = {r.limit: (r.docs_longer, r.tokens_kept) for r in token_counts.truncated_totals(histogram, [0, 7, 100, 10 ** 9]).collect()}
    assert cut == {x: (sum(n > x for n in lengths), sum(min(n, x) for n in lengths)) for x in (0, 7, 100, 10 ** 9)}
    quantile = {r.share: r.n_tokens for r in token_counts.quantiles(histogram, [0.25, 0.5, 1.0]).collect()}
    assert quantile == {s: next(x for i, x in enumerate(lengths, 1) if i >= s * len(lengths)) for s in (0.25, 0.5, 1.0)}
    assert token_counts.length_histogram(token_counts.encoded_lengths(no_documents, MODEL)).count() == 0
    assert token_counts.length_histogram(spark.createDataFrame([(None,)], "n_tokens bigint")).count() == 0


def test_histogram_counts_lengths_in_many_blocks(spark):
    lengths = spark.range(1, 5000).selectExpr("id * 7 AS n_tokens")
    rows = {r.n_tokens: r for r in token_counts.length_histogram(lengths).collect()}
    assert rows[7].tokens_at_least == 7 * sum(range(1, 5000)) and rows[7 * 4999].docs_up_to == 4999
    assert rows[700].docs_at_least == 4900 and rows[700].tokens_truncated == 7 * sum(range(1, 100)) + 700 * 4900


def test_op10_query_encodes_once_and_equals_the_library(spark):
    folder = "/root/testdata/sf0.001"
    histogram = queries.op10_token_counts(spark, folder)
    assert "MapInArrow" not in histogram._jdf.queryExecution().executedPlan().toString()     # it reads the saved counts
    texts = [r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    lengths = [len(LIBRARY.encode(x)) + 1 for x in texts]
    rows = {r.n_tokens: r for r in histogram.collect()}
    assert {k: r.n_docs for k, r in rows.items()} == Counter(lengths)
    for k, r in rows.items():
        longer = [x for x in lengths if x >= k]
        assert (r.docs_at_least, r.tokens_at_least, r.docs_up_to, r.tokens_truncated) == (
            len(longer), sum(longer), sum(x <= k for x in lengths), sum(min(x, k) for x in lengths))


def test_words_of_a_benchmark_item():
    assert decontaminate.normalised(None) == [] and decontaminate.normalised("A-b Ü") == [b"a", b"b", "Ü".encode()]
