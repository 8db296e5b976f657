"""Near duplicates, language model, classifiers, URL filter and the pipeline against brute force."""

import math
import os
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from txn_analytics.llm import language_model, near_duplicates, quality_classifier, queries, toxicity, url_filter
from txn_analytics.llm.queries import PIECES, read_model

MODEL = read_model(PIECES)


def words_of(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [w for w in re.split("[\x20\x09-\x0D]+", lower) if w]


def shingles(text):
    words = words_of(text)
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def brute_groups(texts):
    """{id: (size, smallest id reachable)} by all pairs."""
    sets = {k: shingles(t) for k, t in texts.items()}
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 75 * len(sets[a] | sets[b]):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {k: (len(sets[k]), find(k)) for k in sets}


def chain(rng, length, steps):
    """Texts of which each differs a little from the one before: ends are far apart, yet linked."""
    words = [f"c{rng.randrange(10 ** 6)}" for _ in range(length)]
    for _ in range(steps):
        yield " ".join(words)
        words[rng.randrange(length)] = f"c{rng.randrange(10 ** 6)}"


@pytest.mark.parametrize("block", [2000, 3])
def test_groups_are_those_of_all_pairs(spark, texts, monkeypatch, block):
    monkeypatch.setattr(near_duplicates, "BLOCK", block)
    rng = random.Random(3)
    rows = dict(enumerate([*texts, *chain(rng, 60, 25), *chain(rng, 7, 3), *chain(rng, 300, 30)]))
    passage = " ".join(f"p{i}" for i in range(40))
    rows |= {1000 + i: passage + " " + " ".join(f"own{i}_{k}" for k in range(12 + i % 5)) for i in range(40)}
    docs = spark.createDataFrame(list(rows.items()), "doc_id bigint, text string")
    found = {r.id: (r.n_shingles, r.component) for r in near_duplicates.near_duplicates(docs).collect()}
    assert found == brute_groups(rows)


def test_groups_of_odd_documents(odd_documents, no_documents):
    found = near_duplicates.near_duplicates(odd_documents).collect()
    assert len(found) == odd_documents.count()
    with_id = {r.id: (r.n_shingles, r.component) for r in found if r.id is not None}
    assert with_id == brute_groups({r.doc_id: r.text for r in odd_documents.collect() if r.doc_id is not None})
    assert near_duplicates.near_duplicates(no_documents).count() == 0


def test_pairs_across_components_need_no_more_than_one_table():
    """Two sets that the bounds allow are confirmed, even if no minhashes agree but those of the table."""
    rng = np.random.default_rng(5)
    sides = rng.integers(0, 2 ** 31, (2, 2, near_duplicates.SIDE)).astype(np.uint32)
    sides[1] = sides[0] ^ 1
    sides[1, :, 0] = sides[0, :, 0]
    lanes = sides.reshape(2, -1).view(np.int64)
    row = {"key": [1, 1], "t": [0, 0], "p": [0, 0], "q": [0, 0], "part": [0, 0], "id": [4, 9], "component": [4, 9], "n": [80, 75]}
    row |= {s: [0, 0] for s in near_duplicates._SKETCH} | {m: lanes[:, k] for k, m in enumerate(near_duplicates._LANES)}
    batch = pa.RecordBatch.from_pydict({k: pa.array(v, pa.int64()) for k, v in row.items()})
    assert [x.to_pylist() for x in near_duplicates._across(iter([batch]))] == [[{"a": 4, "b": 9}]]


@pytest.mark.parametrize("length", [300, 3000, 20_000])
def test_every_pair_that_shares_a_table_is_given_once(length):
    """Long texts: minima of many hashes lie close together, and yet only true tables count."""
    rng = random.Random(length)
    texts = []
    for k in range(12):
        words = [f"{k}_{i}" for i in range(length)]
        changed = list(words)
        for i in rng.sample(range(0, length, 5), length // 40):
            changed[i] += "x"
        texts += [" ".join(words), " ".join(changed)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], ["id", "text"])
    rows = pa.Table.from_batches(near_duplicates._signatures(iter([batch]))).to_pydict()
    shared, groups = set(), []
    for t in range(near_duplicates.SIDE ** 2):
        members = {}
        for k, keys in enumerate(rows["keys"]):
            members.setdefault(keys[t], []).append(k)
        for key, ids in members.items():
            shared |= {(a, b) for a in ids for b in ids if a < b}
            groups += [(key, t, k) for k in ids if len(ids) > 1]
    groups.sort()
    at = [k for _, _, k in groups]
    sent = {"key": [x for x, _, _ in groups], "t": [t for _, t, _ in groups], **{x: [0] * len(at) for x in ("p", "q", "part")},
            "id": at, "component": at, "n": [rows["n"][k] for k in at]}
    sent |= {x: [rows[x][k] for k in at] for x in (*near_duplicates._SKETCH, *near_duplicates._LANES)}
    out = near_duplicates._across(iter([pa.RecordBatch.from_pydict({k: pa.array(v, pa.int64()) for k, v in sent.items()})]))
    given = [(r["a"], r["b"]) for x in out for r in x.to_pylist()]
    assert len(shared) == 12 and sorted(given) == sorted(shared)


def test_components_of_long_paths(spark):
    ids = list(range(200))
    random.Random(1).shuffle(ids)
    links = spark.createDataFrame(list(zip(ids[:-1], ids[1:])) + [(500, 501), (7, 7)], "a bigint, b bigint")
    found = {r.id: r.component for r in near_duplicates.components(links).collect()}
    assert found == {**{i: 0 for i in ids}, 500: 500, 501: 500}
    assert near_duplicates.components(links.limit(0)).count() == 0


def brute_word(lattice, model, weights, word):
    """Log probability of a word by all substrings."""
    text, best = "▁" + word, [0.0]
    for j in range(1, len(text) + 1):
        total = -math.inf
        for i in range(max(0, j - lattice.longest), j):
            piece = model.get(text[i:j])
            if piece is not None:
                total = np.logaddexp(total, best[i] + weights[piece])
            elif j - i == 1:
                total = np.logaddexp(total, best[i] + sum(weights[lattice.byte[b]] for b in text[i].encode()))
        best.append(total)
    return best[-1]


def test_lattice_sums_over_all_segmentations():
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
    lattice = language_model.lattice(MODEL)
    pieces = {model.id_to_piece(i): i for i in range(model.vocab_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))}
    words = ["the", "thonnd.", "x" * 40, "ab" * 50, "é你😀a", "a", "\x01b", "ﬁn" * 35, "▁"]
    times = np.array([3, 1, 2, 1, 1, 4, 1, 1, 1])
    weights = lattice.first_weights
    column = pa.array(words, pa.large_string())
    scores = lattice.word_scores(column, weights)
    assert np.allclose(scores, [brute_word(lattice, pieces, weights, w) for w in words])
    # The expected counts are the slopes of the log probability.
    counts = lattice.expected(column, times, weights)
    for piece in (pieces["▁the"], pieces["ab"], pieces["▁"], int(lattice.byte[0xF0]), int(lattice.byte[1])):
        moved = weights.copy()
        moved[piece] += 1e-6
        slope = ((lattice.word_scores(column, moved) - scores) * times).sum() / 1e-6
        assert math.isclose(slope, counts[piece], rel_tol=1e-3, abs_tol=1e-4)


def test_word_model_counts_training_tokens(spark, documents, odd_documents, no_documents, monkeypatch):
    monkeypatch.setattr(language_model, "CHUNK_BYTES", 500)
    docs = documents.select("doc_id", "text").union(odd_documents.selectExpr("doc_id + 1000", "text")).withColumn(
        "held_out", F.coalesce(F.col("doc_id"), F.lit(0)) % 4 == 1)
    rows = docs.collect()
    counts, ends = Counter(), 0
    for r in rows:
        if not r.held_out:
            counts.update(words_of(r.text))
            ends += 1
    n, v = sum(counts.values()) + ends, len(counts) + 1
    expected = sorted((r.doc_id or -1, len(words_of(r.text)) + 1, sum(counts[w] > 0 for w in words_of(r.text)) + 1, n, round(sum(
        math.log10((c + 0.5) / (n + 0.5 * (v + 1))) for c in [*[counts[w] for w in words_of(r.text)], ends]), 4)) for r in rows)
    found = language_model.score(docs, MODEL).collect()
    assert expected == sorted((r.id or -1, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in found)
    assert all(r.score < 0 for r in found)
    assert language_model.score(no_documents.selectExpr("doc_id", "text", "false AS held_out"), MODEL).count() == 0


def test_frequent_pieces_make_likelier_texts(spark):
    rows = [(i, "good words here " * 20, False) for i in range(20)] + [(50, "good words", True), (51, "zqxv kjwq", True), (52, None, True)]
    found = {r.id: r for r in language_model.score(spark.createDataFrame(rows, "doc_id bigint, text string, held_out boolean"), MODEL).collect()}
    assert found[52].score > found[50].score > found[51].score and found[52].n_tokens == 1


def classified_texts(rng, bad, n):
    plain = ["river", "stone", "walking", "the", "of", "and", "blue", "cloud"]
    for i in range(n):
        words = [rng.choice(plain) + rng.choice(["", "s", "ly"]) for _ in range(rng.randrange(30, 90))]
        yield i, " ".join(bad(words, rng) if i % 3 == 0 else words), int(i % 3 == 0)


def auc(rows):
    good, poor = [r[0] for r in rows if r[1]], [r[0] for r in rows if not r[1]]
    return sum((g > p) + 0.5 * (g == p) for g in good for p in poor) / (len(good) * len(poor))


def test_toxicity_is_learnt(spark, odd_documents, no_documents):
    rows = list(classified_texts(random.Random(5), lambda w, rng: w + [rng.choice(["badword", "nastyling"])], 300))
    docs = spark.createDataFrame(rows, "id bigint, text string, label int")
    model = toxicity.train(docs.select("id", "text"), docs.filter("id % 5 <> 0").select("id", "label"))
    held = toxicity.score(docs.filter("id % 5 = 0"), model, ["id", "label"]).collect()
    assert auc([(r.score, r.label) for r in held]) > 0.99
    odd = toxicity.score(odd_documents, model, ["doc_id"]).collect()
    assert len(odd) == odd_documents.count() and all(0 <= r.score <= 1 for r in odd)
    assert toxicity.score(no_documents, model, ["doc_id"]).count() == 0
    for labels in (docs.limit(0), docs.filter("label = 1")):
        one = toxicity.train(docs.select("id", "text"), labels.select("id", "label"))
        assert toxicity.score(docs.limit(3), one, ["id"]).select("score").distinct().count() == 1


def test_label_sample_is_bounded_and_has_one_label_an_id(spark):
    labels = spark.createDataFrame([(i % 50, i % 2) for i in range(300)] + [(7, 0), (None, 1), (8, None), (60, 5)], "id bigint, label int")
    rows = toxicity.labelled_sample(labels, 10).collect()
    assert len(rows) == 20 and len({r.id for r in rows}) == 20 and Counter(r.label for r in rows) == {0: 10, 1: 10}


def test_quality_is_learnt_from_positives_alone(spark, odd_documents, no_documents):
    rows = list(classified_texts(random.Random(6), lambda w, rng: [x.upper() + "!!" for x in w], 400))
    docs = spark.createDataFrame([(i, t, 1 - bad) for i, t, bad in rows], "id bigint, text string, good int")
    found = quality_classifier.with_features(docs, ["id", "good"])
    trusted = docs.filter("good = 1 AND id % 5 <> 0 AND id % 2 = 0").select("id")
    model = quality_classifier.train(found.filter("id % 5 <> 0"), trusted)
    assert abs(model.prior - 2 / 3) < 0.12
    held = quality_classifier.score(found.filter("id % 5 = 0"), model, ["id", "good"]).collect()
    assert auc([(r.score, r.good) for r in held]) > 0.99
    odd = quality_classifier.score(quality_classifier.with_features(odd_documents, ["doc_id"]), model, ["doc_id"]).collect()
    assert len(odd) == odd_documents.count() and all(0 <= r.score <= 1 for r in odd)
    nothing = quality_classifier.with_features(no_documents, ["doc_id"])
    assert quality_classifier.score(nothing, model, ["doc_id"]).count() == 0
    untrained = quality_classifier.train(found.limit(0), trusted.limit(0))
    assert {r.score for r in quality_classifier.score(found, untrained, ["id"]).collect()} == {0.5}


URLS = ["http://A.Example.com/en/x?y#z", "https://www.example.com/en/1", "http://example.com", "http://x.net/es/1", "http://x.net/de/1",
        "ftp://spam.org:80/a", "http://spam.org/a?b://c", "http://a.b.c.d.spam.org#q", "http://notspam.org/", "no scheme", "", None, "://", "://?x",
        "http://sub.bad.host.example.org/en", "http://bad.host.example.org", "HTTP://UPPER.ORG/P", "http://ünï.org/\n#x", "http://org"]


def test_url_verdicts(spark):
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(URLS * 2)], "page_id bigint, url string, host string, rule string")
    listed = spark.createDataFrame([("spam.org",), ("spam.org",), (None,), ("bad.host.example.org",), ("unmet.org",)], "key string")
    found = {r.page_id: r for r in url_filter.judge(pages, queries.RULES, listed, ["page_id", "url"]).collect()}
    assert len(found) == 2 * len(URLS)
    for r in found.values():
        rest = (r.url or "").partition("://")[2]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), re.match("[^/?#]*", rest)[0])
        path = re.match("[^?#]*", rest[len(host):])[0]
        fits = [(len(d + p), d + p, v) for v, d, p in queries.RULES if (host == d or host.endswith("." + d)) and path.startswith(p)]
        bad = any(host == x or host.endswith("." + x) for x in ("spam.org", "bad.host.example.org"))
        assert (r.host, r.path) == (host, path)
        assert (r.rule, r.verdict) == (max(fits)[1:] if fits else (None, "block" if bad else "allow"))
    assert url_filter.judge(pages.limit(0), queries.RULES, listed, ["page_id"]).count() == 0
    assert url_filter.judge(pages, [], listed.limit(0), ["page_id"]).filter("verdict = 'block' OR rule IS NOT NULL").count() == 0


def test_cascade_is_exact_over_its_universe(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "FIRST", (1, 1))
    monkeypatch.setattr(url_filter, "LATER", (2, 1))
    universe = spark.range(3000).selectExpr("concat('k', id) AS key", "id % 7 = 0 AS listed")
    cascade = url_filter.Cascade(universe)
    assert len(cascade.levels) >= 3
    assert universe.filter(cascade.contains(F.col("key")) != F.col("listed")).count() == 0


def test_listed_names_of_any_number_of_labels_block_their_subdomains(spark):
    names = [".".join(f"l{k}" for k in range(n)) for n in range(1, 9)]
    urls = [f"http://{x}{name}{y}/p" for name in names for x in ("", "www.", "a.b.", "not") for y in ("", ".x", ".")]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    for kept in (names[4:5], names[:1], names[7:] + names[2:3]):
        listed = spark.createDataFrame([(n,) for n in kept], "key string")
        for r in url_filter.judge(pages, [], listed, ["page_id"]).collect():
            bad = any(r.host == n or r.host.endswith("." + n) for n in kept)
            assert r.verdict == ("block" if bad else "allow"), (kept, r.host)


@pytest.mark.parametrize("most", [64_000_000, 60_000])
def test_op6_query_with_a_long_list(spark, monkeypatch, tmp_path, most):
    """100,000 listed names in one part and in four, exact through several levels."""
    monkeypatch.setattr(url_filter, "MOST_BYTES", most)
    levels = []
    built = url_filter.Cascade.__init__
    monkeypatch.setattr(url_filter.Cascade, "__init__", lambda self, universe: (built(self, universe), levels.append(len(self.levels)))[0])
    bad = "id % 2 = 0"
    spark.range(200_000).selectExpr("id AS page_id", "concat('http://www.h', id, '.d', id % 90, '.org/p') AS url").write.parquet(
        f"{tmp_path}/pages.parquet")
    listed = spark.range(200_000).filter(bad).selectExpr("concat('h', id, '.d', id % 90, '.org') AS key")
    found = queries.op6_url_filter(spark, str(tmp_path), listed)
    wrong = found.filter("(verdict = 'block') <> (page_id % 2 = 0)")
    assert found.count() == 200_000 and wrong.count() == 0
    assert max(levels) >= 3 if most > 10 ** 6 else len(levels) == 4


def test_url_filter_runs_no_python(spark):
    plan = queries.op6_url_filter(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop|Join", plan)


def test_pipeline_stages_take_effect(spark, odd_documents, no_documents):
    folder = "/root/testdata/sf0.001"
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    for docs in (odd_documents, no_documents):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, folder)
            rows = out.collect()
            if name != names[-1]:
                assert out.columns == docs.columns
            if name in names[3:]:
                assert len(rows) == docs.count()
    long = " ".join(f"word{i} of the" for i in range(60))
    item = spark.read.parquet(f"{folder}/benchmark.parquet").orderBy("item_id").first().text
    rows = [(1, long, "en", "s", 0), (2, long + " x", "en", "s", 0), (3, "short", "en", "s", 0), (4, f"{item} {item}x {long[::-1]}", "en", "s", 0),
            (5, long.replace("word", "mail a@b.com "), "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = {name: {r.doc_id: r for r in stage(spark, docs, folder).collect()} for name, stage in corpus_pipeline.STAGES}
    assert 3 not in kept["quality rules"] and 1 in kept["quality rules"]
    assert set(kept["near duplicates"]) == {1, 3, 4, 5}
    assert set(kept["decontamination"]) == {1, 2, 3, 5}
    assert "a@b.com" not in kept["personal data"][5].text and kept["personal data"][1].text == long
    assert kept["personal data"][5].n_chars == len(kept["personal data"][5].text)
    assert kept["encoding"][1].text == long and kept["encoding"][1].n_tokens == len(kept["encoding"][1].ids)


def test_every_operator_has_one_query():
    names = sorted(queries.QUERIES, key=lambda n: int(n[2:].split("_")[0]))
    assert [n.split("_")[0] for n in names] == [f"op{k}" for k in range(1, 14)]
    assert set(queries.ORACLE) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", list(queries.ORACLE))
def test_query_matches_sql(spark, name):
    folder = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
    database = duckdb.connect()
    for table in ("documents", "benchmark", "pages"):
        database.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    result = queries.QUERIES[name](spark, folder)
    cursor = database.execute(queries.ORACLE[name])
    assert result.columns == [column[0] for column in cursor.description]
    assert sorted(map(tuple, result.collect())) == sorted(cursor.fetchall())
