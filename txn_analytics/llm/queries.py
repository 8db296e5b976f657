"""The operators of this folder over the test tables, by name, and the SQL for those that SQL can express."""

from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txn_analytics.cluster import saved
from txn_analytics.llm import (
    byte_pairs, decontaminate, language_model, near_duplicates, periodic_runs, pieces, pii, quality_classifier, quality_rules,
    token_alignment, token_counts, toxicity, url_filter,
)

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTE_PAIRS = public_tokenizers.path("byte_bpe_50k.json")

RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/")]
#: Labels that mark an unwanted domain in the test pages.
UNWANTED = ("adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm")


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    # Python workers that start elsewhere find this package too, where they see the driver's folders.
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).parents[2]))
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_model(path: str) -> bytes:
    """A vocabulary file, read on the driver: tasks get its bytes."""
    with open(path, "rb") as file:
        return file.read()


def _fold(doc_id: str = "doc_id"):
    return F.crc32(F.col(doc_id).cast("string")) % 5


def _judged(scored: DataFrame, threshold: float) -> DataFrame:
    return scored.select("doc_id", F.coalesce(_fold() == 0, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def op1_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    rows = quality_classifier.with_features(read_table(spark, folder, "documents"), ["doc_id"])
    labels = read_table(spark, folder, "labels").filter(_fold() != 0)
    positives = labels.filter("quality = 1").select(F.col("doc_id").alias("id"))
    model = quality_classifier.train(rows.filter(_fold() != 0).withColumnRenamed("doc_id", "id"), positives)
    return _judged(quality_classifier.score(rows, model, ["doc_id"]), 0.3)


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    labels = read_table(spark, folder, "labels").filter(_fold() != 0)
    model = toxicity.train(docs.select(F.col("doc_id").alias("id"), "text"),
                           labels.select(F.col("doc_id").alias("id"), F.col("toxic").alias("label")))
    return _judged(toxicity.score(docs, model, ["doc_id"]), 0.5)


def op2_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find(read_table(spark, folder, "documents"), ["doc_id"])
    count = [F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}") for kind in pii.BASE_KINDS]
    return found.select("doc_id", *count, F.sha2(pii.listed("base"), 256).alias("base_sha256"),
                        pii.listed(pii.merged("base", "added")).alias("spans"))


def op3_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    groups = near_duplicates.near_duplicates(read_table(spark, folder, "documents"))
    return groups.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"),
                         (F.col("id") == F.col("component")).alias("kept"))


def op4_sentencepiece(spark: SparkSession, folder: str, model: str = PIECES) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    coded = pieces.decode(pieces.encode(docs, read_model(model)), read_model(model))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        pieces.digest().alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))


def op5_language_model(spark: SparkSession, folder: str, model: str = PIECES) -> DataFrame:
    docs = read_table(spark, folder, "documents").withColumn("held_out", _fold() == 1)
    return language_model.score(docs, read_model(model)).withColumnRenamed("id", "doc_id")


def unwanted_domains(pages: DataFrame) -> DataFrame:
    """The block list of the query, read from the pages: of each host the part from a label in ``UNWANTED`` on."""
    labels = pages.select(F.split(url_filter.host("url"), "[.]").alias("_labels")).distinct()
    at = F.expr(f"filter(sequence(1, size(_labels) - 1), i -> _labels[i - 1] IN {UNWANTED})")
    found = labels.filter("size(_labels) > 1").select("_labels", F.explode(at).alias("_at"))
    return found.select(F.expr("array_join(slice(_labels, _at, size(_labels)), '.')").alias("key")).distinct()


def op6_url_filter(spark: SparkSession, folder: str, listed: DataFrame | None = None) -> DataFrame:
    pages = read_table(spark, folder, "pages")
    listed = unwanted_domains(pages) if listed is None else listed
    return url_filter.judge(pages, RULES, saved(listed.select("key"), "listed"), ["page_id"])


def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    hits = decontaminate.contamination(
        read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"), ["doc_id"])
    return hits.select("doc_id", "n_words", "n_hit", F.size("hit_items").cast("long").alias("n_items"),
                       decontaminate.item_digest().alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    return quality_rules.quality_rules(docs, quality_rules.learn_references(docs), ["doc_id"])


def op10_token_counts(spark: SparkSession, folder: str, model: str = PIECES) -> DataFrame:
    return token_counts.length_histogram(token_counts.encoded_lengths(read_table(spark, folder, "documents"), read_model(model)))


def op11_byte_pairs(spark: SparkSession, folder: str, spec: str = BYTE_PAIRS) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    coded = byte_pairs.decode(byte_pairs.encode(docs, read_model(spec), packed=True), read_model(spec))
    return coded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in every tenth document by the hash of its id, the words from one on repeat a stretch of them."""
    words = F.expr(r"CASE WHEN _hash % 10 = 0 THEN regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0) END")
    chosen = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string")).alias("_hash")).withColumn("_words", words)
    chosen = chosen.withColumns({"_n": F.size("_words"), "_g": F.expr("_hash DIV 10")})
    chosen = chosen.withColumn("_a", F.expr("cast(CASE WHEN _n > 0 THEN _g % _n ELSE 0 END AS int)"))
    chosen = chosen.withColumn("_p", F.expr("cast(1 + (_n - _a) DIV (3 + _g % 8) AS int)"))
    planted = F.expr("""array_join(concat(slice(_words, 1, _a), slice(
        flatten(array_repeat(slice(_words, _a + 1, _p), cast(ceil((_n - _a) / _p) AS int))), 1, _n - _a)), ' ')""")
    return chosen.select("doc_id", F.when(F.col("_n") > 0, planted).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic_runs.periodic_runs(with_planted_periods(read_table(spark, folder, "documents")), ["doc_id"])
    listed = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, chr(10))), '')")
    return found.withColumn("_best", periodic_runs.strongest()).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "_best.start", "_best.length", "_best.period",
        F.expr("1000 * _best.length DIV _best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_token_alignment(spark: SparkSession, folder: str, spec: str = BYTE_PAIRS, model: str = PIECES) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    return token_alignment.align(docs, read_model(spec), read_model(model), ["doc_id"])


QUERIES = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_pii": op2_pii,
    "op3_near_duplicates": op3_near_duplicates,
    "op5_language_model": op5_language_model,
    "op6_url_filter": op6_url_filter,
    "op7_toxicity": op7_toxicity,
    "op10_token_counts": op10_token_counts,
    "op4_sentencepiece": op4_sentencepiece,
    "op9_quality_rules": op9_quality_rules,
    "op8_decontamination": op8_decontamination,
    "op11_byte_pairs": op11_byte_pairs,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_token_alignment": op13_token_alignment,
}

_HOST = f"""translate(regexp_extract(rest, '^[^/?#]*', 0), '{url_filter.UPPER}', '{url_filter.LOWER}')"""


def _fits(domain: str, prefix: str) -> str:
    return f"(host = '{domain}' OR ends_with(host, '.{domain}')) AND starts_with(path, '{prefix}')"


def _cases(field: int) -> str:
    ordered = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    return " ".join(f"WHEN {_fits(d, p)} THEN '{(d + p, v)[field]}'" for v, d, p in ordered)


OP6_SQL = f"""
WITH urls AS (
    SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parsed AS (
    SELECT page_id, {_HOST} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM urls)
SELECT page_id, host, path, CASE {_cases(0)} END AS rule,
       CASE {_cases(1)}
            WHEN regexp_matches(host, '(^|[.])({'|'.join(UNWANTED)})[.]') THEN 'block' ELSE 'allow' END AS verdict
FROM parsed"""

_LOWER = f"translate(coalesce(text, ''), '{url_filter.UPPER}', '{url_filter.LOWER}')"

OP3_SQL = f"""
WITH RECURSIVE words AS (
    SELECT doc_id, [x FOR x IN string_split_regex({_LOWER}, '[\\x20\\x09-\\x0D]+') IF x <> ''] AS w FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]
                                        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
    SELECT l.doc_id AS a, r.doc_id AS b, count(*) AS common
    FROM shingles l JOIN shingles r ON l.s = r.s AND l.doc_id < r.doc_id GROUP BY l.doc_id, r.doc_id),
links AS (
    SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * common >= 75 * (x.n + y.n - common)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (
    SELECT doc_id, doc_id AS other FROM documents
    UNION SELECT reached.doc_id, edges.b FROM reached JOIN edges ON edges.a = reached.other)
SELECT reached.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id, reached.doc_id = min(other) AS kept
FROM reached LEFT JOIN sizes ON sizes.doc_id = reached.doc_id GROUP BY reached.doc_id"""

_WORDS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

OP8_SQL = f"""
WITH docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
items AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS n,
           unnest([array_to_string(w[i:i + least(len(w), 10) - 1], ' ') FOR i IN range(1, len(w) - least(len(w), 10) + 2)]) AS s
    FROM items WHERE len(w) > 0),
lengths AS (SELECT DISTINCT n FROM windows),
places AS (
    SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS pos, w FROM docs JOIN lengths ON len(w) >= n),
found AS (
    SELECT doc_id, pos, n, item_id
    FROM (SELECT doc_id, n, pos, array_to_string(w[pos:pos + n - 1], ' ') AS s FROM places) JOIN windows USING (s, n)),
hit AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, pos + unnest(range(n)) FROM found) GROUP BY doc_id),
met AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
    FROM (SELECT DISTINCT doc_id, cast(item_id AS varchar) AS item FROM found) GROUP BY doc_id)
SELECT docs.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit ON hit.doc_id = docs.doc_id LEFT JOIN met ON met.doc_id = docs.doc_id"""

ORACLE = {"op3_near_duplicates": OP3_SQL, "op6_url_filter": OP6_SQL, "op8_decontamination": OP8_SQL}
