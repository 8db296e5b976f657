"""Toxicity: a linear classifier over character n-grams that are scaled by naive Bayes log-count ratios.

The n-grams of a word, with its ends marked, are hashed into a fixed number of buckets. A text has the n-grams of
its distinct words. Their counts in toxic and other documents, over a bounded sample of labelled rows, give the log-count
ratio of each bucket; the classifier is a logistic regression on features scaled by these ratios. The score of a
text is then a sum over its distinct words, so a task scores every word once for each slice of text.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txn_analytics.cluster import saved
from txn_analytics.llm.words import (
    ALPHANUMERIC, MULTIPLIER, Words, first_of_each, mix, per_text, segment_sums, steps,
)

SIZES = (3, 4, 5)
BITS = 18
BUCKETS = 1 << BITS
SMOOTHING = 10.0    # added to the count of each bucket, split between the classes by their totals
#: Labelled documents of each class at most: for the counts, and of these for the regression.
SAMPLE, FITTED = 20_000, 2_000
ROUNDS = 150
RATE, PENALTY = 0.5, 1e-4


def _ngrams(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct words of each text: their positions, one position for each different word, and which it is."""
    hashes = words.hashes()
    own = np.flatnonzero(first_of_each(per_text(hashes, words.texts())))
    _, first, which = np.unique(hashes[own], return_index=True, return_inverse=True)
    return own, own[first], which


def _expand(words: Words, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and word number of every n-gram of the words at ``at``; ends are marked by a zero byte."""
    size = words.ends[at] - words.starts[at]
    full = size + 2
    start = np.cumsum(full) - full
    data = np.zeros(int(full.sum()), np.uint64)
    inside = np.repeat(start + 1, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    source = np.repeat(words.starts[at], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    data[inside] = words.data[source]
    of = np.repeat(np.arange(len(at)), full)
    left = np.repeat(start + full, full) - np.arange(len(data))
    buckets, owners = [], []
    for n in SIZES:
        m = max(0, len(data) - n + 1)
        h = np.full(m, n, np.uint64)
        for k in range(n):
            h *= np.uint64(MULTIPLIER)
            h += data[k:k + m]
        fits = left[:m] >= n
        buckets.append((mix(h[fits]) >> np.uint64(64 - BITS)).astype(np.int64))
        owners.append(of[:m][fits])
    return np.concatenate(buckets), np.concatenate(owners)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, toxic, other): how many n-grams of distinct words each class has, summed over a task."""
    total = np.zeros((2, BUCKETS))
    for batch in (part for whole in batches for part in steps(whole, "text")):
        words = Words(batch.column("text"), ALPHANUMERIC, lower=True)
        own, once, which = _ngrams(words)
        if not len(own):
            continue
        label = batch.column("label").to_numpy(zero_copy_only=False)[words.texts()[own]]
        bucket, owner = _expand(words, once)
        for c in (0, 1):
            times = np.bincount(which[label == c], minlength=len(once))
            total[c] += np.bincount(bucket, times[owner], BUCKETS)
    found = np.flatnonzero(total.sum(axis=0))
    if len(found):
        yield pa.RecordBatch.from_arrays(
            [pa.array(found, pa.int32()), pa.array(total[1, found]), pa.array(total[0, found])], ["bucket", "toxic", "other"])


def log_count_ratio(toxic: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Log of the share of each bucket in toxic over that in other documents; 0 where neither has it."""
    total = toxic.sum() + other.sum()
    of_toxic, of_other = toxic.sum() / total, other.sum() / total
    return np.log((toxic / SMOOTHING + of_toxic) / of_toxic) - np.log((other / SMOOTHING + of_other) / of_other)


def _vectors(ratio: np.ndarray):
    """Scaled features of each document as sorted buckets and values."""
    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in steps(whole, "text")):
            words = Words(batch.column("text"), ALPHANUMERIC, lower=True)
            own, once, which = _ngrams(words)
            bucket, owner = _expand(words, once) if len(once) else (np.zeros(0, np.int64),) * 2
            order = np.argsort(owner, kind="stable")
            bucket, cut = bucket[order], np.searchsorted(owner[order], np.arange(len(once) + 1))
            first = np.searchsorted(words.texts()[own], np.arange(batch.num_rows + 1))
            out = []
            for i in range(batch.num_rows):
                mine = which[first[i]:first[i + 1]]
                grams = np.concatenate([bucket[cut[w]:cut[w + 1]] for w in mine.tolist()]) if len(mine) else bucket[:0]
                found, times = np.unique(grams, return_counts=True)
                out.append({"bucket": found.astype(np.int32), "value": (times * ratio[found]).astype(np.float32)})
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), pa.array([x["bucket"] for x in out], pa.list_(pa.int32())),
                 pa.array([x["value"] for x in out], pa.list_(pa.float32()))], ["label", "bucket", "value"])
    return vectors


def _fit(rows: pa.Table) -> tuple[np.ndarray, float]:
    """Logistic regression by full-batch gradient steps with per-feature step sizes; classes weigh the same.

    Buckets that none of the rows holds get the mean weight, so that their ratios keep their say.
    """
    label = rows.column("label").to_numpy().astype(float)
    size = pc.list_value_length(rows.column("bucket")).to_numpy()
    value = pc.list_flatten(rows.column("value")).to_numpy()
    used, column = np.unique(pc.list_flatten(rows.column("bucket")).to_numpy(), return_inverse=True)
    column, row = column.astype(np.int32), np.repeat(np.arange(len(label), dtype=np.int32), size)
    share = np.where(label == 1, 0.5 / max(label.sum(), 1), 0.5 / max((1 - label).sum(), 1))
    weight, bias = np.zeros(len(used)), 0.0
    seen, seen_bias = np.full(len(used), 1e-8), 1e-8
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(row, value * weight[column], len(label)) + bias, -30, 30)))
        error = share * (p - label)
        slope = np.bincount(column, value * error[row], len(used)) + PENALTY * weight
        seen += slope ** 2
        seen_bias += error.sum() ** 2
        weight -= RATE * slope / np.sqrt(seen)
        bias -= RATE * error.sum() / np.sqrt(seen_bias)
    out = np.full(BUCKETS, max(weight.mean(), 0.0) if len(used) else 0.0)
    out[used] = weight
    return out, bias


class Model:
    """Weight of each bucket, its ratio included, and the bias."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights.astype(np.float32), bias

    def scores(self, column: pa.Array) -> np.ndarray:
        words = Words(column, ALPHANUMERIC, lower=True)
        own, once, which = _ngrams(words)
        if not len(own):
            return np.full(len(column), 1 / (1 + np.exp(-self.bias)))
        bucket, owner = _expand(words, once)
        of_word = np.bincount(owner, self.weights[bucket].astype(np.float64), len(once))
        first = np.searchsorted(words.texts()[own], np.arange(len(column) + 1))
        total = segment_sums(of_word[which], first) + self.bias
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def labelled_sample(labels: DataFrame, most: int) -> DataFrame:
    """(id, label): at most ``most`` rows of each class of (id, label), those with the least hash of the id.

    NULL ids and labels other than 0 and 1 are left out; an id with both labels has label 1.
    """
    one = labels.filter("id IS NOT NULL AND label IN (0, 1)").groupBy("id").agg(F.max("label").cast("int").alias("label"))
    parts = [one.filter(F.col("label") == c).orderBy(F.xxhash64("id"), "id").limit(most) for c in (0, 1)]
    return parts[0].union(parts[1])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, fitted: int = FITTED) -> Model:
    """A model from documents (id, text) and labels (id, label 0 or 1).

    The counts take at most ``sample`` labelled rows of each class, the regression at most ``fitted`` of them:
    both bounds are parameters, and the sample's ids are small enough to be broadcast, so no text is shuffled.
    Without rows of both classes every text scores the share of label 1, or 0.5 without any rows.
    """
    chosen = saved(labelled_sample(labels, sample), "labelled")
    docs = saved(docs.select("id", "text").join(F.broadcast(chosen), "id"), "labelled")
    size = {r["label"]: r["count"] for r in docs.groupBy("label").count().collect()}
    if len(size) < 2:
        share = (size.get(1, 0) + 1e-3) / (sum(size.values()) + 2e-3)
        return Model(np.zeros(BUCKETS), float(np.log(share / (1 - share))))
    counted = docs.mapInArrow(_count, "bucket int, toxic double, other double").groupBy("bucket").agg(
        F.sum("toxic").alias("toxic"), F.sum("other").alias("other")).toArrow()     # one row for each bucket at most
    at = counted.column("bucket").to_numpy()
    toxic, other = np.zeros(BUCKETS), np.zeros(BUCKETS)
    toxic[at] = counted.column("toxic").to_numpy()
    other[at] = counted.column("other").to_numpy()
    ratio = log_count_ratio(toxic, other)
    fit = docs.join(F.broadcast(labelled_sample(chosen, fitted).select("id")), "id")
    rows = fit.mapInArrow(_vectors(ratio), "label int, bucket array<int>, value array<float>").toArrow()
    weights, bias = _fit(rows)
    return Model(weights * ratio, bias)


def score(docs: DataFrame, model: Model, columns: list[str], text: str = "text") -> DataFrame:
    """``columns`` of each document with ``score``, 0 to 1, higher for toxic. NULL and empty texts get the bias."""
    read = docs.select(*columns, F.col(text).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in steps(whole, "_text")):
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(model.scores(batch.column("_text")))], [*batch.schema.names[:-1], "score"])
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in read.schema.fields[:-1]]
    return read.mapInArrow(run, ", ".join([*kept, "score double"]))
