"""Quality by positive-unlabelled learning: trusted positives, unlabelled web text, an estimated class prior.

A linear model over statistics of a text minimises the non-negative unbiased risk: with prior p, the risk of the
positives as positive times p, plus the risk of the unlabelled as negative less p times that of the positives as
negative. Where that difference falls below zero, the step goes back up instead of fitting it further. The prior
is estimated first: a classifier of positives against unlabelled orders the texts, and the share of all unlabelled
above a score, over that of held-back positives, is smallest where there are hardly any negatives.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txn_analytics.cluster import saved
from txn_analytics.llm.quality_rules import CLASSES, CLASS_OF, class_counts, repeated_lines, repeated_words
from txn_analytics.llm.words import NOT_SPACE, Words, first_of_each, per_text, segment_sums, steps

#: Positives and unlabelled documents that the model is fitted on, at most.
SAMPLE = 20_000
ROUNDS, RATE, PENALTY = 600, 0.3, 1e-4
CONFIDENCE = 0.1     # chance that the bound under the estimate of the prior fails


def features(column: pa.Array) -> np.ndarray:
    """One row of numbers for each text, all zero for one without words.

    Square roots of the shares of character classes and of pairs of classes next to each other, then shares of
    different words, of words in repeated windows and of repeated lines, mean word length and log of the words.
    """
    words = Words(column, NOT_SPACE)
    hashes, n = words.hashes(), len(column)
    counts = class_counts(words)
    kind = CLASS_OF[words.data]
    lead = np.flatnonzero(kind >= 0)
    text = np.repeat(np.arange(n), np.diff(words.offsets))[lead]
    kind = kind[lead].astype(np.int64)
    next_to = text[1:] == text[:-1]
    pairs = np.bincount(
        ((text[:-1] * len(CLASSES) + kind[:-1]) * len(CLASSES) + kind[1:])[next_to],
        minlength=n * len(CLASSES) ** 2).reshape(n, len(CLASSES) ** 2)
    shares = [x / np.maximum(x.sum(axis=1, keepdims=True), 1) for x in (counts, pairs)]
    many = np.maximum(words.counts, 1)
    different = segment_sums(first_of_each(per_text(hashes, words.texts())), words.first)
    again = segment_sums(repeated_words(words, hashes), words.first)
    lines = np.add.reduceat(np.r_[(words.data == 0x0A).astype(np.int64), 0], words.offsets[:-1]) if n else np.zeros(0)
    lines = np.where(np.diff(words.offsets) > 0, lines, 0) + 1
    length = segment_sums(words.ends - words.starts, words.first) / many
    out = np.column_stack([*map(np.sqrt, shares), different / many, again / many, repeated_lines(words) / lines,
                           np.minimum(length, 50) / 10, np.log1p(words.counts) / 10])
    out[words.counts == 0] = 0
    return out


def _write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (part for whole in batches for part in steps(whole, "_text")):
        rows = features(batch.column("_text")).astype(np.float32)
        offsets = pa.array(np.arange(len(rows) + 1) * rows.shape[1], pa.int32())
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.ListArray.from_arrays(offsets, pa.array(rows.reshape(-1)))],
            [*batch.schema.names[:-1], "features"])


def with_features(docs: DataFrame, columns: list[str], text: str = "text") -> DataFrame:
    """``columns`` and the features of each document, computed once and kept in the work folder."""
    read = docs.select(*columns, F.col(text).alias("_text"))
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in read.schema.fields[:-1]]
    return saved(read.mapInArrow(_write, ", ".join([*kept, "features array<float>"])), "features")


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _against_unlabelled(positive: np.ndarray, unlabelled: np.ndarray) -> np.ndarray:
    """Weights of a logistic regression of positives against unlabelled, both weighing the same."""
    weight = np.zeros(positive.shape[1])
    for _ in range(ROUNDS // 2):
        slope = (positive.T @ (_sigmoid(positive @ weight) - 1) / len(positive)
                 + unlabelled.T @ _sigmoid(unlabelled @ weight) / len(unlabelled)) / 2
        weight -= RATE * (slope + PENALTY * weight)
    return weight


def estimate_prior(held: np.ndarray, others: np.ndarray) -> float:
    """The share of positives among the unlabelled.

    ``held`` are the sorted scores of positives that the order was not learnt from, and ``others[k]`` how many
    unlabelled rows reach k of their different scores and no more. The score chosen is the one with the least upper
    bound of the ratio of the shares above it. Without rows of either side the prior is a half.
    """
    if not len(held) or not others.sum():
        return 0.5
    at = np.unique(held)
    of_p = 1 - np.searchsorted(held, at, "left") / len(held)
    of_u = np.cumsum(others[::-1])[::-1][1:] / others.sum()
    slack = sum(np.sqrt(np.log(4 / CONFIDENCE) / (2 * n)) for n in (len(held), others.sum()))
    best = np.argmin((of_u + slack) / np.maximum(of_p, 1e-9))
    return float(np.clip(of_u[best] / of_p[best], 0.01, 0.99))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> np.ndarray:
    """Weights that minimise the non-negative risk with the logistic loss."""
    weight = np.zeros(positive.shape[1])
    for _ in range(ROUNDS):
        p, u = positive @ weight, unlabelled @ weight
        rest = np.logaddexp(0, u).mean() - prior * np.logaddexp(0, p).mean()
        of_rest = unlabelled.T @ _sigmoid(u) / len(u) - prior * (positive.T @ _sigmoid(p) / len(p))
        of_positive = prior * (positive.T @ (_sigmoid(p) - 1) / len(p))
        slope = of_positive + of_rest if rest >= 0 else -of_rest
        weight -= RATE * (slope + PENALTY * weight)
    return weight


class Scale:
    """Standardisation by the rows that a model is fitted on, and a column of ones."""

    def __init__(self, rows: np.ndarray):
        self.mean, self.spread = rows.mean(axis=0), rows.std(axis=0) + 1e-3

    def __call__(self, rows: np.ndarray) -> np.ndarray:
        return np.column_stack([np.clip((rows - self.mean) / self.spread, -8, 8), np.ones(len(rows))])


class Model:
    """Standardisation and weights; without positives or unlabelled texts every score is 0.5."""

    def __init__(self, scale: Scale | None = None, weight: np.ndarray | None = None, prior: float = 0.5):
        self.scale, self.weight, self.prior = scale, weight, prior

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return np.full(len(rows), 0.5) if self.weight is None else _sigmoid(self.scale(rows) @ self.weight)


def _matrix(lists: pa.Array) -> np.ndarray:
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(lists), -1) if len(lists) else np.zeros((0, 1))


def _of_ids(rows: DataFrame, ids: DataFrame) -> pa.Table:
    """The features of one row of each of a bounded number of ids, on the driver, in the order of the ids."""
    one = rows.join(F.broadcast(ids), "id").groupBy(*ids.columns).agg(F.min("features").alias("features"))
    return one.toArrow().combine_chunks().sort_by("id")


def _reached(rows: DataFrame, scale: Scale, order: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many rows reach 0, 1, 2, ... of the sorted scores ``at``: one pass, a count for each score comes back."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(at) + 1, np.int64)
        for batch in batches:
            if batch.num_rows:
                total += np.bincount(np.searchsorted(at, scale(_matrix(batch.column(0))) @ order, "right"), minlength=len(total))
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(total[found])], ["reached", "n"])
    counted = rows.select("features").mapInArrow(count, "reached int, n bigint").groupBy("reached").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(len(at) + 1, np.int64)
    out[counted.column("reached").to_numpy()] = counted.column("n").to_numpy()
    return out


def train(rows: DataFrame, positives: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from unlabelled rows (id, features) and the ids of trusted positives.

    Weights are fitted on at most ``sample`` ids of either, those with the least hash; that bound is a parameter, an
    id counts once, and NULL ids are left out of it. The prior counts all unlabelled rows but the half of the
    sample that orders them.
    """
    ids = positives.select("id").filter("id IS NOT NULL").distinct().orderBy(F.xxhash64("id"), "id").limit(sample)
    chosen = rows.select("id").filter("id IS NOT NULL").distinct().orderBy(F.xxhash64("id", F.lit(1)), "id").limit(sample)
    chosen = saved(chosen.withColumn("half", F.expr("xxhash64(id, 2) & 1")), "chosen")
    positive, unlabelled = _matrix(_of_ids(rows, ids).column("features").combine_chunks()), _of_ids(rows, chosen)
    half = unlabelled.column("half").to_numpy() == 0
    unlabelled = _matrix(unlabelled.column("features").combine_chunks())
    if not len(positive) or not len(unlabelled):
        return Model()
    scale = Scale(np.concatenate([positive, unlabelled]))
    positive, unlabelled, prior = scale(positive), scale(unlabelled), 0.5
    if half.any() and len(positive) > 1:
        order = _against_unlabelled(positive[::2], unlabelled[half])
        held = np.sort(positive[1::2] @ order)
        others = rows.join(F.broadcast(chosen.filter("half = 0").select("id")), "id", "left_anti")
        prior = estimate_prior(held, _reached(others, scale, order, np.unique(held)))
    return Model(scale, fit(positive, unlabelled, prior), prior)


def score(rows: DataFrame, model: Model, columns: list[str]) -> DataFrame:
    """``columns`` of each row with ``score``, 0 to 1, higher for good text.

    NULL and empty texts, whose features are all zero, get a score like any other. Repeated rows score alike.
    """
    read = rows.select(*columns, "features")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = model.scores(_matrix(batch.column("features"))) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found)], [*batch.schema.names[:-1], "score"])
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in read.schema.fields[:-1]]
    return read.mapInArrow(run, ", ".join([*kept, "score double"]))
