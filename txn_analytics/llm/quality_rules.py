"""Quality rules: counts of a text, and how far its histograms are from those of the languages of the corpus.

A language reference is learnt from the documents tagged with the language: the mean histogram of character classes, and
the shares of its common words. Documents far from a first mean are left out of the final one, so that junk does not
bend it. Means of languages with few documents lean towards the mean of all documents, by weight and with no threshold;
only how letters divide into kinds is always the language's own, so that any script can be common. Texts without a tag
are one more language.

A text is compared with the references of all languages by Jensen-Shannon distance (base 2, square root, 0 to 1), and the
nearest one counts, since tags can be wrong and texts can be mixed. A reference of few words is known with an error. The
text's own language is given the benefit of that error, and other languages are not: it is added to their distance. So a
text is judged the same way whatever its tag is and however many documents its language or another one has; only texts
with few words are not judged by distance.

References take two passes. The first also finds words that can be common: a word whose share of a language is
``1.5 * COMMON`` has at least ``COMMON`` of it left when every slice of text leaves out the words below half of
``COMMON`` of the slice. That leaves at most ``1 / COMMON`` words a language; the last pass counts them exactly
and keeps those with ``2 * COMMON`` and ``CHANCE`` occurrences more.
"""

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txn_analytics.cluster import saved
from txn_analytics.llm.words import (
    NOT_SPACE, Words, per_text, repeated, segment_sums, steps, window_hashes,
)

MIN_WORDS = 20            # fewer words fail
MOST_REPEATED = 30        # per cent of words in repeated windows
WINDOW = 8
SYMBOLS = "#*$%&|<>"

JUDGED_WORDS = 50         # distances are taken from this many words on
# Most distance of a long text; what a short one may have more, over the square root of its words; and what a reference
# adds to that by documents that are not alike, over the square root of their number.
CHAR_DISTANCE = 0.12, 1.4, 0.1
WORD_DISTANCE = 0.15, 2.2, 0.3
TRIM = 0.15, 0.3          # documents farther from the first mean do not enter the final one; more over the root of their number
COMMON = 0.001            # half the least share of a common word
CHANCE = 3                # occurrences by which a common word exceeds its least share
LEAN = 30                 # documents of all languages that a language's own mean of classes is mixed with
MOST_TAGS = 1000          # rarer tags are one language with the texts that have none: bounds what tasks are sent
LETTERS = [0, 1, 7]       # the classes of letters

CLASSES = ["lower", "upper", "digit", "space", "sentence", "bracket", "symbol", "beyond ASCII"]
CLASS_OF = np.full(256, 6, np.int8)
CLASS_OF[0x61:0x7B], CLASS_OF[0x41:0x5B], CLASS_OF[0x30:0x3A] = 0, 1, 2
CLASS_OF[[0x20, *range(0x09, 0x0E)]] = 3
CLASS_OF[list(b".,;:!?'\"-")] = 4
CLASS_OF[list(b"()[]{}")] = 5
CLASS_OF[0xC0:] = 7
CLASS_OF[0x80:0xC0] = -1    # bytes that go on with a character

_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS.encode())] = True


@dataclass
class References:
    """Of each language: shares of character classes and of its common words by hash, and from how many words
    and documents they are.

    The language of no tag is NULL. ``shares`` has the places in ``words`` and the shares of each language: at most 16
    bytes for 500 words.
    """
    languages: list[str | None] = field(default_factory=list)
    classes: np.ndarray = field(default_factory=lambda: np.zeros((0, len(CLASSES))))
    words: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    shares: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    sizes: np.ndarray = field(default_factory=lambda: np.zeros(0))
    documents: np.ndarray = field(default_factory=lambda: np.zeros(0))


def class_counts(words: Words) -> np.ndarray:
    """Characters of each class in each text."""
    n = len(words.counts)
    kind = CLASS_OF[words.data]
    at = np.repeat(np.arange(n) * len(CLASSES), np.diff(words.offsets))
    return np.bincount((at + kind)[kind >= 0], minlength=n * len(CLASSES)).reshape(n, len(CLASSES))


def _shares(counts: np.ndarray) -> np.ndarray:
    return counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)


def _term(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """What one bin adds to the divergence."""
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left, right = p * np.log2(p / m), q * np.log2(q / m)
    return (np.nan_to_num(left, nan=0.0) + np.nan_to_num(right, nan=0.0)) / 2


def _distance(divergence: np.ndarray) -> np.ndarray:
    return np.sqrt(np.clip(divergence, 0, 1))


def _tags(docs: DataFrame) -> set[str]:
    """The most frequent tags."""
    counts = docs.filter("lang IS NOT NULL").groupBy("lang").agg(F.count("*").alias("n"))
    return {row.lang for row in counts.orderBy(F.desc("n"), "lang").limit(MOST_TAGS).collect()}


def _by_language(known: set[str], tags: pa.Array) -> Iterator[tuple[str | None, np.ndarray]]:
    """Each language with a document, and whether each document is of it."""
    tags = tags.dictionary_encode()
    codes = tags.indices.fill_null(-1).to_numpy(zero_copy_only=False)
    others = np.ones(len(codes), bool)
    for code, lang in enumerate(tags.dictionary.to_pylist()):
        if lang in known:
            own = codes == code
            yield lang, own
            others &= ~own
    if others.any():
        yield None, others


def _learn(known: set[str], words_of: np.ndarray | None, means: dict[str | None, tuple[np.ndarray, float]]):
    """Rows of (lang, kind, key, value): documents and class shares, and words of each slice.

    Without ``words_of`` the words are those that can be common, else they are the given ones. Only documents
    near the mean of their language enter, where there is one.
    """
    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in steps(whole, "text")):
            words = Words(batch.column("text"), NOT_SPACE)
            hashes = words.hashes()
            wanted = np.ones(len(hashes), bool) if words_of is None else np.isin(hashes, words_of)
            shares = _shares(class_counts(words))
            rows = []
            for lang, own_texts in _by_language(known, batch.column("lang")):
                if lang in means:
                    mean, most = means[lang]
                    own_texts = own_texts & (_distance(_term(shares, mean[None, :]).sum(axis=1)) <= most)
                judged = own_texts & (words.counts >= JUDGED_WORDS)
                rows.append((lang, "judged", 0, float(judged.sum())))
                rows += [(lang, "class", k, float(x)) for k, x in enumerate(shares[judged].sum(axis=0))]
                own = np.repeat(own_texts, words.counts)
                n_own = int(own.sum())
                rows.append((lang, "words", 0, float(n_own)))
                found, count = np.unique(hashes[own & wanted], return_counts=True)
                if words_of is None:
                    often = count >= COMMON / 2 * n_own
                    found, count = found[often], count[often]
                rows += [(lang, "word", k, float(c)) for k, c in zip(found.view(np.int64).tolist(), count.tolist())]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(zip(*rows), (pa.string(), pa.string(), pa.int64(), pa.float64()))],
                    ["lang", "kind", "key", "value"])
    return learn


def _learnt(docs: DataFrame, known: set[str], words_of: np.ndarray | None, means: dict[str | None, tuple[np.ndarray, float]]) -> dict:
    """{lang: {kind: {key: sum}}}; bounded by the classes and 1 / COMMON words of each language."""
    sums = saved(docs.mapInArrow(_learn(known, words_of, means), "lang string, kind string, key bigint, value double").groupBy(
        "lang", "kind", "key").agg(F.sum("value").alias("value")), "histograms")
    totals = sums.filter("kind = 'words'").select(F.col("lang").alias("_lang"), F.col("value").alias("words"))
    least, more = (COMMON, 0) if words_of is None else (2 * COMMON, CHANCE)
    rows = sums.join(totals, F.col("lang").eqNullSafe(F.col("_lang"))).filter(
        (F.col("kind") != "word") | (F.col("value") >= least * F.col("words") + more))
    out: dict = defaultdict(lambda: defaultdict(dict))
    for row in rows.select("lang", "kind", "key", "value").collect():
        out[row.lang][row.kind][row.key] = row.value
    return out


def _means(learnt: dict) -> dict[str | None, np.ndarray]:
    """Mean shares of the classes in each language with a judged document, leaning towards those of all of them."""
    found = {x: np.array([learnt[x]["class"].get(k, 0.0) for k in range(len(CLASSES))])
             for x in sorted(learnt, key=lambda x: (x is None, x)) if learnt[x]["judged"].get(0, 0)}
    if not found:
        return {}
    everything = sum(found.values()) / sum(learnt[x]["judged"][0] for x in found)
    means = {}
    for x, sums in found.items():
        mixed = (sums + LEAN * everything) / (learnt[x]["judged"][0] + LEAN)
        if sums[LETTERS].sum() > 0:
            mixed[LETTERS] = mixed[LETTERS].sum() * sums[LETTERS] / sums[LETTERS].sum()
        means[x] = mixed / mixed.sum()
    return means


def learn_references(docs: DataFrame, text: str = "text", lang: str = "lang") -> References:
    """References of the languages of all documents. Without any text of 50 words there are none, nor without one near the mean."""
    docs = docs.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    known = _tags(docs)
    first = _learnt(docs, known, None, {})
    candidates = np.unique(np.array(sorted({k for x in first.values() for k in x["word"]}), np.int64).view(np.uint64))
    near = {x: (mean, TRIM[0] + TRIM[1] / np.sqrt(first[x]["judged"][0])) for x, mean in _means(first).items()}
    learnt = _learnt(docs, known, candidates, near)
    means = _means(learnt)
    if not means:
        return References()
    words = np.unique(np.array(sorted({k for x in means for k in learnt[x]["word"]}), np.int64).view(np.uint64))
    shares = []
    for x in means:
        found = np.array(list(learnt[x]["word"]), np.int64).view(np.uint64)
        shares.append((np.searchsorted(words, found), np.array(list(learnt[x]["word"].values()), float) / learnt[x]["words"][0]))
    return References(list(means), np.array(list(means.values())), words, shares, *[np.array([learnt[x][kind][0] for x in means]) for kind in ("words", "judged")])


def _distances(words: Words, hashes: np.ndarray, refs: References, own: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """By characters, then by common words: the least distance of each text to a reference, and the least with errors.

    ``own`` is the place of the language of each text in ``refs``, -1 without one. Without references, and by words
    without common words, both are 0.
    """
    n = len(words.counts)
    p = _shares(class_counts(words))
    by_char = [_distance(_term(p, q[None, :]).sum(axis=1)) for q in refs.classes]
    by_word = []
    if len(refs.words):
        at = np.minimum(np.searchsorted(refs.words, hashes), len(refs.words) - 1)
        common = refs.words[at] == hashes
        keys, count = np.unique(words.texts()[common] * len(refs.words) + at[common], return_counts=True)
        text, word = keys // len(refs.words), keys % len(refs.words)
        share = count / words.counts[text]
        q = np.zeros(len(refs.words))
        for places, shares in refs.shares:
            q[:] = 0
            q[places] = shares
            its = q[word] > 0
            inside = np.bincount(text[its], share[its], n)
            met = np.bincount(text[its], (_term(share, q[word]) - q[word] / 2)[its], n)
            by_word.append(_distance(met + shares.sum() / 2 + _term(1 - inside, 1 - shares.sum())))
    for distances, (_, more, unlike) in ((by_char, CHAR_DISTANCE), (by_word, WORD_DISTANCE)):
        if not distances:
            yield np.zeros(n), np.zeros(n)
            continue
        errors = more / np.sqrt(refs.sizes) + unlike / np.sqrt(refs.documents)
        yield np.min(distances, axis=0), np.min([
            np.where(own == k, x - error, x + error) for k, (x, error) in enumerate(zip(distances, errors))], axis=0)


def repeated_words(words: Words, hashes: np.ndarray) -> np.ndarray:
    """Whether each word is in a window that its text has twice or more."""
    cover = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(words.left() >= WINDOW)
    again = at[repeated(per_text(window_hashes(hashes, WINDOW)[at], words.texts()[at]))] if len(at) else at
    np.add.at(cover, again, 1)
    np.add.at(cover, again + WINDOW, -1)
    return np.cumsum(cover[:-1]) > 0


def repeated_lines(words: Words) -> np.ndarray:
    """Lines of each text that have a word and equal an earlier line of it."""
    new = words.data == 0x0A
    edge = np.zeros(len(words.data) + 1, bool)
    edge[words.offsets] = True
    starts = np.flatnonzero(edge[:-1] | np.r_[False, new[:-1]]) if len(words.data) else np.zeros(0, np.int64)
    if not len(starts):
        return np.zeros(len(words.counts), np.int64)
    ends = np.r_[starts[1:], len(words.data)]
    ends = ends - new[ends - 1]
    has_word = np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, starts)
    starts, ends = starts[has_word], ends[has_word]
    of = np.searchsorted(words.offsets, starts, "right") - 1
    lines = object.__new__(Words)
    lines.data, lines.starts, lines.ends = words.data, starts, ends
    keys = per_text(lines.hashes(), of)
    again = np.ones(len(keys), bool)
    again[np.unique(keys, return_index=True)[1]] = False
    return np.bincount(of[again], minlength=len(words.counts))


def _judge(refs: References, name: str):
    place = {lang: k for k, lang in enumerate(refs.languages)}

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in steps(whole, name)):
            words = Words(batch.column(name), NOT_SPACE)
            hashes = words.hashes()
            inside = np.zeros(len(words.data) + 1, np.int64)
            np.add.at(inside, words.starts, 1)
            np.add.at(inside, words.ends, -1)
            whole = (np.cumsum(inside[:-1]) > 0) & (CLASS_OF[words.data] >= 0)
            n = words.counts
            again = segment_sums(repeated_words(words, hashes), words.first)
            failed = (n < MIN_WORDS) | (100 * again > MOST_REPEATED * n)
            own = np.array([place.get(x, place.get(None, -1)) for x in batch.column("_lang").to_pylist()], np.int64)
            (chars, chars_at_best), (common, common_at_best) = _distances(words, hashes, refs, own)
            limits = (base + more / np.sqrt(np.maximum(n, 1)) for base, more, _ in (CHAR_DISTANCE, WORD_DISTANCE))
            far = (n >= JUDGED_WORDS) & ((chars_at_best > next(limits)) | (common_at_best > next(limits)))
            kept = [x for x in batch.schema.names if x not in ("_text", "_lang")]
            yield pa.RecordBatch.from_arrays(
                [batch.column(name) for name in kept] + [
                    pa.array(x, pa.int64()) for x in (
                        n, segment_sums(whole, words.offsets), segment_sums(_IS_SYMBOL[words.data], words.offsets),
                        repeated_lines(words), again)
                ] + [pa.array(failed), pa.array(~failed & ~far), pa.array(chars), pa.array(common)],
                kept + ADDED)
    return judge


ADDED = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
         "char_distance", "word_distance"]


def quality_rules(docs: DataFrame, references: References, columns: list[str], text: str = "text",
                  lang: str = "lang") -> DataFrame:
    """``columns`` of each document with its counts, distances and verdict.

    A NULL text has no words and fails, as does any text with fewer than 20 words. A text is kept if it does
    not fail and is not far from every reference; one with fewer than 50 words is not judged by distance, and none
    is without references. Distances are the plain ones, 0 without references. Repeated rows are judged alike. An empty table gives no rows. ``columns`` may be any but
    the added names.
    """
    own = [] if text in columns else [F.col(text).alias("_text")]     # a text that is kept is not sent twice
    read = docs.select(*columns, *own, F.col(lang).cast("string").alias("_lang"))
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in read.schema.fields if f.name not in ("_text", "_lang")]
    schema = ", ".join(kept + [f"{x} bigint" for x in ADDED[:5]] + [f"{x} boolean" for x in ADDED[5:7]]
                       + [f"{x} double" for x in ADDED[7:]])
    return read.mapInArrow(_judge(references, "_text" if own else text), schema)
