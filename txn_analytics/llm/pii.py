"""Personal data by weak supervision: labelers vote on candidate spans, EM weighs them, a classifier decides.

Spans of the four base patterns are always kept. Wider patterns propose candidates: numbers in groups, addresses
with a spelled-out at sign, long hexadecimal strings. Regex, gazetteer and context labelers vote on every
candidate (personal, not personal, abstain). Votes and the features of the classifier have few values, so each
candidate is one number, its pattern, and all candidates of the corpus are counted by pattern. On these counts
expectation-maximisation estimates how far each labeler can be trusted, and a logistic classifier is trained on
the posteriors. Candidates that it accepts and that touch no base span are added.
"""

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txn_analytics.cluster import saved
from txn_analytics.llm.words import steps

KINDS = ["email", "ip", "card", "phone", "secret"]
BASE_KINDS = KINDS[:4]

# Fixed patterns. Every possible start of a run fails alike, so a match may begin at the start of a run only.
_EMAIL_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_NAME_CHARACTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Candidates beyond the base patterns.
_NUMBER = re.compile(r"(?<![\w.+-])[+(]?[0-9](?:[\x20().-]{0,2}[0-9]){6,24}(?![\w-])")
_SPELLED = re.compile(r"(?<![\w.])[A-Za-z0-9._%+-]{1,64}\x20?[(\[](?:at|AT)[)\]]\x20?[A-Za-z0-9-]{1,64}"
                      r"(?:\x20?(?:\.|[(\[](?:dot|DOT)[)\]])\x20?[A-Za-z0-9-]{2,64}){1,4}")
_HEX = re.compile(r"(?<![0-9A-Za-z])[0-9a-f]{32,128}(?![0-9A-Za-z])")

# Fixed lists of the gazetteer and context labelers.
_TOP_DOMAINS = {"com", "org", "net", "edu", "gov", "io", "info", "de", "fr", "es", "it", "uk", "eu", "us", "ch", "at"}
_COUNTRY_CODES = {"1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "41", "43", "44", "45", "46", "47", "48",
                  "49", "52", "55", "61", "81", "82", "86", "90", "91"}
_CARD_PREFIXES = ("34", "37", "4", "51", "52", "53", "54", "55", "6011", "65")
_FOR = re.compile(r"(?i)\b(?:e-?mail|contact|call|tel|phone|mobile|fax|card|visa|credit|account|iban|ssn|token|secret|"
                  r"password|api[_ ]?key|telefon|handy|karte|konto|t[eé]l[eé]phone|carte|tel[eé]fono|tarjeta|cuenta)\b")
_AGAINST = re.compile(r"(?i)\b(?:isbn|issn|version|page|pages|figure|table|section|chapter|vol|art\.?|sha256|md5|commit|seite|p[aá]gina)\b")
_CONTEXT = 40

LABELERS = ["shape", "checksum", "gazetteer", "context", "plain"]
FEATURES = ["digits", "marks", "cue", "valid"]     # two bits each
YES, NO, ABSTAIN = 1, 0, 2


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = ord(d) - 48
        total += d if k % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        domain = _EMAIL_DOMAIN.match(text, at)
        start = at
        if domain:
            while start > done and text[start - 1] in _NAME_CHARACTERS:
                start -= 1
        if domain and start < at:
            yield start, domain.end()
            done = domain.end()
            at = text.find("@", done)
        else:
            at = text.find("@", at + 1)


def _digits(text: str) -> str:
    return "".join([c for c in text if "0" <= c <= "9"])


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the base patterns, by kind and start."""
    spans = [("email", a, b) for a, b in _emails(text)]
    spans += [("ip", *m.span()) for m in _IP.finditer(text)
              if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            spans.append(("card", *m.span()))
    spans += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return spans


def _votes(kind: str, text: str, start: int, end: int, touched: bool) -> int:
    """The pattern of a candidate: kind, whether a base span touches it, votes and features."""
    span = text[start:end]
    digits = _digits(span)
    before = text[max(0, start - _CONTEXT):start]
    groups = len(re.findall(r"[0-9]+", span))
    for_it, against = bool(_FOR.search(before)), bool(_AGAINST.search(before))
    if kind == "email":
        shape, checksum = YES, ABSTAIN
        gazetteer = YES if re.split(r"[^A-Za-z0-9-]+", span.rstrip(")]"))[-1].lower() in _TOP_DOMAINS else NO
        plain = ABSTAIN
    elif kind == "secret":
        letters = len(set(span) - set("0123456789"))
        shape, checksum = (YES if len(digits) >= 8 and letters >= 3 else NO), ABSTAIN
        gazetteer, plain = ABSTAIN, (NO if len(set(span)) < 8 else ABSTAIN)
    elif kind == "card":
        shape = YES if groups in (1, 4, 5) else NO
        checksum = YES if luhn(digits) else NO
        gazetteer = YES if digits.startswith(_CARD_PREFIXES) else NO
        plain = NO if len(set(digits)) < 4 else ABSTAIN
    else:
        shape = YES if span[0] in "+(" or 3 <= groups <= 5 and len(digits) >= 9 else NO
        checksum = YES if 8 <= len(digits) <= 15 else NO
        gazetteer = ABSTAIN if span[0] != "+" else YES if any(digits[:k] in _COUNTRY_CODES for k in (1, 2)) else NO
        plain = NO if groups == 1 or re.fullmatch(r"[0-9]+(?:\.[0-9]+)+", span) else ABSTAIN
    context = YES if for_it and not against else NO if against else ABSTAIN
    out = KINDS.index(kind) * 2 + touched
    for vote in (shape, checksum, gazetteer, context, plain):
        out = out * 4 + vote
    features = (min(len(digits) // 6, 3), min(groups - 1, 3) if groups else 0, 2 * against + for_it,
                2 * (checksum == YES) + (shape == YES))
    for value in features:
        out = out * 4 + value
    return out


def candidates(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int, int]]:
    """Candidates (kind, start, end, pattern), by start; a later one never touches an earlier one."""
    found = [("email", *m.span()) for m in _SPELLED.finditer(text)] if "(" in text or "[" in text else []
    found += [("email", a, b) for kind, a, b in base if kind == "email"]
    found += [("secret", *m.span()) for m in _HEX.finditer(text)]
    for m in _NUMBER.finditer(text):
        n = len(_digits(m[0]))
        found.append(("card" if 16 <= n <= 19 and m[0][0] not in "+(" else "phone", *m.span()))
    out, end = [], 0
    taken = sorted((a, b) for _, a, b in base)
    starts = np.array([a for a, _ in taken])
    furthest = np.maximum.accumulate([b for _, b in taken]) if taken else []
    for kind, a, b in sorted(found, key=lambda x: (x[1], -x[2])):
        if a < end:
            continue
        end = b
        at = int(np.searchsorted(starts, b)) if taken else 0
        out.append((kind, a, b, _votes(kind, text, a, b, at > 0 and furthest[at - 1] > a)))
    return out


def _parts(pattern: int) -> tuple[int, bool, list[int], list[int]]:
    """Kind, touched, votes and features of a pattern."""
    values = []
    for _ in range(len(LABELERS) + len(FEATURES)):
        pattern, value = divmod(pattern, 4)
        values.append(value)
    values.reverse()
    return pattern // 2, bool(pattern % 2), values[:len(LABELERS)], values[len(LABELERS):]


def reliabilities(votes: np.ndarray, count: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """EM over vote patterns: P(vote | class) by labeler, class and vote, and P(personal) of each pattern.

    It starts from the majority of the votes. Each labeler begins and stays better than chance by a small prior; the
    prior of the checksum weighs as much as all candidates, since numbers that fail theirs are hardly ever issued.
    """
    yes, no = (votes == YES).sum(axis=1), (votes == NO).sum(axis=1)
    personal = np.clip((yes + 1) / (yes + no + 2), 0.05, 0.95)
    prior = np.ones((votes.shape[1], 2, 3))
    prior[:, 1, YES] += 2.0
    prior[:, 0, NO] += 2.0
    prior[LABELERS.index("checksum"), 1, YES] += count.sum()
    prior[LABELERS.index("checksum"), 0, NO] += count.sum()
    table = np.zeros((votes.shape[1], 2, 3))
    for _ in range(rounds):
        share = np.clip((count * personal).sum() / count.sum(), 0.01, 0.99)
        for k in range(votes.shape[1]):
            for of_class, weight in enumerate((1 - personal, personal)):
                table[k, of_class] = np.bincount(votes[:, k], count * weight, 3) + prior[k, of_class]
        table /= table.sum(axis=2, keepdims=True)
        odds = np.full(len(votes), np.log(share / (1 - share)))
        for k in range(votes.shape[1]):
            odds += np.log(table[k, 1, votes[:, k]] / table[k, 0, votes[:, k]])
        personal = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return table, personal


def _one_hot(kinds: np.ndarray, features: np.ndarray) -> np.ndarray:
    columns = [kinds == k for k in range(len(KINDS))]
    columns += [features[:, f] == v for f in range(features.shape[1]) for v in range(4)]
    return np.stack(columns, axis=1).astype(float)


def train(patterns: dict[int, int], rounds: int = 400) -> list[int]:
    """The patterns that the span classifier accepts, of those that no base span touches."""
    if not patterns:
        return []
    keys = sorted(patterns)
    count = np.array([patterns[k] for k in keys], float)
    parts = [_parts(k) for k in keys]
    kinds, touched = np.array([p[0] for p in parts]), np.array([p[1] for p in parts])
    votes, features = np.array([p[2] for p in parts]), np.array([p[3] for p in parts])
    _, personal = reliabilities(votes, count)
    x, weight = _one_hot(kinds, features), np.zeros(len(KINDS) + 4 * len(FEATURES))
    share = count / count.sum()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-x @ weight))
        weight -= 2.0 * (x.T @ (share * (p - personal)) + 1e-4 * weight)
    accepted = (1 / (1 + np.exp(-x @ weight)) >= 0.5) & ~touched
    return [k for k, yes in zip(keys, accepted) if yes]


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("pattern", pa.int64())])
SPANS = "array<struct<kind:string,start:bigint,end:bigint,pattern:bigint>>"


def _propose(name: str, kept: list[str]):
    def propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in steps(whole, name)):
            texts = batch.column(name)
            rows = np.flatnonzero(pc.fill_null(pc.match_substring_regex(
                texts, r"[0-9@]|[(\[](at|AT)[)\]]|[0-9a-f]{32}"), False).to_numpy(zero_copy_only=False))
            base, proposed = [[]] * batch.num_rows, [[]] * batch.num_rows
            for i in rows.tolist():
                text = texts[i].as_py()
                found = base_spans(text)
                base[i] = [{"kind": k, "start": a, "end": b, "pattern": None} for k, a, b in found]
                proposed[i] = [{"kind": k, "start": a, "end": b, "pattern": p} for k, a, b, p in candidates(text, found)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(x) for x in kept] + [pa.array(x, pa.list_(_SPAN)) for x in (base, proposed)],
                [*kept, "base", "proposed"])
    return propose


def find(docs: DataFrame, columns: list[str], text: str = "text") -> DataFrame:
    """``columns`` of each document with ``base``, the spans of the base patterns, and ``added``, the others.

    Both are sorted by kind as listed in ``KINDS`` and by start; positions are code points, ends exclusive. A
    NULL or empty text has no spans. Candidates of all rows are counted, repeated rows included; an empty table
    trains nothing and gives no rows. ``columns`` may be any but ``base``, ``proposed`` and ``added``.
    """
    read = docs.select(*columns, *([] if text in columns else [text]))
    types = {f.name: f.dataType.simpleString() for f in read.schema.fields}
    proposed = saved(read.mapInArrow(_propose(text, columns), ", ".join(
        [f"`{c}` {types[c]}" for c in columns] + [f"base {SPANS}", f"proposed {SPANS}"])), "spans")
    # One row for each pattern; there are few thousand at most, whatever the corpus.
    counted = proposed.select(F.explode("proposed.pattern").alias("pattern")).groupBy("pattern").count().collect()
    accepted = train({row["pattern"]: row["count"] for row in counted})
    inside = F.array(*[F.lit(p).cast("long") for p in accepted]) if accepted else F.array().cast("array<bigint>")
    order = F.array(*[F.lit(k) for k in KINDS])

    def by_kind(spans: Column) -> Column:
        return F.transform(F.array_sort(F.transform(spans, lambda s: F.struct(
            F.array_position(order, s["kind"]).alias("at"), s["start"].alias("start"), s["end"].alias("end"),
            s["kind"].alias("kind")))), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return proposed.select(
        *columns, by_kind(F.col("base")).alias("base"),
        by_kind(F.filter("proposed", lambda s: F.array_contains(inside, s["pattern"]))).alias("added"))


def listed(spans: str | Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def merged(first: str, second: str) -> Column:
    """Two lists of spans as one, by kind and start."""
    order = F.array(*[F.lit(k) for k in KINDS])
    both = F.transform(F.concat(first, second), lambda s: F.struct(
        F.array_position(order, s["kind"]).alias("at"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    return F.transform(F.array_sort(both), lambda s: F.struct(
        s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


def _mask(name: str):
    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in steps(whole, name)):
            at = batch.schema.get_field_index(name)
            spans = batch.column("_spans")
            hit = np.flatnonzero(pc.fill_null(pc.list_value_length(spans), 0).to_numpy(zero_copy_only=False))
            out = batch.select([x for x in batch.schema.names if x != "_spans"])
            if len(hit):
                texts = batch.column(at).to_pylist()
                for i in hit.tolist():
                    text, parts, done = texts[i], [], 0
                    for span in sorted(spans[i].as_py(), key=lambda s: (s["start"], -s["end"])):
                        if span["start"] >= done:
                            parts += [text[done:span["start"]], f"<{span['kind']}>"]
                        done = max(done, span["end"])
                    texts[i] = "".join([*parts, text[done:]])
                out = out.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))
            yield out
    return mask


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with every span replaced by its kind in angle brackets; spans that overlap become one.

    The other columns are carried in one, so that their names cannot clash with those of the spans.
    """
    others = [name for name in docs.columns if name != text]
    rest = F.struct(*others) if others else F.lit(None).cast("int")
    found = find(docs.select(rest.alias("_row"), F.col(text).alias("_text")), ["_row", "_text"], "_text")
    found = found.select("_row", "_text", merged("base", "added").alias("_spans"))
    row = found.schema["_row"].dataType.simpleString()
    masked = found.mapInArrow(_mask("_text"), f"_row {row}, _text string")
    return masked.select(*[F.col("_text").alias(name) if name == text else F.col("_row")[name].alias(name) for name in docs.columns])
