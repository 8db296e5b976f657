"""Near duplicates: MinHash tables by tensored banding, links confirmed on full shingle sets, components.

Two collections hold ``SIDE`` tuples of minhashes each. A table key joins one tuple of either, so ``SIDE ** 2``
tables come from ``2 * SIDE`` tuples: about the square root of the minhash work of independent tables. At a
similarity of 0.75 a pair misses every table when it misses every tuple of one collection.

1. Equal sets become one; the rest works on distinct sets, named by their smallest document.
2. Every member of a table bucket is a candidate with the smallest member of the bucket.
3. Bounds on set sizes and on parity sketches drop candidates that cannot be similar enough, without error. The
   others are compared on the shingle sets of their whole texts.
4. Buckets that still hold several components are compared across components, in blocks of bounded size, with the
   same bounds and the same confirmation. So no pair of a bucket is left out that
   may be similar enough, and pairs inside a component, which could not change it, are never listed.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txn_analytics.cluster import saved
from txn_analytics.llm.words import (
    NOT_SPACE, Words, first_of_each, mix, per_text, segment_sums, steps, window_hashes,
)

WORDS = 5
PERCENT = 75
SIDE = 11            # tuples of a collection; SIDE ** 2 tables
TUPLE = 2            # minhashes of a tuple; a key has twice as many
SKETCH = 1024        # bits of the parity sketch
BLOCK = 2_000        # members of a bucket compared at once

_SEEDS = mix(np.arange(1, 2 * SIDE * TUPLE + 1, dtype=np.uint64))


class Shingles:
    """Distinct shingles of each text: ``hashes`` of text ``i`` lie from ``first[i]`` up to ``first[i + 1]``."""

    def __init__(self, column: pa.Array):
        words = Words(column, NOT_SPACE, lower=True)
        hashes, left, of = words.hashes(), words.left(), words.texts()
        windows = window_hashes(hashes, WORDS)
        at = np.flatnonzero(left >= WORDS)
        found, owner = windows[at], of[at]
        # A text with fewer words is one shingle.
        for n in range(1, WORDS):
            short = np.flatnonzero(words.counts == n)
            found = np.concatenate([found, window_hashes(hashes, n)[words.first[short]]])
            owner = np.concatenate([owner, short])
        order = np.argsort(owner, kind="stable")
        found, owner = found[order], owner[order]
        new = first_of_each(per_text(found, owner))
        self.hashes, self.owner = found[new], owner[new]
        self.first = np.searchsorted(self.owner, np.arange(len(words.counts) + 1))
        self.sizes = np.diff(self.first)

    def reduce(self, operation, values: np.ndarray) -> np.ndarray:
        """One value for each text with a shingle."""
        return operation.reduceat(values, self.first[:-1][self.sizes > 0]) if len(values) else values[:0]


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (part for whole in batches for part in steps(whole, "text")):
        sets = Shingles(batch.column("text"))
        full = np.flatnonzero(sets.sizes > 0)
        mins = [sets.reduce(np.minimum, mix(sets.hashes + seed)) for seed in _SEEDS]
        sides, lanes = [], []
        for side in (mins[:SIDE * TUPLE], mins[SIDE * TUPLE:]):
            tuples = []
            for k in range(SIDE):
                key = np.zeros(len(full), np.uint64)
                for x in side[k * TUPLE:(k + 1) * TUPLE]:
                    key = mix(key + x)
                tuples.append(mix(key + np.uint64(k)))
            sides.append(tuples)
            lanes += [x >> np.uint64(32) for x in tuples]
        keys = np.array([mix(a * np.uint64(3) + b) for a in sides[0] for b in sides[1]]).T.reshape(-1)
        bits = (np.cumsum(sets.sizes > 0) - 1)[sets.owner] * SKETCH + (sets.hashes % np.uint64(SKETCH)).astype(np.int64)
        odd = (np.bincount(bits, minlength=len(full) * SKETCH) & 1).astype(np.uint8)
        sketch = np.ascontiguousarray(np.packbits(odd).view(np.uint64).reshape(len(full), SKETCH // 64).T)
        # An order-free digest of the set: two sums of different mixes.
        digest = [segment_sums(mix(sets.hashes ^ np.uint64(salt)), sets.first)[full] for salt in (0x5851F42D, 0x14057B7E)]
        lanes = np.ascontiguousarray(np.array(lanes, np.uint32).T).view(np.int64).T
        none = np.zeros(batch.num_rows, bool)
        none[full] = True
        at = np.cumsum(none) - 1
        pick = pa.array(np.where(none, at, 0), pa.int64(), mask=~none)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(full) + 1) * SIDE ** 2, pa.int32()), pa.array(keys.view(np.int64)))
        columns = [pa.array(x.view(np.int64)).take(pick) for x in (*digest, *sketch, *lanes)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(sets.sizes, pa.int64()), *columns, lists.take(pick)],
            ["id", "n", "d0", "d1", *_SKETCH, *_LANES, "keys"])


_SKETCH = [f"s{k}" for k in range(SKETCH // 64)]
_LANES = [f"m{k}" for k in range(SIDE)]     # the tuples of both collections, two of 32 bits in each


def _possible(left: str, right: str):
    """Whether two sets can be similar enough, by their sizes and the bits in which their sketches differ.

    With i common shingles, 100 i >= P (a + b - i) gives a + b - 2 i <= (100 - P) / (100 + P) (a + b), and each
    bit that differs needs a shingle that only one of them has.
    """
    a, b = F.col(f"{left}.n"), F.col(f"{right}.n")
    differ = sum((F.bit_count(F.col(f"{left}.{s}").bitwiseXOR(F.col(f"{right}.{s}"))) for s in _SKETCH), F.lit(0))
    return ((100 * F.least(a, b) >= PERCENT * F.greatest(a, b))
            & ((100 + PERCENT) * differ <= (100 - PERCENT) * (a + b)))


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose full sets are similar enough."""
    for batch in (p for whole in batches for half in steps(whole, "text_a") for p in steps(half, "text_b")):
        a, b = Shingles(batch.column("text_a")), Shingles(batch.column("text_b"))
        common = np.isin(per_text(a.hashes, a.owner), per_text(b.hashes, b.owner))
        both = segment_sums(common, a.first)
        linked = (100 * both >= PERCENT * (a.sizes + b.sizes - both)) & (both > 0)
        yield batch.filter(pa.array(linked)).select(["a", "b"])


def _confirmed(pairs: DataFrame, docs: DataFrame, name: str) -> DataFrame:
    """Links among the pairs (a, b) of document ids, by the texts of both."""
    texts = docs.select("id", "text")
    both = pairs.join(texts.withColumnsRenamed({"id": "a", "text": "text_a"}), "a").join(
        texts.withColumnsRenamed({"id": "b", "text": "text_b"}), "b")
    return saved(both.select("a", "b", "text_a", "text_b").mapInArrow(_similar, "a bigint, b bigint"), name)


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in a link (a, b); the component is the smallest id reachable.

    Every round points each id at the smallest component among itself and its neighbours, then at that one's own
    component. It ends when no id moves; the rounds are about the logarithm of the longest path.
    """
    edges = links.select("a", "b").union(links.select("b", "a")).filter("a <> b").distinct()
    edges = saved(edges, "edges")
    state = saved(edges.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("b")).select(
        "id", F.least("id", "b").alias("component")), "components")
    while True:
        near = edges.join(state.withColumnsRenamed({"id": "b", "component": "near"}), "b").groupBy("a").agg(F.min("near").alias("near"))
        step = saved(state.join(near.withColumnRenamed("a", "id"), "id").select(
            "id", "component", F.least("component", "near").alias("next")), "step")
        # An id's old component learns of the better one, and each id then takes the component of its component.
        hooks = step.filter("next < component").groupBy(F.col("component").alias("id")).agg(F.min("next").alias("hook"))
        step = step.join(hooks, "id", "left").select("id", "component", F.least("next", F.coalesce("hook", "next")).alias("next"))
        step = saved(step, "step")
        root = step.select(F.col("id").alias("next"), F.col("next").alias("root"))
        moved = saved(step.join(root, "next").select(
            "id", F.least("next", "root").alias("component"), (F.least("next", "root") < F.col("component")).alias("moved")), "components")
        state = moved.select("id", "component")
        if moved.filter("moved").isEmpty():
            return state


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Possible pairs across components in the groups of a partition sorted by group; whole groups are in memory.

    A group holds one part of a bucket, of which all pairs count, or two parts, of which those between them count.
    A pair is given by the first table that it shares, by the tuples of both: whole hashes of 32 bits, which are as
    unlike for long texts as for short ones.
    """
    def pairs(rows: pa.Table) -> pa.RecordBatch:
        at = {x: rows.column(x).to_numpy() for x in rows.column_names}
        sketch = [at[s].view(np.uint64) for s in _SKETCH]
        lanes = np.ascontiguousarray(np.array([at[m] for m in _LANES]).T).view(np.uint32)
        first = np.r_[True, (np.diff(at["key"]) != 0) | (np.diff(at["p"]) != 0) | (np.diff(at["q"]) != 0)]
        group, found = np.cumsum(first), []
        i, step = np.arange(rows.num_rows), 0
        while len(i):
            step += 1
            i = i[i + step < rows.num_rows]
            i = i[group[i + step] == group[i]]
            j = i + step
            size = at["n"][i] + at["n"][j]
            fits = ((at["component"][i] != at["component"][j])
                    & ((at["p"][i] == at["q"][i]) | (at["part"][i] != at["part"][j]))
                    & (100 * np.minimum(at["n"][i], at["n"][j]) >= PERCENT * np.maximum(at["n"][i], at["n"][j])))
            l, r, size = i[fits], j[fits], size[fits]
            differ = np.zeros(len(l), np.int64)
            for s in sketch:
                differ += np.bitwise_count(s[l] ^ s[r])
            fits = (100 + PERCENT) * differ <= (100 - PERCENT) * size
            l, r = l[fits], r[fits]
            agree = lanes[l] == lanes[r]
            tuples = agree.reshape(len(l), 2, SIDE).argmax(axis=2)
            fits = tuples[:, 0] * SIDE + tuples[:, 1] == at["t"][l]
            found.append((at["id"][l[fits]], at["id"][r[fits]]))
        a, b = (np.concatenate([x[k] for x in found]) for k in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.array([batch.column(x).to_numpy() for x in ("key", "p", "q")])
        cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0))
        if held and any(held[-1].column(x)[-1] != batch.column(x)[0] for x in ("key", "p", "q")):
            yield pairs(pa.Table.from_batches(held))
            held = []
        if len(cuts):
            end = int(cuts[-1]) + 1
            yield pairs(pa.Table.from_batches([*held, batch.slice(0, end)]))
            held, batch = [], batch.slice(end)
        held.append(batch)
    if held:
        yield pairs(pa.Table.from_batches(held))


def _mixed_pairs(members: DataFrame, partitions: int) -> DataFrame:
    """Distinct possible pairs across components in buckets (key, t, id, component, n, sketch, minhashes).

    A bucket of more than ``BLOCK`` members is cut into parts by a hash of the id, and every pair of parts is a
    group of its own: no group has more than about ``2 * BLOCK`` rows, however large its bucket is.
    """
    mixed = members.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("size"))
    mixed = mixed.filter("low <> high").select("key", F.ceil(F.col("size") / BLOCK).cast("int").alias("parts"))
    rows = members.join(mixed, "key").withColumn("part", F.expr("cast(pmod(xxhash64(id, 7), parts) as int)"))
    rows = rows.withColumn("other", F.explode(F.expr("sequence(0, parts - 1)"))).select(
        "key", "t", F.least("part", "other").alias("p"), F.greatest("part", "other").alias("q"), "part",
        "id", "component", "n", *_SKETCH, *_LANES)
    return rows.repartition(partitions, "key", "p", "q").sortWithinPartitions("key", "p", "q").mapInArrow(
        _across, "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_shingles, component) of every row with an id, ``n_shingles`` the size of its set.

    ``component`` is the smallest id that links reach. A text without words, NULL or empty, has the empty set
    and is linked with nothing: its component is its own id. A row with a NULL id gets
    the component of equal sets, NULL if there are none. An id should be unique; rows that share one share its component as well. Other columns are not
    read. An empty table gives no rows.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    signed = saved(docs.mapInArrow(
        _signatures, "id bigint, n bigint, d0 bigint, d1 bigint, " + ", ".join(f"{s} bigint" for s in [*_SKETCH, *_LANES]) + ", keys array<bigint>"),
        "signatures")
    sets = signed.filter("n > 0 AND id IS NOT NULL").groupBy("d0", "d1").agg(
        F.min("id").alias("rep"), F.any_value(F.struct("n", *_SKETCH, *_LANES)).alias("of"))
    sets = saved(sets.select("d0", "d1", "rep", "of.*"), "sets")
    meta = sets.select(F.col("rep").alias("id"), "n", *_SKETCH, *_LANES)
    # The keys of the smallest document of each set; its bucket members are then ids of distinct sets.
    own = signed.join(sets.select(F.col("rep").alias("id"), "d0", "d1"), ["id", "d0", "d1"])
    buckets = own.select("id", F.posexplode("keys").alias("t", "key"))
    hubs = buckets.groupBy("key").agg(F.min("id").alias("hub"), F.count("*").alias("size")).filter("size > 1")
    shared = saved(buckets.join(hubs.select("key", "hub"), "key"), "buckets")   # (key, id, t, hub)
    pairs = shared.filter("id <> hub").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()
    left, right = meta.alias("l"), meta.alias("r")
    pairs = pairs.join(left, F.col("a") == F.col("l.id")).join(right, F.col("b") == F.col("r.id")).filter(_possible("l", "r")).select("a", "b")
    links = _confirmed(saved(pairs, "pairs"), docs, "links")

    # Buckets across components, until they are all compared.
    state = components(links)
    members = shared.select("key", "t", "id").join(meta, "id").join(state, "id", "left").withColumn(
        "component", F.coalesce("component", "id"))
    partitions = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    more = saved(_mixed_pairs(members, partitions), "pairs")
    links = links.union(_confirmed(more, docs, "links"))
    state = components(links)

    of_set = sets.join(state.withColumnRenamed("id", "rep"), "rep", "left").select(
        "d0", "d1", F.coalesce("component", "rep").alias("component"))
    return signed.select("id", "n", "d0", "d1").join(of_set, ["d0", "d1"], "left").select(
        "id", F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component"))
