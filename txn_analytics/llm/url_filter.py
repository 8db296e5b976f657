"""URL filter: allow and block rules, then exact membership in a list of domains by a cascade of Bloom filters.

The keys are the hosts of the corpus and those parent domains that have as many labels as a listed domain. The first filter encodes the listed ones. Keys of
the corpus that are not listed and pass it are encoded by the second filter, listed keys that pass that one by the
third, and so on, until a filter lets nothing through that it should not. Over the keys of the corpus the cascade
then answers exactly, and every URL is judged by expressions over constants, without a join.

Everything is built-in DataFrame functions. A filter is one array of 64-bit words, read as a scalar subquery.
"""

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txn_analytics.cluster import saved

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Bits and hashes for each key of the first filter, and of the later ones, which meet few keys.
FIRST, LATER = (16, 8), (6, 3)
#: Filters are sent to every task: about the most bytes of one. A larger list is cut into parts by a hash of the key, and
#: the pages go through the parts one after the other.
MOST_BYTES = 64_000_000


def after_scheme(url: str | Column) -> Column:
    url = F.col(url) if isinstance(url, str) else url
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host(url: str | Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without it or for NULL."""
    return F.translate(F.regexp_extract(after_scheme(url), "^[^/?#]*", 0), UPPER, LOWER)


def path(url: str | Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(after_scheme(url), "^[^/?#]*([^?#]*)", 1)


def rule(rules: Sequence[tuple[str, str, str]], host: str = "host", path: str = "path") -> Column:
    """(rule, verdict) of the longest rule (verdict, host, path) that fits, NULL if none does.

    A rule fits its host and all subdomains, if the path starts with its path. The first of rules of the same
    length wins.
    """
    out = None
    for verdict, domain, prefix in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((F.col(host) == domain) | F.col(host).endswith("." + domain)) & F.col(path).startswith(prefix)
        value = F.struct(F.lit(domain + prefix).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out if out is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def keys(depths: Sequence[int], host: str = "host") -> list[Column]:
    """The parent domains of the host with so many labels, itself included; NULL where it has fewer."""
    labels = F.size(F.split(F.col(host), "[.]"))
    return [F.when(labels >= n, F.substring_index(F.col(host), ".", -n)) for n in depths]


class Cascade:
    """Filters by level; ``contains`` is exact for the keys of the universe it was built over."""

    def __init__(self, universe: DataFrame):
        """``universe`` has one row for each key: (key, listed)."""
        self.levels: list[tuple[DataFrame, int, int]] = []
        encoded, others = universe.filter("listed").select("key"), universe.filter("NOT listed").select("key")
        while not encoded.isEmpty():
            bits, hashes = FIRST if not self.levels else LATER
            size = -(-max(encoded.count() * bits, 64) // 64)
            self.levels.append((self._filter(encoded, size, hashes), size, hashes))
            passed = saved(others.filter(self._passes(F.col("key"), len(self.levels) - 1)), "passed")
            encoded, others = passed, encoded

    @staticmethod
    def _positions(key: Column, level: int, size: int, hashes: int) -> list[Column]:
        return [F.pmod(F.xxhash64(key, F.lit(level), F.lit(k)), F.lit(size * 64)) for k in range(hashes)]

    def _filter(self, encoded: DataFrame, size: int, hashes: int) -> DataFrame:
        """One row with the words of the filter; words are merged by OR before they meet in one task."""
        bit = encoded.select(F.explode(F.array(*self._positions(F.col("key"), len(self.levels), size, hashes))).alias("bit"))
        words = bit.groupBy(F.expr("cast(bit div 64 as int)").alias("at")).agg(
            F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("word"))
        empty = encoded.sparkSession.range(size).select(F.col("id").cast("int").alias("at"), F.lit(0).cast("long").alias("word"))
        full = words.union(empty).groupBy("at").agg(F.bit_or("word").alias("word"))
        return saved(full.agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]).alias("words")), "filter")

    def _passes(self, key: Column, level: int) -> Column:
        words, size, hashes = self.levels[level]
        held = words.scalar()
        out = F.lit(True)
        for bit in self._positions(key, level, size, hashes):
            word = F.get(held, F.floor(bit / 64).cast("int"))
            out = out & (F.call_function("getbit", word, F.pmod(bit, F.lit(64)).cast("int")) == 1)
        return out

    def contains(self, key: Column) -> Column:
        """Whether a key of the universe is listed: passing an odd number of levels in a row, and no further."""
        out = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(range(len(self.levels))):
            out = F.when(~self._passes(key, level), F.lit(level % 2 == 1)).otherwise(out)
        return out


def _parts(universe: DataFrame) -> int:
    """How many parts keep the filters of each within ``MOST_BYTES``: listed keys fill the first, false positives the second."""
    size = universe.agg(F.count("*").alias("all"), F.coalesce(F.sum(F.col("listed").cast("long")), F.lit(0)).alias("listed")).first()
    bits, hashes = FIRST
    passed = size["all"] * (1 - math.exp(-hashes / bits)) ** hashes
    return max(1, math.ceil(max(size["listed"] * bits, passed * LATER[0]) / 8 / MOST_BYTES))


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]], listed: DataFrame, columns: list[str],
          url: str = "url") -> DataFrame:
    """``columns`` of each page with host, path, rule and verdict (allow or block).

    ``listed`` has domains in its column ``key``; a page is blocked if no rule fits and its host is listed or is a
    subdomain of a listed domain, of any number of labels. A NULL URL, or one without ``://``, has an empty host and
    path, fits no rule and is allowed. Repeated URLs and repeated, empty or NULL list entries change nothing. An empty
    list blocks nothing; an empty table gives no rows. ``columns`` may be any but the added names and ``_blocked``.
    """
    parsed = pages.select(*columns, host(url).alias("host"), path(url).alias("path"))
    wanted = listed.select("key").filter("key <> ''")
    # One number for each length of a listed domain: a name has 127 labels at most.
    depths = sorted(row[0] for row in wanted.select(F.size(F.split("key", "[.]"))).distinct().collect())
    own = keys(depths)
    # The universe: distinct hosts first, which are few, then their parents. One aggregation marks the listed keys.
    corpus = parsed.select("host").distinct().select(F.explode(F.array(*own).cast("array<string>")).alias("key"))
    marked = corpus.select("key", F.lit(False).alias("listed"), F.lit(True).alias("met")).union(
        wanted.select("key", F.lit(True), F.lit(False)))
    universe = saved(marked.filter("key <> ''").groupBy("key").agg(
        F.max("listed").alias("listed"), F.max("met").alias("met")).filter("met"), "universe")
    rows, parts = parsed.withColumn("_blocked", F.lit(False)), _parts(universe)
    for part in range(parts):
        def of_part(key: Column, part: int = part) -> Column:
            return F.pmod(F.xxhash64(key, F.lit(-1)), F.lit(parts)) == part
        cascade = Cascade(universe.filter(of_part(F.col("key"))))
        blocked = F.col("_blocked")
        for key in own:
            blocked = blocked | F.coalesce((key != "") & of_part(key) & cascade.contains(key), F.lit(False))
        rows = rows.withColumn("_blocked", blocked)
        if part + 1 < parts:
            rows = saved(rows, "judged")
    fits = rows.withColumn("_rule", rule(rules))
    return fits.select(
        *columns, "host", "path", F.col("_rule.rule").alias("rule"),
        F.when(F.col("_rule").isNotNull(), F.col("_rule.verdict")).when(F.col("_blocked"), "block").otherwise("allow").alias("verdict"))
