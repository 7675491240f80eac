"""URL rules behind a Bloom filter cascade.

A rule lists a host and a path and fits that host and its subdomains where the url's path begins with the
rule's.  So a url has few keys that a rule could have: each suffix of its host (cut at dots) with each prefix
of its path that is as long as some rule's path.  The keys of all urls are the corpus's complete key
universe.  For each verdict a cascade of Bloom filters is built: the first holds the listed keys, the second
those keys of the universe that the first wrongly lets pass, the third the listed keys that the second lets
pass, and so on until nothing passes wrongly.  For keys of the universe membership is then exact, and a url is
judged by bit tests on its own row: no join, and no look at the list.

The size of a cascade follows the list, not the corpus: the first filter lets about as many wrong keys pass
as there are listed ones, so a rule costs some ten to forty bits, which every task holds.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bit_set, bit_words, written

@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str  # allow or block

    @property
    def key(self) -> str:
        return self.host + self.path


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null and for urls without ``://``."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    host = F.translate(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1), upper, upper.lower())
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def candidate_keys(host: Column, path: Column, lengths: list[int]) -> Column:
    """Every key a rule that fits could have, the most specific first: longer hosts, then longer paths.  Empty hosts have none."""
    labels = F.split(host, r"\.", -1)
    suffixes = F.transform(
        F.when(host == "", F.array().cast("array<int>")).otherwise(F.sequence(F.lit(1), F.size(labels))),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    cuts = F.array(*(F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in sorted(lengths, reverse=True)))
    cuts = F.filter(cuts, lambda p: p.isNotNull())
    return F.flatten(F.transform(suffixes, lambda h: F.transform(cuts, lambda p: F.struct(h.alias("host"), p.alias("path")))))


def _positions(key: Column, level: int, bits: int, hashes: int) -> list[Column]:
    start = F.pmod(F.xxhash64(key, F.lit(2 * level)), F.lit(bits).cast("bigint"))
    step = F.pmod(F.xxhash64(key, F.lit(2 * level + 1)), F.lit(bits - 1).cast("bigint")) + 1
    return [F.pmod(start + F.lit(i).cast("bigint") * step, F.lit(bits).cast("bigint")) for i in range(hashes)]


@dataclass(frozen=True)
class Level:
    number: int
    bits: int
    hashes: int
    words: Column

    def passes(self, key: Column) -> Column:
        """Whether a key passes this filter, as an expression on the row; the filter stands in it once."""
        return F.forall(F.array(*_positions(key, self.number, self.bits, self.hashes)), lambda at: bit_set(self.words, at))


def _level(keys: DataFrame, number: int, count: int, rate: float) -> Level:
    """A filter over ``keys(key)``."""
    rate = min(0.5, max(rate, 1e-9))
    bits = max(64, -(-int(count * math.log(1 / rate) / math.log(2) ** 2 + 1) // 64) * 64)
    hashes = max(1, round(math.log(1 / rate) / math.log(2)))
    return Level(number, bits, hashes, bit_words(keys.select(F.explode(F.array(*_positions(F.col("key"), number, bits, hashes))).alias("at")), bits))


def build_cascades(listed: dict[str, DataFrame], universe: DataFrame, sizes: tuple[int, int] | None = None) -> dict[str, list[Level]]:
    """For each name the levels of ``listed[name](key)`` that are exact over ``universe(key)``; no listed keys give no levels.

    Listed keys may lie outside the universe; null keys are in neither.  The universe is read once to tell its size
    and once for all first levels; what passes them wrongly, about as many keys as are listed, is written, and all
    further levels come from that.  ``sizes`` stands for the numbers of listed and of all keys.
    """
    spark = universe.sparkSession
    listed = {name: keys.where("key IS NOT NULL").select("key").distinct() for name, keys in listed.items()}
    counts = {name: sizes[0] if sizes else keys.count() for name, keys in listed.items()}
    listed = {name: keys for name, keys in listed.items() if counts[name]}
    out: dict[str, list[Level]] = {name: [] for name in counts}
    if not listed:
        return out
    all_keys = sizes[1] if sizes else universe.agg(F.approx_count_distinct("key")).first()[0]
    for name, keys in listed.items():
        out[name].append(_level(keys, 0, counts[name], counts[name] / max(1, all_keys)))
    key = F.col("key")
    passing = F.array_compact(F.array(*(F.when(out[name][0].passes(key), F.lit(name)) for name in listed)))
    passed = universe.where("key IS NOT NULL").select(F.explode(passing).alias("name"), "key").distinct()
    known = None
    for name, keys in listed.items():
        own = keys.select(F.lit(name).alias("name"), "key")
        known = own if known is None else known.union(own)
    wrong = written(passed.join(known, ["name", "key"], "left_anti"), "wrong")
    for name, keys in listed.items():
        yes, no = keys, wrong.where(F.col("name") == name).select("key")
        while count := no.count():
            out[name].append(_level(no, len(out[name]), count, 0.5))
            yes, no = no, yes.where(out[name][-1].passes(key))
    return out


def build_cascade(listed: DataFrame, universe: DataFrame, sizes: tuple[int, int] | None = None) -> list[Level]:
    """``build_cascades`` for one list."""
    return build_cascades({"": listed}, universe, sizes)[""]


def in_cascade(key: Column, levels: list[Level]) -> Column:
    """Exact membership of a key of the universe: the first level it does not pass decides."""
    out = F.lit(len(levels) % 2 == 1)
    for level in reversed(levels):
        out = F.when(level.passes(key), out).otherwise(F.lit(level.number % 2 == 1))
    return out


def filter_urls(pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """``(page_id, host, path, rule, verdict)``, one row per input row.

    ``rule`` is the longest rule that fits, as host and path joined (longest host first, then longest path), and
    null if none does, in which case the verdict is ``default``: the url is not listed.  A null url and a url
    without ``://`` have empty host and path, and no rule.  Of rules given twice the first counts.  Ids are
    carried as they are; other columns do not matter; no rules give ``default`` throughout.
    """
    spark = pages.sparkSession
    first: dict[tuple[str, str], str] = {}
    for r in rules:
        first.setdefault((r.host, r.path), r.verdict)
    host, path = url_parts(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    none = F.lit(None).cast("string")
    if not first:
        return rows.select("*", none.alias("rule"), F.lit(default).alias("verdict"))
    keyed = rows.withColumn("keys", candidate_keys(F.col("host"), F.col("path"), sorted({len(p) for _, p in first})))
    # a tab stands between host and path, so different rules have different keys
    text = lambda k: F.concat(k["host"], F.lit("\t"), k["path"])
    universe = keyed.select(F.explode(F.transform("keys", text)).alias("key"))
    given = spark.createDataFrame([(f"{h}\t{p}", v) for (h, p), v in first.items()], "key string, verdict string")
    found = build_cascades({v: given.where(F.col("verdict") == v).select("key") for v in sorted(set(first.values()))}, universe)
    hit = keyed.withColumn(
        "hit",
        F.get(
            F.filter(
                F.transform(
                    "keys",
                    lambda k: F.struct(
                        F.concat(k["host"], k["path"]).alias("rule"),
                        F.coalesce(*(F.when(in_cascade(text(k), levels), F.lit(v)) for v, levels in found.items())).alias("verdict"),
                    ),
                ),
                lambda x: x["verdict"].isNotNull(),
            ),
            0,
        ),
    )
    return hit.select("page_id", "host", "path", F.col("hit.rule").alias("rule"), F.coalesce("hit.verdict", F.lit(default)).alias("verdict"))
