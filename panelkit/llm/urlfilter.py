"""URL filter: exact membership in a host list by a cascade of Bloom filters.

The first level encodes the listed keys. Keys of the corpus that are not listed
but pass it are its false positives; the second level encodes these, the third
the listed keys that pass the second, and so on, until no false positive is
left. Since the false positives are taken over the complete key universe of the
corpus, the answer is exact for every key in it: a key is listed if the first
level that it fails has an even number (counted from one), or if it passes all of an odd
number of levels. Looking up needs no join: the levels are bit arrays of
proven size that go to every task.

A cascade whose bits would be more than ``MAX_BITS`` is split by key hash into
shards of at most that size, looked up one after the other.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from math import ceil, log

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.session import materialize

#: Chance of a false positive at the first and the other levels, and the most bits of a level (32 MB).
FIRST_RATE, RATE = 0.02, 0.2
MAX_BITS = 1 << 28

#: Rules (host, path, verdict), a bounded list that is part of the code: the longest that fits wins.
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block"))

#: Words that list a host when they are a part of its name.
LISTED_WORDS = ("ads", "bet", "bets", "casino", "click", "clickbait", "free", "malware", "phish", "pills", "porn",
                "spam", "track", "tracker", "win", "xxx")


def host() -> Column:
    """From after the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; empty without ``://``."""
    found = F.regexp_extract(_url(), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path() -> Column:
    """What follows the host up to ``? #`` or the end."""
    return F.regexp_extract(_url(), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _url() -> Column:
    return F.coalesce(F.col("url").cast("string"), F.lit(""))


def matching_rule(rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits ``host`` and ``path`` (or null), and its verdict."""
    rule = verdict = F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((F.col("host") == h) | F.col("host").endswith("." + h)) & F.col("path").startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


@dataclass
class Level:
    bits: np.ndarray
    size: int
    hashes: int


def hash_pair(key: Column, level: int) -> list[Column]:
    """Two hashes of a key; the places of a level are drawn from them."""
    return [F.xxhash64(F.lit(2 * level + k), key) for k in (0, 1)]


def places(a, b, size: int, hashes: int) -> list:
    """Bit places by double hashing, the same in numpy and in Spark arithmetic."""
    if isinstance(a, Column):
        low = F.lit(0x7FFFFFFF)
        return [F.pmod(a.bitwiseAND(low) + F.lit(i) * b.bitwiseAND(low), F.lit(size)) for i in range(hashes)]
    return [((a & 0x7FFFFFFF) + i * (b & 0x7FFFFFFF)) % size for i in range(hashes)]


def build_level(keys: DataFrame, n_keys: int, rate: float, level: int) -> Level:
    """A Bloom filter of ``key``: bits are set word by word in Spark, the words are what the driver gets."""
    size = max(64, ceil(n_keys * -log(rate) / log(2) ** 2))
    hashes = max(1, round(size / n_keys * log(2)))
    a, b = hash_pair(F.col("key"), level)
    at = keys.select(F.explode(F.array(*places(a, b, size, hashes))).alias("at"))
    words = (at.groupBy(F.expr("at div 32").alias("word"))
             .agg(F.expr("bit_or(shiftleft(1L, cast(at % 32 as int)))").alias("bits")).toPandas())
    bits = np.zeros((size + 31) // 32, np.uint32)
    bits[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).astype(np.uint32)
    return Level(bits, size, hashes)


def _passes(level: Level, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.ones(len(a), bool)
    for at in places(a, b, level.size, level.hashes):
        out &= (level.bits[at >> 5] >> (at & 31).astype(np.uint32)) & np.uint32(1) == 1
    return out


def _passes_column(level: Level, number: int) -> Column:
    @F.pandas_udf("boolean")
    def passes(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(_passes(level, a.to_numpy(np.int64), b.to_numpy(np.int64)))

    return passes(*hash_pair(F.col("key"), number))


def build_cascade(keys: DataFrame) -> list[Level]:
    """Levels for ``keys`` (key, listed): every distinct key of the corpus, and whether it is listed."""
    yes, no = keys.where("listed").select("key"), keys.where("not listed").select("key")
    levels: list[Level] = []
    encode, other = yes, no
    n = encode.count()
    while n:
        level = build_level(encode, n, FIRST_RATE if not levels else RATE, len(levels))
        false = materialize(other.where(_passes_column(level, len(levels))))
        levels.append(level)
        encode, other, n = false, encode, false.count()
    return levels


def listed_column(levels: list[Level], key: Column) -> Column:
    """Whether a key of the universe is listed, by looking it up in the levels."""
    if not levels:
        return F.lit(False)

    @F.pandas_udf("boolean")
    def listed(*pairs: pd.Series) -> pd.Series:
        cols = [p.to_numpy(np.int64) for p in pairs]
        out = np.full(len(cols[0]), len(levels) % 2 == 1)
        inside = np.ones(len(out), bool)
        for i, level in enumerate(levels):
            now = inside & _passes(level, cols[2 * i], cols[2 * i + 1])
            out[inside & ~now] = i % 2 == 1
            inside = now
        return pd.Series(out)

    return listed(*[h for i in range(len(levels)) for h in hash_pair(key, i)])


def filter_urls(pages: DataFrame, listed: Column | None = None, max_bits: int = MAX_BITS) -> DataFrame:
    """``page_id, host, path, rule, verdict, listed`` for every row of ``pages``.

    ``listed`` is a condition on ``key`` (a host) that marks the list; it is asked once for each distinct host
    when the cascade is built, and the pages are judged by the cascade. A null url, or one without ``://``, has an empty
    host and path, which no rule fits and no list holds. A rule's verdict goes before the cascade's. Repeated
    rows each give a row; an empty table gives none.
    """
    listed = host_is_listed() if listed is None else listed
    rows = pages.select("page_id", host().alias("host"), path().alias("path"))
    keys = materialize(rows.select(F.col("host").alias("key")).distinct().withColumn("listed", listed))
    counts = keys.agg(F.count_if("listed"), F.count_if(~F.col("listed"))).first()
    # the first level holds the listed keys, the second about FIRST_RATE of the others, later ones fewer
    bits = max(counts[0] * -log(FIRST_RATE), counts[1] * 2 * FIRST_RATE * -log(RATE)) / log(2) ** 2
    shards = max(1, ceil(bits / max_bits))
    rule, ruled = matching_rule()
    parts = []
    for s in range(shards):
        own = F.pmod(F.xxhash64(F.lit("shard"), "key"), F.lit(shards)) == s
        mine = F.pmod(F.xxhash64(F.lit("shard"), "host"), F.lit(shards)) == s
        levels = build_cascade(keys.where(own) if shards > 1 else keys)
        part = rows.where(mine) if shards > 1 else rows
        parts.append(part.withColumn("listed", listed_column(levels, F.col("host"))))
    return (reduce(DataFrame.unionByName, parts)
            .select("page_id", "host", "path", rule.alias("rule"),
                    F.coalesce(ruled, F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"),
                    "listed"))


def host_is_listed() -> Column:
    """A host is listed if a listed word is a part of its name, parts being divided by dots and hyphens."""
    return F.arrays_overlap(F.split("key", "[.-]"), F.array(*map(F.lit, LISTED_WORDS)))
