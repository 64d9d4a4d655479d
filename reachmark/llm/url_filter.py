"""URL filters by cascades of Bloom filters."""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reachmark.llm.common import ascii_lower, free_name
from reachmark.runtime import materialize

#: Between host and path of a key; neither part of a url holds it.
MARK = "#"
#: Bits of all levels of a cascade that a plan may carry to the executors.
MAX_FILTER_BYTES = 4 << 20
ACTIONS = ("block", "allow")


@dataclass(frozen=True)
class Level:
    """One Bloom filter: ``bits`` cells in 64-bit ``words``, ``hashes`` cells per key."""

    seed: int
    bits: int
    hashes: int
    words: tuple[int, ...]

    def cells(self, key: Column) -> Column:
        return _cells(key, self.seed, self.bits, self.hashes)

    def passes(self, key: Column) -> Column:
        # a constant: folded to an array once, when the plan is optimised
        words = F.from_json(F.lit(json.dumps(self.words)), "array<bigint>")
        bit = lambda p: F.getbit(F.get(words, F.shiftright(p, 6).cast("int")), F.pmod(p, F.lit(64)).cast("int")) == 1
        if self.hashes == 1:
            return bit(_cell(key, self.seed, self.bits, 0))
        return F.forall(self.cells(key), bit)


def _cell(key: Column, seed: int, bits: int, i) -> Column:
    # double hashing: cell i is h1 + i * h2
    h1 = F.pmod(F.xxhash64(F.lit(2 * seed), key), F.lit(bits))
    h2 = F.pmod(F.xxhash64(F.lit(2 * seed + 1), key), F.lit(bits))
    return F.pmod(h1 + h2 * i, F.lit(bits))


def _cells(key: Column, seed: int, bits: int, hashes: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(hashes - 1)), lambda i: _cell(key, seed, bits, i))


def _shape(listed: int, others: int, first: bool) -> tuple[int, int]:
    """Cells and hashes for ``listed`` keys, with the rate that makes the whole cascade smallest."""
    rate = min(0.5, math.sqrt(0.5) * listed / max(others, 1)) if first else 0.5
    hashes = max(1, round(-math.log2(rate)))
    return 64 * math.ceil(listed * hashes / math.log(2) / 64), hashes


def build_cascade(universe: DataFrame, key: str, listed: Column, max_bytes: int = MAX_FILTER_BYTES) -> list[Level] | None:
    """Levels that tell exactly which keys of ``universe`` are ``listed``.

    Level 0 holds the listed keys, level 1 those others that pass level 0, level 2 the
    listed ones that pass level 1, and so on until nothing wrong passes. None if the levels
    would exceed ``max_bytes``. ``universe`` has distinct keys and should be stored, as each
    level reads it. No listed key: no level.
    """
    k = F.col(key)
    count = universe.agg(F.count_if(listed).alias("a"), F.count_if(~listed).alias("b")).first()
    sides, sizes = [listed, ~listed], [count["a"], count["b"]]
    levels: list[Level] = []
    include, used = 0, 0
    while sizes[include]:
        bits, hashes = _shape(sizes[include], sizes[1 - include], not levels)
        used += bits // 8
        if used > max_bytes:
            return None
        cell = universe.where(sides[include]).select(F.explode(_cells(k, len(levels), bits, hashes)).alias("p"))
        found = (
            cell.groupBy(F.shiftright("p", 6).alias("w"))
            .agg(F.expr("bit_or(shiftleft(1L, cast(p % 64 as int)))").alias("x"))
            .collect()  # at most bits / 64 rows
        )
        words = [0] * (bits // 64)
        for row in found:
            words[row["w"]] = row["x"]
        levels.append(Level(len(levels), bits, hashes, tuple(words)))
        include = 1 - include
        sides[include] = sides[include] & levels[-1].passes(k)
        sizes[include] = universe.where(sides[include]).count()
    return levels


def contains(levels: list[Level], key: Column, at: int = 0) -> Column:
    """Whether ``key``, one of the universe, is listed: the first level that stops it decides."""
    if at == len(levels):
        return F.lit(at % 2 == 1)
    rest = contains(levels, key, at + 1)
    passed = levels[at].passes(key)
    return (passed & rest) if at % 2 == 0 else (~passed | rest)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    start = F.locate("://", url)
    rest = F.when(start > 0, F.substring(url, start + 3, F.length(url)))
    host = ascii_lower(F.regexp_extract(rest, "^([^/?#]*)", 1))
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))


def candidate_keys(host: Column, path: Column, labels: int, lengths: list[int]) -> Column:
    """All keys a rule for this url can have, longest first: domains of at most ``labels``
    labels times path starts of the given ``lengths``."""
    parts = F.split(host, "\\.")
    n = F.least(F.size(parts), F.lit(labels))
    domains = F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(parts, -i, i), "."))
    domains = F.filter(domains, lambda d: d != "")

    def keys(size: int) -> Column:
        one = F.transform(domains, lambda d: F.concat(d, F.lit(MARK), F.substring(path, 1, size)))
        return F.when(F.length(path) >= size, one).otherwise(F.array().cast("array<string>"))

    every = F.flatten(F.array(*[keys(n) for n in lengths])) if lengths else F.array().cast("array<string>")
    order = F.transform(every, lambda k: F.struct((-F.length(k)).alias("n"), (-F.locate(MARK, k)).alias("h"), k.alias("k")))
    return F.transform(F.array_sort(F.array_distinct(order)), lambda s: s["k"])


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    url: str = "url",
    default: str = "allow",
    max_bytes: int = MAX_FILTER_BYTES,
) -> DataFrame:
    """``pages`` with ``url_host, url_path, url_rule, url_verdict``.

    ``rules`` has ``host, path, action`` (block or allow). A rule fits its host and all
    subdomains if the path starts with the rule's; the longest host + path wins, then the
    longer host. A rule both allowed and blocked blocks. Without a rule the verdict is
    ``default``, as it is for null and malformed urls, which have an empty host and path.
    Rules without a host or with another action are left out, repeated ones count once.

    All keys that any url can match form the universe, and one cascade per action tells which
    of them are listed, so every url is judged by itself: no join, and the plan carries only
    the filters' bits. Rule lists whose filters exceed ``max_bytes`` are joined instead, with
    the same result. Rows and other columns stay; the four names must be free.
    """
    clean = rules.select(
        ascii_lower(F.col("host")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), F.col("action").alias("action")
    ).where(F.col("action").isin(*ACTIONS) & (F.coalesce("host", F.lit("")) != ""))
    shape = clean.agg(
        F.coalesce(F.max(F.size(F.split("host", "\\."))), F.lit(1)).alias("labels"),
        F.collect_set(F.length("path")).alias("lengths"),
    ).first()
    if taken := {"url_host", "url_path", "url_rule", "url_verdict"} & {c.lower() for c in pages.columns}:
        raise ValueError(f"pages already has {', '.join(sorted(taken))}")
    host, path = url_parts(F.col(f"`{url}`"))
    split = pages.withColumns({"url_host": host, "url_path": path})
    keys = candidate_keys(F.col("url_host"), F.col("url_path"), shape["labels"], sorted(shape["lengths"]))
    listed = clean.select(
        F.concat("host", F.lit(MARK), "path").alias("k"), *[(F.col("action") == a).alias(a) for a in ACTIONS]
    )
    seen = split.select(F.explode(keys).alias("k")).select("k", *[F.lit(False).alias(a) for a in ACTIONS])
    universe = materialize(
        seen.unionByName(listed).groupBy("k").agg(*[F.max(a).alias(a) for a in ACTIONS]), "urlkeys"
    )
    cascades = {a: build_cascade(universe, "k", F.col(a), max_bytes) for a in ACTIONS}
    if any(c is None for c in cascades.values()):
        return _judge_by_join(split, keys, universe.where(" or ".join(ACTIONS)), default)
    member = lambda a, k: contains(cascades[a], k)
    hit = F.get(F.filter(keys, lambda k: member("block", k) | member("allow", k)), F.lit(0))
    ruled = split.withColumn("url_rule", hit)
    r = F.col("url_rule")
    verdict = F.when(r.isNull(), F.lit(default)).when(member("block", r), F.lit("block")).otherwise(F.lit("allow"))
    return ruled.withColumn("url_verdict", verdict).withColumn("url_rule", F.translate(r, MARK, ""))


def _judge_by_join(split: DataFrame, keys: Column, listed: DataFrame, default: str) -> DataFrame:
    columns = split.columns
    row, best = free_name(split, "_row"), free_name(split, "_best")
    rows = materialize(split.withColumn(row, F.monotonically_increasing_id()), "urls")
    tried = rows.select(row, F.posexplode(keys).alias("_at", "k"))
    found = tried.join(listed, "k").groupBy(row).agg(F.min_by(F.struct("k", "block"), "_at").alias(best))
    verdict = F.when(F.col(best).isNull(), F.lit(default)).when(F.col(f"{best}.block"), "block").otherwise("allow")
    rule = F.translate(F.col(f"{best}.k"), MARK, "").alias("url_rule")
    return rows.join(found, row, "left").select(*[f"`{c}`" for c in columns], rule, verdict.alias("url_verdict"))
