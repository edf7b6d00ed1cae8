"""URL filters by cascades of Bloom filters.

A cascade answers exactly, for every key of a known universe, whether the key
is listed.  Level 1 encodes the listed keys; level 2 the keys of the universe
that level 1 lets through wrongly; level 3 the listed keys that level 2 lets
through wrongly; and so on until a level errs no more.  Membership is then a
pure column expression over a few constant bit arrays: no join.

Everything here is DataFrame operations.  A level's size follows the number of
listed keys and the logarithm of the universe's size; it is checked against
``max_bits``.  Beyond it, keys are dealt by hash into shards with a cascade of
their own, whose bit arrays are rows of a table (``Sharded``).
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop_stored, stored, table

MAX_BITS = 1 << 24
SEED = 7919


def _bit(words: Column, at: Column) -> Column:
    """Whether the bit at a position is set; the shift is by a column."""
    word = F.get(words, F.shiftright(at, 6).cast("int"))
    return F.call_function("shiftrightunsigned", word, at.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1)) == 1


def _set_bits(keys: DataFrame, by: list[str], level: int, bits: int, hashes: int) -> DataFrame:
    """``by``, word number ``w`` and word ``b`` of the filter of ``key``."""
    at = keys.select(*by, F.explode(F.array(*_positions(F.col("key"), level, bits, hashes))).alias("p"))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("p").bitwiseAND(F.lit(63)).cast("int"))
    return at.groupBy(*by, F.shiftright("p", 6).alias("w")).agg(F.bit_or(one).alias("b"))


def _sizes(n: int, error: float) -> tuple[int, int]:
    """Bits and hashes of a filter of ``n`` keys at the given false-positive rate."""
    bits = max(64, 64 * math.ceil(n * -math.log(error) / math.log(2) ** 2 / 64))
    hashes = max(1, round(bits / max(n, 1) * math.log(2))) if bits > 64 else max(1, min(8, round(-math.log2(error))))
    return bits, min(hashes, 30)


def _positions(key: Column, level: int, bits: int, hashes: int) -> list[Column]:
    """Bit positions of a key in a level: double hashing, seeded by level."""
    a = F.xxhash64(F.lit(SEED + 2 * level), key)
    b = F.xxhash64(F.lit(SEED + 2 * level + 1), key).bitwiseOR(F.lit(1))
    mask = F.lit((1 << 40) - 1)
    return [F.pmod(a.bitwiseAND(mask) + F.lit(j) * b.bitwiseAND(mask), F.lit(bits)) for j in range(hashes)]


@dataclass(frozen=True)
class Level:
    """One Bloom filter: 64-bit words, as many hashes as its error asks for."""

    number: int
    bits: int
    hashes: int
    words: tuple[int, ...]

    def test(self, key: Column) -> Column:
        words = F.from_json(F.lit(json.dumps(self.words)), "array<bigint>")  # folded to a constant, once a level
        return F.forall(F.array(*_positions(key, self.number, self.bits, self.hashes)), lambda p: _bit(words, p))


def _level(keys: DataFrame, n: int, error: float, number: int) -> Level:
    """The filter of ``n`` keys at the given false-positive rate."""
    bits, hashes = _sizes(n, error)
    words = [0] * (bits // 64)
    for row in _set_bits(keys, [], number, bits, hashes).collect():  # at most bits / 64 rows, checked against max_bits
        words[row["w"]] = row["b"]
    return Level(number, bits, hashes, tuple(words))


@dataclass
class Cascade:
    """Exact membership for all keys of the universe it was built over."""

    levels: list[Level] = field(default_factory=list)

    def contains(self, key: Column) -> Column:
        """Null keys are not listed."""
        out = F.lit(False)
        for level in reversed(self.levels):
            out = level.test(key) & ~out
        return F.coalesce(out, F.lit(False))

    @property
    def bits(self) -> int:
        return sum(x.bits for x in self.levels)


class TooLarge(ValueError):
    """A level would exceed ``max_bits``."""


def build(listed: DataFrame, universe: DataFrame, *, max_bits: int = MAX_BITS) -> Cascade:
    """The cascade of the ``key`` column of ``listed`` over that of ``universe``.

    The universe may hold listed keys, repeated keys and nulls. It is read
    twice, without a shuffle of its rows: once for an approximate count that
    only sizes level 1, once for the false positives of level 1. Later levels
    read only the wrongly passed keys, which shrink geometrically.
    """
    listed = stored(listed.select("key").where("key is not null").distinct(), "listed")
    n = listed.count()
    if n == 0:
        return Cascade()
    others = max(1, universe.agg(F.approx_count_distinct("key")).first()[0])
    error = min(0.5, max(1e-9, n * math.sqrt(0.5) / others))
    cascade, mine, theirs = Cascade(), listed, None
    while n:
        if n * -math.log(error) / math.log(2) ** 2 > max_bits:
            raise TooLarge(f"level {len(cascade.levels) + 1} of {n} keys needs more than {max_bits} bits")
        level = _level(mine, n, error, len(cascade.levels) + 1)
        cascade.levels.append(level)
        if theirs is None:  # level 1 meets the universe
            wrong = universe.select("key").where(F.col("key").isNotNull() & level.test(F.col("key"))).distinct().join(listed, "key", "left_anti")
        else:
            wrong = theirs.where(level.test(F.col("key")))
        # the next level encodes what this one passes wrongly, and is tested on what this one encodes
        wrong = stored(wrong, "wrong")
        if theirs is not None:
            drop_stored(theirs)
        mine, theirs, n, error = wrong, mine, wrong.count(), 0.5
    return cascade


@dataclass
class Sharded:
    """A cascade for each of ``shards`` hash ranges of the keys. ``levels``
    holds of each level its bits, hashes and a stored table ``shard, words``."""

    shards: int
    levels: list[tuple[int, int, DataFrame]] = field(default_factory=list)

    def shard(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(F.lit(SEED - 1), key), F.lit(self.shards)).cast("int")

    def passed(self, keys: DataFrame, k: int) -> DataFrame:
        """The rows of ``keys`` (``key, shard``) that level ``k`` lets through."""
        bits, hashes, words = self.levels[k]
        test = F.lit(True)
        for p in _positions(F.col("key"), k + 1, bits, hashes):
            test = test & _bit(F.col("words"), p)
        return keys.join(words, "shard").where(test).select("key", "shard")

    def add(self, keys: DataFrame, error: float) -> None:
        spark, number = keys.sparkSession, len(self.levels) + 1
        most = keys.groupBy("shard").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
        bits, hashes = _sizes(most, error)
        size = bits // 64
        every = spark.range(self.shards * size).select((F.col("id") / size).cast("int").alias("shard"), F.pmod("id", F.lit(size)).alias("w"))
        full = every.join(_set_bits(keys, ["shard"], number, bits, hashes), ["shard", "w"], "left")
        ordered = F.sort_array(F.collect_list(F.struct("w", F.coalesce("b", F.lit(0).cast("long")).alias("b"))))  # of one shard, at most some max_bits
        self.levels.append((bits, hashes, stored(full.groupBy("shard").agg(F.transform(ordered, lambda x: x["b"]).alias("words")), "level")))

    def listed(self, keys: DataFrame) -> DataFrame:
        """The listed ones of ``keys`` (``key``, of the universe), each once."""
        now = keys.select("key").where("key is not null").distinct().withColumn("shard", self.shard(F.col("key")))
        now, out = stored(now, "keys"), None
        for k in range(len(self.levels)):
            nxt = stored(self.passed(now, k), "keys")
            if k % 2 == 0 and out is None:
                out = nxt
            elif k % 2:  # what an even level lets through is not listed, unless a later one says so
                out = out.join(nxt, "key", "left_anti")
            else:
                out = out.unionByName(nxt)
            now = nxt
        return out.select("key") if out is not None else now.select("key").limit(0)


def build_sharded(listed: DataFrame, universe: DataFrame, *, max_bits: int = MAX_BITS) -> Sharded:
    """As ``build``, for lists of any size: as many shards as keep a level's
    filter of one shard at about ``max_bits``."""
    listed = stored(listed.select("key").where("key is not null").distinct(), "listed")
    n = listed.count()
    others = max(1, universe.agg(F.approx_count_distinct("key")).first()[0])
    error = min(0.5, max(1e-9, n * math.sqrt(0.5) / others))
    out = Sharded(max(1, math.ceil(n * -math.log(error) / math.log(2) ** 2 / max_bits)))
    put = lambda df: df.select("key").withColumn("shard", out.shard(F.col("key")))
    mine, theirs = stored(put(listed), "keys"), None
    while n:
        out.add(mine, error)
        if theirs is None:
            theirs = put(universe.where("key is not null").distinct().join(listed, "key", "left_anti"))
        wrong = stored(out.passed(theirs, len(out.levels) - 1), "wrong")
        mine, theirs, n, error = wrong, mine, wrong.count(), 0.5
    return out


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; empty without ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    text = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(text, pattern, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(text, pattern, 2)


def suffixes(host: Column) -> Column:
    """The host and all domains above it, longest first."""
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def rule_keys(host: Column, path: Column, lengths: Sequence[int]) -> Column:
    """Every (domain, path prefix) that a rule for this url could name, longest
    first, as ``domain + "\\n" + prefix``: prefixes only of lengths that rules have."""
    cuts = F.filter(F.array(*[F.lit(n) for n in sorted(set(lengths), reverse=True)]), lambda n: n <= F.length(path))
    keys = F.flatten(F.transform(suffixes(host), lambda h: F.transform(cuts, lambda n: F.concat(h, F.lit("\n"), F.substring(path, 1, n)))))
    at = lambda k: F.instr(k, "\n")
    return F.array_sort(keys, lambda a, b: F.when(F.length(a) != F.length(b), F.length(b) - F.length(a)).otherwise(at(b) - at(a)))


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def key(self) -> str:
        return f"{self.host}\n{self.path}"


#: Fixed rules of the production query.
RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)
#: Listed sites of the production query: each of these below example.com, .net and .org.
LISTED = tuple(f"{name}.example.{top}" for name in ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm") for top in ("com", "net", "org"))


def judge(pages: DataFrame, rules: Sequence[Rule], listed: DataFrame, *, url_col: str = "url", max_bits: int = MAX_BITS) -> DataFrame:
    """``pages`` with ``host, path, rule, verdict``.

    A rule fits its host and all subdomains if the path starts with the rule's;
    of fitting rules the longest (host and path together) wins, of equally long
    ones that with the longer host; of two rules with one host and path, block
    wins. A url that no rule fits is blocked if
    its host, or a domain above it, is among ``listed`` (column ``key``), else
    allowed. Null urls and urls without ``://`` have an empty host and path.
    Input columns with the four names are replaced; all rows stay.
    """
    host, path = host_path(F.col(f"`{url_col}`"))
    names = ("host", "path", "rule", "verdict")
    base = pages.drop(*[n for n in names if n != url_col])
    rows = base.withColumns({"__uf_host": host, "__uf_path": path})
    lengths = [len(r.path) for r in rules] or [0]
    spark = pages.sparkSession
    parts = pages.select(host.alias("host"), path.alias("path")).groupBy("host", "path").count()
    parts = stored(parts.select("host", "path"), "urls")  # distinct urls, once; both universes come from it
    universe = parts.select(F.explode(rule_keys(F.col("host"), F.col("path"), lengths)).alias("key"))
    hosts = parts.select("host").distinct().select(F.explode(suffixes(F.col("host"))).alias("key"))

    def cascade(keys, over):
        return build(spark.createDataFrame([(k,) for k in keys], "key string"), over, max_bits=max_bits)

    blocked = {r.key for r in rules if r.verdict == "block"}
    allowed = {r.key for r in rules} - blocked
    try:
        block, allow = cascade(sorted(blocked), universe), cascade(sorted(allowed), universe)
        keys = rule_keys(F.col("__uf_host"), F.col("__uf_path"), lengths)
        fits = F.filter(
            F.transform(keys, lambda k: F.struct(k.alias("k"), block.contains(k).alias("b"), allow.contains(k).alias("a"))),
            lambda x: x["a"] | x["b"],
        )
        rows = rows.withColumn("__uf_fit", F.get(fits, F.lit(0)))
    except TooLarge:  # over the distinct urls, by sharded cascades
        asked = parts.select("host", "path", F.posexplode(rule_keys(F.col("host"), F.col("path"), lengths)).alias("place", "key"))
        found = None
        for names_of, flag in ((blocked, True), (allowed, False)):
            some = spark.createDataFrame([(k,) for k in sorted(names_of)], "key string")
            hit = build_sharded(some, universe, max_bits=max_bits).listed(universe).withColumn("b", F.lit(flag))
            found = hit if found is None else found.unionByName(hit)
        fit = asked.join(stored(found, "rules"), "key").groupBy("host", "path").agg(F.min_by(F.struct(F.col("key").alias("k"), "b"), "place").alias("__uf_fit"))
        fit = stored(fit, "fits").withColumnsRenamed({"host": "__uf_host", "path": "__uf_path"})
        rows = rows.join(fit, ["__uf_host", "__uf_path"], "left")
    try:
        sites = build(listed, hosts, max_bits=max_bits)
        rows = rows.withColumn("__uf_listed", F.exists(suffixes(F.col("__uf_host")), sites.contains))
    except TooLarge:
        hit = stored(build_sharded(listed, hosts, max_bits=max_bits).listed(hosts), "sites")
        asked = parts.select("host").distinct().select("host", F.explode(suffixes(F.col("host"))).alias("key"))
        hit = stored(asked.join(hit, "key", "left_semi").select(F.col("host").alias("__uf_host")).distinct().withColumn("__uf_hit", F.lit(True)), "hosts")
        rows = rows.join(hit, "__uf_host", "left").withColumn("__uf_listed", F.coalesce("__uf_hit", F.lit(False))).drop("__uf_hit")
    fit = F.col("__uf_fit")
    verdict = F.when(fit.isNotNull(), F.when(fit["b"], "block").otherwise("allow")).when(F.col("__uf_listed"), "block").otherwise("allow")
    kept = [F.col(f"`{c}`") for c in base.columns if c not in names]
    return rows.select(
        *kept,
        F.col("__uf_host").alias("host"),
        F.col("__uf_path").alias("path"),
        F.regexp_replace(fit["k"], "\n", "").alias("rule"),
        verdict.alias("verdict"),
    )


def op2_url_filter(spark, sf_dir: str) -> DataFrame:
    """The verdict on the url of every page."""
    listed = spark.createDataFrame([(k,) for k in LISTED], "key string")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages, RULES, listed).select("page_id", "host", "path", "rule", "verdict")


_SQL_RULES = ", ".join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in RULES)
_SQL_LISTED = ", ".join(f"('{k}')" for k in LISTED)
ORACLE = f"""
WITH rules(v, h, p) AS (VALUES {_SQL_RULES}), listed(k) AS (VALUES {_SQL_LISTED}),
parts AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages
), judged AS (
  SELECT *,
    (SELECT h || p FROM rules WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) ORDER BY length(h || p) DESC, length(h) DESC LIMIT 1) AS rule,
    (SELECT v FROM rules WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) ORDER BY length(h || p) DESC, length(h) DESC LIMIT 1) AS v,
    EXISTS (SELECT 1 FROM listed WHERE host = k OR ends_with(host, '.' || k)) AS bad
  FROM parts
)
SELECT page_id, host, path, rule, coalesce(v, CASE WHEN bad THEN 'block' ELSE 'allow' END) AS verdict FROM judged
"""
