"""Mixing sources to target weights by Poisson replication.

Every document is repeated ``k`` times, where ``k`` comes from inverting a
Poisson distribution whose mean is its source's repetition rate

    rate(source) = total * weight(source) / size(source)

at a uniform number hashed from the seed and the document's id.  A large rate
is split into equal pieces, and ``k`` is the sum of their independent counts,
which has the same distribution.  The decision
of one document depends on no other document, so a rerun, a lost executor or
another partitioning gives the same mix.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, table

#: Fixed share of the one large source; the others share the rest evenly.
DEFAULT_WEIGHTS = {"src0": 0.10}
SEED = 20240229
#: Poisson terms kept per source beyond the mean: mean + 12 deviations + 20.
TAIL_SD, TAIL_MIN = 12.0, 20
#: From the first rate on exp(-rate) nears underflow: pieces of at most the second.
LARGE, PIECE = 700.0, 500.0
#: Copies of a row that are listed at once.
BLOCK = 4096


def unit_hash(seed: int, *keys: Column) -> Column:
    """Uniform in [0, 1): 52 bits of the MD5 of the seed and the keys."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(k.cast("string"), F.lit("")) for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def source_rates(sizes: DataFrame, weights: Mapping[str, float], total: float | None) -> DataFrame:
    """``source, rate, pieces, cdf`` from ``source, size``: one row per source.

    Sources without a weight share what the given weights leave, evenly. Given
    weights of sources that are absent count as nothing; weights are scaled to
    a sum of 1. A source of size 0 has rate 0. ``cdf`` holds the cumulative
    Poisson probabilities of 0, 1, 2, ... repetitions at one of ``pieces``
    equal parts of the rate; there is one part below ``LARGE``.
    """
    given = F.lit(None).cast("double")
    for name, w in sorted(weights.items()):
        given = F.when(F.col("source") == name, F.lit(float(w))).otherwise(given)
    left = max(0.0, 1.0 - sum(weights.values()))
    sums = sizes.withColumn("given", given).agg(
        F.sum("given").alias("w"),
        F.sum(F.col("given").isNull().cast("int")).alias("free"),
        F.sum("size").alias("all"),
    )
    s = lambda c: sums.select(c).scalar()
    share = F.when(s("free") > 0, F.lit(left) / s("free")).otherwise(0.0)
    w = F.coalesce(given, share) / (F.coalesce(s("w"), F.lit(0.0)) + F.when(s("free") > 0, F.lit(left)).otherwise(0.0))
    want = F.lit(float(total)) if total is not None else s("all").cast("double")
    rate = F.when(F.col("size") > 0, want * w / F.col("size")).otherwise(0.0)
    out = sizes.withColumn("rate", F.coalesce(rate, F.lit(0.0)))
    out = out.withColumn("pieces", F.when(F.col("rate") < LARGE, F.lit(1).cast("long")).otherwise(F.ceil(F.col("rate") / PIECE)))
    out = out.withColumn("part", F.col("rate") / F.col("pieces"))
    steps = F.sequence(F.lit(1), (F.col("part") + TAIL_SD * F.sqrt("part") + TAIL_MIN).cast("int"))
    start = F.struct(F.exp(-F.col("part")).alias("p"), F.array(F.exp(-F.col("part"))).alias("c"))
    cdf = F.aggregate(
        steps,
        start,
        lambda a, i: F.struct(
            (a["p"] * F.col("part") / i).alias("p"),
            F.concat(a["c"], F.array(F.element_at(a["c"], -1) + a["p"] * F.col("part") / i)).alias("c"),
        ),
        lambda a: a["c"],
    )
    return out.select("source", "rate", "pieces", cdf.alias("cdf"))


def replicate(
    docs: DataFrame,
    weights: Mapping[str, float] = DEFAULT_WEIGHTS,
    *,
    id_col: str = "doc_id",
    source_col: str = "source",
    size: Column | None = None,
    total: float | None = None,
    seed: int = SEED,
    below: float | None = LARGE,
) -> DataFrame:
    """All columns of ``docs`` plus ``copy`` (from 0) and ``mix_key``, in
    globally shuffled order: ranges of the hashed ``mix_key`` over partitions,
    sorted inside each.

    ``size`` measures a document (default: 1, so weights are shares of
    documents); ``total`` is the size of the mix (default: that of the input).
    Sizes are summed over all documents. A null source is a source of its own;
    null ids hash as empty. Rows that repeat an id are repeated alike. Input
    columns named like the two new ones, or with the operator's internal
    prefix, are replaced. Rates from ``below`` on are refused, so that a call
    with a mistaken ``total`` fails; with None, as in the query and the stage,
    none is. A row's copies are numbered by an int, which its count must fit.

    The rates are one row per source; Spark broadcasts them only if their
    measured size is under its own threshold and otherwise joins by shuffle,
    where the adaptive skew join splits a hot source.
    """
    src = F.col(f"`{source_col}`")
    one = size if size is not None else F.lit(1)
    sizes = docs.select(src.alias("source"), one.cast("double").alias("size")).groupBy("source").agg(F.sum("size").alias("size"))
    rates = source_rates(sizes, weights, total)
    cdf = F.col("cdf") if below is None else F.when(F.col("rate") < below, F.col("cdf")).otherwise(F.raise_error(f"repetition rate of {below:g} or more"))
    rates = rates.select(F.col("source").alias("__mix_source"), F.col("pieces").alias("__mix_pieces"), cdf.alias("__mix_cdf"))
    rates = stored(rates, "rates")  # a known size: the join can be planned without moving texts first
    base = docs.drop("copy", "mix_key")
    id_ = F.col(f"`{id_col}`")
    counted = base.join(rates, src.eqNullSafe(F.col("__mix_source")))
    # the hash is bound to a lambda variable so that it is computed once a piece
    count = lambda *keys: F.transform(F.array(unit_hash(seed, *keys)), lambda u: F.size(F.filter("__mix_cdf", lambda c: c <= u)))[0].cast("long")
    more = F.aggregate(F.sequence(F.lit(1).cast("long"), F.col("__mix_pieces") - 1), F.lit(0).cast("long"), lambda a, i: a + count(id_, i))
    n = F.when(F.col("__mix_pieces") > 1, count(id_) + more).otherwise(count(id_))
    kept = [F.col(f"`{c}`") for c in base.columns]
    # blocks of copies, so that no row lists all of very many at once
    blocks = F.when(F.col("__mix_n") > 0, F.sequence(F.lit(0).cast("long"), F.floor((F.col("__mix_n") - 1) / BLOCK)))
    copies = F.sequence(F.col("__mix_block") * BLOCK, F.least(F.col("__mix_n"), (F.col("__mix_block") + 1) * BLOCK) - 1)
    out = counted.select(*kept, n.alias("__mix_n"))
    out = out.select(*kept, "__mix_n", F.explode(blocks).alias("__mix_block")).select(*kept, F.explode(copies).alias("copy"))
    out = out.withColumn("copy", F.col("copy").cast("int"))
    key = F.xxhash64(F.lit(seed), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")), F.col("copy"))
    return out.withColumn("mix_key", key)


def shuffled(mixed: DataFrame, *ties: str) -> DataFrame:
    """A global random permutation: rows go to partitions by a hash of the
    hashed key and are ordered by it there, without the sampling pass of a
    range sort. All copies of a row have keys of their own, so no key is hot."""
    return mixed.repartition("mix_key").sortWithinPartitions("mix_key", *ties)


def op10_mix_sources(spark, sf_dir: str) -> DataFrame:
    """Every whole document, repeated to the default weights by characters."""
    docs = table(spark, sf_dir, "documents")
    mixed = replicate(docs, size=F.length(F.coalesce("text", F.lit(""))), below=None)
    return shuffled(mixed, "doc_id", "copy").drop("mix_key")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the mix, with the columns of its input."""
    mixed = replicate(docs, size=F.length(F.coalesce("text", F.lit(""))), below=None)
    return shuffled(mixed, "doc_id", "copy").select(docs.columns)


ORACLE = """
WITH sizes AS (
  SELECT source, sum(CAST(length(coalesce(text, '')) AS DOUBLE)) AS size FROM documents GROUP BY source
), given AS (
  SELECT *, CASE WHEN source = 'src0' THEN CAST(0.1 AS DOUBLE) END AS g FROM sizes
), tot AS (
  SELECT sum(g) AS w, count(*) FILTER (g IS NULL) AS free, sum(size) AS total FROM given
), rates AS (
  SELECT source, CASE WHEN size > 0 THEN total * (coalesce(g, CASE WHEN free > 0 THEN 0.9::DOUBLE / free ELSE 0 END)
      / (coalesce(w, 0) + CASE WHEN free > 0 THEN 0.9::DOUBLE ELSE 0 END)) / size ELSE 0 END AS rate
  FROM given, tot
), terms AS (
  SELECT source, rate, i, CASE WHEN i = 0 THEN exp(-rate) ELSE exp(-rate + i * ln(rate) - lgamma(i + 1)) END AS p
  FROM rates, range(0, 400) r(i) WHERE i <= rate + 12 * sqrt(rate) + 20
), cdf AS (
  SELECT source, i, sum(p) OVER (PARTITION BY source ORDER BY i) AS c FROM terms
), counted AS (
  SELECT d.*, (SELECT count(*) FROM cdf WHERE cdf.source IS NOT DISTINCT FROM d.source AND cdf.c <=
      CAST(CAST('0x' || substr(md5('20240229|' || CAST(doc_id AS VARCHAR)), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0) AS n
  FROM documents d
)
SELECT doc_id, text, lang, source, n_chars, CAST(k AS INTEGER) AS copy
FROM (SELECT *, unnest(range(0, n)) AS k FROM counted)
"""
