"""Quality rules: fixed rules on text statistics, then robust outliers.

Statistics of a text become a short vector; per language and source, minimum
covariance determinant (MCD) estimates of its centre and scatter are found by
concentration steps, and documents far away in Mahalanobis distance go.

DataFrame operations only.  Texts are read once; the statistics are written to
the shared folder, and every step after that is an aggregation of a few numbers
per row by group, combined map-side, so a group of a third of all rows is no
large task.  What a step hands on is one row per group.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import drop_stored, stored, table, whole_text

WORD = r"[^\x20\x09-\x0D]+"
WINDOW = 5
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "base_failed")
#: Base rule: fewest words, and largest percentage of words in repeated windows.
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20
#: Groups with fewer documents join their language's other small groups; below
#: that, too, nothing is rejected.
MIN_GROUP = 50
#: Share of a group in the half sample, concentration steps, and the squared
#: distance's chi-square tail beyond which a document goes.
SUPPORT, STEPS, TAIL = 0.75, 4, 1e-12
VECTOR = ("word_length", "symbols", "dup_lines", "repeats")
#: Least standard deviation of each coordinate: spreads below it are noise.
FLOOR = (0.02, 0.04, 0.06, 0.06)
P = len(VECTOR)
#: Groups up to which their one row each (some 150 bytes) is broadcast; beyond,
#: rows meet it by shuffle, a group's rows in as many parts as there are salts.
BROADCAST_GROUPS, SALTS = 20_000, 64
#: Grid for medians, and bins per unit of the log distance.
GRID, BINS = 256, 32


def statistics(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """``docs`` without the text, with ``n_words, word_chars, n_symbols,
    n_lines, n_dup_lines, n_repeat_words`` (long) and ``base_failed``.

    Null texts are empty. Windows of five words are compared by a 64-bit hash
    inside one text. Input columns with these names are replaced.
    """
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in STATISTICS and c != text_col]
    t = F.col("__t")
    rows = docs.select(*rest, whole_text(f"`{text_col}`").alias("__t"))
    hashes = F.transform(F.regexp_extract_all(t, F.lit(WORD), F.lit(0)), lambda w: F.xxhash64(w))
    lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.select(
        *rest,
        hashes.alias("__w"),
        lines.alias("__lines"),
        (F.length(t) - F.regexp_count(t, F.lit(r"[\x20\x09-\x0D]"))).cast("long").alias("word_chars"),
        F.regexp_count(t, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
    )
    n, w = F.size("__w"), F.col("__w")
    windows = F.when(n > WINDOW, F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)])))
    rows = rows.select(
        *rest, "word_chars", "n_symbols",
        n.cast("long").alias("n_words"),
        F.size("__lines").cast("long").alias("n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        windows.alias("__g"),
    )
    # only texts in which some window repeats are sorted
    again = F.col("__g").isNotNull() & (F.size(F.array_distinct("__g")) < F.size("__g"))
    ordered = F.when(again, F.sort_array(F.transform("__g", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    rows = rows.withColumn("__s", ordered).drop("__g")
    s = F.col("__s")
    same = lambda x, at: F.coalesce(F.get(s, at)["h"] == x["h"], F.lit(False))
    repeated = F.filter(s, lambda x, k: same(x, k - 1) | same(x, k + 1))
    places = F.sort_array(F.transform(repeated, lambda x: x["i"]))
    covered = F.aggregate(
        places,
        F.struct(F.lit(0).alias("to"), F.lit(0).alias("n")),
        lambda a, p: F.struct((p + WINDOW).alias("to"), (a["n"] + p + WINDOW - F.greatest(a["to"], p)).alias("n")),
        lambda a: a["n"],
    )
    rows = rows.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("__s")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return rows.withColumn("base_failed", failed)


def vector() -> list[Column]:
    """The transformed statistics: a smoothed log word length and square roots
    of smoothed shares, so that short texts vary no more than long ones."""
    return [
        F.log((F.col("word_chars") + 250.0) / (F.col("n_words") + 50.0)).alias("x0"),
        F.sqrt(F.col("n_symbols") / (F.col("word_chars") + 200.0)).alias("x1"),
        F.sqrt(F.col("n_dup_lines") / (F.col("n_lines") + 10.0)).alias("x2"),
        F.sqrt(F.col("n_repeat_words") / (F.col("n_words") + 100.0)).alias("x3"),
    ]


def chi2_tail(x: float, dof: int) -> float:
    """Upper tail of chi-square with an even number of degrees of freedom."""
    half, term, total = x / 2, 1.0, 1.0
    for i in range(1, dof // 2):
        term *= half / i
        total += term
    return math.exp(-half) * total


def chi2_point(tail: float, dof: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_tail(mid, dof) > tail else (low, mid)
    return low


def consistency(share: float, dof: int = P) -> float:
    """What scales the scatter of a normal sample's inner share to its own."""
    return share / (1 - chi2_tail(chi2_point(1 - share, dof), dof + 2))


def _key(*columns: str) -> Column:
    """Text that tells apart all values of the columns, nulls included."""
    part = lambda c: F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), F.col(c)), F.lit("-"))
    return F.concat_ws(",", *[part(c) for c in columns])


def with_groups(rows: DataFrame, params: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """``rows`` joined with ``params``, a stored table of one row per group, so
    that no task gets a whole group: neither by the join, nor by an aggregation
    that would take over its partitioning."""
    if params.count() <= BROADCAST_GROUPS:
        return rows.join(F.broadcast(params), on, how)
    salted = rows.withColumn("__salt", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]), F.lit(SALTS)).cast("int"))
    spread = params.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(spread, [*on, "__salt"], how).drop("__salt")


def grouped(stats: DataFrame, lang_col: str, source_col: str) -> DataFrame:
    """``stats`` with vector and group ``k`` (null where nothing is judged)."""
    own = stats.select("*", *vector(), _key(lang_col, source_col).alias("__own"), _key(lang_col).alias("__lang"))
    sizes = own.groupBy("__own", "__lang").agg(F.count("*").alias("n"))
    sizes = sizes.withColumn("k", F.when(F.col("n") >= MIN_GROUP, F.col("__own")))
    pooled = sizes.where("k is null").groupBy("__lang").agg(F.sum("n").alias("m"))
    keys = sizes.join(pooled, "__lang", "left").select(
        "__own", F.coalesce("k", F.when(F.col("m") >= MIN_GROUP, F.concat(F.lit("*"), F.col("__lang")))).alias("k")
    )
    return with_groups(own, stored(keys, "groups"), ["__own"], "left").drop("__own", "__lang")


def _median(rows: DataFrame, value: Column) -> DataFrame:
    """Median of ``value`` per ``k`` and ``dim`` on a grid: exact counts of
    grid cells, so the outcome doesn't depend on how rows are spread."""
    cells = rows.select("k", "dim", F.floor(value * GRID).alias("cell")).groupBy("k", "dim", "cell").agg(F.count("*").alias("n"))
    w = Window.partitionBy("k", "dim").orderBy("cell")  # cells of a bounded range
    run = cells.select("k", "dim", "cell", F.sum("n").over(w).alias("upto"), F.sum("n").over(Window.partitionBy("k", "dim")).alias("all"))
    return run.where(2 * F.col("upto") >= F.col("all")).groupBy("k", "dim").agg(((F.min("cell") + 0.5) / GRID).alias("mid"))


def _moments(prefix: str = "x") -> list[Column]:
    """Sums around the current centre, from which mean and scatter follow."""
    d = [F.col(f"{prefix}{i}") - F.col(f"m{i}") for i in range(P)]
    out = [F.count("*").alias("n")] + [F.sum(d[i]).alias(f"s{i}") for i in range(P)]
    return out + [F.sum(d[i] * d[j]).alias(f"q{i}{j}") for i in range(P) for j in range(i + 1)]


def _solved(sums: DataFrame, keys: list[str], scale: float) -> DataFrame:
    """``keys, m*, v*, logdet``: the centre, the inverse Cholesky factor of the
    scatter (floors added to its diagonal) and half the log determinant."""
    n = F.col("n")
    cov = {(i, j): F.col(f"q{i}{j}") / n - F.col(f"s{i}") * F.col(f"s{j}") / (n * n) for i in range(P) for j in range(i + 1)}
    out = sums.select(
        *keys,
        *[(F.col(f"m{i}") + F.col(f"s{i}") / n).alias(f"m{i}") for i in range(P)],
        *[(scale * c + (FLOOR[i] ** 2 if i == j else 0.0)).alias(f"c{i}{j}") for (i, j), c in cov.items()],
    )
    for j in range(P):  # Cholesky, column by column
        below = sum((F.col(f"l{j}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))
        out = out.withColumn(f"l{j}{j}", F.sqrt(F.greatest(F.col(f"c{j}{j}") - below, F.lit(1e-12))))
        for i in range(j + 1, P):
            dot = sum((F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))
            out = out.withColumn(f"l{i}{j}", (F.col(f"c{i}{j}") - dot) / F.col(f"l{j}{j}"))
    for j in range(P):  # its inverse
        out = out.withColumn(f"v{j}{j}", 1.0 / F.col(f"l{j}{j}"))
        for i in range(j + 1, P):
            dot = sum((F.col(f"l{i}{k}") * F.col(f"v{k}{j}") for k in range(j, i)), F.lit(0.0))
            out = out.withColumn(f"v{i}{j}", -dot / F.col(f"l{i}{i}"))
    logdet = sum((F.log(F.col(f"l{i}{i}")) for i in range(P)), F.lit(0.0))
    return out.select(*keys, *[f"m{i}" for i in range(P)], *[f"v{i}{j}" for i in range(P) for j in range(i + 1)], logdet.alias("logdet"))


def _distance() -> Column:
    """Squared Mahalanobis distance from the joined estimate."""
    d = [F.col(f"x{i}") - F.col(f"m{i}") for i in range(P)]
    parts = [sum((F.col(f"v{i}{j}") * d[j] for j in range(i + 1)), F.lit(0.0)) for i in range(P)]
    return sum((z * z for z in parts), F.lit(0.0))


def estimates(rows: DataFrame) -> DataFrame:
    """One row per group ``k``: the reweighted MCD centre and scatter.

    Two starts (mean and covariance; medians and median deviations) go through
    concentration steps side by side; the one with the smaller determinant
    wins. The half sample of a step is all rows up to the distance bin that
    holds the group's ``SUPPORT`` quantile, so ties stay together.
    """
    xs = [f"x{i}" for i in range(P)]
    rows = rows.select("k", *xs).where("k is not null")
    long = rows.select("k", F.posexplode(F.array(*xs)).alias("dim", "x"))
    mids = stored(_median(long, F.col("x")), "medians")
    off = with_groups(long, mids, ["k", "dim"])
    mads = _median(off, F.abs(F.col("x") - F.col("mid"))).withColumnRenamed("mid", "mad")
    spread = mids.join(mads, ["k", "dim"]).groupBy("k").agg(
        *[F.max(F.when(F.col("dim") == i, F.col("mid"))).alias(f"m{i}") for i in range(P)],
        *[F.max(F.when(F.col("dim") == i, F.col("mad"))).alias(f"a{i}") for i in range(P)],
    )
    zero = [F.lit(0.0).alias(f"m{i}") for i in range(P)]
    plain = rows.select("*", *zero).groupBy("k", *[f"m{i}" for i in range(P)]).agg(*_moments()).withColumn("start", F.lit(0))
    robust = spread.select(
        "k", *[f"m{i}" for i in range(P)],
        F.lit(1).cast("long").alias("n"),
        *[F.lit(0.0).alias(f"s{i}") for i in range(P)],
        *[(F.pow(1.4826 * F.col(f"a{i}"), 2) if i == j else F.lit(0.0)).alias(f"q{i}{j}") for i in range(P) for j in range(i + 1)],
        F.lit(1).alias("start"),
    )
    keys = ["k", "start"]
    now = stored(_solved(plain.unionByName(robust), keys, 1.0), "mcd")
    centre = [f"m{i}" for i in range(P)]
    for _ in range(STEPS):
        far = with_groups(rows, now, ["k"]).withColumn("bin", F.floor(F.log(_distance() + 1e-9) * BINS))
        counts = far.groupBy("k", "start", "bin").agg(F.count("*").alias("n"))
        w = Window.partitionBy("k", "start")  # bins of a bounded range
        upto = counts.select("k", "start", "bin", F.sum("n").over(w.orderBy("bin")).alias("upto"), F.sum("n").over(w).alias("all"))
        edge = upto.where(F.col("upto") >= SUPPORT * F.col("all")).groupBy("k", "start").agg(F.min("bin").alias("edge"))
        inner = with_groups(far, stored(edge, "edges"), keys).where("bin <= edge")
        nxt = stored(_solved(inner.groupBy(*keys, *centre).agg(*_moments()), keys, consistency(SUPPORT)), "mcd")
        drop_stored(now)
        now = nxt
    best = now.groupBy("k").agg(F.min_by(F.struct(*[c for c in now.columns if c not in keys]), F.struct("logdet", "start")).alias("b")).select("k", "b.*")
    best = stored(best, "mcd")
    near = with_groups(rows, best, ["k"]).where(_distance() <= chi2_point(0.025, P))
    return stored(_solved(near.groupBy("k", *centre).agg(*_moments()), ["k"], consistency(0.975)), "mcd")


def judge(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``docs`` without the text, with the statistics, ``base_failed``,
    ``distance`` (null where the method doesn't judge) and ``kept``.

    ``kept`` is false if the base rule fails, or if the squared distance is
    beyond the chi-square point of tail ``TAIL``. Documents that fail the base
    rule take no part in the estimates. Null languages and sources are values
    of their own; an empty table gives no rows; copies count as rows. Groups of
    fewer than ``MIN_GROUP`` documents are judged together with the other small
    groups of their language; where these have fewer together, only the base
    rule rejects. Input columns named like a result are replaced, all others
    stay.
    """
    made = {*STATISTICS, "distance", "kept", text_col}
    rest = [c for c in docs.columns if c.lower() not in made]
    # input columns travel under names that nothing else has
    rows = docs.select(
        F.col(f"`{text_col}`").alias("__text"), F.col(f"`{lang_col}`").cast("string").alias("__lg"), F.col(f"`{source_col}`").cast("string").alias("__sr"),
        *[F.col(f"`{c}`").alias(f"__c{i}") for i, c in enumerate(rest)],
    )
    stats = stored(statistics(rows, text_col="__text"), "stats")
    judged = grouped(stats, "__lg", "__sr")
    found = estimates(judged.where("not base_failed"))
    out = with_groups(judged, found, ["k"], "left").withColumn("distance", _distance())
    fits = F.coalesce(F.col("distance") <= chi2_point(TAIL, P), F.lit(True))
    keep = [F.col(f"__c{i}").alias(c) for i, c in enumerate(rest)]
    return out.select(*keep, *STATISTICS, "distance", (~F.col("base_failed") & fits).alias("kept"))


def op6_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Statistics of and verdict on every whole document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return judge(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("distance", 3).alias("distance"))
