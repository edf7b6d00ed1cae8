"""Near-duplicate classes by banded DartMinHash signatures.

1. One pass over the texts gives each row a digest of its words and the band
   keys of its signature; texts are not moved.
2. Rows with equal words form a group, led by the smallest id; only leaders go
   on, so thousands of copies are one candidate.
3. Leaders that share a band key meet one head there, the leader with most
   company over all its bands, and each is compared with it exactly: a star,
   not all pairs. What is no link to its head meets a second head, one of
   their own kind.
4. Two members of a star can still be links where their head is none of
   either. Each comparison also tells which shingles a member has that its head
   lacks. Members in different components meet in an index on these, rarest
   first (a prefix filter with positions, so edited copies of one text, which
   have different edits, don't meet in pairs); such as share none can be links
   only if both are nearly contained in the head and of fitting sizes
   (``meetings``). So no link is lost to the stars.
5. Components of the links are the classes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, drop_stored, stored, table, whole_text
from .components import components
from .dartminhash import bands, beyond, pieces, shingles, signatures

#: Similarity from which two texts are linked; coordinates, and those in a
#: band. A pair at the threshold shares a band with probability 0.99995.
THRESHOLD, COORDINATES, ROWS = 0.8, 125, 5
#: Width of a class of sizes, as a natural logarithm.
CLASS = 0.02


def signed(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", coordinates: int = COORDINATES, rows: int = ROWS) -> DataFrame:
    """``id, digest, bands`` of every row, in place. ``bands`` is null for a
    text without words."""
    arrow_batches(docs.sparkSession)
    picked = docs.select(F.col(f"`{id_col}`").alias("id"), whole_text(f"`{text_col}`").alias("text"))
    kind = picked.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column("text").cast(pa.binary()).to_pylist()
            for a, b in pieces([len(r) for r in raw]):
                found = shingles(raw[a:b])
                keys = bands(signatures(found, coordinates), rows)
                lists = pa.array([k if n else None for k, n in zip(list(keys), found.words.tolist(), strict=True)], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([batch.column("id")[a:b], pa.array(found.digests, pa.binary()), lists], names=["id", "digest", "bands"])

    return picked.mapInArrow(run, f"id {kind}, digest binary, bands array<bigint>")


def compared(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """``pairs`` (``a, b``) with their exact ``similarity``, the number of
    shingles of ``a`` (``size``) and the hashes of those that ``b`` lacks
    (``own``). ``texts`` is a stored table ``id, text`` with all their ids.

    The text of ``a`` travels to ``b``; a ``b`` that many pairs share is a hot
    key that Spark can split, and is worked out once for neighbouring rows.
    """
    kind = texts.schema["id"].dataType.simpleString()
    left = texts.select(F.col("id").alias("a"), F.col("text").alias("ta"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("tb"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "ta", "tb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ta, tb = (batch.column(c).cast(pa.binary()) for c in ("ta", "tb"))
            where = tb.dictionary_encode()
            others, index = where.dictionary.to_pylist(), where.indices.to_pylist()
            known = {}
            for i, j in pieces([len(t) for t in others]):
                found = shingles(others[i:j])
                known.update({i + k: (found, k) for k in range(j - i)})
            raw = ta.to_pylist()
            rows = []
            for i, j in pieces([len(t) for t in raw]):
                found = shingles(raw[i:j])
                rows += [beyond(found, k, *known[index[i + k]]) for k in range(j - i)]
            same, size, own = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(same, pa.float64()), pa.array(size, pa.int64()), pa.array(list(own), pa.list_(pa.int64()))],
                names=["a", "b", "similarity", "size", "own"],
            )

    arrow_batches(texts.sparkSession, megabytes=8)
    return both.mapInArrow(run, f"a {kind}, b {kind}, similarity double, size bigint, own array<bigint>")


def meetings(stars: DataFrame, threshold: float) -> DataFrame:
    """``a, b``: pairs of members of one head, in different components, that
    may be links, each once at least. ``stars`` is stored: ``compared`` members
    ``a`` of heads ``b`` with ``root`` and ``loose`` (not in the head's
    component; one of a pair must be).

    Two texts of n and m shingles with similarity t or more share at least
    q = t / (1 + t) (n + m) of them, so m lies between tn and n / t. Order the
    shingles of a star by whether the head has them, then by how many members
    have them.

    - If the two share any that the head lacks, the first that they share is
      among the first n - q + 1 of one and the first m - q + 1 of the other.
      A pair meets once, as the smaller one (n, and q for m = n at least) and
      the larger one (m, and q for n = tm at least), so a member has at most
      n (1 - t) / (1 + t) + 1 and m (1 - t) + 1 rows, whatever the others are.
      Shingles that no other member has take up places, but aren't indexed.
    - If they share none of those, each shares q at least with the head.
    """
    t = threshold
    bin_of = lambda x: F.floor(F.log(x) / CLASS)
    prefix = lambda n, m: (n - F.ceil(t / (1 + t) * (n + m) - 1e-6) + 1).cast("int")
    lower = lambda n: n * t * (1 - 1e-9)
    rows, held = stars.agg(F.count("*"), F.coalesce(F.sum(F.size("own")), F.lit(0))).first()
    facts = stars.select("b", "a", "root", "loose", F.col("similarity").alias("sim"), F.col("size").alias("n"), F.size("own").alias("own"), bin_of(F.col("size").cast("double")).alias("bin"))
    tokens = stars.select("b", "a", F.explode("own").alias("token"))
    common = stored(tokens.groupBy("b", "token").agg(F.count("*").alias("df")).where("df > 1"), "common", rows=held, each=2_000_000)
    listed = tokens.join(common, ["b", "token"]).groupBy("b", "a").agg(F.transform(F.sort_array(F.collect_list(F.struct("df", "token"))), lambda x: x["token"]).alias("tokens"))
    listed = stored(facts.drop("bin").join(listed, ["b", "a"]).withColumn("alone", F.col("own") - F.size("tokens")), "listed", rows=rows, each=20_000)

    def marks(df: DataFrame, side: str, most) -> DataFrame:
        """A row for each of the first ``most`` shingles that others have, with its place."""
        first = F.slice("tokens", 1, F.greatest(most - F.col("alone"), F.lit(0)))
        out = df.select("*", F.posexplode(first).alias("place", "token")).withColumn("place", F.col("place") + F.col("alone") + 1)
        return out.select("b", "token", *[F.col(c).alias(f"{c}_{side}") for c in ("a", "root", "sim", "n", "place")])

    apart = (
        (F.col("root_a") != F.col("root_b"))
        & (F.abs(F.col("sim_a") - F.col("sim_b")) <= 1 - t + 1e-9)
        & (F.greatest("n_a", "n_b") * t <= F.least("n_a", "n_b") + 1e-6)
    )
    n = F.col("n")
    small, large = (lambda df: marks(df, "a", prefix(n, n))), (lambda df: marks(df, "b", prefix(n, n * t)))
    ordered = (F.col("n_a") < F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & (F.col("a_a") < F.col("a_b")))
    agree = apart & ordered & (F.col("place_a") <= prefix(F.col("n_a"), F.col("n_b"))) & (F.col("place_b") <= prefix(F.col("n_b"), F.col("n_a")))
    sides = ((listed.where("loose"), listed), (listed.where("NOT loose"), listed.where("loose")))
    by_token = [small(x).join(large(y), ["b", "token"]).where(agree) for x, y in sides]

    near = facts.withColumn("c", n - F.col("own")).where(F.col("c") >= lower(n))
    side = lambda df, s: df.select("b", "bin", *[F.col(c).alias(f"{c}_{s}") for c in ("a", "root", "loose", "sim", "n", "c")])
    most = F.greatest(F.col("c") * ((1 + t) / t) - n, n * t) * (1 + 1e-9)
    probes = near.where("loose").withColumn("bin", F.explode(F.sequence(bin_of(lower(n)), bin_of(most))))
    once = ~F.col("loose_b") | (F.col("a_a") < F.col("a_b"))
    by_size = side(probes, "a").join(side(near, "b"), ["b", "bin"]).where(apart & once & (F.least("c_a", "c_b") >= t / (1 + t) * (F.col("n_a") + F.col("n_b")) - 1e-6))
    out = [df.select(F.least("a_a", "a_b").alias("a"), F.greatest("a_a", "a_b").alias("b")) for df in (*by_token, by_size)]
    out = stored(out[0].union(out[1]).union(out[2]).distinct(), "rest")
    drop_stored(common, listed)
    return out


def first_stars(banded: DataFrame, rows: int) -> DataFrame:
    """``a, b`` for every leader and head that share a key of ``banded``
    (``leader, key``; so many rows); a key's head is the leader with most company."""
    sizes = stored(banded.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "sizes", rows=rows)
    buckets = stored(banded.join(sizes, "key").select("key", "n", "leader"), "buckets", rows=rows)
    company = stored(buckets.groupBy("leader").agg(F.sum("n").alias("company")), "company", rows=rows)
    heads = buckets.join(company, "leader").groupBy("key").agg(F.min_by("leader", F.struct((-F.col("company")).alias("company"), "leader")).alias("head"))
    heads = stored(heads, "heads", rows=rows)
    out = stored(buckets.join(heads, "key").where("leader <> head").select(F.col("leader").alias("a"), F.col("head").alias("b")).distinct(), "pairs", rows=rows)
    drop_stored(sizes, buckets, company, heads)
    return out


def second_stars(stars: DataFrame, threshold: float, rows: int) -> DataFrame:
    """``a, b`` for the members of each head that are no links to it, with one
    of them as their second head."""
    loose = stars.where(F.col("similarity") < threshold).select("a", "b")
    order = F.struct(F.xxhash64("a"), "a")
    heads = stored(loose.groupBy("b").agg(F.min_by("a", order).alias("head"), F.count("*").alias("n")).where("n > 1").select("b", "head"), "heads", rows=rows)
    out = stored(loose.join(heads, "b").where("a <> head").select("a", F.col("head").alias("b")).distinct(), "pairs", rows=rows)
    drop_stored(heads)
    return out


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, coordinates: int = COORDINATES, rows: int = ROWS) -> DataFrame:
    """``id, class_id`` of every row: the smallest id of its class.

    Two texts are linked if the weighted Jaccard similarity of their five-word
    shingles is at least ``threshold``; classes are the components of links. A
    text of one to four words has all of them as its one shingle. Texts without
    words (null, empty, white space) are classes of their own, and so are rows
    with a null id, whose class is null. Rows that repeat an id are one
    document. Other columns are ignored; an empty table gives no rows.
    """
    sigs = stored(signed(docs, id_col=id_col, text_col=text_col, coordinates=coordinates, rows=rows), "signatures")
    worded = sigs.where("bands is not null and id is not null")
    groups = stored(worded.groupBy("digest").agg(F.min("id").alias("leader"), F.first("bands").alias("bands")), "groups")  # equal words, equal bands
    many = groups.count()
    star = first_stars(groups.select("leader", F.explode("bands").alias("key")), many * (coordinates // rows))
    met = star.count()
    ids = stored(star.select(F.col("a").alias("id")).union(star.select("b")).distinct(), "ids", rows=min(many, 2 * met))
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), whole_text(f"`{text_col}`").alias("text"))
    texts = stored(texts.join(ids, "id", "left_semi"), "texts")
    stars = stored(compared(star, texts), "stars", rows=met, each=5_000)
    again = second_stars(stars, threshold, met)
    more = stored(compared(again, texts), "stars", rows=met, each=5_000)
    links = stars.select("a", "b", "similarity").union(more.select("a", "b", "similarity")).where(F.col("similarity") >= threshold)
    roots = components(links.select("a", "b"), 2 * met)

    # a member without a link is its own root; only heads with members of two components have work left
    of = lambda c, to: roots.withColumnsRenamed({"node": c, "root": to})
    held = stars.join(of("a", "ra"), "a", "left").join(of("b", "rb"), "b", "left")
    held = held.select("a", "b", "similarity", "size", "own", F.coalesce("ra", "a").alias("root"), (F.coalesce("ra", "a") != F.coalesce("rb", "b")).alias("loose"))
    held = stored(held, "members", rows=met, each=20_000)
    busy = stored(held.groupBy("b").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("b"), "busy", rows=met)
    open_ = stored(held.join(busy, "b", "left_semi"), "members", rows=met, each=20_000)
    rest = meetings(open_, threshold)
    left = rest.count()
    late = stored(compared(rest, texts).where(F.col("similarity") >= threshold).select("a", "b"), "late", rows=left, each=5_000)
    drop_stored(ids, star, again, stars, more, held, busy, open_, rest, texts)
    if left := late.count():
        up = lambda c: F.coalesce(f"r{c}", c).alias(c)
        lifted = late.join(of("a", "ra"), "a", "left").join(of("b", "rb"), "b", "left")
        joined = components(lifted.select(up("a"), up("b")), left)
        over = joined.select(F.col("node").alias("root"), F.col("root").alias("__over"))
        everyone = roots.unionByName(late.select(F.col("a").alias("node")).union(late.select("b")).distinct().join(roots, "node", "left_anti").withColumn("root", F.col("node")))
        roots = stored(everyone.join(over, "root", "left").select("node", F.coalesce("__over", "root").alias("root")), "roots", rows=many)

    led = groups.select("digest", "leader").join(roots.withColumnRenamed("node", "leader"), "leader", "left")
    led = stored(led.select("digest", F.coalesce("root", "leader").alias("class_id")), "classes", rows=many)
    classes = worded.select("id", "digest").join(led, "digest").select("id", "class_id")
    alone = sigs.where("bands is null or id is null").select("id", F.col("id").alias("class_id"))
    return classes.unionByName(alone).withColumnRenamed("id", id_col)


def op5_near_duplicates(spark, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every whole document."""
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each class, the document with the smallest id stays.

    Of rows that repeat an id, the one with the smallest digest of its text
    stays, and of rows without an id one for each different sequence of words.
    Documents without words are classes of their own and stay. Only rows whose
    id isn't unique are shuffled.
    """
    classes = near_duplicates(docs)
    gone = stored(classes.where("class_id <> doc_id").select("doc_id").distinct(), "gone")
    kept = docs.join(gone, "doc_id", "left_anti").select(docs.columns)
    twice = stored(docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 or doc_id is null").select(F.col("doc_id").alias("__id")), "twice")
    if not twice.limit(1).count():
        drop_stored(twice)
        return kept
    again = F.col("doc_id").eqNullSafe(F.col("__id"))
    words = F.trim(F.regexp_replace(whole_text(), r"[\x20\x09-\x0D]+", " "))
    key = F.when(F.col("doc_id").isNull(), F.sha2(words, 256)).otherwise("")
    picked = kept.join(twice, again, "left_semi").withColumn("__key", key).groupBy("doc_id", "__key")
    row = F.min_by(F.struct(*docs.columns), F.sha2(whole_text(), 256))
    return kept.join(twice, again, "left_anti").unionByName(picked.agg(row.alias("__row")).select("__row.*"))
