"""Canonical exact digests of documents.

The canonical form of a text folds compatibility forms and case (NFKC, case
folding, NFKC again) and runs of white space; its fingerprint is the 128-bit
xxHash of that form's UTF-8.  Documents with equal fingerprints are compared
byte by byte; should two canonical forms ever share a hash, the one that is
not the bucket's representative gets a longer fingerprint.
"""

from __future__ import annotations

import hashlib
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, TimestampType

from .common import arrow_batches, stored, table, whole_text


def canonical(text: str) -> str:
    """Unicode-normalised, case-folded text with single spaces."""
    if text.isascii():
        return " ".join(text.lower().split())
    folded = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", text).casefold())
    return " ".join(folded.split())


def digest(form: bytes) -> str:
    return xxhash.xxh3_128_hexdigest(form)


def marks(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, fingerprint`` of every row, in place; null texts are empty."""
    arrow_batches(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), whole_text(f"`{text_col}`").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [digest(canonical(t).encode()) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, pa.string())], names=["id", "fingerprint"])

    return rows.mapInArrow(run, f"id {kind}, fingerprint string")


def shared_ids(marked: DataFrame) -> DataFrame:
    """Distinct ids of rows whose fingerprint another row has, too: counted
    map-side first, so a fingerprint of a third of all rows is no large group."""
    shared = marked.groupBy("fingerprint").agg(F.count("*").alias("n")).where("n > 1").select("fingerprint")
    return marked.join(stored(shared, "shared"), "fingerprint", "left_semi").select("id").distinct()


def settled(digests: DataFrame) -> DataFrame:
    """``digests`` (``id, fingerprint, form``, more) without ``form`` and with
    fingerprints that are equal only if the forms are.

    ``form`` is the canonical UTF-8 where the fingerprint occurs twice or more,
    else null. Each such row is compared byte by byte with its bucket's
    representative, the row with the smallest id; where they differ, the
    fingerprint is extended by the form's SHA-256. Of a bucket only one form a
    task is shuffled to find the representative, and the comparison is a join
    whose hot keys Spark can split.
    """
    names = [c for c in digests.columns if c != "form"]
    shared = digests.where("form is not null")
    heads = shared.groupBy("fingerprint").agg(F.min_by("form", F.struct("id", "form")).alias("__head"))
    both = shared.join(stored(heads, "heads"), "fingerprint")
    clash = F.col("form") != F.col("__head")
    final = F.when(clash, F.concat_ws("-", "fingerprint", F.sha2("form", 256))).otherwise(F.col("fingerprint"))
    both = both.withColumn("fingerprint", final)
    return digests.where("form is null").select(names).unionByName(both.select(names))


def duplicate_classes(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, fingerprint, class_id``: the smallest id with the same canonical form."""
    digests = compare_successive(docs, id_col=id_col, text_col=text_col).select(F.col(id_col).alias("id"), "fingerprint")
    digests = stored(digests, "fingerprints")
    first = digests.groupBy("fingerprint").agg(F.min("id").alias("class_id"))
    return digests.join(stored(first, "classes"), "fingerprint").select(F.col("id").alias(id_col), "fingerprint", "class_id")


def order_key(docs: DataFrame, id_col: str):
    """A column that rises with the id and has quantiles: the id itself if it
    is a number or a time, else the six bytes after what all ids begin with."""
    kind = docs.schema[id_col].dataType
    if isinstance(kind, (NumericType, DateType, TimestampType)):
        return F.col(id_col)
    raw = F.col(id_col).cast("binary")
    low, high = (bytes(x or b"") for x in docs.agg(F.min(raw), F.max(raw)).first())
    shared = next((i for i, (a, b) in enumerate(zip(low, high)) if a != b), min(len(low), len(high)))
    return F.conv(F.rpad(F.hex(F.substring(raw, shared + 1, 6)), 12, "0"), 16, 10).cast("bigint")


def bounds_of(docs: DataFrame, key, parts: int) -> list:
    """At most ``parts`` - 1 values of ``key`` that cut the table into ranges of similar size."""
    if parts < 2:
        return []
    found = docs.agg(F.percentile_approx(key, [i / parts for i in range(1, parts)], 10_000)).first()[0]
    return sorted(set(found or []))


def places_of(spark, parts: int, buckets: int) -> list[int]:
    """A number for each bucket whose hash sends it to a partition of its own:
    by their bare numbers several would share one, and others stay empty."""
    tried = spark.range(40 * parts).select("id", F.pmod(F.hash("id"), F.lit(parts)).alias("part"))
    found = {r["part"]: r["id"] for r in tried.groupBy("part").agg(F.min("id").alias("id")).collect()}  # one per partition
    return [found.get(b % parts, b) for b in range(buckets)]


def successive(docs: DataFrame, flagged: DataFrame, id_col: str, text_col: str, parts: int) -> DataFrame:
    """``bucket, tail, id, text`` so that each bucket holds a range of ids and,
    with ``tail`` set, the first row of the following range (of the first
    range, for the last one). Buckets come whole and ordered inside a partition.

    The ids of ``flagged`` come along as rows with a null text, just before the
    row with that id. Ranges are cut at approximate quantiles; the first id of
    each range is collected, one per range.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), whole_text(f"`{text_col}`").alias("text"))
    key = order_key(rows, "id")
    bounds = bounds_of(rows, key, parts)
    if bounds:
        # bounds up to the id, counted in whole blocks first, so the work per row grows with the square root of their number
        size = max(1, round(len(bounds) ** 0.5))
        below = lambda values: F.size(F.filter(values, lambda b: b <= key))
        cuts = F.array(*[F.lit(b) for b in bounds])
        blocks = F.array(*[F.lit(b) for b in bounds[size - 1 :: size]])
        counted = F.transform(F.array(below(blocks) * size), lambda n: n + below(F.slice(cuts, n + 1, size)))[0]
        bucket = F.when(F.col("id").isNull(), 0).otherwise(counted)
    else:
        bucket = F.lit(0)
    rows = rows.withColumn("bucket", bucket.cast("int"))
    found = rows.groupBy("bucket").agg(F.min("id").alias("first"), F.sum(F.col("id").isNull().cast("long")).alias("nulls")).collect()
    found.sort(key=lambda r: r["bucket"])
    firsts, before = [None] * (len(bounds) + 1), [None] * (len(bounds) + 1)
    for i, r in enumerate(found):
        firsts[r["bucket"]] = None if r["nulls"] else r["first"]
        before[r["bucket"]] = found[i - 1]["bucket"]  # the last one for the first
    at = lambda values, kind: F.get(F.array(*[F.lit(v) for v in values]).cast(f"array<{kind}>"), F.col("bucket"))
    first = at(firsts, rows.schema["id"].dataType.simpleString())
    # the bucket that this row ends, if it is the first of its own
    serves = F.when(F.col("id").eqNullSafe(first), F.array(at(before, "int"))).otherwise(F.array().cast("array<int>"))
    places = F.concat(F.array(F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("tail"))), F.transform(serves, lambda b: F.struct(b.alias("bucket"), F.lit(True).alias("tail"))))
    placed = rows.select("id", "text", F.explode(places).alias("at")).select("at.bucket", "at.tail", "id", "text")
    flags = flagged.select(bucket.cast("int").alias("bucket"), F.lit(False).alias("tail"), "id", F.lit(None).cast("string").alias("text"))
    both = placed.unionByName(flags).withColumn("place", at(places_of(rows.sparkSession, parts, len(bounds) + 1), "bigint"))
    return both.repartition(parts, "place").sortWithinPartitions("bucket", "tail", F.col("id").asc_nulls_first(), F.col("text").asc_nulls_first())


DIGEST_COLUMNS = ("n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def edited(text: str, following: str) -> str:
    """The last floor(n / 2) code points replaced by the first as many of the
    following text, or by all of it if it is shorter."""
    n = len(text) // 2
    return text[: len(text) - n] + following[:n]


def compare_successive(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", parts: int | None = None) -> DataFrame:
    """Each row's fingerprint beside that of its edited text and the next row's.

    ``near_edited`` and ``near_next`` are 1 if the canonical forms are equal
    byte by byte, else 0. The order is ascending id, then text; after the last
    row comes the first, so a single row is its own successor. A null id comes
    first, a null text is empty, an empty table gives no rows; columns other
    than id and text are ignored.

    One pass marks the ids whose fingerprints are shared, without moving texts;
    one shuffle of the texts by ranges of ids brings successors together; what
    is shared is compared byte by byte (``settled``).
    """
    spark = docs.sparkSession
    arrow_batches(spark)
    parts = parts or max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    flagged = shared_ids(stored(marks(docs, id_col=id_col, text_col=text_col), "marks"))
    kind = docs.select(F.col(f"`{id_col}`").alias("id")).schema["id"].dataType.simpleString()
    names = ["id", *DIGEST_COLUMNS, "form"]
    ddl = f"id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, form binary"

    def judged(key, text, form, flag, following, next_form):
        own = edited(text, following)
        own_form = canonical(own).encode()
        return (key, len(text), hashlib.sha256(own.encode()).hexdigest(), digest(form), digest(own_form), float(form == own_form), float(form == next_form), form if flag else None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, flag = None, None  # bucket and the row that waits for its successor; the last flagged id
        for batch in batches:
            out = []
            ids, buckets, tails, texts = (batch.column(c).to_pylist() for c in ("id", "bucket", "tail", "text"))
            for key, bucket, tail, text in zip(ids, buckets, tails, texts, strict=True):
                if text is None:
                    flag = (key,)
                    continue
                if held and held[0] != bucket:
                    held = None
                if tail and held is None:
                    continue  # a further row with the first id; the first one has served
                form = canonical(text).encode()
                if held:
                    out.append(judged(*held[1:], text, form))
                held = None if tail else (bucket, key, text, form, flag == (key,))
            columns = list(zip(*out, strict=True)) or [[]] * len(names)
            types = [batch.column("id").type, pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    digests = successive(docs, flagged, id_col, text_col, parts).mapInArrow(run, ddl)
    return settled(stored(digests, "digests")).withColumnRenamed("id", id_col)


def op8_fingerprints(spark, sf_dir: str) -> DataFrame:
    """Fingerprints of every whole document and of its edited text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return compare_successive(docs)
