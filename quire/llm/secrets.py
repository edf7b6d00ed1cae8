"""Secret scans over an incremental blob ledger.

Every version of every path is content-addressed by the SHA-256 of its text.
The ledger remembers which (blob, rule version) pairs were scanned and what
they gave, so a run scans only pairs that it has not seen; findings are joined
back to all paths that hold, or ever held, the blob.

Ledger rows: ``blob_id BINARY, scanned ARRAY<STRING>`` (``rule@version``),
``found ARRAY<STRUCT<kind, version, start, stop>>``; offsets are code points,
``stop`` is exclusive.  A blob may have several rows, one per scan.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, new_path, table, whole_text


@dataclass(frozen=True)
class Rule:
    """A detector: leftmost non-overlapping matches of ``pattern`` whose
    ``group`` has ``least`` characters. ``hints``: a text without any of them
    cannot match and is not searched."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 0
    flags: int = 0
    hints: tuple[str, ...] = ()

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


#: Setting of the session that names a ledger to keep from run to run.
LEDGER = "spark.quire.secrets.ledger"
BASE_KINDS = ("assign", "access", "hex")
RULES: tuple[Rule, ...] = (
    Rule("assign", 1, r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, re.I | re.A, (":", "=")),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 20, 0, ("AKIA",)),
    Rule("hex", 1, r"[0-9a-f]{24,}", 0, 24),
    Rule("pem", 1, r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", 0, 0, 0, ("-----BEGIN ",)),
    Rule("github", 1, r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 0, 0, ("gh",)),
    Rule("slack", 1, r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 0, 0, ("xox",)),
    # a bounded header and scheme: where one begins, no unbounded run is read that the next beginning reads again
    Rule("jwt", 2, r"\beyJ[A-Za-z0-9_-]{8,1000}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", 0, 0, re.A, ("eyJ",)),
    Rule("basic_auth", 2, r"[a-z][a-z0-9+.-]{0,30}://[^\x00-\x20:/@]+:[^\x00-\x20:/@]+@", 0, 0, 0, ("://",)),
)

#: From a private key's header to its END line, or, where that is missing, to the
#: end of its header fields and base64 lines; line ends may be written as escapes.
_GAP = r"""(?:[\s"',>#|]|\\[nrt])*+"""
PEM_BLOCK = (
    r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----(?:"
    r"(?:[^-]++|-(?!----(?:BEGIN|END) ))*+-----END [A-Z ]{0,40}PRIVATE KEY-----"
    rf"""|(?:{_GAP}[A-Z][A-Za-z-]*: [^\r\n\\]*)*+(?:{_GAP}[A-Za-z0-9+/=]{{16,}}+)++(?:(?:\r?\n|\\n)[ \t]*[A-Za-z0-9+/=]{{1,15}}+(?![^\s"'\\]))?"""
    r"|)"
)
#: What the pipeline removes: as RULES, but with whole private keys.
STAGE_RULES: tuple[Rule, ...] = tuple(Rule("pem", 2, PEM_BLOCK, 0, 0, 0, r.hints) if r.kind == "pem" else r for r in RULES)

_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("version", pa.int32()), ("start", pa.int32()), ("stop", pa.int32())]))
LEDGER_SCHEMA = "blob_id binary, scanned array<string>, found array<struct<kind:string,version:int,start:int,stop:int>>"
_LEDGER_ARROW = pa.schema([("blob_id", pa.binary()), ("scanned", pa.list_(pa.string())), ("found", _SPANS)])


def find_spans(text: str, rules: Iterable[tuple[Rule, re.Pattern]]) -> list[dict]:
    """The spans of all rules in one text."""
    out = []
    for rule, pattern in rules:
        if rule.hints and not any(h in text for h in rule.hints):
            continue
        for m in pattern.finditer(text):
            if m.end(rule.group) - m.start(rule.group) >= rule.least:
                out.append({"kind": rule.kind, "version": rule.version, "start": m.start(), "stop": m.end()})
    return out


def blob_id(text_col: str = "text"):
    """The content address of a text; null counts as empty."""
    return F.unhex(F.sha2(whole_text(text_col), 256))


def unseen(versions: DataFrame, rules: tuple[Rule, ...], ledger: DataFrame | None, text_col: str = "text") -> DataFrame:
    """``blob_id, text, todo``: one row per distinct blob with a rule version
    that the ledger lacks. Copies of a blob meet map-side first, so a text that
    a third of all rows share crosses the network once per task at most."""
    keys = [r.key for r in rules]
    blobs = versions.select(blob_id(text_col).alias("blob_id"), whole_text(text_col).alias("text"))
    blobs = blobs.groupBy("blob_id").agg(F.first("text").alias("text"))
    every = F.array(*[F.lit(k) for k in keys])
    if ledger is None:
        return blobs.withColumn("todo", every)
    seen = ledger.select("blob_id", F.explode("scanned").alias("key")).where(F.col("key").isin(keys))
    seen = seen.groupBy("blob_id").agg(F.collect_set("key").alias("seen"))  # at most one entry per rule
    todo = F.when(F.col("seen").isNull(), every).otherwise(F.array_except(every, "seen"))
    return blobs.join(seen, "blob_id", "left").select("blob_id", "text", todo.alias("todo")).where(F.size("todo") > 0)


def scan(versions: DataFrame, rules: tuple[Rule, ...] = RULES, ledger: DataFrame | None = None, text_col: str = "text") -> DataFrame:
    """New ledger rows for the blobs of ``versions``.

    Null texts are the empty blob, which is recorded with no findings; an empty
    table gives no rows; other columns are ignored.
    """
    arrow_batches(versions.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = {r.key: (r, re.compile(r.pattern, r.flags)) for r in rules}
        for batch in batches:
            todo = batch.column("todo").to_pylist()
            texts = batch.column("text")
            found = [find_spans(texts[i].as_py(), [ready[k] for k in keys]) for i, keys in enumerate(todo)]
            yield pa.RecordBatch.from_arrays([batch.column("blob_id").cast(pa.binary()), pa.array(todo, pa.list_(pa.string())), pa.array(found, _SPANS)], schema=_LEDGER_ARROW)

    return unseen(versions, rules, ledger, text_col).mapInArrow(run, LEDGER_SCHEMA)


def findings(versions: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text") -> DataFrame:
    """All rows of ``versions`` with ``blob_id`` and ``secrets``, an array of
    ``kind, start, stop`` ordered by start, then by the rules' order: what the
    ledger holds for the current version of each rule. Columns of the input
    with these two names are replaced."""
    order = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.key), F.lit(i))])
    known = [r.key for r in rules]
    hit = ledger.where(F.size("found") > 0).select("blob_id", F.explode("found").alias("f"))
    hit = hit.withColumn("key", F.concat_ws("@", "f.kind", "f.version")).where(F.col("key").isin(known))
    spans = F.array_sort(F.collect_set(F.struct(F.col("f.start").alias("start"), order[F.col("key")].alias("rank"), F.col("f.kind").alias("kind"), F.col("f.stop").alias("stop"))))
    spans = F.transform(spans, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop")))
    hit = hit.groupBy("blob_id").agg(spans.alias("__secrets"))  # spans of one text
    rows = versions.drop("blob_id", "secrets").withColumn("blob_id", blob_id(text_col))
    none = F.array().cast("array<struct<kind:string,start:int,stop:int>>")
    return rows.join(hit, "blob_id", "left").withColumn("secrets", F.coalesce("__secrets", none)).drop("__secrets")


class SecretLedger:
    """A ledger kept as Parquet at ``path``; ``update`` adds what is unseen."""

    def __init__(self, spark, path: str):
        self.spark, self.path = spark, path

    def read(self) -> DataFrame:
        jpath = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not jpath.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(jpath):
            return self.spark.createDataFrame([], LEDGER_SCHEMA)
        return self.spark.read.schema(LEDGER_SCHEMA).parquet(self.path)

    def update(self, versions: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text") -> DataFrame:
        """Scan unseen pairs, append them, and return the whole ledger."""
        scan(versions, rules, self.read(), text_col).write.mode("append").parquet(self.path)
        return self.read()


def span_text(spans, kinds: tuple[str, ...] | None = None):
    """``kind:start:stop`` joined by commas, of the given kinds or of all."""
    if kinds:
        spans = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))))


def count_of(spans, kind: str):
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def redact(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``found`` with every span of ``text`` replaced by ``<kind>``, left to
    right; overlapping spans are replaced as one, from the first's start to the
    last end, by the kind of the earliest (then the longest) of them."""
    arrow_batches(docs.sparkSession)
    ordered = F.array_sort(F.transform("secrets", lambda s: F.struct(s["start"].alias("start"), (-s["stop"]).alias("neg"), s["kind"].alias("kind"))))
    step = lambda a, s: F.when(
        s["start"] < a["at"], F.struct(a["out"].alias("out"), F.greatest(a["at"], -s["neg"]).alias("at"))
    ).otherwise(
        F.struct(
            F.concat(a["out"], F.substring(F.col("text"), a["at"] + 1, s["start"] - a["at"]), F.lit("<"), s["kind"], F.lit(">")).alias("out"),
            (-s["neg"]).alias("at"),
        )
    )
    done = lambda a: F.concat(a["out"], F.substring(F.col("text"), a["at"] + 1, F.length("text")))
    clean = F.aggregate(ordered, F.struct(F.lit("").alias("out"), F.lit(0).alias("at")), step, done)
    return found.withColumn("text", F.when(F.size("secrets") > 0, clean).otherwise(F.col("text")))


def session_ledger(spark) -> SecretLedger:
    """The ledger that the setting ``LEDGER`` names, or else a new one."""
    return SecretLedger(spark, spark.conf.get(LEDGER, None) or new_path(spark, "ledger"))


def op1_secret_scan(spark, sf_dir: str) -> DataFrame:
    """All spans of all rules in every whole document. Blobs that the session's
    ledger knows are not scanned again; the others are added to it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = findings(docs, session_ledger(spark).update(docs))
    n = {k: count_of(F.col("secrets"), k).alias(f"n_{k}") for k in BASE_KINDS}
    return out.select(
        "doc_id", *n.values(),
        F.sha2(span_text(F.col("secrets"), BASE_KINDS), 256).alias("base_sha256"),
        span_text(F.col("secrets")).alias("spans"),
    )


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every document stays; its secrets are replaced by
    ``<kind>``, private keys with their bodies, and ``n_chars`` follows the new
    text."""
    found = findings(docs, session_ledger(spark).update(docs, STAGE_RULES), STAGE_RULES)
    out = redact(docs, found)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def _sql_pattern(rule: Rule) -> str:
    """The pattern with either case of ASCII letters written out."""
    if not rule.flags & re.I:
        return rule.pattern
    head, close, rest = rule.pattern.partition(")")
    return re.sub(r"[a-z]", lambda m: f"[{m[0]}{m[0].upper()}]", head) + close + rest


def _sql_matches(rank: int, rule: Rule) -> str:
    pattern = "'" + _sql_pattern(rule).replace("'", "''") + "'"
    length = lambda values: f"coalesce(list_sum(list_transform({values}, lambda x: length(x))), 0)"
    return (
        f"SELECT doc_id, '{rule.kind}' AS kind, {rank} AS rank, ({length('parts[1:i]')} + {length('found[1:i - 1]')})::BIGINT AS start, found[i] AS hit "
        f"FROM (SELECT doc_id, regexp_extract_all(t, {pattern}) AS found, string_split_regex(t, {pattern}) AS parts FROM d), unnest(range(1, len(found) + 1)) AS r(i) "
        f"WHERE length(regexp_extract(found[i], {pattern}, {rule.group})) >= {rule.least}"
    )


def _sql_spans(where: str = "") -> str:
    return f"string_agg(kind || ':' || start || ':' || (start + length(hit)), ',' ORDER BY start, rank){where}"


_BASE_SQL = " FILTER (kind IN ('" + "', '".join(BASE_KINDS) + "'))"
ORACLE = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS ({" UNION ALL ".join(_sql_matches(i, r) for i, r in enumerate(RULES))}),
s AS (SELECT doc_id, {_sql_spans()} AS spans, {_sql_spans(_BASE_SQL)} AS base, {", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in BASE_KINDS)} FROM m GROUP BY doc_id)
SELECT d.doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in BASE_KINDS)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN s ON d.doc_id = s.doc_id
"""
