"""Language identification of mixed-language text.

Words are runs of letters of one script.  Script ranges narrow the languages
that a word can be in; character trigrams score what is left; Viterbi decoding
with a penalty for each switch labels spans, and the spans decide on the text.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import arrow_batches, table, whole_text

#: Fixed script ranges (first, last code point), by name.
SCRIPTS: tuple[tuple[str, tuple[tuple[int, int], ...]], ...] = (
    ("latin", ((0x0041, 0x024F), (0x1E00, 0x1EFF), (0xFB00, 0xFB06), (0xFF21, 0xFF5A))),
    ("greek", ((0x0370, 0x03FF), (0x1F00, 0x1FFF))),
    ("cyrillic", ((0x0400, 0x052F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F))),
    ("armenian", ((0x0530, 0x058F),)),
    ("hebrew", ((0x0590, 0x05FF), (0xFB1D, 0xFB4F))),
    ("arabic", ((0x0600, 0x06FF), (0x0750, 0x077F), (0x08A0, 0x08FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF))),
    ("devanagari", ((0x0900, 0x097F), (0xA8E0, 0xA8FF))),
    ("bengali", ((0x0980, 0x09FF),)),
    ("tamil", ((0x0B80, 0x0BFF),)),
    ("thai", ((0x0E00, 0x0E7F),)),
    ("georgian", ((0x10A0, 0x10FF), (0x1C90, 0x1CBF))),
    ("hangul", ((0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF))),
    ("kana", ((0x3040, 0x30FF), (0x31F0, 0x31FF), (0xFF66, 0xFF9F))),
    ("han", ((0x2E80, 0x2FDF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF))),
)
OTHER = len(SCRIPTS) + 1
#: Hashed trigrams; training sample (documents in all, characters of one);
#: smoothing; clip of a trigram's log score.
BUCKETS, SAMPLE_DOCS, SAMPLE_CHARS, ALPHA, CLIP = 1 << 18, 2400, 20_000, 0.5, 4.0
#: Scores in a model: beyond 64 languages, trigrams share fewer buckets.
MODEL_SCORES = 1 << 24
#: Share of a language's letters that makes a script one of its own; cost of a
#: word in a script that is not (more than any switches, so such a language is
#: no candidate where another is); cost of a switch, in nats.
SCRIPT_SHARE, FOREIGN, SWITCH = 0.01, 1000.0, 14.0
#: Scores worked on at once.
BLOCK_SCORES = 1 << 22
#: Weights tried for the language that a text begins in.
LEADS = (0.0, 0.1, 0.2, 0.3, 0.45, 0.6)
FOLDS, HELD_OUT = 5, 0


@lru_cache(maxsize=1)
def script_table() -> np.ndarray:
    """Code point -> 0 for no letter, else 1 + index of its script, or OTHER."""
    out = np.zeros(0x110000, np.uint8)
    for c in range(0x110000):
        if unicodedata.category(chr(c))[0] == "L":
            out[c] = OTHER
    marks = np.fromiter((unicodedata.category(chr(c))[0] == "M" for c in range(0x110000)), bool, 0x110000)
    for i, (_, ranges) in enumerate(SCRIPTS):
        for first, last in ranges:
            part = out[first : last + 1]
            part[(part > 0) | marks[first : last + 1]] = i + 1
    return out


@dataclass
class Words:
    """Words of a batch of texts: flat letters and, per word, its text, its
    first and last + 1 code point there, and its script."""

    codes: np.ndarray
    first: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    script: np.ndarray


def split_words(texts: Sequence[str]) -> Words:
    """Letters are compared in lower case where that keeps their number."""
    sizes = np.array([len(t) for t in texts], np.int64)
    joined = "".join(texts)
    folded = joined.lower()
    flat = np.frombuffer((folded if len(folded) == len(joined) else "".join(c.lower() if len(c.lower()) == 1 else c for c in joined)).encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = script_table()[flat]
    ends = np.cumsum(sizes)
    begins = ends - sizes
    joins = (flat >= 0x0300) & (flat <= 0x036F)  # combining marks go on with the letter before them
    if joins.any():
        joins[begins[(begins < len(flat)) & (sizes > 0)]] = False
        kind = kind[np.maximum.accumulate(np.where(joins, 0, np.arange(len(flat))))]
    new = np.empty(len(flat), bool)
    if len(flat):
        new[0] = True
        new[1:] = kind[1:] != kind[:-1]
        new[begins[(begins < len(flat)) & (sizes > 0)]] = True
    letter = kind > 0
    at = np.flatnonzero(new & letter)
    # a word ends where the next run, of any kind, begins
    runs = np.flatnonzero(new)
    stop = np.append(runs, len(flat))[np.searchsorted(runs, at, "right")] if len(at) else at
    doc = np.searchsorted(ends, at, "right")
    place = np.flatnonzero(letter)
    return Words(flat[place], np.searchsorted(place, at), doc, at - begins[doc] if len(at) else at, stop - begins[doc] if len(at) else at, kind[at])


def trigrams(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the trigram that ends at each letter, and of the one that ends
    each word; positions before a word count as 0."""
    c = words.codes.astype(np.uint64)
    one, two = np.zeros_like(c), np.zeros_like(c)
    one[1:], two[2:] = c[:-1], c[:-2]
    one[words.first] = two[words.first] = 0
    second = words.first + 1
    second = second[second < len(c)]
    two[second] = 0
    mix = lambda a, b, d: ((a * np.uint64(0x9E3779B97F4A7C15) ^ b * np.uint64(0xC2B2AE3D27D4EB4F) ^ d * np.uint64(0x165667B19E3779F9)) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(46)
    last = np.append(words.first[1:], len(c)) - 1 if len(words.first) else words.first
    return mix(c, one, two), mix(np.full(len(last), 1, np.uint64), c[last], one[last])


@dataclass
class Model:
    """What was learned: centred trigram scores (bucket, language), scripts of
    each language, and the weight of the language that a text begins in."""

    langs: list[str]
    scores: np.ndarray
    scripts: np.ndarray
    lead: float = 0.0

    def word_scores(self, words: Words) -> np.ndarray:
        inner, last = (x & np.uint64(len(self.scores) - 1) for x in trigrams(words))
        n, width = len(words.first), len(self.langs)
        out = np.zeros((n, width))
        ends = np.append(words.first[1:], len(words.codes))
        a = 0
        while a < n:  # blocks of whole words
            b = max(a + 1, int(np.searchsorted(ends, words.first[a] + BLOCK_SCORES // max(1, width), "right")))
            begin = words.first[a]
            out[a:b] = np.add.reduceat(self.scores[inner[begin : ends[b - 1]]], words.first[a:b] - begin, axis=0) + self.scores[last[a:b]]
            mine = self.scripts[words.script[a:b]]
            out[a:b] -= FOREIGN * (~mine & mine.any(axis=1, keepdims=True))
            a = b
        return out


def train(texts: Sequence[str], langs: Sequence[str]) -> Model:
    """Trigram scores from labelled texts, languages weighted alike."""
    names = sorted(set(langs))
    buckets = min(BUCKETS, 1 << int(np.log2(max(1, MODEL_SCORES // max(1, len(names))))))
    if not names:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros((OTHER + 1, 0), bool))
    number = {n: i for i, n in enumerate(names)}
    texts = [unicodedata.normalize("NFC", t) for t in texts]
    counts = np.zeros((buckets, len(names)))
    letters = np.zeros((OTHER + 1, len(names)))
    label = np.array([number[x] for x in langs], np.int64)
    for i in range(0, len(texts), 200):
        words = split_words(texts[i : i + 200])
        inner, last = (x & np.uint64(buckets - 1) for x in trigrams(words))
        own = label[i : i + 200][words.doc]
        lengths = np.diff(np.append(words.first, len(words.codes)))
        np.add.at(counts, (inner, np.repeat(own, lengths)), 1)
        np.add.at(counts, (last, own), 1)
        np.add.at(letters, (words.script, own), lengths)
    total = np.maximum(counts.sum(axis=0), 1)
    counts *= total.mean() / total
    seen = max(1, int((counts.sum(axis=1) > 0).sum()))
    logs = np.log((counts + ALPHA) / (counts.sum(axis=0) + ALPHA * seen))
    logs -= logs.mean(axis=1, keepdims=True)
    logs[counts.sum(axis=1) == 0] = 0
    scripts = letters / np.maximum(letters.sum(axis=0), 1) >= SCRIPT_SHARE
    model = Model(names, np.clip(logs, -CLIP, CLIP).astype(np.float32), scripts)
    right = np.zeros(len(LEADS))
    for i in range(0, len(texts), 200):
        for shares, first, truth in zip(*coverage(model, texts[i : i + 200])[:2], label[i : i + 200], strict=True):
            if shares is not None:
                for k, lead in enumerate(LEADS):
                    right[k] += pick(shares, first, lead) == truth
    model.lead = LEADS[int(right.argmax())]
    return model


def viterbi(scores: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """Best language of each word: the path of the largest sum of scores less
    ``switch`` for each change; ties stay, then go to the lower language."""
    rows = scores.tolist()
    states = range(scores.shape[1])
    best, back = rows[0], []
    for row in rows[1:]:
        top = max(best)
        source, jump = best.index(top), top - switch
        back.append([j if best[j] >= jump else source for j in states])
        best = [(best[j] if best[j] >= jump else jump) + row[j] for j in states]
    at = best.index(max(best))
    path = [at]
    for step in reversed(back):
        at = step[at]
        path.append(at)
    return np.array(path[::-1], np.int64)


def label_words(scores: np.ndarray, doc: np.ndarray, n: int, switch: float = SWITCH) -> tuple[np.ndarray, np.ndarray]:
    """The Viterbi label of each word, and each text's summed scores.

    If no stretch of words gains half of what a switch costs by leaving the
    text's best single language, that language is the optimal path: m stretches
    elsewhere gain less than m / 2 switches and need m - 1 at least, and one
    alone over the whole text gains nothing. Only texts where some stretch does
    gain that much are decoded word by word.
    """
    width = scores.shape[1]
    total = np.zeros((n, width))
    if not len(doc):
        return np.zeros(0, np.int64), total
    np.add.at(total, doc, scores)
    best = total.argmax(axis=1)
    gain = scores - scores[np.arange(len(doc)), best[doc]][:, None]
    starts = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
    mixed = np.zeros(n, bool)
    for j in range(width):
        # sums before and after each word, counted from the text's beginning; a step down
        # per text lets the running minimum start anew
        after = np.cumsum(gain[:, j])
        before = after - gain[:, j]
        base = np.repeat(before[starts], np.diff(np.append(starts, len(doc))))
        after, before = after - base, before - base
        drop = (after.max() - min(after.min(), 0) + 1) * np.cumsum(np.append(True, doc[1:] != doc[:-1]))
        low = np.minimum.accumulate(before - drop) + drop
        mixed[doc[after - low > switch / 2 - 1e-6]] = True  # the sums are rounded
    labels = best[doc]
    bounds = np.append(starts, len(doc))
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if mixed[doc[a]]:
            labels[a:b] = viterbi(scores[a:b], switch)
    return labels, total


def coverage(model: Model, texts: Sequence[str]):
    """Per text: letters in each language's spans (None without a letter), the
    first word's language, summed scores; and all words with their labels."""
    words = split_words(texts)
    n = len(texts)
    scores = model.word_scores(words)
    labels, total = label_words(scores, words.doc, n)
    lengths = np.diff(np.append(words.first, len(words.codes)))
    shares = np.zeros((n, len(model.langs)))
    np.add.at(shares, (words.doc, labels), lengths)
    has = np.zeros(n, bool)
    has[words.doc] = True
    first = np.zeros(n, np.int64)
    at = np.flatnonzero(np.append(True, words.doc[1:] != words.doc[:-1])) if len(words.doc) else np.zeros(0, np.int64)
    first[words.doc[at]] = labels[at]
    return [shares[i] if has[i] else None for i in range(n)], first, total, words, labels


def pick(shares: np.ndarray, first: int, lead: float) -> int:
    """The language with most letters, the first one's raised by ``lead``."""
    weighted = shares.copy()
    weighted[first] += lead * shares.sum()
    return int(weighted.argmax())


def predict(model: Model, texts: Sequence[str]) -> list[tuple[str, float]]:
    """Language and score of each text. The score is the share of letters in
    the language's spans times the odds of its summed score over the next best.
    Texts are compared in their composed form (NFC). Of languages alike, the
    first by name counts. Without a letter, or without a learned language:
    ``und``, 0."""
    if not model.langs:
        return [("und", 0.0)] * len(texts)
    shares, first, total, _, _ = coverage(model, [unicodedata.normalize("NFC", t) for t in texts])
    out = []
    for s, f, sums in zip(shares, first, total, strict=True):
        if s is None:
            out.append(("und", 0.0))
            continue
        k = pick(s, f, model.lead)
        rest = np.delete(sums, k)
        margin = np.clip(sums[k] - rest.max(), -30, 30) if len(rest) else 30.0
        out.append((model.langs[k], float(s[k] / s.sum() / (1 + np.exp(-margin)))))
    return out


def spans_of(model: Model, texts: Sequence[str]) -> list[list[dict]]:
    """Spans ``start, stop, lang`` (code points) of each text: neighbouring
    words of one language, from the first letter to the last; offsets are those
    of the text as it is."""
    out: list[list[dict]] = [[] for _ in texts]
    if not model.langs:
        return out
    _, _, _, words, labels = coverage(model, texts)
    if not len(labels):
        return out
    cut = np.append(True, (words.doc[1:] != words.doc[:-1]) | (labels[1:] != labels[:-1]))
    a = np.flatnonzero(cut)
    b = np.append(a[1:], len(labels)) - 1
    for i, j in zip(a.tolist(), b.tolist(), strict=True):
        out[words.doc[i]].append({"start": int(words.start[i]), "stop": int(words.stop[j]), "lang": model.langs[labels[i]]})
    return out


def remainder(column: str, folds: int):
    """CRC-32 of the id as text, modulo ``folds``; null ids count as empty."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def sample(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = FOLDS, held_out: int = HELD_OUT) -> DataFrame:
    """The bounded training sample, ``text, lang``: at most ``SAMPLE_DOCS``
    documents in all, as many of each language (of more languages than that,
    one of each of the most frequent), by the order of a hash of the id, then of
    the text; only texts up to ``SAMPLE_CHARS`` characters."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang"))
    rows = rows.where((remainder("id", folds) != held_out) & F.col("text").isNotNull() & F.col("lang").isNotNull())
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(SAMPLE_DOCS).collect()
    each = SAMPLE_DOCS // max(1, len(sizes))
    shares = docs.sparkSession.createDataFrame([(r["lang"], min(1.0, 1.6 * each / r["n"] + 8 / r["n"])) for r in sizes], "lang string, wanted double")
    rows = rows.join(F.broadcast(shares), "lang")  # at most SAMPLE_DOCS rows: a proven bound
    order = F.conv(F.substring(F.md5(F.col("id").cast("string")), 1, 12), 16, 10).cast("long") / F.lit(float(1 << 48))
    rows = rows.withColumn("order", order).where((F.col("order") < F.col("wanted")) & (F.length("text") <= SAMPLE_CHARS))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("order", "id", "text"))  # of the sample only
    return rows.withColumn("rank", rank).where(F.col("rank") <= each).select("text", "lang")


def learn(docs: DataFrame, **columns) -> Model:
    """A model from the bounded sample of ``docs``, trained on the driver."""
    rows = sorted(tuple(r) for r in sample(docs, **columns).collect())  # at most SAMPLE_DOCS
    return train([r[0] for r in rows], [r[1] for r in rows])


def identify(docs: DataFrame, model: Model, *, text_col: str = "text", keep: Sequence[str] = ("doc_id",), spans: bool = False) -> DataFrame:
    """The ``keep`` columns with ``lang_pred``, ``score`` and, if asked for,
    ``spans``. One row per input row (repeated rows too), in place, without a
    shuffle; null texts are empty; ``keep`` columns named like a result give
    way to it. The model, of bounded size, is broadcast."""
    spark = docs.sparkSession
    arrow_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    made = {"lang_pred", "score", *(["spans"] if spans else [])}
    rows = docs.select(*[F.col(f"`{c}`") for c in keep if c.lower() not in made], whole_text(f"`{text_col}`").alias("__li_text"))
    fields = [f for f in rows.schema.fields if f.name != "__li_text"]
    ddl = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in fields) + "lang_pred string, score double" + (", spans array<struct<start:int,stop:int,lang:string>>" if spans else "")
    kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("lang", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("__li_text").to_pylist()
            found = predict(shared.value, texts)
            names = [n for n in batch.schema.names if n != "__li_text"]
            columns = [batch.column(n) for n in names] + [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            names += ["lang_pred", "score"]
            if spans:
                columns.append(pa.array(spans_of(shared.value, texts), kind))
                names.append("spans")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(run, ddl)


def op3_language_id(spark, sf_dir: str) -> DataFrame:
    """The language of every whole document, learned from four folds of five."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = learn(docs)
    rows = docs.select("doc_id", "text", (remainder("doc_id", FOLDS) == HELD_OUT).alias("held_out"))
    return identify(rows, model, keep=("doc_id", "held_out"))
