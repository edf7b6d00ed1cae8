"""Byte-level BPE encoding and decoding with the tokenizers library.

The vocabulary is a rank file (base64 token, rank).  Its merges are every
split of a token into two tokens, ordered by the rank of what they make, which
is the order in which a rank-based encoder merges; a piece that is a token
itself is taken whole.  Bytes travel as characters through the usual printable
byte table, and token offsets are mapped back to code points of the text.
"""

from __future__ import annotations

import base64
import hashlib
import os
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, table, whole_text

#: Distinct space-delimited chunks whose ids a Python worker remembers, and the
#: longest such chunk: longer ones rarely come again.
CACHE, CACHE_CHARS = 300_000, 12
#: Characters that are encoded in one call when chunks are new.
JOIN_CHARS = 4_000


def byte_table() -> list[str]:
    """Byte -> printable character: printable Latin-1 bytes stand for
    themselves, the others for U+0100 onwards in order."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(rest)) for b in range(256)]


class ByteBPE:
    """One vocabulary: encoding, offsets and decoding."""

    def __init__(self, path: str, pattern: str):
        from tokenizers import Regex, Tokenizer, pre_tokenizers
        from tokenizers.models import BPE

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark already runs a task per core
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        chars = byte_table()
        shown = {token: "".join([chars[b] for b in token]) for token in ranks}
        merges = []
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                if token[:i] in ranks and token[i:] in ranks:
                    merges.append((rank, ranks[token[:i]], shown[token[:i]], shown[token[i:]]))
        merges.sort(key=lambda m: m[:2])
        model = BPE(vocab={shown[t]: r for t, r in ranks.items()}, merges=[m[2:] for m in merges], ignore_merges=True)
        self.tokenizer = Tokenizer(model)
        self.tokenizer.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.Split(Regex(pattern), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        # decoding: the byte table in reverse, token by token
        back = {c: b for b, c in enumerate(chars)}
        self.token_bytes: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for token, i in self.tokenizer.get_vocab().items():
            self.token_bytes[i] = bytes([back[c] for c in token])
        self.token_length = np.array([len(t) for t in self.token_bytes], np.int64)
        self._chunks: dict[str, bytes | None] = {}

    def _whole(self, texts: Sequence[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast(list(texts), add_special_tokens=False)
        return [np.array(e.ids, np.int32).tobytes() for e in encoded]

    def _joined(self, chunks: Sequence[str]) -> list[bytes]:
        """Token ids of chunks that begin with their only space: they are
        encoded together and told apart by the tokens' byte lengths."""
        texts, sizes, room = [], [], 0
        for chunk in chunks:
            if room <= 0:
                texts.append([])
                room = JOIN_CHARS
            texts[-1].append(chunk)
            sizes.append(len(chunk.encode()))
            room -= len(chunk)
        ids = np.concatenate([np.zeros(0, np.int32), *[np.frombuffer(x, np.int32) for x in self._whole(["".join(t) for t in texts])]])
        ends = np.cumsum(self.token_length[ids])
        cuts = np.searchsorted(ends, np.cumsum(sizes), "left") + 1
        raw, at, out = ids.tobytes(), 0, []
        for cut in (4 * cuts).tolist():
            out.append(raw[at:cut])
            at = cut
        return out

    def encode(self, texts: Sequence[str]) -> list[np.ndarray]:
        """Token ids of each text.

        A single space between two non-space characters always starts a match
        of the pattern and no match spans it, so a text is the concatenation of
        its space-delimited chunks; ids of short chunks are remembered. A text
        with any other space (at its ends, or beside white space) is encoded
        whole.
        """
        known = self._chunks
        parts, new = [], {}
        for text in texts:
            own = text.replace(" ", "\x00 ").split("\x00") if "\x00" not in text else [" "]
            parts.append(own)
            new.update(dict.fromkeys([c for c in own if c not in known]))
        lone, plain = [], []
        for chunk in new:
            word = chunk[1:] if chunk[:1] == " " else chunk
            if word and not word[0].isspace() and not word[-1].isspace():
                (plain if chunk[0] == " " else lone).append(chunk)
        new.update(zip(plain, self._joined(plain), strict=True))
        new.update(zip(lone, self._whole(lone), strict=True))
        out: list[bytes] = []
        rest = []
        for i, own in enumerate(parts):
            try:
                out.append(b"".join([known[c] if c in known else new[c] for c in own]))
            except TypeError:  # a chunk that can't stand alone
                out.append(b"")
                rest.append(i)
        for i, ids in zip(rest, self._whole([texts[i] for i in rest]), strict=True):
            out[i] = ids
        if len(known) > CACHE:
            known.clear()
        known.update((c, ids) for c, ids in new.items() if len(c) <= CACHE_CHARS)
        return [np.frombuffer(x, np.int32) for x in out]

    def offsets(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each token: first code point, last code point + 1, and whether
        the token begins or ends inside a character."""
        if not len(ids):
            none = np.zeros(0, np.int64)
            return none, none, none.astype(bool)
        raw = np.frombuffer(text.encode(), np.uint8)
        first = (raw & 0xC0) != 0x80
        char_of = np.cumsum(first) - 1
        stop = np.cumsum(self.token_length[ids])
        start = stop - self.token_length[ids]
        edge = np.append(first, True)
        return char_of[start], char_of[stop - 1] + 1, ~(edge[start] & edge[stop])

    def decode_bytes(self, ids) -> bytes:
        """The bytes that the ids stand for."""
        return b"".join(map(self.token_bytes.__getitem__, ids.tolist() if isinstance(ids, np.ndarray) else ids))

    def decode(self, ids, errors: str = "replace") -> str:
        """The text of any run of ids. Characters split over tokens are joined
        before decoding; what a cut run leaves of a character is replaced."""
        return self.decode_bytes(ids).decode("utf-8", errors)

    def pieces(self, ids) -> list[str]:
        """The text of each token; a character split over tokens belongs to the
        token that completes it, those before get an empty string for it."""
        import codecs

        decoder = codecs.getincrementaldecoder("utf-8")("replace")
        return [decoder.decode(self.token_bytes[i]) for i in ids]


@lru_cache(maxsize=2)
def loaded(path: str, pattern: str) -> ByteBPE:
    """The vocabulary, once per Python process."""
    return ByteBPE(path, pattern)


def production_vocabulary() -> tuple[str, str]:
    """Path and split pattern of the production vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def encode(docs: DataFrame, path: str, pattern: str, *, text_col: str = "text", keep: Sequence[str] = (), offsets: bool = False) -> DataFrame:
    """The ``keep`` columns with ``ids``, and with ``starts, stops`` (code
    points) if ``offsets``. One row per input row, in place, no shuffle. Null
    texts are empty and have no ids. Kept columns must not be named like these."""
    arrow_batches(docs.sparkSession)
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], whole_text(f"`{text_col}`").alias("__bpe_text"))
    fields = [f for f in rows.schema.fields if f.name != "__bpe_text"]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + (", " if fields else "") + "ids array<int>" + (", starts array<int>, stops array<int>" if offsets else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path, pattern)
        for batch in batches:
            texts = batch.column("__bpe_text").to_pylist()
            ids = bpe.encode(texts)
            columns = [(n, batch.column(n)) for n in batch.schema.names if n != "__bpe_text"] + [("ids", lists(ids))]
            if offsets:
                spans = [bpe.offsets(t, i) for t, i in zip(texts, ids, strict=True)]
                columns += [("starts", lists([s[0] for s in spans])), ("stops", lists([s[1] for s in spans]))]
            yield pa.RecordBatch.from_arrays([c for _, c in columns], names=[n for n, _ in columns])

    return rows.mapInArrow(run, ddl)


def decode(tokens: DataFrame, path: str, pattern: str, *, keep: Sequence[str] = ()) -> DataFrame:
    """The ``keep`` columns with ``decoded``, the bytes of the ``ids``; null ids
    give empty bytes."""
    arrow_batches(tokens.sparkSession)
    rows = tokens.select(*[F.col(f"`{c}`") for c in keep], "ids")
    fields = [f for f in rows.schema.fields if f.name != "ids"]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + (", " if fields else "") + "decoded binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path, pattern)
        for batch in batches:
            data = pa.array([bpe.decode_bytes(x or ()) for x in batch.column("ids").to_pylist()], pa.binary())
            names = [n for n in batch.schema.names if n != "ids"]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], data], names=[*names, "decoded"])

    return rows.mapInArrow(run, ddl)


def lists(arrays: Sequence[np.ndarray]) -> pa.Array:
    """A list<int32> column of numpy arrays."""
    ends = np.cumsum([0, *[len(a) for a in arrays]]).astype(np.int32)
    flat = np.concatenate([np.zeros(0, np.int32), *arrays]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def round_trip(docs: DataFrame, path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode, map offsets, decode the ids again and give digests of both:
    ``n_tokens, ids_sha256, decoded_sha256, n_split`` (tokens that begin or end
    inside a character), ``offsets_ok`` (the spans tile the text)."""
    arrow_batches(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").alias("__bpe_id"), whole_text(f"`{text_col}`").alias("__bpe_text"))
    kind = rows.schema["__bpe_id"].dataType.simpleString()
    ddl = f"`{id_col}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string, n_split bigint, offsets_ok boolean"
    names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256", "n_split", "offsets_ok"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path, pattern)
        for batch in batches:
            texts = batch.column("__bpe_text").to_pylist()
            n, ids_sha, text_sha, split, tiled = [], [], [], [], []
            for text, ids in zip(texts, bpe.encode(texts), strict=True):
                numbers = ids.tolist()
                start, stop, cut = bpe.offsets(text, ids)
                n.append(len(numbers))
                ids_sha.append(hashlib.sha256(",".join(map(str, numbers)).encode()).hexdigest())
                text_sha.append(hashlib.sha256(bpe.decode_bytes(numbers)).hexdigest())
                split.append(int(cut.sum()))
                meets = start[1:] - stop[:-1]  # 0 between tokens, -1 where both share a character
                tiled.append(not len(ids) or bool(start[0] == 0 and stop[-1] == len(text) and ((meets == 0) | (meets == -1)).all()))
            yield pa.RecordBatch.from_arrays([batch.column("__bpe_id"), pa.array(n, pa.int64()), pa.array(ids_sha), pa.array(text_sha), pa.array(split, pa.int64()), pa.array(tiled, pa.bool_())], names=names)

    return rows.mapInArrow(run, ddl)


def op7_byte_bpe(spark, sf_dir: str) -> DataFrame:
    """Every whole document encoded and decoded with the production vocabulary."""
    return round_trip(table(spark, sf_dir, "documents"), *production_vocabulary())


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the token ids of every document."""
    tokens = encode(docs, *production_vocabulary(), keep=("doc_id", "source"))
    return tokens.withColumn("n_tokens", F.size("ids").cast("long"))
