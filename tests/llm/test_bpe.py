import base64
import hashlib
import random

import pytest
import tiktoken

from quire.llm import bpe as B

from .helpers import docs, table


@pytest.fixture(scope="module")
def both():
    path, pattern = B.production_vocabulary()
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return B.ByteBPE(path, pattern), tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


TEXTS = ["", " ", "a", "  a b  c ", "don't 'S they'll", "é漢字🙂 x", "a\x00b \x1c c", "tab\t two\n\nlines \n", "x" * 5000, "   y", "123 45a6", "<|endoftext|>"]


def test_same_ids_as_rank_encoder(both):
    own, reference = both
    rng = random.Random(4)
    texts = TEXTS + ["".join(rng.choice("ab ' \n\t\x1c.0é漢'sS") for _ in range(40)) for _ in range(3000)]
    for text, ids in zip(texts, own.encode(texts)):
        assert ids.tolist() == reference.encode_ordinary(text)
        assert own.decode(ids) == text and "".join(own.pieces(ids)) == text
    assert [x.tolist() for x in own.encode(texts)] == [reference.encode_ordinary(t) for t in texts]  # from the cache


def test_every_code_point(both):
    own, reference = both
    texts = [f"a{chr(c)}a 1{chr(c)}1 .{chr(c)}. {chr(c)}" for c in range(0x20, 0x30000, 7) if not 0xD800 <= c < 0xE000]
    assert [x.tolist() for x in own.encode(texts)] == [reference.encode_ordinary(t) for t in texts]


def test_offsets_and_split_characters(both):
    own, _ = both
    text = "é漢字🙂 x"
    ids = own.encode([text])[0]
    start, stop, cut = own.offsets(text, ids)
    assert start[0] == 0 and stop[-1] == len(text) and cut.any()
    for i, (a, b, c) in enumerate(zip(start, stop, cut)):
        if not c:
            assert own.decode(ids[i : i + 1]) == text[a:b]
    assert own.decode(ids[:2]).endswith("�") or not cut[1]
    assert own.pieces(ids)[-1] == " x"


def test_frames(spark, both):
    _, reference = both
    path, pattern = B.production_vocabulary()
    d = docs(spark, [*enumerate(TEXTS), (90, None), (90, None)]).withColumn("ids", B.F.lit(1))
    got = B.encode(d, path, pattern, keep=("doc_id",), offsets=True)
    rows = got.collect()
    assert len(rows) == len(TEXTS) + 2
    assert all(r["ids"] == (reference.encode_ordinary(TEXTS[r["doc_id"]]) if r["doc_id"] < 90 else []) for r in rows)
    back = B.decode(got, path, pattern, keep=("doc_id",)).collect()
    assert all(bytes(r["decoded"]).decode() == (TEXTS[r["doc_id"]] if r["doc_id"] < 90 else "") for r in back)
    assert B.encode(d.limit(0), path, pattern, keep=("doc_id",)).count() == 0


def test_query_on_table(spark, sf, both):
    _, reference = both
    texts = {r["doc_id"]: r["text"] or "" for r in table(sf, "documents")}
    got = B.op7_byte_bpe(spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = reference.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids) and r["offsets_ok"]
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
