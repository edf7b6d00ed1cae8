import zlib

import numpy as np

from quire.llm import quality_cnn as Q

from .helpers import docs, table


def test_gradients():
    rng = np.random.default_rng(0)
    net = Q.new_net(rng)
    for k, p in vars(net).items():
        if k != "constant":
            setattr(net, k, rng.normal(0, 0.3, p.shape))
    net.embed[0] = 0
    raw, y, w = [b"abc" * 300, b"", b"x!! y?" * 40, "é".encode() * 500], np.array([0, 1, 0, 1.0]), np.array([1, 2, 1, 1.0])
    grads = Q.gradients(net, raw, y, w)[1]
    for p, g in zip(net.params(), grads):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        old, e = p[at], 1e-5
        p[at] = old + e
        up = Q.gradients(net, raw, y, w)[0]
        p[at] = old - e
        down = Q.gradients(net, raw, y, w)[0]
        p[at] = old
        assert abs(g[at] - (up - down) / (2 * e)) < 1e-5


def test_pooling_covers_whole_text_and_matches_brute_force(monkeypatch):
    net = Q.new_net(np.random.default_rng(1))
    raw = [b"", b"a", bytes(range(1, 250)) * 9, b"q" * 5000 + b"!!!!!!!!"]
    pooled, n = Q.pool(net, raw)
    monkeypatch.setattr(Q, "PIECE", 256)  # cut into small pieces: the same
    assert np.allclose(pooled, Q.pool(net, raw)[0], atol=1e-5)
    flat = net.filters.reshape(2 * Q.BLOCK, Q.EMBED, Q.FILTERS)
    at = 0
    for r, k in zip(raw, n.tolist()):
        size = Q.BLOCK * Q.CELL
        cells = -(-(len(r) + Q.BLOCK) // size)
        r = r.ljust(cells * size, b"\0")
        windows = range(0, len(r) - Q.BLOCK, Q.BLOCK)
        out = np.array([[sum(net.embed[r[i + j]] @ flat[j] for j in range(2 * Q.BLOCK))] for i in windows])[:, 0] + net.bias
        want = np.maximum(out.max(axis=0), 0)
        assert np.allclose(pooled[at : at + k].max(axis=0), want, atol=1e-4)
        at += k
    assert abs(Q.score(net, ["q" * 5000 + "!" * 8])[0] - Q.score(net, ["q" * 5008])[0]) > 0


def test_degenerate_training():
    assert 0 <= Q.score(Q.train([], []), ["a"])[0] <= 1
    assert Q.score(Q.train(["a"] * 9, [1] * 9), ["", "b"]).tolist() == [1.0, 1.0]
    assert Q.score(Q.train(["a"] * 9, [0] * 9), ["b"])[0] < 0.5


def test_classify_keeps_rows(spark):
    net = Q.new_net(np.random.default_rng(1))
    d = docs(spark, [(1, "a"), (1, "a"), (2, None), (3, ""), (4, "z" * 200_000)]).withColumn("score", Q.F.lit("x"))
    got = Q.classify(d, net).collect()
    assert len(got) == 5 and all(0 <= r["score"] <= 1 for r in got)
    assert {r["score"] for r in got if r["doc_id"] in (2, 3)} == {Q.score(net, [""])[0]}
    assert Q.classify(d.limit(0), net).count() == 0


def test_held_out_quality(spark, sf):
    big = sf.replace("0.001", "0.1")
    truth = {r["doc_id"]: r["quality"] for r in table(big, "labels")}
    got = Q.op4_quality_cnn(spark, big).collect()
    assert len(got) == len(table(big, "documents"))
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) > 0.95 * len(held)
    good = [r for r in held if truth[r["doc_id"]] == 1]
    assert sum(r["predicted"] for r in good) > 0.98 * len(good)


def one_score(net, text):
    """A text's score by plain loops over its chunks."""
    size, raw = Q.BLOCK * Q.CELL, text.encode()
    cells = -(-(len(raw) + Q.BLOCK) // size)
    seen = net.embed[np.frombuffer(raw.ljust(cells * size, b"\0"), np.uint8)]
    windows = np.array([seen[a : a + 2 * Q.BLOCK].ravel() for a in range(0, len(seen) - Q.BLOCK, Q.BLOCK)])
    response = windows @ net.filters + net.bias
    hidden, at = [], 0
    while True:
        inside = response[at * Q.CELL : (at + Q.CELLS) * Q.CELL]
        hidden.append(np.tanh(np.maximum(inside.max(axis=0), 0) @ net.hidden + net.hidden_bias))
        if at + Q.CELLS >= cells:
            break
        at += Q.STEP
    logit = np.concatenate([np.mean(hidden, axis=0), np.max(hidden, axis=0)]) @ net.out + net.out_bias[0]
    return 1 / (1 + np.exp(-float(logit)))


def test_query_matches_brute_force(spark, sf):
    """Sample, weights and every text's score, worked out anew from the tables."""
    texts = {r["doc_id"]: r["text"] for r in table(sf, "documents")}
    marks = {r["doc_id"]: r["quality"] for r in table(sf, "labels") if r["quality"] in (0, 1) and zlib.crc32(str(r["doc_id"]).encode()) % 3 != 1}
    assert all(sum(m == q for m in marks.values()) <= Q.SAMPLE_EACH for q in (0, 1))  # all are learned, each with weight 1
    ids = sorted(i for i in marks if texts.get(i) is not None and len(texts[i]) <= Q.SAMPLE_CHARS)
    net = Q.train([texts[i] for i in ids], [marks[i] for i in ids], [1.0] * len(ids))
    got = {r["doc_id"]: r for r in Q.op4_quality_cnn(spark, sf).collect()}
    assert got.keys() == texts.keys()
    for i, text in texts.items():
        want = one_score(net, text or "")
        assert abs(got[i]["score"] - want) < 1e-3 and got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert got[i]["predicted"] == int(got[i]["score"] >= 0.5)
