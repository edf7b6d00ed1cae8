import random
import re
from collections import Counter

import numpy as np

from quire.llm import components as C
from quire.llm import dartminhash as D
from quire.llm import neardup as N

from .helpers import docs, table

rng = random.Random(7)
VOCABULARY = [f"w{i}" for i in range(500)]


def counted(text, size=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if not words:
        return Counter()
    return Counter(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def jaccard(a, b):
    shared = sum((a & b).values())
    return shared / (sum(a.values()) + sum(b.values()) - shared) if a and b else 0.0


def classes(texts, threshold=0.8):
    """Brute force: {index: smallest index of its class}."""
    grams, root = [counted(t) for t in texts], list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if jaccard(grams[i], grams[j]) >= threshold:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in range(len(texts))}


def sentence(n):
    return [rng.choice(VOCABULARY) for _ in range(n)]


def edited(words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = rng.choice(VOCABULARY)
    return words


def test_shingles_match_brute_force():
    texts = ["", " \t\n", "a b", " a  b ", "é 漢 x y z w", "a b " * 9, "x" * 5000 + " y", " ".join(sentence(3000))]
    s = D.shingles([t.encode() for t in texts])
    for i, t in enumerate(texts):
        assert sorted(counted(t).values()) == sorted(s.count[s.bounds[i] : s.bounds[i + 1]].tolist())
    assert s.digests[2] == s.digests[3] and s.digests[0] == s.digests[1] != s.digests[2]
    for i in range(len(texts)):
        for j in range(len(texts)):
            assert abs(D.similarity(s, i, s, j)[0] - jaccard(counted(texts[i]), counted(texts[j]))) < 1e-12
    # a text's result doesn't depend on its neighbours
    for i, t in enumerate(texts):
        alone = D.shingles([t.encode()])
        assert np.array_equal(D.signatures(alone, 50)[0], D.signatures(s, 50)[i])


def test_signatures_estimate_weighted_similarity():
    for weights in ((1, 1, 6), (3, 9, 2), (1, 1, 1)):
        left = D.Shingles(np.arange(1, 4, dtype=np.uint64) << np.uint64(40), np.array(weights), np.array([0, 3]), np.array([3]), [b""])
        right = D.Shingles(np.arange(2, 6, dtype=np.uint64) << np.uint64(40), np.array([2, 5, 1, 1]), np.array([0, 4]), np.array([4]), [b""])
        same = np.mean([(D.signatures(left, 200, seed=s)[0] == D.signatures(right, 200, seed=s)[0]).mean() for s in range(30)])
        assert abs(same - D.similarity(left, 0, right, 0)[0]) < 0.02


def test_classes_match_brute_force(spark):
    base, other = sentence(120), sentence(40)
    texts = [" ".join(base)] * 4 + [" ".join(edited(base, k % 5)) for k in range(60)]
    texts += [" ".join(edited(other, k % 2)) for k in range(12)] + [" ".join(sentence(60)) for _ in range(30)]
    texts += ["a b c", "a  b\tc", "a b", "", None, " ", "one two three four five " * 30, "one two three four five " * 33, "x " * 40_000]
    chain = sentence(200)  # links only along a chain
    for _ in range(12):
        texts.append(" ".join(chain))
        chain = chain[18:] + sentence(18)
    rows = list(enumerate(texts))
    want = classes(texts)
    for i, t in rows:
        if not counted(t):
            want[i] = i
    got = {r["doc_id"]: r["class_id"] for r in N.near_duplicates(docs(spark, rows)).collect()}
    assert got == want


def test_members_that_stars_leave_apart_are_compared(spark):
    """One band only: the bucket's head is near none of the others, which are near each other."""
    met = []
    while len(met) < 5:  # until the head has enough others in its bucket
        base = sentence(100)
        far = edited(base, 8)
        texts = [" ".join(base)] + [" ".join(edited(far, k % 2)) + f" {k}" for k in range(12)] + [" ".join(sentence(50))] * 2
        sigs = [tuple(D.signatures(D.shingles([t.encode()]), 1)[0].tolist()) for t in texts]
        met = [i for i, s in enumerate(sigs) if s == sigs[0]]
    got = {r["doc_id"]: r["class_id"] for r in N.near_duplicates(docs(spark, list(enumerate(texts))), coordinates=1, rows=1).collect()}
    want = classes([texts[i] for i in met])
    assert len(set(want.values())) == 2
    assert [got[i] for i in met] == [met[want[k]] for k in range(len(met))]
    assert got[len(texts) - 1] == got[len(texts) - 2] == len(texts) - 2


def test_beyond_matches_counts():
    texts = ["a b c d e f g a b c d e f", "a b c d e f g h", "", "x " * 30, "x " * 12, "a b"]
    found = D.shingles([t.encode() for t in texts])
    for i, left in enumerate(texts):
        for j, right in enumerate(texts):
            same, size, own = D.beyond(found, i, found, j)
            a, b = counted(left), counted(right)
            assert abs(same - jaccard(a, b)) < 1e-12 and size == sum(a.values())
            assert len(own) == len(set(own.tolist())) == sum((a - b).values())


def test_meetings_lose_no_link(spark):
    """Members of one head, with edits, cuts, additions and repeats: every link between components is met."""
    head = sentence(80)
    texts = [" ".join(head)]
    for k in range(60):
        w = edited(head, 2 + k % 6)
        cut = rng.randrange(30)
        texts.append(" ".join([w[cut:], w[: 80 - cut], w + w[:cut], w[:40] + ["again"] * cut + w[40:]][k % 4]))
    texts += [" ".join(texts[k].split()[:-1] + ["end"]) for k in range(1, 20)]
    found = D.shingles([t.encode() for t in texts])
    rows = []
    for i in range(1, len(texts)):
        same, size, own = D.beyond(found, i, found, 0)
        rows.append((i, 0, same, size, own.tolist(), i, True))
    stars = spark.createDataFrame(rows, "a bigint, b bigint, similarity double, size bigint, own array<bigint>, root bigint, loose boolean")
    met = {tuple(sorted(r)) for r in N.meetings(stars, 0.8).collect()}
    links = {(j, i) for i in range(1, len(texts)) for j in range(1, i) if jaccard(counted(texts[i]), counted(texts[j])) >= 0.8}
    assert len(links) > 15 and links <= met
    assert len(met) < len(texts) * (len(texts) - 1) / 4


def generated(spark, made):
    """What ``made()`` yields, and the rows of the ``posexplode`` nodes of the plans that it ran."""
    store = spark._jsparkSession.sharedState().statusStore()
    before, out, rows = store.executionsCount(), made(), 0
    spark._jsc.sc().listenerBus().waitUntilEmpty()
    for k in range(before, store.executionsCount()):
        run = store.executionsList().apply(k).executionId()
        values, nodes = store.executionMetrics(run), store.planGraph(run).allNodes()
        for node in (nodes.apply(i) for i in range(nodes.size())):
            if "posexplode" in node.desc():
                found = [m for m in (node.metrics().apply(i) for i in range(node.metrics().size())) if m.name() == "number of output rows"]
                rows += sum(int(values.apply(m.accumulatorId()).replace(",", "")) for m in found if values.contains(m.accumulatorId()))
    return out, rows


def test_rows_of_the_index_do_not_depend_on_other_sizes(spark):
    """Members of one head, of sizes all alike and all different: each has rows for its own prefixes only."""
    shared = random.Random(3)
    for step in (0, 4):
        rows = [(i, 0, 0.7, 400 + step * i, shared.sample(range(1000), 150), i, i % 4 > 0) for i in range(1, 61)]
        stars = spark.createDataFrame(rows, "a bigint, b bigint, similarity double, size bigint, own array<bigint>, root bigint, loose boolean")
        met, made = generated(spark, lambda stars=stars: N.meetings(stars, 0.8).count())
        assert 0 < made <= sum(r[3] / 9 + 1 + (r[3] / 5 + 1) * (1 + r[6]) for r in rows)


def test_pairs_grow_with_the_cluster(spark, monkeypatch):
    """Copies of one text with edits of their own: comparisons are no square of their number."""
    made = {}
    for n in (150, 600):
        base = [f"b{i}" for i in range(150)]
        texts = [" ".join(f"e{n}-{k}-{i}" if i in where else w for i, w in enumerate(base)) for k in range(n) for where in [set(rng.sample(range(150), 1 + k % 6))]]
        seen = []
        real = N.compared
        monkeypatch.setattr(N, "compared", lambda pairs, t, real=real, seen=seen: (seen.append(pairs.count()), real(pairs, t))[1])
        got = {r["doc_id"]: r["class_id"] for r in N.near_duplicates(docs(spark, list(enumerate(texts)))).collect()}
        monkeypatch.setattr(N, "compared", real)
        made[n] = sum(seen)
        if n == 150:
            assert got == classes(texts)
    assert made[600] < 8 * made[150]


def test_stage_keeps_one_row_of_each(spark):
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (7, "k l m"), (7, "o p q"), (9, "a b c d  e f"), (None, "u v w x y z"), (None, "u  v w x y z"), (None, "other words"), (1, ""), (2, None)]
    d = docs(spark, rows)
    got = sorted(((r["doc_id"], " ".join((r["text"] or "").split())) for r in N.stage(spark, d, "").collect()), key=repr)
    kept7 = [t for i, t in got if i == 7]
    assert len(kept7) == 1
    assert got == sorted([(5, "a b c d e f"), (7, kept7[0]), (None, "u v w x y z"), (None, "other words"), (1, ""), (2, "")], key=repr)


def test_edge_rows(spark):
    d = docs(spark, [(5, "a b c d e f"), (5, "a b c d e f"), (9, "a b c d e f"), (None, "a b c d e f"), (None, None)]).withColumn("class_id", N.F.lit(0))
    got = sorted(((r["doc_id"], r["class_id"]) for r in N.near_duplicates(d).collect()), key=repr)
    assert got == sorted([(5, 5), (5, 5), (9, 5), (None, None), (None, None)], key=repr)
    assert N.near_duplicates(d.limit(0)).count() == 0


def test_components(spark):
    for links in ([], [(1, 1)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 30)] + [(50, 51), (51, 50), (52, 51)]):
        root = {}

        def find(x):
            while root.setdefault(x, x) != x:
                x = root[x]
            return x

        for a, b in links:
            if a != b:
                a, b = sorted((find(a), find(b)))
                root[b] = a
        got = {r["node"]: r["root"] for r in C.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
        assert got == {x: find(x) for x in root}


def test_query_on_table(spark, sf):
    rows = sorted(table(sf, "documents"), key=lambda r: r["doc_id"])
    want = classes([r["text"] for r in rows])
    got = {r["doc_id"]: r["class_id"] for r in N.op5_near_duplicates(spark, sf).collect()}
    assert got == {rows[i]["doc_id"]: rows[c]["doc_id"] for i, c in want.items()}
    kept = {r["doc_id"] for r in N.stage(spark, spark.read.parquet(f"{sf}/documents.parquet"), sf).collect()}
    assert kept == set(got.values())
