import hashlib
import random

from quire.llm import fingerprint as P

from .helpers import docs, table


def brute(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1] or ""))
    out = []
    for k, (i, t) in enumerate(rows):
        t, nxt = t or "", rows[(k + 1) % len(rows)][1] or ""
        h = len(t) // 2
        e = t[: len(t) - h] + nxt[:h]
        f = [P.canonical(x) for x in (t, e, nxt)]
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), P.digest(f[0].encode()), P.digest(f[1].encode()), float(f[0] == f[1]), float(f[0] == f[2])))
    return sorted(out, key=repr)


def test_canonical():
    assert P.canonical(" Ｆｕｌｌ  ﬁne\n\tSTRASSE ") == P.canonical("full FINE straße")
    assert P.canonical("é") == P.canonical("É") and P.canonical("") == P.canonical(" \n") == ""
    assert P.canonical("a b") != P.canonical("ab")


def test_matches_brute_force_for_any_partitioning(spark):
    rng = random.Random(3)
    rows = [(rng.randrange(10**6) * 3, rng.choice(["A  b", "a b", "", None, "é" * 50, "x y z " * rng.randrange(40), "q" * 30_000])) for _ in range(120)]
    rows += [(None, "n"), (None, None), (7, "tie one"), (7, "tie two"), (7, "tie one")]
    for parts in (1, 2, 5, 40):
        got = P.compare_successive(docs(spark, rows).withColumn("fingerprint", P.F.lit(0)), parts=parts)
        assert sorted(map(tuple, got.collect()), key=repr) == brute(rows), parts


def test_small_tables(spark):
    assert P.compare_successive(docs(spark, [])).count() == 0
    one = [(3, "Only one")]
    assert list(map(tuple, P.compare_successive(docs(spark, one)).collect())) == brute(one)


def test_clashing_forms_get_different_fingerprints(spark):
    rows = [(1, "f", b"one"), (2, "f", b"one"), (3, "f", b"two"), (4, "g", None), (5, "f", b"two")]
    got = {r["id"]: r["fingerprint"] for r in P.settled(spark.createDataFrame(rows, "id bigint, fingerprint string, form binary")).collect()}
    assert got[1] == got[2] == "f" and got[4] == "g"
    assert got[3] == got[5] == "f-" + hashlib.sha256(b"two").hexdigest()


def test_classes(spark):
    got = {r["doc_id"]: r["class_id"] for r in P.duplicate_classes(docs(spark, [(4, "A b"), (2, "a  B"), (9, "c"), (5, None), (6, "")])).collect()}
    assert got == {4: 2, 2: 2, 9: 9, 5: 5, 6: 5}


def test_query_on_table(spark, sf):
    want = brute([(r["doc_id"], r["text"]) for r in table(sf, "documents")])
    assert sorted(map(tuple, P.op8_fingerprints(spark, sf).collect()), key=repr) == want


def test_ids_that_are_no_numbers(spark):
    rows = [(f"doc-{i:03d}", f"text {i % 7} " * (i % 5)) for i in range(60)] + [(None, "x"), ("doc-", "y"), ("doc-059z", None)]
    d = spark.createDataFrame(rows, "doc_id string, text string").repartition(3)
    got = {r["doc_id"]: r for r in P.compare_successive(d, parts=5).collect()}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or ""))
    assert len(got) == len(rows)
    for (i, t), (_, nxt) in zip(order, order[1:] + order[:1]):
        t, nxt = t or "", nxt or ""
        assert got[i]["edited_sha256"] == hashlib.sha256(P.edited(t, nxt).encode()).hexdigest()
