import random
import re
from collections import Counter

import numpy as np

from quire.llm import quality_rules as Q

from .helpers import docs, rows_of, table


def base(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    runs = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {k for i in range(len(words) - 4) if runs[tuple(words[i : i + 5])] > 1 for k in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_statistics_match_brute_force(spark):
    rng = random.Random(5)
    texts = [None, "", " \t\n", "a", "a b c d e", "a b c d e a b c d e", "x " * 3000, "é🙂 #|<> *$%&", "l\nl\nl \n\n \n", "w w \x1c y\x0bz", "q" * 100_000]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randrange(200))) for _ in range(60)]
    texts += ["\n".join(rng.choice(["one two three", "four", "", "# x"]) for _ in range(30)) for _ in range(20)]
    d = docs(spark, list(enumerate(texts))).withColumn("n_words", Q.F.lit("clash"))
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in Q.statistics(d).collect()}
    assert got == {i: base(t) for i, t in enumerate(texts)}


def test_chi_square():
    assert abs(Q.chi2_tail(9.487729, 4) - 0.05) < 1e-6 and abs(Q.chi2_point(0.05, 4) - 9.487729) < 1e-5
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200_000, 4))
    near = x[(x * x).sum(axis=1) <= Q.chi2_point(0.25, 4)]
    assert abs(Q.consistency(0.75) * near.var(axis=0).mean() - 1) < 0.02


def test_estimates_resist_outliers(spark):
    """A third of a group lies far off: centre and scatter are those of the rest."""
    rng = np.random.default_rng(1)
    mix = np.array([[0.3, 0, 0, 0], [0.2, 0.4, 0, 0], [0, 0.1, 0.5, 0], [0.1, 0, 0, 0.6]])
    good = rng.normal(size=(1500, 4)) @ mix.T + [1, 2, 3, 4]
    bad = rng.normal(size=(350, 4)) * 0.1 + [9, 2, 3, 4]
    rows = [("g", *map(float, r)) for r in np.concatenate([good, bad])]
    found = Q.estimates(spark.createDataFrame(rows, "k string, x0 double, x1 double, x2 double, x3 double")).first()
    assert np.allclose([found[f"m{i}"] for i in range(4)], [1, 2, 3, 4], atol=0.06)
    inverse = np.array([[found[f"v{i}{j}"] if j <= i else 0 for j in range(4)] for i in range(4)])
    scatter = np.linalg.inv(inverse.T @ inverse)
    assert np.allclose(scatter, mix @ mix.T + np.diag(np.square(Q.FLOOR)), atol=0.06)


def test_edge_rows(spark):
    rows = [(i, "some clean words here and a few more of them now " * 1 + str(i), "en", "a", 1) for i in range(80)]
    rows += [(100, None, None, None, None), (101, "", "en", "a", 0), (102, "few words that are on their own in a group alone", "xx", None, 1), (1, rows[1][1], "en", "a", 1)]
    rows += [(103, "### %%% $$$ " * 40 + " ".join(map(str, range(400))), "en", "a", 1)]
    d = docs(spark, rows).withColumn("k", Q.F.lit(1)).withColumn("kept", Q.F.lit(1))
    got = {}
    for r in Q.judge(d).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert sum(map(len, got.values())) == len(rows) and len(got[1]) == 2
    assert not got[100][0]["kept"] and not got[101][0]["kept"]
    assert got[102][0]["kept"] and got[102][0]["distance"] is None
    assert all(got[i][0]["kept"] for i in range(80)) and not got[103][0]["kept"]
    assert Q.judge(d.limit(0)).count() == 0


def test_query_keeps_clean_documents(spark, sf):
    big = sf.replace("0.001", "0.01")
    texts = {r["doc_id"]: r["text"] for r in table(big, "documents")}
    quality = {r["doc_id"]: r["quality"] for r in table(big, "labels")}
    got = {r["doc_id"]: r for r in Q.op6_quality_rules(spark, big).collect()}
    assert {i: tuple(r[c] for c in COLUMNS) for i, r in got.items()} == {i: base(t) for i, t in texts.items()}
    assert not any(r["kept"] and r["base_failed"] for r in got.values())
    clean = [got[i] for i, q in quality.items() if q == 1 and not got[i]["base_failed"]]
    junk = [got[i] for i, q in quality.items() if q == 0 and not got[i]["base_failed"]]
    assert sum(r["kept"] for r in clean) > 0.99 * len(clean)
    assert sum(r["kept"] for r in junk) < 0.5 * len(junk)


def test_many_groups_are_joined_in_parts(spark, sf, monkeypatch):
    one = sorted(map(tuple, Q.op6_quality_rules(spark, sf).collect()))
    monkeypatch.setattr(Q, "BROADCAST_GROUPS", 0)
    many = Q.op6_quality_rules(spark, sf)
    assert "__salt" in many._jdf.queryExecution().toString() and sorted(map(tuple, many.collect())) == one


def test_no_python_in_plan(spark, sf):
    plan = Q.op6_quality_rules(spark, sf)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_columns_of_the_input_stay(spark):
    rows = [(i, "good words in a line that says something here today " * 2, "en", "s", 7) for i in range(60)]
    d = docs(spark, rows)
    plain = rows_of(Q.judge(d))
    names = ("k", "n", "x0", "m0", "logdet", "start", "bin", "__own", "c00")
    out = Q.judge(d.withColumns({name: Q.F.col("doc_id") + 1000 for name in names}))
    assert all(r[name] == r["doc_id"] + 1000 for r in out.collect() for name in names)
    assert rows_of(out.drop(*names)) == plain
    assert rows_of(Q.judge(d.withColumn("kept", Q.F.lit("mine")).withColumn("n_words", Q.F.lit(1)))) == plain


def vector(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines):
    return [np.log((word_chars + 250) / (n_words + 50)), np.sqrt(n_symbols / (word_chars + 200)), np.sqrt(n_dup_lines / (n_lines + 10)), np.sqrt(n_repeat_words / (n_words + 100))]


def far(x, centre, scatter):
    d = x - centre
    return np.einsum("ij,ij->i", d, np.linalg.solve(scatter, d.T).T)


def fitted(x, scale):
    return x.mean(axis=0), scale * np.cov(x.T, bias=True) + np.diag(np.square(Q.FLOOR))


def grid_median(v):
    cells = np.sort(np.floor(v * Q.GRID))
    return (cells[-(-len(cells) // 2) - 1] + 0.5) / Q.GRID


def mcd(x):
    """Centre and scatter of one group, over plain matrices."""
    mids = np.array([grid_median(v) for v in x.T])
    mads = np.array([grid_median(abs(v - m)) for v, m in zip(x.T, mids, strict=True)])
    ends = []
    for centre, scatter in (fitted(x, 1.0), (mids, np.diag((1.4826 * mads) ** 2 + np.square(Q.FLOOR)))):
        for _ in range(Q.STEPS):
            bins = np.floor(np.log(far(x, centre, scatter) + 1e-9) * Q.BINS)
            edge = np.sort(bins)[int(np.ceil(Q.SUPPORT * len(x))) - 1]
            centre, scatter = fitted(x[bins <= edge], Q.consistency(Q.SUPPORT))
        ends.append((np.linalg.slogdet(scatter)[1], centre, scatter))
    _, centre, scatter = min(ends, key=lambda e: e[0])
    return fitted(x[far(x, centre, scatter) <= Q.chi2_point(0.025, 4)], Q.consistency(0.975))


def test_query_matches_brute_force(spark, sf):
    """Groups, estimates, distances and verdicts of every document, worked out anew."""
    for where in (sf, sf.replace("0.001", "0.01")):
        rows = table(where, "documents")
        made = {}
        for r in rows:
            lines = [x for x in (r["text"] or "").split("\n") if re.search("[^\x20\x09-\x0d]", x)]
            *counts, failed = base(r["text"])
            made[r["doc_id"]] = vector(*counts, len(lines)), failed
        own, langs = Counter((r["lang"], r["source"]) for r in rows), Counter()
        for (lang, _), n in own.items():
            langs[lang] += n if n < Q.MIN_GROUP else 0
        members = {}
        for r in rows:
            key = (r["lang"], r["source"])
            if own[key] < Q.MIN_GROUP:
                key = r["lang"] if langs[r["lang"]] >= Q.MIN_GROUP else None
            members.setdefault(key, []).append(r["doc_id"])
        want = {}
        for key, ids in members.items():
            x = np.array([made[i][0] for i in ids])
            good = np.array([not made[i][1] for i in ids])
            distances = far(x, *mcd(x[good])) if key is not None and good.any() else [None] * len(ids)
            want |= dict(zip(ids, distances, strict=True))
        got = {r["doc_id"]: r for r in Q.op6_quality_rules(spark, where).collect()}
        assert len(got) == len(rows) and sum(d is not None for d in want.values()) > len(rows) / 2
        cut = Q.chi2_point(Q.TAIL, 4)
        for i, d in want.items():
            if d is None:
                assert got[i]["distance"] is None and got[i]["kept"] == (not made[i][1])
                continue
            assert abs(got[i]["distance"] - d) <= 1e-3 + 1e-6 * d, (i, got[i]["distance"], d)
            if abs(d - cut) > 1e-3:
                assert got[i]["kept"] == (not made[i][1] and d <= cut)
