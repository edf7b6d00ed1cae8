import hashlib
import itertools
import unicodedata
import zlib
from collections import Counter

import numpy as np

from quire.llm import langid as L

from .helpers import docs, table

EN, FR = "the house that was over there and with the other thing ", "le chat est sur une table avec les autres chiens "
RU, EL = "дом который был там и другая вещь ", "το σπίτι που ήταν εκεί και το άλλο "


def model():
    texts = [t * 20 for t in (EN, FR, RU, EL)] * 3
    return L.train(texts, ["en", "fr", "ru", "el"] * 3)


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(2)
    for _ in range(40):
        s = rng.normal(0, 3, (6, 3))
        best = max(itertools.product(range(3), repeat=6), key=lambda p: sum(s[i, k] for i, k in enumerate(p)) - 2.0 * sum(a != b for a, b in zip(p, p[1:])))
        assert L.viterbi(s, 2.0).tolist() == list(best)


def test_shortcut_equals_full_decoding():
    rng = np.random.default_rng(3)
    doc = np.sort(rng.integers(0, 60, 900))
    s = rng.normal(0, 2, (900, 4)) + 2.5 * np.eye(4)[(doc + np.arange(900) // 37) % 4]
    got, _ = L.label_words(s, doc, 60, 6.0)
    for d in set(doc.tolist()):
        own = s[doc == d]
        value = lambda p: own[np.arange(len(p)), p].sum() - 6.0 * (np.diff(p) != 0).sum()  # noqa: B023, E731
        assert abs(value(got[doc == d]) - value(L.viterbi(own, 6.0))) < 1e-9


def test_short_texts_get_the_best_path():
    got, _ = L.label_words(np.array([[0.0, 10, -20], [0, -20, 10]]), np.zeros(2, np.int64), 1, 14.0)
    assert got.tolist() == [1, 2]
    rng = np.random.default_rng(5)
    doc = np.repeat(np.arange(600), rng.integers(1, 6, 600))
    s = rng.normal(0, 9, (len(doc), 3)) * [0.2, 1, 1]
    got, _ = L.label_words(s, doc, 600, 14.0)
    for d in range(600):
        own = s[doc == d]
        value = lambda p: sum(own[i, k] for i, k in enumerate(p)) - 14.0 * sum(a != b for a, b in zip(p, p[1:]))  # noqa: B023, E731
        assert abs(value(got[doc == d].tolist()) - max(map(value, itertools.product(range(3), repeat=len(own))))) < 1e-9


def test_words_and_spans():
    text = "É1 x" + EN * 8 + "🙂 " + RU * 8
    w = L.split_words([text, "", "123", "ab"])
    assert [(int(a), int(b)) for a, b, d in zip(w.start, w.stop, w.doc) if d == 0][:2] == [(0, 1), (3, 7)]
    assert set(w.doc.tolist()) == {0, 3}
    spans = L.spans_of(model(), [text, "", "123"])
    assert [s["lang"] for s in spans[0]] == ["en", "ru"] and spans[1] == spans[2] == []
    assert text[spans[0][1]["start"] : spans[0][1]["stop"]] == (RU * 8).strip()


def test_prediction_edge_cases():
    m = model()
    got = L.predict(m, [FR, "", "123 !", EN * 3000, "漢字", RU, EL])
    assert [g[0] for g in got][:4] == ["fr", "und", "und", "en"] and [g[0] for g in got][5:] == ["ru", "el"]
    assert got[1][1] == 0 and all(0 <= g[1] <= 1 for g in got)
    empty = L.train([], [])
    assert L.predict(empty, ["a"]) == [("und", 0.0)]


def test_identify_keeps_rows(spark):
    d = docs(spark, [(1, EN), (1, EN), (2, None), (3, "")]).withColumn("score", L.F.lit(9.0))
    got = sorted((r["doc_id"], r["lang_pred"]) for r in L.identify(d, model(), spans=True).collect())
    assert got == [(1, "en"), (1, "en"), (2, "und"), (3, "und")]
    assert L.identify(d.limit(0), model()).count() == 0


def test_any_number_of_languages(spark):
    names = [f"l{i:02d}" for i in range(70)]
    rows = [(i * 100 + k, " ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26)}{chr(97 + (i + j) % 26)}" for j in range(40)), n, "s", 0) for i, n in enumerate(names) for k in range(4)]
    model = L.learn(docs(spark, rows))
    assert model.langs == names and model.scores.size <= L.MODEL_SCORES
    got = L.predict(model, [r[1] for r in rows])
    assert sum(g[0] == r[2] for g, r in zip(got, rows)) > 0.95 * len(rows)
    assert L.predict(model, [rows[0][1] * 3000])[0][0] == "l00"


def test_combining_marks_and_clashing_names(spark):
    import unicodedata

    nfd = unicodedata.normalize("NFD", "cafés élève\u0301")
    w = L.split_words([nfd, "\u0301a"])
    assert [nfd[a:b] for a, b, d in zip(w.start, w.stop, w.doc) if d == 0] == nfd.split()
    m = model()
    assert L.predict(m, [unicodedata.normalize("NFD", FR + "été")]) == L.predict(m, [FR + "été"])
    d = docs(spark, [(1, EN)]).withColumn("score", L.F.lit(9.0))
    assert L.identify(d, m, keep=("doc_id", "score")).columns == ["doc_id", "lang_pred", "score"]


def test_scripts_narrow_the_languages():
    words = L.split_words(["дом the"])
    m = model()
    scores = m.word_scores(words)
    ru, latin = m.langs.index("ru"), [m.langs.index(x) for x in ("en", "fr")]
    assert scores[0].argmax() == ru and scores[1].argmax() in latin
    assert all(scores[0, k] < scores[0, ru] - 500 for k in range(4) if k != ru) and scores[1, ru] < -500


def test_held_out_accuracy(spark, sf):
    big = sf.replace("0.001", "0.01")
    truth = {r["doc_id"]: r["lang"] for r in table(big, "documents")}
    got = L.op3_language_id(spark, big).collect()
    assert len(got) == len(truth)
    held = [r for r in got if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0}
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) > 0.97 * len(held)


def test_query_matches_brute_force(spark, sf):
    """The sample drawn anew, and each text alone: every word's scores, the best path by full decoding, shares, score."""
    rows = [r for r in table(sf, "documents")]
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    learn = [r for r in rows if not held(r["doc_id"]) and r["text"] is not None and r["lang"] is not None]
    sizes = Counter(r["lang"] for r in learn)
    each, drawn = L.SAMPLE_DOCS // len(sizes), []
    for lang, n in sizes.items():
        order = {r["doc_id"]: int(hashlib.md5(str(r["doc_id"]).encode()).hexdigest()[:12], 16) / 2**48 for r in learn if r["lang"] == lang}
        mine = sorted((order[r["doc_id"]], r["doc_id"], r["text"]) for r in learn if r["lang"] == lang and len(r["text"]) <= L.SAMPLE_CHARS)
        drawn += [(t, lang) for o, _, t in mine if o < min(1, (1.6 * each + 8) / n)][:each]
    drawn.sort()
    model = L.train([t for t, _ in drawn], [lang for _, lang in drawn])
    got = {r["doc_id"]: r for r in L.op3_language_id(spark, sf).collect()}
    assert len(got) == len(rows)
    for r in rows:
        words = L.split_words([unicodedata.normalize("NFC", r["text"] or "")])
        row = got[r["doc_id"]]
        assert row["held_out"] == held(r["doc_id"])
        lengths = np.diff(np.append(words.first, len(words.codes)))
        if not len(lengths):
            assert (row["lang_pred"], row["score"]) == ("und", 0.0)
            continue
        scores = model.word_scores(words)
        path = L.viterbi(scores, L.SWITCH)
        shares = np.array([lengths[path == k].sum() for k in range(len(model.langs))], float)
        lead = shares.copy()
        lead[path[0]] += model.lead * shares.sum()
        k = int(lead.argmax())
        sums = scores.sum(axis=0)
        margin = np.clip(sums[k] - max(np.delete(sums, k)), -30, 30)
        assert row["lang_pred"] == model.langs[k]
        assert abs(row["score"] - shares[k] / shares.sum() / (1 + np.exp(-margin))) < 1e-3
