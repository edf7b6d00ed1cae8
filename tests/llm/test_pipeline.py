"""The pipeline against a brute-force version, stage by stage."""

from collections import Counter

import corpus_pipeline
from quire.llm import langid, mixing, neardup, quality_cnn
from quire.llm import secrets as S
from quire.llm.bpe import ByteBPE, production_vocabulary

from .helpers import table
from .test_mixing import expected
from .test_neardup import classes


def test_stages(spark, sf):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5 and corpus_pipeline.ORACLE_SQL is None
    rows = {r["doc_id"]: r for r in table(sf, "documents")}
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    net = quality_cnn.learn(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    ids = sorted(rows)
    keep = [i for i, p in zip(ids, quality_cnn.score(net, [rows[i]["text"] or "" for i in ids])) if p >= 0.5]
    group = classes([rows[i]["text"] for i in keep])
    keep = [i for k, i in enumerate(keep) if group[k] == k]
    ready = [(r, __import__("re").compile(r.pattern, r.flags)) for r in S.RULES]
    texts = {}
    for i in keep:
        text, at, out = rows[i]["text"], 0, ""
        order = [r.kind for r in S.RULES]
        for s in sorted(S.find_spans(text, ready), key=lambda s: (s["start"], -s["stop"], order.index(s["kind"]))):
            if s["start"] >= at:
                out += text[at : s["start"]] + f"<{s['kind']}>"
                at = s["stop"]
        texts[i] = out + text[at:]
    copies = expected([(i, texts[i], None, rows[i]["source"], 0) for i in keep], mixing.DEFAULT_WEIGHTS, lambda r: len(r[1]))
    bpe = ByteBPE(*production_vocabulary())
    want = Counter()
    for (i, _), n in copies.items():
        want[i, tuple(bpe.encode([texts[i]])[0].tolist())] += n
    got = Counter((r["doc_id"], tuple(r["ids"])) for r in corpus_pipeline.run(spark, sf).collect())
    assert got == want and neardup.THRESHOLD == 0.8 and langid.FOLDS == 5
