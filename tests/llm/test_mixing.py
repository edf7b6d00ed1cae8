import hashlib
import math
import statistics
from collections import Counter

import pytest

from quire.llm import mixing as M

from .helpers import docs, same_as_sql


def poisson(rate, u):
    k, p = 0, math.exp(-rate)
    total = p
    while total <= u:
        k += 1
        p *= rate / k
        total += p
    return k


def expected(rows, weights, size, seed=M.SEED):
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += size(r)
    left, free = max(0.0, 1 - sum(weights.values())), [s for s in sizes if s not in weights]
    share = {s: weights.get(s, left / max(1, len(free))) for s in sizes}
    norm, total = sum(share.values()), sum(sizes.values())
    out = Counter()
    for r in rows:
        u = int(hashlib.md5(f"{seed}|{'' if r[0] is None else r[0]}".encode()).hexdigest()[:13], 16) / 2**52
        rate = total * share[r[3]] / norm / sizes[r[3]] if sizes[r[3]] else 0.0
        out[r[0], r[3]] += poisson(rate, u)
    return +out


def test_counts_match_brute_force(spark):
    rows = [(i, f"text {i}", "en", f"s{i % 7 if i % 3 else 0}", 5) for i in range(400)]
    rows += [(None, None, None, None, None), (3, "again", "en", "s3", 5), (3, "again", "en", "s3", 5), (900, "", "en", "tiny", 0), (901, "z" * 100_000, "en", "long", 1)]
    d = docs(spark, rows).withColumn("copy", M.F.lit("old"))
    for weights in ({"s0": 0.1, "absent": 0.2}, {}, {"s0": 0.5, "s1": 0.5}):
        got = Counter((r["doc_id"], r["source"]) for r in M.replicate(d, weights).collect())
        assert got == expected(rows, weights, lambda r: 1)
    copies = [(r["doc_id"], r["copy"]) for r in M.replicate(d, {"tiny": 0.3}, total=1000.0).where("source = 'tiny'").collect()]
    assert sorted(c for _, c in copies) == list(range(len(copies))) and len(copies) > 200
    assert M.replicate(d.limit(0)).count() == 0


def test_rates_that_underflow_are_refused(spark):
    with pytest.raises(Exception, match="repetition rate"):
        M.replicate(docs(spark, [(1, "a")]), total=1000.0).collect()


def hashed(*keys):
    return int(hashlib.md5("|".join(map(str, (M.SEED, *keys))).encode()).hexdigest()[:13], 16) / 2**52


def by_pieces(rate, id_):
    m = 1 if rate < 700 else math.ceil(rate / 500)
    return sum(poisson(rate / m, hashed(id_, *([i] if i else []))) for i in range(m))


def test_rare_and_null_sources_are_repeated_in_full(spark, tmp_path):
    for i, rows in enumerate(([(1, "a" * 5000, None, "big", 0), (2, "abc", None, "tiny", 0)], [(1, "a" * 30_000, None, "src0", 0), (2, "b" * 9000, None, "src1", 0), (3, "cd", None, None, 0), (4, "e", None, None, 0)])):
        docs(spark, rows).coalesce(1).write.parquet(f"file://{tmp_path}/{i}/documents.parquet")
        size = Counter()
        for r in rows:
            size[r[3]] += len(r[1])
        total, free = sum(size.values()), len(size) - ("src0" in size)
        rate = {s: total * (0.1 if s == "src0" else 0.9 / free) / (1.0 if "src0" in size else 0.9) / size[s] for s in size}
        assert max(rate.values()) > 830
        want = {r[0]: by_pieces(rate[r[3]], r[0]) for r in rows}
        got = M.op10_mix_sources(spark, f"file://{tmp_path}/{i}").select("doc_id", "copy").collect()
        assert sorted(map(tuple, got)) == [(d, k) for d in sorted(want) for k in range(want[d])]
        assert M.stage(spark, docs(spark, rows), "").count() == len(got)


def test_large_rates_keep_the_distribution(spark):
    d = docs(spark, [(i, "x") for i in range(60)])
    counts = [r["count"] for r in M.replicate(d, total=120_000.0, below=None).groupBy("doc_id").count().collect()]
    assert abs(statistics.mean(counts) - 2000) < 5 * math.sqrt(2000 / 60) and 0.4 < statistics.variance(counts) / 2000 < 1.8


def test_mix_meets_targets_and_is_shuffled(spark, sf):
    docs_ = spark.read.parquet(sf.replace("0.001", "0.1") + "/documents.parquet")
    mixed = M.shuffled(M.replicate(docs_, {"src1": 0.3}), "doc_id", "copy").select("doc_id", "source").collect()
    share = sum(r["source"] == "src1" for r in mixed) / len(mixed)
    assert abs(share - 0.3) < 0.03
    assert abs(statistics.mean(r["doc_id"] for r in mixed[: len(mixed) // 2]) - statistics.mean(r["doc_id"] for r in mixed[len(mixed) // 2 :])) < 400


def test_query_matches_sql(spark, sf):
    same_as_sql(M.op10_mix_sources(spark, sf), M.ORACLE, sf)


def test_stage_keeps_columns(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet")
    assert M.stage(spark, d, sf).columns == d.columns
