import random

import pytest

from quire.llm import urlfilter as U

from .helpers import rows_of, same_as_sql


def keys(spark, values):
    return spark.createDataFrame([(v,) for v in values], "key string")


def test_cascade_is_exact_over_its_universe(spark):
    rng = random.Random(1)
    universe = [f"k{i}" for i in range(4000)]
    listed = rng.sample(universe, 600) + ["elsewhere"]
    cascade = U.build(keys(spark, listed), keys(spark, [*universe, *universe[:50], None]))
    assert len(cascade.levels) > 1
    got = {r["key"] for r in keys(spark, universe).where(cascade.contains(U.F.col("key"))).collect()}
    assert got == set(listed) - {"elsewhere"}
    assert cascade.bits < 16 * 4000
    assert keys(spark, [None]).where(cascade.contains(U.F.col("key"))).count() == 0


def test_empty_list_and_size_check(spark):
    nothing = U.build(keys(spark, []), keys(spark, ["a"]))
    assert keys(spark, ["a"]).where(nothing.contains(U.F.col("key"))).count() == 0
    with pytest.raises(U.TooLarge):
        U.build(keys(spark, [str(i) for i in range(100)]), keys(spark, ["a"]), max_bits=64)


URLS = [
    (1, None, "none"), (2, "", "empty"), (3, "no scheme/en/", "x"), (4, "http://Example.COM/en/a?x#y", "a"), (5, "https://www.example.com/en/", "b"),
    (6, "https://a.www.example.com/en/z", "c"), (7, "http://example.com", "no path"), (8, "http://x.net/es/1", "d"), (9, "http://x.net/es", "e"),
    (10, "http://spam-farm.example.org/a", "f"), (11, "http://www.spam-farm.example.org", "g"), (12, "http://xspam-farm.example.org/", "h"),
    (13, "ftp://É.com/\n/x", "i"), (14, "a://b://c.com/", "j"), (15, "http://h?q=/en/", "k"), (15, "http://h?q=/en/", "k"), (16, "http://" + "a." * 3000 + "net/fr/", "l"),
]


def test_verdicts(spark):
    pages = spark.createDataFrame(URLS, "page_id bigint, url string, host string")
    listed = keys(spark, U.LISTED)
    out = U.judge(pages, U.RULES, listed)
    assert out.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
    got = {r["page_id"]: (r["host"][:20], r["path"], r["rule"], r["verdict"]) for r in out.collect()}
    assert out.count() == len(URLS)
    assert got[1] == got[2] == got[3] == ("", "", None, "allow")
    assert got[4] == ("example.com", "/en/a", "example.com/en/", "block")
    assert got[5][2:] == got[6][2:] == ("www.example.com/en/", "allow")
    assert got[7] == ("example.com", "", None, "allow")
    assert got[8][2:] == ("net/es/", "block") and got[9][2:] == (None, "allow")
    assert got[10][3] == got[11][3] == "block" and got[12][3] == "allow"
    assert got[13] == ("É.com", "/\n/x", "com/", "allow")
    assert got[14] == ("b:", "//c.com/", None, "allow")
    assert got[15] == ("h", "", None, "allow") and got[16][2:] == ("net/fr/", "block")
    # beyond the size check, the join gives the same
    wide = keys(spark, [*U.LISTED, *(f"n{i}" for i in range(2000))])
    assert rows_of(U.judge(pages, U.RULES, wide, max_bits=2048)) == rows_of(out)
    assert U.judge(pages.limit(0), U.RULES, listed).count() == 0


def test_shards_are_exact(spark):
    rng = random.Random(4)
    universe = [f"k{i}" for i in range(3000)]
    listed = rng.sample(universe, 700) + ["elsewhere"]
    cascade = U.build_sharded(keys(spark, [*listed, listed[0], None]), keys(spark, [*universe, None]), max_bits=1024)
    assert cascade.shards > 2 and len(cascade.levels) > 1
    assert all(bits < 4 * 1024 for bits, _, _ in cascade.levels)
    got = [r["key"] for r in cascade.listed(keys(spark, [*universe, universe[0], None])).collect()]
    assert sorted(got) == sorted(set(listed) - {"elsewhere"})
    assert U.build_sharded(keys(spark, []), keys(spark, ["a"])).listed(keys(spark, ["a"])).count() == 0


def test_long_rule_lists_and_ties(spark):
    pages = spark.createDataFrame(URLS, "page_id bigint, url string, host string")
    rules = [*U.RULES, *(U.Rule("block", f"r{i}.org", f"/{i}/") for i in range(300)), U.Rule("allow", "net", "/es/"), U.Rule("allow", "b.cd", "/"), U.Rule("block", "cd", "/x/")]
    more = spark.createDataFrame([(90, "http://r7.org/7/x", ""), (91, "http://b.cd/x/", "")], pages.schema)
    out = U.judge(pages.unionByName(more), rules, keys(spark, U.LISTED))
    assert rows_of(out) == rows_of(U.judge(pages.unionByName(more), rules, keys(spark, U.LISTED), max_bits=256))
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in out.collect()}
    assert got[90] == ("r7.org/7/", "block") and got[8] == ("net/es/", "block")
    assert got[91] == ("b.cd/", "allow")  # as long as cd/x/, but of the longer host


def test_query_matches_sql(spark, sf):
    same_as_sql(U.op2_url_filter(spark, sf), U.ORACLE, sf)


def test_no_python_in_plan(spark, sf):
    plan = U.op2_url_filter(spark, sf)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
