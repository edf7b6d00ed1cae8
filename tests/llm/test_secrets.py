import hashlib
import re
import time

from quire.llm import secrets as S

from .helpers import docs, rows_of, same_as_sql, table

ASSIGN = re.compile(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base(text):
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(found))


def spans(df):
    return {r["doc_id"]: r["s"] for r in df.select("doc_id", S.span_text(S.F.col("secrets"), S.BASE_KINDS).alias("s")).collect()}


CASES = [
    None, "", "x" * 300_000, "é🙂 Password = 'abcdef' token:ab secret=abc", "password=token: abcdef", "AKIA" + "A" * 16 + " AKIAX",
    "AKIAAKIA" + "9" * 12, "f" * 24 + "g" + "0" * 23, "api_key:" + "ab" * 20 + " APIKEY=\"1234567", "paſſword=abcdefg", "to\u212Aen=abcdefg",
    "password=aaaaaa=password=bbbbbb", "AKIA" + "F" * 16 + "0" * 30,
]


def test_spans_match_brute_force(spark):
    d = docs(spark, list(enumerate(CASES)))
    got = spans(S.findings(d, S.scan(d)))
    assert got == {i: base(t or "") for i, t in enumerate(CASES)}


def test_query_on_table(spark, sf):
    got = {r["doc_id"]: r for r in S.op1_secret_scan(spark, sf).collect()}
    for r in table(sf, "documents"):
        want = base(r["text"] or "")
        assert got[r["doc_id"]]["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()
        assert got[r["doc_id"]]["n_hex"] == want.count("hex:")


def test_only_unseen_pairs_are_scanned(spark, tmp_path):
    ledger = S.SecretLedger(spark, f"file://{tmp_path}/ledger")
    first = docs(spark, [(1, "token=abcdef1"), (2, "token=abcdef1"), (3, "plain")])
    assert ledger.update(first, S.RULES[:2]).count() == 2  # blobs, not paths
    again = S.scan(first, S.RULES[:2], ledger.read())
    assert again.count() == 0
    newer = (S.Rule("assign", 2, S.RULES[0].pattern, 2, 3, S.RULES[0].flags), S.RULES[1])
    later = docs(spark, [(1, "token=abc"), (4, "plain")])
    todo = {bytes(r["blob_id"]): sorted(r["scanned"]) for r in S.scan(later, newer, ledger.read()).collect()}
    assert sorted(todo.values()) == [["access@1", "assign@2"], ["assign@2"]]
    ledger.update(later, newer)
    both = first.unionByName(later)
    got = rows_of(S.findings(both, ledger.read(), newer).select("doc_id", "text", S.span_text(S.F.col("secrets")).alias("s")))
    assert (1, "token=abc", "assign:0:9") in got
    assert (2, "token=abcdef1", "") in got  # the old rule's findings no longer count
    ledger.update(both, newer)
    got = rows_of(S.findings(both, ledger.read(), newer).select("doc_id", S.span_text(S.F.col("secrets")).alias("s")))
    assert got.count((1, "assign:0:13")) == 1 and (2, "assign:0:13") in got


def test_extra_rules_clashing_columns_and_repeats(spark):
    d = docs(spark, [(1, "https://u:pw@h ghp_" + "Z1" * 20)] * 2).withColumn("secrets", S.F.lit(1)).withColumn("blob_id", S.F.lit("x"))
    got = S.findings(d, S.scan(d)).select("doc_id", S.span_text(S.F.col("secrets")).alias("s")).collect()
    assert [r["s"] for r in got] == ["basic_auth:0:13,github:15:59"] * 2
    assert S.findings(d.limit(0), S.scan(d.limit(0))).count() == 0


def test_stage_replaces_secrets(spark, sf):
    d = docs(spark, [(1, "é token=abcdef AKIA" + "B" * 16 + " end"), (2, None), (3, "clean")])
    got = {r["doc_id"]: r for r in S.stage(spark, d, sf).collect()}
    assert got[1]["text"] == "é <assign> <access> end" and got[1]["n_chars"] == len(got[1]["text"])
    assert got[2]["text"] is None and got[3]["text"] == "clean"


BODY = "\n".join(["MIIEvQ" + "Ab0+/" * 11 + "xyz"] * 3 + ["Zm9vYmE="])


def test_stage_leaves_nothing_of_a_secret(spark, sf):
    begin, end = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----"
    cases = {
        "secret = postgresql://admin:hunter2hunter2@db": "<assign>db",
        "DB_PASSWORD=mongodb://u:pw@h": "DB_<assign>h",
        f"a\n{begin}\n{BODY}\n{end}\nz": "a\n<pem>\nz",
        f"a {begin}\r\nProc-Type: 4,ENCRYPTED\r\nDEK-Info: AES-128-CBC,00FF\r\n\r\n" + BODY.replace("\n", "\r\n") + f"\r\n{end} z": "a <pem> z",
        f"{begin}\n{BODY}\nThe rest of the text stays.": "<pem>\nThe rest of the text stays.",
        f"{begin}\nProc-Type: 4,ENCRYPTED\n\n{BODY}\n\nThe rest.": "<pem>\n\nThe rest.",
        '{"key": "' + f"{begin}\n{BODY}\n{end}\n".replace("\n", "\\n") + '"}': '{"key": "<pem>\\n"}',
        f"secret: {begin}\n{BODY}\n{end} z": "<assign> z",
        f"{begin}\n{BODY}\n{begin}\n{BODY}\n{end}": "<pem>\n<pem>",
        f"the line {begin} opens a key file": "the line <pem> opens a key file",
    }
    d = docs(spark, list(enumerate(cases)))
    got = {r["doc_id"]: r["text"] for r in S.stage(spark, d, sf).collect()}
    assert got == dict(enumerate(cases.values()))
    text = (begin + "\n" + "x y " * 50) * 4000
    start = time.time()
    S.find_spans(text, [(r, re.compile(r.pattern, r.flags)) for r in S.STAGE_RULES])
    assert time.time() - start < 10


def test_query_matches_sql(spark, sf):
    same_as_sql(S.op1_secret_scan(spark, sf), S.ORACLE, sf)


def test_sql_agrees_on_hard_texts(spark, tmp_path):
    texts = [*CASES, "-----BEGIN RSA PRIVATE KEY----- eyJhbGciOiJI.eyJzdWIiOiIx.abc xoxb-1234567890-x ghp_" + "Z" * 36 + " ftp://u:p@h x://:y@"]
    docs(spark, list(enumerate(texts))).coalesce(1).write.parquet(f"file://{tmp_path}/documents.parquet")
    (tmp_path / "flat").mkdir()
    next((tmp_path / "documents.parquet").glob("*.parquet")).rename(tmp_path / "flat" / "documents.parquet")
    same_as_sql(S.op1_secret_scan(spark, str(tmp_path / "flat")), S.ORACLE, str(tmp_path / "flat"), ("documents",))


def test_patterns_take_linear_time():
    import time

    ready = [(r, re.compile(r.pattern, r.flags)) for r in S.RULES]
    for text in ("://" + "ab0" * 1_700_000, "eyJ" * 1_000_000, "eyJabcdefgh." * 200_000, "a+" * 2_000_000, "ghp_" * 1_000_000, "token" + " " * 3_000_000, "-----BEGIN " * 300_000):
        began = time.process_time()
        S.find_spans(text, ready)
        assert time.process_time() - began < 20


def test_query_and_stage_keep_to_the_session_ledger(spark, sf, tmp_path):
    spark.conf.set(S.LEDGER, f"file://{tmp_path}/ledger")
    try:
        first = rows_of(S.op1_secret_scan(spark, sf))
        size = S.session_ledger(spark).read().count()
        assert size == len({r["text"] or "" for r in table(sf, "documents")})
        assert rows_of(S.op1_secret_scan(spark, sf)) == first
        assert S.session_ledger(spark).read().count() == size  # nothing was scanned again
        S.stage(spark, spark.read.parquet(f"{sf}/documents.parquet"), sf).count()
        grown = S.session_ledger(spark).read()
        assert grown.count() == 2 * size
        assert {tuple(r["scanned"]) for r in grown.select("scanned").distinct().collect()} == {tuple(r.key for r in S.RULES), ("pem@2",)}  # only the rule that differs
    finally:
        spark.conf.unset(S.LEDGER)
