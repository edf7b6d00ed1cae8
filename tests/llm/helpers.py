import duckdb
import pyarrow.parquet as pq

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def docs(spark, rows):
    """A documents table of (doc_id, text) or full rows."""
    full = [r if len(r) == 5 else (r[0], r[1], "en", "src0", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, DOCS)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def table(sf, name):
    return pq.read_table(f"{sf}/{name}.parquet").to_pylist()


def same_as_sql(df, sql, sf, tables=("documents", "pages", "labels")):
    con = duckdb.connect()
    for t in tables:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    names = sorted(df.columns)
    want = con.sql(f"SELECT {', '.join(names)} FROM ({sql})").fetchall()
    got = [tuple(r) for r in df.select(names).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
