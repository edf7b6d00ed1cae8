"""Production queries of the operators, by name, and their SQL."""

from __future__ import annotations

from importlib import import_module

#: query name -> module; the module has a function of the query's name.
QUERIES = {
    "op1_secret_scan": "secrets",
    "op2_url_filter": "urlfilter",
    "op3_language_id": "langid",
    "op4_quality_cnn": "quality_cnn",
    "op5_near_duplicates": "neardup",
    "op6_quality_rules": "quality_rules",
    "op7_byte_bpe": "bpe",
    "op8_fingerprints": "fingerprint",
    "op9_warc": "warc",
    "op10_mix_sources": "mixing",
}
#: queries with an exact DuckDB equivalent, in ORACLE of their module.
WITH_SQL = ("op1_secret_scan", "op2_url_filter", "op9_warc", "op10_mix_sources")


def _bound(name: str):
    fn = getattr(import_module(f"{__package__}.{QUERIES[name]}"), name)

    def run(spark, sf_dir):
        return fn(spark, sf_dir)

    run.__name__, run.__doc__ = name, fn.__doc__
    return run


def queries() -> dict:
    return {name: _bound(name) for name in QUERIES}


def oracle_sql() -> dict[str, str]:
    return {name: import_module(f"{__package__}.{QUERIES[name]}").ORACLE for name in WITH_SQL}
