"""Every registered query against its DuckDB oracle (sf0.001)."""

import oracle_check

SF = "/root/testdata/sf0.001"


def test_all_queries_match_oracle(spark):
    res = oracle_check.compare(spark, SF)
    bad = {k: v for k, v in res.items() if v[0] not in ("OK", "rows-only")}
    assert not bad, bad


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["doc_id", "text", "lang", "source", "n_chars"]
