"""Mergeable statistics and clustered rewriting."""

import random

import pytest
from pyspark.sql import functions as F

from winnow.operators import profile as pf
from winnow.sources import io


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(2)
    rows = [(f"f{i % 3}", rng.choice(["en", "de", "de", "de", None, ""]), f"text {rng.randrange(6000)} " + "x" * rng.randrange(200)) for i in range(9000)]
    return rows, spark.createDataFrame(rows, "file string, lang string, text string").repartition(5)


def test_merged_parts_equal_one_pass_within_the_stated_error(corpus):
    rows, df = corpus
    parts = pf.profile_rows(df, ["file"], top=("lang",))
    assert parts.count() == 6
    got = {r["field"]: r for r in pf.report(pf.merge_rows(parts), (0.1, 0.5, 0.9), 2).collect()}
    for k, field in ((1, "lang"), (2, "text")):
        values = [r[k] for r in rows if r[k]]
        r, lens = got[field], sorted(map(len, values))
        assert (r.rows, r.covered, r.chars, r.min_len, r.max_len) == (9000, len(values), sum(lens), lens[0], lens[-1])
        exact = len(set(values))
        assert abs(r.distinct_values - exact) <= 1 + 5 * 0.0163 * exact
        for q, v in zip((0.1, 0.5, 0.9), r.length_quantiles):
            assert sum(x < v for x in lens) / len(lens) - 0.03 <= q <= sum(x <= v for x in lens) / len(lens) + 0.03
    assert [(x["item"], x["count"]) for x in got["lang"].frequent_values] == [(v, sum(r[1] == v for r in rows)) for v in ("de", "en")]


def test_rows_are_stored_and_a_new_file_is_only_added(spark, corpus, tmp_path):
    rows, df = corpus
    path = str(tmp_path / "profile")
    for f in ("f0", "f1", "f2"):
        pf.profile_rows(df.where(F.col("file") == f), ["file"], top=("lang",)).write.mode("append").parquet(path)
    stored = spark.read.parquet(path)
    whole = pf.report(pf.merge_rows(pf.profile_rows(df, ["file"], top=("lang",))))
    cols = ["field", "rows", "covered", "coverage", "chars", "avg_length", "min_len", "max_len", "distinct_values"]
    assert sorted(pf.report(pf.merge_rows(stored)).select(cols).collect()) == sorted(whole.select(cols).collect())
    per = {(r["file"], r["field"]): r["rows"] for r in pf.report(pf.merge_rows(stored, ["file"])).collect()}
    assert per == {(f"f{i}", x): 3000 for i in range(3) for x in ("lang", "text")}


def test_empty_and_null_only(spark):
    df = spark.createDataFrame([], "file string, text string")
    assert pf.profile_rows(df, ["file"]).count() == 0
    assert pf.merge_rows(pf.profile_rows(df, ["file"])).count() == 0
    none = spark.createDataFrame([("a", None), ("b", "")], "file string, text string")
    r = pf.report(pf.merge_rows(pf.profile_rows(none, ["file"], top=("text",)))).first()
    assert (r.rows, r.covered, r.coverage, r.chars, r.min_len, r.distinct_values, r.length_quantiles, r.frequent_values) == (2, 0, 0.0, 0, None, 0, None, [])


def test_z_order_lets_both_filters_skip(spark, tmp_path):
    df = spark.range(20_000).select(F.pmod(F.xxhash64("id"), F.lit(1000)).alias("a"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)).alias("b"),
                                    "id", F.when(F.col("id") % 97 == 0, None).otherwise("s").alias("s"))
    paths = {k: str(tmp_path / k) for k in ("z", "a")}
    io.rewrite_parquet(df, paths["z"], 500, cluster_by=["a", "b"], files=4)
    io.rewrite_parquet(df, paths["a"], 500, sort_col="a", files=4)
    share = {}
    for layout, path in paths.items():
        groups = io.row_groups(spark, path, {}).collect()
        assert sum(g["rows"] for g in groups) == 20_000 and {g["codec"] for g in groups} == {"SNAPPY"}
        assert max(g["rows"] for g in groups) <= 500
        for name, ranges in (("a", {"a": (100, 120)}), ("b", {"b": (100, 120)}), ("ab", {"a": (100, 120), "b": (100, 120)})):
            hits = io.row_groups(spark, path, ranges).where("hit").count()
            share[layout, name] = hits / len(groups)
    assert share["z", "b"] < 0.4 < share["a", "b"]          # a filter on either column skips
    assert share["z", "a"] < 0.4 and share["z", "ab"] < 0.1
    assert sorted(r.id for r in spark.read.parquet(paths["z"]).select("id").collect()) == list(range(20_000))


def test_z_order_of_nulls_dates_and_nothing(spark, tmp_path):
    df = spark.createDataFrame([(None, "2024-01-01"), (5, None), (7, "2023-05-05")], "n int, d string").withColumn("d", F.to_date("d"))
    io.rewrite_parquet(df, str(tmp_path / "x"), 2, cluster_by=["n", "d"], files=2)
    assert spark.read.parquet(str(tmp_path / "x")).count() == 3
    io.rewrite_parquet(df.limit(0), str(tmp_path / "y"), 2, cluster_by=["n", "d"], files=2)
    assert spark.read.schema("n int, d date").parquet(str(tmp_path / "y")).count() == 0
