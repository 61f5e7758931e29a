"""Corpus statistics: field coverage, text lengths, value distributions,
size estimates.  All are single-scan aggregations (partial aggregation
before the shuffle)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the size estimate: UTF-8 overhead factor and the assumed
# Parquet / JSONL size ratio.
JSONL_OVERHEAD = 1.2
PARQUET_RATIO = 0.3


def _as_text(name: str, typ: str) -> Column:
    c = F.col(name)
    if typ.startswith("array") or typ.startswith("struct") or typ.startswith("map"):
        return F.to_json(c)
    return c.cast("string")


def _covered(name: str, typ: str) -> Column:
    c = F.col(name)
    if typ == "string":
        return c.isNotNull() & (c != "")
    return c.isNotNull()


def field_stats(df: DataFrame, approx: bool = False) -> DataFrame:
    """(field, coverage, unique_values): coverage = share of all rows with a
    non-null, non-'' value; unique_values = distinct count of the value's text
    form among covered rows.  One scan: the fields are unpivoted with
    ``stack`` and grouped by field."""
    fields = df.dtypes
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("field"), F.when(_covered(n, t), F.unhex(F.md5(_as_text(n, t)))).alias("v")) for n, t in fields])).alias("s"))
    distinct = F.approx_count_distinct("s.v") if approx else F.count_distinct("s.v")
    per = long.groupBy(F.col("s.field").alias("field")).agg(
        F.count(F.lit(1)).alias("_rows"), F.count("s.v").alias("_cov"), distinct.alias("unique_values"))
    return per.select("field", F.round(F.col("_cov") / F.col("_rows"), 6).alias("coverage"), "unique_values")


def text_stats(df: DataFrame, text_col: str = "text") -> DataFrame:
    """total_documents and length avg/min/max/total over non-empty texts;
    an empty corpus gives no row."""
    t = F.col(text_col)
    ne = t.isNotNull() & (t != "")
    ln = F.when(ne, F.length(t))
    out = df.agg(F.count(F.lit(1)).alias("total_documents"),
                 F.round(F.avg(ln), 6).alias("avg_length"), F.min(ln).alias("min_length"),
                 F.max(ln).alias("max_length"), F.sum(ln).alias("total_characters"))
    return out.where(F.col("total_documents") > 0)


def value_distribution(df: DataFrame, dims=("domain", "lang", "source")) -> DataFrame:
    """(dimension, value, n) for each dimension in one scan (GROUPING SETS).
    Absent columns count as 'unknown'; explicit nulls stay null."""
    cols = set(df.columns)
    sel = [(F.col(d) if d in cols else F.lit("unknown")).cast("string").alias(d) for d in dims]
    g = df.select(*sel).groupingSets([[d] for d in dims], *dims).agg(
        F.count(F.lit(1)).alias("n"), *[F.grouping(d).alias(f"_g_{d}") for d in dims])
    dim = F.lit(None).cast("string")
    val = F.lit(None).cast("string")
    for d in dims:
        dim = F.when(F.col(f"_g_{d}") == 0, F.lit(d)).otherwise(dim)
        val = F.when(F.col(f"_g_{d}") == 0, F.col(d)).otherwise(val)
    return g.select(dim.alias("dimension"), val.alias("value"), "n")


def size_estimate(df: DataFrame, group_col: str = "domain", text_col: str = "text") -> DataFrame:
    """Per group: documents, mean characters and the estimated JSONL /
    Parquet sizes in MB (rounded to 2 places) and their ratio."""
    g = df.groupBy(group_col).agg(F.count(F.lit(1)).alias("num_documents"),
                                  F.avg(F.length(text_col)).alias("_avg"))
    jsonl = F.col("num_documents") * F.col("_avg") * JSONL_OVERHEAD / (1024 * 1024)
    parquet = jsonl * PARQUET_RATIO
    return g.select(group_col, "num_documents", F.round("_avg", 6).alias("avg_doc_size"),
                    F.round(jsonl, 2).alias("jsonl_mb"), F.round(parquet, 2).alias("parquet_mb"),
                    F.when(parquet > 0, F.round(jsonl / parquet, 2)).otherwise(F.lit(0.0)).alias("compression_ratio"))
