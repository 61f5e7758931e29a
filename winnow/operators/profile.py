"""Mergeable corpus statistics: one sketch row per part (file, domain, ...) and
field, combined without reading the corpus again.

A row holds exact counts (rows, covered values, characters, shortest and longest
value) and three of Spark's own sketches of bounded size: distinct values (HLL),
length quantiles (KLL) and frequent values (top-k).  Rows of any parts merge by
sum, min, max and the sketches' unions, so a new file adds its rows and every
report -- per file, per domain, overall -- is an aggregate over the stored rows.
The exact one-pass forms in ``stats`` stay the default.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnow.operators.stats import _as_text, _covered

LG_K = 12            # HLL registers: 2^12, standard error 1.04 / 64 = 1.6 %
KLL_K = 200          # KLL accuracy: rank error about 1.7 % at most
TRACKED = 1000       # distinct values a top-k sketch tracks


def _sketch(name: str, *args) -> Column:
    return F.call_function(name, *args)


def profile_rows(df: DataFrame, by: list[str], fields: list[str] | None = None, top: tuple = ()) -> DataFrame:
    """One row per part (the columns ``by``) and field: rows, covered, chars,
    min_len, max_len, distinct, lengths, frequent.  ``top``: fields whose
    frequent values are kept (short ones).  One scan, one partial aggregate;
    an empty table gives no rows."""
    types = dict(df.dtypes)
    fields = [f for f in (fields or df.columns) if f not in by]
    items = []
    for f in fields:
        v = F.when(_covered(f, types[f]), _as_text(f, types[f]))
        items.append(F.struct(F.lit(f).alias("field"), F.xxhash64(v).alias("h"), v.isNotNull().alias("c"), F.length(v).cast("bigint").alias("n"),
                              F.when(F.lit(f in top), v).alias("v")))
    long = df.select(*by, F.explode(F.array(*items)).alias("s"))
    covered = F.col("s.c")
    return long.groupBy(*by, F.col("s.field").alias("field")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(covered).alias("covered"), F.coalesce(F.sum("s.n"), F.lit(0)).alias("chars"),
        F.min("s.n").alias("min_len"), F.max("s.n").alias("max_len"),
        _sketch("hll_sketch_agg", F.when(covered, F.col("s.h")), F.lit(LG_K)).alias("distinct"),
        _sketch("kll_sketch_agg_bigint", F.col("s.n"), F.lit(KLL_K)).alias("lengths"),
        _sketch("approx_top_k_accumulate", F.col("s.v"), F.lit(TRACKED)).alias("frequent"))


def merge_rows(rows: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Stored rows combined over everything but ``by`` and the field."""
    return rows.groupBy(*(by or []), "field").agg(
        F.sum("rows").alias("rows"), F.sum("covered").alias("covered"), F.sum("chars").alias("chars"),
        F.min("min_len").alias("min_len"), F.max("max_len").alias("max_len"),
        _sketch("hll_union_agg", F.col("distinct")).alias("distinct"),
        _sketch("kll_merge_agg_bigint", F.col("lengths")).alias("lengths"),
        _sketch("approx_top_k_combine", F.col("frequent")).alias("frequent"))


def report(rows: DataFrame, quantiles=(0.25, 0.5, 0.75), top: int = 5) -> DataFrame:
    """Readable figures of merged rows: coverage, mean length, the estimates and
    the frequent values with their counts."""
    keys = [c for c in rows.columns if c not in ("rows", "covered", "chars", "min_len", "max_len", "distinct", "lengths", "frequent")]
    q = _sketch("kll_sketch_get_quantile_bigint", F.col("lengths"), F.array(*[F.lit(float(x)) for x in quantiles]))
    return rows.select(
        *keys, "rows", "covered", F.round(F.col("covered") / F.col("rows"), 6).alias("coverage"), "chars",
        F.round(F.try_divide("chars", "covered"), 6).alias("avg_length"), "min_len", "max_len",
        _sketch("hll_sketch_estimate", F.col("distinct")).alias("distinct_values"),
        F.when(F.col("covered") > 0, q).alias("length_quantiles"),
        F.slice(F.filter(_sketch("approx_top_k_estimate", F.col("frequent"), F.lit(top + 1)), lambda x: x["item"].isNotNull()),  # null is an item
                1, top).alias("frequent_values"))
