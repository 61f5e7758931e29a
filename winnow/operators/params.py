"""Parameter-delta operators over tables of (model, name, chunk, vec).

A parameter tensor is stored as rows of fixed-size chunks (``vec`` is an
array<double>), so a multi-billion-value model is many modest rows and every
operator is a join on (name, chunk): no row grows with the model size and
nothing passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KEY = ["name", "chunk"]


def _keyed(df: DataFrame) -> DataFrame:
    return df if "chunk" in df.columns else df.withColumn("chunk", F.lit(0))


def chunk_vectors(df: DataFrame, size: int = 4096) -> DataFrame:
    """Split every ``vec`` into fixed-size chunks, per row (no shuffle):
    (model, name, vec) -> (model, name, chunk, vec)."""
    n = F.size("vec")
    starts = F.sequence(F.lit(0), F.greatest(F.ceil(n / size).cast("int") - 1, F.lit(0)))
    parts = F.transform(starts, lambda i: F.struct(i.alias("chunk"), F.slice("vec", i * size + 1, size).alias("vec")))
    keep = [c for c in df.columns if c not in ("vec", "chunk")]
    return df.select(*keep, F.explode(parts).alias("_c")).select(*keep, "_c.chunk", "_c.vec")


def vector_diff(base: DataFrame, tuned: DataFrame, partial: bool = False) -> DataFrame:
    """([model,] name, chunk, vec = tuned - base) for every base parameter of
    every tuned model, all models in one join.  A base parameter that a model
    lacks raises or, with ``partial``, has no delta of that model; extra tuned
    names are ignored."""
    by = [c for c in ("model",) if c in tuned.columns]
    b = _keyed(base).select(*KEY, F.col("vec").alias("b"))
    t = _keyed(tuned).select(*by, *KEY, F.col("vec").alias("t"))
    if partial:
        return b.join(t, KEY).select(*by, *KEY, F.zip_with("t", "b", lambda x, y: x - y).cast("array<double>").alias("vec"))
    want = b
    if by:  # names of the models: one short row each, bounded by the number of models
        models = [r["model"] for r in tuned.select("model").distinct().collect()]
        want = b.withColumn("model", F.explode(F.array(*[F.lit(m) for m in models]).cast("array<string>")))
    j = want.join(t, [*by, *KEY], "left")
    delta = F.when(F.col("t").isNull(), F.raise_error(F.concat(F.lit("parameter missing in tuned model: "), F.col("name")))) \
             .otherwise(F.zip_with("t", "b", lambda x, y: x - y))
    return j.select(*by, *KEY, delta.cast("array<double>").alias("vec"))


def diff_stats(deltas: DataFrame, by: list[str] | None = None) -> DataFrame:
    """L2 norm, max and min over all values (per ``by`` group); empty -> 0."""
    by = by or []
    x = F.col("x")
    e = deltas.select(*by, F.explode("vec").alias("x"))
    agg = e.groupBy(*by).agg(F.sqrt(F.sum(x * x)).alias("norm"), F.max(x).alias("max"), F.min(x).alias("min"))
    cols = [F.coalesce(F.round(F.col(c), 6), F.lit(0.0)).alias(c) for c in ["norm", "max", "min"]]
    return agg.select(*by, *cols)


def normalize_weights(weights: DataFrame) -> DataFrame:
    """weight / sum(weight).  The weight table has one row per model, so the
    global window is over a table bounded by the number of models."""
    return weights.select("model", (F.col("weight") / F.sum("weight").over(Window.partitionBy())).alias("weight"))


def merge_weighted(base: DataFrame, deltas: DataFrame, weights: DataFrame) -> DataFrame:
    """(name, chunk, vec = base + sum_i w_i * delta_i).  Base parameters that
    no delta touches are kept; a delta parameter absent from the base raises.

    Deltas of one (name, chunk) are gathered per key -- at most one row per
    model, a bound set by the number of models -- and folded with
    ``aggregate(zip_with)``, so vectors are never exploded into scalars."""
    d = _keyed(deltas).join(F.broadcast(weights), "model")
    per_key = d.groupBy(*KEY).agg(F.collect_list(F.struct("weight", "vec")).alias("parts"))
    b = _keyed(base).select(*KEY, F.col("vec").alias("b"))
    j = b.join(per_key, KEY, "full_outer")
    folded = F.aggregate("parts", F.col("b").cast("array<double>"),
                         lambda acc, p: F.zip_with(acc, p["vec"], lambda a, v: a + p["weight"] * v))
    out = (F.when(F.col("b").isNull(), F.raise_error(F.concat(F.lit("parameter missing in base model: "), F.col("name"))))
           .when(F.col("parts").isNull(), F.col("b").cast("array<double>"))
           .otherwise(folded))
    return j.select(*KEY, out.alias("vec"))


def diff_outliers(deltas: DataFrame, by: list[str]) -> DataFrame:
    """Unit-norm delta per group: mean, population variance and the share of
    values more than 3 standard deviations from the mean.  Scaling changes no
    outlier, so one pass takes the raw moments (the norm among them) and one
    counts the tail."""
    e = deltas.select(*by, F.explode("vec").alias("x"))
    mom = e.groupBy(*by).agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("_norm"), F.avg("x").alias("_mean"),
                             F.var_pop("x").alias("_var"))
    far = F.abs(F.col("x") - F.col("_mean")) > 3 * F.sqrt(F.col("_var"))  # one moments row per group
    return e.join(mom, by).groupBy(*by, "_norm", "_mean", "_var").agg(F.avg(far.cast("double")).alias("share")).select(
        *by, F.round(F.col("_mean") / F.col("_norm"), 9).alias("mean"),
        F.round(F.col("_var") / (F.col("_norm") * F.col("_norm")), 9).alias("variance"), F.round("share", 6).alias("outlier_share"))
