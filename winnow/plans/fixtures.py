"""Derived inputs built by Spark from the shared tables (see FIXTURES.md B).

Each is a plain DataFrame projection/join of a given table, so its size
grows with the table; nothing here is made-up data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from winnow.functions import text as tx
from winnow.operators.partitioning import spread
from winnow.session import table

# Domain names assigned by doc_id % 5.
DOMAINS = ["main_data", "textbook", "assembly", "web", "social"]
# ASCII letters mapped onto Hangul syllables (open and closed).
LATIN = "abcdefghijklmnopqrstuvwxyz"
HANGUL_MAP = "가각간갇갈감갑값강개객거검고곡구국그글나난다달마말밤"
# Model weights for the three tuned parameter sets.
MODEL_WEIGHTS = [("m1", 0.5), ("m2", 0.3), ("m3", 0.2)]


def _case(key: Column, values: list) -> Column:
    out = F.lit(None)
    for i, v in reversed(list(enumerate(values))):
        out = F.when(key == i, v if isinstance(v, Column) else F.lit(v)).otherwise(out)
    return out


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def corpus(spark: SparkSession, sf_dir: str, docs: DataFrame | None = None) -> DataFrame:
    """documents + domain + tokens + ts_raw (three layouts, junk and null).
    ``docs``: the documents in an order of their own, which is kept."""
    d = spread(documents(spark, sf_dir)) if docs is None else docs
    k = (F.col("doc_id") % 5).cast("int")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 365).cast("int"))
    ds = F.date_format(day, "yyyy-MM-dd")
    ts = _case(k, [F.concat(ds, F.lit(" 12:34:56")), F.concat(ds, F.lit("T08:00:00")), ds,
                   F.lit("not a date"), F.lit(None).cast("string")])
    return d.select("doc_id", "text", "lang", "source",
                    _case(k, DOMAINS).alias("domain"),
                    F.split(tx.collapse_ws("text"), " ").alias("tokens"),
                    ts.alias("ts_raw"))


def hangul(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Korean-script rendering of documents (letters mapped to syllables)."""
    d = documents(spark, sf_dir)
    return d.select("doc_id", F.translate(F.lower("text"), LATIN, HANGUL_MAP).alias("text"), "lang", "source")


def jsonl_lines(spark: SparkSession, sf_dir: str, docs: DataFrame | None = None) -> DataFrame:
    """(line_no, value) JSONL rendering of corpus rows with rule-broken lines:
    %97 -> '{bad', %89 -> blank, %83 -> text null, %79 -> no source key,
    %73 -> number in lang."""
    c = corpus(spark, sf_dir, docs)
    i = F.col("doc_id")
    base = F.struct("doc_id", "text", "source", "lang", "domain", "tokens", "ts_raw")
    no_src = F.struct("doc_id", "text", "lang", "domain", "tokens", "ts_raw")
    null_text = F.struct("doc_id", F.lit(None).cast("string").alias("text"), "source", "lang", "domain", "tokens", "ts_raw")
    num_lang = F.struct("doc_id", "text", "source", (F.col("doc_id") % 7).alias("lang"), "domain", "tokens", "ts_raw")
    opts = {"ignoreNullFields": "false"}
    line = (F.when(i % 97 == 0, F.lit("{bad"))
            .when(i % 89 == 0, F.lit(""))
            .when(i % 83 == 0, F.to_json(null_text, opts))
            .when(i % 79 == 0, F.to_json(no_src, opts))
            .when(i % 73 == 0, F.to_json(num_lang, opts))
            .otherwise(F.to_json(base, opts)))
    return c.select((i + 1).alias("line_no"), line.alias("value"))


def params(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(model, name, vec array<double>) over the whole embeddings table:
    model = base, m1, m2, m3 by vec_id % 4, name = 'w' || vec_id / 4, so
    every name has one base and three tuned vectors, the last maybe fewer."""
    e = table(spark, sf_dir, "embeddings")
    model = _case((F.col("vec_id") % 4).cast("int"), ["base", "m1", "m2", "m3"])
    return e.select(model.alias("model"), F.concat(F.lit("w"), F.floor(F.col("vec_id") / 4).cast("string")).alias("name"),
                    F.col("embedding").cast("array<double>").alias("vec"))


def model_weights(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(MODEL_WEIGHTS, "model string, weight double")


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(pair_id, prompt, reference, prediction) from conversations: reference =
    text (null on every 11th pair), prediction = text without every 7th word."""
    c = table(spark, sf_dir, "conversations")
    words = F.split(tx.collapse_ws("text"), " ")
    kept = F.filter(words, lambda w, i: (i + 1) % 7 != 0)
    pid = (F.col("conv_id") * 100000 + F.col("turn"))
    return c.select(pid.alias("pair_id"),
                    F.concat(F.lit("conv "), F.col("conv_id").cast("string"), F.lit(" turn "), F.col("turn").cast("string")).alias("prompt"),
                    F.when(pid % 11 == 0, F.lit(None).cast("string")).otherwise(F.col("text")).alias("reference"),
                    F.array_join(kept, " ").alias("prediction"),
                    F.col("text").alias("base_output"))


def token_logprobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(F.col("user_id").alias("seq_id"), F.col("event_id").alias("pos"), (-F.col("value") / 100.0).alias("logprob"))
