"""Structured Streaming ingest of JSONL folders.

One streaming query picks up new files as they land and parses every line once,
with the same VARIANT expressions as the batch reader.  Each micro-batch is one
write of one folder, ``batch=<id>``, that holds the good rows (declared keys as
typed columns, all other keys in ``rest``) and the malformed lines (with the
name of their file) side by side, as partitions ``ok=true`` and ``ok=false``.
The folder is overwritten as a whole, so a batch that is replayed after a crash
leaves exactly what it left the first time, and good and malformed lines of a
batch can never come apart.  ``availableNow`` drains everything present and
stops; a long-running job would use a processing-time trigger instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from winnow.functions import text as tx

DOC_FIELDS = [("doc_id", "bigint"), ("text", "string"), ("source", "string"), ("lang", "string"), ("domain", "string"),
              ("tokens", "array<string>")]


def parse_lines(lines: DataFrame, fields=DOC_FIELDS) -> DataFrame:
    """(declared fields, rest, file, value, ok) of the lines that are not blank:
    ``rest`` is the JSON text of all undeclared keys, ``file`` and ``value`` are
    kept for malformed lines alone."""
    v = tx.strip_ws(F.col("value"))
    p = lines.where(v != "").select("value", "file", F.try_parse_json(v).alias("_v"))
    names = F.array(*[F.lit(n) for n, _ in fields])
    whole = F.try_variant_get("_v", "$", "map<string,variant>")
    rest = F.to_json(F.map_filter(whole, lambda k, _: ~F.array_contains(names, k)), {"ignoreNullFields": "false"})
    ok = F.col("_v").isNotNull()
    return p.select(*[F.try_variant_get("_v", f"$.{n}", t).alias(n) for n, t in fields], rest.alias("rest"),
                    F.when(~ok, F.col("file")).alias("file"), F.when(~ok, F.col("value")).alias("value"), ok.alias("ok"))


def write_batch(out_dir: str, fields=DOC_FIELDS):
    """What ``foreachBatch`` does with a micro-batch of (value, file) lines."""
    out = out_dir.rstrip("/")

    def write(lines: DataFrame, batch: int) -> None:
        parse_lines(lines, fields).write.mode("overwrite").partitionBy("ok").parquet(f"{out}/batch={batch}")
    return write


def start_ingest(spark: SparkSession, src_dir: str, out_dir: str, fields=DOC_FIELDS, max_files_per_trigger: int = 64,
                 glob: str | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Start the streaming query (``availableNow`` unless ``trigger`` says otherwise)."""
    reader = spark.readStream.format("text").option("maxFilesPerTrigger", max_files_per_trigger)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    lines = reader.load(src_dir).select("value", F.col("_metadata.file_path").alias("file"))
    return (lines.writeStream.foreachBatch(write_batch(out_dir, fields))
            .option("checkpointLocation", out_dir.rstrip("/") + "_checkpoint")
            .trigger(**(trigger or {"availableNow": True})).start())


def _sink(spark: SparkSession, out_dir: str, fields) -> DataFrame:
    cols = ", ".join(f"{n} {t}" for n, t in [*fields, ("rest", "string"), ("file", "string"), ("value", "string"), ("batch", "bigint"), ("ok", "boolean")])
    return spark.read.schema(cols).parquet(out_dir)


def ingested(spark: SparkSession, out_dir: str, fields=DOC_FIELDS) -> DataFrame:
    """The good rows of all batches so far."""
    return _sink(spark, out_dir, fields).where("ok").select(*[n for n, _ in fields], "rest")


def quarantined(spark: SparkSession, out_dir: str, fields=DOC_FIELDS) -> DataFrame:
    """(value, file, batch) of the malformed lines of all batches so far."""
    return _sink(spark, out_dir, fields).where("NOT ok").select("value", "file", "batch")


def stream_jsonl_to_parquet(spark: SparkSession, src_dir: str, out_dir: str, fields=DOC_FIELDS,
                            max_files_per_trigger: int = 64, glob: str | None = None) -> DataFrame:
    """Drain ``src_dir`` into ``out_dir`` and return the good rows as a batch
    DataFrame."""
    start_ingest(spark, src_dir, out_dir, fields, max_files_per_trigger, glob).awaitTermination()
    return ingested(spark, out_dir, fields)
