"""End-to-end jobs: the dedup flow and the JSONL -> Parquet conversion,
each one Spark job graph from input files to written outputs.

Usage:
    python -m winnow.plans.curate dedup   --input <jsonl files/dirs> --output <dir>
    python -m winnow.plans.curate convert --input <jsonl files/dirs> --output <dir>
"""

from __future__ import annotations

import argparse
import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from winnow.functions import text as tx
from winnow.operators import dedup as dd
from winnow.operators import validate as va
from winnow.sources import io
from winnow.sources.lines import read_lines, write_lines

# Declared document fields (name, type) that the operators look at; all other
# keys ride along in ``rest``.  A time may be a string or a number.
DOC_FIELDS = [("text", "string"), ("tokens", "array<string>"), ("source", "string"), ("lang", "string"),
              ("domain", "string"), ("timestamp", "variant")]


def _typed(parsed: DataFrame, fields=DOC_FIELDS) -> DataFrame:
    """(doc_id, declared fields, rest): ``rest`` is the whole object but its
    text, string values stripped, everything else as it was."""
    cols = [F.try_variant_get("_v", f"$.{n}", t).alias(n) for n, t in fields]
    whole = F.try_variant_get("_v", "$", "map<string,variant>")

    def cleaned(_, v):
        string = F.coalesce(F.schema_of_variant(v) == "STRING", F.lit(False))
        return F.when(string, tx.strip_ws(F.try_variant_get(v, "$", "string")).cast("variant")).otherwise(v)

    rest = F.transform_values(F.map_filter(whole, lambda k, _: k != "text"), cleaned)
    return parsed.select(F.col("line_no").alias("doc_id"), *cols, rest.alias("rest"))


def document_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, value): the whole document as a JSON line, with its cleaned text
    and, unless it has a doc_id of its own, its line number."""
    own = F.map_from_arrays(F.array(F.lit("text")), F.array(F.col("text").cast("variant")))
    line = F.map_from_arrays(F.array(F.lit("doc_id")), F.array(F.col("doc_id").cast("variant")))
    bare = F.map_concat(own, "rest")
    value = F.when(F.map_contains_key("rest", "doc_id"), F.to_json(bare, {"ignoreNullFields": "false"})) \
             .otherwise(F.to_json(F.map_concat(line, own, "rest"), {"ignoreNullFields": "false"}))
    return docs.select("doc_id", value.alias("value"))


def dedup_job(spark: SparkSession, inputs, out_dir: str, required=("text",), fields=DOC_FIELDS,
              strategy: str = "longest", cfg: dd.DedupConfig = dd.DEFAULT, sample_lines: int = 100) -> dict:
    """Sample check -> row validation -> normalization -> cleaned copy and
    preview -> near-duplicate removal -> kept JSONL, candidate pairs, stats
    and an appended run-log row.  Returns the stats (one small row)."""
    t0 = time.time()
    out = out_dir.rstrip("/")
    inputs = [inputs] if isinstance(inputs, str) else list(inputs)
    for path in inputs:  # every input is checked, not the first lines of their concatenation
        report = va.jsonl_report(read_lines(spark, path), sample_lines).first()
        if not report.is_valid:
            raise ValueError(f"{path} failed the format check: {report.asDict()}")
    lines = read_lines(spark, inputs)
    parsed = va.parse(lines).where(~F.col("_blank") & F.col("_v").isNotNull())
    ok, _ = va.row_validity(list(required))
    docs = dd.normalize_docs(_typed(parsed.where(ok), fields))
    docs.write.mode("overwrite").parquet(f"{out}/cleaned")  # read by the cleaned copy, the index and the outputs
    docs = spark.read.schema(docs.schema).parquet(f"{out}/cleaned")

    write_lines(document_lines(docs), f"{out}/dedup_ready", "doc_id", ids=docs.select("doc_id"))
    document_lines(docs.orderBy("doc_id").limit(5)).select("value").coalesce(1).write.mode("overwrite").text(f"{out}/sample_preview")

    res = dd.deduplicate(docs, cfg, strategy)
    # ranges are cut by the ids of the cleaned documents, so the removal join is not run a second time to sample them
    write_lines(document_lines(res.kept), f"{out}/kept", "doc_id", ids=docs.select("doc_id"))
    if spark.read.text(f"{out}/kept").limit(1).count() == 0:
        raise RuntimeError(f"no document was kept in {out}/kept")  # output gate
    pairs = res.members.where(F.col("doc_id") != F.col("cluster_id")).select(
        F.col("cluster_id").alias("seed"), F.col("doc_id").alias("cand"))
    pairs.write.mode("overwrite").json(f"{out}/candidates")
    stats = dd.dedup_stats(docs, res)
    stats.coalesce(1).write.mode("overwrite").json(f"{out}/stats")
    st = stats.first().asDict()

    log = spark.createDataFrame(
        [(time.strftime("%Y-%m-%d %H:%M:%S"), json.dumps(inputs), out, st["original_count"], st["deduplicated_count"],
          round(time.time() - t0, 2))],
        "timestamp string, input_file string, output_file string, before_count long, after_count long, processing_time double")
    log.write.mode("append").option("header", True).csv(f"{out}/dedup_log")
    return st


def convert_job(spark: SparkSession, inputs, out_dir: str, fields=va.DOC_SCHEMA, domain_col: str = "domain",
                compression: str = "zstd", max_records: int = 100_000) -> DataFrame:
    """JSONL -> typed Parquet laid out by domain (schema side-car, bounded
    file size), then the post-write check of every domain folder.  Returns
    (domain, num_rows, num_columns, is_valid)."""
    out = out_dir.rstrip("/")
    lines = spark.read.text(inputs)
    v = tx.strip_ws(F.col("value"))
    parsed = lines.where(v != "").select(F.try_parse_json(v).alias("_v")).where(F.col("_v").isNotNull())
    schema = io.schema_from_config(fields)
    typed = parsed.select(*[F.try_variant_get("_v", f"$.{f.name}", f.dataType.simpleString()).alias(f.name)
                            for f in schema.fields])
    io.write_by_domain(typed, out, domain_col, max_records, compression)
    io.schema_listing(spark, schema).select(F.concat_ws(":", "name", "type").alias("value")) \
        .coalesce(1).write.mode("overwrite").text(out + "_schema")
    back = spark.read.parquet(out)
    return back.groupBy(domain_col).agg(F.count(F.lit(1)).alias("num_rows")).select(
        domain_col, "num_rows", F.lit(len(back.columns)).alias("num_columns"), (F.col("num_rows") > 0).alias("is_valid"))


def main(argv=None) -> None:
    from winnow.session import get_session
    ap = argparse.ArgumentParser(description="winnow jobs")
    ap.add_argument("job", choices=["dedup", "convert"])
    ap.add_argument("--input", nargs="+", required=True)
    ap.add_argument("--output", required=True)
    ap.add_argument("--strategy", default="longest")
    ap.add_argument("--master", default="local[*]")
    a = ap.parse_args(argv)
    spark = get_session(a.master)
    if a.job == "dedup":
        print(json.dumps(dedup_job(spark, a.input, a.output, strategy=a.strategy)))
    else:
        for r in convert_job(spark, a.input, a.output).collect():
            print(json.dumps(r.asDict()))


if __name__ == "__main__":
    main()
