"""Readers and writers: JSONL (with paging), Parquet conversion, profiling,
rewriting, per-domain layout, and file listings.

Every writer is a distributed Spark write; every reader is a pruned scan.
Scratch output goes under the session's shared checkpoint folder (see
``winnow.session.scratch_path``), never a machine-local temp dir.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from winnow.functions import text as tx
from winnow.operators import validate as va
from winnow.operators.partitioning import estimated_bytes, range_parts
from winnow.sources.lines import read_lines

# Declared type names and their Spark types.
TYPE_MAP = {"string": StringType(), "list[string]": ArrayType(StringType()), "categorical": StringType()}


# ---------------------------------------------------------------- JSONL

def read_jsonl(spark: SparkSession, paths, max_lines: int | None = None) -> DataFrame:
    """Parsed JSONL rows (path, line_no, value, _v, _obj, ...): blank and
    malformed lines are skipped; ``max_lines`` counts physical lines."""
    lines = read_lines(spark, paths)
    if max_lines:
        lines = lines.where(F.col("line_no") <= max_lines)
    p = va.parse(lines)
    return p.where(~F.col("_blank") & F.col("_v").isNotNull())


def parsed_jsonl(spark: SparkSession, paths) -> DataFrame:
    """Parsed JSONL rows without line numbers: one scan, no join."""
    p = va.parse(spark.read.text(paths))
    return p.where(~F.col("_blank") & F.col("_v").isNotNull())


def quarantine(spark: SparkSession, paths) -> DataFrame:
    """Malformed, non-blank lines with their numbers."""
    p = va.parse(read_lines(spark, paths))
    return p.where(~F.col("_blank") & F.col("_v").isNull()).select("path", "line_no", "value")


def jsonl_page(parsed: DataFrame, start_line: int, batch_size: int) -> DataFrame:
    """Skip ``start_line`` physical lines, then take ``batch_size`` valid docs
    (the page size is the feature's own limit)."""
    return parsed.where(F.col("line_no") > start_line).orderBy("line_no").limit(batch_size)


def with_ordinal(df: DataFrame, order_col: str, name: str = "ordinal") -> DataFrame:
    """1-based rank by ``order_col`` without a single-task window: range
    partition, sort and number inside the partitions, count per partition (a
    table bounded by the partition count), offset each partition.  One shuffle;
    the numbered rows are checkpointed, so pass the key columns only and
    join/filter back."""
    from pyspark.sql import Window

    from winnow.session import checkpoint_dir
    checkpoint_dir(df.sparkSession)
    part = (df.repartitionByRange(range_parts(df), order_col).sortWithinPartitions(order_col)
            .withColumn("_mid", F.monotonically_increasing_id()).checkpoint(eager=True))
    part = part.withColumns({"_pid": F.shiftright("_mid", 33), "_rec": F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))})
    counts = part.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return part.join(offs, "_pid").withColumn(name, F.col("_off") + F.col("_rec") + 1).drop("_pid", "_off", "_mid", "_rec")


def text_batches(docs: DataFrame, id_col: str, size: int, text_col: str = "text") -> DataFrame:
    """(batch, first_id, texts): the texts in id order, ``size`` to a batch, the
    last one partial.  Only ids are ranked; a batch is gathered by its number,
    ``size`` texts at most."""
    rank = with_ordinal(docs.select(F.col(id_col).alias("_id")), "_id", "_rank")
    batch = F.floor((F.col("_rank") - 1) / size).cast("bigint")
    rows = docs.join(rank.select(F.col("_id").alias(id_col), batch.alias("batch")), id_col)
    got = rows.groupBy("batch").agg(F.sort_array(F.collect_list(F.struct(F.col(id_col).alias("i"), F.col(text_col).alias("t")))).alias("x"))
    return got.select("batch", F.col("x")[0]["i"].alias("first_id"), F.transform("x", lambda x: x["t"]).alias("texts"))


def jsonl_page_valid(parsed: DataFrame, start: int, batch_size: int) -> DataFrame:
    """Skip ``start`` valid documents, take the next ``batch_size``.

    Only the line numbers are ranked (a narrow table); the page's first and
    last line numbers then filter the parsed rows directly -- ranks are
    monotone in the line number, so no join and no copy of the documents."""
    o = with_ordinal(parsed.select("line_no"), "line_no", "_ord")
    page = o.where((F.col("_ord") > start) & (F.col("_ord") <= start + batch_size))
    bounds = page.select(F.struct(F.min("line_no").alias("lo"), F.max("line_no").alias("hi"))).scalar()
    return parsed.where(F.col("line_no").between(bounds["lo"], bounds["hi"]))


def to_jsonl(df: DataFrame) -> DataFrame:
    """One JSON object per row; null fields are written (not dropped) and
    non-ASCII text is kept as is."""
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"))


def write_jsonl(df: DataFrame, path: str, order_col: str | None = None) -> None:
    out = to_jsonl(df.repartitionByRange(range_parts(df), order_col)
                   .sortWithinPartitions(order_col)) if order_col else to_jsonl(df)
    out.write.mode("overwrite").text(path)


# ---------------------------------------------------------------- evaluation inputs

def read_prompts(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, prompt, reference) of a JSONL prompt file; a line that is not
    JSON raises when read (there is no skipping here), references may lack."""
    v = F.parse_json(F.col("value"))
    return read_lines(spark, path).where(tx.strip_ws("value") != "").select(
        "line_no", F.try_variant_get(v, "$.prompt", "string").alias("prompt"),
        F.try_variant_get(v, "$.reference", "string").alias("reference"))


def read_texts(spark: SparkSession, path: str, name: str) -> DataFrame:
    """(pair_id, ``name``): the stripped non-blank lines of a file, numbered
    from 1 without gaps."""
    lines = read_lines(spark, path).select("line_no", tx.strip_ws("value").alias(name)).where(F.col(name) != "")
    order = with_ordinal(lines.select("line_no"), "line_no", "pair_id")
    return lines.join(order, "line_no").select("pair_id", name)


def write_metrics(row: DataFrame, out: str) -> None:
    """One metric row as CSV (with header) and as JSON below ``out``."""
    one = row.coalesce(1)
    one.write.mode("overwrite").option("header", True).csv(f"{out}/csv")
    one.write.mode("overwrite").json(f"{out}/json")


# ---------------------------------------------------------------- schema

def schema_from_config(cfg: list[tuple[str, str]]) -> StructType:
    """Declared (name, type) list -> StructType; unknown types are strings."""
    return StructType([StructField(n, TYPE_MAP.get(t, StringType()), True) for n, t in cfg])


def schema_listing(spark: SparkSession, schema: StructType) -> DataFrame:
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(schema.fields)]
    return spark.createDataFrame(rows, "ord int, name string, type string")


def convert_jsonl_to_parquet(spark: SparkSession, src, out: str, cfg, compression: str = "zstd",
                             max_records_per_file: int = 0) -> DataFrame:
    """JSONL -> Parquet with an explicit schema.  Absent keys become null;
    malformed lines are skipped.  Writes ``out`` and ``out``_schema (one
    ``name:type`` line per column) and returns the read-back table."""
    schema = schema_from_config(cfg)
    lines = spark.read.text(src)
    parsed = lines.where(tx.strip_ws(F.col("value")) != "").select(
        F.try_parse_json(tx.strip_ws(F.col("value"))).alias("_v")).where(F.col("_v").isNotNull())
    cols = [F.try_variant_get("_v", f"$.{f.name}", f.dataType.simpleString()).alias(f.name) for f in schema.fields]
    w = parsed.select(*cols).write.mode("overwrite").option("compression", compression)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.parquet(out)
    schema_listing(spark, schema).select(F.concat_ws(":", "name", "type").alias("value")) \
        .coalesce(1).write.mode("overwrite").text(out.rstrip("/") + "_schema")
    return spark.read.parquet(out)


# ---------------------------------------------------------------- Parquet

def validate_parquet(spark: SparkSession, path: str) -> DataFrame:
    """(num_rows, num_columns, is_valid): readable, > 0 rows and > 0 columns."""
    df = spark.read.parquet(path)
    ncols = len(df.columns)
    return df.agg(F.count(F.lit(1)).alias("num_rows")).select(
        "num_rows", F.lit(ncols).alias("num_columns"), ((F.col("num_rows") > 0) & F.lit(ncols > 0)).alias("is_valid"))


def parquet_nulls(df: DataFrame) -> DataFrame:
    """(column, type, null_count, num_rows) in one scan."""
    aggs = [F.count(F.lit(1)).alias("_rows")] + [F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(df.columns)]
    one = df.agg(*aggs)
    items = [F.struct(F.lit(c).alias("column"), F.lit(t).alias("type"), F.col(f"_n{i}").alias("null_count"))
             for i, (c, t) in enumerate(df.dtypes)]
    return one.select(F.explode(F.array(*items)).alias("s"), "_rows").select("s.*", F.col("_rows").alias("num_rows"))


def _open(path: str):
    """A file of a listing, opened where the task runs; a scheme that the worker
    cannot open is an error."""
    import pyarrow.fs as pafs
    if path.startswith("file:"):
        return pafs.LocalFileSystem().open_input_file("/" + path[5:].lstrip("/"))
    fs, rel = pafs.FileSystem.from_uri(path)
    return fs.open_input_file(rel)


def _metadata(f):
    import pyarrow.parquet as pq
    return pq.ParquetFile(f).metadata


def _footer_rows(batches):
    import pandas as pd
    for pdf in batches:
        out = []
        for p in pdf["path"]:
            with _open(p) as fh:
                md = _metadata(fh)
            out.append((p, md.num_rows, md.num_row_groups, md.num_columns, md.serialized_size))
        yield pd.DataFrame(out, columns=["path", "num_rows", "num_row_groups", "num_columns", "footer_bytes"])


def parquet_footers(spark: SparkSession, path: str) -> DataFrame:
    """Per data file: rows, row groups, columns and footer size, read by the
    executors from the file list (the file contents are never shipped)."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
             .option("recursiveFileLookup", "true").load(path).select("path"))
    return files.mapInPandas(_footer_rows, "path string, num_rows long, num_row_groups long, num_columns long, footer_bytes long")


def _rank(edges: Column, value: Column, bits: int) -> Column:
    """How many of the ascending ``edges`` (fewer than 2^bits) lie below ``value``:
    a binary search of ``bits`` steps."""
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(bits))])
    return F.aggregate(steps, F.lit(0), lambda at, s: at + F.when(F.get(edges, at + s - 1) < value, s).otherwise(0))


def z_value(df: DataFrame, cols: list[str], bits: int = 10) -> Column:
    """Place on the Z-order curve over ``cols``: every column's value becomes its
    bucket among 2^bits (cut points from one sketch pass, at most 2^bits a
    column), and the buckets' bits are interleaved.  Nulls come first."""
    parts = 1 << bits
    probs = [i / parts for i in range(1, parts)]
    number = {c: F.col(c).cast("double") if dict(df.dtypes)[c] not in ("date", "timestamp", "timestamp_ntz") else
              F.unix_timestamp(F.col(c).cast("timestamp")).cast("double") for c in cols}
    cuts = df.agg(*[F.percentile_approx(number[c], probs, 10 * parts).alias(f"c{i}") for i, c in enumerate(cols)]).first()
    z = F.lit(0).cast("bigint")
    for i, c in enumerate(cols):
        edges = F.array(*[F.lit(float(x)) for x in sorted(set(cuts[i] or []))]).cast("array<double>")
        at = F.when(number[c].isNull(), 0).otherwise(_rank(edges, number[c], bits))
        for b in range(bits):
            z = z + F.shiftleft(F.shiftright(at, b).bitwiseAND(F.lit(1)).cast("bigint"), b * len(cols) + i)
    return z


FILE_BYTES = 32 << 20  # of the optimizer's estimate: a large table gets more files


def rewrite_parquet(df: DataFrame, out: str, row_group_rows: int = 100_000, sort_col: str | None = None,
                    compression: str = "snappy", cluster_by: list[str] | None = None, files: int | None = None) -> None:
    """Rewrite for reading: snappy, bounded row groups, dictionary and
    statistics on, optionally clustered for data skipping -- by ``sort_col``, or
    by several columns along the Z-order curve, so that a filter on any of them
    skips row groups."""
    size = estimated_bytes(df)
    n = max(files or range_parts(df), size // FILE_BYTES if size < 1 << 60 else 0)  # ``files`` at least; no estimate: those
    if cluster_by:
        df = (df.withColumn("_z", z_value(df, cluster_by)).repartitionByRange(n, "_z")
              .sortWithinPartitions("_z").drop("_z"))
    elif sort_col:
        df = df.repartitionByRange(n, sort_col).sortWithinPartitions(sort_col)
    (df.write.mode("overwrite").option("compression", compression)
       .option("parquet.block.row.count.limit", row_group_rows)
       .option("parquet.enable.dictionary", "true")
       .option("parquet.statistics.enabled", "true").parquet(out))


def row_groups(spark: SparkSession, path: str, ranges: dict[str, tuple]) -> DataFrame:
    """(path, row_group, rows, codec, hit) of every row group, from the footers
    alone: ``hit`` tells whether its statistics let a reader with the filter
    ``ranges`` (column -> lowest, highest) skip it or not."""
    def run(batches):
        import pandas as pd
        for pdf in batches:
            out = []
            for p in pdf["path"]:
                with _open(p) as f:
                    md = _metadata(f)
                for g in range(md.num_row_groups):
                    rg, hit, codecs = md.row_group(g), True, set()
                    for c in range(rg.num_columns):
                        col = rg.column(c)
                        codecs.add(col.compression)
                        if col.path_in_schema in ranges and col.statistics is not None and col.statistics.has_min_max:
                            lo, hi = ranges[col.path_in_schema]
                            hit = hit and not (col.statistics.max < lo or col.statistics.min > hi)
                    out.append((p, g, rg.num_rows, ",".join(sorted(codecs)), hit))
            yield pd.DataFrame(out, columns=["path", "row_group", "rows", "codec", "hit"])

    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path).select("path"))
    return files.mapInPandas(run, "path string, row_group int, rows bigint, codec string, hit boolean")


TASK_BYTES = 64 << 20


def write_by_domain(df: DataFrame, out: str, domain_col: str = "domain", max_records: int = 100_000,
                    compression: str = "zstd") -> None:
    """One directory per domain (missing -> 'unknown'), files of about
    ``max_records`` rows and TASK_BYTES of values at most; readers prune
    partitions by domain.

    Every domain gets as many slots as it needs files, and its rows are dealt to
    them at random: a slot is one task and one file.  Of the domains only their
    counts (one short row each) are broadcast."""
    from pyspark.sql import Window

    from winnow.session import checkpoint_dir
    d = df.withColumn(domain_col, F.coalesce(F.col(domain_col), F.lit("unknown")))
    size = F.lit(0)
    for name, typ in d.dtypes:
        size = size + (F.coalesce(F.octet_length(name), F.lit(0)) if typ == "string" else
                       F.coalesce(F.octet_length(F.array_join(name, " ")), F.lit(0)) if typ == "array<string>" else F.lit(8))
    checkpoint_dir(df.sparkSession)
    files = d.groupBy(domain_col).agg(F.greatest(F.ceil(F.count(F.lit(1)) / max_records), F.ceil(F.sum(size) / TASK_BYTES)).alias("_files")).checkpoint()
    before = Window.orderBy(domain_col).rowsBetween(Window.unboundedPreceding, -1)
    first = files.select(domain_col, "_files", F.coalesce(F.sum("_files").over(before), F.lit(0)).alias("_first"))
    slots = files.agg(F.sum("_files")).first()[0] or 1
    slot = (F.col("_first") + F.floor(F.rand(7) * F.col("_files"))).cast("int")
    dealt = d.join(F.broadcast(first), domain_col).withColumn("_slot", slot)
    (dealt.repartitionById(int(slots), F.col("_slot")).select(*d.columns)
     .write.mode("overwrite").partitionBy(domain_col).option("compression", compression)
     .option("maxRecordsPerFile", max_records).parquet(out))


# ---------------------------------------------------------------- files

def list_files(spark: SparkSession, root: str, suffix: str = "*") -> DataFrame:
    """(path, length, modificationTime) of every file under ``root`` whose
    name matches ``suffix`` (glob), recursively, without reading contents."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", suffix)
            .option("recursiveFileLookup", "true").load(root).select("path", "length", "modificationTime"))


def file_facts(listing: DataFrame) -> DataFrame:
    """Local-file facts from a listing: bytes, MB (2 dp), mtime, suffix, name, stem."""
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    ext = F.regexp_extract(name, r"^.+(\.[^.]+)$", 1)
    stem = F.when(ext == "", name).otherwise(F.regexp_extract(name, r"^(.+)\.[^.]+$", 1))
    return listing.select("path", F.col("length").alias("size_bytes"),
                          F.round(F.col("length") / (1024 * 1024), 2).alias("size_mb"),
                          F.col("modificationTime").alias("modified_time"),
                          ext.alias("extension"), name.alias("name"), stem.alias("stem"))


def file_exists(requested: DataFrame, listing: DataFrame) -> DataFrame:
    """(path, exists) for a table of requested paths against a listing; a
    path the listing cannot see counts as absent."""
    seen = listing.select("path", F.lit(True).alias("_seen")).distinct()
    return requested.select("path").join(seen, "path", "left").select(
        "path", F.coalesce("_seen", F.lit(False)).alias("exists"))


def file_manifest(requested: DataFrame, listing: DataFrame) -> DataFrame:
    """Per extension of the requested paths that exist: (extension, files,
    size_mb); plus one total row (extension NULL) where ``total_files``
    counts every requested path and ``size_mb`` sums the rounded per-file MB."""
    facts = file_facts(listing)
    j = requested.select("path").join(facts, "path", "left")
    g = j.rollup("extension").agg(F.count(F.lit(1)).alias("total_files"), F.count("size_bytes").alias("files"),
                                  F.round(F.sum("size_mb"), 2).alias("size_mb"), F.grouping("extension").alias("_all"))
    return g.where((F.col("_all") == 1) | F.col("extension").isNotNull()).select(
        F.when(F.col("_all") == 1, F.lit(None)).otherwise(F.col("extension")).alias("extension"),
        "files", F.coalesce("size_mb", F.lit(0.0)).alias("size_mb"),
        F.when(F.col("_all") == 1, F.col("total_files")).alias("total_files"))


def parse_uri(c: Column) -> tuple[Column, Column]:
    """(bucket, key) of s3://, gs://, azure:// or bare bucket/key paths."""
    body = F.when(c.rlike(r"^(s3|gs|azure)://"), F.regexp_extract(c, r"^[a-z0-9]+://(.*)$", 1)).otherwise(c)
    bucket = F.regexp_extract(body, r"^([^/]*)", 1)
    key = F.regexp_extract(body, r"^[^/]*/(.*)$", 1)
    return bucket, key
