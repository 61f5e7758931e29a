"""Source/sink queries: Parquet projection, conversion, profiling, layout,
listings, JSONL write-back, run logs and the end-to-end curation flow."""

from __future__ import annotations

from pyspark.sql import functions as F

from winnow.functions import scoring
from winnow.operators import validate as va
from winnow.plans import fixtures as fx
from winnow.plans import flow
from winnow.plans import oracle as O
from winnow.plans.q_dedup import flagship, normalized
from winnow.plans.q_params import PARAMS_SQL
from winnow.plans.q_text import CORPUS_SQL, LINES_SQL, jsonl_dir
from winnow.plans.registry import memo, query
from winnow.session import checkpoint_dir, scratch_path, table
from winnow.sources import io
from winnow.sources.lines import in_order


@query("parquet_project", "SELECT doc_id, lang, n_chars FROM documents")
def parquet_project(spark, sf):
    """Column-pruned scan: ReadSchema holds only the three columns."""
    return table(spark, sf, "documents").select("doc_id", "lang", "n_chars")


def _converted(spark, sf):
    def build():
        out = scratch_path(spark, "parquet")
        return io.convert_jsonl_to_parquet(spark, jsonl_dir(spark, sf), out, va.DOC_SCHEMA), out
    return memo(spark, ("converted", sf), build)


@query("jsonl_to_parquet", "WITH " + LINES_SQL + """
SELECT text, len(tokens)::INTEGER AS n_tokens, source, lang, domain FROM parsed""")
def jsonl_to_parquet(spark, sf):
    df, _ = _converted(spark, sf)
    return df.select("text", F.size("tokens").alias("n_tokens"), "source", "lang", "domain")


@query("schema_listing", """SELECT * FROM (VALUES ('text', 'string'), ('tokens', 'array<string>'), ('source', 'string'),
                             ('lang', 'string'), ('domain', 'string')) AS t(name, type)""")
def schema_listing(spark, sf):
    _, out = _converted(spark, sf)
    return spark.read.text(out.rstrip("/") + "_schema").select(
        F.split("value", ":").getItem(0).alias("name"), F.split("value", ":").getItem(1).alias("type"))


@query("parquet_validate", "WITH " + LINES_SQL + """
SELECT count(*) AS num_rows, 5 AS num_columns, count(*) > 0 AS is_valid FROM parsed""")
def parquet_validate(spark, sf):
    _, out = _converted(spark, sf)
    return io.validate_parquet(spark, out)


@query("parquet_profile", """
SELECT 'doc_id' AS "column", 'bigint' AS type, count(*) FILTER (WHERE doc_id IS NULL) AS null_count, count(*) AS num_rows FROM documents
UNION ALL SELECT 'text', 'string', count(*) FILTER (WHERE text IS NULL), count(*) FROM documents
UNION ALL SELECT 'lang', 'string', count(*) FILTER (WHERE lang IS NULL), count(*) FROM documents
UNION ALL SELECT 'source', 'string', count(*) FILTER (WHERE source IS NULL), count(*) FROM documents
UNION ALL SELECT 'n_chars', 'bigint', count(*) FILTER (WHERE n_chars IS NULL), count(*) FROM documents""")
def parquet_profile(spark, sf):
    return io.parquet_nulls(table(spark, sf, "documents"))


@query("parquet_footer")
def parquet_footer(spark, sf):
    _, out = _converted(spark, sf)
    return io.parquet_footers(spark, out)


@query("parquet_rewrite", "SELECT lang, count(*) AS n, sum(n_chars)::BIGINT AS chars FROM documents GROUP BY lang")
def parquet_rewrite(spark, sf):
    out = scratch_path(spark, "rewrite")
    io.rewrite_parquet(table(spark, sf, "documents"), out, 100_000, sort_col="doc_id")
    return spark.read.parquet(out).groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"))


@query("parquet_clustered", """
SELECT 'sorted' AS layout, count(*) AS rows, 'SNAPPY' AS codec, count(*) FILTER (WHERE l_partkey BETWEEN 20 AND 40 AND l_suppkey BETWEEN 2 AND 4) AS found,
       false AS skips_more FROM lineitem
UNION ALL SELECT 'clustered', count(*), 'SNAPPY', count(*) FILTER (WHERE l_partkey BETWEEN 20 AND 40 AND l_suppkey BETWEEN 2 AND 4), true FROM lineitem""")
def parquet_clustered(spark, sf):
    """A table rewritten along the Z-order curve over two columns against the
    same rows sorted by a third: rows, codec, rows found by a filter on the two,
    and which layout lets a reader skip more row groups."""
    d = table(spark, sf, "lineitem")
    wanted = {"l_partkey": (20, 40), "l_suppkey": (2, 4)}
    group = 500
    out = {}
    checkpoint_dir(spark)
    for layout, how in (("sorted", {"sort_col": "l_orderkey"}), ("clustered", {"cluster_by": list(wanted)})):
        path = scratch_path(spark, f"rewrite-{layout}")
        io.rewrite_parquet(d, path, group, files=4, **how)
        out[layout] = path
    read = {k: io.row_groups(spark, p, wanted).agg(F.count_if("hit").alias("n"), F.sum("rows").alias("rows"), F.max("codec").alias("codec"),
                                                   F.min("codec").alias("low")).checkpoint() for k, p in out.items()}
    both = None
    for layout, other in (("sorted", "clustered"), ("clustered", "sorted")):
        back = spark.read.parquet(out[layout]).where(F.col("l_partkey").between(20, 40) & F.col("l_suppkey").between(2, 4))
        row = read[layout].select(F.lit(layout).alias("layout"), "rows", F.when(F.col("codec") == F.col("low"), F.col("codec")).alias("codec"),
                                  back.select(F.count(F.lit(1))).scalar().alias("found"),
                                  (F.col("n") < read[other].select("n").scalar()).alias("skips_more"))
        both = row if both is None else both.unionByName(row)
    return both


def _by_domain(spark, sf):
    def build():
        out = scratch_path(spark, "bydomain")
        io.write_by_domain(fx.corpus(spark, sf), out)
        return out
    return memo(spark, ("bydomain", sf), build)


@query("write_by_domain", "WITH " + CORPUS_SQL + "\nSELECT domain, count(*) AS n, sum(length(text))::BIGINT AS chars FROM corpus GROUP BY domain")
def write_by_domain(spark, sf):
    out = _by_domain(spark, sf)
    return spark.read.parquet(out).groupBy("domain").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars"))


@query("list_files")
def list_files(spark, sf):
    return io.list_files(spark, _by_domain(spark, sf), "*.parquet").select("path", "length")


@query("file_info")
def file_info(spark, sf):
    return io.file_facts(io.list_files(spark, _by_domain(spark, sf), "*.parquet")).drop("modified_time")


@query("file_manifest")
def file_manifest(spark, sf):
    """Requested = every listed data file plus one missing path per domain."""
    listing = io.list_files(spark, _by_domain(spark, sf))
    missing = listing.select(F.concat(F.regexp_extract("path", r"^(.*)/[^/]*$", 1), F.lit("/absent.jsonl")).alias("path")).distinct()
    requested = listing.select("path").unionByName(missing)
    return io.file_manifest(requested, listing)


@query("file_exists")
def file_exists(spark, sf):
    listing = io.list_files(spark, _by_domain(spark, sf))
    missing = listing.select(F.concat(F.regexp_extract("path", r"^(.*)/[^/]*$", 1), F.lit("/absent.jsonl")).alias("path")).distinct()
    return io.file_exists(listing.select("path").unionByName(missing), listing)


URI_SQL = """u AS (SELECT page_id, ['s3://', 'gs://', 'azure://', ''][(page_id % 4)::INT + 1] || regexp_replace(url, '^[a-z]+://', '') AS uri FROM pages),
b AS (SELECT page_id, uri, CASE WHEN regexp_matches(uri, '^(s3|gs|azure)://') THEN regexp_extract(uri, '^[a-z0-9]+://(.*)$', 1) ELSE uri END AS body FROM u)"""


@query("parse_uri", "WITH " + URI_SQL + """
SELECT page_id, uri, regexp_extract(body, '^([^/]*)', 1) AS bucket, regexp_extract(body, '^[^/]*/(.*)$', 1) AS key FROM b""")
def parse_uri(spark, sf):
    p = table(spark, sf, "pages")
    scheme = F.element_at(F.array(F.lit("s3://"), F.lit("gs://"), F.lit("azure://"), F.lit("")), (F.col("page_id") % 4 + 1).cast("int"))
    u = p.select("page_id", F.concat(scheme, F.regexp_replace("url", r"^[a-z]+://", "")).alias("uri"))
    bucket, key = io.parse_uri(F.col("uri"))
    return u.select("page_id", "uri", bucket.alias("bucket"), key.alias("key"))


@query("write_jsonl", "WITH " + CORPUS_SQL + "\nSELECT doc_id, text, domain, len(tokens)::INTEGER AS n_tokens, ts_raw FROM corpus")
def write_jsonl(spark, sf):
    out = scratch_path(spark, "jsonl-out")
    io.write_jsonl(fx.corpus(spark, sf), out, "doc_id")
    p = io.read_jsonl(spark, out)
    return p.select(va.field("doc_id", "bigint").alias("doc_id"), va.field("text").alias("text"), va.field("domain").alias("domain"),
                    F.size(va.field("tokens", "array<string>")).alias("n_tokens"), va.field("ts_raw").alias("ts_raw"))


@query("preview5", "WITH " + O.docs_cte() + "\nSELECT doc_id, text, lang, source FROM docs ORDER BY doc_id LIMIT 5")
def preview5(spark, sf):
    """First five cleaned documents (the preview's own limit)."""
    return normalized(spark, sf).orderBy("doc_id").limit(5).select("doc_id", "text", "lang", "source")


# ------------------------------------------------------------------ the dedup job on whole documents

def job_lines(spark, sf):
    """One JSON line per document, in id order, with keys the job does not declare,
    nested values, and times that are numbers, unpadded and padded text by doc_id."""
    d = in_order(table(spark, sf, "documents").select("doc_id", "text", "lang", "source"), "doc_id")
    i = F.col("doc_id")
    fields = ["doc_id", "text", "lang", "source", F.concat(F.lit("u/"), i).alias("url"),
              F.struct((i * 2).alias("score"), F.array(i % 3, i % 5).alias("tags")).alias("meta")]
    number = F.to_json(F.struct(*fields, (F.lit(1700000000) + i).alias("timestamp")))
    text = F.to_json(F.struct(*fields, F.when(i % 3 == 1, "2024-1-5").otherwise("2024-01-05 10:00:00").alias("timestamp")))
    return d.select((i + 1).alias("line_no"), F.when(i % 3 == 0, number).otherwise(text).alias("value"))


def job_output(spark, sf):
    """Run the job once per session; its output folder."""
    def build():
        from winnow.plans import curate
        src, out = scratch_path(spark, "job-in"), scratch_path(spark, "job-out")
        job_lines(spark, sf).select("value").write.mode("overwrite").text(src)
        curate.dedup_job(spark, [src], out)
        return out
    return memo(spark, ("job", sf), build)


KEPT_SQL = O.dedup_chain() + ", kept AS (SELECT * FROM docs WHERE doc_id NOT IN (SELECT doc_id FROM dropped))"


@query("job_kept", KEPT_SQL + """
SELECT doc_id, text, lang, source, 'u/' || doc_id AS url, doc_id * 2 AS score, '[' || doc_id % 3 || ',' || doc_id % 5 || ']' AS tags,
       CASE doc_id % 3 WHEN 0 THEN (1700000000 + doc_id)::VARCHAR WHEN 1 THEN '"2024-1-5"' ELSE '"2024-01-05 10:00:00"' END AS time_json,
       CASE doc_id % 3 WHEN 0 THEN make_timestamp((1700000000 + doc_id) * 1000000) WHEN 1 THEN TIMESTAMP '2024-01-05'
                       ELSE TIMESTAMP '2024-01-05 10:00:00' END AS time,
       'doc_id,lang,meta,source,text,timestamp,url' AS keys FROM kept""")
def job_kept(spark, sf):
    """Every field of the documents that the dedup job kept, declared or not."""
    v = F.parse_json("value").alias("_v")
    kept = spark.read.text(job_output(spark, sf) + "/kept").select(v, "value")
    get = lambda path, typ: F.try_variant_get("_v", path, typ)
    return kept.select(get("$.doc_id", "bigint").alias("doc_id"), *[get(f"$.{c}", "string").alias(c) for c in ("text", "lang", "source", "url")],
                       get("$.meta.score", "bigint").alias("score"), F.to_json(get("$.meta.tags", "variant")).alias("tags"),
                       F.to_json(get("$.timestamp", "variant")).alias("time_json"),
                       scoring.parse_timestamp_variant(get("$.timestamp", "variant")).alias("time"),
                       F.array_join(F.array_sort(F.json_object_keys("value")), ",").alias("keys"))


@query("run_log", KEPT_SQL + """
SELECT (SELECT count(*) FROM docs) AS before_count, (SELECT count(*) FROM kept) AS after_count, true AS timed""")
def run_log(spark, sf):
    """The job's log row: documents before and after, and whether it was timed."""
    log = spark.read.option("header", True).csv(job_output(spark, sf) + "/dedup_log")
    return log.select(F.col("before_count").cast("bigint").alias("before_count"), F.col("after_count").cast("bigint").alias("after_count"),
                      (F.col("processing_time").cast("double") > 0).alias("timed"))


# ------------------------------------------------------------------ all phases in one run

def flow_inputs(spark, sf) -> dict:
    """The files the phases start from: JSON lines, parameter, weight and pair tables."""
    def build():
        at = {n: scratch_path(spark, f"flow-{n}") for n in ("docs", "params", "weights", "pairs")}
        job_lines(spark, sf).select("value").write.mode("overwrite").text(at["docs"])
        fx.params(spark, sf).write.parquet(at["params"])
        fx.model_weights(spark).write.parquet(at["weights"])
        fx.pairs(spark, sf).write.parquet(at["pairs"])
        return at
    return memo(spark, ("flow-inputs", sf), build, fixture=True)


def flow_run(spark, sf):
    """(root, rows of the first run, rows of a second run on the same root)."""
    def build():
        root = scratch_path(spark, "flow")
        run = lambda: flow.run_stages(spark, flow.phases(partial=True), flow_inputs(spark, sf), root).collect()
        return root, run(), run()
    return memo(spark, ("flow", sf), build)


FLOW_SQL = KEPT_SQL + ", " + PARAMS_SQL + """
SELECT 'dedup' AS phase, count(*) AS rows, true AS reused_by_a_second_run FROM kept
UNION ALL SELECT 'convert', count(*), true FROM kept
UNION ALL SELECT 'delta', count(*), true FROM params WHERE model <> 'base' AND name IN (SELECT name FROM params WHERE model = 'base')
UNION ALL SELECT 'merge', count(*), true FROM params WHERE model = 'base'
UNION ALL SELECT 'metrics', 1, true"""


@query("flow_phases", FLOW_SQL)
def flow_phases(spark, sf):
    """Rows of every phase's output, and whether a second run took it from the
    first by its manifest."""
    _, first, second = flow_run(spark, sf)
    rows = [(a.phase, a.rows, b.reused and not a.reused) for a, b in zip(first, second)]
    return spark.createDataFrame(rows, "phase string, rows bigint, reused_by_a_second_run boolean")


@query("flow_domains", KEPT_SQL + """
SELECT 'unknown' AS domain, lang, source, count(*) AS documents, sum(length(text))::BIGINT AS chars FROM kept GROUP BY lang, source""")
def flow_domains(spark, sf):
    """The kept documents as the flow's second phase wrote them, by domain folder."""
    root, _, _ = flow_run(spark, sf)
    back = spark.read.option("recursiveFileLookup", "false").parquet(f"{root}/convert/*/parquet")
    return back.groupBy("domain", "lang", "source").agg(F.count(F.lit(1)).alias("documents"), F.sum(F.length("text")).alias("chars"))


@query("candidate_sink", O.dedup_chain() + "\nSELECT cid AS seed, m AS cand FROM clusters WHERE m <> cid")
def candidate_sink(spark, sf):
    """The candidate pairs that the dedup job wrote, read back (ids are line numbers)."""
    pairs = spark.read.schema("seed bigint, cand bigint").json(job_output(spark, sf) + "/candidates")
    return pairs.select((F.col("seed") - 1).alias("seed"), (F.col("cand") - 1).alias("cand"))


@query("stats_sink", KEPT_SQL + """
SELECT count(*) AS original_count, (SELECT count(*) FROM kept) AS deduplicated_count, count(*) - (SELECT count(*) FROM kept) AS removed_count,
       (SELECT count(*) FROM seeds) AS duplicate_clusters,
       CASE WHEN count(*) > 0 THEN round((count(*) - (SELECT count(*) FROM kept)) / count(*), 6) ELSE 0.0 END AS deduplication_rate FROM docs""")
def stats_sink(spark, sf):
    """The statistics that the dedup job wrote, read back."""
    return spark.read.schema("original_count bigint, deduplicated_count bigint, removed_count bigint, duplicate_clusters bigint, "
                             "deduplication_rate double").json(job_output(spark, sf) + "/stats")


@query("training_texts", """
WITH d AS (SELECT doc_id, text, (row_number() OVER (ORDER BY doc_id) - 1) // 16 AS batch FROM documents WHERE text IS NOT NULL)
SELECT batch, count(*) AS texts, min(doc_id) AS first_id, sum(length(text))::BIGINT AS chars, md5(string_agg(text, chr(10) ORDER BY doc_id)) AS digest
FROM d GROUP BY batch""")
def training_texts(spark, sf):
    """Batches of 16 texts in file order (the batch size is the feature), each
    one row with its texts."""
    docs = table(spark, sf, "documents").where(F.col("text").isNotNull()).select("doc_id", "text")
    b = io.text_batches(docs, "doc_id", 16)
    return b.select("batch", F.size("texts").cast("bigint").alias("texts"), "first_id",
                    F.aggregate("texts", F.lit(0).cast("bigint"), lambda a, t: a + F.length(t)).alias("chars"),
                    F.md5(F.array_join("texts", "\n").cast("binary")).alias("digest"))


@query("training_batches", "SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 16 AS batch FROM documents WHERE text IS NOT NULL")
def training_batches(spark, sf):
    """Texts of parseable rows in file order, numbered into batches of 16."""
    d = table(spark, sf, "documents").where(F.col("text").isNotNull()).select("doc_id")
    o = io.with_ordinal(d, "doc_id", "rank")
    return o.select("doc_id", F.floor((F.col("rank") - 1) / 16).cast("bigint").alias("batch"))


@query("corpus_manifest", "WITH " + CORPUS_SQL + """
SELECT domain, count(*) AS documents, min(doc_id) AS sample_id, sum(length(text))::BIGINT AS chars FROM corpus GROUP BY domain""")
def corpus_manifest(spark, sf):
    """Per domain of the written layout: documents, smallest id and characters."""
    out = memo(spark, ("by-domain-manifest", sf), lambda: scratch_path(spark, "manifest"))
    io.write_by_domain(fx.corpus(spark, sf), out)
    return spark.read.parquet(out).groupBy("domain").agg(
        F.count(F.lit(1)).alias("documents"), F.min("doc_id").alias("sample_id"), F.sum(F.length("text")).alias("chars"))


@query("curate_flow", O.dedup_chain() + """
SELECT ['main_data','textbook','assembly','web','social'][(doc_id % 5)::INT + 1] AS domain, count(*) AS kept_documents,
       sum(length(text))::BIGINT AS kept_chars
FROM docs WHERE doc_id NOT IN (SELECT doc_id FROM dropped) GROUP BY ALL""")
def curate_flow(spark, sf):
    """clean -> dedup -> per-domain totals of the kept corpus."""
    kept = flagship(spark, sf).kept
    dom = F.element_at(F.array(*[F.lit(d) for d in fx.DOMAINS]), (F.col("doc_id") % 5 + 1).cast("int"))
    return kept.groupBy(dom.alias("domain")).agg(F.count(F.lit(1)).alias("kept_documents"), F.sum(F.length("text")).alias("kept_chars"))
