"""JSONL ingest, validation, cleaning and corpus statistics queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from winnow.functions import scoring
from winnow.functions import text as tx
from winnow.operators import profile as pf
from winnow.operators import stats as st
from winnow.operators import validate as va
from winnow.plans import fixtures as fx
from winnow.plans import oracle as O
from winnow.plans.q_dedup import quality_sql
from winnow.plans.registry import memo, query
from winnow.session import scratch_path, table
from winnow.sources import io
from winnow.sources.lineindex import LineIndex
from winnow.sources.lines import in_order, read_lines
from winnow.streaming import ingest

# DuckDB restatement of the JSONL fixture: one line per document in doc_id
# order, with the same rule-broken lines, expressed on parsed values.
LINES_SQL = """lines AS (
  SELECT row_number() OVER (ORDER BY doc_id) AS line_no, doc_id,
         CASE WHEN doc_id % 97 = 0 THEN 'bad' WHEN doc_id % 89 = 0 THEN 'blank' ELSE 'ok' END AS kind,
         CASE WHEN doc_id % 83 = 0 THEN NULL ELSE text END AS text,
         CASE WHEN doc_id % 83 <> 0 AND doc_id % 79 = 0 THEN NULL ELSE source END AS source,
         doc_id % 83 <> 0 AND doc_id % 79 = 0 AS no_source,
         CASE WHEN doc_id % 83 <> 0 AND doc_id % 79 <> 0 AND doc_id % 73 = 0 THEN (doc_id % 7)::VARCHAR ELSE lang END AS lang,
         ['main_data','textbook','assembly','web','social'][(doc_id % 5)::INT + 1] AS domain,
         CASE WHEN text IS NULL OR """ + O.norm_text("text") + """ = '' THEN [] ELSE string_split(""" + O.norm_text("text") + """, ' ') END AS tokens,
         CASE doc_id % 5 WHEN 0 THEN strftime(DATE '2024-01-01' + (doc_id % 365)::INT, '%Y-%m-%d') || ' 12:34:56'
                         WHEN 1 THEN strftime(DATE '2024-01-01' + (doc_id % 365)::INT, '%Y-%m-%d') || 'T08:00:00'
                         WHEN 2 THEN strftime(DATE '2024-01-01' + (doc_id % 365)::INT, '%Y-%m-%d')
                         WHEN 3 THEN 'not a date' END AS ts_raw
  FROM documents),
parsed AS (SELECT * FROM lines WHERE kind = 'ok')"""


def jsonl_dir(spark, sf):
    """Write the JSONL fixture once per session; returns its folder."""
    def build():
        path = scratch_path(spark, "jsonl")
        docs = in_order(fx.documents(spark, sf).select("doc_id", "text", "lang", "source"), "doc_id")  # the narrow rows are moved, not the lines
        fx.jsonl_lines(spark, sf, docs).select("value").write.mode("overwrite").text(path)
        return path
    return memo(spark, ("jsonl", sf), build, fixture=True)


def parsed_lines(spark, sf):
    return io.read_jsonl(spark, jsonl_dir(spark, sf))


def doc_fields(df):
    return df.select("line_no", va.field("doc_id", "bigint").alias("doc_id"), va.field("text").alias("text"),
                     va.field("source").alias("source"), va.field("lang").alias("lang"), va.field("domain").alias("domain"))


@query("read_jsonl", "WITH " + LINES_SQL + "\nSELECT line_no, doc_id, text, source, lang, domain FROM parsed")
def read_jsonl(spark, sf):
    return doc_fields(parsed_lines(spark, sf))


@query("stream_jsonl", "WITH " + LINES_SQL + """
SELECT doc_id, text, source, lang, domain, array_to_string(tokens, ' ') AS tokens_text, CASE WHEN ts_raw IS NULL THEN '{"ts_raw":null}' ELSE '{"ts_raw":"' || ts_raw || '"}' END AS rest,
       (SELECT count(*) FROM lines WHERE kind = 'bad') AS quarantined FROM parsed""")
def stream_jsonl(spark, sf):
    path = scratch_path(spark, "stream")
    out = ingest.stream_jsonl_to_parquet(spark, jsonl_dir(spark, sf), path)
    bad = ingest.quarantined(spark, path).select(F.count(F.lit(1))).scalar()
    return out.select("doc_id", "text", "source", "lang", "domain", F.array_join("tokens", " ").alias("tokens_text"), "rest", bad.alias("quarantined"))


def line_index(spark, sf) -> LineIndex:
    return memo(spark, ("line-index", sf), lambda: LineIndex.build(spark, jsonl_dir(spark, sf), scratch_path(spark, "line-index")))


@query("jsonl_page", "WITH " + LINES_SQL + "\nSELECT line_no, doc_id, text FROM parsed WHERE line_no > 150 ORDER BY line_no LIMIT 200")
def jsonl_page(spark, sf):
    """A page by physical lines, read through the line index."""
    return doc_fields(line_index(spark, sf).page(150, 200)).select("line_no", "doc_id", "text")


@query("jsonl_page_valid", "WITH " + LINES_SQL + """
SELECT line_no, doc_id, text FROM (SELECT *, row_number() OVER (ORDER BY line_no) AS k FROM parsed) WHERE k > 150 AND k <= 350""")
def jsonl_page_valid(spark, sf):
    """A page by valid documents, read through the line index."""
    return doc_fields(line_index(spark, sf).page_valid(150, 200)).select("line_no", "doc_id", "text")


@query("jsonl_head", "WITH " + LINES_SQL + "\nSELECT line_no, doc_id, text FROM parsed WHERE line_no <= 300")
def jsonl_head(spark, sf):
    """Documents of the first 300 physical lines (the reader's row limit is the feature)."""
    return doc_fields(line_index(spark, sf).head(300)).select("line_no", "doc_id", "text")


@query("line_index_files", "WITH " + LINES_SQL + """
SELECT count(*) AS lines, count(*) FILTER (WHERE kind = 'ok') AS valid, true AS sums_fit FROM lines""")
def line_index_files(spark, sf):
    """Totals of the index, and whether its sums before each file fit them."""
    f = line_index(spark, sf).files()
    last = f.agg(F.max_by(F.struct((F.col("lines_before") + F.col("lines")).alias("l"), (F.col("valid_before") + F.col("valid")).alias("v")), "path").alias("x"),
                 F.sum("lines").alias("lines"), F.sum("valid").alias("valid"))
    return last.select("lines", "valid", ((F.col("x.l") == F.col("lines")) & (F.col("x.v") == F.col("valid"))).alias("sums_fit"))


@query("line_count", "WITH " + LINES_SQL + "\nSELECT count(*) AS lines FROM lines")
def line_count(spark, sf):
    return spark.read.text(jsonl_dir(spark, sf)).agg(F.count(F.lit(1)).alias("lines"))


@query("validate_jsonl_report", "WITH " + LINES_SQL + """
, nb AS (SELECT min(line_no) AS a, max(line_no) AS b FROM lines WHERE kind <> 'blank'),
w AS (SELECT * FROM lines WHERE line_no >= (SELECT a FROM nb) AND line_no < (SELECT a + least(100, b - a + 1) FROM nb))
SELECT (SELECT b - a + 1 FROM nb) AS total_lines, (SELECT least(100, b - a + 1) FROM nb) AS checked_lines,
       count(*) FILTER (WHERE kind = 'ok') AS valid_lines, count(*) FILTER (WHERE kind = 'bad') AS invalid_lines,
       count(*) FILTER (WHERE kind = 'blank') AS empty_lines,
       round(count(*) FILTER (WHERE kind = 'bad') / (SELECT least(100, b - a + 1) FROM nb), 6) AS invalid_rate,
       count(*) FILTER (WHERE kind = 'bad') / (SELECT least(100, b - a + 1) FROM nb) < 0.01 AS is_valid,
       CASE WHEN bool_or(kind = 'ok' AND NOT no_source) THEN 'doc_id,domain,lang,source,text,tokens,ts_raw'
            WHEN bool_or(kind = 'ok') THEN 'doc_id,domain,lang,text,tokens,ts_raw' ELSE '' END AS schema_fields,
       coalesce(bool_or(kind = 'ok' AND regexp_matches(coalesce(text, ''), '[가-힯ᄀ-ᇿ㄰-㆏]')), false) AS is_korean_content,
       coalesce(string_agg((line_no - (SELECT a FROM nb) + 1)::VARCHAR, ',' ORDER BY line_no) FILTER (WHERE kind = 'bad'), '') AS error_lines,
       coalesce(array_to_string(list_slice(list(line_no - (SELECT a FROM nb) + 1 ORDER BY line_no) FILTER (WHERE kind = 'ok'), 1, 5), ','), '') AS sample_lines
FROM w""")
def validate_jsonl_report(spark, sf):
    return va.jsonl_report(read_lines(spark, jsonl_dir(spark, sf)), 100)


@query("jsonl_field_names", "WITH " + LINES_SQL + """
SELECT name, count(*) AS n FROM (SELECT unnest(list_concat(['doc_id', 'text', 'lang', 'domain', 'tokens', 'ts_raw'],
                                                          CASE WHEN no_source THEN [] ELSE ['source'] END)) AS name FROM parsed) GROUP BY name""")
def jsonl_field_names(spark, sf):
    """Every key of the corpus, however many there are, with its lines."""
    return va.jsonl_field_names(spark.read.text(jsonl_dir(spark, sf)))


@query("validate_rows", "WITH " + LINES_SQL + """
SELECT line_no, reason = '' AS ok, reason FROM (
  SELECT line_no, CASE WHEN text IS NULL OR text = '' THEN 'Missing or empty field: text'
                       WHEN source IS NULL OR source = '' THEN 'Missing or empty field: source'
                       WHEN lang IS NULL OR lang = '' THEN 'Missing or empty field: lang'
                       WHEN domain IS NULL OR domain = '' THEN 'Missing or empty field: domain' ELSE '' END AS reason
  FROM parsed)""")
def validate_rows(spark, sf):
    p = parsed_lines(spark, sf)
    ok, reason = va.row_validity()
    return p.select("line_no", ok.alias("ok"), reason.alias("reason"))


@query("valid_counts", "WITH " + LINES_SQL + """
SELECT (text IS NOT NULL AND text <> '' AND source IS NOT NULL AND source <> '' AND lang IS NOT NULL AND lang <> ''
        AND domain IS NOT NULL AND domain <> '') AS valid, count(*) AS n FROM parsed GROUP BY ALL""")
def valid_counts(spark, sf):
    p = io.parsed_jsonl(spark, jsonl_dir(spark, sf))
    ok, _ = va.row_validity()
    return p.groupBy(ok.alias("valid")).agg(F.count(F.lit(1)).alias("n"))


@query("schema_check", "WITH " + LINES_SQL + """
SELECT line_no, concat_ws(',', CASE WHEN text IS NULL THEN 'text (empty)' END,
                               CASE WHEN no_source THEN 'source' END,
                               CASE WHEN lang = '' THEN 'lang (empty)' END,
                               CASE WHEN domain = '' THEN 'domain (empty)' END) AS missing FROM parsed""")
def schema_check(spark, sf):
    p = parsed_lines(spark, sf)
    return p.select("line_no", va.schema_missing().alias("missing"))


@query("clean_to_schema", "WITH " + LINES_SQL + """
SELECT line_no, text, len(tokens)::INTEGER AS n_tokens, array_to_string(tokens, ' ') AS tokens_text, source, lang, domain
FROM parsed WHERE NOT no_source AND text IS NOT NULL AND trim(text) <> ''""")
def clean_to_schema(spark, sf):
    c = va.clean_to_schema(parsed_lines(spark, sf))
    return c.select("line_no", "text", F.size("tokens").alias("n_tokens"), F.array_join("tokens", " ").alias("tokens_text"),
                    "source", "lang", "domain")


@query("contains_korean", f"""
SELECT doc_id, 'documents' AS src, coalesce(regexp_matches(text, '[가-힯ᄀ-ᇿ㄰-㆏]'), false) AS has_korean FROM documents
UNION ALL
SELECT doc_id, 'hangul', coalesce(regexp_matches(translate(lower(text), '{fx.LATIN}', '{fx.HANGUL_MAP}'), '[가-힯ᄀ-ᇿ㄰-㆏]'), false) FROM documents""")
def contains_korean(spark, sf):
    # one scan: both renderings of each row come out of a two-element explode
    d = table(spark, sf, "documents")
    hangul_text = F.translate(F.lower("text"), fx.LATIN, fx.HANGUL_MAP)
    both = F.array(F.struct(F.lit("documents").alias("src"), tx.contains_korean("text").alias("has_korean")),
                   F.struct(F.lit("hangul").alias("src"), tx.contains_korean(hangul_text).alias("has_korean")))
    return d.select("doc_id", F.explode(both).alias("r")).select("doc_id", "r.src", "r.has_korean")


# Letters turned into symbols so that every text has some.
SYMBOLS = ("eao", "\u2600\u263a\u2605")


@query("strip_emoji", f"""
SELECT doc_id, replace(replace(replace(text, 'e', ''), 'a', ''), 'o', '') AS text,
       (length(text) - length(replace(replace(replace(text, 'e', ''), 'a', ''), 'o', '')))::INTEGER AS removed_chars FROM documents""")
def strip_emoji(spark, sf):
    """Symbols out of texts whose letters e, a and o were made symbols."""
    d = table(spark, sf, "documents").select("doc_id", F.translate("text", *SYMBOLS).alias("text"))
    clean = tx.strip_emoji("text")
    return d.select("doc_id", clean.alias("text"), (F.length("text") - F.length(clean)).alias("removed_chars"))


# ------------------------------------------------------------------ statistics over the corpus projection

CORPUS_SQL = """corpus AS (
  SELECT doc_id, text, lang, source,
         ['main_data','textbook','assembly','web','social'][(doc_id % 5)::INT + 1] AS domain,
         string_split(""" + O.norm_text("text") + """, ' ') AS tokens,
         CASE doc_id % 5 WHEN 0 THEN strftime(DATE '2024-01-01' + (doc_id % 365)::INT, '%Y-%m-%d') || ' 12:34:56'
                         WHEN 1 THEN strftime(DATE '2024-01-01' + (doc_id % 365)::INT, '%Y-%m-%d') || 'T08:00:00'
                         WHEN 2 THEN strftime(DATE '2024-01-01' + (doc_id % 365)::INT, '%Y-%m-%d')
                         WHEN 3 THEN 'not a date' END AS ts_raw
  FROM documents)"""


def _field_sql(name: str, covered: str, value: str) -> str:
    return (f"SELECT '{name}' AS field, round(count(*) FILTER (WHERE {covered}) / count(*), 6) AS coverage, "
            f"count(DISTINCT CASE WHEN {covered} THEN {value} END) AS unique_values FROM corpus")


FIELD_STATS_SQL = "WITH " + CORPUS_SQL + "\n" + "\nUNION ALL\n".join([
    _field_sql("doc_id", "doc_id IS NOT NULL", "doc_id::VARCHAR"),
    _field_sql("text", "text IS NOT NULL AND text <> ''", "text"),
    _field_sql("lang", "lang IS NOT NULL AND lang <> ''", "lang"),
    _field_sql("source", "source IS NOT NULL AND source <> ''", "source"),
    _field_sql("domain", "domain IS NOT NULL AND domain <> ''", "domain"),
    _field_sql("tokens", "tokens IS NOT NULL", "tokens::VARCHAR"),
    _field_sql("ts_raw", "ts_raw IS NOT NULL AND ts_raw <> ''", "ts_raw"),
])


@query("field_stats", FIELD_STATS_SQL)
def field_stats(spark, sf):
    return st.field_stats(fx.corpus(spark, sf))


@query("text_stats", "WITH " + CORPUS_SQL + """
SELECT count(*) AS total_documents, round(avg(length(text)) FILTER (WHERE text <> ''), 6) AS avg_length,
       (min(length(text)) FILTER (WHERE text <> ''))::INTEGER AS min_length, (max(length(text)) FILTER (WHERE text <> ''))::INTEGER AS max_length,
       (sum(length(text)) FILTER (WHERE text <> ''))::BIGINT AS total_characters FROM corpus HAVING count(*) > 0""")
def text_stats(spark, sf):
    return st.text_stats(fx.corpus(spark, sf))


@query("value_distribution", "WITH " + CORPUS_SQL + """
SELECT 'domain' AS dimension, domain AS value, count(*) AS n FROM corpus GROUP BY domain
UNION ALL SELECT 'lang', lang, count(*) FROM corpus GROUP BY lang
UNION ALL SELECT 'source', source, count(*) FROM corpus GROUP BY source""")
def value_distribution(spark, sf):
    return st.value_distribution(fx.corpus(spark, sf))


@query("size_estimate", "WITH " + CORPUS_SQL + """
, g AS (SELECT domain, count(*) AS num_documents, avg(length(text)) AS a FROM corpus GROUP BY domain)
SELECT domain, num_documents, round(a, 6) AS avg_doc_size, round(num_documents * a * 1.2 / 1048576, 2) AS jsonl_mb,
       round(num_documents * a * 1.2 / 1048576 * 0.3, 2) AS parquet_mb,
       CASE WHEN num_documents * a * 1.2 / 1048576 * 0.3 > 0 THEN round(1 / 0.3, 2) ELSE 0.0 END AS compression_ratio FROM g""")
def size_estimate(spark, sf):
    return st.size_estimate(fx.corpus(spark, sf))


# Source names given out by doc_id % 9 (the last matches none).
NAMED = ["Wikipedia dump", "daily news", "book scans", "academic", "government", "social", "web crawl", "forum posts", "other"]

QUALITY_INPUT_SQL = f"""
, q AS (SELECT doc_id, lang, domain, tokens, [{', '.join(repr(n) for n in NAMED)}][(doc_id % 9)::INT + 1] AS source,
         CASE WHEN doc_id % 4 = 0 THEN translate(lower(text), '{fx.LATIN}', '{fx.HANGUL_MAP}') ELSE text END AS text FROM corpus)"""


@query("quality_score", "WITH " + CORPUS_SQL + QUALITY_INPUT_SQL + f"""
SELECT doc_id, round({quality_sql('text', 'source', "(CASE WHEN coalesce(source, '') <> '' THEN 1 ELSE 0 END) + (CASE WHEN coalesce(domain, '') <> '' THEN 1 ELSE 0 END) + (CASE WHEN coalesce(lang, '') <> '' THEN 1 ELSE 0 END) + (CASE WHEN len(tokens) > 0 THEN 1 ELSE 0 END)")}, 6) AS score
FROM q""")
def quality_score(spark, sf):
    """Scores with every source name in use and a quarter of the texts in Hangul."""
    i = F.col("doc_id")
    c = fx.corpus(spark, sf).withColumns({
        "source": F.element_at(F.array(*[F.lit(n) for n in NAMED]), (i % 9 + 1).cast("int")),
        "text": F.when(i % 4 == 0, F.translate(F.lower("text"), fx.LATIN, fx.HANGUL_MAP)).otherwise(F.col("text"))})
    return c.select("doc_id", F.round(scoring.quality_score(c.dtypes), 6).alias("score"))


@query("parse_timestamps", "WITH " + CORPUS_SQL + """
SELECT doc_id, coalesce(try_strptime(ts_raw, '%Y-%m-%d %H:%M:%S'), try_strptime(ts_raw, '%Y-%m-%dT%H:%M:%S'),
                        try_strptime(ts_raw, '%Y-%m-%d')) AS ts,
       make_timestamp((1700000000 + doc_id * 3601) * 1000000) AS from_number,
       CASE WHEN doc_id % 2 = 0 THEN make_timestamp((1700000000 + doc_id * 3601) * 1000000)
            ELSE make_timestamp(2024, (1 + doc_id % 12)::INT, (1 + doc_id % 28)::INT, (doc_id % 24)::INT, 5, 9) END AS from_json FROM corpus""")
def parse_timestamps(spark, sf):
    """Text layouts, epoch numbers, and JSON values that are one or the other
    (unpadded text on odd ids)."""
    c = fx.corpus(spark, sf)
    i = F.col("doc_id")
    number = F.lit(1700000000) + i * 3601
    loose = F.format_string("2024-%d-%d %d:5:9", 1 + i % 12, 1 + i % 28, i % 24)
    value = F.when(i % 2 == 0, F.to_json(F.struct(number.alias("t")))).otherwise(F.to_json(F.struct(loose.alias("t"))))
    c = c.withColumn("_t", F.variant_get(F.parse_json(value), "$.t", "variant"))
    return c.select("doc_id", scoring.parse_timestamp(F.col("ts_raw")).alias("ts"),
                    scoring.parse_timestamp(number, numeric=True).alias("from_number"),
                    scoring.parse_timestamp_variant(F.col("_t")).alias("from_json"))


# ------------------------------------------------------------------ mergeable statistics

def profile_store(spark, sf):
    """Sketch rows per file and domain, written once; reports read only these."""
    def build():
        path = scratch_path(spark, "profile")
        c = fx.corpus(spark, sf).withColumn("file", F.lit("documents.parquet"))
        pf.profile_rows(c, ["file", "domain"], ["text", "lang", "source"], top=("lang", "source")).write.parquet(path)
        return path
    return memo(spark, ("profile", sf), build)


@query("profile_merged", "WITH " + CORPUS_SQL + """
, l AS (SELECT unnest([{'f': 'text', 'v': text}, {'f': 'lang', 'v': lang}, {'f': 'source', 'v': source}]) AS s FROM corpus),
v AS (SELECT s.f AS field, nullif(s.v, '') AS v FROM l)
SELECT field, count(*) AS rows, count(v) AS covered, round(count(v) / count(*), 6) AS coverage, coalesce(sum(length(v)), 0)::BIGINT AS chars,
       min(length(v)) AS min_len, max(length(v)) AS max_len, true AS distinct_within, true AS median_within, true AS most_frequent_exact
FROM v GROUP BY field""")
def profile_merged(spark, sf):
    """Statistics merged from stored sketch rows: exact figures, and whether the
    estimates lie within their stated errors of the exact ones."""
    rows = spark.read.parquet(profile_store(spark, sf))
    merged = pf.report(pf.merge_rows(rows), (0.5,), 3)
    c = fx.corpus(spark, sf).select("text", "lang", "source")
    long = c.select(F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.nullif(F.col(f), F.lit("")).alias("v")) for f in c.columns])).alias("s")).select("s.*")
    exact = long.groupBy("field").agg(F.count_distinct("v").alias("d"), F.max(F.when(F.col("field") == "text", None).otherwise(F.lit(1))).alias("short"))
    ranks = long.join(merged.select("field", F.col("length_quantiles")[0].alias("m")), "field").groupBy("field").agg(
        F.avg((F.length("v") < F.col("m")).cast("double")).alias("below"), F.avg((F.length("v") <= F.col("m")).cast("double")).alias("upto"))
    most = long.where("field <> 'text'").groupBy("field", "v").agg(F.count("v").alias("k")).groupBy("field").agg(F.max("k").alias("k"))
    j = merged.join(exact, "field").join(ranks, "field").join(most, "field", "left")
    return j.select("field", "rows", "covered", "coverage", "chars", F.col("min_len"), F.col("max_len"),
                    (F.abs(F.col("distinct_values") - F.col("d")) <= 1 + 5 * 0.0163 * F.col("d")).alias("distinct_within"),
                    ((F.col("below") <= 0.53) & (F.col("upto") >= 0.47)).alias("median_within"),
                    F.coalesce(F.get("frequent_values", F.lit(0))["count"] == F.col("k"), F.lit(True)).alias("most_frequent_exact"))


@query("profile_by_domain", "WITH " + CORPUS_SQL + """
SELECT domain, count(*) AS rows, sum(length(text))::BIGINT AS chars, max(length(text)) AS max_len FROM corpus GROUP BY domain""")
def profile_by_domain(spark, sf):
    """The same stored rows merged to domains."""
    rows = spark.read.parquet(profile_store(spark, sf)).where("field = 'text'")
    return pf.merge_rows(rows, ["domain"]).select("domain", "rows", "chars", "max_len")
