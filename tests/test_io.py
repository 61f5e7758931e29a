"""Sources and sinks on literal fixtures (FIXTURES.md A2/A3/A6)."""

import json
import os

from pyspark.sql import functions as F

from winnow.operators import validate as va
from winnow.sources import io
from winnow.sources.lines import read_lines

DOCS = [{"text": "바닷가에 작은 등대가 서 있다.", "source": "a1", "domain": "coast", "lang": "ko"},
        {"text": "Three boats wait for the tide.", "source": "a2", "domain": "ships", "lang": "en"},
        {"text": "산길을 따라 오래 걸었다. 해가 졌다.", "source": "a3", "domain": "coast", "lang": "ko"}]


def write(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")
    return path


def test_read_jsonl(spark, tmpdir_session):
    p = write(os.path.join(tmpdir_session, "a", "docs.jsonl"), [json.dumps(d, ensure_ascii=False) for d in DOCS] + ["", "{bad"])
    rows = io.read_jsonl(spark, p).select("line_no", va.field("source").alias("s")).orderBy("line_no").collect()
    assert [(r.line_no, r.s) for r in rows] == [(1, "a1"), (2, "a2"), (3, "a3")]
    assert [r.line_no for r in io.quarantine(spark, p).collect()] == [5]


def test_report(spark, tmpdir_session):
    good = write(os.path.join(tmpdir_session, "r1", "x.jsonl"),
                 [json.dumps({"text": d["text"], "source": d["source"]}, ensure_ascii=False) for d in DOCS])
    r = va.jsonl_report(read_lines(spark, good)).first()
    assert r.is_valid and (r.valid_lines, r.invalid_lines) == (3, 0) and r.is_korean_content
    assert r.schema_fields == "source,text"
    bad = write(os.path.join(tmpdir_session, "r2", "x.jsonl"),
                [json.dumps(DOCS[0], ensure_ascii=False), "[1, oops", json.dumps(DOCS[1])])
    r = va.jsonl_report(read_lines(spark, bad)).first()
    assert not r.is_valid and (r.valid_lines, r.invalid_lines) == (2, 1)
    assert (r.error_lines, r.sample_lines) == ("2", "1,3")
    whole = va.jsonl_report(read_lines(spark, bad), None).first()
    assert whole.asDict() == r.asDict()
    errors = va.jsonl_errors(read_lines(spark, bad)).collect()
    assert [(e.line_no, e.value) for e in errors] == [(2, "[1, oops")] and errors[0].error
    assert [x.line_no for x in va.jsonl_samples(read_lines(spark, bad)).collect()] == [1, 3]
    empty = write(os.path.join(tmpdir_session, "r3", "x.jsonl"), ["", "  "])
    assert va.jsonl_report(read_lines(spark, empty)).first().total_lines == 1


def test_range_parts_starts_no_job(spark):
    from winnow.operators.partitioning import range_parts, spread
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count().join(spark.range(7).withColumnRenamed("id", "k"), "k")
    spark.sparkContext.setJobGroup("count-jobs", "parts")
    try:
        assert range_parts(df) >= 4
        spread(df)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("count-jobs")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_write_by_domain_bounds_files(spark, tmpdir_session):
    df = spark.range(1000, numPartitions=20).select("id", F.when(F.col("id") < 600, "big").when(F.col("id") < 990, "mid").alias("domain"))
    out = os.path.join(tmpdir_session, "by-domain")
    io.write_by_domain(df, out, max_records=300)
    files = {d: len([f for f in os.listdir(os.path.join(out, d)) if f.endswith(".parquet")]) for d in os.listdir(out) if "=" in d}
    assert files["domain=unknown"] == 1 and files["domain=big"] <= 4 and files["domain=mid"] <= 4
    assert {r[0]: r[1] for r in spark.read.parquet(out).groupBy("domain").count().collect()} == {"big": 600, "mid": 390, "unknown": 10}


def test_row_validity(spark):
    df = spark.createDataFrame([('{"text":"tide","source":"log"}',), ('{"text":""}',), ('[1]',)], "value string")
    ok, reason = va.row_validity(["text", "source"])
    got = [(r.ok, r.reason) for r in va.parse(df).select(ok.alias("ok"), reason.alias("reason")).collect()]
    assert got == [(True, ""), (False, "Missing or empty field: text"), (False, "Not a JSON object")]


def test_convert_and_schema(spark, tmpdir_session):
    src = write(os.path.join(tmpdir_session, "c", "in.jsonl"), ['{"text":"a","tokens":["a"]}', '{"text":"b","tokens":["b"]}'])
    out = os.path.join(tmpdir_session, "c_out")
    df = io.convert_jsonl_to_parquet(spark, src, out, [("text", "string"), ("tokens", "list[string]")])
    assert sorted((r.text, tuple(r.tokens)) for r in df.collect()) == [("a", ("a",)), ("b", ("b",))]
    assert [r.value for r in spark.read.text(out + "_schema").collect()] == ["text:string", "tokens:array<string>"]
    assert io.validate_parquet(spark, out).first().is_valid


def test_list_files_suffix(spark, tmpdir_session):
    for n in ["day.jsonl", "notes.md", "night.jsonl"]:
        write(os.path.join(tmpdir_session, "l", "deep", n), ["{}"])
    got = io.list_files(spark, os.path.join(tmpdir_session, "l"), "*.jsonl").collect()
    assert sorted(os.path.basename(r.path) for r in got) == ["day.jsonl", "night.jsonl"]


def test_parse_uri(spark):
    df = spark.createDataFrame([("s3://store-7/a/b/c.jsonl",), ("gs://b/k",), ("azure://c/d/e",), ("bucket",)], "u string")
    b, k = io.parse_uri(F.col("u"))
    assert [(r.b, r.k) for r in df.select(b.alias("b"), k.alias("k")).collect()] == [
        ("store-7", "a/b/c.jsonl"), ("b", "k"), ("c", "d/e"), ("bucket", "")]


def test_line_numbers_span_files(spark, tmpdir_session):
    d = os.path.join(tmpdir_session, "ln")
    write(os.path.join(d, "part-00000.txt"), ["a", "b"])
    write(os.path.join(d, "part-00001.txt"), ["c", "", "e"])
    got = [(r.line_no, r.value) for r in read_lines(spark, d).orderBy("line_no").collect()]
    assert got == [(1, "a"), (2, "b"), (3, "c"), (4, ""), (5, "e")]


def test_clean_to_schema_coercions(spark):
    rows = ['{"text":"a","tokens":"x","source":"s","lang":3,"domain":"d"}',
            '{"text":"b","tokens":null,"source":null,"lang":"en","domain":"d"}',
            '{"text":"c","tokens":["p","q"],"source":"s","lang":"en","domain":"d"}',
            '{"text":"d","tokens":5,"source":"s","lang":"en","domain":"d"}',
            '{"text":"  ","tokens":[],"source":"s","lang":"en","domain":"d"}',
            '{"text":"e","source":"s","lang":"en","domain":"d"}']
    df = spark.createDataFrame([(r,) for r in rows], "value string")
    got = [(r.text, r.tokens, r.source, r.lang) for r in va.clean_to_schema(va.parse(df)).collect()]
    assert got == [("a", ["x"], "s", "3"), ("b", [], "", "en"), ("c", ["p", "q"], "s", "en"), ("d", [], "s", "en")]


def test_schema_missing(spark):
    df = spark.createDataFrame([('{"text":null,"lang":"","domain":"d"}',)], "value string")
    assert va.parse(df).select(va.schema_missing().alias("m")).first().m == "text (empty),source,lang (empty)"


def test_normalize_docs(spark):
    from winnow.operators import dedup as dd
    df = spark.createDataFrame([(1, " a\u3000 b ", " en "), (2, "", "ko"), (3, None, None)], "doc_id long, text string, lang string")
    got = [(r.doc_id, r.text, r.lang) for r in dd.normalize_docs(df).orderBy("doc_id").collect()]
    assert got == [(1, "a b", "en"), (2, None, "ko"), (3, None, None)]


def test_numbered_lines_are_not_shuffled(spark, tmp_path):
    """Only the counts of the splits move: the lines meet them in a broadcast join."""
    from winnow.sources.lines import read_lines
    (tmp_path / "a.txt").write_text("".join(f"line {i}\n" for i in range(50)))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = read_lines(spark, str(tmp_path / "a.txt"))
        plan = lines._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        assert [(r.line_no, r.value) for r in lines.orderBy("line_no").collect()] == [(i + 1, f"line {i}") for i in range(50)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_by_domain_layout_bounds_the_bytes_of_a_task(spark, tmp_path, monkeypatch):
    """Few, long rows: a domain is cut by its bytes, with no row lost, and no
    shuffle brings a whole domain into one task."""
    import glob
    from winnow.sources import io
    rows = [(i, "x" * 1000, ["y" * 500] * 2, "big" if i % 10 else None) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, tokens array<string>, domain string")
    monkeypatch.setattr(io, "TASK_BYTES", 50_000, raising=False)
    out = str(tmp_path / "out")
    io.write_by_domain(df, out)
    assert 10 <= len(glob.glob(out + "/domain=big/*.parquet")) <= 15 and 1 <= len(glob.glob(out + "/domain=unknown/*.parquet")) <= 2
    assert sorted(map(tuple, spark.read.parquet(out).select("doc_id", "text", "tokens", "domain").collect())) == \
        sorted((i, t, k, d or "unknown") for i, t, k, d in rows)


def test_z_order_bucket_is_found_in_a_few_steps(spark):
    from pyspark.sql import functions as F
    from winnow.sources import io
    for n in (0, 1, 2, 3, 6, 7):
        edges = [float(3 * i) for i in range(n)]
        at = io._rank(F.array(*[F.lit(x) for x in edges]).cast("array<double>"), F.col("v"), 3)
        got = spark.createDataFrame([(float(v),) for v in range(-2, 24)] + [(float("nan"),)], "v double").select("v", at.alias("k")).collect()
        assert [r.k for r in got] == [sum(e < v for e in edges) for v in range(-2, 24)] + [n]
