"""Streaming ingest: several micro-batches, then a restart on the same
checkpoint adds nothing (exactly-once file sink)."""

import json
import os

from pyspark.sql import functions as F

from winnow.streaming import ingest


def test_stream_ingest_restart(spark, tmpdir_session):
    src = os.path.join(tmpdir_session, "stream_src")
    os.makedirs(src, exist_ok=True)
    for k in range(3):
        with open(os.path.join(src, f"part-{k:05d}.jsonl"), "w", encoding="utf-8") as f:
            for i in range(4):
                d = k * 4 + i
                f.write(json.dumps({"doc_id": d, "text": f"문서 {d}", "source": "s", "lang": "ko", "domain": "web",
                                    "tokens": ["t"], "extra": {"n": d}},
                                   ensure_ascii=False) + "\n")
            f.write("{bad\n\n")
    out = os.path.join(tmpdir_session, "stream_out")
    first = ingest.stream_jsonl_to_parquet(spark, src, out, max_files_per_trigger=1)
    assert sorted(r.doc_id for r in first.collect()) == list(range(12))
    assert all(json.loads(r.rest) == {"extra": {"n": r.doc_id}} and r.tokens == ["t"] for r in first.collect())
    assert [r.value for r in ingest.quarantined(spark, out).collect()] == ["{bad"] * 3
    again = ingest.stream_jsonl_to_parquet(spark, src, out, max_files_per_trigger=1)
    assert again.count() == 12
    with open(os.path.join(src, "part-00003.jsonl"), "w", encoding="utf-8") as f:
        f.write(json.dumps({"doc_id": 99, "text": "new", "source": "s", "lang": "en", "domain": "web"}) + "\n")
    third = ingest.stream_jsonl_to_parquet(spark, src, out, max_files_per_trigger=1)
    assert sorted(r.doc_id for r in third.collect()) == list(range(12)) + [99]


def lines_in(folder, parts):
    os.makedirs(folder, exist_ok=True)
    for name, lines in parts.items():
        with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
            f.write("".join(x + "\n" for x in lines))
    return folder


def test_source_is_read_once_and_bad_lines_name_their_file(spark, tmp_path):
    src = lines_in(str(tmp_path / "src"), {"a.jsonl": ['{"doc_id": 1}', "{bad", ""], "b.jsonl": ['{"doc_id": 2, "x": null}', "oops", "[1]"]})
    q = ingest.start_ingest(spark, src, str(tmp_path / "out"))
    q.awaitTermination()
    assert sum(p["numInputRows"] for p in q.recentProgress) == 6  # every line once, for both kinds of rows
    bad = {(r.value, os.path.basename(r.file)) for r in ingest.quarantined(spark, str(tmp_path / "out")).collect()}
    assert bad == {("{bad", "a.jsonl"), ("oops", "b.jsonl")}
    good = [(r.doc_id, r.rest) for r in ingest.ingested(spark, str(tmp_path / "out")).collect()]
    assert sorted(good, key=str) == sorted([(1, "{}"), (2, '{"x":null}'), (None, None)], key=str)


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    out = str(tmp_path / "out")
    lines = spark.createDataFrame([('{"doc_id": 1}', "f"), ("{bad", "f"), ('{"doc_id": 2}', "g")], "value string, file string")
    other = spark.createDataFrame([('{"doc_id": 3}', "h")], "value string, file string")
    write = ingest.write_batch(out)
    write(lines, 0)
    write(other, 1)

    def state():
        return sorted(r.doc_id for r in ingest.ingested(spark, out).collect()), [tuple(r) for r in ingest.quarantined(spark, out).collect()]
    before = state()
    assert before == ([1, 2, 3], [("{bad", "f", 0)])
    write(lines, 0)  # the same batch again, as after a crash behind the write
    assert state() == before
    half = lines.where(F.col("file") == "f")
    write(half, 1)
    write(other, 1)  # a batch that had written other rows before it was run again
    assert state() == before


def test_only_bad_or_no_lines(spark, tmp_path):
    src = lines_in(str(tmp_path / "src"), {"a.jsonl": ["{bad", ""]})
    assert ingest.stream_jsonl_to_parquet(spark, src, str(tmp_path / "out")).count() == 0
    assert ingest.quarantined(spark, str(tmp_path / "out")).count() == 1
