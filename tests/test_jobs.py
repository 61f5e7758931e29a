"""End-to-end jobs on small JSONL files."""

import json
import os

import pytest

from winnow.plans import curate

DOCS = [{"text": "하늘이 맑고 바람이 분다", "source": "diary", "domain": "nature", "lang": "ko", "url": "u/1", "timestamp": 1700000000},
        {"text": "하늘이  맑고\t바람이 분다", "source": " diary ", "domain": "nature", "lang": "ko", "url": "u/2", "timestamp": "2024-1-5"},
        {"text": "the ferry leaves the harbour at noon", "domain": "travel", "lang": "en", "meta": {"score": 3, "tags": [1, None]}},
        {"text": "하늘이 맑고 바람이 분다 그리고 비가 온다", "source": "diary", "domain": "travel", "lang": "ko", "timestamp": None},
        {"source": "no text"}]


def write(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")
    return path


def as_lines(docs):
    return [json.dumps(d, ensure_ascii=False) for d in docs]


def test_dedup_job_keeps_every_field(spark, tmpdir_session):
    src = write(os.path.join(tmpdir_session, "job", "in.jsonl"), as_lines(DOCS))
    out = os.path.join(tmpdir_session, "job_out")
    st = curate.dedup_job(spark, [src], out)
    assert st["original_count"] == 4 and st["removed_count"] == 1
    kept = {d["doc_id"]: d for d in (json.loads(r.value) for r in spark.read.text(out + "/kept").collect())}
    assert sorted(kept) == [1, 3, 4]
    for line, d in kept.items():
        want = dict(DOCS[line - 1], doc_id=line)
        assert d == want  # undeclared, nested and null values as they came
    assert spark.read.text(out + "/sample_preview").count() == 4
    assert spark.read.option("header", True).csv(out + "/dedup_log").count() == 1


def test_newest_strategy_reads_numbers_and_unpadded_dates(spark, tmpdir_session):
    same = "a sentence that is long enough to be indexed here"
    docs = [{"text": same, "timestamp": "2023-1-5"}, {"text": same, "timestamp": 1700000000}, {"text": same, "timestamp": "2023-02-03 1:2:3"}]
    src = write(os.path.join(tmpdir_session, "newest", "in.jsonl"), as_lines(docs))
    out = os.path.join(tmpdir_session, "newest_out")
    curate.dedup_job(spark, [src], out, strategy="newest")
    assert [json.loads(r.value)["timestamp"] for r in spark.read.text(out + "/kept").collect()] == [1700000000]


def test_every_input_is_checked(spark, tmpdir_session):
    good = write(os.path.join(tmpdir_session, "two", "a.jsonl"), as_lines([{"text": f"fine line number {i}"} for i in range(120)]))
    bad = write(os.path.join(tmpdir_session, "two", "b.jsonl"), ["{not json"] * 5)
    with pytest.raises(ValueError, match="b.jsonl"):
        curate.dedup_job(spark, [good, bad], os.path.join(tmpdir_session, "two_out"))


def test_convert_job(spark, tmpdir_session):
    src = write(os.path.join(tmpdir_session, "conv", "in.jsonl"), as_lines(DOCS))
    out = os.path.join(tmpdir_session, "conv_out")
    got = {r.domain: (r.num_rows, r.is_valid) for r in curate.convert_job(spark, src, out).collect()}
    assert got == {"nature": (2, True), "travel": (2, True), "unknown": (1, True)}


def test_intermediate_folder_must_be_shared():
    from winnow import session
    assert session.is_local("local[4]") and session.is_local("local")
    assert not session.is_local("local-cluster[2,1,1024]") and not session.is_local("yarn")

    class Conf:
        def get(self, *_):
            return None

    class Cluster:
        conf = Conf()

        class sparkContext:
            master = "spark://host:7077"
            getCheckpointDir = staticmethod(lambda: None)
            getConf = staticmethod(lambda: Conf())

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Cluster())
