"""Paging through the line index against plain Python over the files."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from winnow.operators import validate as va
from winnow.sources import lineindex as li


def corpus(folder, seed=1, files=6):
    """Files with good, broken and blank lines; returns all lines in path order."""
    rng = random.Random(seed)
    os.makedirs(folder, exist_ok=True)
    out, k = [], 0
    for i in range(files):
        lines = []
        for _ in range(rng.choice((0, 1, 7, 30))):
            k += 1
            lines.append(rng.choice([json.dumps({"id": k, "text": f"t{k}"})] * 4 + ["{bad", "", "  "]))
        with open(os.path.join(folder, f"part {i:02d}+x.jsonl"), "w", encoding="utf-8") as f:
            f.write("".join(x + "\n" for x in lines))
        out += lines
    return out


def valid(lines):
    """(line number, id) of the valid documents."""
    return [(n, json.loads(x)["id"]) for n, x in enumerate(lines, 1) if x.startswith('{"')]


def got(df):
    return sorted((r.line_no, r.id) for r in df.select("line_no", va.field("id", "bigint").alias("id")).collect())


@pytest.fixture(params=[134217728, 100], ids=["whole files", "many splits"])
def split(request, spark):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, str(request.param))
    yield
    spark.conf.set(key, before)


def test_pages(spark, tmp_path, split):
    lines = corpus(tmp_path / "in")
    index = li.LineIndex.build(spark, str(tmp_path / "in"), str(tmp_path / "index"))
    docs = valid(lines)
    for start in (0, 3, len(lines) // 2, len(lines) - 1, len(lines), len(lines) + 5):
        for size in (1, 5, 1000):
            assert got(index.page(start, size)) == [d for d in docs if d[0] > start][:size], (start, size)
    for start in (0, 4, len(docs) - 1, len(docs)):
        for size in (1, 6, 1000):
            assert got(index.page_valid(start, size)) == docs[start:start + size], (start, size)
    for n in (0, 1, 12, 10_000):
        assert got(index.head(n)) == [d for d in docs if d[0] <= n]


def test_a_page_reads_only_its_files(spark, tmp_path):
    corpus(tmp_path / "in", seed=3)
    index = li.LineIndex.build(spark, str(tmp_path / "in"), str(tmp_path / "index"))
    rows = index.files().orderBy("path").collect()
    third = rows[[r.lines > 5 for r in rows].index(True)]
    page = index.page_valid(third.valid_before, min(2, third.valid))
    assert {os.path.basename(f) for f in page.inputFiles() if "/in/" in f} == {os.path.basename(third.path).replace(" ", "%20").replace("+", "+")}
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "Scan ExistingRDD" not in plan  # no range sort, no checkpoint


def test_refresh_counts_new_and_changed_files_alone(spark, tmp_path):
    lines = corpus(tmp_path / "in", seed=5)
    index = li.LineIndex.build(spark, str(tmp_path / "in"), str(tmp_path / "index"))
    assert index.refresh() == 0
    with open(tmp_path / "in" / "part 99.jsonl", "w") as f:
        f.write('{"id": 777}\n{"id": 778}\n')
    assert index.refresh() == 1 and li.LineIndex(spark, str(tmp_path / "in"), str(tmp_path / "index")).files().agg(F.sum("lines")).first()[0] == len(lines) + 2
    assert got(index.page_valid(len(valid(lines)), 10)) == [(len(lines) + 1, 777), (len(lines) + 2, 778)]
    with open(tmp_path / "in" / "part 99.jsonl", "a") as f:
        f.write('{"id": 779}\n')
    with pytest.raises(ValueError, match="older"):
        index.page_valid(len(valid(lines)), 10)
    assert index.refresh() == 1
    assert [i for _, i in got(index.page_valid(len(valid(lines)), 10))] == [777, 778, 779]


def test_empty_corpus(spark, tmp_path):
    os.makedirs(tmp_path / "in")
    (tmp_path / "in" / "none.jsonl").write_text("")
    index = li.LineIndex.build(spark, str(tmp_path / "in"), str(tmp_path / "index"))
    assert index.page(0, 5).count() == index.page_valid(0, 5).count() == index.head(5).count() == 0
