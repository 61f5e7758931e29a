"""All phases in one run: restart behind the last good stage, gates, dependence."""

import json
import os

import pytest
from pyspark.sql import functions as F

from winnow.plans import flow
from winnow.sources.lines import read_lines, write_lines

TEXTS = [" ".join(f"{w}{c}{i}" for c in "abcdefgh") for i, w in enumerate(["boat", "tide", "hill", "lamp", "rope", "coin", "leaf", "door"])]


@pytest.fixture
def inputs(spark, tmp_path):
    at = {n: str(tmp_path / "in" / n) for n in ("docs", "params", "weights", "pairs")}
    os.makedirs(at["docs"])
    with open(os.path.join(at["docs"], "a.jsonl"), "w", encoding="utf-8") as f:
        for i, t in enumerate(TEXTS + TEXTS[:3]):
            f.write(json.dumps({"text": t, "source": f"s{i}", "lang": "en", "domain": "web" if i % 2 else "news", "tokens": ["t"]}) + "\n")
    spark.createDataFrame([("base", "w1", [1.0, 1.0]), ("m1", "w1", [1.2, 0.8]), ("base", "w2", [2.0]), ("m1", "w2", [1.0])],
                          "model string, name string, vec array<double>").write.parquet(at["params"])
    spark.createDataFrame([("m1", 0.5)], "model string, weight double").write.parquet(at["weights"])
    spark.createDataFrame([(1, "p", "the tide comes in at noon today", "the tide comes in at noon"), (2, "q", "boats wait here", "boats wait here")],
                          "pair_id long, prompt string, reference string, prediction string").write.parquet(at["pairs"])
    return at


def run(spark, stages, inputs, root):
    return {r.phase: (r.rows, r.reused) for r in flow.run_stages(spark, stages, inputs, root).collect()}


def test_a_killed_run_goes_on_behind_the_last_good_stage(spark, inputs, tmp_path):
    root, calls = str(tmp_path / "out"), []

    def counted(s, fail=False):
        def go(spark_, paths, out, params):
            calls.append(s.name)
            s.run(spark_, paths, out, params)
            if fail:
                raise RuntimeError("killed")  # the output is there, the manifest is not
        return flow.Stage(s.name, go, s.gate, s.inputs, s.needs, s.params)
    with pytest.raises(RuntimeError, match="killed"):
        run(spark, [counted(s, s.name == "merge") for s in flow.phases()], inputs, root)
    assert calls == ["dedup", "convert", "delta", "merge"]
    calls.clear()
    got = run(spark, [counted(s) for s in flow.phases()], inputs, root)
    assert calls == ["merge", "metrics"]
    assert got == {"dedup": (8, True), "convert": (8, True), "delta": (2, True), "merge": (2, False), "metrics": (1, False)}
    merged = {r.name: r.vec for r in spark.read.parquet(root + "/merge/*").collect()}
    assert merged["w1"] == pytest.approx([1.1, 0.9]) and merged["w2"] == pytest.approx([1.5])
    calls.clear()
    assert all(reused for _, reused in run(spark, [counted(s) for s in flow.phases()], inputs, root).values()) and not calls


def test_a_change_runs_what_depends_on_it(spark, inputs, tmp_path):
    root = str(tmp_path / "out")
    run(spark, flow.phases(), inputs, root)
    got = run(spark, flow.phases(normalize=True), inputs, root)
    assert {p for p, (_, reused) in got.items() if not reused} == {"merge"}
    with open(os.path.join(inputs["docs"], "b.jsonl"), "w", encoding="utf-8") as f:
        f.write(json.dumps({"text": "another document with words of its own", "domain": "web"}) + "\n")
    got = run(spark, flow.phases(), inputs, root)
    assert {p for p, (_, reused) in got.items() if not reused} == {"dedup", "convert"} and got["convert"][0] == 9
    # a spoilt output is noticed by its gate and written anew
    for d in os.listdir(root + "/delta"):
        spark.createDataFrame([("m1", "w1", 0, None)], "model string, name string, chunk int, vec array<double>") \
             .write.mode("overwrite").parquet(f"{root}/delta/{d}")
    assert run(spark, flow.phases(), inputs, root)["delta"] == (2, False)


def test_gates_stop_the_run(spark, inputs, tmp_path):
    with open(os.path.join(inputs["docs"], "a.jsonl"), "w", encoding="utf-8") as f:
        f.write(json.dumps({"text": "", "domain": "web"}) + "\n")
    with pytest.raises(RuntimeError, match="no document was kept"):
        run(spark, flow.phases(), inputs, str(tmp_path / "empty"))

    def bad(spark_, paths, out, params):
        spark_.createDataFrame([("m", "w", [float("nan")])], "model string, name string, vec array<double>").write.parquet(out)
    with pytest.raises(flow.GateError, match="without a value"):
        run(spark, [flow.Stage("delta", bad, flow._vector_gate)], inputs, str(tmp_path / "nan"))


def test_lines_cut_by_ids_run_their_input_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)
    ids = spark.range(1000).withColumnRenamed("id", "k")
    keep = F.udf(lambda k: seen.add(1) or k % 3 != 0, "boolean").asNondeterministic()
    rows = ids.where(keep("k")).select("k", F.concat(F.lit("v"), F.col("k").cast("string")).alias("value"))
    write_lines(rows, str(tmp_path / "lines"), "k", partitions=6, ids=ids)
    assert seen.value == 1000
    back = [r.value for r in read_lines(spark, str(tmp_path / "lines")).orderBy("line_no").collect()]
    assert back == [f"v{k}" for k in range(1000) if k % 3]
    assert len([f for f in os.listdir(tmp_path / "lines") if f.startswith("part")]) >= 5
    write_lines(rows.limit(0), str(tmp_path / "none"), "k", ids=ids.limit(0))
    assert spark.read.text(str(tmp_path / "none")).count() == 0
