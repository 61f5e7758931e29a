"""One run over all phases, with a manifest per stage, gates and restart.

    dedup -> convert          raw JSONL to kept documents to Parquet by domain
    delta -> merge            parameter tables to deltas to the merged parameters
    metrics                   prediction pairs to the metric row

A stage writes below ``<root>/<stage>/<fingerprint>`` and, once its gate has
passed, a manifest beside it.  The fingerprint covers the stage's name, its
parameters, the files of its own inputs (path, size, time) and the fingerprints
of the stages before it.  A run looks for each stage's manifest first: one that
fits and whose output still passes the gate is not run again, so a run that was
killed goes on behind the last good stage, and a changed input or parameter runs
again exactly the stages that depend on it.  A stage that was cut off half-way
has no manifest and is written anew.

Usage:
    python -m winnow.plans.flow --root out --docs data/*.jsonl --params p.parquet \
        --weights w.parquet --pairs pairs.parquet
"""

from __future__ import annotations

import argparse
import hashlib
import json
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from winnow.operators import metrics as me
from winnow.operators import params as pa
from winnow.plans import curate
from winnow.sources import io

MANIFEST = "stage string, fingerprint string, rows bigint, params string, inputs string, seconds double"


@dataclass(frozen=True)
class Stage:
    """``run(spark, paths, out, params)`` writes ``out``; ``gate(spark, out)`` is
    its number of rows, or raises.  ``paths``: name -> path of every input and
    of every earlier stage's output."""
    name: str
    run: Callable[[SparkSession, dict, str, dict], None]
    gate: Callable[[SparkSession, str], int]
    inputs: tuple[str, ...] = ()
    needs: tuple[str, ...] = ()
    params: dict = field(default_factory=dict)


class GateError(RuntimeError):
    """A stage's output does not hold what it must."""


def _files(spark: SparkSession, paths) -> str:
    """Fingerprint of input files; no content is read and no listing collected."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    r = files.agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("size"),
                  F.bit_xor(F.xxhash64("path", "length", "modificationTime")).alias("h")).first()
    return f"{r.n}:{r['size']}:{r.h}"


def _manifest(spark: SparkSession, path: str) -> dict | None:
    try:
        rows = spark.read.schema(MANIFEST).json(path).limit(1).collect()
    except AnalysisException:  # the folder is not there
        return None
    return rows[0].asDict() if rows else None


def run_stages(spark: SparkSession, stages: list[Stage], inputs: dict, root: str) -> DataFrame:
    """Run what is not done; (phase, rows, reused, seconds) of every stage.

    Raises GateError behind a stage whose output fails its gate; the stages
    before it keep their manifests."""
    root, paths, prints, out = root.rstrip("/"), dict(inputs), {}, []
    for s in stages:
        own = {i: _files(spark, inputs[i]) for i in s.inputs}
        facts = {"stage": s.name, "params": s.params, "inputs": own, "needs": {n: prints[n] for n in s.needs}}
        mark = hashlib.sha256(json.dumps(facts, sort_keys=True).encode()).hexdigest()[:16]
        prints[s.name], paths[s.name] = mark, f"{root}/{s.name}/{mark}"
        note = f"{root}/manifests/{s.name}/{mark}"
        known = _manifest(spark, note)
        if known is not None:
            try:
                if s.gate(spark, paths[s.name]) == known["rows"]:
                    out.append((s.name, known["rows"], True, known["seconds"]))
                    continue
            except (GateError, AnalysisException):
                pass  # the output is gone or spoilt: the stage is run again
        began = time.time()
        s.run(spark, paths, paths[s.name], s.params)
        rows = s.gate(spark, paths[s.name])
        took = round(time.time() - began, 3)
        spark.createDataFrame([(s.name, mark, rows, json.dumps(s.params, sort_keys=True), json.dumps(own, sort_keys=True), took)], MANIFEST) \
             .coalesce(1).write.mode("overwrite").json(note)
        out.append((s.name, rows, False, took))
    return spark.createDataFrame(out, "phase string, rows bigint, reused boolean, seconds double")


# --------------------------------------------------------------------- stages

def _check(ok: bool, what: str) -> None:
    if not ok:
        raise GateError(what)


def _dedup(spark, paths, out, params):
    curate.dedup_job(spark, paths["docs"], out, **params)


def _dedup_gate(spark, out) -> int:
    st = spark.read.json(f"{out}/stats").first()
    kept = spark.read.text(f"{out}/kept").count()
    _check(kept > 0 and kept == st.deduplicated_count, f"{out}/kept has {kept} documents, the statistics say {st.deduplicated_count}")
    return kept


def _convert(spark, paths, out, params):
    report = curate.convert_job(spark, paths["dedup"] + "/kept", out + "/parquet", **params)
    report.coalesce(1).write.mode("overwrite").json(out + "/report")


def _convert_gate(spark, out) -> int:
    bad = spark.read.json(out + "/report").where("NOT is_valid")
    _check(bad.isEmpty(), f"{out}: a domain folder is not valid")
    rows = spark.read.parquet(out + "/parquet").count()
    _check(rows > 0, f"{out}: no rows")
    return rows


def _delta(spark, paths, out, params):
    p = spark.read.parquet(paths["params"])
    base = params["base"]
    pa.vector_diff(p.where(F.col("model") == base), p.where(F.col("model") != base), params["partial"]).write.mode("overwrite").parquet(out)


def _merge(spark, paths, out, params):
    p = spark.read.parquet(paths["params"]).where(F.col("model") == params["base"])
    w = spark.read.parquet(paths["weights"])
    w = pa.normalize_weights(w) if params["normalize"] else w
    pa.merge_weighted(p, spark.read.parquet(paths["delta"]), w).write.mode("overwrite").parquet(out)


def _vector_gate(spark, out) -> int:
    r = spark.read.parquet(out).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("vec").isNull() | F.exists("vec", F.isnan)).alias("bad")).first()
    _check(r.n > 0 and r.bad == 0, f"{out}: {r.n} rows, {r.bad} without a value")
    return r.n


def _metrics(spark, paths, out, params):
    io.write_metrics(me.summary(spark.read.parquet(paths["pairs"])), out)


def _metrics_gate(spark, out) -> int:
    rows = spark.read.json(f"{out}/json").select("bleu", "rouge1", "rouge2", "rougeL").limit(2).collect()
    _check(len(rows) == 1 and None not in rows[0], f"{out}: not one whole metric row")
    return 1


def phases(strategy: str = "longest", base: str = "base", normalize: bool = False, partial: bool = False) -> list[Stage]:
    """The reference order of phases with their parameters; ``partial``: tuned
    models may lack parameters of the base."""
    return [Stage("dedup", _dedup, _dedup_gate, ("docs",), params={"strategy": strategy}),
            Stage("convert", _convert, _convert_gate, needs=("dedup",)),
            Stage("delta", _delta, _vector_gate, ("params",), params={"base": base, "partial": partial}),
            Stage("merge", _merge, _vector_gate, ("params", "weights"), ("delta",), {"base": base, "normalize": normalize}),
            Stage("metrics", _metrics, _metrics_gate, ("pairs",))]


def main(argv=None) -> None:
    from winnow.session import get_session
    ap = argparse.ArgumentParser(description="winnow: all phases")
    ap.add_argument("--root", required=True)
    ap.add_argument("--docs", nargs="+", required=True)
    for name in ("params", "weights", "pairs"):
        ap.add_argument(f"--{name}", required=True)
    ap.add_argument("--strategy", default="longest")
    ap.add_argument("--normalize", action="store_true")
    ap.add_argument("--master", default="local[*]")
    a = ap.parse_args(argv)
    inputs = {"docs": a.docs, "params": a.params, "weights": a.weights, "pairs": a.pairs}
    for r in run_stages(get_session(a.master), phases(a.strategy, normalize=a.normalize), inputs, a.root).collect():
        print(json.dumps(r.asDict()))


if __name__ == "__main__":
    main()
