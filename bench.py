"""Benchmark the headline queries.

Runs each query at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS], executes the full plan into Spark's ``noop`` sink (no
driver collect), and records the median of $BENCH_REPEATS (default 3) runs.
Also times a scan of the same documents as JSONL and as Parquet, the load
comparison of the baseline.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "dedup_keep",          # normalize -> shingles -> MinHash -> LSH -> greedy clusters -> keep
    "connected_clusters",
    "dedup_chunked",
    "normalize_docs",
    "read_jsonl",
    "validate_jsonl_report",
    "field_stats",
    "quality_score",
    "bleu_corpus",
    "rouge_n",
    "merge_weighted",
    "jsonl_to_parquet",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def ratio(scan: dict, a: str, b: str):
    return round(scan[a] / scan[b], 2) if scan.get(a) and scan.get(b) else None


def scan_comparison(spark, docs, jdir, pdir, cpus, repeats):
    from pyspark.sql import functions as F
    from winnow.operators import validate as va
    from winnow.sources import io as wio

    same = docs.repartition(cpus)
    same.write.mode("overwrite").json(jdir)
    same.write.mode("overwrite").option("compression", "zstd").parquet(pdir)
    schema = docs.schema

    def jsonl_loader():
        # the library's JSONL path: line numbers, VARIANT parse, malformed lines dropped
        p = wio.read_jsonl(spark, jdir)
        return p.select(*[va.field(f.name, f.dataType.simpleString()).alias(f.name) for f in schema.fields])

    readers = {"jsonl": lambda: spark.read.schema(schema).json(jdir), "jsonl_loader": jsonl_loader,
               "parquet": lambda: spark.read.parquet(pdir)}
    scan = {}
    for fmt, reader in readers.items():
        for kind, proj in (("full", lambda df: df.select(*[F.col(c) for c in df.columns])),
                           ("two_cols", lambda df: df.select("doc_id", "lang"))):
            rs = []
            for _ in range(repeats):
                t0 = time.time()
                run(proj(reader()))
                rs.append(time.time() - t0)
            scan[f"{fmt}_{kind}"] = round(statistics.median(rs), 3)
    return scan


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    names = sys.argv[1:] or HEADLINE

    from winnow.session import get_session, scratch_path
    from winnow.plans import catalog, registry

    spark = get_session(f"local[{cpus}]", partitions=cpus)
    # shared folder named by the session (spark.checkpoint.dir); a scratch
    # folder is made only when the session names none
    ckpt = scratch_path(spark, "bench").replace("file:", "")
    qs = catalog.queries()

    # warm the JVM (JIT) and the Python workers on the smallest table set
    warm = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    for name in ("parquet_project", "dedup_keep", "bleu_corpus"):
        run(qs[name](spark, warm if os.path.isdir(warm) else sf_dir))
    registry.clear_memo()

    timings, errors = {}, {}
    for name in names:
        runs = []
        try:
            for _ in range(repeats):
                registry.clear_memo()
                t0 = time.time()
                run(qs[name](spark, sf_dir))
                runs.append(time.time() - t0)
            timings[name] = round(statistics.median(runs), 3)
        except Exception as e:  # one failing query must not lose the whole line
            timings[name] = None
            errors[name] = str(e).splitlines()[0][:200]

    # JSONL vs Parquet scan of the same documents (the baseline's load
    # comparison): both copies written from the same partitioning, then a
    # full-row load and a two-column projection of each.
    from pyspark.sql import functions as F
    docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))
    jdir, pdir = os.path.join(ckpt, "docs-jsonl"), os.path.join(ckpt, "docs-parquet")
    scan = {}
    try:
        scan = scan_comparison(spark, docs, jdir, pdir, cpus, repeats)
    except Exception as e:  # reported, not fatal
        errors["scan_comparison"] = str(e).splitlines()[0][:200]

    def du(path):
        try:
            return sum(os.path.getsize(os.path.join(r, f)) for r, _, fs in os.walk(path) for f in fs if f.startswith("part-"))
        except OSError:  # not a local folder
            return None
    n_docs = docs.count()
    total = round(sum(v for v in timings.values() if v is not None), 3)
    out = {
        "metric": "headline_total",
        "value": total,
        "unit": "sec",
        "queries": timings,

        "sf": float(os.path.basename(sf_dir.rstrip("/")).replace("sf", "") or 0),
        "cpus": cpus,
        "repeats": repeats,
        "documents": n_docs,
        "dedup_docs_per_sec": round(n_docs / timings["dedup_keep"], 1) if timings.get("dedup_keep") else None,
        "scan_sec": scan,
        "bytes": {"jsonl": du(jdir), "parquet_zstd": du(pdir)},
        "parquet_vs_jsonl_speedup_full": ratio(scan, "jsonl_full", "parquet_full"),
        "parquet_vs_jsonl_speedup_two_cols": ratio(scan, "jsonl_two_cols", "parquet_two_cols"),
        "parquet_vs_jsonl_loader_speedup_full": ratio(scan, "jsonl_loader_full", "parquet_full"),
    }
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
