"""SimHash near-duplicates through vantage-point trees.

Every document becomes a 64-bit SimHash of its 3-word shingles.  Distinct
fingerprints are partitioned by Hamming distance to vantage points: an inner
node sends a fingerprint inward when its distance to the vantage point is at
most ``mu`` and outward otherwise.  Two fingerprints at distance <= r differ by
at most r in their distance to any vantage point (triangle inequality), so a
fingerprint with mu < d <= mu + r, whose ball crosses the boundary, is also sent
inward.  By induction every pair within r meets in at least one shard, and a
branch whose boundary is further away is pruned.  Inside a shard a local vantage
point orders the members and only distance bands that overlap by r are compared.

Scale: the tree is fitted on a bounded sample of fingerprints (SAMPLE) and only
decides where rows go, never whether a pair is found.  Copies collapse into one
fingerprint by a partial aggregate first, so a text that fills a third of the
corpus is one entry.  Shards above ``cap`` entries are cut into tiles of two
blocks each.  A tile returns a spanning forest, not pairs, so dense groups
give linear output; components come from star contraction.

Defined results: null or wordless text has fingerprint zero and links like any
other; a null doc_id keeps its row and never serves as a component id (its
component is that of its fingerprint's group, or null if no member has an id);
a doc_id that repeats is one document; an empty table gives no rows; columns
beside id and text are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.llm.common import id_text, lean, materialize, utf8
from winnow.llm.components import connected

SEED = 42          # XXH64 seed of shingle hashes
SAMPLE = 32768     # fingerprints the routing tree is fitted on
SHARD = 65536      # aimed entries of a shard
LOCAL = 2048       # entries of a set compared without a further cut
SLICE = 1 << 16    # shingles counted at once
FANOUT_ROWS = 64   # rows of a block compared at once


# ---------------------------------------------------------------- fingerprints

def fingerprint(text: bytes, shingle: int = 3) -> int:
    """64-bit SimHash of the lower-cased (A-Z) words' shingles, repeats counted."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    k = min(shingle, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))
    n = len(words) - k + 1
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for lo in range(0, n, SLICE):
        hi = min(n, lo + SLICE)
        h = np.array([digest(joined[a:b], SEED) for a, b in
                      zip(starts[lo:hi].tolist(), (ends[lo + k - 1:hi + k - 1] - 1).tolist())], dtype="<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp bigint holding the unsigned bits): one narrow pass."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def run(batches):
        for b in batches:
            fp = np.array([fingerprint(t, shingle) for t in utf8(b)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fp.view(np.int64))], schema=schema)

    return id_text(docs, id_col, text_col).mapInArrow(lean(run), "doc_id bigint, fp bigint")


# ---------------------------------------------------------------- routing tree

def fit_tree(sample: np.ndarray, leaf: int, radius: int, seed: int = 7) -> dict:
    """Inner nodes as arrays (vantage, mu, inward, outward); a child below zero
    is shard -child-1.  The vantage point is the candidate whose distances
    spread most, ``mu`` balances the two sides with the overlap counted in."""
    rng = np.random.default_rng(seed)
    nodes: list[list[int]] = []
    shards = 0

    def grow(pts: np.ndarray) -> int:
        nonlocal shards
        if len(pts) > max(leaf, 1):
            picks = pts[rng.choice(len(pts), min(8, len(pts)), replace=False)]
            probe = pts[rng.choice(len(pts), min(1024, len(pts)), replace=False)]
            v = max(picks, key=lambda p: np.bitwise_count(probe ^ p).std())
            d = np.bitwise_count(pts ^ v).astype(np.int64)
            mu, worst = _balanced(d, radius)
            if worst <= 0.95 * len(pts):
                at = len(nodes)
                nodes.append([int(v), mu, 0, 0])
                nodes[at][2] = grow(pts[d <= mu + radius])
                nodes[at][3] = grow(pts[d > mu])
                return at
        shards += 1
        return -shards

    root = grow(np.asarray(sample, np.uint64))
    return {"nodes": nodes, "root": root, "shards": shards, "radius": radius}


def route(fps: np.ndarray, tree: dict) -> tuple[np.ndarray, np.ndarray]:
    """(index into fps, shard): the home shard of every fingerprint and all
    shards whose boundary its ball crosses."""
    idx, shard = [], []
    todo = [(tree["root"], np.arange(len(fps)))]
    while todo:
        at, rows = todo.pop()
        if not len(rows):
            continue
        if at < 0:
            idx.append(rows)
            shard.append(np.full(len(rows), -at - 1, np.int32))
            continue
        v, mu, inward, outward = tree["nodes"][at]
        d = np.bitwise_count(fps[rows] ^ np.uint64(v))
        todo.append((inward, rows[d <= mu + tree["radius"]]))
        todo.append((outward, rows[d > mu]))
    if not idx:
        return np.empty(0, np.int64), np.empty(0, np.int32)
    return np.concatenate(idx), np.concatenate(shard)


# ---------------------------------------------------------------- one tile

def _balanced(d: np.ndarray, radius: int) -> tuple[int, int]:
    """(mu, size of the larger side) of the most even cut of distances ``d``,
    the overlap counted in."""
    below = np.cumsum(np.bincount(d, minlength=65))
    inward = np.append(below, [len(d)] * radius)[radius:radius + 65]
    worst = np.maximum(inward, len(d) - below)
    mu = int(np.argmin(worst))
    return mu, int(worst[mu])


def forest(fps: np.ndarray, ids: np.ndarray, radius: int, block: np.ndarray | None = None,
           local: int = LOCAL) -> list[tuple[int, int]]:
    """Spanning stars (id, smallest id of its group) over all pairs within
    ``radius``; with ``block`` (0/1 marks) only pairs across the two blocks.
    The members are cut further by vantage points of their own, in memory, as
    long as that makes smaller sets; a set is then compared in the order of its
    distances, each block of rows against the band it can reach."""
    lab = np.arange(len(fps))

    def join(i: np.ndarray, j: np.ndarray) -> None:
        if block is not None:
            cross = block[i] != block[j]
            i, j = i[cross], j[cross]
        while len(i):
            a, b = lab[i], lab[j]
            live = a != b
            i, j, a, b = i[live], j[live], a[live], b[live]
            if len(i):
                lab[lab == max(a[0], b[0])] = min(a[0], b[0])

    todo = [np.arange(len(fps))] if len(fps) > 1 else []
    while todo:
        rows = todo.pop()
        picks = fps[rows[:: max(1, len(rows) // 4)][:4]]
        probe = fps[rows[:: max(1, len(rows) // 256)]]
        v = max(picks, key=lambda p: np.bitwise_count(probe ^ p).std())
        d = np.bitwise_count(fps[rows] ^ v).astype(np.int64)
        if len(rows) > local:
            mu, worst = _balanced(d, radius)
            if worst <= 0.8 * len(rows):
                todo += [r for r in (rows[d <= mu + radius], rows[d > mu]) if len(r) > 1]
                continue
        order = np.argsort(d, kind="stable")
        rows, d = rows[order], d[order]
        f = fps[rows]
        for lo in range(0, len(rows), FANOUT_ROWS):
            hi = min(len(rows), lo + FANOUT_ROWS)
            end = int(np.searchsorted(d, d[hi - 1] + radius, side="right"))  # beyond it the triangle bound exceeds radius
            i, j = np.nonzero(np.bitwise_count(f[lo:hi, None] ^ f[None, lo:end]) <= radius)
            keep = i < j
            join(rows[i[keep] + lo], rows[j[keep] + lo])
    low = np.full(len(fps), np.iinfo(np.int64).max)
    np.minimum.at(low, lab, ids)
    root = low[lab]
    moved = root != ids
    return list(zip(ids[moved].tolist(), root[moved].tolist()))


def _tile_edges(radius: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        cross = pdf["t0"].iat[0] != pdf["t1"].iat[0]
        mark = (pdf["part"] == pdf["t1"]).to_numpy(np.int8) if cross else None
        e = forest(pdf["fp"].to_numpy(np.int64).view(np.uint64), pdf["rep"].to_numpy(np.int64), radius, mark)
        return pd.DataFrame(e, columns=["a", "b"]).astype("int64")
    return run


def links(distinct: DataFrame, radius: int = 3, shard: int = SHARD) -> DataFrame:
    """Edges (a, b) between the ``rep`` ids of distinct fingerprints (fp, rep)
    that connect exactly what all pairs within ``radius`` connect."""
    known = distinct.where(F.col("rep").isNotNull())
    total = known.count()
    rows = known.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()
    sample = np.array([r[0] for r in rows], np.int64).view(np.uint64)
    leaf = max(16, shard * len(sample) // max(total, 1))
    tree = fit_tree(sample, leaf, radius)

    def home(batches):
        for b in batches:
            i, s = route(b.column("fp").to_numpy().view(np.uint64), tree)
            yield pa.RecordBatch.from_arrays([b.column("fp").take(pa.array(i)), b.column("rep").take(pa.array(i)),
                                              pa.array(s, pa.int32())], names=["fp", "rep", "shard"])

    entries = materialize(known.select("fp", "rep").mapInArrow(home, "fp bigint, rep bigint, shard int"), "simhash-shards")
    cap = 2 * shard
    big = {r["shard"]: -(-r["n"] // cap) for r in
           entries.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > cap).collect()}
    blocks = F.lit(1)
    if big:  # at most one entry per shard of the bounded tree
        blocks = F.coalesce(F.create_map(*[F.lit(x) for kv in big.items() for x in kv])[F.col("shard")], F.lit(1))
    tiles = (entries.withColumn("blocks", blocks)
             .withColumn("part", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("fp", "rep", "part", "shard", F.least("part", "other").alias("t0"), F.greatest("part", "other").alias("t1")))
    return tiles.groupBy("shard", "t0", "t1").applyInPandas(_tile_edges(radius), "a bigint, b bigint")


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 3, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(doc_id, fp, component_id) for every row; component_id is the smallest
    doc_id reachable through links of at most ``radius`` bits."""
    fps = materialize(fingerprints(docs, shingle, id_col, text_col), "simhash")
    distinct = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-distinct")
    comp = connected(links(distinct, radius))
    named = (distinct.join(comp, distinct["rep"] == comp["node"], "left")
             .select("fp", F.coalesce("component", "rep").alias("component_id")))
    return fps.join(named, "fp").select("doc_id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 3, id_col: str = "doc_id",
                         text_col: str = "text") -> DataFrame:
    """``docs`` without the documents whose component has a smaller id; all
    columns stay, rows with a null id stay."""
    found = near_duplicates(docs, shingle, radius, id_col, text_col)
    gone = materialize(found.where(F.col("doc_id") > F.col("component_id")).select(F.col("doc_id").alias("_gone")).distinct(),
                       "simhash-gone")
    return docs.join(gone, docs[id_col] == gone["_gone"], "left_anti")
