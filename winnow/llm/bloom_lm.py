"""Language-model scores from a log-frequency Bloom filter.

The filter stores, for every bigram of the training texts, its quantised count
q = 1 + floor(log(count) / log(BASE)) as q members (bigram, 1) .. (bigram, q).  A
count is read back by probing levels 1, 2, ... until one is missing; the last
level's mean count stands for the bigram's.  Scores are smoothed with the
unigram:  p(w | u) = (c(u, w) + MU * p(w)) / (c(u) + MU),  p(w) = (c(w)+1) / (N+V+1).

How it runs, one narrow pass over the texts and shuffles of packed numbers only:

1. ``blocks``: each task cuts its documents into blocks of about BLOCK tokens and
   writes token numbers, the block's vocabulary as hashes, and requests: sorted
   distinct unigram and bigram hashes with their training counts, packed by
   hash range (group).  A word or bigram leaves a block once, however hot.
2. Unigram groups sum the requests and answer each block with exact counts.
3. Bigram groups sum theirs, write their range of the filter and answer every
   block's requests from it, where they are: a range is sized by its members, so
   the filter grows with the corpus and is never sent anywhere.
4. Answers meet their block, and documents are scored.

Group counts follow the measured size of the texts.  All rows cover all tokens:
nothing is pruned, so the false-positive rate does not depend on the corpus.

Defined results: null text is empty (the end token alone); null doc_id is
neither held out nor trained on; repeated rows count and are scored each; an
empty table gives no rows; without training tokens N = V = 0; other columns are
ignored.  64-bit hashes stand for words, 48-bit hashes for bigrams.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
import zstandard as zs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.llm.common import lean, materialize, trimmed
from winnow.llm.densified_minhash import mix
from winnow.llm.gru_langid import remainder

BASE = 1.5                 # quantisation of counts
LEVELS = 110               # BASE ** 109 exceeds any 64-bit count
MU = 8.0                   # weight of the unigram in the smoothing
BITS, PROBES = 10, 5       # filter bits and hash functions a member
BLOCK = 1 << 20            # tokens of a block, about
GROUP_TOKENS = 1 << 19     # corpus tokens behind a hash range, about
END = b" "                 # the end token: no word holds a blank
SEED = 42


# ------------------------------------------------------------ packed numbers

def pack_planes(a: np.ndarray) -> bytes:
    """Byte planes under zstandard: small numbers cost about their entropy."""
    a = np.ascontiguousarray(a)
    return zs.ZstdCompressor(level=1).compress(np.ascontiguousarray(a.view(np.uint8).reshape(-1, a.itemsize).T).tobytes())


def unpack_planes(raw: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    flat = np.frombuffer(zs.ZstdDecompressor().decompress(raw), np.uint8)
    return np.ascontiguousarray(flat.reshape(size, -1).T).view(dtype).ravel()


def pack_sorted(a: np.ndarray) -> bytes:
    return pack_planes(np.diff(a, prepend=np.uint64(0)))


def unpack_sorted(raw: bytes) -> np.ndarray:
    return np.cumsum(unpack_planes(raw, np.uint64), dtype=np.uint64)


# ----------------------------------------------------------------- the filter

def quantise(counts: np.ndarray) -> np.ndarray:
    """Level of each positive count."""
    return (1 + np.floor(np.log(counts) / math.log(BASE) + 1e-9)).astype(np.int64)


def level_counts() -> np.ndarray:
    """Mean of the whole counts of each level (0 at level 0; empty levels take their bound)."""
    out = [0.0]
    for q in range(1, LEVELS):
        lo, hi = math.ceil(BASE ** (q - 1) - 1e-9), math.ceil(BASE ** q - 1e-9) - 1
        out.append((lo + hi) / 2 if hi >= lo else float(lo))
    return np.array(out)


def positions(keys: np.ndarray, level: int | np.ndarray, bits: int) -> list[np.ndarray]:
    """Bit positions of (key, level): double hashing."""
    a = mix(keys + np.asarray(level, np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    b = mix(a) | np.uint64(1)
    return [((a + np.uint64(i) * b) % np.uint64(bits)).astype(np.int64) for i in range(PROBES)]


def build_range(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """The filter of one hash range."""
    q = quantise(counts)
    members = int(q.sum())
    if not members:
        return b""
    bits = -(-members * BITS // 8) * 8
    out = np.zeros(bits, bool)
    for level in range(1, int(q.max()) + 1):
        for p in positions(keys[q >= level], level, bits):
            out[p] = True
    return np.packbits(out, bitorder="little").tobytes()


def probe_range(raw: bytes, keys: np.ndarray) -> np.ndarray:
    """Level of each key: the last of the levels found without a gap."""
    level = np.zeros(len(keys), np.uint8)
    if not raw:
        return level
    bits, alive = np.frombuffer(raw, np.uint8), np.arange(len(keys))
    for q in range(1, LEVELS):
        found = np.ones(len(alive), bool)
        for p in positions(keys[alive], q, 8 * len(raw)):
            found &= (bits[p >> 3] >> (p & 7).astype(np.uint8)) & 1 == 1
        alive = alive[found]
        if not len(alive):
            break
        level[alive] = q
    return level


# --------------------------------------------------------------------- blocks

class Numbers(dict):
    """word -> its number in the block, in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        got = self[word] = len(self)
        return got


def bigram_keys(ids: np.ndarray, vocabulary: np.ndarray, end: int) -> np.ndarray:
    """48-bit key of each token with the one before it (the first: after an end)."""
    h = vocabulary[ids]
    before = np.concatenate(([vocabulary[end]], h[:-1]))
    return mix(before * np.uint64(0x9E3779B97F4A7C15) + h) >> np.uint64(16)


def _requests(keys: np.ndarray, counts: np.ndarray, group_bits: int, key_bits: int):
    """(group, packed keys, packed counts) of sorted distinct keys."""
    group = (keys >> np.uint64(key_bits - group_bits)).astype(np.int64) if group_bits else np.zeros(len(keys), np.int64)
    edges = np.flatnonzero(np.diff(group, prepend=-1, append=-1))
    for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist()):
        yield int(group[lo]), pack_sorted(keys[lo:hi]), pack_planes(counts[lo:hi].astype(np.uint32))


BLOCK_SCHEMA = "block bigint, kind int, grp bigint, keys binary, counts binary, docs array<bigint>, held array<boolean>, " \
               "lengths array<bigint>, n_train bigint"
UNIGRAM, BIGRAM, TEXT = 0, 1, 2


def blocks(docs: DataFrame, group_bits: int, block: int = BLOCK) -> DataFrame:
    """Rows of kind TEXT (one per block: token numbers, vocabulary, documents)
    and of kinds UNIGRAM and BIGRAM (requests)."""
    schema = pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("grp", pa.int64()), ("keys", pa.binary()),
                        ("counts", pa.binary()), ("docs", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())),
                        ("lengths", pa.list_(pa.int64())), ("n_train", pa.int64())])

    def flush(at: int, numbers: Numbers, parts: list, ids: list, held: list, train: list):
        hashes = np.array([xxhash.xxh64_intdigest(w, SEED) for w in numbers], np.uint64)
        order = np.argsort(hashes)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        vocabulary, tokens = hashes[order], rank[np.concatenate(parts)]
        lengths = np.array([len(p) for p in parts])
        learn = np.repeat(np.array(train), lengths)
        uni = np.bincount(tokens[learn], minlength=len(vocabulary))
        keys = bigram_keys(tokens, vocabulary, int(rank[numbers[END]]))
        distinct, where = np.unique(keys, return_inverse=True)
        bi = np.bincount(where[learn], minlength=len(distinct))
        rows = [(UNIGRAM, *r) for r in _requests(vocabulary, uni, group_bits, 64)]
        rows += [(BIGRAM, *r) for r in _requests(distinct, bi, group_bits, 48)]
        cols = list(zip(*rows))
        n = len(rows)
        yield pa.RecordBatch.from_arrays(
            [pa.array([at] * n, pa.int64()), *(pa.array(c, f.type) for c, f in zip(cols, list(schema)[1:5])),
             *(pa.nulls(n, f.type) for f in list(schema)[5:])], schema=schema)
        one = [at, TEXT, -1, pack_sorted(vocabulary), pack_planes(tokens.astype(np.uint32)), ids, held, lengths.tolist(),
               int(learn.sum())]
        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(one, schema)], schema=schema)

    def run(batches):
        from pyspark import TaskContext
        at = TaskContext.get().partitionId() << 32
        numbers, parts, ids, held, train, size = Numbers(), [], [], [], [], 0
        end = numbers[END]
        for b in batches:
            for d, t, out, learn in zip(b.column("doc_id").to_pylist(), b.column("text").cast(pa.binary()).to_pylist(),
                                        b.column("held_out").to_pylist(), b.column("train").to_pylist()):
                words = (t or b"").lower().split()
                part = np.empty(len(words) + 1, np.int64)
                part[:-1] = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
                part[-1] = end
                parts.append(part)
                ids.append(d)
                held.append(out)
                train.append(learn)
                size += len(part)
                if size >= block:
                    yield from flush(at, numbers, parts, ids, held, train)
                    at += 1
                    numbers, parts, ids, held, train, size = Numbers(), [], [], [], [], 0
                    end = numbers[END]
        if parts:
            yield from flush(at, numbers, parts, ids, held, train)

    return docs.mapInArrow(lean(run), BLOCK_SCHEMA)


# ------------------------------------------------------- groups: sum and answer

def _sums(rows: dict) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray]:
    """(distinct keys, training counts, each row's places among them)."""
    keys = [unpack_sorted(k) for k in rows["keys"]]
    counts = np.concatenate([unpack_planes(c, np.uint32) for c in rows["counts"]])
    distinct, where = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(where, weights=counts, minlength=len(distinct)).astype(np.int64)
    return distinct, total, np.split(where, np.cumsum([len(k) for k in keys])[:-1])


def unigram_answers(table: pa.Table) -> pa.Table:
    rows = table.to_pydict()
    _, total, places = _sums(rows)
    known = [int((total > 0).sum())] + [0] * (len(places) - 1)  # the group's vocabulary, told once
    return pa.table({"block": pa.array(rows["block"], pa.int64()), "kind": pa.array([UNIGRAM] * len(places), pa.int32()),
                     "grp": pa.array(rows["grp"], pa.int64()),
                     "answer": pa.array([pack_planes(total[p]) for p in places], pa.binary()), "known": pa.array(known, pa.int64())})


def bigram_answers(table: pa.Table) -> pa.Table:
    """Builds the filter of a hash range and answers the range's requests from it."""
    rows = table.to_pydict()
    distinct, total, places = _sums(rows)
    seen = total > 0
    level = probe_range(build_range(distinct[seen], total[seen]), distinct)
    n = len(places)
    return pa.table({"block": pa.array(rows["block"], pa.int64()), "kind": pa.array([BIGRAM] * n, pa.int32()),
                     "grp": pa.array(rows["grp"], pa.int64()),
                     "answer": pa.array([pack_planes(level[p]) for p in places], pa.binary()), "known": pa.array([0] * n, pa.int64())})


ANSWER_SCHEMA = "block bigint, kind int, grp bigint, answer binary, known bigint"


# -------------------------------------------------------------------- scoring

def block_scores(tokens: np.ndarray, vocabulary: np.ndarray, counts: np.ndarray, levels: np.ndarray, end: int,
                 n: int, v: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per token: known, log10 of the base and of the smoothed probability."""
    c = counts[tokens].astype(float)
    base = (c + 1) / (n + v + 1)
    before = np.concatenate(([float(counts[end])], c[:-1]))
    _, where = np.unique(bigram_keys(tokens, vocabulary, end), return_inverse=True)
    pair = np.minimum(level_counts()[levels][where], np.minimum(before, c))
    return c > 0, np.log10(base), np.log10((pair + MU * base) / (before + MU))


def _score(n: int, v: int):
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def run(batches):
        for b in batches:
            for r in range(b.num_rows):
                row = {f: b.column(f)[r].as_py() for f in ("keys", "counts", "docs", "held", "lengths", "answers")}
                vocabulary, tokens = unpack_sorted(row["keys"]), unpack_planes(row["counts"], np.uint32).astype(np.int64)
                by = {k: [a["answer"] for a in sorted(row["answers"], key=lambda a: a["grp"]) if a["kind"] == k] for k in (UNIGRAM, BIGRAM)}
                counts = np.concatenate([unpack_planes(a, np.int64) for a in by[UNIGRAM]])
                levels = np.concatenate([unpack_planes(a, np.uint8) for a in by[BIGRAM]])
                end = int(np.searchsorted(vocabulary, np.uint64(xxhash.xxh64_intdigest(END, SEED))))
                known, base, smooth = block_scores(tokens, vocabulary, counts, levels, end, n, v)
                lengths = np.array(row["lengths"])
                first = np.concatenate(([0], np.cumsum(lengths)[:-1]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["docs"], pa.int64()), pa.array(row["held"], pa.bool_()), pa.array(lengths, pa.int64()),
                     pa.array(np.add.reduceat(known, first, dtype=np.int64)), pa.array(np.full(len(lengths), n), pa.int64()),
                     pa.array(np.add.reduceat(base, first)), pa.array(np.add.reduceat(smooth, first))], names=names)

    return run


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hold_by: int = 7, hold: int = 2,
          block: int = BLOCK, group_tokens: int = GROUP_TOKENS, shard_bytes: int | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.
    (``shard_bytes`` has no effect any more: no part of the filter is broadcast.)"""
    key = F.col(id_col).cast("bigint")
    left = remainder(key, hold_by)
    rows = docs.select(key.alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       F.coalesce(left == hold, F.lit(False)).alias("held_out"), F.coalesce(left != hold, F.lit(False)).alias("train"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    group_bits = max(0, math.ceil(math.log2(max(1, size / 6 / group_tokens))))  # about six bytes a token
    cut = materialize(blocks(rows, group_bits, block), "lm-blocks")
    uni, bi, texts = (cut.where(F.col("kind") == k) for k in (UNIGRAM, BIGRAM, TEXT))
    counted = materialize(uni.select("block", "grp", "keys", "counts").groupBy("grp").applyInArrow(unigram_answers, ANSWER_SCHEMA),
                          "lm-unigrams")
    levels = materialize(bi.select("block", "grp", "keys", "counts").groupBy("grp").applyInArrow(bigram_answers, ANSWER_SCHEMA),
                         "lm-levels")
    n = texts.agg(F.sum("n_train")).first()[0] or 0
    v = counted.agg(F.sum("known")).first()[0] or 0
    answers = (counted.unionByName(levels).groupBy("block")
               .agg(F.collect_list(F.struct("kind", "grp", "answer")).alias("answers")))  # a block's, so bounded
    return (texts.select("block", "keys", "counts", "docs", "held", "lengths").join(answers, "block")
            .mapInArrow(trimmed(_score(n, v)), "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, "
                                      "train_tokens bigint, base_score double, score double"))
