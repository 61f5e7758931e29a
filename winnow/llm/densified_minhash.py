"""Document fingerprints: one-permutation MinHash with optimal densification.

A text's 5-word shingles are hashed once.  The top bits of a hash choose one of
``BINS`` bins, a bin keeps its smallest hash.  An empty bin borrows from a bin
chosen by a universal hash of (bin, attempt), tried until a full one is met --
the optimal densification, which makes equal bins of two sets as likely as their
Jaccard similarity.  Only the low ``BITS`` bits of each bin are stored, packed.
Likeness corrects for bits that agree by chance: (match - c) / (1 - c) with
c = 2**-BITS, cut to 0..1.

The neighbour step (a text against the next document's) deals documents once, in
doc_id order, to buckets whose cut points come from a sketch of the ids; the
first document of a bucket is also sent to the bucket before it, as its last
row's neighbour.  A task streams its bucket and holds two texts at a time.

Defined results: null text counts as empty; no words gives the empty fingerprint
(an empty string), which is like itself only; fewer than 5 words are one shingle;
rows with equal doc_id are ordered by text; null doc_ids come first; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.llm.common import bucket_of, id_text, order_cuts, shuffle_partitions

BINS = 512
BITS = 4
SHINGLE = 5
SEED = 42
WORDS = 400_000        # word hashes a task remembers
EMPTY = np.uint64(2**64 - 1)
_MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))  # fixed values: 64-bit finaliser


class WordHashes(dict):
    """word -> its XXH64, remembered while there is room."""

    def __init__(self, limit: int = WORDS):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        got = self[word] = xxhash.xxh64_intdigest(word, SEED)
        return got


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * _MIX[0]
    h = (h ^ (h >> np.uint64(33))) * _MIX[1]
    return h ^ (h >> np.uint64(33))


def shingle_hashes(words: np.ndarray, k: int = SHINGLE) -> np.ndarray:
    """One 64-bit hash per run of ``k`` words (all words, if fewer)."""
    k = min(k, len(words))
    if not k:
        return words
    h = np.zeros(len(words) - k + 1, np.uint64)
    for j in range(k):
        h = mix(h + words[j:len(words) - k + 1 + j] + np.uint64(j + 1))
    return h


def word_hashes(text: bytes, table: WordHashes) -> np.ndarray:
    words = text.lower().split()
    return np.fromiter(map(table.__getitem__, words), np.uint64, len(words))


def minima(hashes: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Smallest hash of each bin (EMPTY where none), before densification."""
    out = np.full(bins, EMPTY)
    if len(hashes):
        h = np.sort(hashes)
        at = (h >> np.uint64(64 - bins.bit_length() + 1)).astype(np.int64)
        first = np.flatnonzero(np.diff(at, prepend=-1))
        out[at[first]] = h[first]
    return out


@lru_cache(maxsize=64)
def picks(bins: int, block: int, attempts: int = 64) -> np.ndarray:
    """(attempts, bins): the bin each bin asks at each attempt of a block."""
    attempt = np.arange(block * attempts, (block + 1) * attempts, dtype=np.uint64)[:, None]
    return (mix(np.arange(bins, dtype=np.uint64)[None, :] * np.uint64(0x9E3779B97F4A7C15) + attempt + np.uint64(1))
            % np.uint64(bins)).astype(np.int64)


def densify(low: np.ndarray) -> np.ndarray:
    """Fill each empty bin from the first full one among its hash choices."""
    full = low != EMPTY
    if not full.any() or full.all():
        return low
    out, todo, block = low.copy(), np.flatnonzero(~full), 0
    while len(todo):
        asked = picks(len(low), block)[:, todo]
        hit = full[asked]
        got = hit.any(axis=0)
        out[todo[got]] = low[asked[hit.argmax(axis=0)[got], np.flatnonzero(got)]]
        todo, block = todo[~got], block + 1
    return out


def low_bits(hashes: np.ndarray, bins: int = BINS, bits: int = BITS) -> np.ndarray | None:
    """Low bits of the densified bins; None for a text without shingles.  The
    hash's top bits are alike within a bin, its low bits are not."""
    if not len(hashes):
        return None
    return (densify(minima(hashes, bins)) & np.uint64((1 << bits) - 1)).astype(np.uint8)


def packed(low: np.ndarray | None, bits: int = BITS) -> str:
    if low is None:
        return ""
    return np.packbits(np.unpackbits(low[:, None], axis=1)[:, 8 - bits:]).tobytes().hex()


def likeness(a: np.ndarray | None, b: np.ndarray | None, bits: int = BITS) -> float:
    if a is None or b is None:
        return float(a is None and b is None)
    chance = 2.0 ** -bits
    return min(1.0, max(0.0, (float((a == b).mean()) - chance) / (1 - chance)))


def likeness_of(a: str, b: str, bins: int = BINS, bits: int = BITS) -> float:
    """Likeness of two packed fingerprints."""
    def opened(s: str):
        if not s:
            return None
        raw = np.unpackbits(np.frombuffer(bytes.fromhex(s), np.uint8))[:bins * bits].reshape(bins, bits)
        return raw @ (1 << np.arange(bits - 1, -1, -1))
    return likeness(opened(a), opened(b), bits)


# ------------------------------------------------------------------ operators

def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint): one narrow pass."""
    def run(batches):
        table = WordHashes()
        for b in batches:
            fp = [packed(low_bits(shingle_hashes(word_hashes((t or "").encode(), table)))) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fp, pa.string())], names=["doc_id", "fingerprint"])

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, fingerprint string")


def in_order(docs: DataFrame) -> DataFrame:
    """(doc_id, text, extra) with one ordered bucket per partition; ``extra``
    marks the copy of the following bucket's first row that ends each bucket
    (the last one is followed by the first again)."""
    docs = id_text(docs)
    cuts = order_cuts(docs, "doc_id", shuffle_partitions(docs.sparkSession))
    bucket = bucket_of(F.col("doc_id"), cuts)
    known = F.col("doc_id").isNotNull()
    heads = (docs.select("doc_id", bucket.alias("bucket")).groupBy("bucket")
             .agg(F.min(F.struct(known.alias("known"), "doc_id"))["doc_id"].alias("head"))
             .orderBy("bucket").collect())  # one row per bucket
    head_of = {r["bucket"]: r["head"] for r in heads}
    before = {r["bucket"]: heads[i - 1]["bucket"] for i, r in enumerate(heads)}

    @F.pandas_udf("int")
    def also(ids: pd.Series, there: pd.Series, at: pd.Series) -> pd.Series:
        """The bucket that a bucket's first row is sent to besides its own."""
        out = [before[b] if (i if k else None) == head_of[b] else None
               for i, k, b in zip(ids.tolist(), there.tolist(), at.tolist())]
        return pd.Series(out, dtype="Int32")

    def copy(at, extra: bool):
        return F.struct(at.alias("bucket"), F.lit(extra).alias("extra"))

    own, second = F.col("own"), F.col("second")
    return (docs.withColumn("own", bucket).withColumn("second", also(F.coalesce("doc_id", F.lit(0).cast("bigint")), known, "own"))
            .withColumn("x", F.explode(F.when(second.isNull(), F.array(copy(own, False)))
                                       .otherwise(F.array(copy(own, False), copy(second, True)))))
            .select("doc_id", "text", "x.extra", "x.bucket")
            .repartitionById(len(cuts) + 1, F.col("bucket")).sortWithinPartitions("extra", "doc_id", "text"))


def edited(text: str, following: str) -> str:
    """The text with its second half (rounded down) replaced by as many code
    points from the start of the following text, or all it has."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def compare_neighbours(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next of every row."""
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches):
        table, held, closed = WordHashes(), None, False
        for b in batches:
            rows = []
            for d, t, extra in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), b.column("extra").to_pylist()):
                if closed:
                    break  # further copies of a repeated first row
                t = t or ""
                fp = low_bits(shingle_hashes(word_hashes(t.encode(), table)))
                if held is not None:
                    d0, t0, fp0 = held
                    cut = edited(t0, t).encode()
                    fp_cut = low_bits(shingle_hashes(word_hashes(cut, table)))
                    rows.append((d0, len(t0), hashlib.sha256(cut).hexdigest(), packed(fp0), packed(fp_cut),
                                 likeness(fp0, fp_cut), likeness(fp0, fp)))
                held, closed = (d, t, fp), extra
            if rows:
                yield pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*rows)))), schema=schema)

    schema = pa.schema(list(zip(names, [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2])))
    return in_order(docs).mapInArrow(run, "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
                                          "edited_fingerprint string, near_edited double, near_next double")
