"""Bounded-space online best-fit packing of documents into token sequences.

Every input split packs its own documents as they come: no shuffle of texts or
ids.  A packer has at most ``OPEN`` open sequences.  Their free spaces are the
bits of one integer, so the tightest sequence that still takes a piece is its
lowest set bit at or above the piece's length; when one too many is open, the
fullest (lowest bit) is closed.  The pieces of what a split leaves open at its
end are packed once more with those of other splits, longest first and by the
same rule, in groups of bounded size: only (sequence, offset, length) rows move.

Only documents longer than a sequence are cut, into full pieces; the first piece
takes the remainder.  A split is read in file order, so a task run again gives
the same rows.

Defined results: null text is empty (the end id alone); a repeated doc_id is
packed per row; a null doc_id is kept; an empty table gives no rows; other
columns are ignored.  With ``group_col`` a sequence takes documents of one
group alone (null is a group), and a split has a packer a group.
"""

from __future__ import annotations

import itertools
import zlib
from array import array

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.llm.common import lean, materialize
from winnow.llm.tokenizing import encoder

OPEN = 1024          # open sequences of a packer
GROUP = 1 << 14      # open sequences whose pieces are packed together, about
SPLIT_BITS = 33      # low bits of a sequence id: its number within the split


class Packer:
    """Online best-fit into bins of ``size``; ``put`` returns (bin, offset)."""

    def __init__(self, size: int, limit: int, numbers=None):
        self.size, self.limit, self.numbers, self.open, self.mask = size, limit, numbers or itertools.count(), 0, 0
        self.by_free: list[list[int]] = [[] for _ in range(size + 1)]

    def _push(self, free: int, b: int) -> None:
        self.by_free[free].append(b)
        self.mask |= 1 << free
        self.open += 1

    def _pop(self, free: int) -> int:
        b = self.by_free[free].pop()
        if not self.by_free[free]:
            self.mask &= ~(1 << free)
        self.open -= 1
        return b

    def put(self, n: int) -> tuple[int, int]:
        fits = self.mask >> n
        if fits:
            free = n + (fits & -fits).bit_length() - 1
            b = self._pop(free)
        else:
            b, free = next(self.numbers), self.size
        if free > n:
            self._push(free - n, b)
            if self.open > self.limit:
                self._pop((self.mask & -self.mask).bit_length() - 1)  # closed for good
        return b, self.size - free

    def rests(self) -> list[tuple[int, int]]:
        """(bin, used) of what is still open."""
        return [(b, self.size - f) for f, bins in enumerate(self.by_free) for b in bins]


def _split_pieces(docs: DataFrame, vocab: str, end_id: int, size: int, limit: int, with_ids: bool) -> DataFrame:
    """Pieces of every split as packed there; ``used`` marks the extra rows
    that name the split's open rests."""
    end = array("I", [end_id]).tobytes()
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "used", "ids", "grp"]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.string()]

    def run(batches):
        from pyspark import TaskContext
        enc, numbers, base = encoder(vocab), itertools.count(), TaskContext.get().partitionId() << SPLIT_BITS
        packers: dict = {}
        for b in batches:
            rows = []
            for d, t, g in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), b.column("grp").to_pylist()):
                if g not in packers:
                    packers[g] = Packer(size, limit, numbers)
                packer = packers[g]
                ids = enc.encode(t or "") + end
                n = len(ids) // 4
                lo, k = 0, 0
                while lo < n:
                    hi = lo + ((n - lo - 1) % size + 1)  # the remainder first, full pieces after it
                    seq, at = packer.put(hi - lo)
                    part = ids[4 * lo:4 * hi]
                    rows.append((d, k, lo, hi - lo, zlib.crc32(part), base + seq, at, None, part if with_ids else None, g))
                    lo, k = hi, k + 1
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
        if rest := [r for p in packers.values() for r in p.rests()]:
            yield pa.RecordBatch.from_pydict(
                {n: pa.array([base + s for s, _ in rest] if n == "sequence_id" else [u for _, u in rest] if n == "used"
                             else [None] * len(rest), t) for n, t in zip(names, types)})

    return docs.mapInArrow(lean(run), "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, "
                                         "sequence_id bigint, offset bigint, used int, ids binary, grp string")


def _merge(size: int, limit: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "sequence_id", "offset"], ascending=[False, True, True])
        packers, numbers, group = {}, itertools.count(), int(pdf["g"].iat[0])
        for x in pdf["grp"].unique():
            packers[x] = Packer(size, limit, numbers)
        placed = [packers[x].put(n) for x, n in zip(pdf["grp"], pdf["length"].tolist())]
        return pd.DataFrame({"sequence_id": pdf["sequence_id"].to_numpy(), "offset": pdf["offset"].to_numpy(),
                             "into": [-1 - (group << SPLIT_BITS) - b for b, _ in placed], "at": [at for _, at in placed]})
    return run


def pack(docs: DataFrame, vocab: str, end_id: int, size: int = 1024, limit: int = OPEN, with_ids: bool = False,
         id_col: str = "doc_id", text_col: str = "text", group_col: str | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id,
    offset (and ids, uint32 bytes, ``with_ids``)."""
    group = (F.col(group_col) if group_col else F.lit(None)).cast("string")
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"), group.alias("grp"))
    rows = materialize(_split_pieces(docs, vocab, end_id, size, limit, with_ids), "pieces")
    rests = rows.where(F.col("used").isNotNull()).select("sequence_id")
    pieces = rows.where(F.col("used").isNull()).drop("used")
    groups = max(1, rests.count() // GROUP)
    loose = (pieces.select("sequence_id", "offset", "length", "grp").join(rests, "sequence_id", "left_semi")
             .withColumn("g", F.pmod(F.xxhash64("sequence_id"), F.lit(groups))))
    moved = loose.groupBy("g").applyInPandas(_merge(size, limit), "sequence_id bigint, offset bigint, into bigint, at bigint")
    out = pieces.join(moved, ["sequence_id", "offset"], "left").select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        F.coalesce("into", "sequence_id").alias("sequence_id"), F.coalesce("at", "offset").alias("offset"), "ids")
    return out if with_ids else out.drop("ids")
