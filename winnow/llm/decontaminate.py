"""Benchmark decontamination by SimHash of item-sized windows.

Benchmark items fall into size classes of at most GROWTH between neighbours.  An
item's windows of its class's size -- its head, middle and tail, so that an edit
at one end leaves a window without it -- have SimHashes over 5-word shingles; so
has every window of that size of every document (one-word steps, sums from a
running count).  Multi-index hashing finds all window fingerprints within RADIUS
bits of an item's: of BLOCKS blocks of 16 bits one differs in at most
RADIUS // BLOCKS bits, so each stored fingerprint is posted under all such values
of each block, and a probe is compared with the postings of its block values
alone.  Around every hit all windows of the item's own length are verified: the
weighted Jaccard similarity (repeats counted) of the shingles must reach 0.8.

A fingerprint of 64 bits stands for a similarity with some error, so an edited
copy near 0.8 can lie beyond the radius; the tests measure the recall against
brute force (README states it).  An unedited copy has distance 0 and is found.

Words are runs of letters, digits and non-ASCII bytes, lower-cased A-Z; other
ASCII separates.  Items of fewer than 5 words are one shingle of all their words.
A document shorter than a class's window is one window.

Scale: one narrow pass over the documents; the items, a bounded slice of
ITEM_BYTES at a time, travel with the task, and a larger benchmark means further
passes, not a larger broadcast.  A long text is counted in slices.

Defined results: null or wordless texts and items match nothing; a repeated item
or document is reported per id; null ids are reported as null; an empty
benchmark or table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.llm.common import id_text, lean, map_rows, utf8
from winnow.llm.densified_minhash import WordHashes, shingle_hashes

SHINGLE = 5
SIMILARITY = 0.8
RADIUS, BLOCKS = 11, 4
GROWTH = 1.2           # ratio of neighbouring window sizes
SLICE = 1 << 12        # windows of a text counted at once
SHIFT = 3              # words an aligned window may be off, besides an eighth of the item
REMEMBERED = 1 << 17   # word hashes a task remembers
ITEM_BYTES = 1 << 20   # benchmark text of one pass
# Fixed value: letters, digits and bytes beyond ASCII stay, A-Z are lowered, all else separates.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


def simhash(shingles: np.ndarray) -> np.uint64:
    ones = np.unpackbits(shingles.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > len(shingles), bitorder="little").view("<u8")[0]


def window_hashes(shingles: np.ndarray, room: np.ndarray, sizes: list[int]):
    """(size, starts, fingerprints) of all windows of all sizes over texts laid
    end to end, slice by slice; ``room``: shingles from each place to the end of
    its text.  A text shorter than a window is one window."""
    n, top = len(shingles), max(sizes)
    first = np.append(True, room[1:] >= room[:-1])  # a text begins where the room does not shrink
    for lo in range(0, n, SLICE):
        part = shingles[lo:lo + SLICE + top - 1]
        bits = np.unpackbits(part.view(np.uint8), bitorder="little").reshape(-1, 64)
        # sums modulo 2**8 or 2**16 are enough for differences below that
        total = np.zeros((len(part) + 1, 64), np.uint8 if top < 256 else np.uint16 if top < 65536 else np.int64)
        np.cumsum(bits, axis=0, out=total[1:], dtype=total.dtype)
        here = room[lo:lo + SLICE]
        begins = np.flatnonzero(first[lo:lo + SLICE])
        for size in sizes:
            count = min(len(here), len(part) - size + 1)
            if count > 0:  # windows across two texts are hashed too and dropped
                ones = total[size:size + count] - total[:count]
                fps = np.packbits((ones > size // 2).ravel(), bitorder="little").view("<u8")
                inside = here[:count] >= size
                if not inside.all():
                    at = np.flatnonzero(inside)
                    yield size, at + lo, fps[at]
                else:
                    yield size, np.arange(lo, lo + count), fps
            short = begins[here[begins] < size]
            if len(short):
                w = here[short]
                ones = total[short + w] - total[short]
                yield size, short + lo, np.packbits((ones > (w // 2)[:, None]).ravel(), bitorder="little").view("<u8")


# ---------------------------------------------------------------- the index

def _near_blocks(radius: int) -> np.ndarray:
    """All 16-bit patterns of at most ``radius`` ones."""
    every = np.arange(65536, dtype=np.uint16)
    return every[np.bitwise_count(every) <= radius]


class HammingIndex:
    """All stored fingerprints within RADIUS of a probe, by posting lists: a
    stored fingerprint stands under every value of a block that is within
    RADIUS // BLOCKS bits of its own."""

    def __init__(self, fps: np.ndarray):
        self.fps = fps
        masks = _near_blocks(RADIUS // BLOCKS)
        self.tables = np.zeros((BLOCKS, 65536), bool)
        self.posted = []
        for k in range(BLOCKS):
            values = (self.block(fps, k)[:, None] ^ masks[None, :]).ravel()
            order = np.argsort(values, kind="stable")
            first = np.zeros(65537, np.int32)
            np.cumsum(np.bincount(values, minlength=65536), out=first[1:])
            self.posted.append((first, (order // len(masks)).astype(np.int32)))
            self.tables[k, values] = True

    def __reduce__(self):
        return HammingIndex, (self.fps,)  # postings are built where they are used

    @staticmethod
    def block(fps: np.ndarray, k: int) -> np.ndarray:
        return np.ascontiguousarray(fps).view("<u2").reshape(-1, 4)[:, k]

    def probe(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(probe, stored) index pairs within RADIUS bits; a pair that meets in
        several blocks may come several times."""
        i, j = [], []
        blocks = np.ascontiguousarray(fps).view("<u2").reshape(-1, 4).T.astype(np.intp)
        for k in range(BLOCKS):
            at = np.flatnonzero(self.tables[k].take(blocks[k], mode="clip"))
            if not len(at):
                continue
            first, posted = self.posted[k]
            lo = first[blocks[k][at]]
            n = first[blocks[k][at] + 1] - lo
            p = np.repeat(at, n)
            s = posted[np.arange(len(p)) + np.repeat(lo - (np.cumsum(n) - n), n)]
            near = np.flatnonzero(np.bitwise_count(fps[p] ^ self.fps[s]) <= RADIUS)
            if len(near):
                i.append(p[near])
                j.append(s[near])
        if not i:
            return (np.empty(0, np.int64),) * 2
        return np.concatenate(i), np.concatenate(j)


def size_class(n: int) -> int:
    """Largest class size of at most ``n`` shingles."""
    size = 1
    while (larger := max(size + 1, int(size * GROWTH))) <= n:
        size = larger
    return size


def least_shared(n: int) -> int:
    """Shingles a window must share with an item of ``n`` to reach SIMILARITY."""
    t = max(1, int(SIMILARITY * n))  # rounding must not ask for one too many
    return t if t >= SIMILARITY * n else t + 1


class Items:
    """Benchmark items as shingles, by shingle length, with their indexes."""

    def __init__(self, rows: list[tuple[int, bytes]]):
        table = WordHashes()
        self.by_length: dict[int, tuple[list, dict[int, tuple[list, HammingIndex]]]] = {}
        raw: dict[int, list] = {}
        for item, text in rows:
            w = words_of(text)
            if not w:
                continue
            k = min(SHINGLE, len(w))
            sh = shingle_hashes(np.fromiter(map(table.__getitem__, w), np.uint64, len(w)), k)
            raw.setdefault(k, []).append((item, sh))
        for k, members in sorted(raw.items()):
            sizes: dict[int, list] = {}
            for m, (_, sh) in enumerate(members):
                size = size_class(len(sh))
                rest = len(sh) - size
                sizes.setdefault(size, []).extend((m, at) for at in sorted({0, rest // 2, rest}))
            index = {}
            for size, inner in sorted(sizes.items()):
                fps = np.array([simhash(np.ascontiguousarray(members[m][1][at:at + size])) for m, at in inner], np.uint64)
                index[size] = inner, HammingIndex(fps)
            self.by_length[k] = [(item, Counter(sh.tolist()), len(sh)) for item, sh in members], index

    def matches(self, texts: list[bytes], table: WordHashes) -> list[dict]:
        """Per text: item -> (start word, words, similarity) of its best window."""
        best: list[dict] = [{} for _ in texts]
        for d, item, start, n, s in self.found(texts, table):
            if item not in best[d] or (-s, start) < (-best[d][item][2], best[d][item][0]):
                best[d][item] = start, n, s
        return best

    def found(self, texts: list[bytes], table: WordHashes):
        """(text, item, start word, words, similarity) of verified windows."""
        hashed = []
        for text in texts:
            w = words_of(text)
            hashed.append(np.fromiter(map(table.__getitem__, w), np.uint64, len(w)))
        for k, (entries, sizes) in self.by_length.items():
            of = [d for d, h in enumerate(hashed) if len(h) >= k]
            if not of:
                continue
            parts = [shingle_hashes(hashed[d], k) for d in of]
            ends = np.cumsum([len(p) for p in parts])
            sh = np.concatenate(parts)
            room = np.repeat(ends, [len(p) for p in parts]) - np.arange(len(sh))
            starts: dict[tuple[int, int], list] = {}  # (text, item) -> first and last start of windows to verify
            for size, at, fps in window_hashes(sh, room, list(sizes)):
                inner, index = sizes[size]
                i, j = index.probe(fps)
                if not len(i):
                    continue
                place = at[i]
                text = np.searchsorted(ends, place, side="right")
                local = place - np.append(0, ends)[text]
                for d, p, x in zip(text.tolist(), local.tolist(), j.tolist()):
                    m, inside = inner[x]
                    off = SHIFT + entries[m][2] // 8  # edits within the similarity move a window by no more
                    starts.setdefault((d, m), []).append((p - inside - off, p - inside + off))
            for (d, m), spans in starts.items():
                item, weights, n = entries[m]
                for first, last in merged(spans):
                    hit = best_window(weights, n, parts[d], first, last)
                    if hit:
                        yield of[d], item, hit[0], hit[1] + k - 1, hit[2]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Closed ranges as disjoint ones."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1] + 1:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def best_window(weights: Counter, n: int, shingles: np.ndarray, first: int, last: int) -> tuple | None:
    """(first shingle, shingles, similarity) of the most similar window of ``n``
    that starts in first..last, the earliest of equals, if it reaches SIMILARITY.
    Of a window over an end of the text the part inside counts."""
    lo, hi = max(0, first), min(len(shingles), last + n)
    part = shingles[lo:hi].tolist()
    known = [h if h in weights else None for h in part]
    if len(known) - known.count(None) < least_shared(n):
        return None
    have: Counter = Counter()
    shared, a, b, best = 0, lo, lo, None
    for start in range(first, last + 1):
        x, y = max(0, start), min(len(shingles), start + n)
        if y <= x:
            continue
        while b < y:
            h = known[b - lo]
            if h is not None:
                have[h] += 1
                shared += have[h] <= weights[h]
            b += 1
        while a < x:
            h = known[a - lo]
            if h is not None:
                shared -= have[h] <= weights[h]
                have[h] -= 1
            a += 1
        s = shared / (n + y - x - shared)
        if s >= SIMILARITY and (best is None or s > best[2]):
            best = x, y - x, s
    return best


# ------------------------------------------------------------------ operators

def item_slices(benchmark: DataFrame, item_col: str, item_text: str):
    """The benchmark as indexes of about ITEM_BYTES of text each."""
    items = benchmark.select(F.col(item_col).cast("bigint").alias("item_id"), F.col(item_text).cast("string").alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = -(-total // ITEM_BYTES)
    for part in range(passes):
        rows = (items.where(F.col("text").isNotNull() & (F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == part))
                .distinct().collect())  # at most about ITEM_BYTES of text
        yield Items([(r["item_id"], r["text"].encode()) for r in rows])


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, start_word, n_words, similarity): one row per document
    and benchmark item found in it, at its best window."""
    docs = id_text(docs, id_col, text_col)
    schema = "doc_id bigint, item_id bigint, start_word bigint, n_words bigint, similarity double"
    out = None
    for items in item_slices(benchmark, item_col, item_text):
        found = docs.mapInArrow(lean(_search(items, ["doc_id", "item_id", "start_word", "n_words", "similarity"])), schema)
        out = found if out is None else out.unionByName(found)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def _search(items: Items, names: list[str]):
    def run(batches):
        table = WordHashes(REMEMBERED)
        for b in batches:
            found = items.matches(utf8(b), table)
            rows = [(d, item, *v) for d, best in zip(b.column("doc_id").to_pylist(), found) for item, v in best.items()]
            cols = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.float64() if n == "similarity" else pa.int64())
                                              for n, c in zip(names, cols)], names=names)
    return run


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                      item_text: str = "text") -> DataFrame:
    """``docs`` without the rows whose own text holds a benchmark item: a narrow
    pass, whatever the ids."""
    docs = docs.withColumn(text_col, F.col(text_col).cast("string"))
    for items in item_slices(benchmark, item_col, item_text):
        docs = map_rows(docs, _clean(items, text_col))
    return docs


def _clean(items: Items, text_col: str):
    table = WordHashes(REMEMBERED)  # each task's own: the function travels with it

    def clean(batch: pa.RecordBatch) -> pa.RecordBatch:
        held = {d for d, *_ in items.found(utf8(batch, text_col), table)}
        return batch.filter(pa.array([d not in held for d in range(len(batch))], pa.bool_()))
    return clean
