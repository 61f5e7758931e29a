"""Periodic runs of words, found by recompression and a harmonic grid.

A run is a stretch of words with smallest period q and at least max(6, 4q)
words that no neighbouring word extends.  Such a stretch covers three points in
a row of the grid 0, q, 2q, ..., so for every q only neighbouring grid points
with equal words are candidates (n/1 + n/2 + n/3 + ... of them, compared as
arrays).  A candidate (x, x + q) is extended exactly to both sides by longest
common extension (LCE) queries.

The LCE queries run on a grammar made by recompression: block compression
(every maximal repeat a^k becomes one symbol) and pair compression (symbols are
parted into left and right ones; every left-right pair becomes one symbol) take
turns until one symbol is left.  Equal stretches are parsed alike but for their
ends, so a query climbs while both sides stay aligned and then descends, taking
at most one step a level, in O(log n) whatever the length matched.  Blocks are
(symbol, count) rules, so a repeat of any length is one step.  Queries of many
candidates climb and descend together as arrays; no suffix array is built.

Documents are handled alone, in one narrow pass without shuffle; short ones
share a grammar, with a symbol of its own between any two of them.  Memory
follows the longest text.

Defined results: null text and text without words have no run and an empty
collapsed text; repeated rows each get their row; null ids are kept; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.llm.common import id_text, utf8

LEAST = 6          # words of the shortest run
POWER = 4          # periods of the shortest run
TOGETHER = 1 << 16  # words of the documents that share a grammar
STRIDED = 64       # periods whose grid is a strided view; larger ones are gathered
SLICE = 1 << 20    # gathered grid points at once


# -------------------------------------------------------------------- grammar

class Grammar:
    """Recompression of an integer sequence, level by level.

    ``sym[t]`` are the symbols of level t, ``up[t][k]`` the place on level t+1
    of symbol k of level t, ``down[t][k]`` where symbol k of level t begins on
    level t-1 (each with one closing entry for the end of the sequence)."""

    def __init__(self, seq: np.ndarray):
        self.sym, self.up, self.down = [np.unique(seq, return_inverse=True)[1]], [], [None]
        while len(self.sym[-1]) > 1:
            self._add(*(self._blocks() if len(self.up) % 2 == 0 else self._pairs()))

    def _add(self, first: np.ndarray, names: np.ndarray) -> None:
        """A level whose symbols begin at ``first`` on the level below."""
        below = len(self.sym[-1])
        begins = np.zeros(below, bool)
        begins[first] = True
        self.up.append(np.append(np.cumsum(begins, dtype=np.int32) - 1, np.int32(len(first))).astype(np.int32))
        self.down.append(np.append(first, below).astype(np.int32))
        self.sym.append(np.unique(names, return_inverse=True)[1])

    def _blocks(self) -> tuple[np.ndarray, np.ndarray]:
        s = self.sym[-1]
        first = np.flatnonzero(np.r_[True, s[1:] != s[:-1]])
        count = np.diff(np.append(first, len(s)))
        return first, s[first] * (int(count.max()) + 1) + count

    def _pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Left and right symbols are told apart by one hash bit of the round,
        in the orientation that gives more pairs.  No two neighbours are equal
        here, so some round always finds a pair."""
        s = self.sym[-1]
        mixed = (s.astype(np.uint64) + np.uint64(len(self.up) + 1)) * np.uint64(0x9E3779B97F4A7C15)
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        bit = (mixed >> np.uint64(40)) & np.uint64(1) == 1
        a, b = bit[:-1] & ~bit[1:], ~bit[:-1] & bit[1:]
        pair = a if np.count_nonzero(a) >= np.count_nonzero(b) else b
        begins = np.ones(len(s), bool)
        begins[1:] = ~pair
        first = np.flatnonzero(begins)
        size = int(s.max()) + 2
        names = s[first] * size
        two = np.append(pair, False)[first]
        names[two] += s[first[two] + 1] + 1
        return first, names

    def extend(self, x: np.ndarray, y: np.ndarray, back: bool = False) -> np.ndarray:
        """How many symbols of the sequence agree from the boundaries x and y
        on, to the right or, with ``back``, to the left."""
        out = np.empty(len(x), np.int64)
        who, i, j = np.arange(len(x)), x.astype(np.int64), y.astype(np.int64)
        stopped, top = [], len(self.up)
        for t in range(top):  # climb while both sides are aligned
            i, j, done = self._climb(t, i, j, back)
            stopped.append((who[done], i[done], j[done]))
            go = ~done
            who, i, j = who[go], self.up[t][i[go]], self.up[t][j[go]]
        for t in range(top, 0, -1):  # descend around the first difference
            if len(who):
                i, j = self.down[t][i], self.down[t][j]
                self._step(t - 1, i, j, back)
            more, p, q = stopped[t - 1]
            who, i, j = np.concatenate((who, more)), np.concatenate((i, p)), np.concatenate((j, q))
        out[who] = x[who] - i if back else i - x[who]
        return out

    def _same(self, t: int, i: np.ndarray, j: np.ndarray, back: bool) -> np.ndarray:
        """Which queries have equal symbols ahead (none at an end)."""
        s = self.sym[t]
        if back:
            ok = (i > 0) & (j > 0)
            at = np.flatnonzero(ok)
            ok[at] = s[i[at] - 1] == s[j[at] - 1]
        else:
            ok = (i < len(s)) & (j < len(s))
            at = np.flatnonzero(ok)
            ok[at] = s[i[at]] == s[j[at]]
        return ok

    def _ahead(self, t: int, i: np.ndarray, back: bool) -> np.ndarray:
        """Symbols from boundary i to the end of its block."""
        up, down = self.up[t], self.down[t + 1]
        return i - down[up[i - 1]] if back else down[up[i] + 1] - i

    def _aligned(self, t: int, i: np.ndarray) -> np.ndarray:
        return self.down[t + 1][self.up[t][i]] == i

    def _climb(self, t: int, i: np.ndarray, j: np.ndarray, back: bool):
        """One level's step before climbing: (i, j, which queries end here)."""
        i, j = i.copy(), j.copy()
        off = ~(self._aligned(t, i) & self._aligned(t, j))
        same = self._same(t, i, j, back)
        done = ~same
        at = np.flatnonzero(off & same)
        if t % 2 == 0:  # inside a block: to the nearer block end, and on only if both end there
            a, b = self._ahead(t, i[at], back), self._ahead(t, j[at], back)
            step = np.minimum(a, b)
            done[at] = a != b
        else:  # behind one half of a pair: past the other half
            step = 1
        i[at] += -step if back else step
        j[at] += -step if back else step
        return i, j, done

    def _step(self, t: int, i: np.ndarray, j: np.ndarray, back: bool) -> None:
        """One level's step below two different symbols, in place."""
        at = np.flatnonzero(self._same(t, i, j, back))
        step = np.minimum(self._ahead(t, i[at], back), self._ahead(t, j[at], back)) if t % 2 == 0 else 1
        i[at] += -step if back else step
        j[at] += -step if back else step


# ----------------------------------------------------------------- candidates

def grid_candidates(s: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """(q, x) by q, then x, of grid points that may be the first of a run's: the
    words at x, x + q and x + 2q are equal, and so are some more pairs at distance
    q that every run has.  ``longest``: words of the longest document."""
    n, found, top = len(s), [], longest // POWER
    for q in range(1, min(top, STRIDED) + 1):
        g = s[::q]
        eq = g[1:] == g[:-1]
        x = np.flatnonzero(eq[1:] & eq[:-1]) * q
        if len(x):
            found.append(_matching(s, np.full(len(x), q), x))
    lo = STRIDED + 1
    while lo <= top:  # larger periods, as many at once as make a slice of grid points
        hi, size = lo, 0
        while hi <= top and (size == 0 or size + n // hi <= SLICE):
            size += n // hi
            hi += 1
        periods = np.arange(lo, hi)
        points = np.maximum((n - 1) // periods - 1, 0)  # x + 2q is inside
        q = np.repeat(periods, points)
        x = (np.arange(len(q)) - np.repeat(np.cumsum(points) - points, points)) * q
        ok = np.flatnonzero(s[x] == s[x + q])
        q, x = q[ok], x[ok]
        ok = s[x] == s[x + 2 * q]
        found.append(_matching(s, q[ok], x[ok]))
        lo = hi
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    q, x = (np.concatenate(c) for c in zip(*found))
    order = np.lexsort((x, q))
    return q[order], x[order]


def _matching(s: np.ndarray, q: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The candidates whose words match at some further places in [x, x + 2q],
    all of which the matches of a run cover."""
    for offset in (np.ones_like, lambda q: q // 2, lambda q: q + q // 2):
        at = x + offset(q)
        ok = np.flatnonzero(at + q < len(s))
        ok = ok[s[at[ok]] == s[at[ok] + q[ok]]]
        q, x = q[ok], x[ok]
    return q, x


def runs_of(s: np.ndarray, longest: int) -> np.ndarray:
    """(start, end, period) rows, by start, then period."""
    q, x = grid_candidates(s, longest)
    if not len(q):
        return np.empty((0, 3), np.int64)
    grammar = Grammar(s)
    # neighbouring candidates of a period are mostly in one stretch: extend the first of each chain, go on behind it
    new = np.r_[True, (q[1:] != q[:-1]) | (x[1:] - x[:-1] != q[1:])]
    heads = np.flatnonzero(new)
    ends = np.append(heads[1:], len(q))
    key, size = q * (len(s) + 1) + x, len(s) + 1
    out = []
    while len(heads):
        p, a = q[heads], x[heads]
        right, left = grammar.extend(a, a + p), grammar.extend(a, a + p, back=True)
        start, end = a - left, a + p + right
        ok = end - start >= np.maximum(LEAST, POWER * p)
        out.append(np.c_[start[ok], end[ok], p[ok]])
        heads = np.searchsorted(key, p * size + a + np.maximum(right, 1))  # the next one behind this stretch
        go = heads < ends
        heads, ends = heads[go], ends[go]
    rows = np.concatenate(out)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    # of one stretch the smallest period counts; the others are its multiples
    first = np.r_[True, (rows[1:, :2] != rows[:-1, :2]).any(axis=1)] if len(rows) else np.empty(0, bool)
    rows = rows[first]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def document_runs(docs: list[list[bytes]]) -> list[np.ndarray]:
    """(start, end, period) rows of every document, given as lists of words."""
    ids: dict[bytes, int] = {}
    sizes = np.array([len(d) for d in docs], np.int64)
    first = np.cumsum(sizes + 1) - (sizes + 1)
    s = np.empty(int((sizes + 1).sum()), np.int64)
    for d, at in zip(docs, first.tolist()):
        s[at:at + len(d)] = [ids.setdefault(w, len(ids)) for w in d]
    s[first + sizes] = len(ids) + np.arange(len(docs))  # a symbol of its own behind every document
    rows = runs_of(s, int(sizes.max(initial=0)))
    of = np.searchsorted(first, rows[:, 0], side="right") - 1
    rows[:, :2] -= first[of, None]
    cuts = np.searchsorted(of, np.arange(len(docs) + 1))
    return [rows[a:b] for a, b in zip(cuts[:-1], cuts[1:])]


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words that no run holds behind its first period."""
    if not len(runs):
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 1], -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()])


def strongest(runs: np.ndarray) -> tuple[int, int, int] | None:
    """(start, length, period) of greatest exact length / period; ties go to
    the smallest start, then period, which is the order of the rows."""
    best = None
    for a, b, p in runs.tolist():
        if best is None or (b - a) * best[2] > best[1] * p:
            best = a, b - a, p
    return best


# ------------------------------------------------------------------- operator

SCHEMA = ("doc_id bigint, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, "
          "start bigint, length bigint, period bigint, collapsed string")


def _batch(ids: list, docs: list[list[bytes]]) -> pa.RecordBatch:
    found = document_runs(docs)
    best = [strongest(r) or (None,) * 3 for r in found]
    spans = [[{"start": a, "length": b - a, "period": p} for a, b, p in r.tolist()] for r in found]
    long = pa.int64()
    span = pa.list_(pa.struct([("start", long), ("length", long), ("period", long)]))
    texts = [collapsed(d, r).decode() for d, r in zip(docs, found)]
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, long), pa.array([len(d) for d in docs], long), pa.array(spans, span),
         *[pa.array(c, long) for c in zip(*best)], pa.array(texts, pa.string())],
        names=["doc_id", "n_words", "runs", "start", "length", "period", "collapsed"])


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, runs, start, length, period, collapsed): all runs by
    start, then period; the strongest run; the text without the repeats."""
    def run(batches):
        for b in batches:
            ids, some, size = [], [], 0
            for d, t in zip(b.column("doc_id").to_pylist(), utf8(b)):
                ids.append(d)
                some.append(t.split())  # bytes split at blank, tab, CR, LF, VT and FF
                size += len(some[-1])
                if size >= TOGETHER:
                    yield _batch(ids, some)
                    ids, some, size = [], [], 0
            if ids:
                yield _batch(ids, some)

    return id_text(docs, id_col, text_col).mapInArrow(run, SCHEMA)


def with_cycles(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Stand-in input of the registered query: (doc_id, text) where every
    document with crc32(doc_id) % 10 = 0 repeats p of its words from word a on,
    as the query's contract lays down."""
    d = id_text(docs, id_col, text_col)
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), 0)
    d = d.withColumn("_g", F.floor(h / 10)).withColumn("_w", F.when((h % 10 == 0) & F.col("text").isNotNull(), words))
    n = F.size("_w")
    d = d.withColumn("_a", F.when(n > 0, F.col("_g") % n))
    d = d.withColumn("_p", F.lit(1) + F.floor((n - F.col("_a")) / (F.lit(3) + F.col("_g") % 8)))
    place = lambda i: F.when(i < F.col("_a"), i).otherwise(F.col("_a") + (i - F.col("_a")) % F.col("_p")).cast("int")
    cycled = F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get("_w", place(i))), " ")
    return d.select("doc_id", F.when(n > 0, cycled).otherwise(F.col("text")).alias("text"))
