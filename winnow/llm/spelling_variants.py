"""Spelling variants grouped by bidirectional FM-index search schemes.

Two words are near if they differ by exactly one inserted, deleted or replaced
letter.  A word is cut in two halves; one of them must occur unchanged in any
near word, at its beginning or at its end.  So a word is searched twice: its
left half is matched exactly, leftwards from the cut to the delimiter, and then
extended across the right half with one error; and the right half exactly,
rightwards to the delimiter, then extended across the left half.  The index
holds the suffix ranks of the delimited vocabulary ($word$word$...) and of its
reverse; a search state is one interval in each, kept in step, so it extends to
either side.  Errors branch only into letters that occur in the interval.  All
states of a step are extended together as arrays.

Scale: occurrences are counted by one partially aggregated groupBy.  The
vocabulary is sharded by the halves: a word is indexed in the shards of every
half that a near word may share with it (four at most) and searched in the two
shards of its own, so a shard answers alone, and memory is bounded by
SHARD_LETTERS.  A shard with more letters (a beginning that very many words
share) is cut into tiles of some of its words and some of its searches.  A
search returns its count and best near word, not its pairs; a near word that
keeps the left half is counted by the first search only, and the words of a
shard are distinct, so nothing is counted twice.

Defined results: null texts and texts without letters add nothing; a null id is
written as an empty string; repeated rows count again; an empty table gives no
rows; other columns are ignored.  Ties go to the smallest word by code point.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.llm.common import id_text, materialize

# What a run of letters is, and which letters are lowered.
RUN = "[a-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LETTERS, TIMES, RATIO = 6, 5, 5  # least length and occurrences of a word; how much more frequent a form is
TYPO = 199                       # one occurrence in so many loses a letter in the registered query
SHARD_LETTERS = 1 << 18          # indexed letters of a shard, about
SEARCHES = 4096                  # searches run together
BLOCK = 64                       # symbols between two counted rows of the index
END, GAP = 0, 1                  # symbols: end of the text, delimiter; letters follow


# ------------------------------------------------------------------- the index

def suffix_ranks(text: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; the last symbol is the unique smallest."""
    rank, width, n = text.astype(np.int64), 1, len(text)
    while True:
        behind = np.zeros(n, np.int64)
        behind[:n - width] = rank[width:] + 1
        key = rank * (n + 2) + behind
        order = np.argsort(key, kind="stable")
        new = np.r_[0, np.cumsum(key[order][1:] != key[order][:-1])]
        if new[-1] == n - 1:
            return order
        rank[order] = new
        width = min(2 * width, n - 1)


class Side:
    """One direction of the index: symbols before the sorted suffixes, with counts."""

    def __init__(self, text: np.ndarray, symbols: int):
        self.n = len(text)
        self.suffix = suffix_ranks(text)
        self.last = text[self.suffix - 1]  # the symbol before each suffix
        at = np.argsort(self.last, kind="stable")
        self.keys = self.last[at] * (self.n + 1) + at  # (symbol, row) in order
        # how many symbols below each symbol stand before every BLOCK-th row
        rows = np.zeros((self.n // BLOCK + 2, symbols + 1), np.int32)
        np.add.at(rows, (np.arange(self.n) // BLOCK + 1, self.last + 1), 1)
        self.below = np.cumsum(np.cumsum(rows, axis=0, dtype=np.int32), axis=1, dtype=np.int32)
        self.padded = np.append(self.last, np.full(BLOCK, symbols + 1)).astype(np.int16)

    def step(self, c: np.ndarray, lo: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Interval of the pattern with ``c`` put before it."""
        base = c.astype(np.int64) * (self.n + 1)
        first = np.searchsorted(self.keys, base + lo)
        return first, np.searchsorted(self.keys, base + lo + size) - first

    def smaller(self, c: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Symbols below ``c`` before the first ``row`` rows."""
        block = row // BLOCK
        part = self.padded[(block * BLOCK)[:, None] + np.arange(BLOCK)] < c[:, None]
        part &= np.arange(BLOCK) < (row % BLOCK)[:, None]
        return self.below[block, np.minimum(c, self.below.shape[1] - 1)] + part.sum(axis=1)


class Index:
    """Bidirectional FM-index of distinct words."""

    def __init__(self, words: list[str]):
        letters = sorted(set("".join(words)))
        self.code = {c: i + 2 for i, c in enumerate(letters)}
        self.symbols = len(letters) + 2
        flat = np.array([self.code[c] for w in words for c in w], np.int64)
        sizes = np.array([len(w) for w in words], np.int64)
        self.first = np.cumsum(sizes + 1) - (sizes + 1)  # where each word's leading delimiter stands
        text = np.full(int(sizes.sum()) + len(words) + 2, GAP, np.int64)
        text[np.arange(len(flat)) + np.repeat(np.arange(len(words)) + 1, sizes)] = flat
        text[-1] = END
        self.size = len(text)
        self.left = Side(text, self.symbols)                                    # extends to the left
        self.right = Side(np.append(text[:-1][::-1], END), self.symbols)        # extends to the right

    def encoded(self, word: str) -> np.ndarray:
        return np.array([self.code.get(c, self.symbols) for c in word], np.int64)

    def near(self, searches: list[np.ndarray], leftwards: bool) -> tuple[np.ndarray, np.ndarray]:
        """(search, word) of the near words that keep one half: the left half if
        the errors lie rightwards, the right half if ``leftwards``."""
        found = [self._search(searches[i:i + SEARCHES], leftwards) for i in range(0, len(searches), SEARCHES)]
        return (np.concatenate([f[0] + i * SEARCHES for i, f in enumerate(found)]),
                np.concatenate([f[1] for f in found])) if found else (np.empty(0, np.int64),) * 2

    def _search(self, searches: list[np.ndarray], leftwards: bool) -> tuple[np.ndarray, np.ndarray]:
        kept, other = [], []  # both read away from the cut, with the delimiter behind
        for w in searches:
            cut = len(w) // 2
            a, b = np.append(w[:cut][::-1], GAP), np.append(w[cut:], GAP)
            kept.append(b if leftwards else a)
            other.append(a if leftwards else b)
        one, two = (self.right, self.left) if leftwards else (self.left, self.right)
        # the exact half, keeping the interval of the other direction in step
        table, length = padded(kept)
        q = np.arange(len(searches))
        lo, far, size = np.zeros(len(q), np.int64), np.zeros(len(q), np.int64), np.full(len(q), self.size)
        for p in range(table.shape[1]):
            at = np.flatnonzero(length[q] > p)
            c = table[q[at], p]
            far[at] += one.smaller(c, lo[at] + size[at]) - one.smaller(c, lo[at])
            lo[at], size[at] = one.step(c, lo[at], size[at])
            live = size > 0
            q, lo, far, size = q[live], lo[live], far[live], size[live]
        return self._one_error(two, other, q, far, size, leftwards)

    def _one_error(self, side: Side, other: list[np.ndarray], q, lo, size, leftwards: bool):
        """Extend the intervals across ``other`` with exactly one error."""
        table, length = padded(other)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        bad = tuple(np.empty(0, np.int64) for _ in range(3))  # states behind their error
        for p in range(table.shape[1]):
            c = table[q, p]
            final = length[q] == p + 1  # the delimiter: only an insertion can stand before it
            s, b = self._branches(side, lo, size)  # (state, letter) that occur next
            l2, z2 = side.step(b, lo[s], size[s])
            swap = (b != c[s]) & ~final[s]
            l3, z3 = side.step(c[s], l2, z2)  # inserted letter, then the expected symbol
            drop = ~final
            bq, bl, bz = bad
            l1, z1 = side.step(table[bq, p], bl, bz)
            bad = distinct(*(np.concatenate(x) for x in zip(
                (bq, l1, z1), (q[s][swap], l2[swap], z2[swap]), (q[s], l3, z3), (q[drop], lo[drop], size[drop]))))
            lo, size = side.step(c, lo, size)
            live = (size > 0) & ~final
            q, lo, size = q[live], lo[live], size[live]
            ended = length[bad[0]] == p + 1
            done.append((bad[0][ended], bad[1][ended]))
            bad = tuple(x[~ended] for x in bad)
            if not len(q) and not len(bad[0]):
                break
        who = np.concatenate([d[0] for d in done])
        place = side.suffix[np.concatenate([d[1] for d in done])]
        # leftwards the suffix begins at the word's leading delimiter, rightwards at its closing one, read backwards
        start = place if leftwards else self.size - 2 - place - 1
        return who, np.searchsorted(self.first, start, side="right") - 1

    def _branches(self, side: Side, lo, size) -> tuple[np.ndarray, np.ndarray]:
        """(state, letter): every letter that stands next to a state's pattern."""
        few = np.flatnonzero(size <= 2 * self.symbols)
        total = size[few]
        s = np.repeat(few, total)
        row = np.arange(len(s)) - np.repeat(np.cumsum(total) - total, total) + lo[s]
        pairs = np.unique(s * (self.symbols + 1) + side.last[row])
        many = np.flatnonzero(size > 2 * self.symbols)
        pairs = np.concatenate((pairs, (many[:, None] * (self.symbols + 1) + np.arange(self.symbols)).ravel()))
        s, b = np.divmod(pairs, self.symbols + 1)
        return s[b > GAP], b[b > GAP]


def padded(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    length = np.array([len(r) for r in rows], np.int64)
    table = np.zeros((len(rows), int(length.max(initial=0))), np.int64)
    for i, r in enumerate(rows):
        table[i, :len(r)] = r
    return table, length


def distinct(q, lo, size):
    """Live states once each: several errors may give the same pattern."""
    at = np.flatnonzero(size > 0)
    q, lo, size = q[at], lo[at], size[at]
    if not len(q):
        return q, lo, size
    order = np.lexsort((size, lo, q))
    q, lo, size = q[order], lo[order], size[order]
    new = np.r_[True, (q[1:] != q[:-1]) | (lo[1:] != lo[:-1]) | (size[1:] != size[:-1])]
    return q[new], lo[new], size[new]


def near_words(words: list[str], searches: list[tuple[str, str]]):
    """(search, word) index pairs: near words that the searches (word, side) find."""
    index, out = Index(words), []
    for side in ("left", "right"):
        at = np.array([i for i, (_, s) in enumerate(searches) if s == side], np.int64)
        who, what = index.near([index.encoded(searches[i][0]) for i in at.tolist()], side == "right")
        for i, j in zip(at[who].tolist(), what.tolist()):
            w = searches[i][0]
            if side == "left" or not words[j].startswith(w[:len(w) // 2]):
                out.append((i, j))
    return out


# ------------------------------------------------------------------- operators

def occurrences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, run): every maximal run of letters, lower-cased A-Z."""
    d = id_text(docs, id_col, text_col)
    return d.select("doc_id", F.explode(F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(RUN), 0)).alias("run"))


def with_typos(runs: DataFrame) -> DataFrame:
    """Stand-in input of the registered query: (word), where a run whose crc32 of
    doc_id:run is a multiple of TYPO loses one letter, as the contract lays down."""
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), "run"))
    place = (F.col("_h") % F.length("run")).cast("int")
    cut = F.concat(F.expr("substring(run, 1, _p)"), F.expr("substring(run, _p + 2)"))
    return (runs.withColumn("_h", h).withColumn("_p", place)
            .select(F.when(F.col("_h") % TYPO == 0, cut).otherwise(F.col("run")).alias("word")))


def counted(words: DataFrame, letters: int = LETTERS, times: int = TIMES) -> DataFrame:
    """(word, n) of the words of at least ``letters`` letters and ``times`` occurrences."""
    return (words.where(F.length("word") >= letters).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") >= times))


def _half(side: str, length) -> F.Column:
    part = F.substring(F.col("word"), F.lit(1), length) if side == "left" else F.right("word", length)
    return F.xxhash64(F.lit(side), part)


def _shards(words: DataFrame, shard_letters: int) -> DataFrame:
    """(shard, i, j, word, n, side): indexed words (side null) and searches."""
    m = F.length("word")
    total = words.agg(F.sum(m)).first()[0] or 0
    shards = max(1, -(-4 * total // shard_letters))
    shard = lambda key: F.pmod(key, F.lit(shards)).cast("int")

    def halves(side, shortest, longest):
        lengths = F.sequence(F.floor(shortest / 2).cast("int"), F.floor(longest / 2).cast("int"))
        return F.transform(lengths, lambda k: shard(_half(side, k)))

    # the halves of words one letter shorter, as long, or one letter longer
    keys = F.concat(halves("left", m - 1, m + 1), halves("right", m, m + 2))
    texts = words.select("word", "n", F.explode(F.array_distinct(keys)).alias("shard"), F.lit(None).cast("string").alias("side"))
    half = F.floor(m / 2).cast("int")
    searches = words.select("word", "n", F.explode(F.array(
        *[F.struct(shard(_half(s, k)).alias("shard"), F.lit(s).alias("side")) for s, k in (("left", half), ("right", m - half))])).alias("x")) \
        .select("word", "n", "x.shard", "x.side")
    rows = texts.unionByName(searches)
    tiles = lambda cond: F.greatest(F.lit(1), F.ceil(F.sum(F.when(cond, m).otherwise(0)) / (2 * shard_letters))).cast("int")
    sizes = materialize(rows.groupBy("shard").agg(tiles(F.col("side").isNull()).alias("a"), tiles(F.col("side").isNotNull()).alias("b")),
                        "variant-shards")
    spot = F.xxhash64("word")
    deal = lambda mine, n: F.when(mine, F.array(F.pmod(spot, F.col(n)).cast("int"))).otherwise(F.sequence(F.lit(0), F.col(n) - 1))
    text = F.col("side").isNull()
    return (rows.join(sizes, "shard").withColumn("i", F.explode(deal(text, "a")))
            .withColumn("j", F.explode(deal(~text, "b"))).drop("a", "b"))


def _search_shard(table: pa.Table) -> pa.Table:
    word, n, side = (table.column(c).to_pylist() for c in ("word", "n", "side"))
    texts = [(w, k) for w, k, s in zip(word, n, side) if s is None]
    searches = [(w, s) for w, s in zip(word, side) if s is not None]
    best: dict[str, list] = {}
    if texts and searches:
        for i, j in near_words([w for w, _ in texts], searches):
            w, (near, k) = searches[i][0], texts[j]
            got = best.setdefault(w, [0, k, near])
            got[0] += 1
            if (-k, near) < (-got[1], got[2]):
                got[1:] = k, near
    rows = [(w, *v) for w, v in best.items()]
    cols = list(zip(*rows)) or [()] * 4
    return pa.table([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.int64(), pa.string()))],
                    names=["word", "n_near", "near_n", "near"])


def group_variants(words: DataFrame, ratio: int = RATIO, shard_letters: int = SHARD_LETTERS) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word of a (word, n) table of
    distinct words: the most frequent near word, if ``ratio`` times as frequent,
    and the end of the chain of forms."""
    words = materialize(words.select("word", F.col("n").cast("bigint").alias("n")), "vocabulary")
    found = (_shards(words, shard_letters).groupBy("shard", "i", "j")
             .applyInArrow(_search_shard, "word string, n_near bigint, near_n bigint, near string")
             .groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("k"), "near")).alias("best")))
    form_n = -F.col("best.k")
    is_form = form_n >= ratio * F.col("n")
    forms = materialize(words.join(found, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("best.near")).alias("form"),
        F.when(is_form, form_n).alias("form_n")), "forms")
    # a form is more frequent than its word, so chains end; each round doubles the steps taken
    step = forms.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    while True:
        ahead = step.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        step = materialize(step.join(ahead, "root", "left").select(
            "word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")), "roots")
        if step.where("_moved").isEmpty():
            break
        step = step.drop("_moved")
    return forms.join(step.select("word", "root"), "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


def spelling_variants(docs: DataFrame, letters: int = LETTERS, times: int = TIMES, id_col: str = "doc_id",
                      text_col: str = "text", **kw) -> DataFrame:
    """Variants among the words of the texts as they are."""
    words = occurrences(docs, id_col, text_col).select(F.col("run").alias("word"))
    return group_variants(counted(words, letters, times), **kw)
