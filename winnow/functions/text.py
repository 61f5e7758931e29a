"""Text column functions: normalization, script tests, n-gram shingles.

All of these are Spark column expressions except two Arrow helpers with no
Spark SQL built-in: preprocessing (NFKC and white space) and Hangul
syllable decomposition (numpy over the batch's code points; batches without
Hangul pass through untouched).
"""

from __future__ import annotations

import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Python's str.split() whitespace set, in Java regex form: (?U)\s is the
# Unicode White_Space property; U+001C..U+001F are also split on by Python.
WS_RUN = r"(?U)[\s\x1c-\x1f]+"
WS_CHARS = "".join(map(chr, [*range(9, 14), *range(0x1c, 0x21), 0x85, 0xa0, 0x1680, *range(0x2000, 0x200b), 0x2028, 0x2029, 0x202f, 0x205f, 0x3000]))

# Hangul script ranges tested by the Korean-content check.
KOREAN_CLASS = "[가-힯ᄀ-ᇿ㄰-㆏]"
# Precomposed Hangul syllables U+AC00..U+D7A3 and the
# conjoining jamo they decompose into (leads from U+1100, vowels from
# U+1161, tails from U+11A8; syllable index = 588*lead + 28*vowel + tail).
HANGUL_SYLLABLE_CLASS = "[가-힣]"
HANGUL_FIRST = 0xAC00
N_LEAD, N_VOWEL, N_TAIL = 19, 21, 28


def _preprocess_batch(texts: pa.Array) -> pa.Array:
    """NFKC and white-space collapse of one Arrow batch.  ASCII and already
    normal rows skip the normalization."""
    out = []
    for s in texts.to_pylist():
        if s is not None and not s.isascii() and not unicodedata.is_normalized("NFKC", s):
            s = unicodedata.normalize("NFKC", s)
        out.append(None if s is None else " ".join(s.split()))
    return pa.array(out, type=pa.string())


# Declared nondeterministic though it is not: the optimizer then neither pushes
# filters on its result below an exchange nor inlines it into each use, so the
# text is processed once per row.
_preprocess = F.arrow_udf(_preprocess_batch, StringType()).asNondeterministic()


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def collapse_ws(c) -> Column:
    """``' '.join(s.split())``: whitespace runs to one space, ends trimmed."""
    return F.trim(F.regexp_replace(_c(c), WS_RUN, " "))


def strip_ws(c) -> Column:
    """Python ``str.strip()``."""
    return F.btrim(_c(c), F.lit(WS_CHARS))


def preprocess(c) -> Column:
    """NFKC, collapse whitespace, strip (shared by normalize and shingling):
    one helper call, one pass over the text."""
    return _preprocess(_c(c))


def contains_korean(c) -> Column:
    return F.coalesce(_c(c).rlike(KOREAN_CLASS), F.lit(False))


SLICE_BYTES = 1 << 20  # text of one slice: the arrays of a slice take some 50 times as much


def text_slices(texts: pa.Array, size: int = SLICE_BYTES):
    """The batch in runs of rows of about ``size`` bytes of text (a longer row alone)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + size, side="right")))
        yield texts.slice(lo, hi - lo)
        lo = hi


def _jamo_batch(texts: pa.Array) -> pa.Array:
    """Syllable decomposition of one Arrow batch, slice by slice."""
    parts = [_jamo_slice(s) for s in text_slices(texts)]
    return pa.concat_arrays(parts) if parts else pa.array([], pa.string())


def _jamo_slice(texts: pa.Array) -> pa.Array:
    """Vectorized syllable decomposition: code points as a numpy array, each
    Hangul syllable expanded to 2-3 jamo by index arithmetic, one decode for
    the whole slice.  Slices without Hangul are returned untouched."""
    has = pc.match_substring_regex(texts, HANGUL_SYLLABLE_CLASS)
    if not pc.any(has).as_py():
        return texts
    rows = texts.to_pylist()
    hit = [i for i, (r, h) in enumerate(zip(rows, has.to_pylist())) if h]
    parts = [rows[i] for i in hit]
    lens = np.fromiter((len(t) for t in parts), dtype=np.int64, count=len(parts))
    cp = np.frombuffer("".join(parts).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
    is_h = (cp >= HANGUL_FIRST) & (cp <= HANGUL_FIRST + N_LEAD * N_VOWEL * N_TAIL - 1)
    idx = cp - HANGUL_FIRST
    tail = np.where(is_h, idx % N_TAIL, 0)
    width = np.where(is_h, np.where(tail > 0, 3, 2), 1)
    start = np.cumsum(width) - width
    out = np.empty(int(width.sum()), dtype=np.uint32)
    out[start] = np.where(is_h, 0x1100 + idx // (N_VOWEL * N_TAIL), cp)
    out[start[is_h] + 1] = 0x1161 + (idx[is_h] % (N_VOWEL * N_TAIL)) // N_TAIL
    t = is_h & (tail > 0)
    out[start[t] + 2] = 0x11A7 + tail[t]
    row_end = np.cumsum(lens)
    new_len = np.diff(np.concatenate([[0], np.cumsum(width)[row_end - 1] if len(width) else np.zeros(0, np.int64)]))
    whole = out.tobytes().decode("utf-32-le")
    pos = 0
    for k, i in enumerate(hit):
        n = int(new_len[k])
        rows[i] = whole[pos:pos + n]
        pos += n
    return pa.array(rows, type=pa.string())


_jamo = F.arrow_udf(_jamo_batch, StringType())


def hangul_to_jamo(c) -> Column:
    """Split every precomposed Hangul syllable into lead, vowel and (when
    present) tail jamo; every other character is kept unchanged.  Only rows
    that contain Hangul are shipped to the helper (others send a null), so
    text in other scripts never leaves the JVM."""
    col = _c(c)
    return F.coalesce(_jamo(F.when(col.rlike(HANGUL_SYLLABLE_CLASS), col)), col)


def char_ngrams(c, n: int = 3) -> Column:
    """All length-n character windows (code points); text shorter than n
    gives one gram of the whole text."""
    col = _c(c)
    grams = F.regexp_extract_all(col, F.lit(f"(?s)(?=(.{{{n}}})).") , F.lit(1))
    return F.when(F.length(col) < n, F.array(col)).otherwise(grams)


def jamo_ngrams(c, n: int = 3) -> Column:
    return char_ngrams(hangul_to_jamo(c), n)


def word_tokens(c) -> Column:
    """``s.lower().split()`` as an array (empty text -> [''])."""
    return F.split(collapse_ws(F.lower(_c(c))), " ")


def word_ngrams(c, n: int = 5) -> Column:
    """Word n-grams of ``s.lower().split()``.  Fixed rule of the reference:
    exactly four tokens whose last ends with the Korean copula ending
    (fixed value below) get the last token repeated; fewer than n tokens
    give one gram of all tokens."""
    low = collapse_ws(F.lower(_c(c)))
    toks = F.split(low, " ")
    last = F.element_at(toks, -1)
    quirk = (F.size(toks) == 4) & last.endswith(COPULA_ENDING)
    low2 = F.when(quirk, F.concat(low, F.lit(" "), last)).otherwise(low)
    ntok = F.size(toks) + F.when(quirk, 1).otherwise(0)
    pat = f"(?<=^| )(?=([^ ]+(?: [^ ]+){{{n - 1}}}))"  # not behind half a surrogate pair
    grams = F.regexp_extract_all(low2, F.lit(pat), F.lit(1))
    return F.when(ntok < n, F.array(low2)).otherwise(grams)


# Fixed value: the ending that triggers the four-token repeat rule.
COPULA_ENDING = "입니다"

# Fixed value: emoji / symbol classes removed by the optional emoji filter.
EMOJI_CLASS = r"[\p{So}\p{Cs}]"


def strip_emoji(c) -> Column:
    return F.regexp_replace(_c(c), EMOJI_CLASS, "")
