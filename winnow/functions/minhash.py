"""MinHash signatures and LSH banding as Spark expressions.

Hash family (ours, chosen so DuckDB can recompute it exactly):
    base(s)  = first 32 bits of md5(utf8(s)) mod P
    sig_i    = min over the shingle set of (a_i * base + b_i) mod P
with P = 2^31 - 1 and (a_i, b_i) drawn by a fixed integer rule below.
a_i * base < 2^62, so all arithmetic fits in a signed 64-bit integer.

The signature is computed per row (a document's shingles come from one
row), so no shuffle is needed until the LSH bucket join.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from winnow.functions.text import COPULA_ENDING, _jamo_slice, collapse_ws, text_slices

MERSENNE_P = 2147483647
NUM_PERM = 128
DEFAULT_BANDS, DEFAULT_ROWS = 9, 13  # optimum of 0.5*FP + 0.5*FN at threshold 0.8, 128 perms
PERM_SEED = 20240601
SLICE_VALUES = 1 << 16  # hashes per numpy slice
ELEMENT_SLICE = 1 << 18  # bytes of text whose elements are made together: their arrays stay in cache
BLOCK = 512             # values whose residues of all permutations are computed together: they stay in cache


def perm_constants(num_perm: int = NUM_PERM, seed: int = PERM_SEED) -> list[tuple[int, int]]:
    """(a_i, b_i) pairs from a splitmix64 stream: a in [1, P), b in [0, P)."""
    out = []
    x = seed & 0xFFFFFFFFFFFFFFFF

    def nxt():
        nonlocal x
        x = (x + 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF
        z = x
        z = ((z ^ (z >> 30)) * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF
        z = ((z ^ (z >> 27)) * 0x94D049BB133111EB) & 0xFFFFFFFFFFFFFFFF
        return z ^ (z >> 31)

    for _ in range(num_perm):
        a = 1 + nxt() % (MERSENNE_P - 1)
        b = nxt() % MERSENNE_P
        out.append((a, b))
    return out


def optimal_bands(threshold: float = 0.8, num_perm: int = NUM_PERM, fp_weight: float = 0.5,
                  fn_weight: float = 0.5, steps: int = 1000) -> tuple[int, int]:
    """(bands, rows) with bands*rows <= num_perm minimising the weighted
    false-positive and false-negative areas under the banding S-curve
    1 - (1 - s^r)^b (trapezoid integration over s)."""
    def area(f, lo, hi):
        if hi <= lo:
            return 0.0
        h = (hi - lo) / steps
        ys = [f(lo + i * h) for i in range(steps + 1)]
        return h * (sum(ys) - (ys[0] + ys[-1]) / 2)

    best, best_err = (1, num_perm), float("inf")
    for b in range(1, num_perm + 1):
        for r in range(1, num_perm // b + 1):
            fp = area(lambda s: 1 - (1 - s ** r) ** b, 0.0, threshold)
            fn = area(lambda s: (1 - s ** r) ** b, threshold, 1.0)
            err = fp_weight * fp + fn_weight * fn
            if err < best_err:
                best, best_err = (b, r), err
    return best


def base_hash_expr(c) -> Column:
    """Spark form of base(s) (used for checks; the signature UDF uses hashlib)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.conv(F.substring(F.md5(col), 1, 8), 16, 10).cast("bigint") % F.lit(MERSENNE_P)


def _signature_fn(num_perm: int, seed: int):
    consts = np.array(perm_constants(num_perm, seed), dtype=np.int64)
    a_s, b_s = consts[:, 0], consts[:, 1]

    def table(vals: np.ndarray) -> np.ndarray:
        """(values, num_perm): (a*h + b) mod (2^31 - 1) of every value, by Mersenne
        folding instead of '%': two folds bring x < 2^63 into [0, P + 2], one
        conditional subtraction gives the exact residue."""
        out = np.empty((vals.size, num_perm), np.uint32)
        for lo in range(0, vals.size, BLOCK):
            v = vals[lo:lo + BLOCK, None] * a_s
            v += b_s
            for _ in range(2):
                t = v >> 31
                v &= MERSENNE_P
                v += t
            # v is now in [0, P + 2]: min(v, v - P) as unsigned picks v - P
            # exactly when v >= P (otherwise v - P wraps to a huge value)
            np.subtract(v, MERSENNE_P, out=t)
            out[lo:lo + BLOCK] = np.minimum(v.view(np.uint64), t.view(np.uint64))
        return out

    def sign_slice(vals: np.ndarray, starts: np.ndarray, out: np.ndarray) -> None:
        """Documents share many grams: a value's residues are computed once a slice."""
        out[:] = MERSENNE_P
        for at in range(0, vals.size, SLICE_VALUES):  # more than one piece only of a single, long document
            distinct, inverse = np.unique(vals[at:at + SLICE_VALUES], return_inverse=True)
            residues = table(distinct)
            ends = np.append(starts[1:], vals.size) if at == 0 and vals.size <= SLICE_VALUES else [inverse.size]
            for i, (lo, hi) in enumerate(zip(starts, ends)):
                for k in range(lo, hi, BLOCK):
                    np.minimum(out[i], residues[inverse[k:min(hi, k + BLOCK)]].min(axis=0), out=out[i])

    def sign(hashes: pa.Array) -> pa.Array:
        """Whole Arrow batch, in slices of at most SLICE_VALUES hashes (or one
        longer document, in pieces), so temporaries stay bounded whatever the
        batch holds."""
        if isinstance(hashes, pa.ChunkedArray):
            hashes = hashes.combine_chunks()
        n = len(hashes)
        offs = hashes.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
        offs = offs - offs[0]
        lens = np.diff(offs)
        vals = hashes.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        nonempty = lens > 0
        out = np.zeros((n, num_perm), dtype=np.int64)
        rows = np.flatnonzero(nonempty)
        lo = 0
        while lo < rows.size:
            hi = lo + 1
            budget = offs[rows[lo]] + SLICE_VALUES
            # extend the slice while it stays within the value budget
            hi = max(hi, int(np.searchsorted(offs[rows + 1], budget, side="right")))
            hi = min(hi, rows.size)
            r = rows[lo:hi]
            base = offs[r[0]]
            seg = vals[base:offs[r[-1] + 1]]
            part = np.empty((r.size, num_perm), dtype=np.int64)
            sign_slice(seg, offs[r] - base, part)
            out[r] = part
            lo = hi
        flat = pa.array(out.ravel(), type=pa.int64())
        offsets = pa.array(np.arange(0, (n + 1) * num_perm, num_perm, dtype=np.int32))
        valid = pa.array(nonempty & hashes.is_valid().to_numpy(zero_copy_only=False))
        return pa.ListArray.from_arrays(offsets, flat, mask=pa.compute.invert(valid))

    return sign


_SIGNERS: dict = {}


def _hashed(grams: list[bytes]) -> np.ndarray:
    """base(s) of every gram."""
    raw = b"".join([hashlib.md5(g, usedforsecurity=False).digest()[:4] for g in grams])
    return np.frombuffer(raw, ">u4").astype(np.int64) % MERSENNE_P


def _hashed_wide(grams: list[bytes]) -> np.ndarray:
    """64 bits of every gram: elements of exact joins."""
    return np.frombuffer(b"".join([hashlib.md5(g, usedforsecurity=False).digest()[:8] for g in grams]), ">i8").astype(np.int64)


def _word_grams(low: str, word_n: int) -> list[str]:
    toks = low.split(" ")
    if len(toks) == 4 and toks[-1].endswith(COPULA_ENDING):
        toks.append(toks[-1])
    return [" ".join(toks[k:k + word_n]) for k in range(max(1, len(toks) - word_n + 1))]


def gram_hashes(texts: list[str], lows: list[str], word_n: int, char_n: int, distinct: bool = True, hashed=_hashed) -> pa.ListArray:
    """Hashes of every document's grams: the word windows of its lower-cased text
    (``word_ngrams``) and the character windows of its text (``char_ngrams``); a
    length of 0 leaves a kind out.  ``distinct``: the set of both, else with
    repeats.  A window that many documents share is hashed once."""
    lens = np.fromiter((len(t) for t in texts), np.int64, len(texts))
    grams, rows = [], []
    for i, (t, low) in enumerate(zip(texts, lows)):
        own = []
        if word_n:
            own = _word_grams(low, word_n)
            if distinct and char_n == 3:
                own = [g for g in own if len(g) != 3 or g not in t]  # a character window too
        if char_n and len(t) < char_n:
            own.append(t)
        elif char_n and char_n != 3:
            own += [t[k:k + char_n] for k in range(len(t) - char_n + 1)]
        if distinct:
            own = set(own)
        grams += [g.encode() for g in own]
        rows.append(len(own))
    values, at = [hashed(grams)], [np.repeat(np.arange(len(texts)), rows)]
    if char_n == 3 and len(cp := np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.int64)) > 2:
        row = np.repeat(np.arange(len(texts)), lens)
        inside = row[:-2] == row[2:]
        keys, which = np.unique((cp[:-2] << 42 | cp[1:-1] << 21 | cp[2:])[inside], return_inverse=True)
        if len(keys):
            chars = np.stack([keys >> 42, keys >> 21 & 0x1FFFFF, keys & 0x1FFFFF], axis=1).astype("<u4").tobytes().decode("utf-32-le")
            pair = row[:-2][inside] * len(keys) + which
            if distinct:
                pair = np.unique(pair)
            values.append(hashed([chars[k:k + 3].encode() for k in range(0, len(chars), 3)])[pair % len(keys)])
            at.append(pair // len(keys))
    row = np.concatenate(at)
    ends = np.append(0, np.cumsum(np.bincount(row, minlength=len(texts))))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(values)[np.argsort(row, kind="stable")], pa.int64()))


def lowered(text: Column) -> Column:
    """The form of a preprocessed text that its word grams are taken from."""
    return collapse_ws(F.lower(text))


def _of_grams(kind: tuple, finish, typ, text: Column, word_n: int, char_n: int, **how) -> Column:
    """``finish`` of the gram hashes of a preprocessed text, slice by slice:
    the array of a text's grams is never built."""
    key = (*kind, word_n, char_n)
    if key not in _SIGNERS:
        def run(texts: pa.Array, lows: pa.Array) -> pa.Array:
            out, lo = [finish(pa.array([], pa.list_(pa.int64())))], 0
            for part in text_slices(texts):
                low, lo = lows.slice(lo, len(part)).to_pylist(), lo + len(part)
                out.append(finish(gram_hashes(_jamo_slice(part).to_pylist() if char_n else part.to_pylist(), low, word_n, char_n, **how)))
            return pa.concat_arrays(out)

        _SIGNERS[key] = F.arrow_udf(run, typ)
    return _SIGNERS[key](text, lowered(text))


def text_signature(text: Column, word_n: int, char_n: int, num_perm: int = NUM_PERM, seed: int = PERM_SEED) -> Column:
    """Signature of a preprocessed text's shingle set (see ``gram_hashes``): the
    one of ``minhash_signature`` over its shingles, without the array of them."""
    return _of_grams(("signature", num_perm, seed), _signature_fn(num_perm, seed), ArrayType(LongType()), text, word_n, char_n)


def _totals(hashes: pa.Array) -> pa.Array:
    offs = hashes.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    sums = np.append(0, np.cumsum(hashes.values.to_numpy(zero_copy_only=False)))
    return pa.StructArray.from_arrays([pa.array(np.diff(offs), pa.int64()), pa.array(np.diff(sums[offs]), pa.int64())], names=["n", "hash_sum"])


def text_totals(text: Column, word_n: int, char_n: int, distinct: bool = True) -> Column:
    """struct<n, hash_sum>: number and sum of the base hashes of a preprocessed
    text's grams."""
    return _of_grams(("totals", distinct), _totals, "struct<n:bigint,hash_sum:bigint>", text, word_n, char_n, distinct=distinct)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit, in place."""
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(31)
    return x


BASE = 0x9E3779B97F4A7C15   # odd: has an inverse modulo 2^64
LONG_WORD = 64              # bytes; the sum below tells short words apart, longer ones get another hash
_BYTES = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _word_hashes(text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64 bits of every word text[start:end]: the sum of its bytes' numbers times
    powers of BASE, from differences of running sums."""
    n = len(text) + 1
    if n > len(_POWERS[0]):
        _POWERS[:] = _powers(BASE, n), _powers(pow(BASE, -1, 1 << 64), n)
    sums = np.zeros(n, np.uint64)
    np.cumsum(_BYTES[text] * _POWERS[0][:n - 1], out=sums[1:])
    out = _mixed((sums[ends] - sums[starts]) * _POWERS[1][starts])
    if len(long := np.flatnonzero(ends - starts > LONG_WORD)):
        out[long] = _hashed_wide([text[starts[i]:ends[i]].tobytes() for i in long]).view(np.uint64)
    return out


_POWERS = [np.ones(0, np.uint64)] * 2


def _run_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """64 bits of every run of n words, given the words' hashes."""
    out = np.full(max(0, len(words) - n + 1), n, np.uint64)
    for k in range(n):
        out ^= words[k:k + len(out)]
        out *= np.uint64(BASE)
        out ^= out >> np.uint64(32)
    return out


def _threes(chars: np.ndarray) -> np.ndarray:
    """Every three code points in a row as one word."""
    return _mixed(chars[:-2] << np.uint64(42) | chars[1:-1] << np.uint64(21) | chars[2:])


def _code_points(text: bytes) -> np.ndarray:
    return np.frombuffer(text.decode().encode("utf-32-le"), np.uint32).astype(np.uint64)


def _element(gram: str) -> np.ndarray:
    """The element of one gram: three characters as a character window, any other
    text by its words."""
    if len(gram) == 3:
        return _threes(_code_points(gram.encode()))
    words = [w.encode() for w in gram.split(" ")]
    ends = np.cumsum([len(w) for w in words])
    return _run_hashes(_word_hashes(np.frombuffer(b"".join(words), np.uint8), np.append(0, ends[:-1]), ends), len(words))


def _utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a run of texts without nulls."""
    offs = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    return np.frombuffer(data, np.uint8)[offs[0]:offs[-1]] if data else np.zeros(0, np.uint8), offs - offs[0]


def gram_elements(texts: pa.Array, lows: pa.Array, word_n: int, char_n: int) -> pa.ListArray:
    """Every document's shingle set as distinct 64-bit hashes: the grams of
    ``gram_hashes``, those of windows of three characters and three words or more
    by array arithmetic.  A run of words is hashed from its words' hashes, and
    three characters are a number as they are."""
    if char_n != 3 or word_n < 3:
        return gram_hashes(texts.to_pylist(), lows.to_pylist(), word_n, char_n, hashed=_hashed_wide)
    threes = _threes(np.append(_code_points(_utf8(texts)[0].tobytes()), np.zeros(2, np.uint64)))
    ends = np.cumsum(pa.compute.utf8_length(texts).to_numpy()).tolist()
    low, offs = _utf8(lows)
    spaces = np.flatnonzero(low == 32)
    runs = _run_hashes(_word_hashes(low, np.sort(np.append(spaces + 1, offs[:-1])), np.sort(np.append(spaces, offs[1:]))), word_n)
    stops = (np.searchsorted(spaces, offs[1:]) + np.arange(1, len(offs))).tolist()
    flat, starts, at, a, b = np.empty(len(threes) + len(runs) + 2 * len(texts), np.uint64), [], 0, 0, 0
    for i, (end, stop) in enumerate(zip(ends, stops)):
        few = end - a < 3 or stop - b < max(word_n, 5)  # the rules for few characters and words
        if few:
            grams = _word_grams(lows[i].as_py(), word_n) + ([texts[i].as_py()] if end - a < 3 else [])
            own = [threes[a:max(a, end - 2)], *map(_element, grams)]
        else:
            own = [threes[a:end - 2], runs[b:stop - word_n + 1]]
        starts.append(at)
        for x in own:
            flat[at:at + len(x)] = x
            at += len(x)
        flat[starts[-1]:at].view(np.int64).sort()
        a, b = end, stop
    flat = flat[:at]
    new = np.append(True, flat[1:] != flat[:-1])[:at]
    new[starts] = True
    offsets = np.append(0, np.cumsum(new))[np.append(np.array(starts, np.int64), at)]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat[new].view(np.int64)))


def text_element_slices(texts: pa.Array, lows: pa.Array, word_n: int, char_n: int):
    """The shingle sets of a batch of preprocessed texts and their lower-cased
    forms, slice by slice: (first row, sets)."""
    lo = 0
    for part in text_slices(texts, ELEMENT_SLICE):
        yield lo, gram_elements(_jamo_slice(part) if char_n else part, lows.slice(lo, len(part)), word_n, char_n)
        lo += len(part)


def text_elements(text: Column, word_n: int, char_n: int) -> Column:
    """The shingle set of a preprocessed text as 64-bit hashes."""
    key = ("elements", word_n, char_n)
    if key not in _SIGNERS:
        def run(texts: pa.Array, lows: pa.Array) -> pa.Array:
            return pa.concat_arrays([pa.array([], pa.list_(pa.int64())), *(s for _, s in text_element_slices(texts, lows, word_n, char_n))])

        _SIGNERS[key] = F.arrow_udf(run, ArrayType(LongType()))
    return _SIGNERS[key](text, lowered(text))


def shingle_hashes(shingles) -> Column:
    """array<string> -> array<bigint> of base hashes, computed in the JVM."""
    col = F.col(shingles) if isinstance(shingles, str) else shingles
    return F.transform(col, base_hash_expr)


def minhash_signature(shingles, num_perm: int = NUM_PERM, seed: int = PERM_SEED) -> Column:
    """array<string> shingle set -> array<bigint> signature.  Base hashes are
    JVM expressions; the min over the affine family is an Arrow UDF that
    works on whole batches with numpy (no per-shingle Python)."""
    key = (num_perm, seed)
    if key not in _SIGNERS:
        _SIGNERS[key] = F.arrow_udf(_signature_fn(num_perm, seed), ArrayType(LongType()))
    return _SIGNERS[key](shingle_hashes(shingles))


def band_keys(sig, bands: int = DEFAULT_BANDS, rows: int = DEFAULT_ROWS) -> Column:
    """array<struct<band:int, k1:bigint, k2:bigint>>: one 128-bit key per band.

    Two differently seeded 64-bit hashes of the band's values; a false
    bucket needs both to collide (probability ~2^-128 per pair)."""
    col = F.col(sig) if isinstance(sig, str) else sig
    items = []
    for i in range(bands):
        part = F.slice(col, i * rows + 1, rows)
        items.append(F.struct(F.lit(i).alias("band"),
                              F.xxhash64(F.lit(i), part).alias("k1"),
                              F.xxhash64(part, F.lit(-1 - i)).alias("k2")))
    return F.array(*items)


def band_strings(sig, bands: int = DEFAULT_BANDS, rows: int = DEFAULT_ROWS) -> Column:
    """array<struct<band:int, key:string>>: readable band keys (comma-joined values)."""
    col = F.col(sig) if isinstance(sig, str) else sig
    return F.array(*[F.struct(F.lit(i).alias("band"),
                              F.array_join(F.slice(col, i * rows + 1, rows).cast("array<string>"), ",").alias("key"))
                     for i in range(bands)])


def estimate_jaccard(a, b) -> Column:
    """Share of equal positions; different lengths raise; empty -> 0.0."""
    ca = F.col(a) if isinstance(a, str) else a
    cb = F.col(b) if isinstance(b, str) else b
    eq = F.aggregate(F.zip_with(ca, cb, lambda x, y: F.when(x == y, 1).otherwise(0)), F.lit(0), lambda acc, v: acc + v)
    return (F.when(F.size(ca) != F.size(cb), F.raise_error(F.lit("signatures must have the same number of permutations")))
            .when(F.size(ca) == 0, F.lit(0.0))
            .otherwise(eq / F.size(ca)))


def jaccard(a, b) -> Column:
    """Exact Jaccard of two arrays taken as sets; both empty -> 1.0."""
    ca = F.col(a) if isinstance(a, str) else a
    cb = F.col(b) if isinstance(b, str) else b
    inter = F.size(F.array_intersect(ca, cb))
    union = F.size(F.array_union(ca, cb))
    return F.when(union == 0, F.lit(1.0)).otherwise(inter / union)


def perm_values_sql(num_perm: int = NUM_PERM, seed: int = PERM_SEED) -> str:
    """VALUES list (i, a, b) for oracle SQL."""
    return ", ".join(f"({i}, {a}, {b})" for i, (a, b) in enumerate(perm_constants(num_perm, seed)))
