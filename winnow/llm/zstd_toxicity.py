"""Toxicity by compression distance with trained zstandard dictionaries.

A window of ``WINDOW`` bytes is compressed twice: with a dictionary trained on
ordinary text, and with the same dictionary preceded by one trained on toxic
text.  Common wording costs the same both ways; what only toxic text repeats is
cheaper the second time, so the margin (ordinary length - toxic length) is the
compression distance between the classes.  Strong match finding (LEVEL) keeps
the margin of ordinary windows at zero.  A text's margins (largest, mean of
three, mean, excess) go through a logistic threshold calibrated on labelled rows
that the dictionaries have not seen.

The toxic dictionary is trained on the contrasting wording of toxic samples:
words whose number of distinct contexts is, beyond sampling error, over twice
that in ordinary samples.  Contexts, not occurrences, are counted, so copies of
one text say nothing twice.

Fitting uses bounded samples (TOXIC and ORDINARY documents, at most CHARS
characters of each, at a hash-chosen place).  Scoring is one narrow pass over
whole texts with a model of a few kilobytes.

Defined results: null and empty text are scored like a text without evidence;
unlabelled and null-id rows are scored but not learned from; of rows that share
an id and a label the smallest sampled text is learned from; without both
classes among the training rows every score is their share of label 1 (0 when
there are none); an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import zstandard as zs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.llm.gru_langid import remainder

TOXIC, ORDINARY = 1500, 3000     # sampled documents a class
CHARS = 20_000                   # characters of a sampled document
WINDOW, STEP = 256, 240          # bytes
LEVEL = 13
DICT_TOXIC, DICT_ORDINARY = 2048, 4096


def windows(text: bytes) -> list[bytes]:
    return [text[i:i + WINDOW] for i in range(0, max(1, len(text) - WINDOW + STEP), STEP)]


# ------------------------------------------------------------------- training

def contexts(texts: list[bytes]) -> Counter:
    """word -> number of distinct words before it; key None: all pairs."""
    ids: dict[bytes, int] = {}
    pairs = []
    for t in texts:
        at = np.array([ids.setdefault(w, len(ids) + 1) for w in t.split()], np.uint64)
        pairs.append(np.unique((np.concatenate(([0], at[:-1])).astype(np.uint64) << np.uint64(32)) | at) if len(at) else at)
    every = np.unique(np.concatenate(pairs)) if pairs else np.empty(0, np.uint64)
    n = np.bincount((every & np.uint64(0xFFFFFFFF)).astype(np.int64), minlength=len(ids) + 1)
    return Counter({w: int(n[i]) for w, i in ids.items()} | {None: len(every)})


def contrast(toxic: list[bytes], ordinary: list[bytes]) -> set[bytes]:
    """Words with over twice the contexts in toxic text, three deviations sure."""
    a, b = contexts(toxic), contexts(ordinary)
    na, nb = max(1, a[None]), max(1, b[None])
    return {w for w, c in a.items() if w is not None
            and (c - 3 * math.sqrt(c)) / na > 2 * (b[w] + 3 * math.sqrt(b[w]) + 3) / nb}


def dictionary(size: int, samples: list[bytes]) -> bytes:
    """zstandard's trainer; raw content where it has too little to train on."""
    samples = [s for s in samples if len(s) >= 8]
    try:
        return zs.train_dictionary(size, samples).as_bytes()
    except zs.ZstdError:
        return b" ".join(dict.fromkeys(b" ".join(samples).split()))[:size]


def compressor(content: bytes) -> zs.ZstdCompressor:
    params = zs.ZstdCompressionParameters.from_level(LEVEL, source_size=WINDOW, dict_size=len(content), write_checksum=False,
                                                     write_content_size=False, write_dict_id=False)
    d = zs.ZstdCompressionDict(content.ljust(8), dict_type=zs.DICT_TYPE_RAWCONTENT)
    d.precompute_compress(compression_params=params)
    return zs.ZstdCompressor(compression_params=params, dict_data=d)


class Margins:
    """Window margins of a text under the two dictionaries."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        self.plain, self.both = compressor(ordinary), compressor(toxic + ordinary)

    def features(self, text: bytes) -> tuple[float, ...]:
        w = windows(text)
        m = np.sort([len(self.plain.compress(x)) - len(self.both.compress(x)) for x in w])[::-1].astype(float)
        return m[0], m[:3].mean(), m.mean(), np.maximum(m - 1, 0).sum() / math.sqrt(len(w)), math.log(len(w))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 30) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(centre, scale, weights): ridge logistic regression, classes balanced, Newton steps."""
    centre, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.c_[(x - centre) / scale, np.ones(len(x))]
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean())) / len(y)
    keep, w = ridge * np.eye(z.shape[1]), np.zeros(z.shape[1])
    keep[-1, -1] = 1e-6
    for _ in range(rounds):
        p = sigmoid(z @ w)
        step = np.linalg.solve((z * (weight * p * (1 - p))[:, None]).T @ z + keep, z.T @ (weight * (p - y)) + keep @ w)
        w -= step * min(1.0, 5 / (np.abs(step).max() + 1e-9))
    return centre, scale, w


def sigmoid(v: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(v, -40, 40)))


def train(rows: list[tuple[bytes, int]]) -> dict:
    """Model from (text, label): two of three rows train the dictionaries, the
    third calibrates."""
    y_all = np.array([y for _, y in rows])
    model = {"base": float(y_all.mean()) if len(rows) else 0.0, "margins": None}
    learn = [r for i, r in enumerate(rows) if i % 3] or rows
    hold = [r for i, r in enumerate(rows) if i % 3 == 0]
    toxic, ordinary = [t for t, y in learn if y], [t for t, y in learn if not y]
    y = np.array([y for _, y in hold])
    if not toxic or not ordinary or len(set(y.tolist())) < 2:
        return model
    words = contrast(toxic, ordinary)
    content = dictionary(DICT_TOXIC, [b" ".join(w for w in t.split() if w in words) for t in toxic])
    every = [w for t in ordinary for w in windows(t)]
    plain = dictionary(DICT_ORDINARY, every[:: max(1, len(every) // 20_000)])
    margins = Margins(content, plain)
    model["fit"] = logistic(np.array([margins.features(t) for t, _ in hold]), y)
    model["margins"] = (content, plain)
    return model


# ------------------------------------------------------------------ operators

def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> dict:
    """Train on labelled rows whose id remainder (crc32 mod 5) is not 0."""
    d, k = docs.select(F.col(id_col).cast("bigint").alias("k"), F.col(text_col).cast("string").alias("t")), F.col("k")
    marks = (labels.select(F.col(id_col).cast("bigint").alias("k"), F.col(label_col).cast("int").alias("y"))
             .where(F.col("y").isin(0, 1) & (remainder(k, 5) != 0)))
    counts = {r["y"]: r["n"] for r in marks.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.when(F.col("y") == 1, min(1.0, 1.2 * TOXIC / max(1, counts.get(1, 0)))).otherwise(
        min(1.0, 1.2 * ORDINARY / max(1, counts.get(0, 0))))
    draw = F.xxhash64(F.lit("toxicity"), k)
    chosen = marks.where(F.pmod(draw, F.lit(1_000_000)) < share * 1_000_000)
    chosen = chosen.where("y = 1").orderBy(draw, "k").limit(TOXIC).unionByName(
        chosen.where("y = 0").orderBy(draw, "k").limit(ORDINARY))
    place = F.pmod(F.xxhash64(F.lit("place"), k), F.greatest(F.lit(1), F.length("t") - CHARS + 1)).cast("int") + 1
    rows = (d.where(F.col("t").isNotNull()).join(F.broadcast(chosen), "k")  # at most TOXIC + ORDINARY rows
            .select(F.substring("t", place, F.lit(CHARS)).alias("t"), "y", draw.alias("o"), "k")
            .groupBy("k", "y", "o").agg(F.min("t").alias("t")).collect())  # one text an id, however often it repeats
    rows.sort(key=lambda r: (r["o"], r["k"], r["t"]))
    return train([(r["t"].encode(), r["y"]) for r in rows[:TOXIC + ORDINARY]])


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    def run(batches):
        margins = Margins(*model["margins"]) if model["margins"] else None
        for b in batches:
            texts = [t or b"" for t in b.column("text").cast(pa.binary()).to_pylist()]
            p = np.full(len(texts), model["base"])
            if margins and texts:
                centre, scale, w = model["fit"]
                z = (np.array([margins.features(t) for t in texts]) - centre) / scale
                p = sigmoid(z @ w[:-1] + w[-1])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(p, pa.float64()),
                                              pa.array((p >= 0.5).astype(np.int32))],
                                             names=["doc_id", "held_out", "score", "predicted"])

    key = F.col(id_col).cast("bigint")
    held = F.coalesce(remainder(key, 5) == 0, F.lit(False))
    return (docs.select(key.alias("doc_id"), held.alias("held_out"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, "doc_id bigint, held_out boolean, score double, predicted int"))


def toxicity(docs: DataFrame, labels: DataFrame, **cols) -> DataFrame:
    return score(docs, fit(docs, labels, **cols), **{k: v for k, v in cols.items() if k != "label_col"})
