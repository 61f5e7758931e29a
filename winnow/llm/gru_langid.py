"""Language identification with a bidirectional gated recurrent network over bytes.

Two recurrent passes (left to right, right to left) read windows of ``SPAN``
bytes; each position's two states give it a distribution over languages, and a
document's probabilities are the mean over all its positions.  The unit has one
gate for reset and update (a minimal gated unit), with a hard sigmoid and
softsign, so a byte costs few numpy operations.  It is trained here, in numpy,
by backpropagation through time with Adam on a bounded, documented sample:
``PER_LANG`` windows a language (fewer if there are over 128), at hash-chosen
places of hash-chosen documents that are not held out.  Every label is learned.  Every byte of every text is read when predicting.

Scale: fitting reads (id, lang) and the chosen rows; predicting is one narrow
pass with a model of a few kilobytes.

Defined results: null text or text without a letter is ``und`` with score 0;
null doc_id is neither held out nor learned from; without labelled rows all are
``und``; an empty table gives no rows; other columns are never read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnow.llm.common import lean, map_rows, replaced

SPAN = 128         # bytes of a window
HIDDEN = 8         # states a direction
PER_LANG = 1200    # training windows a language (bound of the sample)
WINDOWS = 128 * PER_LANG  # of all languages together; many languages get fewer each, but LEAST
LEAST = 64
EPOCHS = 12
BLOCK = 2048       # windows run together
LETTER = re.compile(r"[^\W\d_]")
UND = "und"


# -------------------------------------------------------------------- network

def init(langs: int, seed: int = 3) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    f = lambda *s, k=1.0: (rng.standard_normal(s) * k).astype(np.float32)
    p = {"out": f(langs, 2 * HIDDEN, k=0.3), "bias": np.zeros((langs, 1), np.float32)}
    for d in "fb":
        p["in_" + d] = f(2 * HIDDEN, 256, k=0.7)
        p["rec_" + d] = f(2 * HIDDEN, HIDDEN, k=0.4)
    return p


def _step(p: dict, d: str, x: np.ndarray, h: np.ndarray) -> tuple:
    """One position of one direction: gate, candidate, new state."""
    g = np.take(p["in_" + d], x, axis=1, mode="clip")
    r = p["rec_" + d] @ h
    gate = g[:HIDDEN] + r[:HIDDEN]
    gate *= 0.25
    gate += 0.5
    np.clip(gate, 0, 1, out=gate)
    a = gate * r[HIDDEN:]
    a += g[HIDDEN:]
    cand = a / (1 + np.abs(a))
    return gate, a, cand, r[HIDDEN:], h + gate * (cand - h)


def states(p: dict, d: str, x: np.ndarray) -> np.ndarray:
    """(T, H, B) states of one direction over x (T, B)."""
    t_all, b = x.shape
    out, h = np.empty((t_all, HIDDEN, b), np.float32), np.zeros((HIDDEN, b), np.float32)
    for t in range(t_all) if d == "f" else range(t_all - 1, -1, -1):
        h = out[t] = _step(p, d, x[t], h)[4]
    return out


def pooled(p: dict, x: np.ndarray, length: np.ndarray) -> np.ndarray:
    """(B, L): each window's label probabilities summed over its positions."""
    fwd, bwd = states(p, "f", x), states(p, "b", x)
    total = np.zeros((p["bias"].shape[0], x.shape[1]), np.float32)
    wf, wb = p["out"][:, :HIDDEN], p["out"][:, HIDDEN:]
    for t in range(x.shape[0]):
        z = wf @ fwd[t]
        z += wb @ bwd[t]
        z += p["bias"]
        z -= z.max(axis=0)
        np.exp(z, out=z)
        z *= (t < length) / z.sum(axis=0)
        total += z
    return total.T


def gradients(p: dict, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, dict]:
    """Mean loss over all positions and its gradients, through time."""
    t_all, b = x.shape
    hs = {d: states(p, d, x) for d in "fb"}
    both = np.concatenate([hs["f"], hs["b"]], axis=1)
    z = np.matmul(p["out"], both) + p["bias"]
    z = np.exp(z - z.max(axis=1, keepdims=True))
    prob = z / z.sum(axis=1, keepdims=True)
    loss = float((-np.log(prob[:, y, np.arange(b)] + 1e-9) * weight).mean())
    prob[:, y, np.arange(b)] -= 1
    dz = prob * weight / (t_all * b)
    grad = {"out": np.einsum("tlb,thb->lh", dz, both, optimize=True), "bias": dz.sum(axis=(0, 2))[:, None]}
    dstate = np.matmul(p["out"].T, dz)
    for k, d in enumerate("fb"):
        dh_in, h_all = dstate[:, k * HIDDEN:(k + 1) * HIDDEN], hs[d]
        rec, drec = p["rec_" + d], np.zeros_like(p["rec_" + d])
        dg_all = np.empty((t_all, 2 * HIDDEN, b), np.float32)
        dh, order = np.zeros((HIDDEN, b), np.float32), list(range(t_all) if d == "f" else range(t_all - 1, -1, -1))
        for i in range(t_all - 1, -1, -1):
            t = order[i]
            prev = h_all[order[i - 1]] if i else np.zeros((HIDDEN, b), np.float32)
            gate, a, cand, r, _ = _step(p, d, x[t], prev)
            dh = dh + dh_in[t]
            da = dh * gate / (1 + np.abs(a)) ** 2
            dgate = (dh * (cand - prev) + da * r) * 0.25 * ((gate > 0) & (gate < 1))
            dr = np.concatenate([dgate, da * gate])
            dg_all[t, :HIDDEN], dg_all[t, HIDDEN:] = dgate, da
            drec += dr @ prev.T
            dh = dh * (1 - gate) + rec.T @ dr
        flat = x.ravel()
        grad["rec_" + d] = drec
        grad["in_" + d] = np.stack([np.bincount(flat, w, 256) for w in dg_all.transpose(1, 0, 2).reshape(2 * HIDDEN, -1)]).astype(np.float32)
    return loss, grad


def train(windows: list[bytes], labels: np.ndarray, langs: int, epochs: int = EPOCHS, seed: int = 3, batch: int = 128) -> dict:
    """Adam over shuffled batches; classes weigh the same in total."""
    p, rng = init(langs, seed), np.random.default_rng(seed)
    x_all = np.frombuffer(b"".join(w[:SPAN].ljust(SPAN) for w in windows), np.uint8).reshape(-1, SPAN).astype(np.intp)
    counts = np.bincount(labels, minlength=langs)
    weight = (len(labels) / (np.maximum(counts, 1) * max(1, (counts > 0).sum()))).astype(np.float32)
    m1 = {k: np.zeros_like(v) for k, v in p.items()}
    m2 = {k: np.zeros_like(v) for k, v in p.items()}
    step, total = 0, max(1, epochs * -(-len(labels) // batch))
    for _ in range(epochs):
        order = rng.permutation(len(labels))
        for lo in range(0, len(order), batch):
            at = order[lo:lo + batch]
            _, g = gradients(p, np.ascontiguousarray(x_all[at].T), labels[at], weight[labels[at]])
            norm = np.sqrt(sum(float((v ** 2).sum()) for v in g.values()))
            step += 1
            rate = 0.03 * (1 - 0.95 * step / total)
            for k, v in g.items():
                v = v * min(1.0, 1.0 / (norm + 1e-9))
                m1[k] = 0.9 * m1[k] + 0.1 * v
                m2[k] = 0.99 * m2[k] + 0.01 * v * v
                p[k] -= (rate * (m1[k] / (1 - 0.9 ** step)) / (np.sqrt(m2[k] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
    return p


def predict(p: dict, texts: list[bytes]) -> np.ndarray:
    """(documents, L) mean label probabilities over all bytes (at least one each)."""
    n = np.array([len(t) for t in texts], np.int64)
    per_doc = -(-n // SPAN)
    first = np.concatenate(([0], np.cumsum(per_doc)))
    buf = np.full(int(first[-1]) * SPAN, 0x20, np.uint8)
    for t, w in zip(texts, first.tolist()):
        buf[w * SPAN:w * SPAN + len(t)] = np.frombuffer(t, np.uint8)
    length = np.full(int(first[-1]), SPAN, np.int64)
    length[first[1:] - 1] = n - (per_doc - 1) * SPAN
    grid = buf.reshape(-1, SPAN)
    sums = [pooled(p, np.ascontiguousarray(grid[lo:lo + BLOCK].T).astype(np.intp), length[lo:lo + BLOCK])
            for lo in range(0, len(grid), BLOCK)]
    return np.add.reduceat(np.concatenate(sums), first[:-1], axis=0) / n[:, None]


# ------------------------------------------------------------------ operators

def remainder(id_col: Column, by: int) -> Column:
    """crc32 of the id's decimal text, modulo ``by``."""
    return F.crc32(id_col.cast("bigint").cast("string")) % by


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        per_lang: int = PER_LANG) -> tuple[list[str], dict | None]:
    """(languages, parameters) from the labelled rows that are not held out."""
    key = F.col(id_col).cast("bigint")
    seen = docs.where((remainder(key, 4) != 2) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counts = seen.groupBy(lang_col).agg(F.count(F.lit(1)).alias("n")).collect()  # one row a label
    if not counts:
        return [], None
    per_lang = min(per_lang, max(LEAST, WINDOWS // len(counts)))
    share = F.create_map(*[x for r in counts for x in (F.lit(r[lang_col]), F.lit(min(1.0, per_lang / r["n"])))])
    draw = F.xxhash64(F.lit("langid"), key)
    at = F.pmod(F.xxhash64(F.lit("place"), key), F.greatest(F.lit(1), F.length(text_col) - SPAN + 1)).cast("int") + 1
    rows = (seen.where(F.pmod(draw, F.lit(1_000_000)) < share[F.col(lang_col)] * 1_000_000)
            .select(F.col(lang_col).alias("lang"), F.substring(F.col(text_col), at, F.lit(SPAN)).alias("t"), draw.alias("o"))
            .orderBy("o", "t").limit(2 * per_lang * len(counts)).collect())
    langs = sorted(r[lang_col] for r in counts)
    index = {x: i for i, x in enumerate(langs)}
    rows = [r for r in rows if LETTER.search(r["t"] or "")]
    if not rows:
        return [], None
    return langs, train([r["t"].encode() for r in rows], np.array([index[r["lang"]] for r in rows]), len(langs))


def tell(langs: list[str], params: dict | None, texts: list) -> tuple[list[str], list[float]]:
    """Language and score of each text."""
    some = [i for i, t in enumerate(texts) if params is not None and t and LETTER.search(t)]
    best, score = [UND] * len(texts), [0.0] * len(texts)
    if some:
        prob = predict(params, [texts[i].encode() for i in some])
        for i, row in zip(some, prob):
            k = int(row.argmax())
            best[i], score[i] = langs[k], min(1.0, float(row[k]))
    return best, score


def keep_lettered(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``docs`` without the rows whose own text is null or has no letter; every
    row's label becomes the language its text is in, whatever the table said
    (without a model labels stay)."""
    langs, params = fit(docs, id_col, text_col, lang_col)

    tells = params is not None and lang_col in docs.columns

    def judge(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(text_col).to_pylist()
        some = [bool(t and LETTER.search(t)) for t in texts]
        batch, texts = batch.filter(pa.array(some, pa.bool_())), [t for t, keep in zip(texts, some) if keep]
        if not tells:
            return batch
        return replaced(batch, lang_col, pa.array(tell(langs, params, texts)[0], pa.string()))

    return map_rows(docs.withColumn(text_col, F.col(text_col).cast("string")), judge)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row."""
    langs, params = fit(docs, id_col, text_col, lang_col)

    def run(batches):
        for b in batches:
            best, score = tell(langs, params, b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(best, pa.string()),
                                              pa.array(score, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    key = F.col(id_col).cast("bigint")
    held = F.coalesce(remainder(key, 4) == 2, F.lit(False))
    return (docs.select(key.alias("doc_id"), held.alias("held_out"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(lean(run), "doc_id bigint, held_out boolean, lang_pred string, score double"))
