"""Token-id files: flat unsigned integers plus 64-bit document offsets.

Documents are dealt to buckets in ascending doc_id order (cut points from one
narrow sketch of the ids), encoded before the only shuffle, sorted inside their
bucket and appended to the bucket's files as they arrive, so a task holds one
Arrow batch, never a bucket.  Each bucket has

    NNNNNN.bin  token ids, little-endian, 2 bytes if the vocabulary allows, else 4
    NNNNNN.off  n+1 uint64 offsets, in ids, of its documents
    NNNNNN.doc  n int64 doc_ids (null ids come first; ``n_null`` counts them)

A file is written under an attempt's own name and then moved in place; a task
that is run again makes the same bytes.  A bucket's base, the ids in all buckets
before it, is a prefix sum over the manifest: one row per bucket.

Defined results: null text is empty (the end id alone); rows with equal doc_id
are ordered by their ids; null doc_ids come first; no rows give no files; other
columns are ignored.
"""

from __future__ import annotations

import itertools
import uuid
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from winnow.llm.common import id_text, materialize, order_cuts, shuffle_partitions
from winnow.llm.tokenizing import encoder
from winnow.session import scratch_path

READ_DOCS = 4096  # documents of one output batch when reading


def _store(uri: str):
    from pyarrow import fs
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def _flat(uri: str, dtype: str) -> np.ndarray:
    """A file's integers: memory-mapped on a mounted path, else read."""
    from pyarrow import fs
    store, path = _store(uri)
    if isinstance(store, fs.LocalFileSystem):
        with pa.memory_map(path) as f:
            return np.frombuffer(f.read_buffer(), dtype)
    with store.open_input_file(path) as f:
        return np.frombuffer(f.read_buffer(), dtype)


def id_width(vocab: str, end_id: int) -> int:
    """Bytes of an id in the files: 2 if the vocabulary's and the end id fit, else 4."""
    top = max([end_id, *encoder(vocab).tok.get_vocab(with_added_tokens=True).values()])
    if end_id < 0 or top >= 1 << 32:
        raise ValueError(f"ids must fit 4 bytes; the end id is {end_id}, the largest id {top}")
    return 2 if top < 1 << 16 else 4


def encode(docs: DataFrame, vocab: str, end_id: int, cuts: list[int], dtype: str) -> DataFrame:
    """(bucket, doc_id, ids binary of the file's width) with the end id appended."""
    end = array("I", [end_id]).tobytes()
    edges = np.array(cuts, np.int64)

    def run(batches):
        enc = encoder(vocab)
        for b in batches:
            ids = [np.frombuffer(enc.encode(t or "") + end, "<u4").astype(dtype).tobytes() for t in b.column("text").to_pylist()]
            at = np.searchsorted(edges, b.column("doc_id").fill_null(np.iinfo(np.int64).min).to_numpy(), side="right")
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), b.column("doc_id"), pa.array(ids, pa.binary())],
                                             names=["bucket", "doc_id", "ids"])

    return docs.mapInArrow(run, "bucket int, doc_id bigint, ids binary")


def write_token_files(docs: DataFrame, path: str, vocab: str, end_id: int, width: int | None = None,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the files below ``path``, ids of ``width`` bytes (``id_width`` if not
    given); the manifest (bucket, n_docs, n_null, n_tokens, base), one row per
    non-empty bucket."""
    least = id_width(vocab, end_id)
    width = width or least
    if width < least:
        raise ValueError(f"ids of this vocabulary and end id {end_id} need {least} bytes, not {width}")
    spark = docs.sparkSession
    docs = id_text(docs, id_col, text_col)
    parts = shuffle_partitions(spark)
    cuts = order_cuts(docs, "doc_id", parts)
    dtype = {2: "<u2", 4: "<u4"}[width]

    def run(batches):
        rows = None
        for b in batches:
            if rows is None:
                store, root = _store(path)
                store.create_dir(root, recursive=True)
                bucket, tag = b.column("bucket")[0].as_py(), uuid.uuid4().hex
                final = f"{root}/{bucket:06d}"
                out = store.open_output_stream(f"{final}.bin.{tag}")
                rows, offsets, ids, nulls = 0, array("Q", [0]), array("q"), 0
            for d, raw in zip(b.column("doc_id").to_pylist(), b.column("ids").to_pylist()):
                out.write(raw)
                offsets.append(offsets[-1] + len(raw) // width)
                ids.append(0 if d is None else d)
                nulls += d is None
                rows += 1
        if rows is None:
            return
        out.close()
        for kind, data in (("off", offsets), ("doc", ids)):
            with store.open_output_stream(f"{final}.{kind}.{tag}") as f:
                f.write(data.tobytes())
        for kind in ("bin", "off", "doc"):
            store.move(f"{final}.{kind}.{tag}", f"{final}.{kind}")
        yield pa.RecordBatch.from_pydict({"bucket": pa.array([bucket], pa.int32()), "n_docs": [rows], "n_null": [nulls],
                                          "n_tokens": [offsets[-1]]})

    done = (encode(docs, vocab, end_id, cuts, dtype)
            .repartitionById(len(cuts) + 1, F.col("bucket")).sortWithinPartitions("doc_id", "ids")
            .mapInArrow(run, "bucket int, n_docs bigint, n_null bigint, n_tokens bigint"))
    rows = materialize(done, "token-manifest").orderBy("bucket").collect()  # one row per bucket
    bases = itertools.accumulate((r["n_tokens"] for r in rows), initial=0)
    return spark.createDataFrame([(*r, b) for r, b in zip(rows, bases)],
                                 "bucket int, n_docs bigint, n_null bigint, n_tokens bigint, base bigint")


def read_token_files(spark: SparkSession, path: str, manifest: DataFrame, width: int | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files,
    whose size tells the width if it is not given."""
    def run(batches):
        for b in batches:
            for m in b.to_pylist():
                name = f"{path}/{m['bucket']:06d}"
                raw, off, ids = _flat(f"{name}.bin", "u1"), _flat(f"{name}.off", "<u8"), _flat(f"{name}.doc", "<i8")
                flat = raw.view(f"<u{width or len(raw) // m['n_tokens']}")
                for lo in range(0, m["n_docs"], READ_DOCS):
                    hi = min(m["n_docs"], lo + READ_DOCS)
                    crc = [zlib.crc32(flat[off[i]:off[i + 1]].astype("<u4").tobytes()) for i in range(lo, hi)]
                    o = off[lo:hi + 1].astype(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[lo:hi], mask=np.arange(lo, hi) < m["n_null"]), pa.array(o[:-1] + m["base"]),
                         pa.array(np.diff(o)), pa.array(crc, pa.int64())],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return (manifest.repartition(shuffle_partitions(spark), "bucket")
            .mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"))


def token_files(docs: DataFrame, vocab: str, end_id: int, path: str | None = None) -> DataFrame:
    """Write and read back in the shared folder: the digest of every document."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "tokens")
    manifest = write_token_files(docs, path, vocab, end_id)
    return read_token_files(spark, path, manifest)
