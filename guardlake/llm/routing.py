"""Dealing packed arrays between documents and keys.

Documents lie in batches, by a hash of their id; what a batch knows about a key
(a hash) goes to the bucket of that key, and the bucket's answers go back to the
batch.  A row carries whole arrays, so the shuffle moves a few bytes per key and
the work inside a task runs on arrays.
"""

import numpy as np
import pyarrow as pa
from guardlake.llm.hashing import groups
from pyspark.sql import functions as F

#: Batches per shuffle partition, so that their sizes even out.
PER_PARTITION = 2
#: Bytes of documents that a task holds before it sends them out in pieces.
HELD = 64 << 20
DOCUMENTS = pa.schema([("id", pa.int64()), ("doc_id", pa.int64()), ("text", pa.string())])


def counts(spark):
    """(batches, buckets) for the session's number of shuffle partitions.

    A batch sends at most one row per bucket, so their product bounds the rows.
    """
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return PER_PARTITION * n, n


def in_batches(docs, n, doc_id="doc_id", text="text"):
    """(batch, id, text) with null ids as the largest number, dealt out by batch."""
    slim = docs.select(
        F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(np.iinfo(np.int64).max)).alias("id"),
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    return slim.withColumn("batch", F.pmod(F.xxhash64("id"), F.lit(n)).cast("int"))


def in_packed_batches(docs, n, doc_id="doc_id", text="text"):
    """(batch, documents): the rows of :func:`in_batches`, those that a task has for a batch as one compressed piece."""

    def pieces(tables):
        rows = pa.Table.from_batches(tables)
        batch = np.asarray(rows.column("batch"))
        order, firsts, _ = groups(batch)
        (rows,) = rows.select(DOCUMENTS.names).take(order).combine_chunks().to_batches()
        made = [shrunk(rows.slice(a, b - a).serialize()) for a, b in zip(firsts, np.append(firsts[1:], len(order)))]
        del rows
        pa.default_memory_pool().release_unused()
        return pa.record_batch([pa.array(batch[order[firsts]], pa.int32()), pa.array(made, pa.binary())], ["batch", "documents"])

    def pack(tables):
        held, size = [], 0
        for rows in tables:
            if held and size + rows.nbytes > HELD:
                yield pieces(held)
                held, size = [], 0
            if rows.num_rows:
                held.append(rows)
                size += rows.nbytes
        if held:
            yield pieces(held)

    return in_batches(docs, n, doc_id, text).mapInArrow(pack, "batch int, documents binary")


def documents(table):
    """The documents in the pieces of :func:`in_packed_batches`."""
    parts = [pa.ipc.read_record_batch(pa.py_buffer(grown(x)), DOCUMENTS) for x in table.column("documents").to_pylist()]
    return pa.Table.from_batches(parts, DOCUMENTS).combine_chunks()


def shrunk(data):
    """Bytes compressed by zstd, which codes them by frequency too; Spark's own codec for shuffles finds repeats only."""
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def grown(data):
    """The bytes that :func:`shrunk` compressed."""
    return pa.decompress(memoryview(data)[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)


def ids_as_bytes(ids):
    """Compressed differences of 64-bit ids; about two bits an id where they ascend closely."""
    return shrunk(as_bytes(np.diff(ids, prepend=np.int64(0))))


def ids_from_bytes(data):
    """The ids that :func:`ids_as_bytes` wrote."""
    return np.cumsum(from_bytes(grown(data), "<i8"))


def packed(bucket, arrays):
    """For each bucket that occurs: its number and the bytes of the entries of each array, in their order."""
    for b, parts in dealt(bucket, arrays):
        yield b, [as_bytes(x) for x in parts]


def dealt(bucket, arrays):
    """For each bucket that occurs: its number and the entries of each array, in their order."""
    order = np.argsort(bucket, kind="stable")
    sorted_bucket = bucket[order]
    firsts = np.flatnonzero(np.concatenate([[True], sorted_bucket[1:] != sorted_bucket[:-1]])) if len(order) else order
    ends = np.append(firsts[1:], len(order))
    moved = [a[order] for a in arrays]
    for a, b in zip(firsts, ends):
        yield int(sorted_bucket[a]), [m[a:b] for m in moved]


def as_bytes(array):
    """Bytes of an array; signed 64-bit numbers, ids as a rule, byte plane by byte plane, which compresses well."""
    if array.dtype == np.int64:
        return np.ascontiguousarray(array).view(np.uint8).reshape(-1, 8).T.tobytes()
    return array.tobytes()


def from_bytes(data, dtype):
    """The array that :func:`as_bytes` wrote."""
    if np.dtype(dtype) == np.int64:
        return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(np.int64).ravel()
    return np.frombuffer(data, dtype)
