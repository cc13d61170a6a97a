"""Token ids as flat binary files with document offsets.

A shard is three files: ``.bin`` holds the ids of its documents one after
another, little-endian, as 16-bit unsigned integers if all ids fit and as 32-bit
otherwise; ``.idx`` the 64-bit offsets of the documents in the shard, counted in
ids, with the total at the end; ``.doc`` their 64-bit document ids.  ``manifest`` holds a
row per shard with its base, the number of ids in the shards before it.
"""

import json
import posixpath
import zlib
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import functions as F

from guardlake.llm.bpe import bpe, shared_text, slices
from guardlake.llm.hashing import ranges
from guardlake.llm.words import byte_pattern, plain

#: Stands for a null document id in ``.doc``.
NO_ID = np.iinfo(np.int64).min
#: Ids that a reader handles at once.
READ = 1 << 20
#: Pre-tokens in a worker's table, some 200 bytes each.
REMEMBERED = 1_000_000


def _filesystem(folder):
    return fs.FileSystem.from_uri(folder)


class FlatEncoder:
    """Ids of texts through a worker's table of pre-tokens: where each one's ids lie in one flat array.

    Texts are cut by the compiled pattern, or by the tokenizer's own steps where
    they hold special strings or characters past its tables; pre-tokens that the
    table lacks are merged by the library's model.  A table of ``REMEMBERED``
    pre-tokens is begun anew.
    """

    def __init__(self, model, end_id):
        self.model, self.end = model, (end_id,)
        self.clear()

    def clear(self):
        self.table = {self.end: 0}
        self.flat, self.starts, self.lengths = (np.array([x], np.int64) for x in (self.end[0], 0, 1))

    def pre_tokens(self, text):
        """Pre-tokens of a text; a special string is the tuple of its id."""
        model = self.model
        if model.lower or not plain(text) or any(s in text for s in model.specials):
            words, numbers, _ = model.cut([text])
            return [words[k] for k in numbers.tolist()]
        return byte_pattern().findall(text)

    def encode(self, texts):
        """Flat ids, the end id behind each text's, and where each text's begin, with the total at the end."""
        if len(self.table) > REMEMBERED:
            self.clear()
        tokens, bounds = [], [0]
        for text in texts:
            tokens += self.pre_tokens(text)
            tokens.append(self.end)
            bounds.append(len(tokens))
        place = np.fromiter(map(self.table.get, tokens, repeat(-1)), np.int64, len(tokens))
        missing = np.flatnonzero(place < 0)
        if len(missing):
            self.learn(list(dict.fromkeys([tokens[i] for i in missing.tolist()])))
            place[missing] = [self.table[tokens[i]] for i in missing.tolist()]
        lengths = self.lengths[place]
        upto = np.concatenate([[0], np.cumsum(lengths)])
        return self.flat[ranges(self.starts[place], lengths)], upto[bounds]

    def learn(self, words):
        ids, lengths = self.model.library_ids(words)
        first = len(self.starts)
        self.table.update(zip(words, range(first, first + len(words))))
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.flat = np.concatenate([self.flat, ids])


_ENCODERS = {}


def encoder(text, end_id):
    """The encoder of that tokenizer file, built once per worker."""
    key = hash(text), end_id
    if key not in _ENCODERS:
        _ENCODERS[key] = FlatEncoder(bpe(text, by_library=True), end_id)
    return _ENCODERS[key]


def write_token_files(docs, tokenizer_path, folder, end_id, doc_id="doc_id", text="text", partitions=None):
    """Encode whole texts and write them in ascending order of id, one shard per range of ids.

    ``folder`` is a URI that all executors reach.  A shard's files carry the number
    of the task attempt that wrote them, and the manifest names the attempts that
    succeeded, so a lost executor leaves at most files that nothing refers to.
    Returns the manifest's rows.  A null text counts as empty and holds just the
    end id; null ids come last; rows with the same id stand side by side, ordered by text.
    """
    spark = docs.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    spec = shared_text(spark, tokenizer_path)
    wide = max([end_id, *bpe(spec.value, by_library=True).names]) >= 1 << 16
    dtype = "<u4" if wide else "<u2"
    ordered = (
        docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
        .repartitionByRange(partitions, F.col("doc_id").asc_nulls_last())
        .sortWithinPartitions(F.col("doc_id").asc_nulls_last(), "text")
    )

    def write(batches):
        task = TaskContext.get()
        shard = task.partitionId()
        name = f"part-{shard:06d}-{task.taskAttemptId()}"
        store, place = _filesystem(folder)
        store.create_dir(place, recursive=True)
        model, total, offsets, numbers = encoder(spec.value, end_id), 0, [np.zeros(1, np.int64)], []
        with store.open_output_stream(posixpath.join(place, name + ".bin")) as out:
            for batch in batches:
                texts = batch.column("text").to_pylist()
                numbers.append(np.asarray(batch.column("doc_id").fill_null(NO_ID), "<i8"))
                for a, b in slices(texts):
                    ids, bounds = model.encode(texts[a:b])
                    out.write(ids.astype(dtype).tobytes())
                    offsets.append(total + bounds[1:])
                    total += len(ids)
        for ending, arrays in ((".idx", offsets), (".doc", numbers)):
            with store.open_output_stream(posixpath.join(place, name + ending)) as out:
                for x in arrays:
                    out.write(x.astype("<i8").tobytes())
        n_docs = sum(map(len, numbers))
        if n_docs:
            row = {"shard": shard, "name": name, "dtype": dtype, "n_docs": n_docs, "n_tokens": total}
            yield pa.RecordBatch.from_pylist([row], SHARD)

    shards = ordered.mapInArrow(write, "shard int, name string, dtype string, n_docs long, n_tokens long").collect()
    base, rows = 0, []
    for r in sorted(shards, key=lambda r: r["shard"]):
        rows.append({**r.asDict(), "base": base})
        base += r["n_tokens"]
    store, place = _filesystem(folder)
    store.create_dir(place, recursive=True)
    with store.open_output_stream(posixpath.join(place, "manifest")) as out:
        out.write("".join(json.dumps(r) + "\n" for r in rows).encode())
    return rows


SHARD = pa.schema(
    [("shard", pa.int32()), ("name", pa.string()), ("dtype", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]
)


def read_manifest(folder):
    """The manifest's rows, one per shard."""
    store, place = _filesystem(folder)
    with store.open_input_stream(posixpath.join(place, "manifest")) as f:
        return [json.loads(line) for line in f.read().splitlines()]


def _mapped(store, path, dtype):
    """The file's numbers, memory-mapped where it is local."""
    if isinstance(store, fs.LocalFileSystem):
        if store.get_file_info(path).size == 0:
            return np.zeros(0, dtype)
        return np.memmap(path, dtype, "r")
    with store.open_input_file(path) as f:
        return np.frombuffer(f.read(), dtype)


def _documents(folder, row):
    """Runs of documents of a shard: ids of the documents, starts and ends, all ids of the shard."""
    store, place = _filesystem(folder)
    ids = _mapped(store, posixpath.join(place, row["name"] + ".bin"), row["dtype"])
    offsets = _mapped(store, posixpath.join(place, row["name"] + ".idx"), "<i8")
    numbers = _mapped(store, posixpath.join(place, row["name"] + ".doc"), "<i8")
    first = 0
    while first < len(numbers):
        last = int(np.searchsorted(offsets, offsets[first] + READ, "right")) - 1
        last = min(len(numbers), max(last, first + 1))
        yield np.array(numbers[first:last]), np.array(offsets[first : last + 1]), ids
        first = last


def _read(spark, folder, one, schema):
    rows = [(r["name"], r["dtype"], r["base"]) for r in read_manifest(folder)]
    shards = spark.createDataFrame(rows, "name string, dtype string, base long")

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                for numbers, offsets, ids in _documents(folder, row):
                    columns = [
                        pa.array(numbers, pa.int64(), mask=numbers == NO_ID),
                        pa.array(offsets[:-1] + row["base"], pa.int64()),
                        pa.array(np.diff(offsets), pa.int64()),
                        one(offsets, ids),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in schema.split(", ")])

    return shards.mapInArrow(read, schema)


def read_token_files(spark, folder):
    """(doc_id, start, n_tokens, ids) of every document in the files; start counts the ids of all documents before."""

    def lists(offsets, ids):
        values = pa.array(np.array(ids[offsets[0] : offsets[-1]], np.int64), pa.int64())
        return pa.ListArray.from_arrays(pa.array(offsets - offsets[0], pa.int32()), values)

    return _read(spark, folder, lists, "doc_id long, start long, n_tokens long, ids array<long>")


def digest_token_files(spark, folder):
    """As :func:`read_token_files` with ids_crc32, of the ids as little-endian 32-bit integers, instead of the ids."""

    def sums(offsets, ids):
        wide = np.array(ids[offsets[0] : offsets[-1]], "<u4")
        at = (offsets - offsets[0]).tolist()
        return pa.array([zlib.crc32(wide[a:b].tobytes()) for a, b in zip(at, at[1:])], pa.int64())

    return _read(spark, folder, sums, "doc_id long, start long, n_tokens long, ids_crc32 long")
