"""Quality scores by nearest-neighbour voting in a latent-semantic space."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from guardlake.llm.hashing import PrefixHash, blocks, groups, mix, utf8

#: Hashed columns of the term table: character-shape trigrams, then bins of word statistics.
SHAPES, BINS = 2048, 16
#: Labelled documents that are kept as neighbours, latent dimensions, neighbours that vote.
REFERENCES, DIMENSIONS, NEIGHBOURS = 4096, 48, 24


def _shape_classes():
    """Letters below and above, digits, blanks, line ends; every other ASCII character for itself."""
    table = np.arange(256, dtype=np.uint32)
    table[ord("a") : ord("z") + 1] = table[0x80:] = ord("a")
    table[ord("A") : ord("Z") + 1] = ord("A")
    table[ord("0") : ord("9") + 1] = ord("0")
    return table


_CLASSES = _shape_classes()
#: Word statistics: share of distinct words, of words equal to the one before, mean length, log of the number of words.
STATISTICS = 4


def terms(data, offsets):
    """Term weights of documents [offsets[i], offsets[i + 1]): a dense row each, of SHAPES + STATISTICS * BINS columns."""
    n = len(offsets) - 1
    width = SHAPES + STATISTICS * BINS
    out = np.zeros((n, width), np.float32)
    owner = np.repeat(np.arange(n), np.diff(offsets))
    if len(data) >= 3:
        shape = _CLASSES[data]
        code = (shape[:-2] << 16) | (shape[1:-1] << 8) | shape[2:]
        # A multiplicative hash; trigrams do not cross documents.
        column = (code * np.uint32(2654435761)) >> np.uint32(21)
        inside = owner[:-2] == owner[2:]
        counts = np.bincount(owner[:-2][inside] * SHAPES + column[inside], minlength=n * SHAPES)
        out[:, :SHAPES] = np.sqrt(counts.reshape(n, SHAPES))
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    word = ~blank
    starts_new = word.copy()
    starts_new[1:] &= blank[:-1] | (owner[1:] != owner[:-1])
    starts = np.flatnonzero(starts_new)
    stops_here = word.copy()
    stops_here[:-1] &= blank[1:] | (owner[1:] != owner[:-1])
    ends = np.flatnonzero(stops_here) + 1
    of = owner[starts]
    words = np.bincount(of, minlength=n)
    some = np.maximum(words, 1)
    hashes = PrefixHash(data).of(starts, ends) if len(starts) else np.zeros(0, np.uint64)
    order, firsts, _ = groups(hashes ^ mix(of.astype(np.uint64)))
    distinct = np.bincount(of[order[firsts]], minlength=n)
    again = np.bincount(of[1:][(hashes[1:] == hashes[:-1]) & (of[1:] == of[:-1])], minlength=n)
    length = np.bincount(of, ends - starts, minlength=n)
    size = np.log2(1 + words)
    figures = (
        # Long texts repeat words anyway, so the share is judged by size.
        distinct / some * np.sqrt(np.maximum(size, 1)) / 4,
        np.minimum(1, again / some * 4),
        length / some / 16,
        size / 16,
    )
    spread = np.sqrt(np.diff(offsets))
    for i, figure in enumerate(figures):
        at = np.clip((figure * BINS).astype(np.int64), 0, BINS - 1)
        # As heavy as a tenth of the text's trigrams, so that it counts beside them.
        out[np.arange(n), SHAPES + i * BINS + at] = np.maximum(1, 0.4 * spread)
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.maximum(norm, 1e-9)


def _unit(x):
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


class Voter:
    """Latent-semantic projection and labelled vectors; the same at every size of the corpus."""

    def __init__(self, rows, labels, dimensions=DIMENSIONS, neighbours=NEIGHBOURS):
        rows = rows.astype(np.float32)
        present = (rows > 0).sum(0)
        self.weights = np.log((1 + len(rows)) / (1 + present)).astype(np.float32) + 0.1
        weighted = rows * self.weights
        # Leading right singular vectors by subspace iteration from a fixed start.
        basis = np.random.default_rng(7).standard_normal((rows.shape[1], min(dimensions + 16, len(rows))))
        for _ in range(6):
            basis, _ = np.linalg.qr(weighted.T @ (weighted @ basis))
        _, _, turn = np.linalg.svd(weighted @ basis, full_matrices=False)
        keep = basis @ turn.T[:, :dimensions]
        self.projection = (self.weights[:, None] * keep).astype(np.float32)
        self.vectors = _unit(rows @ self.projection).astype(np.float32)
        self.labels = labels.astype(np.float32)
        self.neighbours = min(neighbours, len(labels))

    def score(self, rows):
        """Share of label 1 among the nearest labelled vectors, weighted by cosine."""
        cosines = _unit(rows @ self.projection) @ self.vectors.T
        k = self.neighbours
        near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosines, near, 1), 1e-6).astype(np.float64) ** 8
        return (weight * self.labels[near]).sum(1) / weight.sum(1)


def held_out(doc_id):
    """Whether the label of that id is never learned from; a null id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


def _term_rows(column):
    data, offsets = utf8(column)
    for a, b in blocks(offsets, each=2048):
        yield a, b, terms(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])


def fit(docs, labels, doc_id="doc_id", text="text", label="quality", references=REFERENCES):
    """Voter over at most ``references`` labelled documents, chosen by a hash of the id.

    Learns only from labels of ids that are not held out.  Of repeated ids the
    smallest label and text count; null labels are left out.
    """
    given = labels.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{label}`").cast("int").alias("label"))
    given = given.where(F.col("label").isNotNull() & F.col("id").isNotNull() & ~held_out(F.col("id")))
    given = given.groupBy("id").agg(F.min("label").alias("label"))
    texts = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    present = texts.select("id").join(given, "id", "left_semi").distinct()
    # Bounded by ``references`` rows of two numbers.
    chosen = given.join(present, "id").orderBy(F.xxhash64("id"), "id").limit(references)
    rows = texts.join(F.broadcast(chosen), "id").groupBy("id", "label").agg(F.min("text").alias("text"))

    def encode(batches):
        for batch in batches:
            for a, b, x in _term_rows(batch.column("text")):
                half = [r.tobytes() for r in x.astype(np.float16)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(a, b - a).cast(pa.int64()), batch.column("label").slice(a, b - a), pa.array(half, pa.binary())],
                    ["id", "label", "terms"],
                )

    found = sorted(rows.mapInArrow(encode, "id long, label int, terms binary").collect())
    width = SHAPES + STATISTICS * BINS
    x = np.array([np.frombuffer(r["terms"], np.float16) for r in found], np.float32).reshape(len(found), width)
    return Voter(x, np.array([r["label"] for r in found])) if found else None


def score_documents(docs, voter, text="text", columns=None):
    """``docs`` (or some of its columns) with a quality score from 0 to 1 as last column; returns (frame, its name).

    Every document is compared with every labelled vector, in blocks.  Only the
    text counts; null counts as empty, and an empty text is scored by the vector
    of empty texts.  Without any label each score is 0.5.
    """
    columns = docs.columns if columns is None else columns
    name = "score"
    while name in docs.columns:
        name += "_"
    model = docs.sparkSession.sparkContext.broadcast(voter)
    position = len(columns)

    def score(batches):
        for batch in batches:
            found = [np.zeros(0)]
            for _, _, x in _term_rows(batch.column(position)):
                found.append(model.value.score(x) if model.value is not None else np.full(len(x), 0.5))
            arrays = [*batch.columns[:position], pa.array(np.concatenate(found), pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, [*columns, name])

    inner = docs.select(*[F.col(f"`{c}`") for c in columns], F.col(f"`{text}`").alias("text of the score"))
    schema = docs.select(*[F.col(f"`{c}`") for c in columns]).withColumn(name, F.lit(0.0)).schema
    return inner.mapInArrow(score, schema), name
