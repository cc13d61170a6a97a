"""Token counts by a two-tier lookup."""

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from guardlake.llm.bpe import MEMORY, bpe, merge_all, shared_text, slices

#: Documents, and characters of each, that are looked at for frequent pre-tokens.
SAMPLE_DOCS, SAMPLE_CHARS = 1024, 4096
#: Entries of the broadcast table, and the longest pre-token in it.
TABLE, LONGEST = 32_768, 64

_LENGTHS = {}


def frequent_lengths(docs, model, text="text"):
    """Number of tokens of the most frequent pre-tokens of a bounded sample.

    Which pre-tokens are in the table only decides where a count is looked up.
    """
    rows = docs.count()
    share = min(1.0, 2.0 * SAMPLE_DOCS / max(rows, 1))
    heads = docs.select(F.substring(F.coalesce(F.col(f"`{text}`"), F.lit("")), 1, SAMPLE_CHARS).alias("head"))
    sample = [r["head"] for r in heads.sample(fraction=share, seed=5).limit(SAMPLE_DOCS).collect()]
    seen = Counter()
    for a, b in slices(sample):
        words, numbers, _ = model.cut(sample[a:b])
        seen.update(dict(zip(words, np.bincount(numbers, minlength=len(words)).tolist())))
    chosen = [w for w, _ in seen.most_common(TABLE) if isinstance(w, str) and len(w) <= LONGEST]
    return dict(zip(chosen, map(len, merge_all([model.symbols(w) for w in chosen], model.ranks))))


def count_tokens(docs, tokenizer_path, limit=2048, doc_id="doc_id", text="text"):
    """Tokens of every whole text, without added special tokens.

    Frequent pre-tokens are looked up in a broadcast table of at most 32,768
    lengths, the others in the worker's memory; what neither knows is encoded
    there.  No pre-token is shuffled.  Returns doc_id, n_bytes (UTF-8), n_tokens,
    over_limit.  A null text counts as empty: 0 bytes, 0 tokens; rows with the
    same or a null id are counted each for itself; other columns are left out.
    """
    spec = shared_text(docs.sparkSession, tokenizer_path)
    table = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, bpe(spec.value), text))
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    base = docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
        F.octet_length(body).cast("long").alias("n_bytes"),
        body.alias("text"),
    )

    def count(batches):
        model, frequent = bpe(spec.value), table.value
        own = _LENGTHS.setdefault(hash(spec.value), {})
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in slices(texts):
                words, numbers, bounds = model.cut(texts[a:b])
                if len(own) > MEMORY:
                    own.clear()
                missing = [w for w in words if w not in frequent and w not in own]
                new = merge_all([[0] if isinstance(w, tuple) else model.symbols(w) for w in missing], model.ranks)
                own.update(zip(missing, map(len, new)))
                lengths = np.array([frequent[w] if w in frequent else own[w] for w in words], np.int64)
                upto = np.concatenate([[0], np.cumsum(lengths[numbers])]) if words else np.zeros(1, np.int64)
                counts = np.diff(upto[bounds])
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("n_bytes"), pa.array(counts, pa.int64()), pa.array(counts > limit)],
                    ["doc_id", "n_bytes", "n_tokens", "over_limit"],
                )

    return base.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
