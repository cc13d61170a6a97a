"""What suffix dedup moves: few bytes for documents and entries, and the same rows with hardly any bits of a key."""

import random

import numpy as np
import pyarrow as pa
import pytest
from guardlake.llm import routing, suffix_dedup

from tests.llm.cases import documents, prose
from tests.llm.test_repeats import got, repeats, rows_with_nulls, summary, texts  # noqa: F401


def test_pieces_hold_all_documents(spark, texts):  # noqa: F811
    docs = rows_with_nulls(spark, texts)
    want = sorted(map(str, routing.in_batches(docs, 7).collect()))
    pieces = routing.in_packed_batches(docs, 7).toArrow()
    found = []
    for batch in set(pieces.column("batch").to_pylist()):
        rows = routing.documents(pieces.filter(pa.compute.equal(pieces.column("batch"), batch)))
        found += [{"id": r["id"], "doc_id": r["doc_id"], "text": r["text"], "batch": batch} for r in rows.to_pylist()]
    assert want == sorted(f"Row(id={r['id']}, doc_id={r['doc_id']}, text={r['text']!r}, batch={r['batch']})" for r in found)
    assert routing.in_packed_batches(docs.limit(0), 7).count() == 0


def test_pieces_of_prose_are_small(spark):
    rng = random.Random(4)
    made = [prose(rng, 800) for _ in range(200)]
    pieces = routing.in_packed_batches(documents(spark, made), 4).collect()
    assert sum(len(r.documents) for r in pieces) < 0.6 * sum(len(t.encode()) for t in made)


def test_entries_are_small():
    rng = random.Random(5)
    made = [prose(rng, 400) for _ in range(300)]
    table = pa.table({"id": pa.array(np.arange(300) * 7 + 3_000_000), "text": made})
    batch = suffix_dedup.Batch(table, 50, 20, 4, 16)
    rows = [x for _, x in batch.entries()]
    assert sum(len(x[0]) for x in rows) == 4 * len(batch.sent) > 10_000
    assert sum(len(a) + len(b) + len(ids) for a, b, ids, _ in rows) < 12.6 * len(batch.sent)


@pytest.mark.parametrize("key_bits,here,many", [(0, 16, 4096), (3, 16, 4096), (3, 2, 40)])
def test_anchors_that_share_a_key(spark, texts, key_bits, here, many):  # noqa: F811
    docs = rows_with_nulls(spark, texts)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    frame = suffix_dedup.remove_repeats(docs, 50, many_here=here, many=many, key_bits=key_bits)
    assert got(frame) == sorted((summary(*x) for x in repeats(rows, 50)), key=str)
