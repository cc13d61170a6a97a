"""Chunk dedup of documents shorter than the shortest run."""

from guardlake.llm import chunk_dedup

from tests.llm.cases import documents


def test_short_copies_are_removed(spark):
    texts = ["yes please", "no", "yes please", "yes please!", "", "no", None, "yes please"]
    for whole, gone in ((True, {2, 5, 7}), (False, set())):
        found = {r.doc_id: bytes(r.kept).decode() for r in chunk_dedup.remove_repeats(documents(spark, texts), whole_documents=whole).collect()}
        assert found == {i: "" if i in gone else t or "" for i, t in enumerate(texts)}
