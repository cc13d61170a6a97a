"""Strings whose polynomials modulo a power of two agree are told apart."""

import random

import numpy as np
import pytest
from guardlake.llm import chunk_dedup, jaccard_join, suffix_dedup
from guardlake.llm.hashing import PIECE, PrefixHash

from tests.llm.cases import documents


def doubled(a, b, times):
    """Two texts: each step puts the other one behind."""
    for _ in range(times):
        a, b = a + b, b + a
    return a, b


def brute_length(texts, length):
    seen, gone = set(), []
    for text in texts:
        body = text.encode()
        here = {body[i : i + length] for i in range(len(body) - length + 1)}
        taken = set()
        for i in range(len(body) - length + 1):
            if body[i : i + length] in seen:
                taken |= set(range(i, i + length))
        seen |= here
        gone.append(len(taken))
    return gone


@pytest.mark.parametrize("length", [3, PIECE, PIECE + 1, 3 * PIECE, 700])
def test_windows_and_ranges_agree(length):
    data = np.frombuffer(bytes(random.Random(length).choices(b"ab", k=900)), np.uint8)
    for which in (0, 1):
        hashes = PrefixHash(data, which)
        at = np.arange(len(data) - length + 1)
        windows = hashes.windows(length)
        assert (windows == hashes.raw(at, at + length)).all()
        texts = [data[i : i + length].tobytes() for i in at]
        assert len(set(windows.tolist())) == len(set(texts))
        assert all((windows[i] == windows[j]) == (texts[i] == texts[j]) for i in range(0, 100) for j in (i + 1, i + 7))


def test_doubled_texts_differ():
    for times in (8, 10, 11, 12):
        texts = doubled("c", "x", times)
        found = [PrefixHash(np.frombuffer(t.encode(), np.uint8), w).of(np.array([0]), np.array([len(t)]))[0] for t in texts for w in (0, 1)]
        assert found[0] != found[2] and found[1] != found[3]


def test_operators_on_doubled_texts(spark):
    texts = [*doubled("c", "x", 11), *doubled("ab", "ba", 11)]
    docs = documents(spark, texts)
    classes = jaccard_join.link_documents(docs, width=3, percent=90).collect()
    assert {r.component_id for r in classes} == {0, 1, 2, 3}
    for length in (50, 1024):
        found = {r.doc_id: sum(s.end - s.start for s in r.spans) for r in suffix_dedup.remove_repeats(docs, length=length).collect()}
        assert found == dict(enumerate(brute_length(texts, length)))
    kept = {r.doc_id: bytes(r.kept).decode() for r in chunk_dedup.remove_repeats(docs).collect()}
    assert kept[0] and all(kept[i] != "" or texts[i] in texts[:i] for i in kept)
