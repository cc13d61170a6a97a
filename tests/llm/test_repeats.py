"""Suffix-array dedup and chunk dedup against brute force."""

import hashlib
import random

import numpy as np
import pytest
from guardlake.llm import chunk_dedup, suffix_dedup
from guardlake.llm import queries as llm

from tests.llm.cases import AWKWARD, documents, prose


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(21)
    passage, line = prose(rng, 70), prose(rng, 14)
    made = list(AWKWARD)
    for i in range(150):
        body = prose(rng, rng.randint(5, 120)).split(" ")
        at = rng.randrange(len(body))
        if i % 3 == 0:
            body.insert(at, passage)
        if i % 2 == 0:
            body.insert(at, line)
        if i % 10 == 0:
            body.insert(at, line + " " + line)
        if i % 7 == 0:
            body.insert(at, "ä" * rng.randint(1, 150))
        made.append(" ".join(body))
    made += [made[40]] * 6 + [made[41][:200], made[42] + "x", "y" + made[43], "x" * 3000 + "z", "ab" * 700, passage]
    rng.shuffle(made)
    return made


def rows_with_nulls(spark, texts):
    docs = documents(spark, texts).withColumnRenamed("hash", "batch").withColumnRenamed("row", "bucket").repartition(4)
    docs = docs.unionByName(docs.where("doc_id in (3, 50)").selectExpr("null doc_id", *docs.columns[1:]))
    return docs.unionByName(docs.where("doc_id in (7, 60)"))


def repeats(rows, length):
    """Removed bytes per row."""
    first = {}
    for i, t in rows:
        i = float("inf") if i is None else i
        b = (t or "").encode()
        for at in range(len(b) - length + 1):
            s = b[at : at + length]
            first[s] = min(first.get(s, i), i)
    for i, t in rows:
        b = (t or "").encode()
        mask = np.zeros(len(b), bool)
        for at in range(len(b) - length + 1):
            if first[b[at : at + length]] < (float("inf") if i is None else i):
                mask[at : at + length] = True
        yield i, b, mask


def summary(i, b, mask):
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(int), [0]])))
    return i, len(b), [tuple(map(int, p)) for p in edges.reshape(-1, 2)], bytes(np.frombuffer(b, np.uint8)[~mask])


def got(frame):
    return sorted(((r.doc_id, r.n_bytes, [(s.start, s.end) for s in r.spans], bytes(r.kept)) for r in frame.collect()), key=str)


@pytest.mark.parametrize("length,here,many", [(50, 16, 4096), (50, 1, 3), (20, 2, 2), (130, 16, 4)])
def test_suffix_dedup(spark, texts, length, here, many):
    docs = rows_with_nulls(spark, texts)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    frame = suffix_dedup.remove_repeats(docs, length, many_here=here, many=many)
    assert got(frame) == sorted((summary(*x) for x in repeats(rows, length)), key=str)


def test_suffix_sort_with_collisions(monkeypatch):
    rng = np.random.default_rng(3)
    text = rng.integers(97, 99, 600, dtype=np.uint8)
    starts, segments, ids = rng.permutation(580)[:400], np.sort(rng.integers(0, 9, 400)), rng.integers(0, 50, 400)

    def check():
        order, equal = suffix_dedup.sort_suffixes(text, starts, segments, 12)
        key = lambda i: text[starts[i] : starts[i] + 12].tobytes()
        assert order.tolist() == sorted(range(400), key=lambda i: (segments[i], key(i), i))
        want = [j > 0 and segments[order[j]] == segments[order[j - 1]] and key(order[j]) == key(order[j - 1]) for j in range(400)]
        assert equal.tolist() == want
        found = suffix_dedup.repeated_suffixes(text, starts, segments, ids, 12)
        for i in range(400):
            assert found[i] == any(segments[j] == segments[i] and key(j) == key(i) and ids[j] < ids[i] for j in range(400))

    check()
    raw = suffix_dedup.PrefixHash.raw
    monkeypatch.setattr(suffix_dedup.PrefixHash, "raw", lambda self, a, b: raw(self, a, b) % np.uint64(3))
    check()


def slow_chunks(b):
    h, cuts, last, start = 0, [], -99, 0
    for i, x in enumerate(b):
        h = ((h << 1) + int(chunk_dedup.GEAR[x])) & 0xFFFFFFFF
        if h >> 27 == 0 and (i + 1 == len(b) or b[i + 1] & 0xC0 != 0x80):
            if i - last >= 16:
                cuts.append(i + 1)
            last = i
    out = []
    for end in sorted({*cuts, len(b)} - {0}):
        at = start
        while end - at > 4096:
            to = start + (at - start) // 4096 * 4096 + 4096 if at == start else (at_next := at_base + 4096)
            at_base = to
            while b[to] & 0xC0 == 0x80:
                to -= 1
            out.append((at, to))
            at = to
            if end - at_base <= 4096:
                break
        if end > at:
            out.append((at, end))
        start = end
    return out


def slow_dedup(rows, shortest):
    seen = set()
    for i, t in sorted(rows, key=lambda r: (float("inf") if r[0] is None else r[0], r[1] or "")):
        b = (t or "").encode()
        mask, run = np.zeros(len(b), bool), None
        marks = []
        for a, e in slow_chunks(b):
            marks.append((a, e, b[a:e] in seen))
            seen.add(b[a:e])
        for a, e, again in [*marks, (len(b), len(b), False)]:
            if again and run is None:
                run = a
            if not again and run is not None:
                if a - run >= shortest or (run == 0 and a == len(b)):
                    mask[run:a] = True
                run = None
        yield i, b, mask


def test_chunk_dedup(spark, texts):
    docs = rows_with_nulls(spark, texts + ["é" * 9000, "q" * 10_000, "é" * 9001])
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    frame = chunk_dedup.remove_repeats(docs)
    assert got(frame) == sorted((summary(*x) for x in slow_dedup(rows, 64)), key=str)
    assert all(r.kept.decode() is not None for r in frame.collect())


def test_shifted_passage_is_caught_and_the_rest_is_left(spark):
    rng = random.Random(8)
    letters = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(n))
    passage = letters(60)
    texts = [letters(100), letters(40) + " " + passage + " " + letters(30), letters(77) + " x " + passage, letters(90)]
    removed = [sum(e - s for s, e in spans) for _, _, spans, _ in got(chunk_dedup.remove_repeats(documents(spark, texts)))]
    assert removed[:2] == [0, 0] and removed[3] == 0 and removed[2] > len(passage) / 2


def test_empty_tables(spark):
    docs = documents(spark, ["a"]).where("false")
    assert suffix_dedup.remove_repeats(docs).count() == chunk_dedup.remove_repeats(docs).count() == 0


def test_queries_against_brute_force(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    for query, want in ((llm.op1_suffix_dedup, repeats(rows, 50)), (llm.op9_chunk_dedup, slow_dedup(rows, 64))):
        expected = {}
        for i, b, mask in want:
            _, n, spans, kept = summary(i, b, mask)
            expected[i] = (n, int(mask.sum()), len(spans), hashlib.sha256(kept).hexdigest())
        found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in query(spark, sf_dir).collect()}
        assert found == expected
