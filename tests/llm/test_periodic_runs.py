"""Periodic runs against brute force, over any way of appending the words."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from guardlake.llm import periodic_runs
from guardlake.llm import queries as llm

from tests.llm.cases import AWKWARD, documents, prose


def brute_runs(words, exponent=4, shortest=6):
    n, found = len(words), {}
    for p in range(1, n // exponent + 1):
        i = p
        while i < n:
            j = i
            while j < n and words[j] == words[j - p]:
                j += 1
            if j > i:
                found.setdefault((i - p, j), p)
            i = j + 1
    return sorted((s, e - s, p) for (s, e), p in found.items() if e - s >= max(shortest, exponent * p))


def repeated(rng, size, letters):
    words = []
    while len(words) < size:
        if words and rng.random() < 0.4:
            a = rng.randrange(len(words))
            words += (words[a : a + rng.randint(1, 20)] * rng.randint(1, 9))[: rng.randint(1, 90)]
        else:
            words.append(b"%d" % rng.randrange(letters))
    return words


def test_streams_of_repeats(monkeypatch):
    rng = random.Random(11)
    for _ in range(300):
        docs = [repeated(rng, rng.choice([0, 5, 30, 80]), rng.choice([1, 2, 3, 5])) for _ in range(rng.randint(0, 4))]
        monkeypatch.setattr(periodic_runs, "CHUNK", rng.choice([1, 2, 3, 7, 16, 1000]))
        exponent, shortest = rng.choice([2, 3, 4]), rng.choice([1, 6])
        found = [[] for _ in docs]
        for d, *run in zip(*(x.tolist() for x in periodic_runs.runs_of(docs, exponent, shortest))):
            found[d].append(tuple(run))
        assert found == [brute_runs(d, exponent, shortest) for d in docs]


def test_words_with_equal_prints(monkeypatch):
    monkeypatch.setattr(periodic_runs, "_blend", lambda a, b: (a + b) % np.uint32(3))
    rng = random.Random(12)
    for _ in range(60):
        words = repeated(rng, 60, 3)
        assert list(zip(*(x.tolist() for x in periodic_runs.runs_of([words])[1:]))) == brute_runs(words)


def test_one_long_run():
    found = periodic_runs.runs_of([[b"a"] * 30_000, [b"a", b"b"] * 15_000 + [b"b"]])
    assert [x.tolist() for x in found] == [[0, 1], [0, 0], [30_000, 30_000], [1, 2]]


def brute_row(text, doc_id):
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    gone = {i for s, size, q in runs for i in range(s + q, s + size)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    listed = "".join(f"{s},{size},{q}\n" for s, size, q in runs).encode()
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *top, hashlib.sha256(listed).hexdigest(), hashlib.sha256(kept).hexdigest())


COLUMNS = "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256".split()


def ordered(rows):
    return sorted(rows, key=str)


def test_query_like_brute_force(spark, sf_dir):
    found = [tuple(r[c] for c in COLUMNS) for r in llm.op11_periodic_runs(spark, sf_dir).collect()]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    want = [brute_row(r.text, r.doc_id) for r in docs]
    assert ordered(found) == ordered(want)
    assert sum(r[1] > 0 for r in want) > len(want) // 20


def test_awkward_rows(spark, tmp_path):
    rng = random.Random(13)
    texts = AWKWARD + ["x " * 2000, "a\tb\n" * 900, "one two " * 7, " ".join(["é"] * 6), prose(rng, 2000)] * 2
    docs = documents(spark, texts)
    docs = docs.union(docs.selectExpr("null", *docs.columns[1:])).union(docs)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = [tuple(r[c] for c in COLUMNS) for r in llm.op11_periodic_runs(spark, str(tmp_path)).collect()]
    assert ordered(found) == ordered(brute_row(r.text, r.doc_id) for r in docs.collect())
    clash = docs.withColumnRenamed("norm", "runs").withColumnRenamed("row", "n_words")
    out = periodic_runs.collapse_runs(clash)
    assert out.columns == ["doc_id", "n_words", "runs", "strongest", "text"] and out.count() == clash.count()
    assert periodic_runs.collapse_runs(docs.where("false")).count() == 0
    with pytest.raises(ValueError):
        periodic_runs.collapse_runs(docs, exponent=1)
