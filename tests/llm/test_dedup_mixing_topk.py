"""Exact dedup, mixing and top-k search against plain loops."""

import hashlib
import math
import random

import numpy as np
import pytest
from guardlake.llm import exact_dedup, mixing, topk

from tests.llm.cases import AWKWARD, documents, prose


def lowered(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


@pytest.mark.parametrize("keep,partitions", [("largest", 3), ("smallest", 40)])
def test_exact_dedup(spark, keep, partitions):
    rng = random.Random(5)
    base = [prose(rng, n) for n in (1, 5, 30, 2000)]
    texts = AWKWARD + base * 4 + [base[2].upper(), "É", "é"] + ["Hot text"] * 700 + [base[1].title()] * 3
    docs = documents(spark, texts, norm="clash")
    docs = docs.unionByName(docs.where("doc_id = 3")).unionByName(docs.where("doc_id in (4, 20)").selectExpr("null doc_id", *docs.columns[1:]))
    rows = [(r.doc_id, lowered(r.text)) for r in docs.collect()]
    ids, sizes = {}, {}
    for i, t in rows:
        ids.setdefault(t, []).append(i)
        sizes[t] = sizes.get(t, 0) + 1
    pick = max if keep == "largest" else min
    best = {t: pick([i for i in found if i is not None], default=None) for t, found in ids.items()}
    got = exact_dedup.mark_copies(docs, keep=keep, partitions=partitions).collect()
    assert len(got) == len(rows)
    kept = {}
    for r in got:
        t = lowered(r.row.text)
        assert (r.keep_id, r.group_size) == (best[t], sizes[t])
        assert r.text_sha256 == hashlib.sha256(t.encode()).hexdigest()
        if r.kept:
            kept.setdefault(t, []).append(r.id)
    assert kept == {t: [i] for t, i in best.items()}
    left = exact_dedup.drop_copies(docs, keep=keep)
    assert left.columns == docs.columns and left.count() == len(ids)
    assert exact_dedup.mark_copies(docs.where("false")).count() == 0


def test_poisson_steps():
    for mean in (0.0, 0.3, 4.0, 90.0):
        steps = mixing.poisson_steps(mean)
        assert steps == sorted(steps) and abs(steps[-1] - 1) < 1e-12
        drawn = np.searchsorted(steps, (np.arange(20_000) + 0.5) / 20_000, "right")
        assert abs(drawn.mean() - mean) < 0.02 + mean / 500
    with pytest.raises(ValueError):
        mixing.poisson_steps(1e6)


def test_mixing(spark):
    rows = [(i, f"t{i}", "hot" if i % 3 else "rare") for i in range(6000)] + [(None, None, None), (6000, "", "free"), (1, "t1", "hot")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("copies", docs_copies())
    weights = {"hot": 1.0, "rare": 3.0, "absent": 9.0}
    mixed = mixing.mix_sources(docs, weights).collect()
    again = mixing.mix_sources(docs.repartition(7), weights, partitions=5).collect()
    key = sorted((str(r.row.doc_id), r.copy, r.place) for r in mixed)
    assert key == sorted((str(r.row.doc_id), r.copy, r.place) for r in again)
    assert [r.place for r in mixed] == sorted(r.place for r in mixed)
    sources = [r.row.source for r in mixed]
    assert abs(sources.count("rare") / 4500 - 1) < 0.06 and abs(sources.count("hot") / 1500 - 1) < 0.1
    assert sources.count(None) == sources.count("free") == 1
    digest = lambda i: int(hashlib.md5(f"42:{i}".encode()).hexdigest()[:13], 16) / 16**13
    rate = mixing.repetition_rates(docs, weights)["rare"]
    for i in range(0, 300, 3):
        want, u, upto, term = 0, digest(i), math.exp(-rate), math.exp(-rate)
        while u >= upto:
            want += 1
            term *= rate / want
            upto += term
        assert sum(r.row.doc_id == i for r in mixed) == want
    assert mixing.mixed_documents(docs, weights).columns == docs.columns
    assert mixing.mixed_documents(docs.where("false"), weights).count() == 0
    assert mixing.mixed_documents(docs, {}).count() == docs.count()
    assert {r.source for r in mixing.mixed_documents(docs, {"hot": 0.0, "rare": 1.0}).collect()} == {"rare", "free", None}


def docs_copies():
    from pyspark.sql import functions as F

    return F.lit("x")


def brute(rows, wanted, k):
    """Rows (query_id, rank, vec_id, score); every row but the query's own takes part."""
    found = []
    for q, (query_id, query) in enumerate(rows):
        if wanted(query_id):
            scores = sorted((-sum(a * b for a, b in zip(query, v)), i) for r, (i, v) in enumerate(rows) if r != q)
            found += [(query_id, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(found)


def test_top_k(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(int(i), [float(np.float32(x)) for x in rng.integers(-3, 4, 5) / 1024]) for i in range(0, 900, 3)]
    odd = [(901, None), (902, [1.0, None]), (903, [float("nan")]), (904, [float("inf")]), (905, []), (None, [1.0]), (906, [0.5]), (3, rows[1][1]), (300, [0.25] * 5), (300, [0.25] * 5)]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>").selectExpr("*", "1 as id", "2 as q")
    vectors = topk.integer_vectors(table)
    whole = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows + odd if i is not None and i not in (901, 902, 903, 904)]
    assert sorted((r.id, list(r.vector)) for r in vectors.collect()) == sorted(whole)
    for sizes in ((1024, 8192), (4, 50)):
        monkeypatch.setattr(topk, "QUERY_BLOCK", sizes[0])
        monkeypatch.setattr(topk, "CANDIDATE_BLOCK", sizes[1])
        got = topk.top_k(vectors, vectors.where("id % 100 = 0 or id > 900"), 7).collect()
        assert sorted(map(tuple, got)) == brute(whole, lambda i: i % 100 == 0 or i > 900, 7)
    few = vectors.where("id < 9")
    assert sorted(map(tuple, topk.top_k(few, few, 10).collect())) == brute([r for r in whole if r[0] < 9], lambda i: True, 10)
    assert topk.top_k(few.where("false"), few, 3).count() == topk.top_k(few, few.where("false"), 3).count() == 0
