"""Ranked search against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
from guardlake.llm import best_positions
from guardlake.llm import queries as llm

from tests.llm.cases import AWKWARD, documents, prose


def terms_of(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)


def brute(docs, items, k=10):
    """Rows (item_id, rank, doc_id, score)."""
    counts = [(i, Counter(terms_of(t))) for i, t in docs]
    counts = [(i, c, sum(c.values())) for i, c in counts if c]
    n_docs, total = len(counts), sum(n for _, _, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    rows = []
    for item, text in items:
        scored = []
        for doc_id, c, n in counts:
            m, score = 10 + 90 * n * n_docs // total, 0
            for t in set(terms_of(text)):
                weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += weight * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        rows += [(item, r, s[3], -s[0]) for r, s in enumerate(sorted(scored)[:k], 1)]
    return rows


def test_segment_gives_the_best(monkeypatch):
    rng = np.random.default_rng(31)
    monkeypatch.setattr(best_positions, "FIRST_ROUND", 2)
    rounds = []
    unique = np.unique
    for _ in range(200):
        n, terms = int(rng.integers(1, 300)), int(rng.integers(1, 9))
        size = int(rng.integers(1, 900))
        owner, term = rng.integers(0, n, size), rng.integers(0, terms, size)
        norm = rng.choice([10, 50, 100, 400], n)
        lists = best_positions.ImpactLists(owner, term, terms, norm)
        weights = rng.choice([0, 1, 5, 9000], terms)
        tf = np.zeros((terms, n), np.int64)
        np.add.at(tf, (term, owner), 1)
        full = (weights[:, None] * (1_000_000_000 * tf // (1000 * tf + 8 * norm))).sum(0)
        k = int(rng.integers(1, 12))
        docs, scores = best_positions.best_positions(lists, unique(term), weights[unique(term)], k)
        want = sorted(((-s, i) for i, s in enumerate(full) if s > 0))[:k]
        assert sorted(zip(-scores, docs))[:k] == want
        assert (full[docs] == scores).all()
        rounds.append(len(docs))
        kth = -want[-1][0] if want else 0
        docs, scores = best_positions.best_positions(lists, unique(term), weights[unique(term)], k, kth)
        assert set(docs) == {i for i, s in enumerate(full) if s >= max(kth, 1)} or len(want) < k
    assert max(rounds) > 1


def test_stops_before_the_end_of_the_lists(monkeypatch):
    taken = []
    partition = np.partition
    monkeypatch.setattr(best_positions.np, "partition", lambda x, i: taken.append(len(x)) or partition(x, i))
    n = 5000
    owner = np.concatenate([np.repeat(np.arange(50), 40), np.arange(n), np.arange(n)])
    term = np.concatenate([np.zeros(2000, np.int64), np.zeros(n, np.int64), np.ones(n, np.int64)])
    lists = best_positions.ImpactLists(owner, term, 2, np.arange(10, n + 10))
    docs, _ = best_positions.best_positions(lists, np.array([0, 1]), np.array([900, 3]), 5)
    assert len(docs) >= 5 and sum(taken) < n


def test_awkward_rows_blocks_and_segments(spark, monkeypatch):
    rng = random.Random(32)
    texts = AWKWARD + [prose(rng, rng.randint(1, 60)) for _ in range(150)] + [prose(rng, 4000), "alpha beta " * 2000]
    texts += texts[20:60] * 3
    docs = documents(spark, texts)
    docs = docs.union(docs.selectExpr("null", *docs.columns[1:]).where("id % 7 = 0")).union(docs.where("id % 9 = 0"))
    given = [(i, prose(rng, 12)) for i in range(12)] + [(3, "Alpha BETA alpha"), (3, "kappa"), (None, "kappa"), (20, None), (21, ""), (22, "nowhere"), (23, "é étions alpha")]
    given += [(30 + i, "mu nu's") for i in range(30)]
    items = spark.createDataFrame([(*x, 1, "s") for x in given], "item_id long, text string, rank int, score string")
    rows = docs.select("doc_id", "text").collect()
    want = brute(rows, given)
    for segment, query_bytes, rows_per_batch in ((8 << 20, 4 << 20, 10_000), (300, 200, 17)):
        monkeypatch.setattr(best_positions, "SEGMENT", segment)
        monkeypatch.setattr(best_positions, "QUERY_BYTES", query_bytes)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows_per_batch)
        try:
            found = best_positions.rank_documents(docs, items)
            assert found.columns == ["item_id", "rank", "doc_id", "score"]
            assert sorted(map(tuple, found.collect()), key=str) == sorted(want, key=str)
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for d, q in ((docs.where("false"), items), (docs, items.where("false")), (docs.where("text is null"), items)):
        assert best_positions.rank_documents(d, q).count() == 0


def test_query_like_brute_force(spark, sf_dir):
    read = [spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark")]
    docs, items = read[0].select("doc_id", "text").collect(), read[1].select("item_id", "text").collect()
    assert sorted(map(tuple, llm.op13_ranked_search(spark, sf_dir).collect())) == sorted(brute(docs, items))
