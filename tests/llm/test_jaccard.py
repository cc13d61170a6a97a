"""Jaccard join and components against brute force."""

import random
import re

import numpy as np
import pytest
from guardlake.llm import components, jaccard_join
from guardlake.llm import queries as llm
from guardlake.session import scratch_folder

from tests.llm.cases import AWKWARD, documents, prose


def shingles(text, width):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0d]+", text)
    if not words:
        return set()
    if len(words) < width:
        return {tuple(words)}
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def brute(rows, width, percent):
    sets = [shingles(t, width) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    order = sorted(range(len(rows)), key=lambda i: len(sets[i]))
    for x, i in enumerate(order):
        for j in order[x + 1 :]:
            if len(sets[j]) * percent > 100 * len(sets[i]):
                break
            if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    best = {}
    for i, (doc, _) in enumerate(rows):
        r = find(i)
        best[r] = doc if best.get(r) is None else best[r] if doc is None else min(best[r], doc)
    return sorted(((d, len(s), best[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def edited(rng, text, n):
    words = text.split(" ")
    for _ in range(n):
        words[rng.randrange(len(words))] = rng.choice(["edit", "other", "word"]) + str(rng.randrange(99))
    return " ".join(words)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(11)
    made = list(AWKWARD)
    for size in (1, 2, 3, 4, 9, 10, 11, 19, 20, 21, 40, 63, 64, 66, 127, 129, 250, 700):
        base = prose(rng, size)
        made += [base, base.upper(), base] + [edited(rng, base, k) for k in (1, 1, 1, 2, 3, 4, 6, 9)]
        made += [base + " " + prose(rng, max(1, size // 12)) for _ in range(3)]
    chain = prose(rng, 300)
    for _ in range(40):  # each near the one before, the ends far apart
        chain = edited(rng, chain, 3)
        made.append(chain)
    rng.shuffle(made)
    return made


@pytest.mark.parametrize("width,percent,tile", [(3, 90, 2048), (5, 80, 2048), (3, 90, 7), (5, 80, 11)])
def test_link_documents(spark, texts, monkeypatch, width, percent, tile):
    monkeypatch.setattr(jaccard_join, "TILE_SETS", tile)
    docs = documents(spark, texts).repartition(5).withColumnRenamed("hash", "node").withColumnRenamed("row", "tile")
    docs = docs.unionByName(docs.where("doc_id < 9").selectExpr("null doc_id", *docs.columns[1:])).unionByName(docs.where("doc_id = 12"))
    docs = docs.unionByName(docs.where("doc_id = 13").selectExpr("12 as doc_id", *docs.columns[1:]))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = sorted(map(tuple, jaccard_join.link_documents(docs, width, percent).collect()), key=str)
    assert got == brute(rows, width, percent)


@pytest.mark.parametrize("percent", [60, 80, 90, 100])
def test_linked_sets_share_a_key(percent):
    rng = np.random.default_rng(percent)
    threshold = jaccard_join.Threshold(percent)
    for _ in range(400):
        size = int(rng.integers(1, 300))
        a = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
        b = a.copy()
        for _ in range(int(rng.integers(0, 1 + threshold.difference(2 * size) + 1))):
            if rng.random() < 0.5 and len(b) > 1:
                b = np.delete(b, rng.integers(len(b)))
            else:
                b = np.unique(np.append(b, rng.integers(0, 1 << 63, dtype=np.uint64)))
        both = len(np.intersect1d(a, b))
        if 100 * both >= percent * (len(a) + len(b) - both):
            # Any numbers of occurrences will do that are alike in both sets and above 1 for common elements.
            every = np.union1d(a, b)
            times = rng.integers(1, 9, len(every)).astype(np.uint8)
            times[np.isin(every, a) & np.isin(every, b)] += 1
            one, two = (jaccard_join.tile_keys(x, np.array([0, len(x)]), times[np.searchsorted(every, x)], threshold)[1] for x in (a, b))
            assert np.isin(one, two).any(), (len(a), len(b), both)


def test_elements_of_one_set_are_no_keys():
    rng = np.random.default_rng(4)
    values = np.unique(rng.integers(0, 1 << 63, 200, dtype=np.uint64))
    bounds, threshold = np.array([0, 120, 120, len(values)]), jaccard_join.Threshold(80)
    assert len(jaccard_join.tile_keys(values, bounds, np.ones(len(values), np.uint8), threshold)[1]) == 0
    # 25 of 120 elements are enough, and 24 of them are this set's alone.
    times = np.full(len(values), 9, np.uint8)
    times[:24] = 1
    sets, _ = jaccard_join.tile_keys(values, bounds, times, threshold)
    assert (sets == 0).sum() in (1, 2)


def test_common_passages_make_no_candidates(spark):
    rng = random.Random(7)
    shared = " ".join(f"common{i}" for i in range(60))
    texts = [" ".join([shared, *(f"own{i}x{rng.random()}" for _ in range(60))]) for i in range(80)]
    texts += [texts[0] + " more", shared]
    docs = documents(spark, texts)
    edges = jaccard_join.candidate_edges(docs, 5, jaccard_join.Threshold(80)).collect()
    assert len({x for e in edges for x in (bytes(e.a), bytes(e.b)) if e.a != e.b}) == 2


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 60) if i % 7] + [(100, x) for x in range(101, 180)] + [(5, 5)]
    edges += [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)]
    label = {}
    for a, b in edges:
        if a != b:
            label.setdefault(a, a), label.setdefault(b, b)
    for _ in label:
        for a, b in edges:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    frame = spark.createDataFrame(edges, "a long, b long")
    got = components.components(frame, scratch_folder(spark, "components")).collect()
    assert sorted(map(tuple, got)) == sorted(label.items())
    assert components.components(frame.where("false"), scratch_folder(spark, "components")).count() == 0


def test_empty_table(spark):
    assert jaccard_join.link_documents(documents(spark, ["a"]).where("false")).count() == 0


def test_query_against_brute_force(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert sorted(map(tuple, llm.op8_jaccard_join(spark, sf_dir).collect()), key=str) == brute(rows, 3, 90)
