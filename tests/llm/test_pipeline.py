"""The pipeline's stages against plain loops, each on its own input."""

import hashlib
import math

import corpus_pipeline
import public_tokenizers
import pytest
from guardlake.llm.queries import SOURCE_WEIGHTS
from tokenizers import Tokenizer

from tests.llm.cases import AWKWARD, documents, prose
from tests.llm.test_dedup_mixing_topk import lowered
from tests.llm.test_jaccard import brute


def copies(rows):
    """Copies of each document by its source's rate."""
    n = {s: sum(r.source == s for r in rows) for s in SOURCE_WEIGHTS}
    weight = sum(w for s, w in SOURCE_WEIGHTS.items() if n[s])
    total = sum(n.values())
    for r in rows:
        u = int(hashlib.md5(f"42:{'' if r.doc_id is None else r.doc_id}".encode()).hexdigest()[:13], 16) / 16**13
        if r.source not in SOURCE_WEIGHTS:
            yield r.doc_id, 1
            continue
        mean = SOURCE_WEIGHTS[r.source] / weight * total / n[r.source]
        k, term = 0, math.exp(-mean)
        upto = term
        while u >= upto:
            k += 1
            term *= mean / k
            upto += term
        yield r.doc_id, k


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").cache()
    found = [docs]
    for _, stage in corpus_pipeline.STAGES:
        found.append(stage(spark, found[-1], sf_dir).cache())
    return found


def test_stages_in_order(stages, spark, sf_dir):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == [
        "quality classifier", "exact dedup", "n-gram Jaccard join", "mixing sources to target weights", "BPE encoding and decoding"
    ]
    assert all(s.columns == stages[0].columns for s in stages[:-1])


def test_classifier_keeps_good_documents_and_drops_bad_ones(stages, spark, sf_dir):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    left = {r.doc_id for r in stages[1].collect()}
    good = [i for i, q in labels.items() if q == 1]
    bad = [i for i, q in labels.items() if q == 0]
    assert sum(i in left for i in good) >= 0.98 * len(good)
    assert sum(i in left for i in bad) <= 0.2 * len(bad)


def test_exact_copies(stages):
    first = {}
    for r in stages[1].collect():
        t = lowered(r.text)
        first[t] = min(first.get(t, r.doc_id), r.doc_id)
    assert sorted(r.doc_id for r in stages[2].collect()) == sorted(first.values())


def test_near_copies(stages):
    linked = brute([(r.doc_id, r.text) for r in stages[2].collect()], 5, 80)
    assert sorted(r.doc_id for r in stages[3].collect()) == sorted(d for d, _, c in linked if c == d)


def test_mixing(stages):
    want = sorted(d for d, k in copies(stages[3].collect()) for _ in range(k))
    assert sorted(r.doc_id for r in stages[4].collect()) == want


def test_tokens(stages, spark, sf_dir):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = sorted((r.doc_id, tokenizer.encode(r.text, add_special_tokens=False).ids) for r in stages[4].collect())
    assert sorted((r.doc_id, list(r.ids)) for r in stages[5].collect()) == want
    assert sorted((r.doc_id, list(r.ids)) for r in corpus_pipeline.run(spark, sf_dir).collect()) == want


def test_awkward_rows_pass_every_stage(spark, sf_dir, tmp_path):
    import random

    rng = random.Random(2)
    docs = documents(spark, AWKWARD * 2 + [prose(rng, 50)] * 4)
    docs = docs.unionByName(docs.selectExpr("null doc_id", "text", "lang", "null source", *docs.columns[4:]))
    for name, stage in corpus_pipeline.STAGES:
        for some in (docs, docs.where("false")):
            out = stage(spark, some, sf_dir)
            out.count()
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == docs.columns
