"""Quality scores: held-out accuracy and awkward rows."""

import zlib

import numpy as np
from guardlake.llm import quality
from guardlake.llm import queries as llm

from tests.llm.cases import AWKWARD, documents


def test_held_out_labels_are_predicted(spark, sf_dir):
    scored = {r.doc_id: r for r in llm.op10_quality(spark, sf_dir).collect()}
    assert len(scored) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    held = [i for i in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(scored[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i in scored)
    right = np.mean([(scored[i].score >= 0.3) == labels[i] for i in held])
    assert right > 0.9


def test_scores_are_those_of_single_texts():
    texts = ["One two three.", "", "XX!! YY!! ZZ!!", "a | b | c"] * 20
    rows = np.concatenate([quality.terms(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t)])) for t in texts])
    data, bounds = np.frombuffer("".join(texts).encode(), np.uint8), np.cumsum([0, *map(len, texts)])
    assert np.allclose(rows, quality.terms(data, bounds), atol=1e-6)
    voter = quality.Voter(rows, np.array([1, 1, 0, 0] * 20), neighbours=8)
    scores = voter.score(rows)
    unit = voter.vectors.astype(float)
    for i, row in enumerate(unit):
        cosines = unit @ row
        near = np.argsort(-cosines, kind="stable")[:8]
        want = np.average(voter.labels[near], weights=np.maximum(cosines[near], 1e-6) ** 8)
        assert abs(want - scores[i]) < 0.3 and 0 <= scores[i] <= 1


def test_awkward_rows(spark):
    docs = documents(spark, AWKWARD + ["good text here"] * 6).withColumnRenamed("hash", "score")
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)] + [(3, None), (None, 1), (5, 1)], "doc_id long, quality int")
    scored, name = quality.score_documents(docs, quality.fit(docs, labels, references=8))
    assert scored.columns == [*docs.columns, name]
    got = {r.doc_id: r[name] for r in scored.collect()}
    assert len(got) == docs.count() and all(0 <= x <= 1 for x in got.values()) and got[0] == got[1]
    none, name = quality.score_documents(docs, quality.fit(docs, labels.where("false")))
    assert {r[name] for r in none.collect()} == {0.5}
    empty, _ = quality.score_documents(docs.where("false"), quality.fit(docs.where("false"), labels))
    assert empty.count() == 0
