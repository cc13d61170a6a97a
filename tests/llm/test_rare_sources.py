"""Mixing with sources so rare that their documents come many hundred times."""

import hashlib
from decimal import Decimal, getcontext

import pytest
from guardlake.llm import mixing


def inverse(mean, u):
    """Count and distribution by terms of 60 digits."""
    getcontext().prec = 60
    term = upto = (-Decimal(mean)).exp()
    k = 0
    while Decimal(u) >= upto:
        k += 1
        term *= Decimal(mean) / k
        upto += term
    return k


@pytest.mark.parametrize("mean", [0.0, 3.5, 499.0, 500.5, 2400.0, 90_000.0])
def test_poisson_window(mean):
    first, steps = mixing.poisson_window(mean)
    assert steps == sorted(steps) and abs(steps[-1] - 1) < 1e-12 and (first == 0 or steps[0] < 2.0**-52)
    for u in (0.001, 0.25, 0.5, 0.75, 0.999):
        assert first + sum(x <= u for x in steps) == inverse(mean, u)


def test_rare_source_is_repeated_in_full(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 100)
    rows = [(i, f"t{i}", "hot") for i in range(6000)] + [(6000, "r", "rare"), (6001, "s", "rare"), (None, "free", None), (6002, "", "free")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    weights = {"hot": 1.0, "rare": 1.0}
    rate = mixing.repetition_rates(docs, weights)["rare"]
    assert rate > 1500
    mixed = mixing.mix_sources(docs, weights)
    got = [(r.row.doc_id, r.copy, r.place) for r in mixed.collect()]
    assert [p for *_, p in got] == sorted(p for *_, p in got)
    for i in (6000, 6001):
        u = int(hashlib.md5(f"42:{i}".encode()).hexdigest()[:13], 16) / 16**13
        assert sorted(c for d, c, _ in got if d == i) == list(range(1, inverse(rate, u) + 1))
    digest = lambda c: int(hashlib.md5(f"42-place:6000:{c}".encode()).hexdigest()[:13], 16) / 16**13
    assert all(p == digest(c) for d, c, p in got if d == 6000)
    assert sum(d is None for d, *_ in got) == sum(d == 6002 for d, *_ in got) == 1
    again = [(r.row.doc_id, r.copy, r.place) for r in mixing.mix_sources(docs.repartition(7), weights, partitions=3).collect()]
    assert sorted(map(str, again)) == sorted(map(str, got))
