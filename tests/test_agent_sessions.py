"""Session operators against plain folds on random sessions, hot ones split."""

import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from guardlake.operators import agent_sessions as agent
from guardlake.schemas import DIM_COLUMNS, VIOLATION
from tests.folds import accept, patterns, trend

T0 = datetime(2024, 1, 1)
AS_OF = datetime(2025, 1, 1)
SCHEMA = (
    "session_id bigint, call_id bigint, ts timestamp_ntz, tool_name string, score double, decision string, "
    f"pii_fields array<string>, violations array<{VIOLATION}>, credits double, "
    + ", ".join(f"{c} double" for c in DIM_COLUMNS)
)


def sessions(seed, lengths):
    rnd = random.Random(seed)
    out, call_id = {}, 0
    for session, length in enumerate(lengths):
        ts, calls = 0, []
        for _ in range(length):
            ts += rnd.choice([0, 1, 30, 600]) * 1_000_000
            call_id += 1
            calls.append(
                {
                    "call_id": call_id,
                    "ts": ts,
                    "tool": rnd.choice("abc"),
                    "score": rnd.randrange(101) / 10,
                    "decision": rnd.choice(["FLAG", "FLAG", "FLAG", "ALLOW", "BLOCK"]),
                    "pii": rnd.random() < 0.2,
                    "violation": rnd.choice([None, None, None, "v1", "v2", "v3", "v4", "v5"]),
                    "critical": rnd.random() < 0.03,
                    "d_safety": rnd.choice([None, rnd.randrange(101) / 10]),
                    "d_privacy": rnd.randrange(101) / 10,
                }
            )
        out[session] = calls
    return out


def frame(spark, by_session):
    rows = []
    for session, calls in by_session.items():
        for c in calls:
            violations = []
            if c["violation"]:
                violations.append(("gdpr", c["violation"], "", "medium", "", ""))
            if c["critical"]:
                violations.append(("gdpr", c["violation"] or "v1", "", "critical", "", ""))
                c["violation"] = c["violation"] or "v1"
            dims = [c.get(d) for d in DIM_COLUMNS]
            rows.append(
                (session, c["call_id"], T0 + timedelta(microseconds=c["ts"]), c["tool"], c["score"], c["decision"],
                 ["x"] if c["pii"] else [], violations, 0.5, *dims)
            )
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


LENGTHS = [0, 1, 2, 3, 4, 5, 5, 12, 40, 160, 30, 30, 30]


@pytest.mark.parametrize("chunk_rows", [1 << 20, 6])
@pytest.mark.parametrize("block", [True, False])
def test_acceptance_and_mode(spark, chunk_rows, block):
    data = sessions(7, LENGTHS)
    calls = frame(spark, data)
    attempts = agent.accept_calls(
        calls, max_calls=25, ttl_minutes=100, block_after_critical=block, chunk_rows=chunk_rows
    )
    got = {r.call_id: (r.accepted, r.reject_reason) for r in attempts.collect()}
    by_session = {r.session_id: r for r in agent.session_status(attempts).collect()}
    status = {c[0]["call_id"]: by_session[s] for s, c in data.items() if c}
    for calls_of in data.values():
        want, closed_at = accept(calls_of, 25, 100 * 60_000_000, block)
        if calls_of:
            session = status[calls_of[0]["call_id"]]
            assert session.closed_at == (None if closed_at is None else T0 + timedelta(microseconds=closed_at))
            assert session.accepted_calls == sum(ok for ok, _, _ in want)
        for call, (ok, reason, _) in zip(calls_of, want):
            assert got[call["call_id"]] == (ok, reason)
    modes = {
        r.call_id: r.mode
        for r in agent.agent_mode(calls, deep_every_n=5, escalate_after_flags=3, base_mode="basic", chunk_rows=chunk_rows).collect()
    }
    for calls_of in data.values():
        want, _ = accept(calls_of, 1 << 30, 1 << 60, False, 5, 3, "basic")
        for call, (_, _, mode) in zip(calls_of, want):
            assert modes[call["call_id"]] == mode


def test_limits_are_tested_at_the_next_attempt(spark):
    calls = frame(spark, {0: sessions(1, [5])[0]}).withColumn("violations", F.array().cast(f"array<{VIOLATION}>"))
    full = agent.session_status(agent.accept_calls(calls, max_calls=5)).first()
    assert (full.status, full.closed_at, full.accepted_calls) == ("active", None, 5)
    over = agent.session_status(agent.accept_calls(calls, max_calls=4)).first()
    assert over.status == "closed" and over.accepted_calls == 4 and over.rejected_calls == 1


@pytest.mark.parametrize("chunk_rows", [1 << 20, 5])
def test_summary_and_patterns(spark, chunk_rows):
    data = {s: c for s, c in sessions(3, LENGTHS).items() if c}
    rows = agent.risk_summary(frame(spark, data), AS_OF, chunk_rows=chunk_rows).collect()
    assert len(rows) == len(data)
    for r in rows:
        calls = data[r.session_id]
        recent = [c["score"] for c in calls[-5:]]
        assert r.total_tool_calls == len(calls)
        assert r.current_risk_score == pytest.approx(sum(recent) / len(recent))
        assert r.risk_trend == trend(calls)
        assert r.total_credits == pytest.approx(0.5 * len(calls))
        got = set()
        for p in r.patterns:
            first = p.first_seen if p.pattern == "compliance_accumulation" else (p.first_seen - T0) // timedelta(microseconds=1)
            words = p.description
            key = {
                "repeated_pii_access": lambda: int(re.search(r"in (\d+) of", words)[1]),
                "escalating_risk_scores": lambda: int(re.search(r"in (\d+) ", words)[1]),
                "blocked_retry": lambda: re.search(r'"(.*)"', words)[1],
                "compliance_accumulation": lambda: int(words.split()[0]),
                "dimension_degradation": lambda: words.split()[1],
            }[p.pattern]()
            got.add((p.pattern, first, key))
        assert got == patterns(calls, AS_OF)


def test_summary_uses_one_wide_shuffle(spark):
    """Windows and the first aggregate share one exchange by session and chunk."""
    data = sessions(2, [30, 30])
    plan = agent.risk_summary(frame(spark, data), AS_OF)._jdf.queryExecution().executedPlan().toString()
    by_chunk = [line for line in plan.splitlines() if "hashpartitioning(session_id" in line and "_chunk" in line]
    assert 1 <= len(by_chunk) <= 2  # the second belongs to the branch for split sessions
