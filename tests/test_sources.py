"""Decoders, encoders and sinks on literal rows."""

import json

from pyspark.sql import functions as F

from guardlake.schemas import DIM_COLUMNS, EVALUATION
from guardlake.sources import decode, encode, sinks


def docs(spark, *objects):
    rows = [(i, o if isinstance(o, str) or o is None else json.dumps(o)) for i, o in enumerate(objects)]
    return spark.createDataFrame(rows, "id int, json string")


def rows(df):
    return df.orderBy("id").collect()


def test_evaluation(spark):
    full = {
        "rail_score": {"score": 8.5, "confidence": 0.9, "summary": "fine"},
        "explanation": "why",
        "dimension_scores": {"safety": {"score": 9, "confidence": 0.9, "issues": ["i"]}, "other": {"score": 1}},
        "issues": [{"dimension": "safety", "description": "d"}],
        "from_cache": True,
    }
    out = rows(decode.decode_evaluation(docs(spark, full, "broken{", None), "json"))
    r = out[0]
    assert (r.score, r.confidence, r.summary, r.d_safety, r.d_privacy, r.from_cache, r.malformed) == (8.5, 0.9, "fine", 9.0, None, True, False)
    assert set(r.dimension_scores) == {"safety", "other"} and r.issues[0].description == "d"
    assert out[1].malformed and out[2].malformed and out[1].score is None


def test_json_lines_keep_bad_rows(spark, tmp_path):
    path = tmp_path / "log.jsonl"
    path.write_text('{"rail_score":{"score":1.5},"from_cache":false}\nnot json\n')
    out = decode.read_json_log(spark, str(path), EVALUATION).cache()
    assert out.where("_corrupt_record is not null").count() == 1
    assert out.where("_corrupt_record is null").first()["rail_score"].score == 1.5


def test_agent_decision_defaults(spark):
    full = {
        "decision": "FLAG", "decision_reason": "r", "event_id": "e", "rail_score": {"score": 5, "confidence": 0.5, "summary": "s"},
        "dimension_scores": {"safety": {"score": 4}}, "compliance_violations": [{"framework": "gdpr", "severity": "high"}],
        "policy": {"threshold_used": {"block_below": 3}}, "context_signals": {"tool_risk_level": "high", "pii_fields_detected": ["ssn"]},
        "suggested_params": {"a": {"b": 1}}, "credits_consumed": 1.5,
    }
    r, empty = rows(decode.decode_agent_decision(docs(spark, full, {}), "json"))
    assert (r.decision, r.score, r.credits, json.loads(r.suggested_params)) == ("FLAG", 5.0, 1.5, {"a": {"b": 1}})
    assert (r.violations[0].framework, r.violations[0].article, r.violations[0].severity) == ("gdpr", "", "high")
    assert (r.policy.block_below, r.policy.flag_below, r.policy.source, r.policy.applied_rule) == (3.0, None, "system_default", "")
    assert r.signals.pii_fields_detected == ["ssn"] and r.signals.proxy_variables_detected == []
    assert (empty.decision, empty.decision_reason, empty.score, empty.confidence, empty.summary) == (None, "", 0.0, 0.0, "")
    assert (empty.dimension_scores, empty.violations, empty.policy, empty.suggested_params, empty.credits) == ({}, [], None, None, 0.0)
    assert (empty.signals.tool_risk_level, empty.signals.high_stakes_domain) == ("", False)


def test_tool_result_and_injection_defaults(spark):
    full = {"pii_detected": {"found": True, "entities": [{"type": "email", "offset": 3}], "redacted_result": "x"}, "rail_score": {"score": 2, "confidence": 1}}
    r, empty = rows(decode.decode_tool_result(docs(spark, full, {}), "json"))
    assert (r.pii_found, r.entities[0].type, r.entities[0].value, r.entities[0].offset, r.entities[0].should_redact) == (True, "email", "", 3, False)
    assert (r.redacted_result, r.score) == ("x", 2.0)
    assert (empty.risk_level, empty.recommended_action, empty.pii_found, empty.entities, empty.score) == ("low", "PASS", False, [], None)
    assert (empty.redacted_result, empty.compliance_flags, empty.injection_detected, empty.redacted_available) == (None, [], False, False)
    i = rows(decode.decode_injection(docs(spark, {}, {"severity": "high", "attack_type": "jailbreak"}), "json"))
    assert (i[0].attack_type, i[0].severity, i[0].recommended_action, i[0].injection_detected) == ("none", "none", "PASS", False)
    assert (i[1].attack_type, i[1].severity) == ("jailbreak", "high")


def test_plan_step_and_profile(spark):
    s = rows(decode.decode_plan_step(docs(spark, {"decision": "BLOCK"}, {"rail_score": {"score": 4}}), "json"))
    assert [(r.decision, r.score, r.step_index, r.violations) for r in s] == [("BLOCK", 0.0, 0, []), (None, 4.0, 0, [])]
    p = rows(decode.decode_tool_profile(docs(spark, {"tool_name": "t", "thresholds": {"dimension_minimums": {"safety": 5}}}, {}), "json"))
    assert (p[0].tool_name, p[0].risk_level, p[0].source, p[0].thresholds.dimension_minimums) == ("t", "low", "system", {"safety": 5.0})
    assert p[1].thresholds is None and p[1].pii_fields_watch is None and p[1].tool_name == ""


def test_compliance_and_regeneration(spark):
    one = {"framework": "gdpr", "compliance_score": {"score": 6.5, "label": "Good"}, "requirements": [{"requirement_id": "r1", "status": "passed"}, {"requirement_id": "r2"}], "issues": []}
    out = decode.decode_compliance(docs(spark, one), "json")
    assert out.first().compliance_score.score == 6.5
    assert [r.requirement_id for r in decode.explode_requirements(out, "id", "framework").collect()] == ["r1", "r2"]
    assert decode.explode_issues(out, "id").first().severity is None
    multi = {"results": {"gdpr": one, "ccpa": {"framework": "ccpa"}}, "cross_framework_summary": {"frameworks_evaluated": 2, "weakest_framework": "gdpr", "weakest_score": 6.5}}
    rows_ = decode.decode_multi_compliance(docs(spark, multi), "json").orderBy("framework_key").collect()
    assert [(r.framework_key, r.framework, r.summary.weakest_score) for r in rows_] == [("ccpa", "ccpa", 6.5), ("gdpr", "gdpr", 6.5)]
    regen = {"status": "passed", "best_iteration": 2, "iteration_history": [{"iteration": 1, "thresholds_met": False, "improvement_from_previous": None}, {"iteration": 2, "improvement_from_previous": 1.5, "scores": {"a": 1}}]}
    out = decode.decode_regeneration(docs(spark, regen), "json")
    its = decode.explode_iterations(out, "id").orderBy("position").collect()
    assert [(r.iteration, r.improvement_from_previous) for r in its] == [(1, None), (2, 1.5)] and json.loads(its[1].scores) == {"a": 1}


def test_answers(spark):
    def got(vendor, *objects):
        out = rows(decode.extract_llm_response(docs(spark, *objects), "json", vendor))
        return [(r.content, r.prompt_tokens, r.completion_tokens, r.total_tokens) for r in out]

    assert got("choices", {"choices": [{"message": {"content": "hi"}}], "usage": {"prompt_tokens": 1, "completion_tokens": 2, "total_tokens": 9}}, {"choices": []}, {}) == [
        ("hi", 1, 2, 9), ("", 0, 0, 0), ("", 0, 0, 0),
    ]
    assert got("blocks", {"content": [{"type": "text", "text": "a"}, {"type": "tool_use", "text": "x"}, {"type": "text", "text": "b"}], "usage": {"input_tokens": 3, "output_tokens": 4}}, {"content": "odd"}) == [
        ("ab", 3, 4, 7), ("", 0, 0, 0),
    ]
    part = [{"content": {"parts": [{"text": "t"}, {"text": "u"}]}}]
    assert got("candidates", {"response": {"candidates": part, "usageMetadata": {"promptTokenCount": 5}}}, {"candidates": part, "usageMetadata": {"candidatesTokenCount": 6}}, {}) == [
        ("t", 5, 0, 5), ("t", 0, 6, 6), ("", 0, 0, 0),
    ]


def test_encode(spark):
    df = spark.createDataFrame(
        [("c1", "", None, {"safety": 50.0}, False), ("c2", "deep", [], None, None)],
        "content string, mode string, dimensions array<string>, weights map<string,double>, include_issues boolean",
    )
    assert [r.body for r in encode.encode_requests(df, "eval").orderBy("content").collect()] == [
        '{"content":"c1","weights":{"safety":50.0},"include_issues":false}',
        '{"content":"c2","mode":"deep","dimensions":[]}',
    ]
    df = spark.createDataFrame([("c", "ai_act", ["dpdp"]), ("c", None, ["dpdp", "gdpr"])], "content string, framework string, frameworks array<string>")
    assert sorted(r.body for r in encode.encode_requests(df, "compliance/check").collect()) == [
        '{"content":"c","framework":"eu_ai_act"}', '{"content":"c","frameworks":["india_dpdp","gdpr"]}',
    ]


def scored(spark):
    dims = {"safety": 3.0, "privacy": 7.0, "fairness": 6.9}
    row = ("t1", 8.5, 0.9, True, "note", "x" * 300, *[dims.get(c[2:]) for c in DIM_COLUMNS])
    return spark.createDataFrame([row], "id string, score double, confidence double, met boolean, note string, text string, " + ", ".join(f"{c} double" for c in DIM_COLUMNS)).withColumns(
        {"ts": F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00")), "why": F.create_map(F.lit("safety"), F.lit("bad"))}
    )


def test_fanout(spark):
    df = scored(spark)
    assert sinks.score_fanout(df, "id").count() == 5
    out = {r.name: (r.value, r.comment) for r in sinks.score_fanout(df, "id", threshold_met_col="met", comment_col="note", explanations_col="why").collect()}
    assert out == {
        "rail_score": (8.5, "note"), "rail_confidence": (0.9, None), "rail_threshold_met": (1.0, None),
        "rail_safety": (3.0, "bad"), "rail_privacy": (7.0, None), "rail_fairness": (6.9, None),
    }


def test_review_queue(spark, tmp_path):
    items = sinks.review_items(scored(spark), "id", "text", org="o", explanations_col="why")
    got = items.orderBy("dimension").collect()
    assert [(r.dimension, r.score, r.threshold) for r in got] == [("fairness", 6.9, 7.0), ("safety", 3.0, 7.0)]
    assert all(len(r.content_preview) == 200 and r.environment == "production" and len(r.item_id) == 16 for r in got)
    assert got[1].explanation == "bad" and got[0].item_id != got[1].item_id
    assert {r.dimension: r["items"] for r in sinks.queue_sizes(items).collect()} == {"safety": 1, "fairness": 1}
    assert sinks.pending(items, "safety").count() == 1
    assert sinks.drain(items, "2024-01-01 00:00:00").count() == 2
    assert sinks.pending(items, drained_at="2024-01-01 00:00:00").count() == 0
    sinks.append_parquet(items, str(tmp_path / "q"))
    sinks.append_parquet(items, str(tmp_path / "q"))
    assert spark.read.parquet(str(tmp_path / "q")).count() == 4


def test_incidents(spark):
    df = scored(spark).withColumns(
        {"kind": F.lit("breach"), "sev": F.lit("high"), "dims": F.array(F.lit("safety")), "min": F.lit(7.0), "meta": F.create_map(F.lit("team"), F.lit("x"))}
    )
    cols = dict(id_col="id", type_col="kind", severity_col="sev", title_col="note", dimensions_col="dims", threshold_col="min")
    record = json.loads(sinks.incidents(df, metadata_col="meta", **cols).first().record)
    assert record["incident_id"] == "t1" and record["status"] == "open" and record["team"] == "x" and record["affected_dimensions"] == ["safety"]
    assert "team" not in json.loads(sinks.incidents(df, **cols).first().record)
