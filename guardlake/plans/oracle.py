"""Equivalent SQL of the example jobs, for a second engine over the same tables."""

from guardlake.plans.queries import AS_OF, THRESHOLDS
from guardlake.schemas import DIM_COLUMNS, DIMENSIONS
from guardlake.operators.compliance import DEADLINE_DAYS, EFFORT, REQUIREMENTS

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
IPV4 = r"\b(?:[0-9]{1,3}\.){3}[0-9]{1,3}\b"
CARD = r"\b[0-9]{16}\b"
TOKEN = r'token = "[0-9a-f]{40}"'
BLANK = r"[\s\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]*"

INJECTION = {
    "direct_instruction_override": (
        r"(?i)\b(?:ignore|disregard|forget)\b[^.\n]{0,40}\b(?:previous|prior|above|earlier)\b[^.\n]{0,40}\b(?:instructions?|rules?|prompts?)\b",
        "critical",
    ),
    "data_exfiltration": (
        r"(?i)\b(?:send|post|upload|reveal|print)\b[^.\n]{0,60}\b(?:password|api key|secret|system prompt)\b",
        "critical",
    ),
    "jailbreak": (r"(?i)\b(?:jailbreak|developer mode|without any restrictions)\b", "high"),
    "role_hijack": (r"(?i)\byou are now\b|\bpretend to be\b|\bact as (?:an?|the) (?:admin|root|system)\b", "high"),
    "context_manipulation": (r"(?i)(?:^|\n)\s*(?:system|assistant)\s*:", "medium"),
}


def q(s):
    return "'" + s.replace("'", "''") + "'"


def each(template, sep=",\n  "):
    """Template once per dimension: {d} name, {c} column, {i} ordinal."""
    return sep.join(template.format(d=d, c=c, i=i) for i, (d, c) in enumerate(zip(DIMENSIONS, DIM_COLUMNS)))


def _dim(i, c):
    value = f"((k * {2 * i + 3} + event_id * {i + 1}) % 101) / 10.0"
    return f"CASE WHEN event_id % 7 <> 0 THEN {value} END AS {c}" if c == "d_user_impact" else f"{value} AS {c}"


EVENTS = "ev AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events)"
CALLS = f"""{EVENTS},
calls AS (
  SELECT user_id AS session_id, event_id AS call_id, ts, event_type AS tool_name, k, props AS params,
  k / 10.0 AS score, (50 + (k * 3 + event_id) % 51) / 100.0 AS confidence,
  {", ".join(_dim(i, c) for i, c in enumerate(DIM_COLUMNS))},
  CASE WHEN k < 30 THEN 'BLOCK' WHEN k < 60 THEN 'FLAG' ELSE 'ALLOW' END AS decision,
  'rule ' || (k % 10) AS decision_reason,
  CASE WHEN k % 10 = 0 THEN ['ssn'] WHEN k % 10 = 1 THEN ['ssn', 'dob'] ELSE CAST([] AS VARCHAR[]) END AS pii_fields,
  CASE WHEN k % 25 = 0 THEN 'gdpr' WHEN k % 25 IN (1, 2) THEN 'eu_ai_act' WHEN k % 25 IN (3, 4, 5) THEN 'ccpa'
    WHEN k % 25 = 6 THEN 'hipaa' END AS v_framework,
  CASE WHEN k % 25 = 0 THEN 'Art. 5' WHEN k % 25 IN (1, 2) THEN 'Art. 10' WHEN k % 25 IN (3, 4, 5) THEN '1798.100'
    WHEN k % 25 = 6 THEN '164.312' END AS v_article,
  CASE WHEN k % 25 = 0 THEN 'critical' WHEN k % 25 IN (1, 2) THEN 'high' WHEN k % 25 IN (3, 4, 5) THEN 'medium'
    WHEN k % 25 = 6 THEN 'low' END AS v_severity,
  CASE WHEN event_id % 5 = 0 THEN 1.5 ELSE 0.5 END::DOUBLE AS credits,
  CASE WHEN k < 30 AND event_id % 2 = 0 THEN '{{"k":99}}' END AS suggested_params,
  user_id || ':' || strftime(date_trunc('week', ts), '%Y-%m-%d') AS plan_id,
  row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n,
  count(*) OVER (PARTITION BY user_id) AS total
  FROM ev)"""
QUOTED = "CASE WHEN k % 3 = 0 THEN 0 ELSE {} % (SELECT max(conv_id) + 1 FROM conversations) END"
OPENINGS = "openings AS (SELECT conv_id AS quoted, arg_min(text, turn) AS opening FROM conversations GROUP BY conv_id)"
TEXT_CALLS = f"""{CALLS}, {OPENINGS},
text_calls AS (SELECT *, CASE call_id % 3 WHEN 0 THEN params WHEN 1 THEN opening END AS result FROM (
  SELECT calls.*, coalesce(opening, 'no such text') AS opening FROM calls LEFT JOIN openings ON quoted = {QUOTED.format("call_id")}))"""
TURNS = f"""turns AS (
  SELECT conv_id, turn, role, text,
  ((length(text) * 7 + turn * 13 + conv_id * 5) % 101) / 10.0 AS score,
  (50 + (length(text) + turn) % 51) / 100.0 AS confidence,
  {", ".join(f"((length(text) * {i + 2} + turn * {i + 5} + conv_id) % 101) / 10.0 AS {c}" for i, c in enumerate(DIM_COLUMNS))}
  FROM conversations)"""
CANDIDATES = f"""{TURNS},
candidates AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS iteration FROM turns WHERE role = 'assistant')"""
STEPS = f"""{CALLS},
steps AS (SELECT *, row_number() OVER (PARTITION BY plan_id ORDER BY ts, call_id) - 1 AS step_index FROM calls)"""
SCORED = f"""sig AS (
  SELECT d.doc_id, d.text, l.quality, l.toxic,
  len(regexp_extract_all(text, {q(EMAIL)})) AS n_email, len(regexp_extract_all(text, {q(IPV4)})) AS n_ip,
  len(regexp_extract_all(text, {q(CARD)})) AS n_card, len(regexp_extract_all(text, {q(TOKEN)})) AS n_token
  FROM documents d LEFT JOIN labels l USING (doc_id)),
tenths AS (
  SELECT *, CASE WHEN toxic = 1 THEN 20 WHEN toxic = 0 THEN 90 ELSE 70 END AS s_t,
  greatest(0, 100 - 25 * n_email - 15 * n_ip - 40 * n_card - 40 * n_token) AS p_t,
  CASE WHEN quality = 1 THEN 90 WHEN quality = 0 THEN 40 ELSE 60 END AS r_t,
  CASE WHEN length(text) BETWEEN 50 AND 10000 THEN 90 ELSE 50 END AS u_t,
  toxic IS NOT NULL OR quality IS NOT NULL AS labelled FROM sig),
scored AS (
  SELECT *, s_t / 10.0 AS d_safety, p_t / 10.0 AS d_privacy, r_t / 10.0 AS d_reliability,
  (s_t + p_t + r_t) / 30.0 AS score, CASE WHEN labelled THEN 9 ELSE 5 END / 10.0 AS confidence FROM tenths)"""


def _catalogue():
    rows = [
        "({})".format(
            ", ".join([q(f), q(r), q(a), "[" + ", ".join(q(x) for x in dims) + "]", q(s)])
        )
        for f, r, a, dims, s in REQUIREMENTS
    ]
    return f"catalogue(framework, requirement_id, article, dims, severity) AS (VALUES {', '.join(rows)})"


def _requirements(bar):
    dim = "CASE d WHEN 'safety' THEN d_safety WHEN 'privacy' THEN d_privacy WHEN 'reliability' THEN d_reliability END"
    wanted = "('gdpr'), ('ccpa'), ('india_dpdp'), ('eu_ai_act')"
    return f"""{SCORED}, {_catalogue()},
wanted(framework) AS (VALUES {wanted}),
src AS (
  SELECT doc_id, c.framework, requirement_id, article, dims, severity, score, d_safety, d_privacy, d_reliability, unnest(dims) AS d
  FROM scored CROSS JOIN wanted JOIN catalogue c ON c.framework = wanted.framework),
req AS (
  SELECT doc_id, framework, requirement_id, article, any_value(dims) AS dims, severity,
  coalesce(avg({dim}), any_value(score)) AS requirement_score
  FROM src GROUP BY doc_id, framework, requirement_id, article, severity),
judged AS (
  SELECT *, CASE WHEN requirement_score >= {bar} THEN 'passed' WHEN requirement_score >= {bar} - 1.0 THEN 'warned' ELSE 'failed' END AS status FROM req),
checks AS (
  SELECT doc_id, framework, round(avg(requirement_score), 8) AS compliance_score, count(*) AS requirements_checked,
  count(*) FILTER (status = 'passed') AS requirements_passed, count(*) FILTER (status = 'failed') AS requirements_failed,
  count(*) FILTER (status = 'warned') AS requirements_warned FROM judged GROUP BY doc_id, framework),
labelled_checks AS (
  SELECT *, CASE WHEN compliance_score >= 8 THEN 'Excellent' WHEN compliance_score >= 6 THEN 'Good' WHEN compliance_score >= 4 THEN 'Fair'
  WHEN compliance_score >= 2 THEN 'Poor' ELSE 'Critical' END AS label FROM checks)"""


def failed(thresholds, prefix=""):
    items = ", ".join(f"CASE WHEN {prefix}d_{d} < {float(t)} THEN '{d}' END" for d, t in thresholds.items())
    return f"list_filter([{items}], lambda x: x IS NOT NULL)"


def fixed(x, decimals):
    """Fixed-decimal text of the exact value.  printf rounds ties to even, which only multiples of a power of two meet."""
    bump = 10.0 ** -(decimals + 2)
    return f"printf('%.{decimals}f', {x} + CASE WHEN {x} * {2 ** (decimals + 1)} % 2 = 1 THEN {bump} ELSE 0 END)"


REQUESTS = f"""{EVENTS},
req AS (
  SELECT event_id AS request_id, ts,
  CASE event_type WHEN 'click' THEN 'eval' WHEN 'view' THEN 'compliance/check' WHEN 'purchase' THEN 'agent/tool-call'
    WHEN 'signup' THEN 'safe-regenerate' ELSE 'health' END AS endpoint,
  CASE WHEN k % 3 = 0 THEN 'deep' ELSE 'basic' END AS mode, k / 10.0 AS score, (50 + k % 51) / 100.0 AS confidence,
  CASE WHEN k % 3 = 0 THEN 1.5 ELSE 0.5 END::DOUBLE AS credits_consumed, k % 4 = 0 AS from_cache,
  CAST(k * 10 + event_id % 10 AS BIGINT) AS duration_ms,
  CASE WHEN k >= 90 THEN 'RateLimitError' WHEN k >= 85 THEN 'TimeoutError' END AS error_type, k
  FROM ev),
log AS (
  SELECT request_id, ts, endpoint, mode, CASE WHEN error_type IS NULL THEN score END AS score,
  CASE WHEN error_type IS NULL THEN confidence END AS confidence,
  CASE WHEN error_type IS NULL THEN credits_consumed END AS credits_consumed,
  CASE WHEN error_type IS NULL THEN from_cache END AS from_cache, duration_ms, error_type
  FROM req WHERE endpoint NOT IN ('health', 'agent/tool-call'))"""

TREND = """CASE WHEN total < 3 THEN 'stable' WHEN s0 <= 3.0 THEN 'critical' WHEN s0 < s1 AND s1 < s2 THEN 'escalating'
  WHEN s0 > s1 AND s1 > s2 THEN 'improving' ELSE 'stable' END"""
AVERAGES = each("round(avg({c}), 8) AS avg_{c}")


def _accepted(max_calls, minutes, critical):
    stop = "coalesce(c >= {m}, TRUE)".format(m=max_calls) if critical else "TRUE"
    blocked = "c IS NOT NULL" if critical else "FALSE"
    return f"""{CALLS},
timed AS (
  SELECT *, ts >= first_value(ts) OVER w + INTERVAL {minutes} MINUTE AS expired,
  min(CASE WHEN v_severity = 'critical' THEN n END) OVER (PARTITION BY session_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS c
  FROM calls WINDOW w AS (PARTITION BY session_id ORDER BY n)),
attempts AS (
  SELECT *, CASE WHEN n > {max_calls} AND {stop} THEN 'max_tool_calls'
    WHEN expired THEN 'ttl_expired' WHEN {blocked} THEN 'critical_violation' END AS reject_reason FROM timed),
final AS (SELECT *, reject_reason IS NULL AS accepted FROM attempts)"""


def _patterns(base=CALLS, calls="calls"):
    degrade = "\nUNION ALL\n".join(
        f"""SELECT session_id, 'dimension_degradation' AS pattern, 'medium' AS severity, half_ts AS first_seen,
  'Average {d} score dropped ' || {fixed('drop', 1)} || ' points over the session' AS description
  FROM (SELECT session_id, max(total) AS total, round(avg({c}) FILTER (n <= total // 2) - avg({c}) FILTER (n > total // 2), 9) AS drop,
    max(ts) FILTER (n = total // 2 + 1) AS half_ts, max(CASE WHEN n = 1 THEN {c} END) AS first_value FROM {calls} GROUP BY session_id)
  WHERE total >= 4 AND first_value IS NOT NULL AND drop >= 2.0"""
        for d, c in zip(DIMENSIONS, DIM_COLUMNS)
    )
    return f"""{base},
lagged AS (SELECT *, lag(score) OVER (PARTITION BY session_id ORDER BY n) AS prev FROM {calls}),
firsts AS (SELECT session_id, tool_name, min(n) AS b FROM {calls} WHERE decision = 'BLOCK' GROUP BY ALL)
SELECT session_id, 'repeated_pii_access' AS pattern, 'high' AS severity, min(ts) FILTER (len(pii_fields) > 0) AS first_seen,
  'Tool accessed PII fields in ' || count(*) FILTER (len(pii_fields) > 0) || ' of ' || count(*) || ' calls' AS description
FROM {calls} GROUP BY session_id HAVING count(*) FILTER (len(pii_fields) > 0) >= 3
UNION ALL
SELECT session_id, 'escalating_risk_scores', 'high', min(ts) FILTER (n = 2),
  'Score dropped in ' || count(*) FILTER (score < prev) || ' consecutive calls'
FROM lagged GROUP BY session_id HAVING count(*) >= 3 AND count(*) FILTER (score < prev) >= 3
UNION ALL
SELECT c.session_id, 'blocked_retry', 'medium', min(c.ts), 'Tool "' || c.tool_name || '" was blocked and called again'
FROM {calls} c JOIN firsts f ON c.session_id = f.session_id AND c.tool_name = f.tool_name AND c.n > f.b GROUP BY c.session_id, c.tool_name
UNION ALL
SELECT session_id, 'compliance_accumulation', 'high', TIMESTAMP '{AS_OF}',
  count(DISTINCT v_framework || ':' || v_article) || ' distinct compliance violations accumulated across the session'
FROM {calls} GROUP BY session_id HAVING count(DISTINCT v_framework || ':' || v_article) > 3
UNION ALL
{degrade}"""


def _injection(text="text"):
    """Severity-ranked first hit: list order is the tie-break within a severity."""
    order = sorted(
        enumerate(INJECTION.items()), key=lambda e: ({"critical": 0, "high": 1, "medium": 2}[e[1][1][1]], e[0])
    )
    kind = " ".join(f"WHEN regexp_matches({text}, {q(p)}) THEN {q(k)}" for _, (k, (p, _)) in order)
    sev = " ".join(f"WHEN regexp_matches({text}, {q(p)}) THEN {q(s)}" for _, (_, (p, s)) in order)
    return f"CASE {kind} ELSE 'none' END AS attack_type, CASE {sev} ELSE 'none' END AS severity"


SCAN = f"""scan AS (
  SELECT doc_id, text, {_injection()},
  regexp_matches(text, {q(TOKEN)}) AS h_secret, regexp_matches(text, {q(CARD)}) AS h_card,
  regexp_matches(text, {q(EMAIL)}) AS h_email, regexp_matches(text, {q(IPV4)}) AS h_ip,
  len(regexp_extract_all(text, {q(EMAIL)})) + len(regexp_extract_all(text, {q(IPV4)})) + len(regexp_extract_all(text, {q(CARD)}))
  + len(regexp_extract_all(text, {q(TOKEN)})) AS entities FROM documents),
judged AS (
  SELECT *, entities > 0 AS pii_found, severity IN ('high', 'critical') AS severe, attack_type <> 'none' AS injected,
  array_to_string(list_distinct_ordered, ',') AS compliance_flags FROM (
    SELECT *, list_filter([CASE WHEN h_secret THEN 'security' END, CASE WHEN h_card THEN 'pci_dss' END,
      CASE WHEN h_email OR h_ip THEN 'gdpr' END, CASE WHEN h_email THEN 'ccpa' END], lambda x: x IS NOT NULL) AS list_distinct_ordered FROM scan)),
acted AS (
  SELECT *, CASE WHEN severe THEN 'BLOCK' WHEN injected AND pii_found THEN 'REDACT_AND_FLAG' WHEN injected THEN 'FLAG'
    WHEN pii_found AND (h_secret OR h_card) THEN 'REDACT_AND_FLAG' WHEN pii_found THEN 'REDACT_AND_PASS' ELSE 'PASS' END AS recommended_action,
  CASE WHEN severity = 'critical' THEN 'critical' WHEN severe OR h_secret OR h_card THEN 'high'
    WHEN injected OR pii_found THEN 'medium' ELSE 'low' END AS risk_level FROM judged)"""


def redacted(c="text"):
    out = c
    for pattern, tag in ((TOKEN, "[SECRET]"), (CARD, "[CARD]"), (EMAIL, "[EMAIL]"), (IPV4, "[IP]")):
        out = f"regexp_replace({out}, {q(pattern)}, '{tag}', 'g')"
    return out


def _entities(kind, pattern):
    return f"""SELECT doc_id, '{kind}' AS type, m[i] AS value,
  CAST(coalesce(list_sum(list_transform(g[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS INT) AS "offset",
  TRUE AS should_redact
FROM (SELECT doc_id, m, g, unnest(range(1, len(m) + 1)) AS i FROM (
  SELECT doc_id, regexp_extract_all(text, {q(pattern)}) AS m, string_split_regex(text, {q(pattern)}) AS g FROM documents))"""


REGISTRY = """reg AS (
  SELECT replace(p_name, ' ', '_') || '_' || p_partkey AS tool_name,
  CASE WHEN p_size <= 12 THEN 'low' WHEN p_size <= 25 THEN 'medium' WHEN p_size <= 40 THEN 'high' ELSE 'critical' END AS risk_level,
  CASE WHEN p_brand LIKE 'Brand#1%' THEN 'org_custom' ELSE 'system' END AS source FROM part)"""

WEIGHTS = f"""{CALLS},
w AS (
  SELECT *, CASE WHEN k = 0 THEN 0.0 ELSE k / s END::DOUBLE AS ws, CASE WHEN k = 0 THEN 0.0 ELSE (100 - k + shift) / s END::DOUBLE AS wp
  FROM (SELECT *, CASE WHEN call_id % 3 = 0 THEN 100.0 ELSE 1.0 END::DOUBLE AS s, ((call_id % 7 - 3) / 2.0)::DOUBLE AS shift FROM calls)),
ww AS (SELECT *, ws + wp AS total_w FROM w)"""

ENTRIES = "[" + ", ".join(f"{{'s': {c}, 'i': {i}, 'd': '{d}'}}" for i, (d, c) in enumerate(zip(DIMENSIONS, DIM_COLUMNS))) + "]"
ENTRIES = f"list_filter({ENTRIES}, lambda e: e.s IS NOT NULL)"


def _tool_cases(field, default, purchase, signup=None):
    signup = default if signup is None else signup
    return f"CASE tool_name WHEN 'purchase' THEN {purchase} WHEN 'signup' THEN {signup} ELSE {default} END AS {field}"


def js(c):
    return f"CASE WHEN {c} = floor({c}) THEN CAST(CAST({c} AS BIGINT) AS VARCHAR) ELSE CAST({c} AS VARCHAR) END"


POLICY = f"""{CALLS},
lim AS (SELECT *, {_tool_cases("bb", "4.0", "6.0")}, {_tool_cases("fb", "7.0", "8.0", "9.5")},
  CASE WHEN tool_name = 'purchase' THEN {failed({"fairness": 5.0, "privacy": 5.0})} ELSE {failed({"safety": 2.0})} END AS bad FROM calls),
lim2 AS (SELECT *, bb::DOUBLE AS b, fb::DOUBLE AS f FROM lim),
j AS (SELECT *, decision = 'BLOCK' OR score < b OR len(bad) > 0 AS blocked FROM lim2),
jj AS (SELECT *, NOT blocked AND (decision = 'FLAG' OR score < f) AS flagged FROM j)"""

REGISTRY_TOOLS = """tools AS (SELECT replace(p_name, ' ', '_') || '_' || p_partkey AS tool_name,
  CASE WHEN p_size <= 12 THEN 'low' WHEN p_size <= 25 THEN 'medium' WHEN p_size <= 40 THEN 'high' ELSE 'critical' END AS risk_level,
  CASE WHEN p_brand LIKE 'Brand#1%' THEN 'org_custom' ELSE 'system' END AS source, p_type AS description FROM part)"""
SQL = {
    "score_bands": f"""WITH {CALLS} SELECT call_id,
  CASE WHEN score >= 8 THEN 'Excellent' WHEN score >= 6 THEN 'Good' WHEN score >= 4 THEN 'Fair' WHEN score >= 2 THEN 'Poor' ELSE 'Critical' END AS label,
  CASE WHEN score >= 7 THEN 'green' WHEN score >= 5 THEN 'yellow' ELSE 'red' END AS color,
  CASE WHEN score >= 9 THEN 'A' WHEN score >= 8 THEN 'A-' WHEN score >= 7 THEN 'B' WHEN score >= 6 THEN 'C' WHEN score >= 5 THEN 'D' ELSE 'F' END AS grade,
  CASE WHEN score >= 7 THEN 'low' WHEN score >= 5 THEN 'medium' WHEN score >= 3 THEN 'high' ELSE 'critical' END AS risk,
  score >= 7.0 AS passing, round(score * confidence, 8) AS weighted FROM calls""",
    "names_and_aliases": f"""WITH {CALLS}, n AS (SELECT call_id, k, score,
  [{", ".join(q(d) for d in DIMENSIONS)}, 'legal_compliance'][k % 9 + 1] AS raw,
  ['ai_act', 'euaia', 'dpdp', 'ai_governance', 'india_ai', 'gdpr', 'hipaa'][k % 7 + 1] AS fw,
  ['low', 'medium', 'high', 'critical'][k % 4 + 1] AS sev FROM calls)
SELECT call_id, CASE raw WHEN 'legal_compliance' THEN 'inclusivity' ELSE raw END AS dimension,
  array_to_string(list_transform(string_split(raw, '_'), lambda x: upper(x[1]) || x[2:]), ' ') AS display_name,
  CASE fw WHEN 'ai_act' THEN 'eu_ai_act' WHEN 'euaia' THEN 'eu_ai_act' WHEN 'dpdp' THEN 'india_dpdp' WHEN 'ai_governance' THEN 'india_ai_gov'
    WHEN 'india_ai' THEN 'india_ai_gov' ELSE fw END AS framework,
  {fixed('score', 1)} AS score_text, {fixed('score', 2)} AS score_text_2,
  CASE WHEN sev IN ('low', 'medium') THEN 'WARN' WHEN sev = 'high' THEN 'ERROR' END AS level,
  CASE WHEN k % 2 = 0 THEN 8.5 ELSE 7.0 END::DOUBLE AS threshold FROM n""",
    "content_previews": """SELECT doc_id, substring(text, 1, 200) AS preview,
  CASE WHEN length(text) > 80 THEN substring(text, 1, 80) || '…' ELSE text END AS log_preview FROM documents""",
    "weighted_and_extremes": f"""WITH {CALLS}, e AS (SELECT *, {ENTRIES} AS es FROM calls)
SELECT call_id, round(list_sum(list_transform(es, lambda x: x.s)) / len(es), 8) AS equal_weighted,
  round(d_safety * 50 + d_privacy * 50, 8) AS two_weighted,
  list_sort(es)[1].d AS lowest, list_sort(es)[1].s AS lowest_score,
  list_sort(list_transform(es, lambda x: {{'s': -x.s, 'i': x.i, 'd': x.d}}))[1].d AS highest,
  list_max(list_transform(es, lambda x: x.s)) AS highest_score,
  array_to_string(list_transform(list_sort(list_filter(es, lambda x: x.s < 7.0)), lambda x: x.d), ',') AS below FROM e""",
    "weight_normalization": f"""WITH {WEIGHTS} SELECT call_id, round(total_w, 8) AS total, abs(total_w - 100.0) <= 1.0 AS accepted,
  abs(total_w - 100.0) < 1.0 AS accepted_strict, CASE WHEN total_w <> 0 THEN round(ws / total_w, 8) END AS share_safety,
  round(CASE WHEN abs(total_w - 1.0) < 0.01 THEN ws * 100.0 ELSE ws END, 8) AS percent_safety,
  CASE WHEN total_w = 0 THEN 'weights_zero' END AS error_code FROM ww""",
    "content_validation": f"""SELECT doc_id,
  CASE WHEN regexp_full_match(text, {q(BLANK)}) THEN 'empty_content' WHEN length(text) < 10 THEN 'content_too_short' WHEN length(text) > 10000 THEN 'content_too_long' END AS error_code,
  CASE WHEN regexp_full_match(text, {q(BLANK)}) THEN 'Content cannot be empty' WHEN length(text) < 10 THEN 'Content needs at least 10 characters, has ' || length(text)
    WHEN length(text) > 10000 THEN 'Content allows at most 10000 characters, has ' || length(text) END AS error_message FROM documents""",
    "rejected_content": f"""SELECT doc_id, n_chars,
  CASE WHEN regexp_full_match(text, {q(BLANK)}) THEN 'empty_content' WHEN length(text) < 10 THEN 'content_too_short' ELSE 'content_too_long' END AS error_code
FROM documents WHERE regexp_full_match(text, {q(BLANK)}) OR length(text) NOT BETWEEN 10 AND 10000""",
    "request_validation": f"""WITH {WEIGHTS}, x AS (SELECT *, CASE WHEN k % 5 = 0 THEN 'gdpr' END AS framework,
  CASE WHEN k % 5 <> 1 THEN least(call_id % 7, 6) END AS n_frameworks FROM ww)
SELECT call_id, CASE WHEN abs(total_w - 100.0) > 1.0 THEN 'weights_sum' END AS weights_error,
  CASE WHEN framework IS NOT NULL THEN NULL WHEN n_frameworks IS NULL THEN 'framework_required' WHEN n_frameworks < 1 THEN 'frameworks_empty'
    WHEN n_frameworks > 5 THEN 'frameworks_too_many' END AS framework_error,
  CASE WHEN k % 11 = 0 THEN 'tool_name_required' WHEN k % 13 = 0 THEN 'tool_params_object' END AS tool_error,
  CASE WHEN k % 11 = 0 THEN 'tool_name_required' WHEN k % 2 <> 0 AND k % 3 <> 0 THEN 'tool_result_empty' END AS result_error,
  CASE WHEN k % 17 = 0 THEN 'session_id_required' WHEN k % 4 = 0 THEN 'empty_content' END AS continue_error,
  CASE WHEN k % 6 = 0 THEN 'unknown_mode' WHEN k % 7 = 0 THEN 'unknown_domain' WHEN k % 8 = 0 THEN 'unknown_usecase' END AS option_error,
  CASE WHEN k % 9 = 0 OR k % 10 = 0 THEN 'unknown_framework' END AS framework_name_error,
  CASE WHEN k % 6 = 0 THEN 'empty_content' WHEN k % 6 = 5 THEN 'content_too_long' END AS compliance_error FROM x""",
    "aggregate_scores": f"""WITH {CALLS} SELECT tool_name, round(avg(score), 8) AS average_score, min(score) AS min_score, max(score) AS max_score,
  count(*) AS total_evaluations, {AVERAGES} FROM calls GROUP BY tool_name""",
    "aggregate_scores_rollup": f"""WITH {CALLS} SELECT tool_name, decision, round(avg(score), 8) AS average_score, count(*) AS total_evaluations
FROM calls GROUP BY ROLLUP (tool_name, decision)""",
    "plugin_scorer": """SELECT doc_id, (length(text) % 101) / 10.0 AS score, 0.9::DOUBLE AS confidence, (length(text) % 11)::DOUBLE AS d_safety,
  NULL::DOUBLE AS d_privacy, 'deep' AS mode FROM documents""",
    "custom_callback": f"""WITH {SCORED}, f AS (SELECT *, list_filter([CASE WHEN d_privacy < 7.0 THEN 'privacy' END], lambda x: x IS NOT NULL) AS bad FROM scored)
SELECT doc_id, len(bad) = 0 AS passed, coalesce(array_to_string(bad, ','), '') AS failed,
  CASE WHEN len(bad) > 0 AND length(text) % 2 = 0 THEN nullif(text, '') END AS replacement FROM f""",
    "evaluate_documents": f"""WITH {SCORED}, v AS (SELECT lang, (70 + p_t + 60) / 30.0 AS s, d_privacy FROM scored JOIN (SELECT doc_id, lang FROM documents) USING (doc_id)
  WHERE NOT regexp_full_match(text, {q(BLANK)}) AND length(text) BETWEEN 10 AND 10000)
SELECT lang, round(avg(s), 8) AS average_score, min(s) AS min_score, count(*) AS total_evaluations, round(avg(d_privacy), 8) AS avg_d_privacy FROM v GROUP BY lang""",
    "guarded_conversations": f"""WITH n AS (SELECT *, {{penalty}} AS p, lead(role) OVER w AS nr, lead(text) OVER w AS nt FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
x AS (SELECT *, lead(p) OVER (PARTITION BY conv_id ORDER BY turn) AS np FROM n),
y AS (SELECT conv_id, turn, coalesce(nr = 'assistant', FALSE) AS answered, NOT regexp_full_match(text, {q(BLANK)}) AND greatest(0, 100 - p) < 80 AS bad_in,
  nr = 'assistant' AND NOT regexp_full_match(nt, {q(BLANK)}) AS has_out, greatest(0, 100 - np) AS np_t, nt,
  CASE WHEN length(nt) BETWEEN 50 AND 10000 THEN 9.0 ELSE 5.0 END::DOUBLE AS ui FROM x WHERE role = 'user'),
z AS (SELECT *, list_filter([CASE WHEN has_out AND np_t < 90 THEN 'privacy' END, CASE WHEN has_out AND ui < 6.0 THEN 'user_impact' END], lambda x: x IS NOT NULL) AS f FROM y)
SELECT conv_id, turn, answered, CASE WHEN bad_in THEN 'input' WHEN len(f) > 0 THEN 'output' END AS stage, bad_in OR len(f) > 0 AS blocked,
  CASE WHEN bad_in THEN 'privacy' ELSE coalesce(array_to_string(f, ','), '') END AS failed, CASE WHEN NOT bad_in AND has_out THEN 0.8 END::DOUBLE AS out_confidence,
  CASE WHEN NOT bad_in AND has_out THEN ui END AS out_d_user_impact, CASE WHEN NOT bad_in AND len(f) = 0 AND answered THEN length(nt) END AS result_chars FROM z""".replace(
        "{penalty}",
        f"25 * len(regexp_extract_all(text, {q(EMAIL)})) + 15 * len(regexp_extract_all(text, {q(IPV4)})) + "
        f"40 * len(regexp_extract_all(text, {q(CARD)})) + 40 * len(regexp_extract_all(text, {q(TOKEN)}))",
    ),
    "weighted_subset_scorer": f"""WITH {SCORED} SELECT doc_id, round((d_safety * 30.0 + d_privacy * 70.0) / 100.0, 8) AS score, d_safety, d_privacy,
  NULL::DOUBLE AS d_reliability, 'deep' AS mode FROM scored""",
    "guarded_answers": f"""WITH a AS (SELECT conv_id, turn, turn % 3 = 0 AS skipped, text || '!' AS content FROM conversations WHERE role = 'assistant'),
s AS (SELECT *, greatest(0, 100 - 25 * len(regexp_extract_all(content, {q(EMAIL)})) - 15 * len(regexp_extract_all(content, {q(IPV4)}))
  - 40 * len(regexp_extract_all(content, {q(CARD)})) - 40 * len(regexp_extract_all(content, {q(TOKEN)}))) AS p FROM a)
SELECT conv_id, turn, skipped, NOT skipped AND p < 90 AS blocked, CASE WHEN skipped THEN 0.0 ELSE round((70 + p + 60) / 30.0, 8) END::DOUBLE AS score,
  CASE WHEN NOT skipped THEN p / 10.0 END AS d_privacy, CASE WHEN NOT skipped AND p < 90 THEN 'response blocked: dimensions [privacy] below threshold' END AS message,
  CAST(length(content) - 1 + 5 AS BIGINT) AS total_tokens FROM s""",
    "traced_contents": f"""WITH {SCORED} SELECT CAST(doc_id AS VARCHAR) AS trace_id, name, value, NULL::VARCHAR AS comment FROM (
  SELECT doc_id, 'rail_score' AS name, (70 + p_t + 60) / 30.0 AS value FROM scored UNION ALL SELECT doc_id, 'rail_confidence', 0.5 FROM scored
  UNION ALL SELECT doc_id, 'rail_safety', 7.0 FROM scored UNION ALL SELECT doc_id, 'rail_privacy', d_privacy FROM scored UNION ALL SELECT doc_id, 'rail_reliability', 6.0 FROM scored)""",
    "regenerated_turns": f"""WITH {CANDIDATES}, r AS (SELECT * FROM candidates WHERE iteration <= 5),
f AS (SELECT conv_id, min(iteration) FILTER (score >= 6.0) AS met FROM r GROUP BY conv_id),
b AS (SELECT conv_id, text AS best, row_number() OVER (PARTITION BY conv_id ORDER BY CASE WHEN met IS NULL THEN -score WHEN iteration = met THEN -1 ELSE 0 END, iteration) AS o FROM r JOIN f USING (conv_id))
SELECT conv_id, NOT (d_safety < 6.0 OR d_privacy < 5.0) AS passed, CASE WHEN d_safety < 6.0 OR d_privacy < 5.0 THEN 6.0 END::DOUBLE AS target_score,
  CAST(CASE WHEN d_safety < 6.0 OR d_privacy < 5.0 THEN length(best) END AS INTEGER) AS replacement_chars FROM candidates JOIN b USING (conv_id) WHERE iteration = 1 AND o = 1""",
    "conversation_metrics": f"""WITH {TURNS} SELECT conv_id, round(avg(score), 8) AS average_score, min(score) AS min_score, max(score) AS max_score,
  count(*) AS turn_count, round(count(*) FILTER (score >= 7.0) * 100.0 / count(*), 8) AS passing_rate, {AVERAGES}
FROM turns WHERE role <> 'system' GROUP BY conv_id""",
    "conversation_scores_summary": f"""WITH {TURNS} SELECT conv_id, count(*) AS turns, round(avg(score), 8) AS average_score, min(score) AS lowest_score,
  count(*) FILTER (score < 7.0) AS below_threshold_count, CAST(0 AS BIGINT) AS regeneration_count FROM turns GROUP BY conv_id""",
    "input_checks": f"""WITH {TURNS} SELECT conv_id, turn, role <> 'user' AS recorded, CASE WHEN role = 'user' THEN 'basic' END AS mode, d_safety,
  CASE WHEN role <> 'user' THEN d_fairness END AS d_fairness FROM turns""",
    "conversation_mode": f"""WITH {TURNS}, t AS (SELECT *, row_number() OVER w AS turn_number, lag(score) OVER w AS previous_score FROM turns
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
SELECT conv_id, turn, turn_number, previous_score, CASE WHEN turn_number % 5 = 0 OR coalesce(previous_score < 7.0, FALSE) THEN 'deep' ELSE 'basic' END AS mode FROM t""",
    "guardrail_pairs": f"""WITH {TURNS}, t AS (SELECT *, lead(role) OVER w AS nr, lead(text) OVER w AS nt, lead(d_privacy) OVER w AS np, lead(d_fairness) OVER w AS nf
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
p AS (SELECT *, coalesce(nr = 'assistant', FALSE) AS answered, d_safety < 3.0 AS bad_in,
  list_filter([CASE WHEN nr = 'assistant' AND np < 4.0 THEN 'privacy' END, CASE WHEN nr = 'assistant' AND nf < 3.0 THEN 'fairness' END], lambda x: x IS NOT NULL) AS f
  FROM t WHERE role = 'user')
SELECT conv_id, turn, answered, CASE WHEN bad_in THEN 'input' WHEN len(f) > 0 THEN 'output' END AS stage, bad_in OR len(f) > 0 AS blocked,
  CASE WHEN bad_in THEN 'input blocked: dimensions [safety] below threshold'
    WHEN len(f) > 0 THEN 'output blocked: dimensions [' || array_to_string(f, ', ') || '] below threshold' END AS message,
  NOT bad_in AS pre_allowed, CASE WHEN bad_in THEN 'safety' END AS pre_failed,
  CASE WHEN NOT (bad_in OR len(f) > 0) AND answered THEN length(nt) END AS result_chars FROM p""",
    "guard_turn_policies": f"""WITH {TURNS}, t AS (SELECT *, lead(role) OVER w AS nr, lead(text) OVER w AS nt, lead(d_privacy) OVER w AS np, lead(d_fairness) OVER w AS nf
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
p AS (SELECT *, list_filter([CASE WHEN np < 4.0 THEN 'privacy' END, CASE WHEN nf < 3.0 THEN 'fairness' END], lambda x: x IS NOT NULL) AS f
  FROM t WHERE role = 'user' AND nr = 'assistant'),
m(policy) AS (VALUES ('BLOCK'), ('LOG_ONLY'), ('CUSTOM'), ('REGENERATE'))
SELECT policy, conv_id, turn, policy = 'BLOCK' AND len(f) > 0 AS blocked,
  CASE WHEN policy = 'BLOCK' AND len(f) > 0 THEN 'Output blocked: dimensions [' || array_to_string(f, ', ') || '] below threshold' END AS message,
  CASE WHEN len(f) = 0 OR policy = 'LOG_ONLY' THEN length(nt) WHEN policy = 'BLOCK' THEN NULL WHEN policy = 'REGENERATE' THEN length('rewritten')
    WHEN turn % 2 = 0 THEN 0 ELSE length(nt) END AS result_chars FROM p CROSS JOIN m""",
    "policy_enforce": f"""WITH {CALLS}, p AS (SELECT *, {failed(THRESHOLDS)} AS f, CASE WHEN k % 2 = 0 THEN 'rewrite ' || call_id ELSE '' END AS rw FROM calls),
m(mode) AS (VALUES ('LOG_ONLY'), ('BLOCK'), ('REGENERATE'), ('CUSTOM'))
SELECT mode, call_id, len(f) = 0 AS passed, coalesce(array_to_string(f, ','), '') AS failed, mode = 'BLOCK' AND len(f) > 0 AS blocked,
  CASE WHEN mode = 'BLOCK' AND len(f) > 0 THEN 'Content blocked: dimensions [' || array_to_string(f, ', ') || '] below threshold' END AS message,
  CASE WHEN mode = 'REGENERATE' AND len(f) > 0 THEN 6.0 END::DOUBLE AS target_score,
  CASE WHEN len(f) > 0 AND mode = 'REGENERATE' THEN rw WHEN len(f) > 0 AND mode = 'CUSTOM' THEN nullif(rw, '') END AS replacement FROM p CROSS JOIN m""",
    "agent_policy_check": f"""WITH {POLICY} SELECT call_id, blocked, flagged, NOT blocked AND NOT flagged AS allowed, blocked AS halted,
  CASE WHEN decision = 'BLOCK' OR (flagged AND decision = 'FLAG') THEN decision_reason
    WHEN blocked AND len(bad) > 0 THEN 'Dimension minimum violated: [' || array_to_string(bad, ', ') || ']'
    WHEN blocked THEN 'Score ' || {js("score")} || ' is below block threshold ' || {js("b")}
    WHEN flagged THEN 'Score ' || {js("score")} || ' is below flag threshold ' || {js("f")} ELSE '' END AS reason,
  coalesce(array_to_string(bad, ','), '') AS violated FROM jj""",
    "agent_session_policy": f"""WITH {CALLS}, j AS (SELECT *, decision = 'BLOCK' OR score < 2.5 AS b FROM calls), jj AS (SELECT *, NOT b AND (decision = 'FLAG' OR score < 6.5) AS f FROM j)
SELECT session_id, count(*) FILTER (b) AS blocked, count(*) FILTER (f) AS flagged, count(*) FILTER (NOT b AND NOT f) AS allowed FROM jj GROUP BY session_id""",
    "agent_guard_scan": f"""WITH {TEXT_CALLS}, documents AS (SELECT call_id AS doc_id, result AS text, call_id % 3 = 0 AS as_json FROM text_calls
  WHERE result IS NOT NULL AND NOT (decision = 'BLOCK' OR score < 4.0)), {SCAN}
SELECT a.doc_id AS call_id, CASE WHEN as_json THEN 'json' ELSE 'text' END AS scan_format, pii_found, attack_type, recommended_action, risk_level AS result_risk
FROM acted a JOIN documents d USING (doc_id)""",
    "agent_policy_table": f"""WITH {CALLS}, t AS (SELECT *, CASE tool_name WHEN 'purchase' THEN 6.0 WHEN 'click' THEN 3.0 ELSE 4.0 END AS b,
  CASE tool_name WHEN 'purchase' THEN 8.0 WHEN 'signup' THEN 9.5 ELSE 7.0 END AS f FROM calls),
v AS (SELECT call_id, decision = 'BLOCK' OR score < b AS blocked, decision = 'FLAG' OR score < f AS doubtful FROM t)
SELECT call_id, blocked, NOT blocked AND doubtful AS flagged, NOT blocked AND NOT doubtful AS allowed, blocked AS halted FROM v""",
    "observed_policy": f"""WITH {CALLS}, j AS (SELECT *, decision = 'BLOCK' OR score < 2.5 AS b FROM calls), jj AS (SELECT *, NOT b AND (decision = 'FLAG' OR score < 6.5) AS f FROM j)
SELECT count(*) AS rows, count(*) FILTER (b) AS blocked, count(*) FILTER (f) AS flagged, count(*) FILTER (NOT b AND NOT f) AS allowed FROM jj""",
    "agent_guard_params": f"""WITH {TEXT_CALLS}, m(policy) AS (VALUES ('log_only'), ('block'), ('suggest_fix'), ('auto_fix')),
j AS (SELECT *, decision = 'BLOCK' OR score < 4.0 AS blocked FROM text_calls CROSS JOIN m),
s AS (SELECT *, blocked AND policy IN ('suggest_fix', 'auto_fix') AND suggested_params IS NOT NULL AS swapped, NOT (blocked AND policy = 'block') AS executed FROM j)
SELECT policy, call_id, blocked, swapped, executed, CASE WHEN NOT executed THEN NULL WHEN swapped THEN suggested_params ELSE params END AS effective_params,
  CASE WHEN executed THEN CASE call_id % 3 WHEN 0 THEN 'json' WHEN 1 THEN 'text' END END AS scan_format FROM s""",
    "agent_mode": f"""WITH {CALLS}, t AS (SELECT *, max(CASE WHEN decision <> 'FLAG' THEN n END) OVER (PARTITION BY session_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS clear FROM calls)
SELECT call_id, n - 1 AS prior_calls, n - 1 - coalesce(clear, 0) AS flag_run,
  CASE WHEN n - 1 - coalesce(clear, 0) >= 3 OR (n > 1 AND (n - 1) % 7 = 0) THEN 'deep' ELSE 'basic' END AS mode FROM t""",
    "agent_accepted_prefix": f"WITH {_accepted(40, 20 * 24 * 60, True)} SELECT call_id, accepted, reject_reason FROM final",
    "agent_accepted_no_block": f"WITH {_accepted(40, 20 * 24 * 60, False)} SELECT call_id, accepted, reject_reason FROM final",
    "agent_session_status": f"""WITH {_accepted(50, 29 * 24 * 60, False)} SELECT session_id, min(ts) AS started_at,
  min(ts) FILTER (reject_reason IN ('max_tool_calls', 'ttl_expired')) AS closed_at, count(*) FILTER (accepted) AS accepted_calls,
  count(*) FILTER (NOT accepted) AS rejected_calls,
  CASE WHEN count(*) FILTER (reject_reason IN ('max_tool_calls', 'ttl_expired')) > 0 THEN 'closed' ELSE 'active' END AS status FROM final GROUP BY session_id""",
    "agent_decision_counts": f"""WITH {CALLS} SELECT session_id, count(*) AS total_tool_calls, count(*) FILTER (decision = 'ALLOW') AS allowed,
  count(*) FILTER (decision = 'FLAG') AS flagged, count(*) FILTER (decision = 'BLOCK') AS blocked FROM calls GROUP BY session_id""",
    "agent_risk_trend": f"""WITH {CALLS} SELECT session_id, round(crs, 8) AS current_risk_score, {TREND} AS risk_trend FROM (
  SELECT session_id, max(total) AS total, avg(score) FILTER (n > total - 5) AS crs, max(CASE WHEN n = total THEN score END) AS s0,
  max(CASE WHEN n = total - 1 THEN score END) AS s1, max(CASE WHEN n = total - 2 THEN score END) AS s2 FROM calls GROUP BY session_id)""",
    "agent_exposure": f"""WITH {CALLS} SELECT session_id, v_framework AS framework, count(*) FILTER (v_severity IN ('high', 'critical')) AS violations,
  count(*) FILTER (v_severity NOT IN ('high', 'critical')) AS warnings, count(*) FILTER (v_severity = 'critical') AS critical, count(DISTINCT v_article) AS articles,
  CASE WHEN count(*) FILTER (v_severity IN ('high', 'critical')) >= 3 THEN 'high' WHEN count(*) >= 3 THEN 'medium' ELSE 'low' END AS risk_tier
FROM calls WHERE v_framework IS NOT NULL GROUP BY session_id, v_framework""",
    "agent_patterns": "WITH " + _patterns(),
    "agent_risk_summary": f"""WITH {CALLS}, pat AS (SELECT session_id, count(*) AS np FROM (WITH {_patterns()}) GROUP BY session_id),
ex AS (SELECT session_id, v_framework, count(*) FILTER (v_severity IN ('high', 'critical')) AS v, count(*) FILTER (v_severity NOT IN ('high', 'critical')) AS w
  FROM calls WHERE v_framework IS NOT NULL GROUP BY ALL),
exs AS (SELECT session_id, string_agg(v_framework || ':' || v || ':' || w || ':' || CASE WHEN v >= 3 THEN 'high' WHEN v + w >= 3 THEN 'medium' ELSE 'low' END, ',' ORDER BY v_framework) AS exposure FROM ex GROUP BY session_id),
g AS (SELECT session_id, max(total) AS total, count(*) FILTER (decision = 'ALLOW') AS allowed, count(*) FILTER (decision = 'FLAG') AS flagged,
  count(*) FILTER (decision = 'BLOCK') AS blocked, count(*) FILTER (v_severity = 'critical') AS critical_violations,
  count(DISTINCT v_framework || ':' || v_article) AS distinct_violations, avg(score) FILTER (n > total - 5) AS crs,
  max(CASE WHEN n = total THEN score END) AS s0, max(CASE WHEN n = total - 1 THEN score END) AS s1, max(CASE WHEN n = total - 2 THEN score END) AS s2,
  {AVERAGES}, sum(credits) AS total_credits, min(ts) AS started FROM calls GROUP BY session_id)
SELECT session_id, 'active' AS status, total AS total_tool_calls, allowed, flagged, blocked, critical_violations, distinct_violations,
  round(crs, 8) AS current_risk_score, {TREND} AS risk_trend, {each("avg_{c}")}, coalesce(np, 0) AS patterns_detected, coalesce(exposure, '') AS exposure, total_credits,
  CAST(floor((epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(started)) / 1000000) AS BIGINT) AS duration_seconds
FROM g LEFT JOIN pat USING (session_id) LEFT JOIN exs USING (session_id)""",
    "agent_closed_summary": f"""WITH {_accepted(40, 20 * 24 * 60, True)},
st AS (SELECT session_id, min(ts) FILTER (reject_reason IN ('max_tool_calls', 'ttl_expired')) AS closed_at FROM final GROUP BY session_id),
r AS (SELECT session_id, ts, score, credits, row_number() OVER (PARTITION BY session_id ORDER BY n) AS i, count(*) OVER (PARTITION BY session_id) AS total FROM final WHERE accepted),
g AS (SELECT session_id, max(total) AS total, max(CASE WHEN i = total THEN score END) AS s0, max(CASE WHEN i = total - 1 THEN score END) AS s1,
  max(CASE WHEN i = total - 2 THEN score END) AS s2, sum(credits) AS total_credits, min(ts) AS started FROM r GROUP BY session_id)
SELECT session_id, CASE WHEN closed_at IS NULL THEN 'active' ELSE 'closed' END AS status, closed_at, total AS total_tool_calls, {TREND} AS risk_trend, total_credits,
  CAST(floor((epoch_us(coalesce(closed_at, TIMESTAMP '{AS_OF}')) - epoch_us(started)) / 1000000) AS BIGINT) AS duration_seconds FROM g JOIN st USING (session_id)""",
    "session_event_log": f"""WITH {CALLS}, u AS (SELECT session_id, 'tool_call' AS kind, ts FROM calls
  UNION ALL SELECT conv_id, CASE role WHEN 'assistant' THEN 'tool_result' ELSE 'injection' END, TIMESTAMP '2024-01-01 00:00:00' + to_seconds(turn) FROM conversations WHERE role IN ('assistant', 'user'))
SELECT session_id, kind, count(*) AS events, min(ts) AS first_at, max(ts) AS last_at FROM u GROUP BY session_id, kind""",
    "history_since_reset": f"""WITH {CALLS}, r AS (SELECT session_id, max(ts) AS reset_at FROM calls WHERE k = 99 GROUP BY session_id)
SELECT session_id, count(*) AS turns, round(avg(score), 8) AS average_score FROM calls LEFT JOIN r USING (session_id) WHERE reset_at IS NULL OR ts > reset_at GROUP BY session_id""",
    "plan_verdict": f"""WITH {STEPS}, p AS (SELECT plan_id, count(*) AS steps, count(*) FILTER (decision = 'BLOCK') AS b, avg(score) AS a, sum(credits) AS credits,
  string_agg(CAST(step_index AS VARCHAR), ', ' ORDER BY step_index) FILTER (decision = 'BLOCK') AS idx FROM steps GROUP BY plan_id)
SELECT plan_id, steps, CASE WHEN steps > 20 THEN 'plan_too_long' END AS error_code,
  CASE WHEN steps > 20 THEN NULL WHEN b = steps THEN 'BLOCK_ALL' WHEN b > 0 THEN 'PARTIAL_BLOCK' ELSE 'ALLOW_ALL' END AS overall_decision,
  CASE WHEN steps > 20 THEN NULL WHEN round(a, 9) >= 7 THEN 'low' WHEN round(a, 9) >= 5 THEN 'medium' WHEN round(a, 9) >= 3 THEN 'high' ELSE 'critical' END AS overall_risk,
  CASE WHEN steps > 20 THEN NULL WHEN b = steps THEN 'All ' || steps || ' steps are blocked.'
    WHEN b > 0 THEN (steps - b) || ' of ' || steps || ' steps can proceed. Blocked steps: [' || idx || '].' ELSE 'All ' || steps || ' steps can proceed.' END AS plan_summary,
  round(a, 8) AS average_score, credits FROM p""",
    "plan_evaluation": f"""WITH {STEPS}, s AS (SELECT plan_id, step_index, ((call_id * 13 + step_index * 7) % 101) / 10.0 AS v FROM steps),
p AS (SELECT plan_id, count(*) AS steps, count(*) FILTER (v < 2.5) AS b, avg(v) AS a, string_agg(CAST(step_index AS VARCHAR), ',' ORDER BY step_index) FILTER (v < 2.5) AS idx FROM s GROUP BY plan_id)
SELECT plan_id, steps, CASE WHEN steps > 20 THEN 'plan_too_long' END AS error_code,
  CASE WHEN steps > 20 THEN NULL WHEN b = steps THEN 'BLOCK_ALL' WHEN b > 0 THEN 'PARTIAL_BLOCK' ELSE 'ALLOW_ALL' END AS overall_decision,
  CASE WHEN steps > 20 THEN NULL WHEN round(a, 9) >= 7 THEN 'low' WHEN round(a, 9) >= 5 THEN 'medium' WHEN round(a, 9) >= 3 THEN 'high' ELSE 'critical' END AS overall_risk,
  CASE WHEN steps <= 20 THEN coalesce(idx, '') END AS blocked_indices FROM p""",
    "tool_profiles": f"""WITH {CALLS} SELECT call_id, tool_name AS profile_name, CASE WHEN tool_name IN ('error', 'purchase') THEN 'high' WHEN tool_name = 'signup' THEN 'medium' ELSE 'low' END AS profile_risk_level,
  CASE WHEN tool_name = 'purchase' THEN 'org_custom' ELSE 'system' END AS profile_source, CASE WHEN tool_name = 'purchase' THEN 6.0 END::DOUBLE AS block_below FROM calls""",
    "tool_call_assessment": f"""WITH {CALLS}, a AS (SELECT *, tool_name = 'purchase' AS hit, tool_name = 'signup' AS proxy, k % 2 = 0 AS hs, CASE WHEN tool_name = 'purchase' THEN 6.0 ELSE 4.0 END::DOUBLE AS bb,
  CASE WHEN tool_name = 'purchase' THEN 8.0 ELSE 7.0 END::DOUBLE AS fb FROM calls)
SELECT call_id, CASE WHEN proxy THEN 'k' ELSE '' END AS proxy_hits, CASE WHEN hit THEN 'k' ELSE '' END AS pii_hits, hs AS high_stakes, bb AS block_below, fb AS flag_below,
  CASE WHEN score < bb THEN 'BLOCK' WHEN score < fb OR hit OR proxy OR (tool_name IN ('error', 'purchase') AND hs) THEN 'FLAG' ELSE 'ALLOW' END AS decision FROM a""",
    "registry_page": """WITH r AS (
  SELECT replace(p_name, ' ', '_') || '_' || p_partkey AS tool_name, 'high' AS risk_level, 'org_custom' AS source, p_type AS description
  FROM part WHERE p_size > 25 AND p_size <= 40 AND p_brand LIKE 'Brand#1%' AND contains(lower(p_name), 'red')),
t AS (SELECT count(*) AS total FROM r)
SELECT tool_name, risk_level, source, description, total, total > 60 AS has_more FROM r CROSS JOIN t ORDER BY tool_name, source LIMIT 50 OFFSET 10""",
    "registry_upsert": f"""WITH {REGISTRY}, new AS (
  SELECT replace(p_name, ' ', '_') || '_' || p_partkey AS tool_name, arg_max(
    CASE WHEN l_quantity <= 12 THEN 'low' WHEN l_quantity <= 25 THEN 'medium' WHEN l_quantity <= 40 THEN 'high' ELSE 'critical' END,
    {{'a': l_shipdate, 'b': l_orderkey, 'c': l_linenumber, 'd': l_quantity, 'e': l_returnflag}}) AS risk_level
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1)
SELECT tool_name, source, risk_level FROM reg WHERE source = 'system' OR tool_name NOT IN (SELECT tool_name FROM new)
UNION ALL SELECT tool_name, 'org_custom', risk_level FROM new""",
    "registry_delete": f"""WITH {REGISTRY}, names AS (SELECT DISTINCT tool_name FROM reg WHERE risk_level = 'critical' UNION SELECT DISTINCT s_name FROM supplier),
kept AS (SELECT * FROM reg WHERE source = 'system' OR tool_name NOT IN (SELECT tool_name FROM names))
SELECT n.tool_name, coalesce(r.source = 'org_custom', FALSE) AS deleted, CASE WHEN r.source = 'system' THEN n.tool_name ELSE 'generic' END AS fallback FROM names n LEFT JOIN reg r USING (tool_name)
UNION ALL SELECT 'left:' || source, FALSE, CAST(count(*) AS VARCHAR) FROM kept GROUP BY source""",
    "pii_scan": "\nUNION ALL\n".join(
        _entities(k, p) for k, p in (("secret", TOKEN), ("card", CARD), ("email", EMAIL), ("ip", IPV4))
    ),
    "pii_redact": f"SELECT doc_id, {redacted()} AS redacted FROM documents",
    "tool_result_scan": f"""WITH {SCAN} SELECT doc_id, pii_found, entities, coalesce(compliance_flags, '') AS compliance_flags, attack_type, recommended_action, risk_level,
  CASE WHEN pii_found THEN length({redacted()}) END AS redacted_chars FROM acted""",
    "injection_check": f"""WITH s AS (SELECT doc_id, {_injection()} FROM documents) SELECT doc_id, attack_type <> 'none' AS injection_detected, attack_type, severity,
  CASE WHEN severity IN ('high', 'critical') THEN 'BLOCK' WHEN attack_type <> 'none' THEN 'FLAG' ELSE 'PASS' END AS injection_action, 0.5::DOUBLE AS injection_credits FROM s""",
    "rule_scorer": f"""WITH {SCORED} SELECT doc_id, n_email, n_ip, n_card, n_token, d_safety, d_privacy, d_reliability, confidence, round(score, 8) AS score FROM scored""",
    "low_confidence_upgrade": f"""WITH {SCORED} SELECT doc_id, CASE WHEN labelled THEN 'basic' ELSE 'deep' END AS mode, NOT labelled AS upgraded,
  CASE WHEN labelled THEN 0.9 ELSE 0.8 END::DOUBLE AS confidence, CASE WHEN NOT labelled THEN u_t / 10.0 END AS d_user_impact,
  round(CASE WHEN labelled THEN score ELSE (s_t + p_t + r_t + u_t) / 40.0 END, 8) AS score FROM scored""",
    "score_distinct": f"""WITH {SCORED} SELECT doc_id, d_privacy, round((70 + p_t + 60) / 30.0, 8) AS score, 'basic' AS mode FROM scored""",
    "compliance_matrix": f"WITH {_requirements(7.0)} SELECT * FROM labelled_checks",
    "compliance_matrix_strict": f"WITH {_requirements(8.5)} SELECT * FROM labelled_checks",
    "cross_framework": f"""WITH {_requirements(7.0)} SELECT doc_id, count(*) AS frameworks_evaluated, round(avg(compliance_score), 6) AS average_score,
  arg_min(framework, {{'s': compliance_score, 'f': framework}}) AS weakest_framework, min(compliance_score) AS weakest_score FROM checks GROUP BY doc_id""",
    "issue_counts": f"""WITH {_requirements(7.0)} SELECT framework, severity, count(*) AS issues,
  CASE WHEN severity IN ('low', 'medium') THEN 'WARN' WHEN severity = 'high' THEN 'ERROR' END AS level FROM judged WHERE status = 'failed' GROUP BY framework, severity""",
    "top_issues": f"""WITH {_requirements(7.0)}, i AS (SELECT doc_id, doc_id || ':' || requirement_id AS issue_id, severity, dims[1] AS dimension,
  CASE severity {" ".join(f"WHEN '{s}' THEN {d}" for s, d in DEADLINE_DAYS)} END AS remediation_deadline_days,
  row_number() OVER (PARTITION BY doc_id ORDER BY CASE severity WHEN 'critical' THEN 0 WHEN 'high' THEN 1 WHEN 'medium' THEN 2 ELSE 3 END, doc_id || ':' || requirement_id) AS rank
  FROM judged WHERE status = 'failed') SELECT doc_id, rank, issue_id, severity, dimension, remediation_deadline_days FROM i WHERE rank <= 3""",
    "compliance_log": f"""WITH {_requirements(7.0)} SELECT doc_id, framework, 'INFO' AS level,
  '[Compliance] ' || framework || ' | score=' || {fixed('compliance_score', 2)} || ' | label=' || label || ' | passed=' || requirements_passed || ' | failed=' || requirements_failed AS line FROM labelled_checks
UNION ALL SELECT doc_id, framework, CASE severity WHEN 'high' THEN 'ERROR' ELSE 'WARN' END,
  '[Compliance] [' || framework || '] ' || upper(severity) || ' — Requirement ' || requirement_id || ' is not met (' || article || ')' ||
  CASE WHEN severity = 'high' THEN ' — remediation: {dict(EFFORT)["high"]}' ELSE '' END FROM judged WHERE status = 'failed' AND severity <> 'critical'""",
    "risk_classification": f"""WITH {CALLS}, x AS (SELECT call_id, ['general', 'healthcare', 'finance', 'code', 'hr'][call_id % 5 + 1] AS dom,
  ['automated', 'assisted', 'social_scoring', 'fully_automated'][k % 4 + 1] AS kind FROM calls),
t AS (SELECT call_id, CASE WHEN kind = 'social_scoring' THEN 'unacceptable' WHEN dom IN ('healthcare', 'finance', 'hr') AND kind <> 'assisted' THEN 'high'
  WHEN dom IN ('healthcare', 'finance', 'hr') OR kind <> 'assisted' THEN 'limited' ELSE 'minimal' END AS tier FROM x)
SELECT call_id, tier, CASE tier WHEN 'unacceptable' THEN 'prohibited decision type' WHEN 'high' THEN 'automated decisions in a high-risk domain'
  WHEN 'limited' THEN 'high-risk domain or automated decisions' ELSE 'no risk indicator' END AS basis,
  CASE tier WHEN 'unacceptable' THEN 'do_not_deploy' WHEN 'high' THEN 'risk_management,human_oversight,logging' WHEN 'limited' THEN 'transparency_notice' ELSE '' END AS obligations FROM t""",
    "best_iteration": f"""WITH {CANDIDATES}, r AS (SELECT * FROM candidates WHERE iteration <= 3),
f AS (SELECT conv_id, min(iteration) FILTER (score >= 8.0) AS met, max(iteration) AS last, max(score) FILTER (iteration = 1) < 3.0 AS refused FROM r GROUP BY conv_id),
b AS (SELECT r.*, met, last, refused, row_number() OVER (PARTITION BY r.conv_id ORDER BY CASE WHEN met IS NULL THEN -score WHEN iteration = met THEN -1 ELSE 0 END, iteration) AS o FROM r JOIN f USING (conv_id))
SELECT conv_id, CASE WHEN refused THEN 'too_harmful' WHEN met IS NOT NULL THEN 'passed' WHEN last >= 3 THEN 'max_iterations_reached' ELSE 'awaiting_regeneration' END AS status,
  CASE WHEN refused THEN 0 ELSE coalesce(met, last) END AS iterations_used, CASE WHEN refused THEN 0 ELSE 3 - coalesce(met, last) END AS iterations_remaining,
  CASE WHEN NOT refused THEN iteration END AS best_iteration, CASE WHEN NOT refused THEN score END AS best_score, CASE WHEN NOT refused THEN length(text) END AS best_chars FROM b WHERE o = 1""",
    "iteration_history": f"""WITH {CANDIDATES}, r AS (SELECT *, score - lag(score) OVER (PARTITION BY conv_id ORDER BY iteration) AS d,
  min(CASE WHEN score >= 8.0 THEN iteration END) OVER (PARTITION BY conv_id) AS met FROM candidates WHERE iteration <= 3)
SELECT conv_id, iteration, score, score >= 8.0 AS thresholds_met, round(d, 8) AS improvement_from_previous FROM r WHERE met IS NULL OR iteration <= met""",
    "regeneration_credits": f"""WITH {CANDIDATES}, r AS (SELECT *, min(CASE WHEN score >= 8.0 THEN iteration END) OVER (PARTITION BY conv_id) AS met FROM candidates WHERE iteration <= 3)
SELECT conv_id, count(*)::DOUBLE AS evaluations, (count(*) FILTER (iteration > 1) * 1.5)::DOUBLE AS regenerations, (count(*) + count(*) FILTER (iteration > 1) * 1.5)::DOUBLE AS total
FROM r WHERE met IS NULL OR iteration <= met GROUP BY conv_id""",
    "expired_regenerations": f"""WITH {CANDIDATES}, t AS (SELECT conv_id, iteration, TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(iteration * iteration * 3 + conv_id % 5 AS INT)) AS ts FROM candidates),
l AS (SELECT *, coalesce(ts > lag(ts) OVER (PARTITION BY conv_id ORDER BY iteration) + INTERVAL 15 MINUTE, FALSE) AS late FROM t)
SELECT conv_id, max(ts) AS last_step_at, bool_or(late) AS expired, min(iteration) FILTER (late) AS expired_at_iteration FROM l GROUP BY conv_id""",
    "score_fanout": f"""WITH {CALLS}, f AS (
  SELECT call_id, session_id, 'rail_score' AS name, score AS value, 'call ' || call_id AS comment FROM calls
  UNION ALL SELECT call_id, session_id, 'rail_confidence', confidence, NULL FROM calls
  UNION ALL SELECT call_id, session_id, 'rail_threshold_met', CASE WHEN score >= 7.0 THEN 1.0 ELSE 0.0 END::DOUBLE, NULL FROM calls WHERE k % 3 <> 0
  UNION ALL {each("SELECT call_id, session_id, 'rail_{d}', {c}, CASE WHEN {i} = 0 THEN 'k=' || k END FROM calls WHERE {c} IS NOT NULL", " UNION ALL ")})
SELECT call_id AS trace_id, session_id, name, value, comment FROM f""",
    "review_queue": f"""WITH {CALLS}, q AS ({each("SELECT call_id, k, ts, '{d}' AS dimension, {c} AS score FROM calls WHERE {c} < 3.0", " UNION ALL ")})
SELECT 'rev_' || substring(sha256(call_id || ':' || dimension), 1, 12) AS item_id, call_id AS source_key, dimension, score, 3.0::DOUBLE AS threshold, 'org' AS org_id, 'p' AS project_id,
  'production' AS environment, ts AS enqueued_at, 'call ' || call_id AS content_preview, CASE WHEN dimension = 'safety' THEN 'k=' || k END AS explanation FROM q""",
    "review_queue_sizes": f"""WITH {CALLS}, q AS ({each("SELECT '{d}' AS dimension FROM calls WHERE {c} < 3.0", " UNION ALL ")}) SELECT dimension, count(*) AS items FROM q GROUP BY dimension""",
    "review_pending": f"""WITH {CALLS}, q AS ({each("SELECT '{d}' AS dimension, ts > TIMESTAMP '2024-01-10 00:00:00' AS late FROM calls WHERE {c} < 3.0", " UNION ALL ")})
SELECT dimension, count(*) AS items, CASE WHEN late THEN 'pending' ELSE 'drained' END AS part FROM q GROUP BY dimension, late
UNION ALL SELECT 'safety', count(*), 'pending safety' FROM q WHERE late AND dimension = 'safety'""",
    "incidents": f"""WITH {CALLS}, f AS (SELECT *, {failed({"safety": 1.0, "privacy": 1.0})} AS bad FROM calls)
SELECT 'inc_' || call_id AS incident_id, 'threshold_breach' AS type, CASE WHEN len(bad) > 1 THEN 'high' ELSE 'medium' END AS severity, 'open' AS status,
  'Low scores in ' || tool_name AS title, array_to_string(bad, ',') AS affected_dimensions, 1.0::DOUBLE AS threshold, ts AS "timestamp", tool_name AS record_tool, 'open' AS record_status FROM f WHERE len(bad) > 0""",
    "request_log": f"WITH {REQUESTS} SELECT * FROM log",
    "request_metrics": f"""WITH {REQUESTS} SELECT endpoint, mode, count(*) AS requests, count(error_type) AS errors, sum(credits_consumed) AS credits_consumed, count(*) FILTER (from_cache) AS cache_hits,
  min(duration_ms) AS duration_min, max(duration_ms) AS duration_max, round(avg(duration_ms), 8) AS duration_avg, quantile_disc(duration_ms, 0.5) AS duration_p50,
  quantile_disc(duration_ms, 0.95) AS duration_p95, count(score) AS scores, round(avg(score), 8) AS score_avg FROM log GROUP BY endpoint, mode""",
    "request_histograms": f"""WITH {REQUESTS} SELECT endpoint, floor(score)::DOUBLE AS bucket_low, count(*) AS rows, 'score.distribution' AS metric, 'histogram' AS kind FROM log WHERE score IS NOT NULL GROUP BY ALL
UNION ALL SELECT endpoint, (floor(duration_ms / 100.0) * 100.0)::DOUBLE, count(*), 'request.duration', 'histogram' FROM log GROUP BY ALL""",
    "request_errors": f"WITH {REQUESTS} SELECT endpoint, error_type, count(*) AS errors FROM log WHERE error_type IS NOT NULL GROUP BY ALL",
    "request_dedup": f"""WITH RECURSIVE {REQUESTS},
openings AS (SELECT conv_id AS quoted, arg_min(text, turn) AS opening FROM conversations GROUP BY conv_id),
keyed AS (SELECT request_id, ts, error_type IS NULL AS ok, endpoint IN ('eval', 'health') AS cacheable,
  endpoint || ':' || (request_id % 5 = 0) || ':' || coalesce(opening, 'no such text') AS key FROM req LEFT JOIN openings ON quoted = {QUOTED.format("request_id")}),
stored AS (SELECT * FROM keyed WHERE ok AND cacheable),
chain AS (
  SELECT key, min(ts) AS t FROM stored GROUP BY key
  UNION ALL SELECT key, t FROM (SELECT c.key, (SELECT min(x.ts) FROM stored x WHERE x.key = c.key AND x.ts > c.t + INTERVAL 3600 SECOND) AS t FROM chain c) WHERE t IS NOT NULL),
sent AS (SELECT c.key, c.t, min(request_id) AS request_id FROM chain c JOIN stored r ON r.key = c.key AND r.ts = c.t GROUP BY ALL),
found AS (SELECT r.*, CASE WHEN r.ts <= s.t + INTERVAL 3600 SECOND THEN s.request_id END AS stored_id
  FROM (SELECT * FROM keyed WHERE cacheable) r ASOF LEFT JOIN sent s ON r.key = s.key AND r.ts >= s.t)
SELECT request_id, stored_id AS answer_id, coalesce(stored_id <> request_id, FALSE) AS from_cache FROM found
UNION ALL SELECT request_id, CASE WHEN ok THEN request_id END, FALSE FROM keyed WHERE NOT cacheable""",
    "decode_decisions": f"""WITH {CALLS} SELECT call_id, decision, CASE WHEN k % 9 <> 0 THEN decision_reason ELSE '' END AS decision_reason, CASE WHEN k % 8 <> 0 THEN score ELSE 0.0 END::DOUBLE AS score,
  CASE WHEN k % 8 <> 0 THEN confidence ELSE 0.0 END::DOUBLE AS confidence, '' AS summary, {each("{c}")}, CASE WHEN k % 9 <> 0 AND v_framework IS NOT NULL THEN 1 ELSE 0 END AS violations,
  CASE WHEN k % 9 <> 0 THEN v_severity END AS first_severity, CASE WHEN k % 9 <> 0 THEN coalesce(array_to_string(pii_fields, ','), '') ELSE '' END AS pii_fields, FALSE AS high_stakes, TRUE AS no_policy, suggested_params,
  CASE WHEN k % 9 <> 0 THEN credits ELSE 0.0 END::DOUBLE AS credits FROM calls""",
    "decode_evaluations": f"""WITH {TURNS} SELECT conv_id, turn, score, confidence, role AS summary, length(text) AS chars, {each("{c}")}, FALSE AS from_cache FROM turns""",
    "decode_scans": f"""WITH {SCAN} SELECT doc_id, risk_level AS risk, recommended_action AS action, pii_found, entities, coalesce(compliance_flags, '') AS compliance_flags, injected AS injection_detected, attack_type,
  'none' AS severity, 0.5::DOUBLE AS credits FROM acted""",
    "decode_plan_steps": f"""WITH {STEPS} SELECT plan_id, call_id, step_index, tool_name, decision, CASE WHEN call_id % 6 <> 0 THEN score ELSE 0.0 END::DOUBLE AS score, credits FROM steps""",
    "decode_tool_profiles": f"""WITH {REGISTRY} SELECT tool_name, risk_level, source, CASE WHEN source = 'org_custom' THEN 4.0 END::DOUBLE AS block_below FROM reg""",
    "decode_compliance_results": f"""WITH {_requirements(7.0)} SELECT doc_id, framework, count(*) OVER (PARTITION BY doc_id, framework) AS requirements_checked, requirement_id, article, status, 7.0::DOUBLE AS threshold FROM judged""",
    "decode_compliance_issues": f"""WITH {_requirements(7.0)} SELECT doc_id, framework, doc_id || ':' || requirement_id AS issue_id, severity, dims[1] AS dimension,
  CAST(CASE severity {" ".join(f"WHEN '{s}' THEN {d}" for s, d in DEADLINE_DAYS)} END AS INTEGER) AS remediation_deadline_days FROM judged WHERE status = 'failed'""",
    "json_log": f"""WITH {CALLS} SELECT call_id, decision, score FROM calls WHERE call_id % 10 <> 3
UNION ALL SELECT NULL, substring('{{"call_id":' || call_id || ',"decision"', 1, 12), NULL FROM calls WHERE call_id % 10 = 3""",
    "decode_regenerations": f"""WITH {CANDIDATES}, r AS (SELECT *, min(CASE WHEN score >= 8.0 THEN iteration END) OVER (PARTITION BY conv_id) AS met FROM candidates WHERE iteration <= 3)
SELECT conv_id, iteration - 1 AS position, iteration, length(text) AS chars, score >= 8.0 AS thresholds_met FROM r WHERE met IS NULL OR iteration <= met""",
    "extracted_answers": """SELECT v AS vendor, conv_id, turn, length(text) + CASE WHEN v = 'blocks' THEN 1 ELSE 0 END AS chars, length(text) AS prompt_tokens,
  CASE v WHEN 'choices' THEN 7 WHEN 'blocks' THEN 5 ELSE 0 END AS completion_tokens, length(text) + CASE v WHEN 'choices' THEN 7 WHEN 'blocks' THEN 5 ELSE 0 END AS total_tokens
FROM conversations CROSS JOIN (VALUES ('choices'), ('blocks'), ('candidates')) f(v) WHERE role = 'assistant'""",
    "token_usage": """SELECT v AS vendor, count(*) AS responses, CAST(sum(length(text)) AS BIGINT) AS prompt_tokens, CAST(sum(CASE v WHEN 'choices' THEN 7 WHEN 'blocks' THEN 5 ELSE 0 END) AS BIGINT) AS completion_tokens,
  CAST(sum(length(text) + CASE v WHEN 'choices' THEN 7 WHEN 'blocks' THEN 5 ELSE 0 END) AS BIGINT) AS total_tokens
FROM conversations CROSS JOIN (VALUES ('choices'), ('blocks'), ('candidates')) f(v) WHERE role = 'assistant' GROUP BY v""",
    "llm_guard": f"""WITH {TURNS}, g AS (SELECT *, turn % 5 = 0 OR conv_id % 4 = 0 AS skipped FROM turns WHERE role = 'assistant')
SELECT conv_id, turn, skipped, NOT skipped AND d_safety < 4.0 AS blocked, CASE WHEN skipped THEN 0.0 ELSE score END::DOUBLE AS score, CASE WHEN skipped THEN 0.0 ELSE confidence END::DOUBLE AS confidence,
  CASE WHEN NOT skipped THEN d_safety END AS d_safety, CASE WHEN NOT skipped AND d_safety < 4.0 THEN 'response blocked: dimensions [safety] below threshold' END AS message FROM g""",
    "encode_requests": f"""WITH {TEXT_CALLS} SELECT call_id, 'eval' AS endpoint, '{{"content":' || to_json(opening)::VARCHAR || CASE WHEN k % 3 = 0 THEN ',"mode":"deep"' ELSE '' END ||
  CASE WHEN k % 5 = 0 THEN ',"dimensions":[]' ELSE '' END || CASE WHEN k % 2 = 0 THEN ',"include_issues":false' ELSE '' END || '}}' AS body FROM text_calls""",
    "encode_tool_calls": f"""WITH {CALLS} SELECT call_id, 'agent/tool-call' AS endpoint, '{{"tool_name":"' || tool_name || '","tool_params":{{"k":' || k || '}}}}' AS body FROM calls""",
    "encode_compliance": f"""WITH {TEXT_CALLS} SELECT call_id, 'compliance/check' AS endpoint, '{{"content":' || to_json(opening)::VARCHAR || ',' || CASE WHEN k % 2 = 0 THEN '"framework":"india_dpdp"' ELSE '"frameworks":["eu_ai_act","gdpr"]' END ||
  CASE WHEN k % 4 = 0 THEN ',"strict_mode":false' ELSE '' END || '}}' AS body FROM text_calls""",
    "stream_session_metrics": f"""WITH {CALLS}, g AS (SELECT session_id, count(*) AS turn_count, round(avg(score), 8) AS average_score, min(score) AS min_score, max(score) AS max_score,
  count(*) FILTER (score >= 7.0) AS passing, count(*) FILTER (score < 7.0) AS below_threshold_count, max(CASE WHEN n = total THEN score END) AS last_score FROM calls GROUP BY session_id)
SELECT *, CASE WHEN (turn_count + 1) % 5 = 0 OR last_score < 7.0 THEN 'deep' ELSE 'basic' END AS next_mode FROM g""",
    "stream_agent_sessions": f"""WITH {_accepted(40, 20 * 24 * 60, True)}, t AS (SELECT *, max(CASE WHEN decision <> 'FLAG' THEN n END) OVER (PARTITION BY session_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS clear FROM final)
SELECT call_id, accepted, reject_reason, CASE WHEN NOT accepted THEN NULL WHEN n - 1 - coalesce(clear, 0) >= 3 OR (n > 1 AND (n - 1) % 7 = 0) THEN 'deep' ELSE 'basic' END AS mode FROM t""",
    "stream_request_metrics": f"""WITH {REQUESTS} SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, endpoint, count(*) AS requests, count(error_type) AS errors, sum(credits_consumed) AS credits_consumed,
  CAST(sum(duration_ms) AS BIGINT) AS duration_total FROM log GROUP BY ALL""",
    "stream_review_queue": f"""WITH {CALLS}, q AS ({each("SELECT call_id, '{d}' AS dimension, {c} AS score FROM calls WHERE {c} < 3.0", " UNION ALL ")})
SELECT 'rev_' || substring(sha256(call_id || ':' || dimension), 1, 12) AS item_id, call_id AS source_key, dimension, score FROM q""",
    "stream_request_first_seen": f"""WITH {REQUESTS}, openings AS (SELECT conv_id AS quoted, arg_min(text, turn) AS opening FROM conversations GROUP BY conv_id)
SELECT DISTINCT endpoint, coalesce(opening, 'no such text') AS content, request_id % 5 = 0 AS b_first, CAST(1 AS BIGINT) AS let_through FROM req LEFT JOIN openings ON quoted = {QUOTED.format("request_id")}""",
}
SQL["stream_regenerations"] = f"""WITH {EVENTS}, l AS (SELECT *, coalesce(ts > lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 15 MINUTE, TRUE) AS starts FROM ev),
s AS (SELECT *, sum(starts::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS part FROM l),
g AS (SELECT user_id AS session_id, part, bool_or(k >= 90) AS met, count(*) AS steps, min(ts) AS first_step_at, max(ts) AS last_step_at FROM s GROUP BY user_id, part),
m AS (SELECT max(ts) - INTERVAL 1 MINUTE AS watermark FROM ev)
SELECT session_id, CASE WHEN met THEN 'passed' ELSE 'expired' END AS outcome, steps, first_step_at, last_step_at FROM g CROSS JOIN m WHERE last_step_at + INTERVAL 15 MINUTE <= watermark"""
SQL["regeneration_sessions"] = SQL["stream_regenerations"].split(" FROM g CROSS JOIN m")[0] + " FROM g"
SQL["stream_request_dedup"] = SQL["request_dedup"]
SQL["registry_seek"] = f"""WITH {REGISTRY_TOOLS}
SELECT * FROM (SELECT *, 'deep' AS page, count(*) OVER () AS total, count(*) OVER () > 190 AS has_more FROM tools ORDER BY tool_name, source LIMIT 70 OFFSET 120)
UNION ALL BY NAME SELECT *, 'some' AS page FROM ({SQL["registry_page"]})"""
SQL["stream_guarded_turns"] = f"""WITH {TURNS},
m AS (SELECT *, TIMESTAMP '2024-01-01 00:00:00' + to_minutes(conv_id * 10 + turn + CASE WHEN role = 'assistant' AND conv_id % 7 = 3 THEN 60 ELSE 0 END) AS ts FROM turns),
i AS (SELECT * FROM m WHERE role = 'user'), o AS (SELECT * FROM m WHERE role = 'assistant'),
mark AS (SELECT least((SELECT max(ts) FROM i), (SELECT max(ts) FROM o)) - INTERVAL 10 MINUTE AS passed),
j AS (SELECT coalesce(i.conv_id, o.conv_id) AS conv_id, coalesce(i.turn, o.turn - 1) AS turn, i.turn IS NOT NULL AND o.turn IS NOT NULL AS answered, i.turn IS NULL AS late,
  i.d_safety AS in_safety, o.d_privacy, o.d_fairness, i.ts AS in_ts, o.ts AS out_ts
  FROM i FULL JOIN o ON i.conv_id = o.conv_id AND o.turn = i.turn + 1 AND o.ts BETWEEN i.ts AND i.ts + INTERVAL 5 MINUTE)
SELECT conv_id, turn, answered, late, CASE WHEN in_safety < 3.0 THEN 'input' WHEN d_privacy < 4.0 OR d_fairness < 3.0 THEN 'output' END AS stage,
  coalesce(in_safety < 3.0, FALSE) OR coalesce(d_privacy < 4.0 OR d_fairness < 3.0, FALSE) AS blocked,
  CASE WHEN in_safety < 3.0 THEN 'safety' ELSE concat_ws(',', CASE WHEN d_privacy < 4.0 THEN 'privacy' END, CASE WHEN d_fairness < 3.0 THEN 'fairness' END) END AS failed
FROM j, mark WHERE answered OR in_ts + INTERVAL 5 MINUTE < passed OR (late AND out_ts < passed)"""
SQL["stream_incidents"] = SQL["incidents"]
SQL["stream_score_fanout"] = SQL["score_fanout"]
_LONG = "CASE WHEN regexp_full_match(text, {blank}) THEN 'empty_content' WHEN length(text) < 1 THEN 'content_too_short' WHEN length(text) > {most} THEN 'content_too_long' END AS {name}"
SQL["compliance_content_validation"] = f"""SELECT doc_id, {_LONG.format(blank=q(BLANK), most=50_000, name="error")}, {_LONG.format(blank=q(BLANK), most=2000, name="narrow_error")} FROM documents"""
SQL["iteration_thresholds"] = f"""WITH {CANDIDATES}, m AS (SELECT *, score >= 5.0 AND confidence >= 0.6 AND coalesce(d_safety >= 3.0, TRUE) AND coalesce(d_privacy >= 6.0, TRUE) AS ok,
  concat_ws(',', CASE WHEN d_safety < 3.0 THEN 'safety' END, CASE WHEN d_privacy < 6.0 THEN 'privacy' END) AS failing FROM candidates WHERE iteration <= 4),
b AS (SELECT conv_id, min(iteration) FILTER (ok) AS met, max(iteration) AS last, arg_max(iteration, {{'s': score, 'i': -iteration}}) AS highest FROM m GROUP BY conv_id)
SELECT conv_id, iteration, ok AS thresholds_met, failing, CASE WHEN met IS NOT NULL THEN 'passed' WHEN last >= 4 THEN 'max_iterations_reached' ELSE 'awaiting_regeneration' END AS status,
  coalesce(met, highest) AS best_iteration FROM m JOIN b USING (conv_id) WHERE met IS NULL OR iteration <= met"""
SQL["stream_observed_policy"] = f"""WITH {CALLS} SELECT count(*) AS "rows", count(*) FILTER (decision = 'BLOCK' OR score < 2.5) AS blocked,
  count(*) FILTER (NOT (decision = 'BLOCK' OR score < 2.5) AND (decision = 'FLAG' OR score < 6.5)) AS flagged,
  count(*) FILTER (NOT (decision = 'BLOCK' OR score < 2.5) AND NOT (decision = 'FLAG' OR score < 6.5)) AS allowed FROM calls"""
SQL["model_scorer"] = """SELECT doc_id, CASE WHEN doc_id % 5 <> 0 THEN (length(text) % 101) / 10.0 END::DOUBLE AS score, CASE WHEN doc_id % 5 <> 0 THEN 0.5 END::DOUBLE AS confidence,
  CASE WHEN doc_id % 5 <> 0 THEN 0.9 END::DOUBLE AS deep_confidence, CASE WHEN doc_id % 5 <> 0 THEN 1.0 END::DOUBLE AS set_ups, CASE WHEN doc_id % 5 <> 0 THEN 1.0 END::DOUBLE AS deep_set_ups FROM documents"""


def _chained(conversations, order, periodic):
    """Turn by turn: a turn is deep if its number says so or the score before it is low."""
    return f"""WITH RECURSIVE t AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY {order}) AS turn_number FROM ({conversations})),
r AS (
  SELECT conv_id, turn_number, CASE WHEN {periodic} THEN 'deep' ELSE 'basic' END AS mode,
    (length(text) % CASE WHEN {periodic} THEN 89 ELSE 101 END) / 10.0 AS score FROM t WHERE turn_number = 1
  UNION ALL
  SELECT conv_id, turn_number, CASE WHEN deep THEN 'deep' ELSE 'basic' END, (size % CASE WHEN deep THEN 89 ELSE 101 END) / 10.0
  FROM (SELECT t.conv_id, t.turn_number, length(t.text) AS size, r.score < 7.0 OR {periodic.replace("turn_number", "t.turn_number")} AS deep
        FROM r JOIN t ON t.conv_id = r.conv_id AND t.turn_number = r.turn_number + 1))"""


SQL["conversation_scoring"] = f"""{_chained("SELECT conv_id, turn, text FROM conversations", "turn", "turn_number % 5 = 0")}
SELECT conv_id, turn, turn_number, mode, score, CASE mode WHEN 'deep' THEN 0.9 ELSE 0.5 END::DOUBLE AS confidence FROM r JOIN t USING (conv_id, turn_number)"""
_SPREAD = "SELECT CASE WHEN (conv_id * 8 + turn) % 3 = 0 THEN -1 ELSE conv_id END AS conv_id, conv_id AS part, turn, text FROM conversations"
SQL["conversation_scoring_chained"] = f"""{_chained(_SPREAD, "part, turn", "FALSE")}
SELECT conv_id, part, turn, turn_number, mode, score FROM r JOIN t USING (conv_id, turn_number)"""
_KEPT = f"""{_accepted(40, 20 * 24 * 60, True)},
kept AS (SELECT * REPLACE (row_number() OVER (PARTITION BY session_id ORDER BY n) AS n, count(*) OVER (PARTITION BY session_id) AS total) FROM final WHERE accepted)"""
SQL["stream_agent_patterns"] = "WITH " + _patterns(_KEPT, "kept")
SQL["stream_agent_summaries"] = f"SELECT * EXCLUDE (duration_seconds) FROM ({SQL['agent_closed_summary']})"
SQL["encode_endpoints"] = f"""WITH {TEXT_CALLS}
SELECT call_id, 'safe-regenerate' AS endpoint, '{{"content":' || to_json(opening)::VARCHAR || ',"max_regenerations":' || (k % 5) || CASE WHEN k % 2 = 0 THEN ',"regeneration_model":"external"' ELSE '' END ||
  CASE WHEN k % 3 = 0 THEN ',"policy_hint":{{"tone":"calm"}}' ELSE '' END || '}}' AS body FROM text_calls
UNION ALL SELECT call_id, 'safe-regenerate/continue', '{{"session_id":"' || call_id || '","regenerated_content":' || to_json(opening)::VARCHAR || '}}' FROM text_calls
UNION ALL SELECT call_id, 'agent/tool-result', '{{"tool_name":"' || tool_name || '","tool_result":{{"data":{{"k":' || k || '}}}}' || CASE WHEN k % 2 = 0 THEN ',"checks":["pii"]' ELSE '' END || '}}' FROM calls
UNION ALL SELECT call_id, 'agent/prompt-injection', '{{"content":' || to_json(opening)::VARCHAR || CASE WHEN k % 2 = 0 THEN ',"content_source":"user_input"' ELSE '' END || '}}' FROM text_calls
UNION ALL SELECT call_id, 'agent/registry/tools', '{{"tool_name":"' || tool_name || '","risk_level":"high"' || CASE WHEN k % 2 = 0 THEN ',"thresholds":{{"block_below":4.5}}' ELSE '' END || '}}' FROM calls"""
SQL["decode_multi_compliance"] = f"""WITH {_requirements(7.0)} SELECT doc_id, framework, compliance_score, label, CAST(requirements_checked AS INTEGER) AS requirements_checked,
  CAST(count(*) OVER (PARTITION BY doc_id) AS INTEGER) AS frameworks_evaluated FROM labelled_checks"""
SQL["cross_framework_log"] = f"""WITH {_requirements(7.0)}, s AS (SELECT doc_id, count(*) AS n, round(avg(compliance_score), 8) AS mean, min(compliance_score) AS low, arg_min(framework, {{'s': compliance_score, 'f': framework}}) AS weakest FROM checks GROUP BY doc_id)
SELECT doc_id, 'INFO' AS level, '[Compliance] Cross-framework summary: frameworks=' || n || ' | avg_score=' || {fixed('mean', 2)} || ' | weakest=' || weakest || ' (' || {fixed('low', 2)} || ')' AS line FROM s"""
SQL["blocked_plans"] = f"""WITH {STEPS}, p AS (SELECT plan_id, count(*) AS steps, count(*) FILTER (decision = 'BLOCK') AS b,
  string_agg(CAST(step_index AS VARCHAR), ', ' ORDER BY step_index) FILTER (decision = 'BLOCK') AS idx FROM steps GROUP BY plan_id)
SELECT plan_id, CASE WHEN b = steps THEN 'BLOCK_ALL' ELSE 'PARTIAL_BLOCK' END AS overall_decision, CAST(b AS INTEGER) AS blocked,
  CASE WHEN b = steps THEN 'All ' || steps || ' steps are blocked.' ELSE (steps - b) || ' of ' || steps || ' steps can proceed. Blocked steps: [' || idx || '].' END AS plan_summary
FROM p WHERE steps <= 20 AND b > 0"""

# Result types as the jobs give them, where SQL's own counting type is wider.
TYPES = {
    "guardrail_pairs": {"result_chars": "INTEGER"},
    "guard_turn_policies": {"result_chars": "INTEGER"},
    "guarded_conversations": {"result_chars": "INTEGER"},
    "agent_risk_summary": {"patterns_detected": "INTEGER"},
    "tool_result_scan": {"entities": "INTEGER", "redacted_chars": "INTEGER"},
    "rule_scorer": {"n_email": "INTEGER", "n_ip": "INTEGER", "n_card": "INTEGER", "n_token": "INTEGER"},
    "top_issues": {"rank": "INTEGER"},
    "best_iteration": {"best_chars": "INTEGER"},
    "decode_evaluations": {"chars": "INTEGER"},
    "decode_scans": {"entities": "INTEGER"},
    "decode_plan_steps": {"step_index": "INTEGER"},
    "decode_compliance_results": {"requirements_checked": "INTEGER"},
    "decode_regenerations": {"position": "INTEGER", "iteration": "INTEGER", "chars": "INTEGER"},
    "extracted_answers": {"chars": "INTEGER", "completion_tokens": "BIGINT"},
}
for _name, _columns in TYPES.items():
    _casts = ", ".join(f"CAST({c} AS {t}) AS {c}" for c, t in _columns.items())
    SQL[_name] = f"SELECT * REPLACE ({_casts}) FROM ({SQL[_name]})"
