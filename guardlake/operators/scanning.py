"""Personal data, secrets and prompt injection in texts.  The rules are ours."""

from pyspark.sql import functions as F

from guardlake.functions import let, preview
from guardlake.operators.scoring import CARD, EMAIL, IPV4, NEEDLES, TOKEN, has_match

# Entity types in the order redaction applies them.
PII_RULES = (
    ("secret", TOKEN, "[SECRET]", ("security",)),
    ("card", CARD, "[CARD]", ("pci_dss",)),
    ("email", EMAIL, "[EMAIL]", ("gdpr", "ccpa")),
    ("ip", IPV4, "[IP]", ("gdpr",)),
)

# Attack type, pattern, severity, and words of which a match holds one
# (in lower case; testing them first spares most rows the regex).
INJECTION_RULES = (
    (
        "direct_instruction_override",
        r"(?i)\b(?:ignore|disregard|forget)\b[^.\n]{0,40}\b(?:previous|prior|above|earlier)\b[^.\n]{0,40}\b(?:instructions?|rules?|prompts?)\b",
        "critical",
        ("ignore", "disregard", "forget"),
    ),
    (
        "data_exfiltration",
        r"(?i)\b(?:send|post|upload|reveal|print)\b[^.\n]{0,60}\b(?:password|api key|secret|system prompt)\b",
        "critical",
        ("password", "api key", "secret", "system prompt"),
    ),
    (
        "jailbreak",
        r"(?i)\b(?:jailbreak|developer mode|without any restrictions)\b",
        "high",
        ("jailbreak", "developer mode", "without any restrictions"),
    ),
    (
        "role_hijack",
        r"(?i)\byou are now\b|\bpretend to be\b|\bact as (?:an?|the) (?:admin|root|system)\b",
        "high",
        ("you are now", "pretend to be", "act as "),
    ),
    ("context_manipulation", r"(?i)(?:^|\n)\s*(?:system|assistant)\s*:", "medium", ("system", "assistant")),
)
SEVERITY_RANK = {"low": 1, "medium": 2, "high": 3, "critical": 4}
INJECTION_CREDITS = 0.5


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def _total(values):
    return F.aggregate(values, F.lit(0), lambda a, v: a + v)


def _entities(text, kind, pattern):
    """Matches of one type as ``(type, value, offset, should_redact)``; offsets count code points.

    The lengths of the parts between matches and of the matches themselves add
    up to the offsets.  They are summed by blocks of about the square root of
    their number, so texts with very many matches stay cheap.
    """

    def located(found):
        matches, gaps = found["matches"], found["gaps"]
        steps = F.transform(matches, lambda m, i: F.length(F.get(gaps, i)) + F.length(m))
        width = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(matches))).cast("int"))
        return let(F.struct(steps.alias("steps"), width.alias("width")), lambda s: blocked(found, s["steps"], s["width"]))

    def blocked(found, steps, width):
        blocks = F.transform(
            F.sequence(F.lit(0), F.floor(F.size(steps) / width).cast("int")),
            lambda b: _total(F.slice(steps, b * width + 1, width)),
        )
        starts = let(blocks, lambda sums: F.transform(sums, lambda _, b: _total(F.slice(sums, F.lit(1), b))))
        return let(starts, lambda at: F.transform(found["matches"], lambda m, i: entity(found, steps, width, at, m, i)))

    def entity(found, steps, width, starts, m, i):
        block = F.floor(i / width).cast("int")
        before = F.get(starts, block) + _total(F.slice(steps, block * width + 1, i - block * width))
        return F.struct(
            F.lit(kind).alias("type"),
            m.alias("value"),
            (before + F.length(F.get(found["gaps"], i))).alias("offset"),
            F.lit(True).alias("should_redact"),
        )

    return let(
        F.struct(
            F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("matches"),
            F.split(text, pattern, -1).alias("gaps"),
        ),
        located,
    )


def redact(c):
    """Text with every entity replaced by its tag."""
    out = _c(c)
    for _, pattern, tag, _ in PII_RULES:
        cleaned = F.regexp_replace(out, F.lit(pattern), F.lit(tag))
        if pattern in NEEDLES:
            cleaned = F.when(F.contains(out, F.lit(NEEDLES[pattern])), cleaned).otherwise(out)
        out = cleaned
    return out


def scan_pii(df, text_col="text"):
    """Add ``entities``, ``pii_found``, ``redacted_text`` (null when nothing found), ``compliance_flags``."""
    text = F.col(text_col)
    # Each rule is tested once; only texts it hits are searched and rewritten.
    hit = {kind: F.coalesce(F.col(f"_hit_{kind}"), F.lit(False)) for kind, _, _, _ in PII_RULES}
    out = df.withColumns({f"_hit_{kind}": has_match(text, pattern) for kind, pattern, _, _ in PII_RULES})
    none = F.array().cast("array<struct<type:string,value:string,offset:int,should_redact:boolean>>")
    parts = [F.when(hit[k], _entities(text, k, p)).otherwise(none) for k, p, _, _ in PII_RULES]
    flags = F.array_distinct(
        F.array_compact(F.array(*[F.when(hit[k], F.lit(flag)) for k, _, _, flags in PII_RULES for flag in flags]))
    )
    any_hit = F.lit(False)
    redacted = text
    for kind, pattern, tag, _ in PII_RULES:
        any_hit = any_hit | hit[kind]
        redacted = F.when(hit[kind], F.regexp_replace(redacted, F.lit(pattern), F.lit(tag))).otherwise(redacted)
    return out.withColumns(
        {
            "entities": F.when(any_hit, F.concat(*parts)).otherwise(none),
            "pii_found": any_hit,
            "redacted_text": F.when(any_hit, redacted),
            "compliance_flags": flags,
        }
    ).drop(*[f"_hit_{kind}" for kind, _, _, _ in PII_RULES])


def pii_entities(df, key, text_col="text"):
    """One row per entity."""
    return scan_pii(df, text_col).select(key, F.inline("entities"))


def check_injection(df, text_col="text", rules=INJECTION_RULES):
    """Add ``injection_detected, attack_type, severity, payload_preview, injection_action, injection_credits``.

    Of the rules that hit, the most severe decides; the earlier rule wins a tie.
    """
    text, low = F.col(text_col), F.col("_low")

    def hits(pattern, words):
        worth = F.lit(False)
        for word in words:
            worth = worth | F.contains(low, F.lit(word))
        return worth & text.rlike(pattern)

    # Most severe first, so the first branch that holds decides.
    ranked = sorted(enumerate(rules), key=lambda r: (-SEVERITY_RANK[r[1][2]], r[0]))
    which = None
    for i, (_, pattern, _, words) in ranked:
        hit = hits(pattern, words)
        which = F.when(hit, i) if which is None else which.when(hit, i)
    out = df.withColumn("_low", F.lower(text)).withColumn("_rule", which).drop("_low")

    def of_rule(value):
        chosen = None
        for i, rule in enumerate(rules):
            at = F.col("_rule") == i
            chosen = F.when(at, value(rule)) if chosen is None else chosen.when(at, value(rule))
        return chosen

    out = out.withColumns(
        {
            "injection_detected": F.col("_rule").isNotNull(),
            "attack_type": F.coalesce(of_rule(lambda r: F.lit(r[0])), F.lit("none")),
            "severity": F.coalesce(of_rule(lambda r: F.lit(r[2])), F.lit("none")),
            "payload_preview": of_rule(lambda r: preview(F.regexp_extract(text, r[1], 0), 200)),
        }
    )
    severity = F.col("severity")
    return out.withColumns(
        {
            "injection_action": F.when(severity.isin("high", "critical"), "BLOCK")
            .when(F.col("injection_detected"), "FLAG")
            .otherwise("PASS"),
            "injection_credits": F.lit(INJECTION_CREDITS),
        }
    ).drop("_rule")


def recommend_action(df):
    """Add ``recommended_action`` and ``risk_level`` from the PII and injection findings."""
    severe = F.col("severity").isin("high", "critical")
    injected = F.col("injection_detected")
    pii = F.col("pii_found")
    sensitive = F.exists("entities", lambda e: e["type"].isin("secret", "card"))
    return df.withColumns(
        {
            "recommended_action": F.when(severe, "BLOCK")
            .when(injected & pii, "REDACT_AND_FLAG")
            .when(injected, "FLAG")
            .when(pii & sensitive, "REDACT_AND_FLAG")
            .when(pii, "REDACT_AND_PASS")
            .otherwise("PASS"),
            "risk_level": F.when(F.col("severity") == "critical", "critical")
            .when(severe | sensitive, "high")
            .when(injected | pii, "medium")
            .otherwise("low"),
        }
    )


def scan_tool_results(df, text_col="text"):
    """PII scan, injection check and recommended action in one pass over the texts."""
    return recommend_action(check_injection(scan_pii(df, text_col), text_col))
