"""Compliance checks of scored content against requirement catalogues."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from guardlake.functions import compliance_threshold, format_score, preview, resolve_framework, score_label, severity_level
from guardlake.schemas import DIMENSIONS, FRAMEWORK_ALIASES, FRAMEWORKS, dim_column

# Fixed values, ours: framework, requirement id, article, dimension sources, severity when failed.
REQUIREMENTS = (
    ("gdpr", "gdpr-5", "Art. 5", ("privacy", "transparency"), "high"),
    ("gdpr", "gdpr-22", "Art. 22", ("fairness", "accountability"), "medium"),
    ("gdpr", "gdpr-32", "Art. 32", ("privacy", "safety"), "critical"),
    ("ccpa", "ccpa-100", "1798.100", ("privacy",), "medium"),
    ("ccpa", "ccpa-105", "1798.105", ("privacy", "accountability"), "low"),
    ("hipaa", "hipaa-312", "164.312", ("privacy", "safety"), "critical"),
    ("hipaa", "hipaa-502", "164.502", ("privacy", "reliability"), "high"),
    ("eu_ai_act", "aia-10", "Art. 10", ("fairness", "reliability"), "high"),
    ("eu_ai_act", "aia-13", "Art. 13", ("transparency",), "medium"),
    ("eu_ai_act", "aia-15", "Art. 15", ("reliability", "safety"), "high"),
    ("india_dpdp", "dpdp-6", "Sec. 6", ("privacy", "transparency"), "medium"),
    ("india_dpdp", "dpdp-8", "Sec. 8", ("privacy", "safety"), "high"),
    ("india_ai_gov", "iag-1", "Principle 1", ("safety", "user_impact"), "medium"),
    ("india_ai_gov", "iag-4", "Principle 4", ("fairness", "inclusivity"), "low"),
)
EFFORT = (("critical", "high"), ("high", "high"), ("medium", "medium"), ("low", "low"))
DEADLINE_DAYS = (("critical", 7), ("high", 30), ("medium", 90), ("low", 180))
WARN_BAND = 1.0
LOG_TAG = "[Compliance]"

HIGH_RISK_DOMAINS = ("healthcare", "finance", "legal", "hr", "education")
PROHIBITED_DECISIONS = ("social_scoring", "subliminal_manipulation")
AUTOMATED_DECISIONS = ("automated", "fully_automated")


def requirement_catalogue(spark, rows=REQUIREMENTS):
    """The catalogue as a table, one row per requirement."""
    return spark.createDataFrame(
        [(f, r, a, list(d), s) for f, r, a, d, s in rows],
        "framework string, requirement_id string, article string, dimension_sources array<string>, severity string",
    )


def expand_frameworks(df, frameworks):
    """One row per content and requested framework, aliases resolved.

    ``frameworks`` is a list of names, which must be known, or an array column, for
    which ``framework_name_rules`` marks the rows with unknown ones.
    """
    if isinstance(frameworks, (list, tuple)):
        if unknown := [f for f in frameworks if FRAMEWORK_ALIASES.get(f, f) not in FRAMEWORKS]:
            raise ValueError(f"unknown frameworks: {', '.join(unknown)}")
        frameworks = F.array(*[F.lit(f) for f in frameworks])
    resolved = F.array_distinct(F.transform(frameworks, resolve_framework))
    return df.withColumn("framework", F.explode(resolved))


def expand_requirements(df, requirements):
    """One row per content, framework and requirement.

    The catalogue is a fixed list of rules, never data, so it is broadcast.  It
    brings a flag per dimension it draws on, which keeps later arithmetic flat.
    """
    flagged = requirements.withColumns({f"uses_{d}": F.array_contains("dimension_sources", d) for d in DIMENSIONS})
    return df.join(F.broadcast(flagged), "framework", "inner")


def _case(c, pairs):
    out = None
    for key, value in pairs:
        out = F.when(c == key, value) if out is None else out.when(c == key, value)
    return out


def evaluate_requirements(df, requirements, strict=False):
    """Requirement rows with ``requirement_score, threshold, status``.

    The score is the mean of the source dimensions that were scored, a
    requirement without any falls back on the overall score.  Passed at or above
    the threshold, warned within one point below (our band), else failed.
    """
    rows = expand_requirements(df, requirements)
    used = {d: F.when(F.col(f"uses_{d}"), F.col(dim_column(d))) for d in DIMENSIONS if dim_column(d) in df.columns}
    total = sum((F.coalesce(c, F.lit(0.0)) for c in used.values()), F.lit(0.0))
    known = sum((c.isNotNull().cast("int") for c in used.values()), F.lit(0))
    mean = total / F.nullif(known, F.lit(0))
    rows = rows.withColumns(
        {"requirement_score": F.coalesce(mean, F.col("score")), "threshold": compliance_threshold(strict)}
    )
    value, bar = F.col("requirement_score"), F.col("threshold")
    status = F.when(value >= bar, "passed").when(value >= bar - WARN_BAND, "warned").otherwise("failed")
    return rows.withColumn("status", status).drop(*[f"uses_{d}" for d in DIMENSIONS])


def compliance_check(df, key, requirements, strict=False):
    """One row per content and framework: score, label, requirement counts.

    ``df`` already has one row per content and framework (see :func:`expand_frameworks`).
    """
    rows = evaluate_requirements(df, requirements, strict)
    return (
        rows.groupBy(key, "framework")
        .agg(
            F.avg("requirement_score").alias("compliance_score"),
            F.count(F.lit(1)).alias("requirements_checked"),
            F.count_if(F.col("status") == "passed").alias("requirements_passed"),
            F.count_if(F.col("status") == "failed").alias("requirements_failed"),
            F.count_if(F.col("status") == "warned").alias("requirements_warned"),
        )
        .withColumn("label", score_label(F.round("compliance_score", 9)))
    )


def compliance_issues(df, key, requirements, strict=False):
    """One row per failed requirement, as an issue."""
    rows = evaluate_requirements(df, requirements, strict).where(F.col("status") == "failed")
    return rows.select(
        key,
        "framework",
        F.concat_ws(":", F.col(key).cast("string"), "requirement_id").alias("issue_id"),
        F.concat(F.lit("Requirement "), "requirement_id", F.lit(" is not met")).alias("description"),
        F.get("dimension_sources", F.lit(0)).alias("dimension"),
        "severity",
        F.col("requirement_id").alias("requirement"),
        "article",
        _case(F.col("severity"), EFFORT).alias("remediation_effort"),
        _case(F.col("severity"), DEADLINE_DAYS).alias("remediation_deadline_days"),
    )


def cross_framework_summary(checks, *keys):
    """Frameworks evaluated, mean score, weakest framework and its score (name breaks a tie)."""
    weakest = F.min(F.struct(F.col("compliance_score").alias("s"), F.col("framework").alias("f")))
    return (
        checks.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("frameworks_evaluated"),
            F.avg("compliance_score").alias("average_score"),
            weakest.alias("_weakest"),
        )
        .select(
            *keys,
            "frameworks_evaluated",
            "average_score",
            F.col("_weakest.f").alias("weakest_framework"),
            F.col("_weakest.s").alias("weakest_score"),
        )
    )


def risk_classification(df, domain_col="domain", decision_col="decision_type"):
    """Add risk ``tier``, its ``basis`` and ``obligations`` from the context.  The rules are ours."""
    domain, kind = F.lower(F.col(domain_col)), F.lower(F.col(decision_col))
    prohibited = F.coalesce(kind.isin(*PROHIBITED_DECISIONS), F.lit(False))
    risky = F.coalesce(domain.isin(*HIGH_RISK_DOMAINS), F.lit(False))
    automated = F.coalesce(kind.isin(*AUTOMATED_DECISIONS), F.lit(False))
    tier = (
        F.when(prohibited, "unacceptable").when(risky & automated, "high").when(risky | automated, "limited").otherwise("minimal")
    )
    out = df.withColumn("tier", tier)
    names = {
        "unacceptable": ("prohibited decision type", ("do_not_deploy",)),
        "high": ("automated decisions in a high-risk domain", ("risk_management", "human_oversight", "logging")),
        "limited": ("high-risk domain or automated decisions", ("transparency_notice",)),
        "minimal": ("no risk indicator", ()),
    }
    basis = _case(F.col("tier"), [(k, v[0]) for k, v in names.items()])
    duties = _case(
        F.col("tier"),
        [(k, F.array(*[F.lit(o) for o in v[1]]).cast("array<string>")) for k, v in names.items()],
    )
    return out.withColumns({"basis": basis, "obligations": duties})


def compliance_log(checks, issues, key, *, content_col=None, tag=LOG_TAG):
    """Log lines: one INFO per checked framework, WARN or ERROR per issue; critical issues write none.

    ``content_col`` of ``checks`` adds an 80-character preview.
    """
    quoted = F.lit("")
    if content_col:
        text = F.concat(F.lit(' | content: "'), preview(content_col, 80, ellipsis=True), F.lit('"'))
        quoted = F.coalesce(F.when(F.col(content_col) != "", text), F.lit(""))
    info = checks.select(
        key,
        "framework",
        F.lit("INFO").alias("level"),
        F.concat(
            F.lit(f"{tag} "),
            "framework",
            F.lit(" | score="),
            format_score("compliance_score", 2),
            F.lit(" | label="),
            "label",
            F.lit(" | passed="),
            "requirements_passed",
            F.lit(" | failed="),
            "requirements_failed",
            quoted,
        ).alias("line"),
    )
    level = severity_level("severity")
    body = F.concat(
        F.lit(f"{tag} ["),
        "framework",
        F.lit("] "),
        F.upper("severity"),
        F.lit(" — "),
        "description",
        F.lit(" ("),
        "article",
        F.lit(")"),
    )
    line = F.when(level == "ERROR", F.concat(body, F.lit(" — remediation: "), "remediation_effort")).otherwise(body)
    found = issues.select(key, "framework", level.alias("level"), line.alias("line")).where(F.col("level").isNotNull())
    return info.unionByName(found)


def cross_framework_log(summary, key, *, tag=LOG_TAG):
    """One INFO line per content about all its frameworks."""
    return summary.select(
        key,
        F.lit("INFO").alias("level"),
        F.concat(
            F.lit(f"{tag} Cross-framework summary: frameworks="),
            "frameworks_evaluated",
            F.lit(" | avg_score="),
            format_score("average_score", 2),
            F.lit(" | weakest="),
            "weakest_framework",
            F.lit(" ("),
            format_score("weakest_score", 2),
            F.lit(")"),
        ).alias("line"),
    )


def top_issues(issues, key, k=3):
    """The ``k`` most severe issues of each content.

    The rank filter is applied before the shuffle as well, so a content with
    very many issues sends at most ``k`` of them per task.
    """
    rank = _case(F.col("severity"), (("critical", 0), ("high", 1), ("medium", 2), ("low", 3)))
    w = Window.partitionBy(key).orderBy(F.coalesce(rank, F.lit(4)), "issue_id")
    return issues.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
