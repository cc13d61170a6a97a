"""Tool risk registry: effective profiles, paging, upsert, delete, call assessment."""

from pyspark.sql import functions as F

from guardlake.functions import is_blank

from guardlake.operators.lookups import lookup_join, telling_columns

GENERIC = "generic"
FALLBACK_RISK = "low"


def effective_registry(registry):
    """One profile per tool: the organisation's own wins over the system's."""
    rank = F.when(F.col("source") == "org_custom", 0).otherwise(1)
    fields = [c for c in registry.columns if c != "tool_name"]
    return (
        registry.groupBy("tool_name").agg(F.min_by(F.struct(*fields), rank).alias("p")).select("tool_name", "p.*")
    )


def with_tool_profile(calls, registry, *, tool_col="tool_name", id_cols=None, chunk_rows=None):
    """Add ``profile_*`` columns of each call's tool; unknown tools get the generic profile.

    The registry is broadcast only if Spark finds it small enough; otherwise the
    calls of a hot tool are salted by ``id_cols`` (by default ``call_id``, or all
    plain columns if there is none).
    """
    default = ["call_id"] if "call_id" in calls.columns else telling_columns(calls, [tool_col])
    ids = list(id_cols) if id_cols else default
    table = effective_registry(registry)
    renamed = table.select(
        F.col("tool_name").alias(tool_col),
        F.lit(True).alias("_known"),
        *[F.col(c).alias(f"profile_{c}") for c in table.columns if c != "tool_name"],
    )
    out = lookup_join(calls, renamed, [tool_col], ids, chunk_rows=chunk_rows)
    return out.withColumns(
        {
            "profile_name": F.when(F.col("_known"), F.col(tool_col)).otherwise(GENERIC),
            "profile_risk_level": F.coalesce("profile_risk_level", F.lit(FALLBACK_RISK)),
            "profile_source": F.coalesce("profile_source", F.lit("system")),
        }
    ).drop("_known")


def watch_hits(params, watch):
    """Parameter names that are on a watch list, in parameter order."""
    params = F.col(params) if isinstance(params, str) else params
    watch = F.col(watch) if isinstance(watch, str) else watch
    none = F.array().cast("array<string>")
    return F.array_intersect(F.coalesce(F.json_object_keys(params), none), F.coalesce(watch, none))


def assess_tool_calls(calls, registry, *, block_below=4.0, flag_below=7.0, high_stakes=("finance", "healthcare", "hr", "legal")):
    """Add signals and a decision per call.  The rule set is ours.

    BLOCK below the tool's (or default) block threshold, or when a critical tool
    touches watched fields; FLAG below the flag threshold, on any watched field,
    or for a high or critical tool in a high-stakes domain; else ALLOW.
    """
    out = with_tool_profile(calls, registry)
    score = F.col("score")
    domain = F.col("domain") if "domain" in calls.columns else F.lit("general")
    out = out.withColumns(
        {
            "proxy_hits": watch_hits("params", "profile_proxy_variable_watch"),
            "pii_hits": watch_hits("params", "profile_pii_fields_watch"),
            "high_stakes": domain.isin(*high_stakes),
            "block_below": F.coalesce(F.col("profile_thresholds.block_below"), F.lit(float(block_below))),
            "flag_below": F.coalesce(F.col("profile_thresholds.flag_below"), F.lit(float(flag_below))),
        }
    )
    hits = F.size("proxy_hits") + F.size("pii_hits") > 0
    risk = F.col("profile_risk_level")
    blocked = (score < F.col("block_below")) | ((risk == "critical") & hits)
    flagged = (score < F.col("flag_below")) | hits | (risk.isin("high", "critical") & F.col("high_stakes"))
    return out.withColumn("decision", F.when(blocked, "BLOCK").when(flagged, "FLAG").otherwise("ALLOW"))


def matching_tools(registry, *, source=None, risk_level=None, search=None):
    """Tools by source, risk level and a text in their name, each where given."""
    found = registry
    if source and source != "all":
        found = found.where(F.col("source") == source)
    if risk_level:
        found = found.where(F.col("risk_level") == risk_level)
    if search:
        found = found.where(F.contains(F.lower("tool_name"), F.lit(search.lower())))
    return found


def list_tools(registry, *, limit=50, offset=0, source=None, risk_level=None, search=None):
    """One page of the registry by tool name, with ``total`` and ``has_more`` on each row.

    Keeps ``offset + limit`` rows a task; :mod:`guardlake.operators.registry_pages` seeks deep pages.
    """
    found = matching_tools(registry, source=source, risk_level=risk_level, search=search)
    total = found.select(F.count(F.lit(1))).scalar()
    page = found.orderBy("tool_name", "source").offset(offset).limit(limit)
    return page.withColumn("total", total).withColumn("has_more", F.col("total") > offset + limit)


def split_unnamed(rows):
    """Rows with a tool name, and the rejected ones without, with ``error`` and ``field``."""
    blank = is_blank("tool_name")
    rejected = rows.where(blank).withColumns({"error": F.lit("tool_name is required"), "field": F.lit("tool_name")})
    return rows.where(~blank), rejected


def register_tools(registry, new, *, order_cols=("registered_at",)):
    """Upsert custom profiles by tool name; the latest registration of a tool wins.

    Returns the new registry and the rejected registrations, which have no tool name.
    """
    new, rejected = split_unnamed(new)
    fields = [c for c in new.columns if c not in ("tool_name", "source") and c not in order_cols]
    latest = (
        new.groupBy("tool_name")
        .agg(F.max_by(F.struct(*fields), F.struct(*order_cols)).alias("p"))
        .select("tool_name", "p.*")
        .withColumn("source", F.lit("org_custom"))
    )
    custom = F.col("source") == "org_custom"
    kept = registry.where(custom).join(latest.select("tool_name"), "tool_name", "left_anti")
    return registry.where(~custom).unionByName(kept).unionByName(latest, allowMissingColumns=True), rejected


def delete_tools(registry, names):
    """Remove custom profiles.  Returns the new registry, one report row per name, and the rejected rows without a name."""
    names, rejected = split_unnamed(names)
    names = names.select("tool_name").distinct()
    custom = F.col("source") == "org_custom"
    kept = registry.where(~custom).unionByName(registry.where(custom).join(names, "tool_name", "left_anti"))
    known = registry.groupBy("tool_name").agg(
        F.bool_or(custom).alias("had_custom"), F.bool_or(~custom).alias("had_system")
    )
    report = names.join(known, "tool_name", "left").select(
        "tool_name",
        F.coalesce("had_custom", F.lit(False)).alias("deleted"),
        F.when(F.col("had_system"), F.col("tool_name")).otherwise(GENERIC).alias("fallback"),
    )
    return kept, report, rejected
