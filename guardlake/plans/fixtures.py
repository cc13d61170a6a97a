"""Deterministic operator inputs derived from whole given tables.

Arbitrary test rules, not a scoring model.  Scores are carried as integer tenths
and divided last, so Spark and another engine give the same doubles.
"""

from pyspark.sql import functions as F

from guardlake.operators.lookups import lookup_join
from guardlake.operators.ordered import ordered_columns
from guardlake.operators.scoring import SIGNALS, with_signals
from guardlake.schemas import DIM_COLUMNS, VIOLATION
from guardlake.sources.readers import read_table


def read(spark, sf_dir, table):
    return read_table(spark, f"{sf_dir}/{table}.parquet")


def k():
    return F.get_json_object("props", "$.k").cast("int")


def agent_calls(spark, sf_dir):
    """One tool call per event; the user is the session."""
    return calls_from_events(read(spark, sf_dir, "events"))


def calls_with_texts(spark, sf_dir):
    """Calls with the opening of a conversation as ``opening``, and with a ``result``: that text, JSON, or none."""
    eid = F.col("call_id")
    openings = opening_texts(spark, sf_dir)
    calls = lookup_join(quoting(agent_calls(spark, sf_dir), openings, "call_id"), openings, ["quoted"], ["call_id"])
    calls = calls.withColumn("opening", F.coalesce("opening", F.lit("no such text")))
    result = F.when(eid % 3 == 0, F.col("params")).when(eid % 3 == 1, F.col("opening"))
    return calls.withColumn("result", result).drop("quoted")


def calls_from_events(events):
    ev = events.withColumn("k", k())
    K, eid = F.col("k"), F.col("event_id")
    dims = {
        c: ((K * (2 * i + 3) + eid * (i + 1)) % 101) / F.lit(10.0) for i, c in enumerate(DIM_COLUMNS)
    }
    dims["d_user_impact"] = F.when(eid % 7 != 0, dims["d_user_impact"])

    def violation(framework, article, severity):
        return F.struct(
            F.lit(framework).alias("framework"),
            F.lit(article).alias("article"),
            F.lit("").alias("title"),
            F.lit(severity).alias("severity"),
            F.lit("").alias("description"),
            F.lit("").alias("remediation"),
        )

    step = K % 25
    one = (
        F.when(step == 0, violation("gdpr", "Art. 5", "critical"))
        .when(step.isin(1, 2), violation("eu_ai_act", "Art. 10", "high"))
        .when(step.isin(3, 4, 5), violation("ccpa", "1798.100", "medium"))
        .when(step == 6, violation("hipaa", "164.312", "low"))
    )
    return ev.select(
        F.col("user_id").alias("session_id"),
        eid.alias("call_id"),
        "ts",
        F.col("event_type").alias("tool_name"),
        "k",
        (K / F.lit(10.0)).alias("score"),
        ((50 + (K * 3 + eid) % 51) / F.lit(100.0)).alias("confidence"),
        *[e.alias(c) for c, e in dims.items()],
        F.when(K < 30, "BLOCK").when(K < 60, "FLAG").otherwise("ALLOW").alias("decision"),
        F.concat(F.lit("rule "), (K % 10).cast("string")).alias("decision_reason"),
        F.when(K % 10 == 0, F.array(F.lit("ssn")))
        .when(K % 10 == 1, F.array(F.lit("ssn"), F.lit("dob")))
        .otherwise(F.array().cast("array<string>"))
        .alias("pii_fields"),
        F.when(one.isNull(), F.array().cast(f"array<{VIOLATION}>")).otherwise(F.array(one)).alias("violations"),
        F.when(eid % 5 == 0, 1.5).otherwise(0.5).alias("credits"),
        F.col("props").alias("params"),
        F.when((K < 30) & (eid % 2 == 0), '{"k":99}').alias("suggested_params"),
        F.concat_ws(
            ":", F.col("user_id").cast("string"), F.date_format(F.date_trunc("week", "ts"), "yyyy-MM-dd")
        ).alias("plan_id"),
    )


def plan_steps(spark, sf_dir):
    """Calls numbered from 0 inside their plan."""
    calls = agent_calls(spark, sf_dir).select("plan_id", "call_id", "ts", "tool_name", "score", "decision", "credits")
    out = ordered_columns(calls, ["plan_id"], ["ts", "call_id"], number="_n")
    return out.withColumn("step_index", (F.col("_n") - 1).cast("int")).drop("_n")


def turn_evaluations(spark, sf_dir):
    """One evaluation per conversation turn."""
    size = F.length("text")
    turn, conv = F.col("turn"), F.col("conv_id")
    return read(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        "role",
        "text",
        (((size * 7 + turn * 13 + conv * 5) % 101) / F.lit(10.0)).alias("score"),
        ((50 + (size + turn) % 51) / F.lit(100.0)).alias("confidence"),
        *[
            (((size * (i + 2) + turn * (i + 5) + conv) % 101) / F.lit(10.0)).alias(c)
            for i, c in enumerate(DIM_COLUMNS)
        ],
    )


def candidates(spark, sf_dir):
    """Assistant turns of a conversation as successive rewrites."""
    turns = turn_evaluations(spark, sf_dir).where(F.col("role") == "assistant")
    return ordered_columns(turns, ["conv_id"], ["turn"], number="iteration")


def document_signals(spark, sf_dir):
    """Signals of each document with its labels where there are any; texts stay out of the join."""
    docs = with_signals(read(spark, sf_dir, "documents")).select("doc_id", "lang", *SIGNALS)
    return docs.join(read(spark, sf_dir, "labels"), "doc_id", "left")


def tool_registry(spark, sf_dir):
    """A registry as large as the part table: each part is a tool, some brands' are custom."""
    size = F.col("p_size")
    return read(spark, sf_dir, "part").select(
        F.concat_ws("_", F.translate("p_name", " ", "_"), F.col("p_partkey").cast("string")).alias("tool_name"),
        F.when(size <= 12, "low").when(size <= 25, "medium").when(size <= 40, "high").otherwise("critical").alias("risk_level"),
        F.when(F.col("p_brand").startswith("Brand#1"), "org_custom").otherwise("system").alias("source"),
        F.col("p_type").alias("description"),
    )


def tool_registrations(spark, sf_dir):
    """A log of registrations: each line item registers its part's tool anew."""
    qty = F.col("l_quantity")
    lines = read(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag"
    )
    parts = read(spark, sf_dir, "part").select("p_partkey", "p_name")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.concat_ws("_", F.translate("p_name", " ", "_"), F.col("p_partkey").cast("string")).alias("tool_name"),
        F.when(qty <= 12, "low").when(qty <= 25, "medium").when(qty <= 40, "high").otherwise("critical").alias("risk_level"),
        F.concat(F.lit("flag "), F.col("l_returnflag")).alias("description"),
        F.col("l_shipdate").alias("registered_at"),
        F.col("l_orderkey").alias("order_no"),
        F.col("l_linenumber").alias("line_no"),
        qty.alias("quantity"),
    )


def event_tool_registry(spark, sf_dir):
    """Profiles of the tools seen in the events: a system row each, a custom row for purchases.

    A tool's system risk follows from its name.
    """
    tools = read(spark, sf_dir, "events").groupBy(F.col("event_type").alias("tool_name")).agg(F.count(F.lit(1)).alias("calls"))
    name = F.col("tool_name")
    null_list = F.lit(None).cast("array<string>")
    thresholds = "struct<block_below:double,flag_below:double>"
    system = tools.select(
        "tool_name",
        F.when(name.isin("error", "purchase"), "high").when(name == "signup", "medium").otherwise("low").alias("risk_level"),
        F.lit("system").alias("source"),
        F.lit(None).cast(thresholds).alias("thresholds"),
        F.when(name == "signup", F.array(F.lit("zip"), F.lit("k"))).alias("proxy_variable_watch"),
        null_list.alias("pii_fields_watch"),
    )
    custom = tools.where(name == "purchase").select(
        "tool_name",
        F.lit("high").alias("risk_level"),
        F.lit("org_custom").alias("source"),
        F.struct(F.lit(6.0).alias("block_below"), F.lit(8.0).alias("flag_below")).cast(thresholds).alias("thresholds"),
        null_list.alias("proxy_variable_watch"),
        F.array(F.lit("k")).alias("pii_fields_watch"),
    )
    return system.unionByName(custom)


def opening_texts(spark, sf_dir):
    """First turn of every conversation."""
    first = F.min_by("text", "turn").alias("opening")
    return read(spark, sf_dir, "conversations").groupBy(F.col("conv_id").alias("quoted")).agg(first)


def quoting(rows, openings, event_id):
    """Add ``quoted``, a conversation of the whole table: the first one for a third of all rows, which is hot."""
    size = openings.select((F.max("quoted") + 1).alias("_conversations"))  # one row
    other = F.col(event_id) % F.col("_conversations")
    return rows.join(F.broadcast(size)).withColumn("quoted", F.when(F.col("k") % 3 == 0, 0).otherwise(other)).drop("_conversations")


def requests(spark, sf_dir):
    """A request log: each event asks one of five endpoints about the opening of a conversation."""
    return requests_from_events(read(spark, sf_dir, "events"), opening_texts(spark, sf_dir))


def requests_from_events(events, openings):
    """The same from given events, streaming or not.

    Fields come in either order, which does not matter to a request's key; so do
    those of the nested object, where it does.
    """
    K, eid = F.col("k"), F.col("event_id")
    quoted = quoting(events.withColumn("k", k()), openings, "event_id")
    quoted = quoted.join(openings, "quoted", "left").withColumn("opening", F.coalesce("opening", F.lit("no such text")))
    content, mode = F.to_json(F.struct(F.col("opening").alias("content"))), F.lit('"mode":"basic"')
    inner = F.substring(content, 2, F.length(content) - 2)
    nested = F.when(eid % 5 == 0, ',"meta":{"b":1,"a":2}').otherwise(',"meta":{"a":2,"b":1}')
    body = F.when(eid % 2 == 0, F.concat(F.lit("{"), inner, F.lit(","), mode, nested, F.lit("}"))).otherwise(
        F.concat(F.lit("{"), mode, nested, F.lit(","), inner, F.lit("}"))
    )
    return quoted.select(
        eid.alias("request_id"),
        "ts",
        F.when(F.col("event_type") == "click", "eval")
        .when(F.col("event_type") == "view", "compliance/check")
        .when(F.col("event_type") == "purchase", "agent/tool-call")
        .when(F.col("event_type") == "signup", "safe-regenerate")
        .otherwise("health")
        .alias("endpoint"),
        F.when(K % 3 == 0, "deep").otherwise("basic").alias("mode"),
        (K / F.lit(10.0)).alias("score"),
        ((50 + K % 51) / F.lit(100.0)).alias("confidence"),
        F.when(K % 3 == 0, 1.5).otherwise(0.5).alias("credits_consumed"),
        (K % 4 == 0).alias("from_cache"),
        (K * 10 + eid % 10).cast("bigint").alias("duration_ms"),
        F.when(K >= 90, "RateLimitError").when(K >= 85, "TimeoutError").alias("error_type"),
        body.alias("body"),
        F.col("user_id"),
    )


def regeneration_steps(events):
    """Events as steps of external regeneration sessions, a user's by one key."""
    met = F.get_json_object("props", "$.k").cast("int") >= 90
    return events.select(F.col("user_id").alias("session_id"), "ts", met.alias("met"))
