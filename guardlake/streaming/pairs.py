"""Live pairing of input turns with their answers."""

from pyspark.sql import functions as F


def stream_turn_pairs(
    turns,
    key,
    turn_col="turn",
    ts="ts",
    *,
    role_col="role",
    input_role="user",
    output_role="assistant",
    carry,
    within="1 hour",
    watermark="10 minutes",
):
    """Live :func:`~guardlake.operators.conversations.pair_turns` for turns that are numbered without gaps.

    An input is paired with the turn numbered next if that is an output and comes
    no more than ``within`` after it.  An answered pair comes out at once.  An input
    without answer comes out once the watermark has passed that time, with
    ``answered`` false.  An output that no waiting input asked for, because it came
    too late or follows no input, comes out with ``late`` true and null columns of an
    input, but for key, turn (that of the output less one) and time.

    Inputs and outputs are joined by key and number, so a conversation with very
    many turns is spread; Spark's state holds the turns of ``within`` and the watermark.
    """
    keys = [key] if isinstance(key, str) else list(key)
    timed = turns.withColumn(ts, F.col(ts).cast("timestamp"))
    inputs = timed.where(F.col(role_col) == input_role).withWatermark(ts, watermark)
    outputs = timed.where(F.col(role_col) == output_role).select(
        *[F.col(k).alias(f"_of_{k}") for k in keys],
        (F.col(turn_col) - 1).alias("_asked_at"),
        F.col(ts).alias("out_ts"),
        *[F.col(c).alias(f"out_{c}") for c in carry],
        F.lit(True).alias("_out"),
    ).withWatermark("out_ts", watermark)
    same = F.col(turn_col) == F.col("_asked_at")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    in_time = (F.col("out_ts") >= F.col(ts)) & (F.col("out_ts") <= F.col(ts) + F.expr(f"INTERVAL {within}"))
    joined = inputs.withColumn("_in", F.lit(True)).join(outputs, same & in_time, "full_outer")
    both, either = F.col("_in") & F.col("_out"), {k: F.coalesce(k, f"_of_{k}") for k in keys}
    either |= {turn_col: F.coalesce(turn_col, "_asked_at"), ts: F.coalesce(ts, "out_ts")}
    return joined.select(
        *[either.get(c, F.col(c)).alias(c) for c in timed.columns],
        *[f"out_{c}" for c in carry],
        F.coalesce(both, F.lit(False)).alias("answered"),
        F.col("_in").isNull().alias("late"),
    )
