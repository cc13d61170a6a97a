"""Conversation turns: depth choice, pairing, resets, unrecorded input checks."""

from pyspark.sql import functions as F

from guardlake.functions import restrict_dimensions
from guardlake.operators.lookups import lookup_join
from guardlake.operators.ordered import ordered_columns
from guardlake.operators.scoring import score_where
from guardlake.schemas import DEFAULT_THRESHOLD


def mode_rule(turn, previous_score, explicit=None, deep_every=5, threshold=DEFAULT_THRESHOLD):
    """Depth of a turn: explicit, else every n-th or after a low score deep, else basic."""
    periodic = (turn % deep_every == 0) if deep_every > 0 else F.lit(False)
    chosen = F.when(periodic | F.coalesce(previous_score < threshold, F.lit(False)), "deep").otherwise("basic")
    return chosen if explicit is None else F.coalesce(F.nullif(explicit, F.lit("")), chosen)


def conversation_mode(
    df, key, order, *, deep_every=5, threshold=DEFAULT_THRESHOLD, explicit_col=None, chunk_rows=None
):
    """Add ``turn_number``, ``previous_score`` and ``mode`` per logged turn.

    A log already holds the scores; :func:`score_conversations` has the scorer in
    the loop.
    """
    keys = [key] if isinstance(key, str) else list(key)
    out = ordered_columns(
        df, keys, order, chunk_rows=chunk_rows, number="turn_number", lag={"previous_score": "score"}
    )
    explicit = F.col(explicit_col) if explicit_col else None
    return out.withColumn(
        "mode", mode_rule(F.col("turn_number"), F.col("previous_score"), explicit, deep_every, threshold)
    )


#: Turns that are folded together where no turn is deep by its number.
TURNS = 4096


def score_conversations(
    turns, key, order, scorer, *, text_col="text", deep_every=5, threshold=DEFAULT_THRESHOLD, explicit_col=None, chunk_rows=None
):
    """Score every turn at the depth that its number and the score before it ask for.

    The depth of a turn changes its score, and that the depth of the next one.  A
    turn is scored at each depth it can come to: deep only, if its number or an
    explicit mode says so, else both.  The chain then runs over these scores alone:
    turns between two whose number makes them deep are folded together, a group of
    ``deep_every`` turns at most, whatever the conversation's length.  Without such
    turns (``deep_every`` 0) groups of ``TURNS`` are folded for either state they can
    begin in, and the state goes from group to group.

    Adds ``turn_number``, ``mode`` and the scores.  Texts go through one scan for the
    scorer and one for the result; ``order`` must tell the turns of a conversation apart.
    """
    keys = [key] if isinstance(key, str) else list(key)
    at = [order] if isinstance(order, str) else list(order)
    place = [*keys, *at]
    numbers = ordered_columns(turns.select(*place), keys, at, chunk_rows=chunk_rows, number="turn_number")
    numbers = numbers.select(*[F.col(c).alias(f"_of_{c}") for c in place], "turn_number")
    numbered = turns.join(numbers, _all_equal([(c, f"_of_{c}") for c in place])).drop(*[f"_of_{c}" for c in place])
    periodic = (F.col("turn_number") % deep_every == 0) if deep_every > 0 else F.lit(False)
    given = F.nullif(F.col(explicit_col), F.lit("")) if explicit_col else F.lit(None).cast("string")
    rows = numbered.select(*keys, "turn_number", F.col(text_col).alias("_text"), F.coalesce(given, F.when(periodic, "deep")).alias("_fixed"))
    could_be_basic = F.col("_fixed").isNull() | (F.col("_fixed") != "deep")
    rows = score_where(rows, could_be_basic, "_text", scorer, "basic", prefix="_b_")
    rows = score_where(rows, F.col("_fixed").isNull() | (F.col("_fixed") == "deep"), "_text", scorer, "deep", prefix="_d_")
    fields = [c.removeprefix("_b_") for c in rows.columns if c.startswith("_b_")]
    scores = [F.struct(*[F.col(f"{p}{c}").alias(c) for c in fields]).alias(name) for p, name in (("_b_", "basic"), ("_d_", "deep"))]
    turn = F.struct("turn_number", F.col("_fixed").alias("fixed"), *scores)
    group = F.floor(F.col("turn_number") / (deep_every if deep_every > 0 else TURNS)).alias("_group")
    groups = rows.groupBy(*keys, group).agg(F.array_sort(F.collect_list(turn)).alias("_turns"))

    def fold(low):
        def step(state, t):
            mode = F.coalesce(t["fixed"], F.when(state["low"], "deep").otherwise("basic"))
            score = F.when(mode == "deep", t["deep"]["score"]).otherwise(t["basic"]["score"])
            next_low = F.coalesce(score < threshold, F.lit(False))
            return F.struct(next_low.alias("low"), F.array_append(state["modes"], mode).alias("modes"))

        return F.aggregate("_turns", F.struct(F.lit(low).alias("low"), F.array().cast("array<string>").alias("modes")), step)

    if deep_every > 0:  # a group begins with a turn that is deep whatever came before, or with the first turn
        groups = groups.withColumn("_modes", fold(False)["modes"])
    else:
        groups = groups.withColumns({"_ok": fold(False), "_low": fold(True)})
        exits = F.struct("_group", F.col("_ok.low").alias("ok"), F.col("_low.low").alias("low"))
        per_key = groups.groupBy(*keys).agg(F.array_sort(F.collect_list(exits)).alias("_exits"))

        def carry(state, e):
            now = F.element_at(state, -1)["low"]
            after = F.when(now, e["low"]).otherwise(e["ok"])
            return F.array_append(state, F.struct((e["_group"] + 1).alias("group"), after.alias("low")))

        begin = F.array(F.struct(F.lit(0).cast("long").alias("group"), F.lit(False).alias("low")))
        entries = per_key.select(*[F.col(k).alias(f"_of_{k}") for k in keys], F.inline(F.aggregate("_exits", begin, carry)).alias("_at", "_begins_low"))
        same = _all_equal([*((k, f"_of_{k}") for k in keys), ("_group", "_at")])
        groups = groups.join(entries, same).drop(*[f"_of_{k}" for k in keys])
        groups = groups.withColumn("_modes", F.when(F.col("_begins_low"), F.col("_low.modes")).otherwise(F.col("_ok.modes")))

    chosen = F.transform(
        "_turns",
        lambda t, i: F.struct(
            t["turn_number"].alias("turn_number"),
            F.get("_modes", i).alias("mode"),
            F.when(F.get("_modes", i) == "deep", t["deep"]).otherwise(t["basic"]).alias("s"),
        ),
    )
    folded = groups.select(*[F.col(k).alias(f"_of_{k}") for k in keys], F.inline(chosen).alias("_number", "mode", "_s"))
    kept = [c for c in turns.columns if c not in (*fields, "mode", "turn_number")]
    out = numbered.select(*kept, "turn_number").join(folded, _all_equal([*((k, f"_of_{k}") for k in keys), ("turn_number", "_number")]))
    return out.select(*kept, "turn_number", "mode", *[F.col(f"_s.{c}").alias(c) for c in fields])


def pair_turns(df, key, order, *, role_col="role", input_role="user", output_role="assistant", carry, chunk_rows=None):
    """Pair each input turn with the turn after it when that is an output turn.

    ``carry`` lists the columns brought over as ``out_<name>``.  Input turns
    without an output keep null.  Only keys, order and role go through the ordered
    windows; what is carried, texts as a rule, is joined by key and place.
    """
    keys = [key] if isinstance(key, str) else list(key)
    at = [order] if isinstance(order, str) else list(order)
    lead = {"_next_role": role_col, "_next": F.struct(*at)}
    places = ordered_columns(df.select(*keys, *at, role_col), keys, at, chunk_rows=chunk_rows, lead=lead)
    places = places.where((F.col(role_col) == input_role) & (F.col("_next_role") == output_role)).select(
        *[F.col(c).alias(f"_of_{c}") for c in (*keys, *at)], *[F.col(f"_next.{c}").alias(f"_then_{c}") for c in at], F.lit(True).alias("_answered")
    )
    outputs = df.where(F.col(role_col) == output_role).select(
        *[F.col(c).alias(f"_out_{c}") for c in (*keys, *at)], *[F.col(c).alias(f"out_{c}") for c in carry]
    )
    rows = df.where(F.col(role_col) == input_role)
    rows = rows.join(places, _all_equal([(c, f"_of_{c}") for c in (*keys, *at)]), "left")
    rows = rows.join(
        outputs, _all_equal([*((c, f"_out_{c}") for c in keys), *((f"_then_{c}", f"_out_{c}") for c in at)]) & F.col("_answered"), "left"
    )
    return rows.select(*df.columns, *[f"out_{c}" for c in carry], F.coalesce("_answered", F.lit(False)).alias("answered"))


def _all_equal(pairs):
    same = None
    for a, b in pairs:
        part = F.col(a).eqNullSafe(F.col(b))
        same = part if same is None else same & part
    return same


def since_reset(df, resets, key, ts="ts", reset_ts="reset_at", *, chunk_rows=None):
    """Rows of each session after its latest reset; sessions never reset stay whole."""
    last = resets.groupBy(key).agg(F.max(reset_ts).alias("_reset"))
    rows = lookup_join(df, last, [key], [ts], chunk_rows=chunk_rows)
    return rows.where(F.col("_reset").isNull() | (F.col(ts) > F.col("_reset"))).drop("_reset")


def check_inputs(df, is_input, dims=None):
    """Mark input checks as unrecorded basic evaluations, on a dimension subset if given."""
    checks = df.where(is_input).withColumns({"mode": F.lit("basic"), "recorded": F.lit(False)})
    if dims is not None:
        checks = restrict_dimensions(checks, dims)
    rest = df.where(~F.coalesce(is_input, F.lit(False))).withColumn("recorded", F.lit(True))
    return rest.unionByName(checks, allowMissingColumns=True)
