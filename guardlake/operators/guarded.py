"""Guards that score as they go: inputs first, outputs of admitted inputs only."""

from pyspark.sql import functions as F

from guardlake.functions import failed_dimensions, is_blank
from guardlake.operators.aggregates import aggregate_scores
from guardlake.operators.policy import guard_llm_log, guard_turns
from guardlake.operators.scoring import rule_scorer, score, score_distinct, score_where
from guardlake.operators.validation import content_rules, validate
from guardlake.schemas import DIM_COLUMNS
from guardlake.sources.decode import extract_llm_response
from guardlake.sources.sinks import score_fanout

SCORES = (*DIM_COLUMNS, "score", "confidence")


def evaluate_contents(df, text_col="text", *, scorer=rule_scorer, mode="basic", shared=False):
    """Valid contents scored, and the rejected rows.  ``shared`` scores equal texts once, for costly scorers."""
    valid, rejected = validate(df, content_rules(text_col))
    scored = (score_distinct if shared else score)(valid, text_col, scorer, mode)
    return scored, rejected


def evaluate_and_aggregate(df, *keys, text_col="text", scorer=rule_scorer, shared=False):
    """Validate, score and aggregate contents by ``keys``."""
    scored, _ = evaluate_contents(df, text_col, scorer=scorer, shared=shared)
    return aggregate_scores(scored, *keys)


def guard_conversations(
    pairs,
    input_thresholds=None,
    output_thresholds=None,
    *,
    scorer=rule_scorer,
    policy=None,
    custom=None,
    regenerated=None,
    upgrade_below=None,
):
    """Run the turn guard with a scorer over paired turns ``text`` / ``out_text``.

    An input that fails is blocked before its output is scored, and without
    thresholds a side is not scored at all.  ``upgrade_below`` re-scores outputs of
    low confidence at full depth.  Blank texts are not scored and count as passing.
    """
    rows = _scored_side(pairs, "text", "", scorer, input_thresholds, F.lit(True), None)
    bad = F.size(failed_dimensions(input_thresholds)) > 0 if input_thresholds else F.lit(False)
    rows = _scored_side(rows, "out_text", "out_", scorer, output_thresholds, ~bad, upgrade_below)
    return guard_turns(
        rows, input_thresholds, output_thresholds, policy=policy, custom=custom, regenerated=regenerated
    )


def _scored_side(rows, text_col, prefix, scorer, thresholds, going, upgrade_below):
    """Scores of one side where its turn comes and it has a text; all rows go through once."""
    if not thresholds:
        return rows.withColumns({f"{prefix}{c}": F.lit(None).cast("double") for c in SCORES})
    rows = score_where(rows, going & ~is_blank(text_col), text_col, scorer, prefix=prefix)
    if upgrade_below is None:
        return rows
    low = F.col(f"{prefix}confidence") < upgrade_below
    return score_where(rows, low, text_col, scorer, "deep", prefix=prefix)


def guard_answers(df, json_col, vendor, thresholds=None, *, scorer=rule_scorer, skip_col=None, mode="basic"):
    """Read logged model answers, score those not skipped or empty, and gate them."""
    rows = extract_llm_response(df, json_col, vendor)
    skip = F.col("content") == ""
    if skip_col:
        skip = skip | F.coalesce(F.col(skip_col), F.lit(False))
    rows = rows.withColumn("_skip", skip)
    everything = score_where(rows, ~F.col("_skip"), "content", scorer, mode)
    return guard_llm_log(everything, thresholds, skip_col="_skip").drop("_skip")


def trace_contents(df, trace_col, text_col="text", *, scorer=rule_scorer, mode="basic", **options):
    """Score contents and return their score rows (see score_fanout)."""
    return score_fanout(score(df, text_col, scorer, mode), trace_col, **options)
