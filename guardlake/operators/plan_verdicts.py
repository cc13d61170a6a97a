"""Plans of agent steps: size rule and verdict."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from guardlake.functions import risk_band
from guardlake.operators.validation import annotate, plan_rules
from guardlake.schemas import MAX_PLAN_STEPS


def leading_steps(steps, plan_col, count):
    """The first ``count`` steps of each plan.

    Spark applies the rank limit before the shuffle too, so even a plan that
    holds a large share of all rows sends at most ``count`` of them per task.
    """
    w = Window.partitionBy(plan_col).orderBy("step_index")
    return steps.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= count).drop("_rank")


def plan_verdict(steps, *, plan_col="plan_id", max_steps=MAX_PLAN_STEPS):
    """One row per plan from scored steps ``(plan, step_index, score, decision, credits)``.

    A plan over ``max_steps`` is rejected: it carries an error and no verdict.
    Sizes come from a partial aggregate; blocked steps are listed up to
    ``max_steps`` per plan, which is all of them for any valid plan.
    """
    blocked = F.col("decision") == "BLOCK"
    score = F.coalesce(F.col("score"), F.lit(0.0))
    per_plan = steps.groupBy(plan_col).agg(
        F.count(F.lit(1)).alias("steps"),
        F.count_if(blocked).alias("blocked_steps"),
        F.avg(score).alias("average_score"),
        F.sum(F.coalesce(F.col("credits"), F.lit(0.0))).alias("credits"),
    )
    valid = annotate(per_plan, plan_rules("steps", max_steps))
    listed = (
        leading_steps(steps.where(blocked).select(plan_col, "step_index"), plan_col, max_steps)
        .groupBy(plan_col)
        .agg(F.array_sort(F.collect_list("step_index")).alias("blocked_indices"))
    )
    ok = F.col("error_code").isNull()
    none = F.array().cast("array<int>")
    out = valid.join(listed, plan_col, "left").withColumn(
        "blocked_indices", F.when(ok, F.coalesce("blocked_indices", none)).otherwise(none)
    )
    all_blocked = F.col("blocked_steps") == F.col("steps")
    any_blocked = F.col("blocked_steps") > 0
    n, k = F.col("steps").cast("string"), F.col("blocked_steps")
    # The wording of the summary and the names of the decisions.
    summary = (
        F.when(all_blocked, F.concat(F.lit("All "), n, F.lit(" steps are blocked.")))
        .when(
            any_blocked,
            F.concat(
                (F.col("steps") - k).cast("string"),
                F.lit(" of "),
                n,
                F.lit(" steps can proceed. Blocked steps: ["),
                F.array_join(F.col("blocked_indices").cast("array<string>"), ", "),
                F.lit("]."),
            ),
        )
        .otherwise(F.concat(F.lit("All "), n, F.lit(" steps can proceed.")))
    )
    decision = F.when(all_blocked, "BLOCK_ALL").when(any_blocked, "PARTIAL_BLOCK").otherwise("ALLOW_ALL")
    # Rounding hides the order in which a distributed mean adds up.
    risk = risk_band(F.round("average_score", 9))
    return out.withColumns(
        {
            "overall_decision": F.when(ok, decision),
            "overall_risk": F.when(ok, risk),
            "plan_summary": F.when(ok, summary),
        }
    )


def evaluate_plans(steps, scorer, *, plan_col="plan_id", max_steps=MAX_PLAN_STEPS):
    """Score the steps of all plans in one job, then give each plan its verdict.

    ``scorer`` takes the step table and returns it with ``score``, ``decision``
    and ``credits``.  Plans over the limit are not scored.
    """
    # One step past the limit is enough to tell that a plan is too long.
    some = leading_steps(steps, plan_col, max_steps + 1)
    held = F.count(F.lit(1)).over(Window.partitionBy(plan_col))
    small = some.withColumn("_held", held).where(F.col("_held") <= max_steps).drop("_held")
    sizes = annotate(steps.groupBy(plan_col).agg(F.count(F.lit(1)).alias("steps")), plan_rules("steps", max_steps))
    verdicts = plan_verdict(scorer(small), plan_col=plan_col, max_steps=max_steps)
    rejected = sizes.where(F.col("error_code").isNotNull())
    return verdicts.unionByName(rejected, allowMissingColumns=True)


def blocked_plans(verdicts):
    """Plans that may not start as a whole, with their blocked steps and summary."""
    return verdicts.where(F.col("overall_decision").isin("PARTIAL_BLOCK", "BLOCK_ALL")).select(
        verdicts.columns[0], "overall_decision", "blocked_indices", "plan_summary"
    )
