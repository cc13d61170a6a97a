"""Content scoring: a pluggable scorer and a transparent rule-based one.

A scorer is ``scorer(df, text_col, mode) -> df`` that adds ``score``,
``confidence`` and ``d_*`` columns.  The built-in one is column expressions only;
its rules are this project's, not a model.
"""

from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from guardlake.functions import restrict_dimensions, weighted_score
from guardlake.operators.lookups import lookup_join, telling_columns
from guardlake.schemas import DIM_COLUMNS, LOW_CONFIDENCE

# Signal patterns, valid in Java and RE2 alike.
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
IPV4 = r"\b(?:[0-9]{1,3}\.){3}[0-9]{1,3}\b"
CARD = r"\b[0-9]{16}\b"
TOKEN = r'token = "[0-9a-f]{40}"'


# Text any match must contain; testing it first spares most rows the regex.
NEEDLES = {EMAIL: "@", TOKEN: "token = "}


def has_match(c, pattern):
    c = F.col(c) if isinstance(c, str) else c
    found = c.rlike(pattern)
    return F.contains(c, F.lit(NEEDLES[pattern])) & found if pattern in NEEDLES else found


def count_matches(c, pattern):
    """Number of matches; 0 without running the regex where the needle is missing."""
    c = F.col(c) if isinstance(c, str) else c
    count = F.regexp_count(c, F.lit(pattern))
    if pattern not in NEEDLES:
        return count
    return F.when(c.isNull() | F.contains(c, F.lit(NEEDLES[pattern])), count).otherwise(0)


SIGNALS = ("n_email", "n_ip", "n_card", "n_token", "n_text")


def with_signals(df, text_col="text"):
    """Add ``n_email, n_ip, n_card, n_token`` over the whole text and its length ``n_text``.

    A map over the texts.  Joins with labels and the like belong after it, on the
    signals, so that texts are not shuffled.
    """
    return df.withColumns(
        {
            "n_email": count_matches(text_col, EMAIL),
            "n_ip": count_matches(text_col, IPV4),
            "n_card": count_matches(text_col, CARD),
            "n_token": count_matches(text_col, TOKEN),
            "n_text": F.length(text_col),
        }
    )


def rule_scorer(df, text_col="text", mode="basic"):
    """Score by personal-data and secret counts, and by labels where the table has them.

    Uses signals the table already has.  Deep mode adds one dimension,
    ``user_impact`` by text length, and 0.3 confidence.
    """
    out = df if all(c in df.columns for c in SIGNALS) else with_signals(df, text_col)
    toxic = F.col("toxic") if "toxic" in df.columns else F.lit(None).cast("int")
    quality = F.col("quality") if "quality" in df.columns else F.lit(None).cast("int")
    penalty = 25 * F.col("n_email") + 15 * F.col("n_ip") + 40 * F.col("n_card") + 40 * F.col("n_token")
    tenths = {
        "d_privacy": F.greatest(F.lit(0), 100 - penalty),
        "d_safety": F.when(toxic == 1, 20).when(toxic == 0, 90).otherwise(70),
        "d_reliability": F.when(quality == 1, 90).when(quality == 0, 40).otherwise(60),
    }
    if mode == "deep":
        tenths["d_user_impact"] = F.when(F.col("n_text").between(50, 10000), 90).otherwise(50)
    total = sum(tenths.values(), F.lit(0))
    labelled = toxic.isNotNull() | quality.isNotNull()
    confidence = F.when(labelled, 9).otherwise(5)
    if mode == "deep":
        confidence = F.least(F.lit(10), confidence + 3)
    null = F.lit(None).cast("double")
    return out.withColumns(
        {
            **{c: (tenths[c] / F.lit(10.0)) if c in tenths else null for c in DIM_COLUMNS},
            "score": total / F.lit(10.0 * len(tenths)),
            "confidence": confidence / F.lit(10.0),
        }
    )


FIELDS = ["score", "confidence", *DIM_COLUMNS]
SCORED = ", ".join(f"{f} double" for f in FIELDS)
#: Models by scorer, in a Python worker.
_MODELS = {}


def _scored(found, texts):
    """Fields in order, for all texts; ``found`` has those of the texts that are not null."""
    return found.reindex(columns=FIELDS).astype("float64").set_axis(texts.index[texts.notna()]).reindex(texts.index)


def _with_scored(df, scored):
    out = df.withColumn("_scored", scored)
    return out.withColumns({f: F.col(f"_scored.{f}") for f in FIELDS}).drop("_scored")


def pandas_scorer(fn):
    """Scorer from ``fn(texts, mode) -> DataFrame`` over batches of texts, for outside models.

    ``fn`` gets a pandas Series without nulls and returns a pandas DataFrame with
    ``score``, ``confidence`` and any ``d_*`` columns; absent dimensions stay unscored,
    and so do null texts.
    """

    def scorer(df, text_col, mode):
        @F.pandas_udf(SCORED)
        def run(texts: pd.Series) -> pd.DataFrame:
            return _scored(fn(texts[texts.notna()], mode), texts)

        return _with_scored(df, run(F.col(text_col)))

    return scorer


def built(key, setup):
    """The model of that key in this Python worker; set up when it is first asked for."""
    if key not in _MODELS:
        _MODELS[key] = setup()
    return _MODELS[key]


def text_runs(texts, batch_bytes):
    """Cut texts into runs of at most ``batch_bytes`` of UTF-8; a longer text is a run by itself."""
    sizes = np.array([len(t.encode("utf-8", "surrogatepass")) for t in texts], np.int64)
    upto, first = np.concatenate([[0], np.cumsum(sizes)]), 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(upto, upto[first] + batch_bytes, "right")) - 1)
        yield texts.iloc[first:last]
        first = last


def model_scorer(setup, fn, *, batch_bytes=1 << 20):
    """Scorer by a model that is costly to set up, from ``fn(model, texts, mode) -> DataFrame``.

    ``setup()`` runs once in each Python worker, however many tasks, batches and
    sides of a guard the worker sees.  ``fn`` gets runs of texts without nulls, of at
    most ``batch_bytes`` each, and returns what :func:`pandas_scorer` asks for.  Null
    texts are left unscored; a longer text is a run by itself; partitions without
    texts set up nothing.
    """
    key = uuid4().hex

    def scorer(df, text_col, mode):
        @F.pandas_udf(SCORED)
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            for texts in batches:
                there = texts[texts.notna()]
                parts = [fn(built(key, setup), some, mode).reindex(columns=FIELDS) for some in text_runs(there, batch_bytes)]
                found = pd.concat(parts, ignore_index=True) if parts else pd.DataFrame(columns=FIELDS)
                yield _scored(found, texts)

        return _with_scored(df, run(F.col(text_col)))

    return scorer


def score_where(df, condition, text_col="text", scorer=rule_scorer, mode="basic", *, prefix=""):
    """Score the rows that meet a condition, in one pass over all of them.

    Adds ``<prefix>score``, ``<prefix>confidence`` and ``<prefix>d_*``; columns of these
    names keep their values in other rows, otherwise those are null there.  Rows are
    neither split off nor joined: the scorer sees their texts as null, which a
    Python scorer passes over.
    """
    names = {c: f"{prefix}{c}" for c in FIELDS}
    own = {c: f"_own_{c}" for c in df.columns if c in FIELDS or c in names.values()}
    work = df.withColumn("_wanted", F.coalesce(condition, F.lit(False))).withColumnsRenamed(own)
    if text_col in df.columns:
        work = work.withColumn("_wanted_text", F.when(F.col("_wanted"), F.col(own.get(text_col, text_col))))
        text_col = "_wanted_text"
    scored = scorer(work, text_col, mode)
    source = {n: c for c, n in names.items() if c in scored.columns}

    def column(c):
        if c not in source:  # no score, or one that this scorer does not give
            return F.col(own.get(c, c)).alias(c)
        new = F.when(F.col("_wanted"), F.col(source[c]))
        return (new.otherwise(F.col(own[c])) if c in df.columns else new).alias(c)

    return scored.select(*[column(c) for c in [*df.columns, *(n for n in source if n not in df.columns)]])


def score(df, text_col="text", scorer=rule_scorer, mode="basic", *, dimensions=None, weights=None):
    """Run a scorer and note the depth it ran at.

    ``dimensions`` keeps only some dimensions.  ``weights`` (adding up to 100)
    replace the overall score by the weighted one.
    """
    out = scorer(df, text_col, mode).withColumn("mode", F.lit(mode))
    if dimensions is not None:
        out = restrict_dimensions(out, dimensions)
    if weights is not None:
        if abs(sum(weights.values()) - 100) > 1.0:
            raise ValueError(f"Weights must sum to 100. Current sum: {sum(weights.values())}")
        out = out.withColumn("score", weighted_score(weights) / F.lit(100.0))
    return out


def score_distinct(df, text_col="text", scorer=rule_scorer, mode="basic", *, id_cols=None, chunk_rows=None):
    """Score each distinct text once and attach the result to all its copies.

    Worth it when the scorer is costly.  Copies are reduced before the shuffle,
    and only the hash of a text, not the text, is joined back.  Copies of a hot
    text are told apart by ``id_cols`` (by default all other plain columns) and salted.
    """
    ids = list(id_cols) if id_cols else telling_columns(df, [text_col])
    keyed = df.withColumn("_content_key", F.sha2(F.col(text_col), 256))
    distinct = keyed.groupBy("_content_key").agg(F.any_value(text_col).alias(text_col))
    scored = score(distinct, text_col, scorer, mode).drop(text_col)
    out = lookup_join(keyed, scored, ["_content_key"], ids, chunk_rows=chunk_rows)
    return out.drop("_content_key")


def upgrade_low_confidence(df, text_col="text", scorer=rule_scorer, below=LOW_CONFIDENCE):
    """Re-score at full depth the rows whose confidence is strictly below ``below``.

    ``df`` is a scored table; its other rows pass through untouched.
    """
    base = df.withColumn("upgraded", F.coalesce(F.col("confidence") < below, F.lit(False)))
    out = score_where(base, F.col("upgraded"), text_col, scorer, "deep")
    mode = F.when(F.col("upgraded"), "deep").otherwise(F.col("mode") if "mode" in df.columns else None)
    return out.withColumn("mode", mode).select(*df.columns, *([] if "mode" in df.columns else ["mode"]), "upgraded")
