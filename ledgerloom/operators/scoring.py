"""Scoring answers against expectations, and one scoring against another."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def one_per_case(rows: DataFrame, case: str) -> DataFrame:
    """One row per case, the smallest; partial sums only travel, whatever a case's share."""
    others = [c for c in rows.columns if c != case]
    if not others:
        return rows.distinct()
    return rows.groupBy(case).agg(F.min(F.struct(*others)).alias("row")).select(case, "row.*")


def score_cases(
    predictions: DataFrame,
    expected: DataFrame,
    scorers: Mapping[str, Column],
    case: str = "case_id",
) -> DataFrame:
    """Expected cases joined with their predictions, one column per scorer.

    Scorers are expressions over both sides' columns. A case expected or predicted
    several times counts once, with its smallest row. A case without a prediction is
    kept, with nulls on that side; a prediction without an expectation cannot be scored
    and is left out.
    """
    joined = one_per_case(expected, case).join(one_per_case(predictions, case), case, "left")
    return joined.select("*", *[scorer.alias(name) for name, scorer in scorers.items()])


def outcomes(predicted: str, actual: str) -> dict[str, Column]:
    """What a case adds to the counts of 0/1 predictions; a missing prediction is a 0."""
    said = F.coalesce(F.col(predicted), F.lit(0)) == 1
    truth = F.col(actual) == 1
    told = {"tp": said & truth, "fp": said & ~truth, "fn": ~said & truth, "hit": said == truth}
    counted = {name: F.coalesce(c.cast("bigint"), F.lit(0)) for name, c in told.items()}
    return {"n_cases": F.lit(1).cast("bigint")} | counted


def ratios(suffix: str = "") -> dict[str, Column]:
    """The measures, from counts whose names end in ``suffix``; null without a base."""
    n, tp, fp, fn, hit = (F.col(c + suffix) for c in ("n_cases", "tp", "fp", "fn", "hit"))

    def ratio(part: Column, base: Column) -> Column:
        return part / F.nullif(base.cast("double"), F.lit(0.0))

    return {
        "precision": ratio(tp, tp + fp),
        "recall": ratio(tp, tp + fn),
        "f1": ratio(2 * tp, 2 * tp + fp + fn),
        "hit_rate": ratio(hit, n),
    }


def evaluate(
    predictions: DataFrame,
    expected: DataFrame,
    predicted: str,
    actual: str,
    by: Sequence[str] = (),
    case: str = "case_id",
) -> DataFrame:
    """Precision, recall, F1 and hit rate of 0/1 predictions, overall or by group.

    A missing prediction counts as 0. Measures without a base are null. All
    counts are summed partially before the one shuffle of a few rows.
    """
    scored = score_cases(predictions, expected, outcomes(predicted, actual), case)
    counts = scored.groupBy(*by).agg(
        F.count("*").alias("n_cases"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tp", "fp", "fn", "hit")],
    )
    measured = [F.round(c, 6).alias(name) for name, c in ratios().items()]
    return counts.select(*by, "n_cases", "tp", "fp", "fn", *measured)


def evaluate_delta(
    run_a: DataFrame, run_b: DataFrame, case: str = "case_id", score: str = "score"
) -> DataFrame:
    """Two runs' scores case by case: improved, regressed, same, added, removed.

    A case scored several times in a run counts with its mean. That reduces each
    run to one row per case before the join, whatever a case's share of the rows.
    """

    def means(run: DataFrame, name: str) -> DataFrame:
        return run.groupBy(case).agg(F.round(F.avg(score), 6).alias(name))

    a, b = F.col("score_a"), F.col("score_b")
    return (
        means(run_a, "score_a")
        .join(means(run_b, "score_b"), case, "full")
        .select(
            case,
            "score_a",
            "score_b",
            F.when(a.isNull() & b.isNull(), "same")
            .when(a.isNull(), "added")
            .when(b.isNull(), "removed")
            .when(b > a, "improved")
            .when(b < a, "regressed")
            .otherwise("same")
            .alias("change"),
        )
    )


def delta_summary(delta: DataFrame) -> DataFrame:
    """How many cases changed which way."""
    return delta.groupBy("change").agg(F.count("*").alias("n_cases"))
