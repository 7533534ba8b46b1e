"""How sure measures and differences of runs are: a Poisson bootstrap in one pass.

Every case has, in every resample, a weight from the Poisson distribution of mean 1 (the
limit of drawing as many cases as there are, with replacement). The weight depends on seed,
case and resample only, so it needs no count of the cases, is the same for both runs of a
comparison, and does not change with the layout of the data. Cases are multiplied by the
number of resamples inside their tasks and summed there; one partial sum per task, group
and resample travels.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.scoring import one_per_case, outcomes, ratios

# A draw is 8 hexadecimal digits; a digest holds four.
DIGITS, PER_DIGEST = 8, 4
# The least draws of weight 1, 2, ...: the distribution function, in steps of 2 ** -32.
LEAST_DRAW = [
    math.floor(sum(math.exp(-1) / math.factorial(i) for i in range(k + 1)) * 16**DIGITS)
    for k in range(12)
]


def weight(digest: Column, place: int) -> Column:
    """The Poisson weight that the draw at ``place`` of a digest stands for."""
    digits = F.substring(digest, place * DIGITS + 1, DIGITS)
    draw = F.conv(digits, 16, 10).cast("bigint")
    return sum(((draw >= least).cast("int") for least in LEAST_DRAW), F.lit(0))


def intervals(
    scored: DataFrame,
    sums: Mapping[str, Column],
    measures: Mapping[str, Column],
    by: Sequence[str] = (),
    case: str = "case_id",
    resamples: int = 200,
    level: float = 0.95,
    seed: int = 1,
) -> DataFrame:
    """Rows (by..., measure, value, low, high): measures with their bootstrap intervals.

    ``scored`` has one row per case. ``sums`` are whole numbers of a case; ``measures`` are
    expressions over their totals. ``low`` and ``high`` are percentiles of the resampled
    values, of which null ones (a measure without a base) do not count.
    """
    names = list(sums)
    chunks = math.ceil(resamples / PER_DIGEST)
    rows = scored.select(
        *[F.col(b).alias(f"by{i}") for i, b in enumerate(by)],
        F.col(case).cast("string").alias("case"),
        *[column.alias(name) for name, column in sums.items()],
    )
    # Chunk -1 is no resample: every case counts once.
    spread = rows.withColumn("chunk", F.explode(F.sequence(F.lit(-1), F.lit(chunks - 1))))
    digests = spread.withColumn("digest", F.md5(F.concat_ws(":", F.lit(str(seed)), "case", "chunk")))
    drawn = F.array(
        *[
            F.struct((F.col("chunk") * PER_DIGEST + p).alias("resample"), weight(F.col("digest"), p).alias("weight"))
            for p in range(PER_DIGEST)
        ]
    )
    whole = F.array(F.struct(F.lit(-1).alias("resample"), F.lit(1).alias("weight")))
    groups = [f"by{i}" for i in range(len(by))]
    weighted = digests.select(
        *groups, *names, F.explode(F.when(F.col("chunk") < 0, whole).otherwise(drawn)).alias("draw")
    ).where(F.col("draw.weight").between(1, len(LEAST_DRAW)) & (F.col("draw.resample") < resamples))
    totals = weighted.groupBy(*groups, F.col("draw.resample").alias("resample")).agg(
        *[F.sum(F.col("draw.weight") * F.col(name)).alias(name) for name in names]
    )
    told = F.array(
        *[F.struct(F.lit(m).alias("measure"), column.alias("value")) for m, column in measures.items()]
    )
    values = totals.select(*groups, "resample", F.explode(told).alias("told")).select(
        *groups, "resample", "told.*"
    )
    tried = F.when(F.col("resample") >= 0, F.col("value"))
    tail = (1 - level) / 2
    return (
        values.groupBy(*groups, "measure")
        .agg(
            F.max(F.when(F.col("resample") < 0, F.col("value"))).alias("value"),
            F.percentile(tried, F.lit(tail)).alias("low"),
            F.percentile(tried, F.lit(1 - tail)).alias("high"),
        )
        .select(
            *[F.col(g).alias(b) for g, b in zip(groups, by, strict=True)],
            "measure",
            *[F.round(c, 6).alias(c) for c in ("value", "low", "high")],
        )
    )


def evaluate_intervals(
    predictions: DataFrame,
    expected: DataFrame,
    predicted: str,
    actual: str,
    by: Sequence[str] = (),
    case: str = "case_id",
    **drawing,
) -> DataFrame:
    """The measures of ``evaluate``, each with its interval; one row per group and measure."""
    joined = one_per_case(expected, case).join(one_per_case(predictions, case), case, "left")
    return intervals(joined, outcomes(predicted, actual), ratios(), by, case, **drawing)


def difference_intervals(
    run_a: DataFrame,
    run_b: DataFrame,
    expected: DataFrame,
    predicted: str,
    actual: str,
    by: Sequence[str] = (),
    case: str = "case_id",
    **drawing,
) -> DataFrame:
    """By how much each measure of run b exceeds that of run a, with its interval.

    Both runs are weighted alike in a resample, so what they have in common cancels out.
    ``is_real`` says that the interval does not hold zero. ``by`` names columns of
    ``expected``.
    """
    joined = one_per_case(expected, case)
    for run, name in ((run_a, "_a"), (run_b, "_b")):
        said = one_per_case(run.select(case, F.col(predicted).alias(name)), case)
        joined = joined.join(said, case, "left")
    sums = {f"{k}{run}": c for run in ("_a", "_b") for k, c in outcomes(run, actual).items()}
    more = {m: ratios("_b")[m] - a for m, a in ratios("_a").items()}
    found = intervals(joined, sums, more, by, case, **drawing)
    return found.withColumn("is_real", (F.col("low") > 0) | (F.col("high") < 0))
