"""Named questions over Silver and Gold."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def monthly_sales(gold: DataFrame, segment: str | None = None) -> DataFrame:
    """Orders and sales by month, over all segments or one."""
    chosen = gold if segment is None else gold.where(F.col("market_segment") == segment)
    return chosen.groupBy("order_month").agg(
        F.sum("n_orders").alias("n_orders"), F.sum("total_sales").alias("total_sales")
    )


def segment_share(gold: DataFrame, month: date | None = None) -> DataFrame:
    """Each segment's share of its month's sales in percent, for all months or one."""
    chosen = gold if month is None else gold.where(F.col("order_month") == F.lit(month))
    in_month = F.sum("total_sales").over(W.partitionBy("order_month"))
    share = F.col("total_sales").cast("double") / F.nullif(in_month.cast("double"), F.lit(0.0))
    return chosen.select(
        "order_month",
        "market_segment",
        "total_sales",
        F.round(share * 100, 2).alias("share_pct"),
    )


def top_nations(silver: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` nations with the highest sales, ties by name."""
    return (
        silver.groupBy("nation")
        .agg(F.count("*").alias("n_orders"), F.sum("order_amount").alias("total_sales"))
        .orderBy(F.col("total_sales").desc_nulls_last(), "nation")
        .limit(k)
    )


def month_over_month(gold: DataFrame) -> DataFrame:
    """Sales of each segment beside those of the calendar month before.

    After a month without sales there is nothing to compare with, and the previous
    sales are null. Gold has one row per month and segment, so the window sees few
    rows however many orders there are.
    """
    order = W.partitionBy("market_segment").orderBy("order_month")
    adjacent = F.lag("order_month").over(order) == F.col("order_month") - F.expr("INTERVAL 1 MONTH")
    before = F.when(adjacent, F.lag("total_sales").over(order))
    change = F.col("total_sales") - F.col("previous_sales")
    previous = F.nullif(F.col("previous_sales").cast("double"), F.lit(0.0))
    return gold.select(
        "market_segment", "order_month", "total_sales", before.alias("previous_sales")
    ).select(
        "*",
        change.alias("change"),
        F.round(change.cast("double") / previous * 100, 2).alias("change_pct"),
    )
