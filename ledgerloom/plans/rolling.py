"""Gold kept up to date from new and corrected orders, without reading the others."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.plans.medallion import to_silver
from ledgerloom.session import Namespace
from ledgerloom.sinks import BATCH, write_batch

STREAM_NAME = "gold"


def average(amount: Column, n: Column) -> Column:
    """The mean as ``avg`` gives it for money: to six places, before any other rounding."""
    return (amount / F.nullif(n, F.lit(0)).cast("decimal(20,0)")).cast("decimal(22,6)")


class RollingGold:
    """Monthly sales as sums that batches of orders add to.

    Two tables: ``<name>_changes`` holds, for every order of every batch, what Silver makes
    of it (or that it leaves Silver); ``<name>_partials`` holds what each batch adds to the
    sums and counts of each month and segment. A corrected order takes back what its last
    version had given. Money is added as decimals, so that the sums, and what is rounded
    from them, equal those of a rebuild.

    Rows are stored under the number of their batch: a batch that is applied again, with
    the same rows, replaces itself. Of the earlier changes only orders that the batch names
    are looked up, by id; the refined table is neither read nor written. Changes of customers
    and nations are not followed; they need a rebuild. One writer at a time.
    """

    def __init__(self, spark: SparkSession, namespace: Namespace, name: str = "sales_monthly"):
        self.spark = spark
        self.changes = namespace.table(f"{name}_changes")
        self.partials = namespace.table(f"{name}_partials")

    def batches(self) -> set[int]:
        """Numbers of the batches whose changes are stored: one partition each."""
        if not self.spark.catalog.tableExists(self.changes):
            return set()
        shown = self.spark.sql(f"SHOW PARTITIONS {self.changes}").collect()
        return {int(row[0].rsplit("=", 1)[1]) for row in shown}

    def apply(
        self,
        number: int,
        orders: DataFrame,
        customer: DataFrame,
        nation: DataFrame,
        newest: str | None = None,
    ) -> None:
        """Take in batch ``number``, higher than all before, or one of them once more.

        An order that stands several times in the batch counts with its row of the greatest
        ``newest``, or else with its greatest row. Orders without an id cannot be recognised
        later: each is an order of its own.
        """
        known = self.batches()
        if number not in known and number < max(known, default=number):
            raise ValueError(f"batch {number} comes after batch {max(known)}")
        write_batch(changes_of(orders, customer, nation, newest), self.changes, STREAM_NAME, number)
        write_batch(self.added_by(number), self.partials, STREAM_NAME, number)

    def added_by(self, number: int) -> DataFrame:
        """What the stored changes of a batch add to the sums, and take from them."""
        stored = self.spark.table(self.changes)
        now = stored.where(F.col(BATCH) == number)
        ids = now.where("order_id IS NOT NULL").select("order_id").distinct()
        before = stored.where(F.col(BATCH) < number).join(ids, "order_id", "left_semi")
        latest = Window.partitionBy("order_id").orderBy(F.col(BATCH).desc())
        replaced = before.withColumn("_age", F.rank().over(latest)).where("_age = 1").drop("_age")
        signed = now.withColumn("sign", F.lit(1)).unionByName(replaced.withColumn("sign", F.lit(-1)))
        amount = F.col("order_amount")
        return (
            signed.where("in_silver")
            .groupBy("order_month", "market_segment")
            .agg(
                F.sum("sign").alias("n_orders"),
                F.sum(F.when(amount.isNotNull(), F.col("sign"))).alias("n_amounts"),
                F.sum(F.when(F.col("sign") < 0, -amount).otherwise(amount)).alias("amount"),
            )
        )

    def gold(self) -> DataFrame:
        """The same rows and types as ``to_gold`` of all orders as they are now."""
        sums = self.spark.table(self.partials).groupBy("order_month", "market_segment").agg(
            F.sum("n_orders").alias("n_orders"),
            F.coalesce(F.sum("n_amounts"), F.lit(0)).alias("n_amounts"),
            F.sum("amount").cast("decimal(28,2)").alias("amount"),
        )
        amount = F.when(F.col("n_amounts") > 0, F.col("amount"))
        return sums.where("n_orders > 0").select(
            "order_month",
            "market_segment",
            "n_orders",
            F.round(amount, 0).alias("total_sales"),
            F.round(average(amount, F.col("n_amounts")), 0).alias("avg_order_value"),
        )


def changes_of(
    orders: DataFrame, customer: DataFrame, nation: DataFrame, newest: str | None = None
) -> DataFrame:
    """One row per order of a batch: its share in Silver, or that it has none."""
    needed = ["o_custkey", "o_orderdate", "o_orderpriority", "o_totalprice"]
    first = [newest] if newest else []
    row = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(first + needed)])
    picked = orders.where("o_orderkey IS NOT NULL").groupBy("o_orderkey").agg(F.max(row).alias("row"))
    once = picked.select(
        "o_orderkey", *[F.col(f"row.c{i + len(first)}").alias(c) for i, c in enumerate(needed)]
    )
    nameless = orders.where("o_orderkey IS NULL").select("o_orderkey", *needed)

    def share(rows: DataFrame) -> DataFrame:
        return to_silver(rows, customer, nation).select(
            "order_id",
            F.lit(True).alias("in_silver"),
            F.date_trunc("month", "order_date").alias("order_month"),
            "market_segment",
            "order_amount",
        )

    named = once.select(F.col("o_orderkey").alias("order_id")).join(share(once), "order_id", "left")
    return named.withColumn("in_silver", F.coalesce("in_silver", F.lit(False))).unionByName(share(nameless))
