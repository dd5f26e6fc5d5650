"""Global row numbers and running totals without a window over the whole table.

Rows are range-partitioned and sorted; what a range starts from comes from the sizes of the
ranges before it, a table with one row a range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievework.session import cut


def _ranged(df: DataFrame, order: list[Column]) -> DataFrame:
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut(df.repartitionByRange(parts, *order).withColumn("_range", F.spark_partition_id()))


def with_ordinal(df: DataFrame, order: list[Column], name: str = "ord") -> DataFrame:
    """Add a row number from 0 by ``order``, which should be unique."""
    return with_running_total(df, order, F.lit(1), name).withColumn(name, F.col(name) - 1)


def with_running_total(df: DataFrame, order: list[Column], value: Column, name: str) -> DataFrame:
    """Add the sum of ``value`` over all rows up to this one by ``order``; null values count 0."""
    ranged = _ranged(df.withColumn("_value", F.coalesce(value, F.lit(0)).cast("bigint")), order)
    sizes = ranged.groupBy("_range").agg(F.sum("_value").alias("_size"))
    base = sizes.select("_range", (F.sum("_size").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_size")).alias("_base"))
    inside = F.sum("_value").over(Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return ranged.withColumn("_run", inside).join(F.broadcast(base), "_range").withColumn(name, F.col("_run") + F.col("_base")).drop("_range", "_value", "_run", "_base")
