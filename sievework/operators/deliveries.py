"""Rows that were delivered again: the latest of each key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.session import broadcast_if_small, cut


def latest(df: DataFrame, key: str, order: Column) -> DataFrame:
    """One row per ``key``, the latest by ``order``; of equally late ones the largest values.

    Keys that come again are found from key and order alone; only their rows are shuffled
    whole. Null orders come first, rows with a null key are left out.
    """
    keyed = df.filter(F.col(f"`{key}`").isNotNull())
    again = cut(keyed.groupBy(F.col(f"`{key}`")).agg(F.count("*").alias("_n")).filter("_n > 1").drop("_n"))
    few = broadcast_if_small(again)
    rest = [c for c in df.columns if c != key]
    late = keyed.withColumn("_order", order).join(few, key, "left_semi").groupBy(F.col(f"`{key}`")).agg(F.max(F.struct("_order", *[F.col(f"`{c}`") for c in rest])).alias("_r"))
    return keyed.join(few, key, "left_anti").unionByName(late.select(F.col(f"`{key}`"), *[F.col("_r").getField(c).alias(c) for c in rest]))


def without_older(df: DataFrame, key: str, order: Column) -> DataFrame:
    """The rows of every ``key`` that are latest by ``order``, read in one pass; equally late ones all stay.

    Null orders come first, rows with a null key are left out.
    """
    keyed = df.filter(F.col(f"`{key}`").isNotNull()).withColumn("_order", order)
    again = keyed.groupBy(F.col(f"`{key}`")).agg(F.count("*").alias("_n"), F.max("_order").alias("_last")).filter("_n > 1")
    joined = keyed.join(broadcast_if_small(cut(again)), key, "left")
    return joined.filter(F.col("_n").isNull() | F.col("_order").eqNullSafe(F.col("_last"))).select(*[F.col(f"`{c}`") for c in df.columns])
