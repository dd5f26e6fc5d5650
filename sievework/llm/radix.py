"""Radix selection: the rows with the smallest keys of every group, without sorting a group.

A key is a pair of BIGINT columns whose signed order is the wanted order. Read as
16 big-endian bytes (sign bits flipped) it sorts by unsigned bytes. A round counts,
per group, the rows by the value of one byte, finds the value in which the last
wanted row lies, fixes it and goes on inside; digits that all rows left have in common
are skipped. A task sees counts of at most 256 values a group, never the group's rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievework.session import cut, skew_join

_MIN = -(1 << 63)


def _byte(hi: Column, lo: Column, at: Column) -> Column:
    """Byte ``at`` (0 to 15) of the key."""
    word = F.when(at < 8, hi).otherwise(lo)
    shift = (F.lit(56) - F.pmod(at, F.lit(8)) * 8).cast("int")
    value = F.call_function("shiftrightunsigned", word, shift).bitwiseAND(F.lit(255)).cast("int")
    return F.when(at.isin(0, 8), value.bitwiseXOR(F.lit(128))).otherwise(value)


def _mask(bytes_fixed: Column) -> Column:
    """A BIGINT whose first 0 to 8 bytes are ones."""
    part = F.call_function("shiftleft", F.lit(-1).cast("bigint"), (F.lit(64) - bytes_fixed * 8).cast("int"))
    return F.when(bytes_fixed <= 0, F.lit(0).cast("bigint")).when(bytes_fixed >= 8, F.lit(-1).cast("bigint")).otherwise(part)


def _common(a: Column, b: Column) -> Column:
    """Number of leading bytes that two words share."""
    same = F.lit(0)
    for n in range(1, 9):
        same = F.when(a.bitwiseXOR(b).bitwiseAND(_mask(F.lit(n))) == 0, F.lit(n)).otherwise(same)
    return same


def _advance(df: DataFrame) -> DataFrame:
    """From the bounds of the rows left: the next byte to look at, and what lies before it."""
    at = F.when(F.col("h0") != F.col("h1"), _common(F.col("h0"), F.col("h1"))).otherwise(F.lit(8) + _common(F.col("l0"), F.col("l1")))
    df = df.withColumn("at", at.cast("int"))
    mh, ml = _mask(F.least(F.col("at"), F.lit(8))), _mask(F.col("at") - 8)
    return df.select("*", mh.alias("mh"), ml.alias("ml"), F.col("h0").bitwiseAND(mh).alias("vh"), F.col("l0").bitwiseAND(ml).alias("vl"))


def group_bounds(rows: DataFrame, group: str, hi: str, lo: str) -> DataFrame:
    """Count and key bounds of every group, combined before the shuffle."""
    return rows.groupBy(group).agg(F.count("*").alias("n"), F.min(hi).alias("h0"), F.max(hi).alias("h1"), F.min(lo).alias("l0"), F.max(lo).alias("l1"))


def cutoffs(rows: DataFrame, bounds: DataFrame, group: str, hi: str, lo: str) -> DataFrame:
    """Per group the largest key to keep, as ``group, cut_h, cut_l``.

    ``bounds`` is group_bounds() with a column ``take`` of 1 <= take < n; other groups need
    no cut-off. Rows with equal keys count as one order; keys should be unique in a group.
    """
    state, done = cut(_advance(bounds.select(group, F.col("take").cast("bigint").alias("left"), "h0", "h1", "l0", "l1"))), None
    over = Window.partitionBy(group).orderBy("digit")
    for _ in range(17):
        if state.isEmpty():
            break
        keys = rows.select(group, F.col(hi).alias("_h"), F.col(lo).alias("_l"))
        inside = skew_join(keys, state.select(group, "left", "at", "mh", "ml", "vh", "vl"), [group])
        inside = inside.filter((F.col("_h").bitwiseAND(F.col("mh")) == F.col("vh")) & (F.col("_l").bitwiseAND(F.col("ml")) == F.col("vl")))
        counted = inside.groupBy(group, "left", _byte(F.col("_h"), F.col("_l"), F.col("at")).alias("digit")).agg(
            F.count("*").alias("n"), F.min("_h").alias("h0"), F.max("_h").alias("h1"), F.min("_l").alias("l0"), F.max("_l").alias("l1")
        )
        run = counted.withColumn("upto", F.sum("n").over(over)).withColumn("before", F.col("upto") - F.col("n"))
        hit = cut(run.filter((F.col("before") < F.col("left")) & (F.col("left") <= F.col("upto"))).withColumn("left", F.col("left") - F.col("before")))
        alone = (F.col("h0") == F.col("h1")) & (F.col("l0") == F.col("l1"))
        ends = (F.col("left") == F.col("n")) & (F.col("h0") == F.col("h1")) | alone
        found = hit.filter(ends).select(group, F.col("h1").alias("cut_h"), F.col("l1").alias("cut_l"))
        done = found if done is None else done.unionByName(found)
        state = cut(_advance(hit.filter(~ends).select(group, "left", "h0", "h1", "l0", "l1")))
    if done is None:
        done = bounds.select(group, F.col("h0").alias("cut_h"), F.col("l0").alias("cut_l")).limit(0)
    return done


def within(hi: str, lo: str) -> Column:
    """The key is at most the cut-off of its group."""
    return (F.col(hi) < F.col("cut_h")) | (F.col(hi) == F.col("cut_h")) & (F.col(lo) <= F.col("cut_l"))
