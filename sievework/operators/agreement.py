"""Agreement of two raters: Cohen's kappa, plain and with quadratic weights."""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.functions.rules import keep_expr
from sievework.operators.ordinals import with_ordinal
from sievework.schemas import CRITERIA
from sievework.session import broadcast_if_small, cut


def contingency(ratings: DataFrame, a: str, b: str) -> DataFrame:
    """Counts of label pairs; rows where either is null are left out."""
    return ratings.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(F.col(a).alias("x"), F.col(b).alias("y")).agg(F.count("*").alias("n"))


def kappa(ratings: DataFrame, a: str, b: str) -> DataFrame:
    """One row: ``n, agree, kappa, weighted_kappa`` for whole-number labels.

    Kappas are null, and ``constant`` true, where either rater gave one label only.
    """
    table = cut(contingency(ratings, a, b))
    rows = table.groupBy(F.col("x").alias("l")).agg(F.sum("n").alias("rn"))
    cols = table.groupBy(F.col("y").alias("l")).agg(F.sum("n").alias("cn"))
    labels = rows.join(cols, "l", "full").select(F.col("l").cast("double").alias("l"), F.coalesce("rn", F.lit(0)).alias("rn"), F.coalesce("cn", F.lit(0)).alias("cn"))
    # what differs by chance, squared, follows from sums over the labels; no grid of labels is made
    chance = labels.agg(
        F.sum(F.col("rn") * F.col("cn")).alias("by_chance"), F.count_if(F.col("rn") > 0).alias("kx"), F.count_if(F.col("cn") > 0).alias("ky"), F.coalesce(F.sum("rn"), F.lit(0)).alias("n"),
        (F.sum(F.col("rn") * F.col("l") * F.col("l")) * F.sum("cn") - 2 * F.sum(F.col("rn") * F.col("l")) * F.sum(F.col("cn") * F.col("l")) + F.sum("rn") * F.sum(F.col("cn") * F.col("l") * F.col("l"))).alias("we"),
    )
    seen = table.agg(F.coalesce(F.sum(F.when(F.col("x") == F.col("y"), F.col("n"))), F.lit(0)).alias("agree"), F.sum(F.col("n") * F.pow(F.col("x") - F.col("y"), F.lit(2))).alias("wo"))
    one = chance.crossJoin(seen)  # one row each
    constant = (F.least("kx", "ky") < 2) | (F.col("n") == 0)
    n = F.col("n").cast("double")
    po, pe = F.col("agree") / n, F.coalesce(F.col("by_chance"), F.lit(0)) / (n * n)
    return one.select("n", "agree", constant.alias("constant"), F.round(F.when(~constant, (po - pe) / (1 - pe)), 6).alias("kappa"), F.round(F.when(~constant, 1 - F.col("wo") * n / F.col("we")), 6).alias("weighted_kappa"))


def strength(k: Column) -> Column:
    """A word for a kappa."""
    return F.when(k.isNull(), "undefined").when(k < 0, "none").when(k <= 0.2, "slight").when(k <= 0.4, "fair").when(k <= 0.6, "moderate").when(k <= 0.8, "substantial").otherwise("almost perfect")


def constant_raters(ratings: DataFrame, columns: list[str]) -> DataFrame:
    """``rater, labels, constant`` for each column."""
    counted = ratings.agg(*[F.countDistinct(c).alias(c) for c in columns])
    return counted.select(F.explode(F.array(*[F.struct(F.lit(c).alias("rater"), F.col(c).alias("labels")) for c in columns])).alias("r")).select("r.rater", "r.labels", (F.col("r.labels") < 2).alias("constant"))


def keep_agreement(ratings: DataFrame, a: str, b: str) -> DataFrame:
    """kappa() of what the keep rule makes of two raters' scores."""
    return kappa(ratings.select(keep_expr(F.col(a)).cast("int").alias("a"), keep_expr(F.col(b)).cast("int").alias("b")), "a", "b")


def criteria_kappas(ratings: DataFrame, a: str, b: str) -> DataFrame:
    """kappa() of each criterion of two score structs."""
    out = None
    for k in CRITERIA:
        row = kappa(ratings.select(F.col(a)[k].alias("a"), F.col(b)[k].alias("b")), "a", "b").withColumn("criterion", F.lit(k))
        out = row if out is None else out.unionByName(row)
    return out


def seeded_sample(pairs: DataFrame, order: list[Column], size: int = 40, seed: int = 42) -> DataFrame:
    """``size`` rows that a seeded draw picks by ``order``, in drawn order as ``draw``."""
    numbered = cut(with_ordinal(pairs, order))
    n = numbered.count()
    drawn = random.Random(seed).sample(range(n), min(size, n))
    chosen = pairs.sparkSession.createDataFrame(list(zip(drawn, range(len(drawn)))), "ord bigint, draw int")
    return numbered.join(broadcast_if_small(chosen), "ord")
