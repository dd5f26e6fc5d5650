"""Capping records per dominant contributor by radix selection."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.llm.radix import cutoffs, group_bounds, within
from sievework.session import cut, skew_join

_LAST = 1 << 40  # after every negated INT


@dataclass
class Capped:
    """``dropped``: id, contributor. ``contributors``: contributor, n, kept, for all of them."""

    dropped: DataFrame
    contributors: DataFrame
    allowed: int


def cap_contributors(
    df: DataFrame, id_col: str, contributor: Column, score: Column, *, delivered: Column | None = None, max_rows: int | None = None, share_of: int | None = None
) -> Capped:
    """Records beyond ``max_rows`` of a contributor, or beyond floor(N / ``share_of``) of N ids.

    The best scores stay; null scores come last, ties go to the smaller id.
    ``score`` must be INT or smaller, ``id_col`` an integer. Rows of one id count once;
    of several, the latest by ``delivered`` holds (then the largest values). Rows with a
    null id are not records and are left out. A null contributor has no limit. An empty
    table gives empty results. Other columns of ``df`` are never looked at.
    """
    order = F.lit(0) if delivered is None else delivered
    hi = F.coalesce(-score.cast("bigint"), F.lit(_LAST))
    picked = df.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.struct(order.alias("w"), contributor.alias("who"), hi.alias("hi")).alias("s")).filter("id is not null")
    rows = cut(picked.groupBy("id").agg(F.max("s").alias("s")).select("id", "s.who", "s.hi"))
    groups = cut(group_bounds(rows.withColumnRenamed("id", "lo"), "who", "hi", "lo"))
    total = groups.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    allowed = max_rows if share_of is None else total // share_of
    groups = groups.withColumn("take", F.lit(allowed).cast("bigint"))
    over = groups.filter("who is not null and n > take")
    keyed = rows.withColumnRenamed("id", "lo")
    if allowed < 1:
        dropped = rows.filter("who is not null").select("id", "who")
    else:
        dropped = skew_join(keyed, cut(cutoffs(keyed, over, "who", "hi", "lo")), ["who"]).filter(~within("hi", "lo")).select(F.col("lo").alias("id"), "who")
    kept = F.when(F.col("who").isNull(), F.col("n")).otherwise(F.least("n", "take"))
    return Capped(dropped, groups.select(F.col("who").alias("contributor"), "n", kept.alias("kept")), allowed)
