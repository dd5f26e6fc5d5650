"""Filling containers of fixed capacity by first-fit decreasing in randomised groups."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.functions.text import WS
from sievework.session import cut

#: Items that one task packs; a group is a random share of all items.
GROUP_ITEMS = 20_000
#: Runs of letters and digits, or runs of anything else that is no white space.
TOKEN = rf"[\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}{WS}]+"


def token_count(text: Column) -> Column:
    """Number of tokens of a whole text; of a null text 0."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(TOKEN)).cast("bigint")


class _Bins:
    """A tournament tree over bins: each inner node holds the largest room below it."""

    def __init__(self, items: int, capacity: int) -> None:
        self.size = 1
        while self.size < items:
            self.size *= 2
        self.room = [capacity] * (2 * self.size)

    def first_fit(self, need: int) -> int:
        room, i = self.room, 1
        while i < self.size:
            i *= 2
            if room[i] < need:
                i += 1
        room[i] -= need
        bin_no, i = i - self.size, i // 2
        while i:
            best = max(room[2 * i], room[2 * i + 1])
            if room[i] == best:
                break
            room[i], i = best, i // 2
        return bin_no


def first_fit_decreasing(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The bin of every item, items taken by falling size (ties: earlier first)."""
    bins, out = _Bins(max(len(sizes), 1), capacity), np.empty(len(sizes), np.int64)
    for i in np.argsort(-sizes, kind="stable").tolist():
        out[i] = bins.first_fit(int(sizes[i]))
    return out


def pack(df: DataFrame, id_col: str, size: Column, capacity: int = 1024, *, group_items: int = GROUP_ITEMS, seed: int = 42) -> DataFrame:
    """``id, piece, pieces, tokens, container_group, container`` for every item.

    An item above ``capacity`` fills containers of its own and leaves one piece with the rest,
    which is packed like any item (pieces count from 0, the rest is last); no other item is
    divided. Groups are drawn by a hash of seed and id, so that each holds about ``group_items``
    pieces to be packed, whatever the sizes; ``container`` names group and bin, or group, ``own``,
    id and piece. Items of size 0 or null go into the first
    container that comes, those with a null id are left out, repeated ids are one item of the
    largest size. An empty table gives an empty result.
    """
    items = cut(df.select(F.col(f"`{id_col}`").alias("id"), F.greatest(F.coalesce(size.cast("bigint"), F.lit(0)), F.lit(0)).alias("tokens")).filter("id is not null").groupBy("id").agg(F.max("tokens").alias("tokens")))
    groups = max(1, -(-items.count() // group_items))
    items = items.withColumn("container_group", F.pmod(F.xxhash64(F.lit(seed), F.col("id")), F.lit(groups)).cast("int"))
    full, rest = F.expr(f"tokens div {capacity}"), F.col("tokens") % capacity
    n_full = F.when((F.col("tokens") > 0) & (rest == 0), full - 1).otherwise(full)
    items = items.select("*", n_full.cast("int").alias("full"), (F.col("tokens") - n_full * capacity).alias("rest"))

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id").reset_index(drop=True)
        return pdf.assign(container=first_fit_decreasing(pdf["rest"].to_numpy(), capacity))

    kind = dict(items.dtypes)["id"]
    packed = items.groupBy("container_group").applyInPandas(one, f"id {kind}, tokens bigint, container_group int, full int, rest bigint, container bigint")
    place = F.concat_ws("/", "container_group", "container")
    last = packed.select("id", F.col("full").alias("piece"), (F.col("full") + 1).alias("pieces"), F.col("rest").alias("tokens"), "container_group", place.alias("container"))
    own = items.filter("full > 0").select("id", F.explode(F.sequence(F.lit(0), F.col("full") - 1)).alias("piece"), (F.col("full") + 1).alias("pieces"), F.lit(capacity).cast("bigint").alias("tokens"), "container_group")
    own = own.withColumn("container", F.concat_ws("/", "container_group", F.lit("own"), F.col("id").cast("string"), "piece"))
    return last.unionByName(own)


def container_fill(packed: DataFrame, capacity: int = 1024) -> DataFrame:
    """Per group: containers, the least number that its tokens need, tokens, and the tokens of room left unused."""
    bins = packed.groupBy("container_group", "container").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("pieces"))
    return bins.groupBy("container_group").agg(F.count("*").alias("containers"), F.ceil(F.sum("tokens") / capacity).alias("least_containers"), F.sum("tokens").alias("tokens"), (F.count("*") * capacity - F.sum("tokens")).alias("unused"))


def packing_checks(packed: DataFrame, capacity: int = 1024) -> DataFrame:
    """One row: items, tokens, containers with more than ``capacity``, items divided without need, and whether
    there are at most 2 % more containers than the tokens need, and one a group."""
    bins = packed.groupBy("container_group", "container").agg(F.sum("tokens").alias("tokens"))
    groups = bins.groupBy("container_group").agg(F.count("*").alias("n"), F.sum("tokens").alias("t"), F.count_if(F.col("tokens") > capacity).alias("overfull"))
    a = groups.agg(F.coalesce(F.sum("overfull"), F.lit(0)).alias("overfull"), (F.sum("n") * 100 * capacity <= 102 * F.sum("t") + 100 * capacity * F.count("*")).alias("near_bound"))
    items = packed.groupBy("id").agg(F.sum("tokens").alias("tokens"), F.max("pieces").alias("pieces"))
    b = items.agg(F.count("*").alias("items"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"), F.count_if((F.col("pieces") > 1) & (F.col("tokens") <= capacity)).alias("divided_needlessly"))
    return b.crossJoin(a)  # one row each
