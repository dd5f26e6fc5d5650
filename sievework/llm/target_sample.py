"""A sample whose categories have target shares, with a report of what could not be met."""

from __future__ import annotations

from dataclasses import dataclass
from fractions import Fraction

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.llm.radix import cutoffs, group_bounds, within
from sievework.session import broadcast_if_small, cut


@dataclass
class TargetSample:
    """``sample``: plan_id, cell_id, id. ``report``: a row per cell with its quota, the share of the sample
    that this makes, and the shortfall: records missing to what is wanted or to the minimum."""

    sample: DataFrame
    report: DataFrame


def allocate(total: int, weights: list[int], floors: list[int], available: list[int]) -> list[int]:
    """Integer quotas that add up to ``total`` where bounds allow it.

    Proportional to ``weights`` by largest remainder (ties: earlier cell); no quota is under
    min(floor, available) or over available. Cells at a bound are fixed, the rest is shared anew.
    """
    low = [min(max(f, 0), a) for f, a in zip(floors, available)]
    fixed: dict[int, int] = {}
    while True:
        free = [i for i in range(len(weights)) if i not in fixed]
        left, weight = total - sum(fixed.values()), sum(weights[i] for i in free)
        share = {i: Fraction(max(left, 0) * weights[i], weight) if weight else Fraction(0) for i in free}
        under = {i: low[i] - share[i] for i in free if share[i] < low[i]}
        over = {i: share[i] - available[i] for i in free if share[i] > available[i]}
        if not under and not over:
            break
        if sum(under.values()) >= sum(over.values()):
            fixed |= {i: low[i] for i in under}
        else:
            fixed |= {i: available[i] for i in over}
    quota = [fixed.get(i, 0) for i in range(len(weights))]
    for i in free:
        quota[i] = share[i].numerator // share[i].denominator
    missing = min(total - sum(quota), len(free)) if sum(weights[i] for i in free) else 0
    for i in sorted(free, key=lambda i: (quota[i] - share[i], i))[: max(missing, 0)]:
        quota[i] += quota[i] < available[i]
    return quota


_REPORT = "plan_id int, cell_id int, available bigint, wanted double, min_rows bigint, quota bigint, shortfall bigint, share double, unmet boolean"


def _plan(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("cell_id").reset_index(drop=True)
    n, c = [int(x) for x in pdf["total"]], [int(x) for x in pdf["available"]]
    pct, sample, least = ([int(x) for x in pdf[k].fillna(0)] for k in ("target_pct", "sample_pct", "min_rows"))
    wanted = [Fraction(p * s * m, 10000) for p, s, m in zip(pct, sample, n)]
    size = int(sum(wanted) + Fraction(1, 2))
    quota = allocate(size, pct, least, c)
    return pd.DataFrame(
        {
            "plan_id": pdf["plan_id"],
            "cell_id": pdf["cell_id"],
            "available": c,
            "wanted": [float(w) for w in wanted],
            "min_rows": least,
            "quota": quota,
            "shortfall": [max(0, -(-w.numerator // w.denominator) - a, m - a) for a, w, m in zip(c, wanted, least)],
            "share": [round(q / max(1, sum(quota)), 6) for q in quota],
            "unmet": [a < w or a < m for a, w, m in zip(c, wanted, least)],
        }
    )


def target_sample(df: DataFrame, id_col: str, keys: dict[str, Column], cells: DataFrame, *, delivered: Column | None = None, seed: int = 42) -> TargetSample:
    """Draw, for each plan of ``cells``, a sample with the plan's shares of categories.

    ``keys`` gives the category of a row under the names that the columns of ``cells`` have
    (``plan_id, cell_id, sample_pct, target_pct, min_rows`` and the keys). A row whose key is
    null or in no cell belongs to none but counts in N. Rows of one id count once (the latest
    by ``delivered``, then the largest values); rows with a null id are left out. A null
    percentage or minimum is 0; cells without plan or number are left out. An empty table leaves every cell with a positive wish unmet;
    empty cells give an empty report. Other columns of ``df`` are never looked at.

    Chosen in a cell are the rows with the smallest random keys: a hash of seed and id, then
    the id. The same seed gives the same sample at any partitioning.
    """
    names = list(keys)
    order = F.lit(0) if delivered is None else delivered
    picked = df.select(F.col(f"`{id_col}`").cast("bigint").alias("lo"), F.struct(order.alias("w"), *[c.alias(k) for k, c in keys.items()]).alias("s")).filter("lo is not null")
    rows = cut(picked.groupBy("lo").agg(F.max("s").alias("s")).select("lo", *[F.col(f"s.{k}").alias(k) for k in names]))
    counts = cut(rows.groupBy(*names).agg(F.count("*").alias("available")))
    total = counts.agg(F.coalesce(F.sum("available"), F.lit(0))).first()[0]
    cells = cells.filter("plan_id is not null and cell_id is not null").select(*names, "plan_id", "cell_id", "sample_pct", "target_pct", "min_rows")
    plans = cells.join(counts, names, "left").select("plan_id", "cell_id", "sample_pct", "target_pct", "min_rows", F.coalesce("available", F.lit(0)).alias("available"), F.lit(total).cast("bigint").alias("total"))
    report = cut(plans.groupBy("plan_id").applyInPandas(_plan, _REPORT))

    wanted = broadcast_if_small(cells.select(*names, "cell_id").join(report, "cell_id").filter("quota > 0").select(*names, "plan_id", "cell_id", "quota"))
    inside = rows.join(wanted, names).select("plan_id", "cell_id", "quota", F.xxhash64(F.lit(seed), F.col("lo")).alias("hi"), "lo")
    bounds = cut(group_bounds(inside, "cell_id", "hi", "lo").join(report.select("cell_id", F.col("quota").alias("take")), "cell_id").filter("take < n"))
    limits = broadcast_if_small(cut(cutoffs(inside, bounds, "cell_id", "hi", "lo")))
    chosen = inside.join(limits, "cell_id", "left").filter(F.col("cut_h").isNull() | within("hi", "lo"))
    return TargetSample(chosen.select("plan_id", "cell_id", F.col("lo").alias("id")), report)
