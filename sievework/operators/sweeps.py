"""What-if runs: thresholds of the keep rule and of deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievework.functions.rules import FLOORS, keep_expr, total_score
from sievework.functions.text import opener
from sievework.operators.dedup import edges_within, matches, resolve, similarity_edges
from sievework.session import cut

MIN_SCORES = (3, 4, 5, 6)
THRESHOLDS = (0.75, 0.85, 0.90, 0.95)


def threshold_sweep(graded: DataFrame, min_scores: tuple[int, ...] = MIN_SCORES) -> DataFrame:
    """Per least score, with and without floors: pairs that pass, their score sum and distinct openers.

    One pass over the pairs decides all variants. Unscored pairs count for none.
    """
    scored = graded.filter(total_score(F.col("scores")).isNotNull())
    flags = [F.struct(F.lit(m).alias("min_score"), F.lit(on).alias("floors"), keep_expr(F.col("scores"), m, FLOORS if on else {}).alias("keep")) for m in min_scores for on in (True, False)]
    long = scored.select(F.explode(F.array(*flags)).alias("v"), total_score(F.col("scores")).alias("total"), opener(F.col("question")).alias("opener"))
    kept = F.col("v.keep")
    return long.groupBy("v.min_score", "v.floors").agg(F.count("*").alias("graded"), F.count_if(kept).alias("passed"), F.coalesce(F.sum(F.when(kept, F.col("total"))), F.lit(0)).alias("score_sum"), F.countDistinct(F.when(kept, F.col("opener"))).alias("unique_openers"))


def swept_dedup(graded: DataFrame, ord_col: str, vector: str, min_scores: tuple[int, ...] = MIN_SCORES, threshold: float = 0.90) -> DataFrame:
    """threshold_sweep() with what greedy deduplication leaves of every variant; edges are found once."""
    edges = cut(similarity_edges(graded, threshold, ord_col, vector))
    out = None
    for m in min_scores:
        for on in (True, False):
            kept = cut(graded.filter(keep_expr(F.col("scores"), m, FLOORS if on else {})).select(F.col(ord_col).alias("i")))
            gone = resolve(edges_within(edges, kept))
            row = kept.agg(F.count("*").alias("passed")).crossJoin(gone.agg(F.count("*").alias("duplicates")))  # one row each
            row = row.select(F.lit(m).alias("min_score"), F.lit(on).alias("floors"), "passed", "duplicates", (F.col("passed") - F.col("duplicates")).alias("after_dedup"))
            out = row if out is None else out.unionByName(row)
    return out


def dedup_sweep(vectors: DataFrame, ord_col: str, vector: str, thresholds: tuple[float, ...] = THRESHOLDS) -> DataFrame:
    """Per cosine threshold: survivors and removals. Edges are found once, at the least threshold."""
    edges = cut(similarity_edges(vectors, min(thresholds), ord_col, vector))
    n = vectors.agg(F.count("*").alias("rows"))
    out = None
    for t in thresholds:
        gone = cut(resolve(edges.filter(F.col("similarity") >= t)))
        row = n.crossJoin(gone.agg(F.count("*").alias("removed")))  # one row each
        row = row.select(F.lit(t).alias("threshold"), (F.col("rows") - F.col("removed")).alias("survivors"), "removed")
        out = row if out is None else out.unionByName(row)
    return out


def least_similar_removals(edges: DataFrame, thresholds: tuple[float, ...] = THRESHOLDS, top: int = 3) -> DataFrame:
    """Per threshold the removals that resemble their match least."""
    out = None
    for t in thresholds:
        own = edges.filter(F.col("similarity") >= t)
        row = matches(own, resolve(own)).withColumn("threshold", F.lit(t))
        out = row if out is None else out.unionByName(row)
    nth = F.row_number().over(Window.partitionBy("threshold").orderBy("similarity", "i"))
    return out.withColumn("nth", nth).filter(F.col("nth") <= top)
