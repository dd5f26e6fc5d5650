"""Read-side queries: filters, search, pages, best and worst, funnels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievework.functions.rules import abstention_note, abstention_outcome
from sievework.functions.text import or_true
from sievework.operators.agreement import strength
from sievework.schemas import CRITERIA


def explorer_filter(least_score: int, statuses: list[str], types: list[str] | None = None, sources: list[str] | None = None) -> Column:
    """Answerable pairs of at least a score (null as 0), and abstention pairs, each if its status is chosen.

    No chosen type or source means all of them; no chosen status means nothing.
    """
    able = or_true(F.col("answerable"))
    chosen = (able & (F.coalesce(F.col("quality_score"), F.lit(0)) >= least_score) & F.lit("answerable" in statuses)) | (~able & F.lit("abstention" in statuses))
    for name, picks in (("question_type", types), ("source", sources)):
        if picks:
            chosen = chosen & F.coalesce(F.col(name).isin(*picks), F.lit(False))
    return chosen


def search(needle: str) -> Column:
    """The needle, a regular expression, in the lower-cased question or answer."""
    low = needle.lower()
    return F.lower(F.coalesce("question", F.lit(""))).rlike(low) | F.lower(F.coalesce("answer", F.lit(""))).rlike(low)


def view_metrics(pairs: DataFrame, chosen: Column) -> DataFrame:
    """Rows shown and in all, and the score sum of shown rows that have one."""
    return pairs.agg(F.count("*").alias("all_pairs"), F.count_if(chosen).alias("shown"), F.count_if(chosen & F.col("quality_score").isNotNull()).alias("scored"), F.coalesce(F.sum(F.when(chosen, F.col("quality_score"))), F.lit(0)).alias("score_sum"))


def page_of(df: DataFrame, order: list[Column], page: int, size: int = 25) -> DataFrame:
    """One page of rows, counted from 0, with ``ord``; ``order`` should be unique.

    Every task keeps the rows up to this page only. For pages far on, filter by the last key of
    the page before and ask for page 0.
    """
    rows = df.orderBy(*order).offset(page * size).limit(size)
    nth = F.row_number().over(Window.orderBy(*order))  # over one page
    return rows.withColumn("ord", nth.cast("bigint") + page * size - 1)


def worst_rejected(rejected: DataFrame, order: list[Column], top: int = 20) -> DataFrame:
    """Assessed pairs with the lowest scores."""
    return rejected.filter("quality_score is not null").orderBy("quality_score", *order).limit(top)


def best_kept(pairs: DataFrame, order: list[Column], top: int = 20) -> DataFrame:
    return pairs.orderBy(F.desc_nulls_last("quality_score"), *order).limit(top)


def criterion_crosstab(rejected: DataFrame) -> DataFrame:
    """How many rejected pairs scored 0 and 1 on each criterion."""
    long = rejected.select(F.explode(F.array(*[F.struct(F.lit(k).alias("criterion"), F.col("scores")[k].alias("score")) for k in CRITERIA])).alias("s")).select("s.*")
    return long.filter("score in (0, 1)").groupBy("criterion", "score").agg(F.count("*").alias("pairs"))


def closest_duplicates(duplicates: DataFrame, order: list[Column], top: int = 25) -> DataFrame:
    return duplicates.filter("similarity is not null").orderBy(F.desc("similarity"), *order).limit(top)


def passages_by_question(graded: DataFrame, passage: str, order: Column) -> DataFrame:
    """Per question its first passage that is not empty."""
    text = F.when(F.col(passage) != "", F.col(passage))
    return graded.select("question", text.alias("p"), order.alias("o")).filter("p is not null").groupBy("question").agg(F.min_by("p", "o").alias("passage"))


def survival_funnel(raw: int | Column, judged: Column, final: Column) -> Column:
    """Three stages with their pairs and their share of the first, in tenths of a percent, cut off."""
    first = F.lit(raw) if isinstance(raw, int) else raw
    share = lambda c: F.floor(c * 1000 / F.greatest(first, F.lit(1))).cast("bigint")
    return F.array(*[F.struct(F.lit(k).alias("stage"), c.cast("bigint").alias("pairs"), share(c).alias("share")) for k, c in (("1 raw", first), ("2 judged", judged), ("3 deduplicated", final))])


def leniency(graded: DataFrame, most: int = 6) -> DataFrame:
    """Share of full scores and number of scores used; a judge that gives them to over 3 in 4 is lenient."""
    one = graded.filter("quality_score is not null").agg(F.count("*").alias("scored"), F.count_if(F.col("quality_score") == most).alias("full"), F.countDistinct("quality_score").alias("scores_used"))
    return one.withColumn("lenient", F.col("full") * 4 > F.col("scored") * 3)


def weakest_type(found: DataFrame) -> DataFrame:
    """The question type with the lowest mean overlap."""
    means = found.groupBy("question_type").agg(F.avg("lexical_overlap").alias("m"), F.count("*").alias("pairs"))
    return means.orderBy("m", "question_type").limit(1).select("question_type", "pairs")


def abstention_table(unanswerable: DataFrame) -> DataFrame:
    """Abstention pairs with the outcome of their check and, if it failed, why."""
    check = F.col("abstention_check")
    return unanswerable.select("question", "source", "page", "in_dataset", abstention_outcome(check).alias("outcome"), abstention_note(check).alias("note"))


def judged_and_matched(found: DataFrame, score: str = "quality_score") -> DataFrame:
    """Pairs with a score whose passage was found, for setting the judge against the overlap."""
    return found.filter(F.col("passage_found") & F.col(score).isNotNull())


def unsupported_numbers(found: DataFrame) -> DataFrame:
    """Pairs whose answers bring numbers that their passage lacks."""
    return found.filter("passage_found and has_unsupported_number")


def lowest_overlap(found: DataFrame, order: list[Column], top: int = 15) -> DataFrame:
    """The pairs that share least with their passage."""
    return found.filter("passage_found").orderBy("lexical_overlap", *order).limit(top)


def weakest_kappa(kappas: DataFrame, name: str = "criterion") -> DataFrame:
    """The criterion with the least kappa that is defined, its strength, and whether it calls for a warning (under 0.4)."""
    worst = kappas.filter("kappa is not null").orderBy("kappa", name).limit(1)
    return worst.select(name, "kappa", strength(F.col("kappa")).alias("strength"), (F.col("kappa") < 0.4).alias("warn"))


def labelled_progress(sample: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """Rows of a sample, rows with a label, and the first row without."""
    marked = sample.join(labels.select(key).distinct().withColumn("_l", F.lit(1)), key, "left")
    return marked.agg(F.count("*").alias("sampled"), F.count("_l").alias("labelled"), F.min(F.when(F.col("_l").isNull(), F.col(key))).alias("first_open"))


def preview(df: DataFrame, n: int = 3) -> tuple[list[dict], dict[str, bool]]:
    """The first records, and which columns are nested."""
    nested = {f.name: f.dataType.typeName() in ("array", "map", "struct") for f in df.schema.fields}
    return [r.asDict(recursive=True) for r in df.limit(n).collect()], nested
