"""Queries of the training-data operators, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.functions.text import or_true, source_name, trim_blanks
from sievework.llm.capping import Capped, cap_contributors
from sievework.llm.contamination import find_leaks
from sievework.llm.entity_splits import achieved_shares, source_groups, split_by_group
from sievework.llm.near_dup import NearDuplicates, duplicate_classes, id_pairs, near_duplicates
from sievework.llm.packing import container_fill, pack, packing_checks, token_count
from sievework.llm.pair_defects import find_defects, read_pairs, templates
from sievework.llm.target_sample import TargetSample, target_sample
from sievework.llm.unfit_text import CATEGORIES, fit_model, score_documents
from sievework.session import cut, table


def _sample(spark: SparkSession, d: str) -> TargetSample:
    keys = {"question_type": F.lower(trim_blanks(F.col("question_type"))), "answerable": or_true(F.col("answerable"))}
    return target_sample(table(spark, d, "synthetic_dataset"), "pair_id", keys, table(spark, d, "sample_targets"), delivered=F.col("written_at"))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return _sample(spark, d).report.filter("unmet").select("plan_id", "cell_id")


def p1_report(spark: SparkSession, d: str) -> DataFrame:
    return _sample(spark, d).report


def p1_sample(spark: SparkSession, d: str) -> DataFrame:
    return _sample(spark, d).sample.withColumnRenamed("id", "pair_id")


def p1_plans(spark: SparkSession, d: str) -> DataFrame:
    """Per plan the records that its sample has."""
    return _sample(spark, d).sample.groupBy("plan_id").agg(F.count("*").alias("sampled"))


def _capped(spark: SparkSession, d: str) -> Capped:
    return cap_contributors(table(spark, d, "synthetic_dataset"), "pair_id", source_name(F.col("source")), F.col("quality_score"), delivered=F.col("written_at"), share_of=50)


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return _capped(spark, d).dropped.select(F.col("id").alias("pair_id"))


def p2_contributors(spark: SparkSession, d: str) -> DataFrame:
    return _capped(spark, d).contributors


def _near(spark: SparkSession, d: str) -> NearDuplicates:
    text = F.concat(F.coalesce("question", F.lit("")), F.lit(" "), F.coalesce("answer", F.lit("")))
    return near_duplicates(table(spark, d, "synthetic_dataset"), "pair_id", text, F.col("answer"), delivered=F.col("written_at"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return id_pairs(_near(spark, d)).select(F.col("a").alias("pair_id_a"), F.col("b").alias("pair_id_b"))


def p3_classes(spark: SparkSession, d: str) -> DataFrame:
    return duplicate_classes(_near(spark, d)).withColumnRenamed("id", "pair_id")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return find_defects(table(spark, d, "synthetic_dataset"), "pair_id", "question", "answer", F.col("answerable"), delivered=F.col("written_at"))


def p4_templates(spark: SparkSession, d: str) -> DataFrame:
    """The templates that recur over unrelated prompts and bring nothing, with the prompts of their cluster."""
    pairs = table(spark, d, "synthetic_dataset")
    return templates(read_pairs(pairs, "pair_id", "question", "answer", F.col("answerable"), F.col("written_at"))).filter("recurs").select(F.col("word").alias("template"), "uses", "prompts", F.round("shared", 4).alias("shared"))


def p4_rates(spark: SparkSession, d: str) -> DataFrame:
    """Defects by kind and source, against the pairs of the source."""
    pairs = table(spark, d, "synthetic_dataset").filter("pair_id is not null").groupBy("pair_id").agg(F.min(source_name(F.col("source"))).alias("source"))
    marked = pairs.join(p4_found(spark, d), "pair_id", "left")
    return marked.groupBy("source").agg(F.count("*").alias("pairs"), *[F.count_if(F.col("defect") == k).alias(k) for k in ("empty", "copied_question", "other_language", "refusal", "truncated")])


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    groups = cut(source_groups(table(spark, d, "source_files")))
    several = groups.groupBy("group_source").count().filter("count > 1")
    return groups.join(several, "group_source", "left_semi").select("source", "group_source")


def _split(spark: SparkSession, d: str) -> DataFrame:
    return split_by_group(table(spark, d, "synthetic_dataset"), "pair_id", "source", table(spark, d, "source_files"), table(spark, d, "split_targets")).records


def p5_split(spark: SparkSession, d: str) -> DataFrame:
    return _split(spark, d).withColumnRenamed("id", "pair_id")


def p5_shares(spark: SparkSession, d: str) -> DataFrame:
    return achieved_shares(_split(spark, d), table(spark, d, "split_targets"))


def _packed(spark: SparkSession, d: str) -> DataFrame:
    return pack(table(spark, d, "documents"), "doc_id", token_count(F.col("text")))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return _packed(spark, d).filter("pieces > 1").select(F.col("id").alias("doc_id")).distinct()


def p6_containers(spark: SparkSession, d: str) -> DataFrame:
    return _packed(spark, d).withColumnRenamed("id", "doc_id")


def p6_fill(spark: SparkSession, d: str) -> DataFrame:
    return container_fill(_packed(spark, d))


def p6_checks(spark: SparkSession, d: str) -> DataFrame:
    return packing_checks(_packed(spark, d))


def _leaks(spark: SparkSession, d: str) -> DataFrame:
    return find_leaks(table(spark, d, "documents"), "doc_id", "text", table(spark, d, "eval_items"), "item_id", ["question", "answer", "passage"])


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return _leaks(spark, d).select("doc_id", "item_id").distinct()


def p7_spans(spark: SparkSession, d: str) -> DataFrame:
    return _leaks(spark, d)


def _scored(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return score_documents(docs, fit_model(docs, table(spark, d, "content_labels")))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    best = F.max(F.struct(F.greatest(*CATEGORIES), "category")).alias("m")
    return _scored(spark, d).filter("category is not null").groupBy("doc_id").agg(best).select("doc_id", "m.category")


def p8_scores(spark: SparkSession, d: str) -> DataFrame:
    return _scored(spark, d)


def p8_rates(spark: SparkSession, d: str) -> DataFrame:
    """Documents and unfit documents per source."""
    docs = table(spark, d, "documents").select("doc_id", source_name(F.col("source")).alias("source"))
    marked = docs.join(p8_found(spark, d), "doc_id", "left")
    return marked.groupBy("source").agg(F.countDistinct("doc_id").alias("documents"), *[F.count_if(F.col("category") == c).alias(c) for c in CATEGORIES])


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """All queries by name."""
    return {k: v for k, v in globals().items() if k[0] == "p" and k[1].isdigit()}
