"""Statistics of a run and its exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.functions.rules import NOT_ASSESSED, UNGROUNDED, abstention_outcome
from sievework.functions.text import or_true, source_name
from sievework.schemas import CRITERIA, EXPORT_FIELDS

#: Parts of file names that mean clinical sources.
CLINICAL = ("who", "clinical", "health", "patient", "hiv", "medical", "disease", "guideline", "treatment", "care")
CLINICAL_SYSTEM = "You answer questions about clinical guidance from the documents given. For education and research only; this is no medical advice."
SYSTEM = "You answer questions from the documents given and from nothing else. For education and research only; this is no professional advice."
REASON_HEAD, TOP_REASONS = 80, 10


def clean_records(pairs: DataFrame) -> DataFrame:
    """The export columns, in order; missing ones are null."""
    kinds = {"page": "int", "answerable": "boolean", "quality_score": "int"}
    return pairs.select(*[F.col(c) if c in pairs.columns else F.lit(None).cast(kinds.get(c, "string")).alias(c) for c in EXPORT_FIELDS])


def assert_no_internals(exported: DataFrame) -> None:
    """Fail if anything but the export columns is there."""
    extra = [c for c in exported.columns if c not in EXPORT_FIELDS]
    if extra:
        raise ValueError(f"columns that must not be exported: {extra}")


def clinical(sources: Column) -> Column:
    """Whether any source, in a group, looks clinical."""
    low = F.lower(F.coalesce(sources, F.lit("")))
    hit = F.lit(False)
    for part in CLINICAL:
        hit = hit | low.contains(part)
    return F.coalesce(F.bool_or(hit), F.lit(False))


def with_messages(pairs: DataFrame, include_system: bool = True) -> DataFrame:
    """Add ``messages``: a system, a user and an assistant turn. The system turn depends on all sources together."""
    system = pairs.agg(F.when(clinical(F.col("source")), CLINICAL_SYSTEM).otherwise(SYSTEM).alias("_system"))
    turn = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    turns = [turn("user", F.col("question")), turn("assistant", F.col("answer"))]
    wide = pairs.crossJoin(F.broadcast(system))  # one row on the right
    return wide.withColumn("messages", F.array(*([turn("system", F.col("_system"))] if include_system else []), *turns)).drop("_system")


def chat_records(pairs: DataFrame, include_system: bool = True) -> DataFrame:
    """``messages`` beside the other export columns."""
    return with_messages(pairs, include_system).select("messages", "source", "page", "question_type", or_true(F.col("answerable")).alias("answerable"), "quality_score")


def counts(final: DataFrame, rejected: DataFrame, duplicates: DataFrame) -> DataFrame:
    """One row: what a run made, kept and dropped, with the numerators and denominators of its rates."""
    able = or_true(F.col("answerable"))
    f = final.agg(F.count("*").alias("final"), F.count_if(~able).alias("final_unanswerable"))
    r = rejected.agg(
        F.count("*").alias("rejected"), F.count_if(F.col("quality_score").isNull() & able).alias("unassessed"), F.count_if(~able).alias("rejected_unanswerable"),
        F.count_if(F.col("reject_reason") == NOT_ASSESSED).alias("judge_failures"), F.count_if(F.col("reject_reason").startswith(UNGROUNDED)).alias("ungrounded"),
    )
    d = duplicates.agg(F.count("*").alias("duplicates"))
    one = f.crossJoin(r).crossJoin(d)  # one row each
    validated = F.col("final") + F.col("duplicates")
    raw = validated + F.col("rejected")
    assessed = F.greatest(raw - F.col("unassessed"), F.lit(1))
    return one.select("*", validated.alias("validated"), raw.alias("raw"), assessed.alias("assessed"))


def rates(counted: DataFrame) -> DataFrame:
    """Pass, duplicate and yield rates in tenths of a percent, cut off; no denominator is 0."""
    per = lambda n, d: F.floor(F.col(n) * 1000 / F.greatest(F.col(d), F.lit(1))).cast("bigint")
    return counted.select(per("validated", "assessed").alias("pass_rate"), per("duplicates", "validated").alias("duplicate_rate"), per("final", "raw").alias("yield_rate"), per("unassessed", "raw").alias("unassessed_rate"), (F.col("judge_failures") == 0).alias("complete"))


def answerable_rates(final: DataFrame, rejected: DataFrame) -> DataFrame:
    """Per kind of pair: passed, assessed, and the pass rate in tenths of a percent, cut off."""
    both = final.select("answerable", F.lit(True).alias("ok"), F.lit(True).alias("seen")).unionByName(rejected.select("answerable", F.lit(False).alias("ok"), F.col("quality_score").isNotNull().alias("seen")))
    by = both.groupBy(or_true(F.col("answerable")).alias("answerable")).agg(F.count_if("ok").alias("passed"), F.count_if("seen").alias("assessed"))
    return by.withColumn("pass_rate", F.floor(F.col("passed") * 1000 / F.greatest("assessed", F.lit(1))).cast("bigint"))


def per_chunk(log: DataFrame, broken: Column, pairs: DataFrame) -> DataFrame:
    """One row: chunks in the log, those without a whole record, their share in tenths of a percent, and pairs a chunk in hundredths."""
    keys = log.groupBy("chunk_key").agg(F.bool_and(broken).alias("failed"))
    one = keys.agg(F.count("*").alias("chunks"), F.count_if("failed").alias("failed_chunks")).crossJoin(pairs.agg(F.count("*").alias("pairs")))  # one row each
    return one.withColumns({"failed_share": F.floor(F.col("failed_chunks") * 1000 / F.greatest("chunks", F.lit(1))).cast("bigint"), "pairs_a_chunk_1e2": F.floor(F.col("pairs") * 100 / F.greatest("chunks", F.lit(1))).cast("bigint")})


def abstention_block(unanswerable: DataFrame, final: DataFrame, requested: Column | None = None) -> DataFrame:
    """One row of five counts: requested, generated, verified, in the dataset, failed. Without ``requested`` all that exist were."""
    outcome = abstention_outcome(F.col("abstention_check"))
    made = unanswerable.agg(F.count("*").alias("generated"), F.count_if(outcome == "passed").alias("verified"), F.count_if(outcome == "failed").alias("failed"))
    there = final.agg(F.count_if(~or_true(F.col("answerable"))).alias("in_dataset"))
    return made.crossJoin(there).select((F.col("generated") if requested is None else requested).alias("requested"), "generated", "verified", "in_dataset", "failed")  # one row each


def quality(pairs: DataFrame) -> DataFrame:
    """One row on the scores that are there."""
    return pairs.agg(F.count("quality_score").alias("scored"), F.sum("quality_score").alias("score_sum"), F.min("quality_score").alias("least"), F.max("quality_score").alias("most"))


def score_distribution(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("quality_score").agg(F.count("*").alias("pairs"))


def sub_scores(pairs: DataFrame) -> DataFrame:
    """Per criterion: pairs scored, sum and mean."""
    long = pairs.select(F.explode(F.array(*[F.struct(F.lit(k).alias("criterion"), F.col("scores")[k].alias("score")) for k in CRITERIA])).alias("s")).select("s.*")
    return long.filter("score is not null").groupBy("criterion").agg(F.count("*").alias("pairs"), F.sum("score").alias("score_sum"), F.round(F.avg("score"), 3).alias("mean_score"))


def abstention_report(unanswerable: DataFrame, final: DataFrame) -> DataFrame:
    """Add ``check_outcome`` and ``now_in_dataset``: whether a final pair asks the same question."""
    asked = final.select("question").distinct().withColumn("_there", F.lit(True))
    return unanswerable.join(asked, "question", "left").withColumn("now_in_dataset", F.col("_there").isNotNull()).withColumn("check_outcome", abstention_outcome(F.col("abstention_check"))).drop("_there")


def per_source(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy(source_name(F.col("source")).alias("source")).agg(F.count("*").alias("pairs"))


def per_type(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy(F.lower(F.trim("question_type")).alias("question_type")).agg(F.count("*").alias("pairs"))


def top_reasons(rejected: DataFrame, order: Column | None = None, head: int = REASON_HEAD, top: int = TOP_REASONS) -> DataFrame:
    """The commonest beginnings of reject reasons; ties to the first seen by ``order``, then by the text."""
    first = F.min(F.lit(0) if order is None else order).alias("first")
    by = rejected.filter("reject_reason is not null").groupBy(F.substring("reject_reason", 1, head).alias("reason")).agg(F.count("*").alias("pairs"), first)
    return by.orderBy(F.desc("pairs"), "first", "reason").limit(top).drop("first")


def summary_by_answerable(pairs: DataFrame) -> DataFrame:
    """Pairs, scored pairs and score sum of answerable and other pairs."""
    return pairs.groupBy(or_true(F.col("answerable")).alias("answerable")).agg(F.count("*").alias("pairs"), F.count("quality_score").alias("scored"), F.sum("quality_score").alias("score_sum"))


def dataset_card(name: str, counted: dict[str, int]) -> str:
    """A short description of a dataset in Markdown."""
    lines = "\n".join(f"| {k.replace('_', ' ')} | {v} |" for k, v in counted.items())
    return f"# {name}\n\nQuestion-answer pairs made from documents by a model and graded by another. For education and research only.\n\n| what | number |\n|---|---|\n{lines}\n\nColumns: {', '.join(EXPORT_FIELDS)}.\n"
