"""Judging: batches of one passage, responses put back to their pairs, the three outcomes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.functions.model_json import as_boolean, as_text, json_object, json_objects
from sievework.functions.rules import MIN_SCORE, NOT_ASSESSED, abstention_note, abstention_outcome, clamp_score, keep_expr, outcome, reject_reason
from sievework.functions.text import or_true, strip
from sievework.operators.ordinals import with_ordinal
from sievework.schemas import CRITERIA
from sievework.session import broadcast_if_small, cut

#: Characters of a passage that the judge sees, and of its reason that are kept.
CONTEXT, REASON = 800, 150
JUDGE_PROMPT = (
    "Grade each numbered pair against the passage: groundedness, specificity and completeness, each 0, 1 or 2, and a short reason. "
    'Reply with a JSON array of objects with the keys "index", "groundedness", "specificity", "completeness" and "reason".\n\nPassage:\n'
)


def passage_groups(pairs: DataFrame, passage: str = "chunk_text", order: str = "pair_ord", batch: int = 50) -> DataFrame:
    """Pairs of one passage text, in order: ``passage, batch_no, pairs``.

    Equal texts fall together wherever they stand, null ones too. A passage with more than
    ``batch`` pairs is cut into batches by row numbers over the table, so that no task gathers it.
    """
    item = F.sort_array(F.collect_list(F.struct(F.col(order).alias("pair_ord"), "question", "answer"))).alias("pairs")
    large = cut(pairs.groupBy(passage).agg(F.count("*").alias("n")).filter(F.col("n") > batch).select(F.col(passage).alias("_large")))
    match = F.col(passage).eqNullSafe(F.col("_large"))
    few = broadcast_if_small(large)
    small = pairs.join(few, match, "left_anti").groupBy(F.col(passage).alias("passage")).agg(item).select("passage", F.lit(0).cast("bigint").alias("batch_no"), "pairs")
    if large.isEmpty():
        return small
    numbered = with_ordinal(pairs.join(few, match, "left_semi"), [F.col(passage), F.col(order)], "_ord")
    return small.unionByName(numbered.groupBy(F.col(passage).alias("passage"), F.floor(F.col("_ord") / batch).alias("batch_no")).agg(item))


def batch_prompt(passage: Column, pairs: Column) -> Column:
    """Rubric, the head of the passage, and the pairs, numbered from 1."""
    lines = F.transform(pairs, lambda p, i: F.concat(F.lit("\n["), (i + 1).cast("string"), F.lit("] Q: "), p["question"], F.lit("\n    A: "), p["answer"]))
    return F.concat(F.lit(JUDGE_PROMPT), F.substring(passage, 1, CONTEXT), F.lit("\n\nPairs:"), F.array_join(lines, ""))


def scores_of(fields: Column) -> Column:
    """Clamped scores of a judge's object."""
    return F.struct(*[clamp_score(F.coalesce(F.element_at(fields, F.lit(k)), F.lit("null"))).cast("int").alias(k) for k in CRITERIA])


def aligned_scores(groups: DataFrame, response: str = "raw") -> DataFrame:
    """``pair_ord, scores, reason`` for the pairs of groups with a response.

    An item belongs to the pair of its index, or of its position if it has none that is a whole
    number; indices out of range are dropped, and of two items for one pair the later counts.
    """
    item = F.explode(json_objects(F.col(response))).alias("_o")
    got = groups.select("pairs", item).withColumn("_i", F.element_at("_o.fields", F.lit("index")))
    # a whole number in quotes, or any number without
    whole = F.coalesce(*[F.regexp_extract(F.col("_i"), p, 1).try_cast("int") for p in (r'^"\s*([+-]?\d+)\s*"$', r"^([+-]?\d+)(?:\.\d+)?$")], F.when(F.col("_i") == "true", 1).when(F.col("_i") == "false", 0))
    own = F.coalesce(whole, F.col("_o.at") + 1)
    placed = got.withColumn("_p", own).filter((F.col("_p") >= 1) & (F.col("_p") <= F.size("pairs")))
    row = placed.select(F.element_at("pairs", F.col("_p"))["pair_ord"].alias("pair_ord"), F.col("_o.at").alias("_at"), scores_of(F.col("_o.fields")).alias("scores"), F.substring(strip(F.coalesce(as_text(F.element_at("_o.fields", F.lit("reason"))), F.lit(""))), 1, REASON).alias("reason"))
    last = F.max_by(F.struct("scores", "reason"), "_at").alias("_s")
    return row.groupBy("pair_ord").agg(last).select("pair_ord", "_s.scores", "_s.reason")


def unjudged(groups: DataFrame, scores: DataFrame) -> DataFrame:
    """``key, prompt, pair_ord``: the pairs of groups none of whose pairs has a score, each for a call of its own.

    Pairs that read the same have one key.
    """
    each = groups.select("key", "passage", F.explode("pairs").alias("pair"))
    scored = each.join(scores.select("pair_ord"), F.col("pair.pair_ord") == F.col("pair_ord"), "left_semi").select("key")
    alone = each.join(scored.distinct(), "key", "left_anti").select(batch_prompt(F.col("passage"), F.array("pair")).alias("prompt"), F.col("pair.pair_ord").alias("pair_ord"))
    return alone.withColumn("key", F.sha2("prompt", 256))


def single_scores(responses: DataFrame, response: str = "raw") -> DataFrame:
    """``pair_ord, scores, reason`` of pairs judged alone, by an object or the first one of an array."""
    fields = F.coalesce(F.get(json_objects(F.col(response)), F.lit(0))["fields"], json_object(F.col(response)))
    reason = F.substring(strip(F.coalesce(as_text(F.element_at("_f", F.lit("reason"))), F.lit(""))), 1, REASON)
    return responses.withColumn("_f", fields).filter("_f is not null").select("pair_ord", scores_of(F.col("_f")).alias("scores"), reason.alias("reason"))


def abstention_checks(responses: DataFrame, response: str = "raw", keep: list[str] | None = None, fixed_answer: Column | None = None) -> DataFrame:
    """The check of abstention pairs; only real booleans count as answers."""
    wide = responses.withColumn("_f", json_object(F.col(response)))
    value = {k: as_boolean(F.element_at("_f", F.lit(k))) for k in ("unanswerable", "plausible")}
    check = F.struct(value["unanswerable"].alias("unanswerable"), value["plausible"].alias("plausible"), (F.lit(True) if fixed_answer is None else fixed_answer).alias("abstention_answer"))
    return wide.select(*(keep or []), check.alias("check"))


def graded(pairs: DataFrame, min_score: int = MIN_SCORE, floors: dict[str, int] | None = None) -> DataFrame:
    """Add ``outcome, quality_score, reject_reason`` to pairs with ``answerable, scores, reason, check``.

    Order and number of rows stay: one projection decides for both kinds of pairs.
    """
    able = or_true(F.col("answerable"))
    kind = F.when(able, outcome(F.col("scores"), min_score, floors)).otherwise(F.when(abstention_outcome(F.col("check")) == "passed", "kept").when(abstention_outcome(F.col("check")) == "failed", "rejected").otherwise("not_assessed"))
    failed = F.concat(F.lit("abstention check failed: "), abstention_note(F.col("check"), F.col("reason")))
    why = F.when(able, reject_reason(F.col("scores"), F.col("reason"), min_score, floors)).when(abstention_outcome(F.col("check")) == "not_assessed", NOT_ASSESSED).when(abstention_outcome(F.col("check")) == "failed", failed)
    total = F.when(able, sum((F.coalesce(F.col("scores")[k], F.lit(0)) for k in CRITERIA), F.lit(0)))
    return pairs.withColumns({"outcome": kind, "quality_score": F.when(kind != "not_assessed", total), "reject_reason": why})


def unscored(pairs: DataFrame, scored: DataFrame, key: str = "question") -> DataFrame:
    """Pairs that no saved score exists for."""
    return pairs.join(scored.select(key).distinct(), key, "left_anti")


def outcome_counts(scores: DataFrame, min_score: int = MIN_SCORE, floors: dict[str, int] | None = None) -> DataFrame:
    """Pairs by scores, with the rule's decision."""
    s = F.col("scores")
    return scores.groupBy(*[s[k].alias(k) for k in CRITERIA], outcome(s, min_score, floors).alias("outcome"), keep_expr(s, min_score, floors).alias("keep")).agg(F.count("*").alias("pairs"))
