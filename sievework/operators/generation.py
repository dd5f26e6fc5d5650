"""From passages to question-answer pairs: prompts, responses, gates, abstention."""

from __future__ import annotations

import math
import random

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.functions.model_json import as_text, json_object, json_objects
from sievework.functions.rules import ABSTENTION, MIN_QUESTION, about_the_document, leans_on_passage, long_enough, normal_type
from sievework.functions.text import strip, stripped_length
from sievework.operators.ordinals import with_ordinal
from sievework.session import broadcast_if_small

#: Share of passages that also get a question they cannot answer; seed of the choice.
ABSTENTION_SHARE, SEED = 0.10, 42
#: How a rate limit says when to come again: minutes, if any, and seconds.
RETRY = r"try again in (?:(\d+)m)?([\d.]+)s"

PAIRS_PROMPT = (
    "From the passage below, write {n} question-answer pairs that it fully supports. Each question must make sense "
    "without the passage and must not ask about the publication. Use the types factual, definitional and procedural. "
    'Reply with a JSON array of objects with the keys "question", "answer" and "question_type".\n\nPassage:\n'
)
ABSTENTION_PROMPT = (
    "Write one question on the topic of the passage below that a reader may well ask and that the passage does not answer, "
    'not even in part. Reply with a JSON object with the key "question".\n\nPassage:\n'
)


def pairs_prompt(passage: Column, n: int = 3) -> Column:
    return F.concat(F.lit(PAIRS_PROMPT.format(n=n)), passage)


def abstention_prompt(passage: Column) -> Column:
    return F.concat(F.lit(ABSTENTION_PROMPT), passage)


def gated(pairs: DataFrame) -> DataFrame:
    """Pairs that are long enough and whose question stands alone and is not about the publication."""
    q = F.col("question")
    return pairs.filter(long_enough(q, F.col("answer")) & ~leans_on_passage(q) & ~about_the_document(q)).withColumn("question_type", normal_type(F.col("question_type")))


def gate_report(pairs: DataFrame) -> DataFrame:
    """How many pairs each gate stops, the first that does."""
    q = F.col("question")
    gate = F.when(~long_enough(q, F.col("answer")), "too_short").when(leans_on_passage(q), "leans_on_passage").when(about_the_document(q), "about_the_document").otherwise("passed")
    return pairs.groupBy(gate.alias("gate")).agg(F.count("*").alias("pairs"))


def parsed_pairs(responses: DataFrame, response: str = "raw", keep: list[str] | None = None) -> DataFrame:
    """Gated pairs out of responses: the columns ``keep``, ``pos`` in the array, question, answer, type."""
    kept = keep or []
    wide = responses.select(*kept, F.explode(json_objects(F.col(response))).alias("_o"))
    f = F.col("_o.fields")
    text = {k: strip(F.coalesce(as_text(F.element_at(f, F.lit(k))), F.lit("None" if k == "answer" else ""))) for k in ("question", "answer", "question_type")}
    return gated(wide.select(*kept, F.col("_o.at").alias("pos"), *[v.alias(k) for k, v in text.items()]))


def abstention_pairs(responses: DataFrame, response: str = "raw", keep: list[str] | None = None) -> DataFrame:
    """Pairs with the fixed refusal out of abstention responses whose question passes the gates."""
    kept = keep or []
    q = strip(F.coalesce(as_text(F.element_at(json_object(F.col(response)), F.lit("question"))), F.lit("")))
    got = responses.select(*kept, q.alias("question")).filter((stripped_length(F.col("question")) >= MIN_QUESTION) & ~leans_on_passage(F.col("question")) & ~about_the_document(F.col("question")))
    return got.select(*kept, "question", F.lit(ABSTENTION).alias("answer"), F.lit("unanswerable").alias("question_type"), F.lit(False).alias("answerable"))


def exact_pick(n: int, share: float = ABSTENTION_SHARE, seed: int = SEED) -> list[int]:
    """Row numbers that a seeded draw without replacement picks out of n."""
    if n <= 0 or share <= 0:
        return []
    return sorted(random.Random(seed).sample(range(n), min(n, math.ceil(n * share))))


def pick_exact(df: DataFrame, order: list[Column], share: float = ABSTENTION_SHARE, seed: int = SEED) -> DataFrame:
    """The rows that exact_pick() picks by ``order``. The numbers are drawn on the driver, share * n of them;
    for tables beyond some million rows use pick_by_hash()."""
    numbered = with_ordinal(df, order)
    chosen = exact_pick(numbered.count(), share, seed)
    wanted = df.sparkSession.createDataFrame([(i,) for i in chosen], "ord bigint")
    return numbered.join(broadcast_if_small(wanted), "ord", "left_semi")


def pick_by_hash(df: DataFrame, key: Column, share: float = ABSTENTION_SHARE, seed: int = SEED) -> DataFrame:
    """The ceil(n * share) rows with the least hash of seed and ``key``, ties by key; distributed at any size."""
    mixed = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")).cast("binary"))
    numbered = with_ordinal(df.withColumn("_mix", mixed).withColumn("_key", key.cast("string")), [F.col("_mix"), F.col("_key")], "_ord")
    n = numbered.count()
    return numbered.filter(F.col("_ord") < math.ceil(n * share)).drop("_mix", "_key", "_ord")


def flattened(answered: DataFrame, abstained: DataFrame) -> DataFrame:
    """All pairs in passage order, the abstention pair of a passage after its others: adds ``pair_ord``.

    Both need ``chunk_ord``; ``answered`` also ``pos``.
    """
    both = answered.withColumn("_branch", F.lit(0)).unionByName(abstained.withColumn("_branch", F.lit(1)).withColumn("pos", F.lit(0)), allowMissingColumns=True)
    return with_ordinal(both, [F.col("chunk_ord"), F.col("_branch"), F.col("pos")], "pair_ord").drop("_branch")


def retry_seconds(message: Column, attempt: Column) -> Column:
    """How long to wait after a rate limit: as the message says plus one, 300 at most; else 20 more each time, 120 at most."""
    minutes = F.coalesce(F.regexp_extract(message, RETRY, 1).try_cast("double"), F.lit(0.0))
    seconds = F.regexp_extract(message, RETRY, 2).try_cast("double")
    told = F.when(seconds.isNotNull(), F.least(minutes * 60 + seconds + 1, F.lit(300.0)))
    return F.coalesce(told, F.least(F.lit(20.0) * (attempt + 1), F.lit(120.0)))


def generation_summary(pairs: DataFrame) -> DataFrame:
    """Answerable and unanswerable pairs by type."""
    return pairs.groupBy("question_type").agg(F.count_if("answerable").alias("answerable_pairs"), F.count_if(~F.col("answerable")).alias("unanswerable_pairs"))
