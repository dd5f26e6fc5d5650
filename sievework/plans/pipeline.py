"""The whole way from pages to a deduplicated dataset, with models plugged in."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.functions.model_json import has_array, has_checks, has_object, has_objects
from sievework.functions.rules import FLOORS, MIN_SCORE
from sievework.operators.checkpoints import fingerprint
from sievework.operators.dedup import dedup_text, greedy_dedup, hashed_vector
from sievework.operators.generation import abstention_pairs, abstention_prompt, flattened, pairs_prompt, parsed_pairs, pick_by_hash
from sievework.operators.ingest import chunk_key, drop_boilerplate, evenly_spaced, keep_chunks, keep_pages, recursive_chunks
from sievework.operators.judging import abstention_checks, aligned_scores, batch_prompt, graded, passage_groups, single_scores, unjudged
from sievework.operators.ordinals import with_ordinal
from sievework.session import cut
from sievework.sources.external import Client, ask_missing


@dataclass
class Settings:
    max_chunks: int = 0
    questions: int = 3
    min_score: int = MIN_SCORE
    floors: dict[str, int] = field(default_factory=lambda: dict(FLOORS))
    threshold: float = 0.90

    def name(self) -> str:
        return fingerprint(**self.__dict__)


@dataclass
class Run:
    chunks: DataFrame
    graded: DataFrame
    final: DataFrame
    duplicates: DataFrame


def run(pages: DataFrame, make_generator, make_abstainer, make_judge, make_checker, settings: Settings | None = None, saved: str | None = None) -> Run:
    """Chunk, generate, judge and deduplicate. Each ``make_`` argument makes a Client in a task.

    Every response is written before it is used, so that no later action asks a model again; in the
    folder ``saved``, if given, for later runs with these settings too. Calls that fail or say
    nothing usable are made again, and pairs of a passage that got no score at all are judged one by one.
    """
    s = settings or Settings()
    kept_at = lambda stage: saved and f"{saved.rstrip('/')}/{s.name()}/{stage}"
    chunks = drop_boilerplate(keep_chunks(recursive_chunks(keep_pages(pages), ["source_file", "page"])))
    order = [F.col("source_file"), F.col("page"), F.col("start_index")]
    chunks = cut(evenly_spaced(chunks, order, s.max_chunks).withColumnRenamed("ord", "chunk_ord").withColumn("key", chunk_key(*order)))

    said = ask_missing(chunks.select("key", pairs_prompt(F.col("page_content"), s.questions).alias("prompt")), make_generator, kept_at("generated"), usable=has_array)
    keep = ["chunk_ord", "source_file", "page", "page_content"]
    answered = parsed_pairs(chunks.join(said, "key"), keep=keep).withColumn("answerable", F.lit(True))
    picked = cut(pick_by_hash(chunks, F.col("key")))
    to_abstain = picked.select("key", abstention_prompt(F.col("page_content")).alias("prompt"))
    asked = ask_missing(to_abstain, make_abstainer, kept_at("abstained"), usable=has_object)
    # questions that don't pass the gates get their second call here
    first = cut(abstention_pairs(picked.join(asked, "key"), keep=["key", *keep]))
    gated = to_abstain.join(asked.filter("raw is not null"), "key", "left_semi").join(first, "key", "left_anti")
    again = ask_missing(gated, make_abstainer, kept_at("abstained_again"), usable=has_object, retries=0)
    abstained = first.drop("key").unionByName(abstention_pairs(picked.join(again, "key"), keep=keep))
    pairs = flattened(answered, abstained).withColumnsRenamed({"source_file": "source", "page_content": "chunk_text"}).withColumn("page", F.col("page") + 1)
    pairs = cut(pairs)

    groups = cut(passage_groups(pairs.filter("answerable")).withColumn("key", F.concat_ws("|", F.sha2("passage", 256), "batch_no")))
    judged = ask_missing(groups.select("key", batch_prompt(F.col("passage"), F.col("pairs")).alias("prompt")), make_judge, kept_at("judged"), usable=has_objects)
    scores = cut(aligned_scores(groups.join(judged, "key")))
    alone = cut(unjudged(groups, scores))
    singly = ask_missing(alone.select("key", "prompt").distinct(), make_judge, kept_at("judged_singly"), usable=lambda t: has_objects(t) or has_object(t))
    scores = scores.unionByName(single_scores(alone.join(singly, "key")))
    checks_of = pairs.filter("not answerable").select("pair_ord", F.concat(F.lit("Does the passage leave the question open, and is the question plausible?\n\n"), F.substring("chunk_text", 1, 800), F.lit("\n\nQuestion: "), F.col("question")).alias("prompt")).withColumn("key", F.sha2("prompt", 256))
    checked = ask_missing(checks_of.select("key", "prompt").distinct(), make_checker, kept_at("checked"), usable=has_checks)
    checks = abstention_checks(checks_of.join(checked, "key"), keep=["pair_ord"])
    result = cut(graded(pairs.join(scores, "pair_ord", "left").join(checks, "pair_ord", "left"), s.min_score, s.floors))

    kept = cut(with_ordinal(result.filter("outcome = 'kept'").drop("ord"), [F.col("pair_ord")]).withColumn("vector", hashed_vector(dedup_text(F.col("question"), F.col("answer")))))
    final, duplicates = greedy_dedup(kept, "ord", "vector", s.threshold)
    return Run(chunks, result, final.drop("vector"), duplicates)


__all__ = ["Client", "Run", "Settings", "run"]
