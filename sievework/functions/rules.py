"""The rules on pairs and scores, each written once as a Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sievework.functions.text import or_true, strip, stripped_length
from sievework.schemas import CRITERIA

#: Least total and least score of each criterion.
MIN_SCORE = 4
FLOORS = {"groundedness": 2, "specificity": 1, "completeness": 1}
MIN_QUESTION, MIN_ANSWER = 15, 25
QUESTION_TYPES = ("factual", "definitional", "procedural")
ABSTENTION = "This information is not available in the provided document."
NOT_ASSESSED = "judge call failed - not assessed"
UNGROUNDED = "UNGROUNDED"
#: Reasons where the judge gave none.
NOT_TRACEABLE = "claims not traceable to passage"
NOT_FIXED, DOES_ANSWER, OFF_TOPIC = "answer is not the fixed abstention string", "passage does answer the question", "question is off-topic or implausible"

#: Questions that lean on their passage, and questions about the publication.
CONTEXT_DEPENDENT = (
    r"\b(this|the)\s+(passage|text|document|excerpt|section|article|guideline\s+text)\b"
    r"|\baccording to the (passage|text|document|above)\b"
    r"|\bthe above\b|\bmentioned above\b"
)
ABOUT_THE_DOCUMENT = (
    r"\b(disclaimer|copyright|ISBN|licence|license|publisher|book-?orders)\b"
    r"|\b(dotted|dashed)\b.{0,20}\blines?\b"
    r"|\bborder lines\b|\blegal status\b|\bfrontiers\b"
    r"|\binitial capital letters\b|\bthird-party\b"
    r"|\bfigure \d|\btable \d|\bpage \d|\breference list\b"
    r"|\b(which|what) page\b|\bpage number\b|\bcontents list\b"
    r"|\btable of contents\b|\bsection (start|begin)\b"
    r"|\blisted in the contents\b|\bwhich section\b"
)


def matches(c: Column, pattern: str) -> Column:
    """Case-blind search; '.' stops at line feeds only."""
    return F.coalesce(c, F.lit("")).rlike(f"(?iud){pattern}")


def long_enough(question: Column, answer: Column) -> Column:
    return (stripped_length(question) >= MIN_QUESTION) & (stripped_length(answer) >= MIN_ANSWER)


def leans_on_passage(question: Column) -> Column:
    return matches(question, CONTEXT_DEPENDENT)


def about_the_document(question: Column) -> Column:
    return matches(question, ABOUT_THE_DOCUMENT)


def normal_type(c: Column) -> Column:
    """One of the three types; anything else is factual."""
    low = F.lower(strip(F.coalesce(c, F.lit(""))))
    return F.when(low.isin(*QUESTION_TYPES), low).otherwise("factual")


def total_score(scores: Column) -> Column:
    """Sum of the scores that are there; null where there is none at all."""
    some = F.coalesce(*[scores[k] for k in CRITERIA])
    return F.when(some.isNotNull(), sum((F.coalesce(scores[k], F.lit(0)) for k in CRITERIA), F.lit(0)))


def keep_expr(scores: Column, min_score: Column | int = MIN_SCORE, floors: dict[str, int] | None = None) -> Column:
    """The keep rule: some scores, their sum at least ``min_score``, and every floor met (a missing score is 0).

    ``floors={}`` leaves the floors out. Never null.
    """
    least = FLOORS if floors is None else floors
    total = total_score(scores)
    met = F.lit(True)
    for name, floor in least.items():
        met = met & (F.coalesce(scores[name], F.lit(0)) >= floor)
    return F.coalesce((total >= min_score) & met, F.lit(False))


def outcome(scores: Column, min_score: int = MIN_SCORE, floors: dict[str, int] | None = None) -> Column:
    """kept, rejected, or not_assessed where the judge gave nothing."""
    return F.when(total_score(scores).isNull(), "not_assessed").when(keep_expr(scores, min_score, floors), "kept").otherwise("rejected")


def reject_reason(scores: Column, said: Column, min_score: int = MIN_SCORE, floors: dict[str, int] | None = None) -> Column:
    """Why a pair was not kept; null for a kept one. ``said`` is the judge's reason, blank or null if none.

    First groundedness under its floor, then the other floors, then the total.
    """
    least = FLOORS if floors is None else floors
    reason = F.nullif(strip(F.coalesce(said, F.lit(""))), F.lit(""))
    s = {k: F.coalesce(scores[k], F.lit(0)) for k in CRITERIA}
    ground = F.concat(F.lit(f"{UNGROUNDED} (groundedness "), s["groundedness"].cast("string"), F.lit("/2): "), F.coalesce(reason, F.lit(NOT_TRACEABLE)))
    below = F.array_compact(F.array(*[F.when(s[k] < f, F.concat(F.lit(f"{k} "), s[k].cast("string"), F.lit(f"/{f}"))) for k, f in least.items() if k != "groundedness"] or [F.lit(None).cast("string")]))
    floor_text = F.concat(F.lit("below floor on "), F.array_join(below, ", "), F.coalesce(F.concat(F.lit(": "), reason), F.lit("")))
    total = total_score(scores)
    short = F.coalesce(reason, F.concat(F.lit("scored "), total.cast("string"), F.lit(f"/6, below threshold {min_score}")))
    ungrounded = s["groundedness"] < least["groundedness"] if "groundedness" in least else F.lit(False)
    return F.when(total.isNull(), NOT_ASSESSED).when(keep_expr(scores, min_score, floors), None).when(ungrounded, ground).when(F.size(below) > 0, floor_text).otherwise(short)


def clamp_score(value: Column) -> Column:
    """A score given as text, as JSON prints it, in 0 to 2; 0 if it is no number.

    "2.9" without quotes counts as 2, in quotes it is no whole number and counts as 0.
    """
    quoted = value.startswith('"')
    inner = F.regexp_replace(value, '^"|"$', "")
    number = F.when(quoted, F.when(strip(inner).rlike(r"^[+-]?\d+$"), strip(inner).try_cast("int"))).when(value == "true", 1).otherwise(value.try_cast("double").try_cast("int"))
    return F.greatest(F.lit(0), F.least(F.lit(2), F.coalesce(number, F.lit(0))))


def abstention_outcome(check: Column) -> Column:
    """passed, failed, or not_assessed where any of the three answers is missing."""
    a, b, c = check["unanswerable"], check["plausible"], check["abstention_answer"]
    return F.when(a.isNull() | b.isNull() | c.isNull(), "not_assessed").when(a & b & c, "passed").otherwise("failed")


def abstention_note(check: Column, said: Column | None = None) -> Column:
    """What failed first: the fixed answer, then being unanswerable, then being plausible.

    For the last two the judge's own reason counts, if it gave one.
    """
    failed = abstention_outcome(check) == "failed"
    reason = F.lit(None).cast("string") if said is None else F.nullif(strip(F.coalesce(said, F.lit(""))), F.lit(""))
    return F.when(failed, F.when(~check["abstention_answer"], NOT_FIXED).when(~check["unanswerable"], F.coalesce(reason, F.lit(DOES_ANSWER))).otherwise(F.coalesce(reason, F.lit(OFF_TOPIC))))
