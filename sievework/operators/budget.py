"""What a run costs, how far it is, and how long it will take."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.operators.ordinals import with_running_total

#: Calibrated tokens, limits and seconds.
GENERATION, ABSTENTION, JUDGE, JUDGE_PAIR = 860, 680, 450, 110
TOKENS_A_DAY, REQUESTS_A_DAY, TOKENS_A_MINUTE = 200_000, 1_000, 8_000
STARTUP, PAGE_SECONDS, GENERATE_SECONDS, JUDGE_SECONDS, DEDUP_SECONDS, EXPORT_SECONDS = 35.0, 1.6, 5.4, 4.8, 12.0, 4.0
STAGES = ("ingest", "generate", "validate", "deduplicate", "export")
STAGE_WEIGHTS = (0.03, 0.45, 0.45, 0.04, 0.03)
STALE_AFTER = 420


def run_cost(chunks: Column, questions: int = 3) -> dict[str, Column]:
    """Estimates for a number of chunks, as columns by name. A tenth of the chunks also abstains, in two calls each."""
    generation = F.floor(chunks * GENERATION + chunks * F.lit(0.1) * ABSTENTION).cast("bigint")
    judge = (chunks * (JUDGE + JUDGE_PAIR * questions)).cast("bigint")
    total = generation + judge
    return {
        "estimated_pairs": (chunks * questions).cast("bigint"), "generation_tokens": generation, "judge_tokens": judge, "total_tokens": total,
        "requests": F.floor(chunks * 2 + chunks * F.lit(0.1) * 2).cast("bigint"),
        "over_budget": total > TOKENS_A_DAY,
        "daily_token_share": F.round(total / TOKENS_A_DAY * 100, 1),
        "least_minutes": F.round(total / TOKENS_A_MINUTE + F.lit(STARTUP / 60), 1),
    }


def affordable_chunks(tokens: Column, questions: int = 3) -> Column:
    """How many chunks so many tokens pay for."""
    return F.greatest(F.lit(0), F.floor(tokens / F.lit(GENERATION + ABSTENTION * 0.1 + JUDGE + JUDGE_PAIR * questions))).cast("bigint")


def running_spend(calls: DataFrame, order: list[Column], tokens: Column, budget: int) -> DataFrame:
    """Add ``spent`` so far and whether that is ``within`` the budget."""
    return with_running_total(calls, order, tokens, "spent").withColumn("within", F.col("spent") <= budget)


def plan_seconds(chunks: Column, pages: Column) -> dict[str, Column]:
    """Planned seconds of every stage and in all."""
    parts = {"ingest": F.lit(STARTUP) + pages * F.lit(PAGE_SECONDS), "generate": chunks * F.lit(GENERATE_SECONDS), "validate": chunks * F.lit(JUDGE_SECONDS), "deduplicate": F.lit(DEDUP_SECONDS), "export": F.lit(EXPORT_SECONDS)}
    return parts | {"total": sum(parts.values(), F.lit(0.0))}


def overall_percent(plan: dict[str, Column], stage: str, current: Column, total: Column, done: Column | None = None) -> Column:
    """How far a run is: planned seconds of stages passed and of this one's share; by weights without a plan."""
    at = STAGES.index(stage)
    within = F.when(total > 0, current / total).otherwise(F.lit(0.0))
    before = sum((plan[s] for s in STAGES[:at]), F.lit(0.0))
    planned = (before + within * plan[stage]) / plan["total"] * 100
    weighed = (F.lit(sum(STAGE_WEIGHTS[:at])) + within * STAGE_WEIGHTS[at]) * 100
    value = F.round(F.least(F.lit(100.0), F.when(plan["total"] > 0, planned).otherwise(weighed)), 1)
    return value if done is None else F.when(done, F.lit(100.0)).otherwise(value)


def seconds_left(plan: dict[str, Column], stage: str, current: Column, total: Column, elapsed: Column) -> Column:
    """The plan and the run's own speed, the latter weighing more as the run goes on."""
    at = STAGES.index(stage)
    spent = sum((plan[s] for s in STAGES[:at]), F.lit(0.0)) + F.when(total > 0, current / total).otherwise(F.lit(0.0)) * plan[stage]
    part = spent / plan["total"]
    blended = plan["total"] * (1 - part) + elapsed / F.nullif(part, F.lit(0.0)) * part
    return F.when(spent <= 1, F.greatest(plan["total"] - elapsed, F.lit(0.0))).otherwise(F.greatest(blended - elapsed, F.lit(0.0)))


def early_percent(plan: dict[str, Column], reported: Column, elapsed: Column) -> Column:
    """A bar for the time before the first page is read: at most nine tenths of the share of that stage."""
    return F.round(F.least(elapsed / plan["ingest"], F.lit(0.9)) * plan["ingest"] / plan["total"] * 100, 1) if reported is None else F.coalesce(F.nullif(reported, F.lit(0.0)), early_percent(plan, None, elapsed))


def stale(running: Column, age_seconds: Column) -> Column:
    return running & (age_seconds > STALE_AFTER)
