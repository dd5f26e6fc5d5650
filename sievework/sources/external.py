"""Models outside: anything that maps prompts to responses, run once and kept.

A call is expensive and a task may run twice, so responses are written to a table keyed by
fingerprint and key, and only missing ones are asked for. Calls that fail or say nothing usable
are made again.
"""

from __future__ import annotations

import re
import threading
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.operators.generation import RETRY
from sievework.session import cut

#: Seconds before a call that failed is made again.
PAUSE = 2.0
#: A client: made once a task, then called with a prompt; it may raise.
Client = Callable[[str], str]


class TokenBucket:
    """Tokens that refill evenly up to a minute's worth; ask() waits until there are enough."""

    def __init__(self, tokens_a_minute: float, share: float = 0.9, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep) -> None:
        self.capacity = tokens_a_minute * share
        self.level, self.clock, self.sleep, self.lock = self.capacity, clock, sleep, threading.Lock()
        self.at = clock()

    def ask(self, tokens: float) -> None:
        need = min(tokens, self.capacity)
        while True:
            with self.lock:
                now = self.clock()
                self.level, self.at = min(self.capacity, self.level + (now - self.at) * self.capacity / 60), now
                if self.level >= need:
                    self.level -= need
                    return
                wait = (need - self.level) * 60 / self.capacity
            self.sleep(wait)

    def give_back(self, tokens: float) -> None:
        with self.lock:
            self.level = min(self.capacity, self.level + tokens)


class Meter:
    """Tokens spent by stage, and whether what remains is reserved."""

    def __init__(self, budget: int, reserve: int = 3_000) -> None:
        self.budget, self.reserve, self.by_stage, self.requests, self.lock = budget, reserve, {}, 0, threading.Lock()

    def record(self, stage: str, tokens: int) -> None:
        with self.lock:
            self.by_stage[stage] = self.by_stage.get(stage, 0) + tokens
            self.requests += 1

    def exhausted(self, keep_share: float = 0.0) -> bool:
        """``keep_share`` of the budget is left for later stages."""
        return self.budget - sum(self.by_stage.values()) <= max(self.reserve, self.budget * keep_share)


def retry_wait(message: str, attempt: int) -> float:
    """generation.retry_seconds() of one message."""
    m = re.search(RETRY, message)
    try:
        return min(float(m[1] or 0) * 60 + float(m[2]) + 1, 300.0)
    except (TypeError, ValueError):
        return min(20.0 * (attempt + 1), 120.0)


def is_rate_limit(error: Exception) -> bool:
    return "RateLimit" in type(error).__name__ or "429" in str(error)


def ask_model(prompts: DataFrame, make_client: Callable[[], Client], key: str = "key", prompt: str = "prompt", *, tasks: int = 4, tokens_a_minute: float | None = None, usable: Callable[[str], bool] | None = None, retries: int = 1) -> DataFrame:
    """``key, raw`` with null where all of 1 + ``retries`` calls failed or said nothing ``usable``.

    After a rate limit the task waits as long as the message says, else PAUSE seconds.
    At most ``tasks`` calls run at a time, sharing the rate.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = make_client()
        bucket = TokenBucket(tokens_a_minute / tasks) if tokens_a_minute else None

        def said(p: str) -> str | None:
            for attempt in range(retries + 1):
                wait = PAUSE
                if bucket:
                    bucket.ask(len(p) / 4)
                try:
                    got = client(p)
                    if got is not None and (usable is None or usable(got)):
                        return got
                except Exception as error:
                    if is_rate_limit(error):
                        wait = retry_wait(str(error), attempt)
                if attempt < retries:
                    time.sleep(wait)
            return None

        for pdf in batches:
            yield pd.DataFrame({key: pdf[key], "raw": [said(p) for p in pdf[prompt]]})

    return prompts.repartition(tasks).mapInPandas(run, f"{key} string, raw string")


def ask_missing(prompts: DataFrame, make_client: Callable[[], Client], folder: str | None = None, **how) -> DataFrame:
    """``key, raw`` for ``key, prompt``, written before it is used.

    With a ``folder``, responses that it has to the same key and prompt are taken from it, only the
    others are asked for, and what they bring is added to it.
    """
    if folder is None:
        return cut(ask_model(prompts, make_client, **how))
    spark = prompts.sparkSession
    # one key of both, so that a changed prompt is asked anew
    both = cut(prompts.select(F.col("key").alias("own"), F.concat_ws("|", "key", F.sha2("prompt", 256)).alias("key"), "prompt"))
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    read = lambda: spark.read.schema("key string, raw string").parquet(folder)
    there = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
    fresh = cut(ask_model(missing(both, read()) if there else both, make_client, **how))
    fresh.filter("raw is not null").write.mode("append").parquet(folder)
    return cut(replay(both, read().dropDuplicates(["key"])).join(both.select("key", "own"), "key").select(F.col("own").alias("key"), "raw"))


def replay(prompts: DataFrame, saved: DataFrame, key: str = "key") -> DataFrame:
    """Responses that were saved, null where there is none."""
    return prompts.select(key).join(saved.select(key, "raw"), key, "left")


def missing(prompts: DataFrame, saved: DataFrame, key: str = "key") -> DataFrame:
    """Prompts without a saved response."""
    return prompts.join(saved.filter(F.col("raw").isNotNull()).select(key), key, "left_anti")


def embed(df: DataFrame, text: str, make_model: Callable[[], Callable[[list[str]], list]], name: str = "vector") -> DataFrame:
    """Add vectors of a model that is made once a task."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = make_model()
        for texts in batches:
            yield pd.Series([[float(x) for x in v] for v in model(texts.fillna("").tolist())])

    # the hint of iterators is read from the annotations as objects
    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return df.withColumn(name, F.pandas_udf(run, "array<float>")(text))
