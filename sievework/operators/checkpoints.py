"""The append-only log of finished calls, and resuming from it."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def fingerprint(**settings: object) -> str:
    """What names the settings of a run: 16 hex digits of a hash of its sorted JSON."""
    return hashlib.sha256(json.dumps(settings, sort_keys=True).encode()).hexdigest()[:16]


def broken(payload: Column) -> Column:
    """The payload is missing or no JSON."""
    return F.try_parse_json(payload).isNull()


def latest(log: DataFrame, order: list[Column], run: str | None = None, *, stop_at_broken: bool = False) -> DataFrame:
    """The last whole record of every fingerprint and key.

    Broken records are skipped or, with ``stop_at_broken``, end the log at the first of them by
    the first column of ``order``. A key with very many records is only aggregated.
    """
    rows = log if run is None else log.filter(F.col("fingerprint") == run)
    good = rows.filter(~broken(F.col("payload")))
    if stop_at_broken:
        first = rows.filter(broken(F.col("payload"))).agg(F.min(order[0]).alias("_stop"))
        good = good.crossJoin(F.broadcast(first)).filter(F.col("_stop").isNull() | (order[0] < F.col("_stop"))).drop("_stop")  # one row on the right
    last = F.max(F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)], "payload")).alias("m")
    return good.groupBy("fingerprint", F.col("chunk_key").alias("key")).agg(last).select("fingerprint", "key", F.col("m.payload").alias("payload"))


def open_work(work: DataFrame, done: DataFrame, key: str = "key") -> DataFrame:
    """Work whose key is not in the log."""
    return work.join(done.select(F.col("key").alias(key)).distinct(), key, "left_anti")


def summary(log: DataFrame) -> DataFrame:
    """Per fingerprint: records, broken ones and distinct keys."""
    return log.groupBy("fingerprint").agg(F.count("*").alias("records"), F.count_if(broken(F.col("payload"))).alias("broken"), F.countDistinct("chunk_key").alias("keys"))


def run_cost(done: DataFrame) -> DataFrame:
    """Per fingerprint: calls, attempts, tokens and pairs that the payloads tell."""
    n = lambda k: F.coalesce(F.sum(F.get_json_object("payload", f"$.{k}").try_cast("bigint")), F.lit(0)).alias(k)
    return done.groupBy("fingerprint").agg(F.count("*").alias("calls"), n("tokens"), n("pairs"), n("attempt"))


def clear(spark: SparkSession, *paths: str) -> None:
    """Delete logs; ones that are not there are no error."""
    for p in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(p)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def append(spark, path: str, run: str, records: DataFrame) -> None:
    """Add records (key, payload) of a run to a log kept as Parquet; repeats are sorted out when it is read."""
    records.select(F.lit(run).alias("fingerprint"), F.col("key").alias("chunk_key"), "payload", F.current_timestamp().alias("appended_at")).write.mode("append").parquet(path)
