"""Session, shared work folder and bounded broadcasts."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows and bytes up to which a side is broadcast at all; beyond, callers shuffle.
BROADCAST_ROWS, BROADCAST_BYTES = 500_000, 8_000_000
#: Nodes of a plan that are worth writing before it is run twice.
_WORK = re.compile(r"\b(?:Aggregate|Join|Sort|Window|Generate|Repartition\w*|Distinct|MapIn\w+|FlatMap\w+|Union)\b")


def local_session(cpus: int | str = 8, **extra: str) -> SparkSession:
    """A session for one machine, for tests and the bench."""
    conf = {
        "spark.master": f"local[{cpus}]",
        "spark.sql.shuffle.partitions": str(cpus),
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        "spark.driver.host": "127.0.0.1",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    } | {k.replace("__", "."): v for k, v in extra.items()}
    session = SparkSession.builder.config(map=conf).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One table of a data folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def work_folder(spark: SparkSession) -> str:
    """The folder shared by all executors, from ``spark.checkpoint.dir``.

    Only a local session may go without that setting; it gets a temporary
    folder, as one machine runs everything.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="sievework-")
        sc.setCheckpointDir(root)
    return f"{root.rstrip('/')}/sievework-{sc.applicationId}"


_cleaned: set[str] = set()


def _clean_at_exit(spark: SparkSession, folder: str) -> None:
    if folder in _cleaned:
        return
    _cleaned.add(folder)
    jvm, jsc = spark._jvm, spark.sparkContext._jsc

    def clean() -> None:
        try:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(jsc.hadoopConfiguration()).delete(path, True)
        except Exception:
            pass  # the JVM may have gone first

    atexit.register(clean)


def cut(df: DataFrame, codec: str | None = None, scope: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage, so that later passes neither recompute it nor depend on
    any executor. The folder goes when the application ends, or with the ``work_scope`` around,
    or with that which ``scope`` names.
    """
    spark = df.sparkSession
    folder = work_folder(spark)
    _clean_at_exit(spark, folder)
    path = f"{folder}/{_scope.get() if scope is None else scope}{uuid.uuid4().hex}"
    df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def clear_work(spark: SparkSession) -> None:
    """Delete all that was ``cut`` so far; results built on it can no longer be read."""
    _delete(spark, work_folder(spark))


_scope: ContextVar[str] = ContextVar("scope", default="")


@contextmanager
def work_scope(spark: SparkSession) -> Iterator[str]:
    """Delete at the end what is ``cut`` inside; results must be written, collected or cut in the scope outside, whose name is given, before. Scopes may be nested."""
    outer = _scope.get()
    token = _scope.set(f"{outer}{uuid.uuid4().hex}/")
    try:
        yield outer
    finally:
        own = _scope.get()
        _scope.reset(token)
        _delete(spark, f"{work_folder(spark)}/{own}")


def _bytes(c: Column, kind: T.DataType) -> Column:
    """About how many bytes a value takes in a joined row."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)) + 16
    if isinstance(kind, T.ArrayType):
        each = F.aggregate(c, F.lit(0).cast("bigint"), lambda n, x: n + F.coalesce(F.octet_length(x), F.lit(0)) + 16) if isinstance(kind.elementType, (T.StringType, T.BinaryType)) else F.size(c) * 8
        return F.greatest(F.coalesce(each, F.lit(0)), F.lit(0)) + 24
    return F.lit(8)


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_ROWS, most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast after counting that it has at most ``limit`` rows and ``most_bytes`` bytes.

    Larger sides come back unmarked and are joined by shuffle. A plan that does more than read,
    filter and project is written first, so that it is not run once for the count and once again.
    """
    if _WORK.search(df._jdf.queryExecution().optimizedPlan().toString()):
        df = cut(df)
    width = sum((_bytes(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields), F.lit(16)).cast("bigint")
    n, size = df.agg(F.count("*"), F.coalesce(F.sum(width), F.lit(0))).first()
    return F.broadcast(df) if n <= limit and size <= most_bytes else df


def _is_marked(df: DataFrame) -> bool:
    return df._jdf.queryExecution().analyzed().nodeName() == "ResolvedHint"


def skew_join(big: DataFrame, small: DataFrame, on: list[str], how: str = "inner", salts: int = 32, hot_rows: int = 200_000, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Equi-join, inner or left, whose hot keys are spread over ``salts`` tasks.

    ``big`` should be a table that is cheap to read again. If ``small`` is small it
    is broadcast. Otherwise keys with more than ``hot_rows`` rows in ``big`` (at most
    rows / hot_rows keys) are joined under a salt, on whose every value the rows of
    ``small`` with these keys are repeated; all other rows join as usual.
    """
    small = broadcast_if_small(small, broadcast_rows)
    if _is_marked(small):
        return big.join(small, on, how)
    hot = cut(big.groupBy(*on).count().filter(F.col("count") > hot_rows).select(*on))
    if hot.isEmpty():
        return big.join(small, on, how)
    few = F.broadcast(hot) if hot.count() <= 100_000 else hot
    salted = big.join(few, on, "left_semi").withColumn("_salt", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in big.columns]), F.lit(salts)).cast("int"))
    repeated = small.join(few, on, "left_semi").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    rest = big.join(few, on, "left_anti").join(small.join(few, on, "left_anti"), on, how)
    return rest.unionByName(salted.join(repeated, [*on, "_salt"], how).drop("_salt"))
