import random

import pytest
from pyspark.sql import functions as F

from sievework.session import broadcast_if_small, clear_work, cut, skew_join, work_folder


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("rows,hot", [(10**6, 5), (0, 5), (0, 10**6)])
def test_skew_join_is_a_join(spark, how, rows, hot):
    r = random.Random(1)
    big = spark.createDataFrame([(r.choice([0] * 40 + list(range(20)) + [None]), i) for i in range(400)], "k int, x int")
    small = spark.createDataFrame([(k, y) for k in range(0, 16) for y in range(k % 3)] + [(None, 9)], "k int, y int")
    got = skew_join(cut(big), cut(small), ["k"], how, salts=4, hot_rows=hot, broadcast_rows=rows)
    assert sorted(map(str, got.select("k", "x", "y").collect())) == sorted(map(str, big.join(small, "k", how).select("k", "x", "y").collect()))


def test_broadcast_only_if_small(spark):
    df = spark.range(100)
    assert broadcast_if_small(df, 99) is df and broadcast_if_small(df, 100) is not df


def test_cut_keeps_rows_and_types(spark):
    df = spark.createDataFrame([(1, None, [1.5]), (None, "é", None)], "a int, b string, c array<double>")
    got = cut(df)
    assert got.dtypes == df.dtypes and sorted(map(str, got.collect())) == sorted(map(str, df.collect()))
    empty = cut(df.filter(F.lit(False)))
    assert empty.count() == 0 and empty.dtypes == df.dtypes
    assert work_folder(spark) == work_folder(spark)


def test_clear_work(spark):
    got = cut(spark.range(3))
    clear_work(spark)
    with pytest.raises(Exception):
        spark.read.parquet(got.inputFiles()[0])
    assert cut(spark.range(3)).count() == 3


def test_scopes_delete_their_tables(spark):
    from pathlib import Path

    from sievework.session import work_folder, work_scope

    keep = cut(spark.range(3))
    with work_scope(spark):
        inner = cut(spark.range(5))
        files = inner.inputFiles()
        assert inner.count() == 5
    assert not any(Path(f.removeprefix("file://").removeprefix("file:")).exists() for f in files)
    assert keep.count() == 3 and all(work_folder(spark).removeprefix("file:") in f for f in files)


def test_broadcasts_are_bounded_by_bytes(spark):
    from pyspark.sql import functions as F

    from sievework.session import _is_marked, broadcast_if_small

    wide = spark.range(100).withColumn("s", F.repeat(F.lit("x"), 1000)).withColumn("l", F.split(F.repeat(F.lit("a "), 50), " "))
    assert _is_marked(broadcast_if_small(wide)) and not _is_marked(broadcast_if_small(wide, most_bytes=50_000)) and not _is_marked(broadcast_if_small(wide, limit=99))
    assert _is_marked(broadcast_if_small(spark.range(0)))
