from collections import Counter
from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sievework.functions.text import source_name
from sievework.llm.capping import cap_contributors
from sievework.llm.target_sample import allocate, target_sample

CELLS = "plan_id int, cell_id int, sample_pct int, kind string, target_pct int, min_rows int"


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(0, 9), st.integers(0, 80)), min_size=1, max_size=8), st.integers(0, 300))
def test_allocate_keeps_bounds_and_total(cells, total):
    weights, floors, available = map(list, zip(*cells))
    quota = allocate(total, weights, floors, available)
    low = [min(f, a) for f, a in zip(floors, available)]
    assert all(lo <= q <= a for lo, q, a in zip(low, quota, available))
    reachable = sum(a if w else lo for w, lo, a in zip(weights, low, available))
    if sum(low) <= total <= reachable:
        assert sum(quota) == total


def test_allocate_is_largest_remainder_without_bounds():
    assert allocate(10, [1, 1, 1], [0] * 3, [100] * 3) == [4, 3, 3]
    assert allocate(100, [40, 35, 25], [0] * 3, [1000] * 3) == [40, 35, 25]
    assert allocate(100, [40, 35, 25], [0] * 3, [10, 1000, 1000]) == [10, 53, 37]


def _rows(spark, n=400):
    rows = [(i, "a" if i % 3 else "b", datetime(2025, 1, 1), "x") for i in range(n)]
    rows += [(i, "a" if i % 3 else "b", datetime(2025, 1, 2), "x") for i in range(50)]  # delivered again
    rows += [(None, "a", None, "x"), (n, None, datetime(2025, 1, 1), None), (n + 1, "other", None, None)]
    return spark.createDataFrame(rows, "id bigint, kind string, at timestamp, available string")


def test_target_sample(spark):
    cells = spark.createDataFrame([(1, 10, 50, "a", 50, 5), (1, 11, 50, "b", 50, 5), (2, 20, 100, "b", 90, 5), (2, 21, 10, "none", 5, 2), (2, 22, None, "a", None, None)], CELLS)
    got = target_sample(_rows(spark), "id", {"kind": F.col("kind")}, cells, delivered=F.col("at"))
    report = {r.cell_id: r for r in got.report.collect()}
    n = 402
    counts = {"a": sum(1 for i in range(400) if i % 3), "b": sum(1 for i in range(400) if not i % 3)}
    assert report[10].available == counts["a"] and report[11].available == counts["b"]
    for c, (have, pct, sample, least) in {10: (counts["a"], 50, 50, 5), 11: (counts["b"], 50, 50, 5), 20: (counts["b"], 90, 100, 5), 21: (0, 5, 10, 2), 22: (counts["a"], 0, 0, 0)}.items():
        assert report[c].unmet == (have * 10000 < pct * sample * n or have < least)
    assert report[21].shortfall == 3 and report[10].shortfall == 0 and abs(report[10].share - 0.5) < 0.01
    chosen = got.sample.collect()
    assert Counter(r.cell_id for r in chosen) == {c: r.quota for c, r in report.items() if r.quota}
    assert len({(r.plan_id, r.cell_id, r.id) for r in chosen}) == len(chosen)
    # the smallest hashes, at any partitioning
    want = _rows(spark).filter("kind = 'a' and id is not null").select("id").distinct().orderBy(F.xxhash64(F.lit(42), F.col("id")), "id").limit(report[10].quota)
    assert {r.id for r in chosen if r.cell_id == 10} == {r.id for r in want.collect()}
    again = target_sample(_rows(spark).repartition(17), "id", {"kind": F.col("kind")}, cells, delivered=F.col("at"))
    assert set(map(tuple, again.sample.collect())) == set(map(tuple, chosen))


def test_target_sample_of_nothing(spark):
    cells = spark.createDataFrame([(1, 10, 50, "a", 50, 5), (1, 11, 50, "b", 50, 0)], CELLS)
    got = target_sample(_rows(spark).limit(0), "id", {"kind": F.col("kind")}, cells)
    assert {r.cell_id: (r.quota, r.unmet) for r in got.report.collect()} == {10: (0, True), 11: (0, False)}
    assert got.sample.count() == 0
    assert target_sample(_rows(spark), "id", {"kind": F.col("kind")}, cells.limit(0)).report.count() == 0


def _dropped(rows, allowed):
    by, latest = {}, {}
    for i, who, score, at in rows:
        if i is not None and (i not in latest or at > latest[i][2]):
            latest[i] = (who, score, at)
    for i, (who, score, _) in latest.items():
        who = (who or "").replace("\\", "/").rsplit("/", 1)[-1].strip(" \t").lower()
        if who:
            by.setdefault(who, []).append((score is None, -(score or 0), i))
    return {x[2] for v in by.values() for x in sorted(v)[allowed:]}


@pytest.mark.parametrize("share,most", [(50, None), (None, 7), (None, 0)])
def test_cap_contributors(spark, share, most):
    import random

    r = random.Random(5)
    at = datetime(2025, 1, 1)
    names = ["hot.pdf"] * 30 + ["up/Hot.PDF ", "C:\\x\\hot.pdf", None, " ", "b.md", "c.md"]
    rows = [(r.choice([1, -1, 2**40]) * i, r.choice(names), r.choice([None, 0, 3, 3, 6, -2]), at) for i in range(1, 900)]
    rows += rows[:40] + [(None, "hot.pdf", 1, at)]
    df = spark.createDataFrame(rows, "pair_id bigint, source string, score int, at timestamp").withColumn("id", F.lit("clash")).withColumn("n", F.lit(1))
    got = cap_contributors(df, "pair_id", source_name(F.col("source")), F.col("score"), delivered=F.col("at"), share_of=share, max_rows=most)
    allowed = len({x[0] for x in rows if x[0] is not None}) // share if share else most
    assert got.allowed == allowed
    dropped = [x.id for x in got.dropped.collect()]
    assert len(dropped) == len(set(dropped)) and set(dropped) == _dropped(rows, allowed)
    assert all(x.kept <= allowed for x in got.contributors.collect() if x.contributor is not None)


def test_cap_of_nothing(spark):
    df = spark.createDataFrame([], "pair_id bigint, source string, score int")
    got = cap_contributors(df, "pair_id", F.col("source"), F.col("score"), share_of=50)
    assert got.dropped.count() == 0 and got.contributors.count() == 0
