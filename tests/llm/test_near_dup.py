import random
import re
from fractions import Fraction
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sievework.llm.gray_index import GrayForest, gray_rank
from sievework.llm.near_dup import _copy_pairs, duplicate_classes, id_pairs, near_duplicates

WORD, NUMBER = re.compile(r"[^\W_]+"), re.compile(r"[0-9]+(?:[.,][0-9]+)*")


def brute(rows, t=Fraction(4, 5)):
    sets = {(i, q, a): (set(WORD.findall(f"{q or ''} {a or ''}".lower())), {x.replace(",", "") for x in NUMBER.findall(a or "")}) for i, q, a in rows if i is not None}
    out = set()
    for (x, (w, n)), (y, (v, m)) in combinations(sets.items(), 2):
        if x[0] != y[0] and len(w & v) * t.denominator >= t.numerator * len(w | v) and not (n and m and n != m):
            out.add((min(x[0], y[0]), max(x[0], y[0])))
    return out


def found(spark, rows, **kw):
    df = spark.createDataFrame(rows, "pair_id bigint, question string, answer string").withColumn("id", F.lit(0)).withColumn("w", F.lit("clash"))
    text = F.concat(F.coalesce("question", F.lit("")), F.lit(" "), F.coalesce("answer", F.lit("")))
    return near_duplicates(df, "pair_id", text, F.col("answer"), **kw)


def texts(r, n, vocabulary):
    out = []
    for i in range(n):
        if out and r.random() < 0.5:
            w = r.choice(out)[1].split()
            for _ in range(r.randint(0, 3)):
                k = r.randrange(len(w) + 1)
                w[k : k + r.randint(0, 1)] = r.choice([[], [r.choice(vocabulary)]])
            r.shuffle(w)
        else:
            w = [r.choice(vocabulary) for _ in range(r.randint(1, 25))]
        out.append((i, " ".join(w), r.choice(["", "12 kg", "1,200 kg", "1200 kg", None, "no number"])))
    return out


@pytest.mark.parametrize("size,hot", [(600, 4096), (30, 4096), (30, 20)])
def test_against_brute_force(spark, size, hot):
    """Few words make hot blocks; a low bound for hot words makes these be divided."""
    r = random.Random(size + hot)
    rows = texts(r, 300, [f"w{k}" for k in range(size)])
    rows += rows[:20] + [(900, None, None), (901, "", ""), (902, "Éa straße 日本 x_y", "１２"), (903, "éA STRASSE 日本 x y", "１２"), (None, "w1 w2", "w3"), (904, "long " + " ".join(f"z{k}" for k in range(3000)), ""), (905, " ".join(f"z{k}" for k in range(2900)), "")]
    got = [tuple(x) for x in id_pairs(found(spark, rows, hot_word=hot)).collect()]
    assert len(got) == len(set(got))
    assert set(got) == brute(rows)


def test_copies_are_one_class(spark):
    rows = [(i, "the same words here", "again") for i in range(400)] + [(1000, "the same words here", "again too"), (1001, "nothing alike", "")]
    near = found(spark, rows)
    by = {x.pair_id if hasattr(x, "pair_id") else x.id: x for x in duplicate_classes(near).collect()}
    assert by[7].copies == 400 and by[7].class_id == 0 and by[7].links == 1
    assert by[1000].links == 1 and by[1001].links == 0
    assert near.pairs.count() == 1


def test_copies_pair_up_in_parts(spark):
    """Pairs of copies are the same whatever the size of a part."""
    rows = [(i, f"class {i % 3}", "same") for i in range(60)] + [(99, "class 0", "other")]
    near = found(spark, rows)
    want = {(i, j) for i in range(60) for j in range(i + 1, 60) if i % 3 == j % 3}
    for copies in (7, 2000):
        got = [(x.x, x.y) for x in _copy_pairs(near.members.filter("id < 60"), copies).collect()]
        assert len(got) == len(want) and set(got) == want


def test_half_of_all_in_one_block(spark):
    """A rare word that half of all records have in common is divided, and no pair is lost."""
    r = random.Random(8)
    rows = [(i, "hot " + " ".join(f"a{k}" for k in r.sample(range(8), 6)), f"q{i}") for i in range(150)] + texts(r, 150, [f"w{k}" for k in range(300)])
    rows = [(i, q, a) for i, (_, q, a) in enumerate(rows)]
    got = [tuple(x) for x in id_pairs(found(spark, rows, hot_word=40)).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows)


def test_latest_delivery_holds(spark):
    rows = [(1, "one two three four five six", "x", 1), (1, "quite other words stand here now", "x", 2), (2, "one two three four five six", "x", 1), (3, "one two three four five six", "x", 1)]
    df = spark.createDataFrame(rows, "pair_id bigint, question string, answer string, at int")
    text = F.concat_ws(" ", "question", "answer")
    got = id_pairs(near_duplicates(df, "pair_id", text, F.col("answer"), delivered=F.col("at"))).collect()
    assert [tuple(x) for x in got] == [(2, 3)]
    assert len(id_pairs(near_duplicates(df, "pair_id", text, F.col("answer"))).collect()) == 3


def test_nothing(spark):
    near = found(spark, [])
    assert id_pairs(near).count() == 0 and duplicate_classes(near).count() == 0


def test_other_threshold(spark):
    rows = texts(random.Random(3), 120, [f"w{k}" for k in range(60)])
    got = {tuple(x) for x in id_pairs(found(spark, rows, threshold=Fraction(2, 3))).collect()}
    assert got == brute(rows, Fraction(2, 3))
    with pytest.raises(ValueError):
        found(spark, rows, threshold=Fraction(7, 10))


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**32), st.integers(2, 120), st.integers(1, 6), st.integers(1, 10))
def test_forest(seed, n, blocks, bits):
    r = np.random.default_rng(seed)
    block = np.sort(r.integers(0, blocks, n))
    code = r.integers(0, 1 << bits, n).astype(np.uint64) * np.uint64(0x0101010101010101)
    size, lead = r.integers(5, 40, n), r.integers(0, 3, n)
    order = np.lexsort((gray_rank(code), lead, block))
    block, code, size, lead = block[order], code[order], size[order], lead[order]
    got = sorted((int(a), int(b)) for x, y in GrayForest(block, code, size, lead, 9, (5, 4)).pairs() for a, b in zip(x, y))
    want = []
    for i in range(n):
        for j in range(i + 1, n):
            low, high = sorted((int(size[i]), int(size[j])))
            apart = bin(int(code[i]) ^ int(code[j])).count("1")
            if block[i] == block[j] and apart <= (low + high) // 9 - lead[i] - lead[j] and 5 * low >= 4 * high:
                want.append((i, j))
    assert got == want


def test_gray_rank_neighbours_differ_in_one_bit():
    code = np.arange(1 << 10, dtype=np.uint64)
    order = code[np.argsort(gray_rank(code))]
    assert (np.bitwise_count(order[1:] ^ order[:-1]) == 1).all()


def test_steps_cut_batches_by_size():
    import pyarrow as pa

    from sievework.llm.batches import steps

    batch = pa.record_batch([pa.array(range(6)), pa.array(["aaa", None, "b" * 50, "", "cc", "dd"]), pa.array([[1], None, [1] * 9, [], [2, 2], [3]])], ["i", "s", "l"])
    assert [b.num_rows for b in steps(iter([batch]), 1, 4)] == [2, 1, 3]
    assert [b.column(0).to_pylist() for b in steps(iter([batch, batch.slice(0, 0)]), 2, 2)] == [[0, 1], [2], [3, 4], [5]]


@pytest.mark.parametrize("seed", range(12))
def test_blocks_over_batches(monkeypatch, seed):
    """Where batches end must not matter, nor how many records are held."""
    import pyarrow as pa

    from sievework.llm import near_dup as n

    r = np.random.default_rng(seed)
    rows = 200
    word = np.sort(r.integers(0, (3, 12, 60)[seed % 3], rows))
    data = [word, r.integers(0, 150, rows), r.integers(0, 8, rows), r.integers(9, 12, rows).astype(np.int32), r.integers(0, 2, rows).astype(np.int32)]
    batch = pa.record_batch([pa.array(x) for x in data], ["word", "k1", "code", "size", "lead"])

    def run(sizes):
        at, parts = 0, []
        for s in sizes:
            parts.append(batch.slice(at, s))
            at += s
        out = set()
        for b in n._candidates(9, (5, 4))(iter([*parts, batch.slice(at)])):
            out |= set(zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
        return out

    whole = run([])
    assert whole
    for most in (1, 5, 40):
        monkeypatch.setattr(n, "BLOCK_ROWS", most)
        assert run(r.integers(0, 9, 30).tolist()) == whole
        assert run([1] * 150) == whole
