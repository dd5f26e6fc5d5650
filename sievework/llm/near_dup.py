"""Near-duplicate records with small edits, by word sets and a Gray-order index.

Similarity is shared / all distinct words. Exact copies of word and number set form a class;
classes are compared, copies never pairwise. The way to all similar pairs, without loss:

* Words are put in one order for all records, seemingly rare ones first (a counting sketch of
  fixed size tells). Of two sets of at least the wanted similarity, sharing a word, the first
  common word stands within the first n - ceil(t n) + 1 words of either, so that records are
  compared in the blocks of these words only.
* The fingerprint of a record in a block has one bit flipped for each of its words from the
  block's word on. Words before the first common word are on one side only; every further
  word on one side flips one bit. So two records whose first common word is the block's differ
  by at most d - i - j bits, where d = (n + m) (1 - t) / (1 + t), and i and j are the
  positions of the word. That is the range that the Gray-order index is asked for.
* What the index gives is compared by the words themselves.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.functions.text import number_set, words
from sievework.llm.batches import steps
from sievework.llm.contamination import _lists
from sievework.llm.gray_index import GrayForest, gray_rank
from sievework.operators.deliveries import without_older
from sievework.session import broadcast_if_small, cut, skew_join

#: Counters of the sketch by which words are ordered, at least and at most (32 MB); in between, one for 64 records.
SKETCH, MOST_SKETCH = 1 << 16, 1 << 22
#: Records of a block from which on it is divided, so that no task holds more of one.
HOT_WORD = 50_000
#: Records of whole blocks that one search takes at a time.
BLOCK_ROWS = 200_000
#: Copies in a part of a class; pairs of copies are made in cells of two parts.
COPIES = 2_000
#: Words that a task orders at a time.
STEP_WORDS = 1_000_000
#: Classes that a task remembers, so as to send each but once.
SEEN = 500_000


@dataclass
class NearDuplicates:
    """``pairs``: class keys a1, a2, b1, b2 of different classes. ``members``: k1, k2, id."""

    pairs: DataFrame
    members: DataFrame


def _prefixes(batch: pa.RecordBatch, counts: np.ndarray, t: Fraction, seen: set[int]) -> pa.RecordBatch:
    """Block rows of a batch of (k1, sorted distinct word hashes)."""
    k1 = batch.column(0).to_numpy()
    values, offsets = _lists(batch.column(1))
    n = np.diff(offsets)
    fresh = np.zeros(len(k1), bool)
    for i, k in enumerate(k1.tolist()):
        if k not in seen:
            seen.add(k)
            fresh[i] = True
    if len(seen) > SEEN:
        seen.clear()
    row = np.repeat(np.arange(len(n)), n)
    keep = fresh[row]
    row, values = row[keep], values[keep]
    n = np.where(fresh, n, 0)
    starts = np.cumsum(n) - n
    order = np.lexsort((values, counts[(values % np.uint64(len(counts))).astype(np.int64)], row))
    values = values[order]  # rows stay together
    bit = np.uint64(1) << (values >> np.uint64(58))
    # xor of the bits from each word to the row's last
    run = np.bitwise_xor.accumulate(bit[::-1])[::-1] if len(bit) else bit
    after = np.r_[run, np.zeros(1, np.uint64)][starts + n]
    suffix = run ^ after[row]
    at = np.arange(len(row)) - starts[row]
    prefix = n - -(-n * t.numerator // t.denominator) + 1
    take = at < prefix[row]
    row, at = row[take], at[take]
    word = values[take]
    size = n[row]
    out = [word.view(np.int64), k1[row], suffix[take].view(np.int64), size.astype(np.int32), at.astype(np.int32)]
    return pa.record_batch([pa.array(x) for x in out], ["word", "k1", "code", "size", "lead"])


_BLOCKS = "word bigint, k1 bigint, code bigint, size int, lead int"


def _search(table: pa.Table, divisor: int, ratio: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """Candidate pairs within the blocks of a table sorted by word."""
    word, k1, code, size, lead = (table.column(c).to_numpy() for c in range(5))
    code = code.view(np.uint64)
    order = np.lexsort((gray_rank(code), lead, word))
    word, k1, code, size, lead = (x[order] for x in (word, k1, code, size, lead))
    if len(word) > 1:
        again = (word[1:] == word[:-1]) & (k1[1:] == k1[:-1]) & (code[1:] == code[:-1]) & (size[1:] == size[:-1]) & (lead[1:] == lead[:-1])
        keep = np.r_[True, ~again]
        word, k1, code, size, lead = (x[keep] for x in (word, k1, code, size, lead))
    edge = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
    rows = np.diff(np.r_[edge, len(word)])
    for large in (False, True):  # small blocks are leaves; they need no levels above
        pick = np.repeat((rows > 8) if large else (rows > 1) & (rows <= 8), rows)
        if not pick.any():
            continue
        k = k1[pick]
        forest = GrayForest(word[pick], code[pick], size[pick], lead[pick], divisor, ratio)
        for x, y in forest.pairs():
            a, b = np.minimum(k[x], k[y]), np.maximum(k[x], k[y])
            keep = a != b
            if keep.any():
                both = np.unique(np.stack([a[keep], b[keep]], 1), axis=0)
                yield pa.record_batch([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a1", "b1"])


_FOUND = "a1 bigint, b1 bigint, " + _BLOCKS


def _candidates(divisor: int, ratio: tuple[int, int], hot_word: int = HOT_WORD):
    """Candidate pairs (a1, b1) of rows sorted by word; rows of blocks with more than ``hot_word`` go through as they are."""

    def searched(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in _search(pa.Table.from_batches(held), divisor, ratio):
            none = [pa.nulls(found.num_rows, k) for k in (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32())]
            yield pa.record_batch([*found.columns, *none], ["a1", "b1", "word", "k1", "code", "size", "lead"])

    def passed(batch: pa.RecordBatch) -> pa.RecordBatch:
        none = [pa.nulls(batch.num_rows, pa.int64())] * 2
        return pa.record_batch([*none, *batch.columns], ["a1", "b1", "word", "k1", "code", "size", "lead"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # whole blocks
        count = 0
        block: list[pa.RecordBatch] = []  # the last block, which may go on
        word, rows = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            w = batch.column(0).to_numpy()
            edges = np.r_[0, np.flatnonzero(w[1:] != w[:-1]) + 1, len(w)]
            if len(edges) > 3 and len(w) <= hot_word:  # all between the first and the last block at once
                edges = edges[[0, 1, -2, -1]]
                inner = {1}
            else:
                inner = set()
            for n, (low, high) in enumerate(zip(edges.tolist(), edges[1:].tolist())):
                part = batch.slice(low, high - low)
                if n in inner or w[low] != word:
                    if rows <= hot_word:
                        held += block
                        count += rows
                    block, rows, word = [], 0, w[low]
                if n in inner:
                    held.append(part)
                    count += high - low
                    word = None
                else:
                    rows += high - low
                    block.append(part)
                    if rows > hot_word:
                        yield from map(passed, block)
                        block = []
                if count >= BLOCK_ROWS:
                    yield from searched(held)
                    held, count = [], 0
        if rows <= hot_word:
            held += block
        if held:
            yield from searched(held)

    return run


def _noted(width: int):
    """Id and class of every record, and how often words fall to each of ``width`` counters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(width, np.int64)
        names = ["id", "k1", "k2", "x", "n"]
        for batch in steps(batches, 3, STEP_WORDS):
            values, _ = _lists(batch.column(3))
            counter, n = np.unique(values & np.uint64(width - 1), return_counts=True)
            counts[counter.astype(np.int64)] += n
            yield pa.record_batch([*batch.columns[:3], pa.nulls(batch.num_rows, pa.int32()), pa.nulls(batch.num_rows, pa.int64())], names)
        at = np.flatnonzero(counts)
        none = [pa.nulls(len(at), pa.int64())] * 3
        yield pa.record_batch([*none, pa.array(at.astype(np.int32)), pa.array(counts[at])], names)

    return run


def _divided(blocks: DataFrame, hot_word: int) -> DataFrame:
    """Rows of hot blocks, each in the cells of a triangle that its part of the block belongs to."""
    blocks = cut(blocks.distinct())
    sizes = blocks.groupBy("word").agg(F.ceil(F.count("*") / max(1, hot_word // 2)).cast("int").alias("parts"))
    wide = skew_join(blocks, cut(sizes), ["word"])
    own = F.pmod(F.xxhash64("word", "k1"), F.col("parts")).cast("int")  # anew for every cell
    wide = wide.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    key = F.xxhash64("word", F.least("own", "other"), F.greatest("own", "other"), "parts")
    return wide.select(key.alias("word"), "k1", "code", "size", "lead")


def near_duplicates(df: DataFrame, id_col: str, text: Column, numbers_in: Column, *, threshold: Fraction = Fraction(4, 5), hot_word: int = HOT_WORD, delivered: Column | None = None) -> NearDuplicates:
    """All pairs of classes of records whose word similarity is at least ``threshold``.

    A class is a set of distinct words of ``text`` with a set of distinct numbers of
    ``numbers_in``. Pairs where both have numbers, and not the same, are none. Null texts
    are empty; texts without words are similar to each other only. Rows with a null id are
    left out. Of an id that comes again the latest row by ``delivered`` holds; without that, or
    for rows equally late, an id with several contents belongs to several classes. Empty tables
    give empty results. Texts of any length are compared whole. Other columns of ``df`` are
    never looked at.
    """
    spark = df.sparkSession
    t = Fraction(threshold)
    divisor_exact = (1 + t) / (1 - t)
    if divisor_exact.denominator != 1:
        raise ValueError("(1 + threshold) / (1 - threshold) must be whole")
    divisor, ratio = divisor_exact.numerator, (t.denominator, t.numerator)
    rows = df.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.coalesce(text, F.lit("")).alias("t"), F.coalesce(numbers_in, F.lit("")).alias("n"), (F.lit(0) if delivered is None else delivered).alias("late")).filter("id is not null")
    rows = (rows if delivered is None else without_older(rows, "id", F.col("late"))).drop("late")
    hashed = rows.select("id", F.sort_array(F.array_distinct(F.transform(words(F.col("t")), lambda w: F.xxhash64(w)))).alias("w"), number_set(F.col("n")).alias("nums"))
    keyed = hashed.select("id", F.xxhash64("w", "nums").alias("k1"), F.xxhash64(F.lit(7), F.col("nums"), F.col("w")).alias("k2"), "w")

    width = min(MOST_SKETCH, max(SKETCH, 1 << (rows.count() // 64).bit_length()))
    # one pass gives the members of classes and the counts of words
    noted = cut(keyed.mapInArrow(_noted(width), "id bigint, k1 bigint, k2 bigint, x int, n bigint"))
    counted = noted.filter("x is not null").groupBy("x").agg(F.sum("n").alias("n")).toPandas()  # at most ``width`` rows
    counts = np.zeros(width, np.int64)
    counts[counted["x"].to_numpy()] = counted["n"].to_numpy()
    sent = spark.sparkContext.broadcast(counts)

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in steps(batches, 1, STEP_WORDS):
            yield _prefixes(batch, sent.value, t, seen)

    blocks = keyed.filter(F.size("w") > 0).select("k1", "w").mapInArrow(prefixes, _BLOCKS)
    search = _candidates(divisor, ratio, hot_word)
    first = cut(blocks.repartition("word").sortWithinPartitions("word").mapInArrow(search, _FOUND))
    pairs, hot = first.filter("a1 is not null").select("a1", "b1"), first.filter("a1 is null").select("word", "k1", "code", "size", "lead")
    while not hot.isEmpty():  # cells are half as large as what is divided; by chance, one may have to be divided again
        more = cut(_divided(hot, hot_word).repartition("word").sortWithinPartitions("word").mapInArrow(search, _FOUND))
        pairs, hot = pairs.unionByName(more.filter("a1 is not null").select("a1", "b1")), more.filter("a1 is null").select("word", "k1", "code", "size", "lead")
    found = cut(pairs.distinct())
    members = cut(noted.filter("x is null").select("k1", "k2", "id").distinct())

    ends = found.select(F.col("a1").alias("k1")).unionByName(found.select(F.col("b1").alias("k1"))).distinct()
    picked = cut(members.join(broadcast_if_small(cut(ends)), "k1", "left_semi").groupBy("k1", "k2").agg(F.min("id").alias("id")))
    texts = rows.join(broadcast_if_small(picked.select("id").distinct()), "id", "left_semi")
    own = texts.select("id", F.array_distinct(words(F.col("t"))).alias("w"), number_set(F.col("n")).alias("nums"))
    h = F.transform(F.col("w"), lambda w: F.xxhash64(w))
    own = own.select(F.xxhash64(F.sort_array(h), F.col("nums")).alias("k1"), F.xxhash64(F.lit(7), F.col("nums"), F.sort_array(h)).alias("k2"), "w", "nums")
    reps = cut(own.dropDuplicates(["k1", "k2"]))
    a, b = (reps.select(F.col("k1").alias(f"{x}1"), F.col("k2").alias(f"{x}2"), F.col("w").alias(f"{x}w"), F.col("nums").alias(f"{x}n")) for x in "ab")
    both = skew_join(cut(skew_join(found, a, ["a1"])), b, ["b1"])
    shared = F.size(F.array_intersect("aw", "bw"))
    similar = t.denominator * shared >= t.numerator * (F.size("aw") + F.size("bw") - shared)
    veto = (F.size("an") > 0) & (F.size("bn") > 0) & (F.col("an") != F.col("bn"))
    pairs = cut(both.filter(similar & ~veto).select("a1", "a2", "b1", "b2"))
    return NearDuplicates(pairs, members)


def _copy_pairs(several: DataFrame, copies: int = COPIES) -> DataFrame:
    """``x, y`` with x < y for all ids of a class, made in cells of two parts of it, so that no task has a whole class."""
    several = cut(several)
    sizes = several.groupBy("k1", "k2").agg(F.ceil(F.count("*") / copies).cast("int").alias("parts"))
    placed = cut(skew_join(several, cut(sizes), ["k1", "k2"]).withColumn("own", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")))
    wide = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    left = wide.filter("own <= other").select("k1", "k2", F.col("own").alias("i"), F.col("other").alias("j"), F.col("id").alias("x"))
    right = wide.filter("own >= other").select("k1", "k2", F.col("other").alias("i"), F.col("own").alias("j"), F.col("id").alias("y"))
    both = left.join(right, ["k1", "k2", "i", "j"]).filter("x <> y and (i < j or x < y)")
    return both.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))


def id_pairs(found: NearDuplicates) -> DataFrame:
    """All pairs of ids, ``a < b``, that are similar, copies included."""
    m = found.members
    a = m.select(F.col("k1").alias("a1"), F.col("k2").alias("a2"), F.col("id").alias("x"))
    b = m.select(F.col("k1").alias("b1"), F.col("k2").alias("b2"), F.col("id").alias("y"))
    across = skew_join(b, cut(skew_join(a, found.pairs, ["a1", "a2"])), ["b1", "b2"]).select("x", "y")
    copied = m.groupBy("k1", "k2").agg(F.count("*").alias("n")).filter("n > 1").select("k1", "k2")
    within = _copy_pairs(m.join(broadcast_if_small(cut(copied)), ["k1", "k2"], "left_semi"))
    pairs = across.filter("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    return pairs.unionByName(within.select(F.col("x").alias("a"), F.col("y").alias("b"))).distinct()


def duplicate_classes(found: NearDuplicates) -> DataFrame:
    """``id, class_id, copies, links``: a record's class, named by its least id, the number of its
    records, and of the other classes directly similar to it."""
    sizes = found.members.groupBy("k1", "k2").agg(F.min("id").alias("class_id"), F.count("*").alias("copies"))
    ends = found.pairs.select(F.col("a1").alias("k1"), F.col("a2").alias("k2")).unionByName(found.pairs.select(F.col("b1").alias("k1"), F.col("b2").alias("k2")))
    links = ends.groupBy("k1", "k2").agg(F.count("*").alias("links"))
    named = cut(sizes.join(links, ["k1", "k2"], "left"))
    return skew_join(found.members, named, ["k1", "k2"]).select("id", "class_id", "copies", F.coalesce("links", F.lit(0)).alias("links"))
