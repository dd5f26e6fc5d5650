"""Passages of held-out items in a corpus, by winnowed k-gram fingerprints.

After Schleimer, Wilkerson and Aiken, "Winnowing: Local Algorithms for Document
Fingerprinting" (SIGMOD 2003): of every window of consecutive k-gram hashes the least is
kept (ties: the rightmost). Two texts that share ``span`` words share a whole window of
span - k + 1 k-grams and thus a fingerprint, so that no shared span is missed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievework.functions.text import words
from sievework.llm.batches import steps
from sievework.session import broadcast_if_small, cut, skew_join

#: Words of held-out fields up to which these are sent to every executor (8 bytes a word and fingerprint).
BROADCAST_WORDS = 2_000_000
#: Words of documents that a task looks at at a time.
STEP_WORDS = 1_000_000
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _kgrams(h: np.ndarray, k: int) -> np.ndarray:
    """A hash of the k words from each position on."""
    n = len(h) - k + 1
    if n < 1:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = (out ^ h[j : j + n]) * _MIX
        out ^= out >> np.uint64(29)
    return out


def winnow(h: np.ndarray, k: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of a text of word hashes, and the positions where they stand."""
    grams = _kgrams(h, k)
    if len(grams) < window:
        return grams[:0], np.empty(0, np.int64)
    windows = sliding_window_view(grams, window)
    at = np.unique(np.arange(len(windows)) + window - 1 - np.argmin(windows[:, ::-1], axis=1))
    return grams[at], at


def _winnow_many(values: np.ndarray, offsets: np.ndarray, k: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """winnow() of all texts of a batch at once: fingerprints and positions in ``values``."""
    grams = _kgrams(values, k)
    if len(grams) < window:
        return grams[:0], np.empty(0, np.int64)
    starts = np.arange(len(grams) - window + 1)
    end_of = np.repeat(offsets[1:], np.diff(offsets))[: len(starts)]
    starts = starts[starts + window - 1 + k <= end_of]  # windows inside one text
    if not len(starts):
        return grams[:0], np.empty(0, np.int64)
    windows = sliding_window_view(grams, window)[starts]
    at = np.unique(starts + window - 1 - np.argmin(windows[:, ::-1], axis=1))
    return grams[at], at


def _lists(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and offsets of a column of lists without nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = column.offsets.to_numpy().astype(np.int64)
    values = column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
    return values.astype(np.int64, copy=False).view(np.uint64), offsets - offsets[0]


def shared_span(a: np.ndarray, i: int, b: np.ndarray, j: int) -> tuple[int, int]:
    """Start in ``a`` and length of the longest common run through a[i] = b[j]."""
    back = min(i, j)
    differ = np.flatnonzero(a[i - back : i] != b[j - back : j])
    left = back - 1 - int(differ[-1]) if len(differ) else back
    ahead = min(len(a) - i, len(b) - j)
    differ = np.flatnonzero(a[i : i + ahead] != b[j : j + ahead])
    right = int(differ[0]) if len(differ) else ahead
    return i - left, left + right


_HITS = "doc_id bigint, item_id bigint, field string, start int, length int"


def _hits(rows: list[tuple]) -> pa.RecordBatch:
    c = list(zip(*rows)) if rows else [()] * 5
    return pa.record_batch([pa.array(c[0], pa.int64()), pa.array(c[1], pa.int64()), pa.array(c[2], pa.string()), pa.array(c[3], pa.int32()), pa.array(c[4], pa.int32())], ["doc_id", "item_id", "field", "start", "length"])


def _hashed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Ids with the hashed words of a text, and nothing else of it."""
    return df.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.transform(words(F.col(f"`{text_col}`")), lambda w: F.xxhash64(w)).alias("h")).filter("id is not null")


def _against_few(docs: DataFrame, fields: list[tuple[int, str, np.ndarray]], span: int, k: int) -> DataFrame:
    """Hits against fields that fit into every executor; corpus fingerprints are never shuffled.

    What is sent is arrays: fingerprints, their places, and the words of all fields.
    """
    window = span - k + 1
    flat = np.concatenate([h for _, _, h in fields]) if fields else np.empty(0, np.uint64)
    ends = np.cumsum([0, *(len(h) for _, _, h in fields)])
    keys, at = _winnow_many(flat, ends, k, window)
    order = np.argsort(keys, kind="stable")
    keys, at = keys[order], at[order]
    of = np.searchsorted(ends, at, "right") - 1
    items = np.array([i for i, _, _ in fields], np.int64)
    sent = docs.sparkSession.sparkContext.broadcast((keys, of.astype(np.int32), (at - ends[of]).astype(np.int32), flat, ends, items, [f for _, f, _ in fields]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, of, where, flat, ends, items, names = sent.value
        for batch in steps(batches, 1, STEP_WORDS):
            ids = batch.column(0).to_numpy()
            values, offsets = _lists(batch.column(1))
            fps, at = _winnow_many(values, offsets, k, window)
            low, high = np.searchsorted(keys, fps, "left"), np.searchsorted(keys, fps, "right")
            hit = np.flatnonzero(high > low)
            rows = np.searchsorted(offsets, at[hit], "right") - 1
            best: dict[tuple, tuple[int, int]] = {}
            upto: dict[tuple, int] = {}  # end of the last run of a document and field on a diagonal
            for x, row in zip(hit.tolist(), rows.tolist()):
                first = int(offsets[row])
                i = int(at[x]) - first
                for y in range(int(low[x]), int(high[x])):
                    f, j = int(of[y]), int(where[y])
                    if i < upto.get((row, f, i - j), 0):
                        continue
                    start, length = shared_span(values[first : offsets[row + 1]], i, flat[ends[f] : ends[f + 1]], j)
                    upto[row, f, i - j] = start + length
                    key = (int(ids[row]), int(items[f]), names[f])
                    if length >= span and (key not in best or (-length, start) < (-best[key][1], best[key][0])):
                        best[key] = (start, length)
            yield _hits([(*key, *v) for key, v in best.items()])

    return docs.mapInArrow(scan, _HITS)


def _fingerprints(df: DataFrame, span: int, k: int) -> DataFrame:
    """``id, fp, at`` of all texts."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, 1, STEP_WORDS):
            values, offsets = _lists(batch.column(1))
            fps, at = _winnow_many(values, offsets, k, span - k + 1)
            row = np.searchsorted(offsets, at, "right") - 1
            yield pa.record_batch([batch.column(0).take(pa.array(row)), pa.array(fps.view(np.int64)), pa.array((at - offsets[row]).astype(np.int32))], ["id", "fp", "at"])

    return df.mapInArrow(scan, "id bigint, fp bigint, at int")


def _against_many(docs: DataFrame, items: DataFrame, span: int, k: int) -> DataFrame:
    """Hits against any number of fields: fingerprints are joined, hits extended beside both texts.

    Of hits of a document and field that follow each other on a diagonal so closely that they
    belong to one run, only the first goes on; and all that a document and field have in common
    meet their texts at once.
    """
    fields = cut(items.select(F.xxhash64("id", "field").alias("fid"), F.col("id").alias("item_id"), "field", "h"))
    theirs = cut(_fingerprints(fields.select(F.col("fid").alias("id"), "h"), span, k).select("fp", F.col("id").alias("fid"), F.col("at").alias("j")))
    known = broadcast_if_small(cut(theirs.select("fp").distinct()))
    ours = cut(_fingerprints(docs, span, k).join(known, "fp", "left_semi"))
    hits = skew_join(ours, theirs, ["fp"]).select("id", "at", "fid", "j").distinct()
    before = F.lag("at").over(Window.partitionBy("id", "fid", F.col("at") - F.col("j")).orderBy("at"))
    fresh = hits.withColumn("before", before).filter(F.col("before").isNull() | (F.col("at") - F.col("before") > k))
    grouped = cut(fresh.groupBy("id", "fid").agg(F.collect_list(F.struct("at", "j")).alias("hits")))  # at most the places of one text beside another
    texts = docs.join(broadcast_if_small(cut(grouped.select("id").distinct())), "id", "left_semi").withColumnRenamed("h", "a")
    beside = cut(skew_join(grouped, cut(texts), ["id"]))
    both = skew_join(beside, fields.withColumnRenamed("h", "b"), ["fid"]).select("a", "id", "item_id", "field", "hits", "b")

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, 0, STEP_WORDS):
            (a, ao), (b, bo), rows = _lists(batch.column(0)), _lists(batch.column(5)), []
            for x, (doc, item, field, places) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(1, 5)))):
                for place in places:
                    start, length = shared_span(a[ao[x] : ao[x + 1]], place["at"], b[bo[x] : bo[x + 1]], place["j"])
                    if length >= span:
                        rows.append((doc, item, field, start, length))
            yield _hits(rows)

    return both.mapInArrow(extend, _HITS)


def find_leaks(docs: DataFrame, doc_id: str, text_col: str, items: DataFrame, item_id: str, fields: list[str], *, span: int = 8, k: int = 5, broadcast_words: int = BROADCAST_WORDS) -> DataFrame:
    """``doc_id, item_id, field, start, length``: the longest run of common words, if at least ``span``.

    Of runs equally long the first in the document is given; start counts words from 0. Words
    are compared in order with none between, as 64-bit hashes. Null texts and fields, and those
    under ``span`` words, match nothing; rows with a null id are left out; an id that comes
    again gives one row a document, item and field. Empty tables give an empty result.

    Fields of at most ``broadcast_words`` words altogether are sent to the executors, which is
    checked; more are joined by their fingerprints.
    """
    hashed = _hashed(docs, doc_id, text_col)
    long = None
    for field in fields:
        part = _hashed(items, item_id, field).select("id", F.lit(field).alias("field"), "h")
        long = part if long is None else long.unionByName(part)
    long = cut(long.filter(F.size("h") >= span))
    n = long.agg(F.coalesce(F.sum(F.size("h")), F.lit(0))).first()[0]
    if n <= broadcast_words:
        few = [(r.id, r.field, np.array(r.h, np.int64).view(np.uint64)) for r in long.collect()]
        found = _against_few(hashed, few, span, k)
    else:
        found = _against_many(hashed, long, span, k)
    best = F.min(F.struct(-F.col("length"), "start")).alias("m")
    return found.groupBy("doc_id", "item_id", "field").agg(best).select("doc_id", "item_id", "field", "m.start", (-F.col("m.col1")).alias("length"))
