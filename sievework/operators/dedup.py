"""Greedy first-wins removal of near-duplicates by cosine, with a guard on numbers.

Row i stays unless an earlier row that stays is at least ``threshold`` similar and not vetoed.
This is the lexicographically first maximal independent set of the similarity graph; it is found
in rounds over the edges (Blelloch, Fineman and Shun, SPAA 2012), not by a scan.

Rows with equal vectors and equal numbers are compared once, as their first; the others always go,
and have one edge, to the first. The edges are exact. Rows are homed at the nearest of some pivots,
the means of groups of a sample, and sent beyond a border that is near: if rows of two homes are
similar, one of them lies no further from the plane between the pivots than half their greatest
distance. Pivots with crowded borders make one cell. Vectors are packed without loss and travel in
compressed blocks, of which a cell's chunks of some ten thousand rows are made; each pair of chunks is
a unit of work, so a row is repeated once for every chunk of its cell. Chunks are compared by matrix products of
some principal axes and the norm of the rest, which bound the cosine; what is left is computed in doubles.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievework.functions.text import number_set, opener
from sievework.session import broadcast_if_small, cut, _is_marked, skew_join, work_scope

#: Half of the rows up to which there is one cell; pivots at most; rows of the sample that they come from; rows of a chunk, and of a task's rows placed at once.
PIVOT_ROWS, PIVOTS, SAMPLE, CHUNK, PART = 20_000, 256, 8192, 65_536, 40_000
#: Rows and columns of one matrix product; pairs of rows that a task should compare, about.
TILE, WORK = 1024, 600_000_000
#: Axes that products may be cut to, and the share of pairs that this may leave over.
AXES, LEFT = (32, 48, 64, 96, 128, 192), 0.002
#: Nodes up to which resolve() broadcasts them, 8 bytes each.
NODES = 500_000
#: Share of all comparisons that cells must leave at most to be worth making.
MOST_WORK = 0.5


def dedup_text(question: Column, answer: Column, question_only: bool = False) -> Column:
    return question if question_only else F.concat_ws(" ", question, answer)


def answer_numbers(answer: Column) -> Column:
    """Numbers of an answer without commas, sorted: 1,500 is 1500, and 3.0 is not 3."""
    return number_set(answer)


def number_veto(a: Column, b: Column) -> Column:
    """Both have numbers, and not the same."""
    return (F.size(a) > 0) & (F.size(b) > 0) & (a != b)


#: Bytes that are no ASCII letter or digit become blanks.
_LETTERS = bytes(x if chr(x).isalnum() and x < 128 else 32 for x in range(256))


def _hashed_counts(texts: list[str | None], dim: int) -> np.ndarray:
    """Signed counts of each text's hashed words and word pairs."""
    import re
    import zlib

    words, crc, ends, hashes = re.compile(r"[^\W_]+").findall, zlib.crc32, [], []
    for t in texts:
        low = (t or "").lower()
        w = low.encode().translate(_LETTERS).split() if low.isascii() else [x.encode() for x in words(low)]
        each = [crc(g) for g in w]
        hashes += each
        hashes += [crc(b" " + q, h) for h, q in zip(each, w[1:])]
        ends.append(len(hashes))
    h = np.array(hashes, np.int64)
    at = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0)) * dim + h % dim
    return np.bincount(at, np.where(h >> 31, 1.0, -1.0), len(ends) * dim).reshape(-1, dim)


def hashed_vector(text: Column, dim: int = 256, packed: bool = False) -> Column:
    """A deterministic stand-in for a sentence model: unit vector of hashed words and word pairs.

    A text without words gives the null vector, which resembles nothing. ``packed`` gives the same
    vectors as bytes, as similarity_edges() keeps them.
    """

    def run(texts: pd.Series) -> pd.Series:
        all_, out = texts.tolist(), []
        for k in range(0, len(all_), 512):
            counts = _hashed_counts(all_[k : k + 512], dim)
            if not packed:
                out += list(_units(counts))
            elif np.abs(counts).max() <= 127:
                out += [b"c" + x.tobytes() for x in counts.astype(np.int8)]
            else:
                out += _packed(_units(counts))
        return pd.Series(out)

    return F.pandas_udf(run, "binary" if packed else "array<float>")(text)


def cosine(a: Column, b: Column) -> Column:
    """Dot product in doubles, for unit vectors."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def _units(counts: np.ndarray) -> np.ndarray:
    c = counts.astype(np.float64)
    n = np.sqrt((c * c).sum(1))
    return (c / np.where(n > 0, n, 1.0)[:, None]).astype(np.float32)


def _packed(v: np.ndarray) -> list[bytes]:
    """Each row as bytes: whole numbers (``c``) if the row comes out when they are divided by their norm, else its floats (``f``)."""
    size = np.abs(v)
    least = np.where(size > 0, size, np.inf).min(1, initial=np.inf)[:, None]
    c = np.rint(v / least)
    whole = (np.abs(c) <= 127).all(1)
    c = np.where(whole[:, None], c, 0).astype(np.int8)
    whole &= (_units(c) == v).all(1)
    return [b"c" + x.tobytes() if w else b"f" + y.tobytes() for w, x, y in zip(whole.tolist(), c, v)]


def _unpacked(rows: list[bytes]) -> np.ndarray:
    """The float32 rows."""
    if len({len(x) for x in rows}) > 1:
        kinds = np.array([x[:1] == b"c" for x in rows])
        parts = [_unpacked([x for x, k in zip(rows, kinds) if k == kind]) for kind in (True, False)]
        out = np.empty((len(rows), parts[0].shape[1]), np.float32)
        out[kinds], out[~kinds] = parts
        return out
    return _flat(b"".join(rows), len(rows))


def _flat(data: bytes, n: int) -> np.ndarray:
    """The float32 rows of n packed ones of one kind."""
    at = np.frombuffer(data, np.uint8).reshape(n, -1)
    return _units(at[:, 1:].view(np.int8)) if at[0, 0] == ord("c") else np.ascontiguousarray(at[:, 1:]).view(np.float32)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            ready, own = pa.types.is_binary(batch.schema.field(1).type), []
            rows = batch.column(1) if ready else pa.array(_packed(batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(batch.num_rows, -1)), pa.binary())
            for k in range(0, batch.num_rows, 512):
                v = _unpacked(rows[k : k + 512].to_pylist())
                own.append((np.ascontiguousarray(v.T).astype(np.float64) ** 2).sum(0))
            yield pa.record_batch([batch.column(0), rows, batch.column(2), pa.array(np.concatenate(own))], ["o", "v", "n", "own"])


def _runs(batch: pa.RecordBatch, columns: int) -> list[tuple[int, int]]:
    """Bounds of runs of rows that are equal in the first columns."""
    n = batch.num_rows
    new = np.zeros(max(n - 1, 0), bool)
    for k in range(columns):
        c = batch.column(k).to_numpy()
        new |= c[1:] != c[:-1]
    edges = [0, *(np.flatnonzero(new) + 1).tolist(), n]
    return [(low, high) for low, high in zip(edges, edges[1:]) if high > low]


def _near(x: np.ndarray, pivots: np.ndarray, cell: np.ndarray, half: float) -> tuple[np.ndarray, np.ndarray]:
    """The home cell of each row, and a matrix of the cells that it belongs to, at home or beyond a border at most ``half`` away."""
    score = x @ pivots.T - (pivots * pivots).sum(1) / 2
    nearest = score.argmax(1)
    square = (pivots * pivots).sum(1)
    apart = np.sqrt(np.maximum(square[:, None] + square - 2 * pivots @ pivots.T, 1e-12))
    close = (score[np.arange(len(x)), nearest][:, None] - score) / apart[nearest] <= half
    order = np.argsort(cell, kind="stable")
    within = np.logical_or.reduceat(close[:, order], np.searchsorted(cell[order], np.arange(cell.max() + 1)), axis=1)
    home = cell[nearest]
    within[np.arange(len(x)), home] = True
    return home, within


def _pivots(x: np.ndarray, half: float, seed: int) -> tuple[np.ndarray, np.ndarray] | None:
    """Pivots from the rows of a sample and the cell of each, or nothing if cells would save too little.

    Two cells are made one where keeping them apart leaves no fewer comparisons between them.
    """
    pivots = x[np.random.default_rng(seed).choice(len(x), max(1, min(PIVOTS, len(x) // 16)), replace=False)]
    for _ in range(8):
        nearest = (x @ pivots.T - (pivots * pivots).sum(1) / 2).argmax(1)
        order = np.argsort(nearest, kind="stable")
        first = np.flatnonzero(np.diff(nearest[order], prepend=-1))
        pivots = np.add.reduceat(x[order], first, axis=0) / np.diff(first, append=len(x))[:, None]
    pivots = pivots.astype(np.float32)
    cell = np.arange(len(pivots))
    while True:
        home, within = _near(x, pivots, cell, half)
        n = np.bincount(home, minlength=cell.max() + 1).astype(float)
        sent = np.array([within[home == c].sum(0) for c in range(len(n))]) / np.maximum(n, 1)[:, None]
        np.fill_diagonal(sent, 0)
        both, name, joined = sent + sent.T, np.arange(len(n)), set()
        for a, b in sorted(np.argwhere(np.triu(both) >= 1).tolist(), key=lambda p: -both[p[0], p[1]]):
            if not {a, b} & joined:
                name[b] = a
                joined |= {a, b}
        if not joined:
            break
        cell = np.unique(name, return_inverse=True)[1][cell]
    return (pivots, cell) if (n * (within.sum(0) - n / 2)).sum() <= MOST_WORK * len(x) ** 2 / 2 else None


def _axes(v: np.ndarray, threshold: float) -> np.ndarray | None:
    """The fewest principal axes of the rows by which _bounds() leaves few pairs over; nothing if all dimensions do as well."""
    if len(v) < 256:
        return None
    all_ = np.linalg.eigh((v.T @ v).astype(np.float64))[1][:, ::-1].astype(np.float32)
    some = v[:: max(1, len(v) // 1024)]
    least = (some @ some.T >= threshold).mean()
    for k in AXES:
        if k <= 0.75 * v.shape[1] and ((b := _bounds(some, all_[:, :k])) @ b.T >= threshold).mean() <= least + LEFT:
            return np.ascontiguousarray(all_[:, :k])
    return None


def _bounds(v: np.ndarray, axes: np.ndarray | None) -> np.ndarray:
    """Rows whose products are no less than those of ``v``: the axes and the length of the rest, a little more for rounding."""
    if axes is None:
        return v
    at = v @ axes
    rest = np.maximum(np.einsum("ij,ij->i", v, v) - np.einsum("ij,ij->i", at, at), 0)
    return np.column_stack([at, np.sqrt(rest + np.float32(2e-6))])


def similarity_edges(vectors: DataFrame, threshold: float, ord_col: str = "ord", vector: str = "vector", number_col: str | None = None, seed: int = 42) -> DataFrame:
    """``i, j, similarity, copy`` with j < i, for all pairs of unit vectors at least ``threshold`` similar.

    Of rows with equal vectors and numbers only the first takes part; each other has one edge, to
    the first, marked as ``copy``. Vectors are floats or packed. Pairs that the number veto parts are left out, if ``number_col``
    names arrays of numbers. ``ord_col`` must be unique. Null vectors are left out.
    """
    spark = vectors.sparkSession
    nums = F.col(number_col) if number_col else F.array().cast("array<string>")
    joined = F.when(F.size(nums) > 0, F.concat(F.lit("="), F.array_join(nums, "\0"))).otherwise(F.lit(""))
    v = F.col(vector) if dict(vectors.dtypes)[vector] == "binary" else F.col(vector).cast("array<float>")
    with work_scope(spark) as outside:  # the packed rows go once they are placed
        every = cut(vectors.select(F.col(ord_col).cast("bigint").alias("o"), v.alias("v"), joined.alias("n")).filter("v is not null").mapInArrow(_pack, "o bigint, v binary, n string, own double"), "zstd")
        keyed = every.filter(F.col("own") >= threshold).select("o", F.xxhash64("v", "n").alias("k1"), F.xxhash64(F.lit(7), F.col("n"), F.col("v")).alias("k2"), "own")
        several = cut(keyed.groupBy("k1", "k2").agg(F.min("o").alias("first"), F.count("*").alias("times")).filter("times > 1").select("k1", "k2", "first"))
        rows, copies = every if threshold <= 0 else every.filter("own > 0"), None  # the null vector resembles nothing
        if not several.isEmpty():
            copies = cut(skew_join(keyed, several, ["k1", "k2"]).filter("o <> first").select(F.col("o").alias("i"), F.col("first").alias("j"), F.col("own").alias("similarity"), F.lit(True).alias("copy")), scope=outside)
            others = broadcast_if_small(copies.select(F.col("i").alias("o")))
            rows = rows.join(others, "o", "left_anti")
            if not _is_marked(others):
                rows = cut(rows, "zstd")
        half = math.sqrt(max(0.0, 2 - 2 * threshold)) / 2 + 1e-4
        n, made = rows.count(), None
        if n > 2 * PIVOT_ROWS:
            lot = F.pmod(F.xxhash64(F.lit(seed), F.col("o")), F.lit(1 << 30))
            drawn = rows.filter(lot < int(SAMPLE / n * (1 << 30))).select("o", "v").collect()  # about SAMPLE rows, to fit pivots; all rows are placed
            made = _pivots(_unpacked([bytes(r.v) for r in sorted(drawn, key=lambda r: r.o)]), half, seed) if drawn else None
        most, chunk = max(1, CHUNK // 4), CHUNK

        def blocks(o: np.ndarray, v: list[bytes], names: np.ndarray) -> Iterator[tuple]:
            home, within = _near(_unpacked(v), *made, half) if made else (np.zeros(len(o), int), np.ones((len(o), 1), bool))
            whole = np.array([x[:1] == b"c" for x in v])
            for c in range(within.shape[1]):
                for at_home in (True, False):
                    of = within[:, c] & ((home == c) == at_home)
                    for kind in (whole, ~whole):
                        at = np.flatnonzero(of & kind)
                        for k in range(0, len(at), most):
                            part = at[k : k + most]
                            yield c, at_home, len(part), o[part], names[part], pa.compress(b"".join([v[r] for r in part]), "zstd", asbytes=True), sum(len(v[r]) for r in part)

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def made_of(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                t = pa.Table.from_batches(held)
                out = list(zip(*blocks(t.column(0).to_numpy(), t.column(1).to_pylist(), np.array(t.column(2).to_pylist(), object))))
                kinds = [pa.int32(), pa.bool_(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.binary(), pa.int64()]
                yield pa.record_batch([pa.array(x, k) for x, k in zip(out, kinds)], ["cell", "home", "n", "o", "names", "v", "bytes"])

            held: list[pa.RecordBatch] = []
            for batch in batches:
                held += [batch] if batch.num_rows else []
                if sum(b.num_rows for b in held) >= PART:
                    yield from made_of(held)
                    held = []
            if held:
                yield from made_of(held)

        placed = cut(rows.select("o", "v", "n").mapInArrow(place, "cell int, home boolean, n int, o array<bigint>, names array<string>, v binary, bytes bigint"), scope=outside)
    sizes = placed.groupBy("cell").agg(F.sum(F.when(F.col("home"), F.col("n")).otherwise(0)).alias("homed"), F.sum(F.when(F.col("home"), 0).otherwise(F.col("n"))).alias("sent")).filter("homed > 0").collect()  # a row a cell
    work = sum(r.homed * (r.homed / 2 + r.sent) for r in sizes)
    counts = spark.createDataFrame([(r.cell, -(-r.homed // chunk)) for r in sizes], "cell int, homes int")
    units = sum(h * (h + 1) // 2 for r in sizes for h in [-(-r.homed // chunk)])
    # a unit holds chunk a of a cell and meets chunk b >= a and, of the rows sent there, those that fall to b
    lot = F.pmod(F.xxhash64(F.element_at("o", 1), "bytes"), F.lit(1 << 30))
    sized = placed.join(F.broadcast(counts), "cell").withColumn("own", (lot % F.col("homes")).cast("int")).withColumn("lot", lot)
    rest = ["n", "o", "names", "v", "bytes"]
    last = F.col("homes") - 1
    held_ = sized.filter("home").select("cell", F.col("own").alias("a"), F.explode(F.sequence("own", last)).alias("b"), F.lit(0).alias("side"), *rest)
    met = sized.filter("home and own > 0").select("cell", F.explode(F.sequence(F.lit(0), F.col("own") - 1)).alias("a"), F.col("own").alias("b"), F.lit(1).alias("side"), *rest)
    sent = sized.filter("not home").select("cell", F.explode(F.sequence(F.lit(0), last)).alias("a"), "homes", "lot", *rest)
    met = met.unionByName(sent.select("cell", "a", (F.col("a") + F.col("lot") % (F.col("homes") - F.col("a"))).cast("int").alias("b"), F.lit(1).alias("side"), *rest))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def read(batch: pa.RecordBatch, r: int) -> tuple:
            v = _flat(pa.decompress(batch.column(7)[r].as_py(), batch.column(8)[r].as_py(), "zstd", asbytes=True), batch.column(4)[r].as_py())
            return batch.column(5)[r].values.to_numpy(), np.array(batch.column(6)[r].as_py(), object), v

        product, over = np.empty(TILE * TILE, np.float32), np.empty(TILE * TILE, bool)

        def pairs(x: tuple, y: tuple, same: bool) -> Iterator[pa.RecordBatch]:
            for low in range(0, len(x[0]), TILE):
                for left in range(low if same else 0, len(y[0]), TILE):
                    p, q = x[3][low : low + TILE], y[3][left : left + TILE]
                    at = len(p), len(q)
                    np.matmul(p, q.T, out=(sims := product[: at[0] * at[1]].reshape(at)))
                    maybe = np.flatnonzero(np.greater_equal(sims, threshold - 1e-5, out=over[: at[0] * at[1]].reshape(at)))
                    for k in range(0, len(maybe), TILE):
                        p, q = maybe[k : k + TILE] // at[1] + low, maybe[k : k + TILE] % at[1] + left
                        ok = x[0][p] > y[0][q] if same and low == left else x[0][p] != y[0][q]
                        if number_col:
                            n, m = x[1][p], y[1][q]
                            ok &= (n == "") | (m == "") | (n == m)
                        p, q = p[ok], q[ok]
                        sim = np.einsum("ij,ij->i", x[2][p].astype(np.float64), y[2][q].astype(np.float64))
                        o, other, sim = x[0][p][sim >= threshold], y[0][q][sim >= threshold], sim[sim >= threshold]
                        if len(o):
                            yield pa.record_batch([pa.array(np.maximum(o, other)), pa.array(np.minimum(o, other)), pa.array(sim)], ["i", "j", "similarity"])

        def whole(held: list[tuple]) -> tuple:
            o, names, v = (np.concatenate(x) for x in zip(*held))
            axes = _axes(v, threshold)
            return o, names, v, _bounds(v, axes), axes

        key: tuple | None = None
        held: list[tuple] = []
        block: tuple | None = None
        for batch in batches:
            c, a, b, s = (batch.column(k).to_numpy() for k in range(4))
            for r in range(batch.num_rows):
                if key != (c[r], a[r], b[r]):
                    if held and key[1] == key[2]:
                        block = whole(held)
                        yield from pairs(block, block, True)
                    key, held, block = (c[r], a[r], b[r]), [], None
                if s[r] == 0:
                    held.append(read(batch, r))
                elif held:
                    block, other = block or whole(held), read(batch, r)
                    yield from pairs(block, (*other, _bounds(other[2], block[4])), False)
        if held and key[1] == key[2]:
            block = whole(held)
            yield from pairs(block, block, True)

    tasks = max(1, min(units, 2 * spark.sparkContext.defaultParallelism), min(units, math.ceil(work / WORK)))
    arranged = held_.unionByName(met).repartition(tasks, "cell", "a", "b").sortWithinPartitions("cell", "a", "b", "side")
    found = arranged.mapInArrow(compare, "i bigint, j bigint, similarity double").groupBy("i", "j").agg(F.max("similarity").alias("similarity"))
    found = found.withColumn("copy", F.lit(False))
    return found if copies is None else found.unionByName(copies)


def resolve(edges: DataFrame) -> DataFrame:
    """``i`` of the rows that go, out of edges i, j with j < i. A row without edges stays, a copy goes.

    Each round, rows with an earlier neighbour that stays go, and rows whose earlier
    neighbours have all gone stay; the rest waits.
    """
    gone = cut(edges.filter("copy").select("i")) if "copy" in edges.columns else None
    left = cut((edges if gone is None else edges.filter("not copy")).select("i", "j").distinct())
    nodes = cut(left.select("i").distinct())
    kept = cut(left.select(F.col("j").alias("k")).distinct().join(nodes, F.col("k") == F.col("i"), "left_anti"))
    few = lambda df, n: F.broadcast(df) if n <= NODES else df  # noqa: E731 - 8 bytes a row
    while n_kept := kept.count():
        out = cut(left.join(few(kept.withColumnRenamed("k", "j"), n_kept), "j", "left_semi").select("i").distinct())
        gone = out if gone is None else gone.unionByName(out)
        n_out = out.count()
        rest = left.join(few(out, n_out), "i", "left_anti")
        waiting = cut(rest.join(few(out.withColumnRenamed("i", "j"), n_out), "j", "left_anti"))
        # rows that lost their last earlier neighbour stay
        kept = cut(rest.select("i").distinct().join(waiting.select("i").distinct(), "i", "left_anti").select(F.col("i").alias("k")))
        left = waiting
    return gone if gone is not None else nodes.limit(0)


def matches(edges: DataFrame, gone: DataFrame) -> DataFrame:
    """``i, duplicate_of, similarity``: for every row that goes the most similar row that stays, ties to the earliest.

    A copy has the neighbours of its first, as far as they are earlier than itself.
    """
    all_ = edges.select("i", "j", "similarity")
    if "copy" in edges.columns:
        copies = cut(edges.filter("copy").select("i", F.col("j").alias("first")))
        if not copies.isEmpty():
            plain = edges.filter("not copy")
            beside = plain.select(F.col("i").alias("first"), "j", "similarity").unionByName(plain.select(F.col("j").alias("first"), F.col("i").alias("j"), "similarity"))
            all_ = all_.unionByName(skew_join(copies, cut(beside), ["first"]).filter("j < i").select("i", "j", "similarity"))
    inside = all_.join(broadcast_if_small(gone), "i", "left_semi").join(broadcast_if_small(gone.select(F.col("i").alias("j"))), "j", "left_anti")
    best = F.max(F.struct("similarity", -F.col("j"))).alias("m")
    return inside.groupBy("i").agg(best).select("i", (-F.col("m.col2")).alias("duplicate_of"), F.col("m.similarity").alias("similarity"))


def edges_within(edges: DataFrame, kept: DataFrame) -> DataFrame:
    """The edges that similarity_edges() would give for the rows ``i`` of ``kept`` alone."""
    copies = edges.filter("copy").select("i", F.col("j").alias("class"))
    named = cut(kept.join(broadcast_if_small(cut(copies)), "i", "left").withColumn("class", F.coalesce("class", "i")))
    first = cut(named.groupBy("class").agg(F.min("i").alias("first")))
    again = named.join(broadcast_if_small(first), "class").filter("i <> first").select("i", F.col("first").alias("j"), F.lit(1.0).alias("similarity"), F.lit(True).alias("copy"))
    x, y = (broadcast_if_small(first.select(F.col("class").alias(c), F.col("first").alias(f"f{c}"))) for c in "ij")
    own = edges.filter("not copy").join(x, "i").join(y, "j").select(F.greatest("fi", "fj").alias("i"), F.least("fi", "fj").alias("j"), "similarity", "copy")
    return own.unionByName(again)


def lexical_overlap(a: Column, b: Column) -> Column:
    """The ratio of Python's SequenceMatcher on lower-cased texts, 4 places; for the few removed rows."""

    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([round(SequenceMatcher(None, (p or "").lower(), (q or "").lower()).ratio(), 4) for p, q in zip(x, y)], dtype="float64")

    return F.pandas_udf(run, "double")(a, b)


def greedy_dedup(pairs: DataFrame, ord_col: str, vector: str, threshold: float = 0.90) -> tuple[DataFrame, DataFrame]:
    """Pairs that stay, and a record per pair that goes with what it resembles."""
    numbered = pairs.select(ord_col, vector, answer_numbers(F.col("answer")).alias("_n"))
    with work_scope(pairs.sparkSession) as outside:
        edges = cut(similarity_edges(numbered, threshold, ord_col, vector, "_n"))
        gone = cut(resolve(edges), scope=outside)
        found = cut(matches(edges, gone), scope=outside)
    unique = pairs.join(broadcast_if_small(gone.withColumnRenamed("i", ord_col)), ord_col, "left_anti")
    # texts of the rows that take part, so that those of all others are shuffled once at most
    taking = found.select(F.col("i").alias(ord_col)).unionByName(found.select(F.col("duplicate_of").alias(ord_col))).distinct()
    texts = cut(pairs.select(ord_col, "question", "answer", "source", "page", "question_type", "quality_score").join(broadcast_if_small(taking), ord_col, "left_semi"), "zstd")
    text = texts.withColumnRenamed(ord_col, "_o")
    removed = found.join(text, found["i"] == text["_o"]).drop("_o").withColumnsRenamed({"question": "removed_question", "answer": "removed_answer"})
    other = texts.select(F.col(ord_col).alias("duplicate_of"), F.col("question").alias("duplicate_of_question"), F.col("answer").alias("duplicate_of_answer"))
    full = removed.join(other, "duplicate_of")
    overlap = lexical_overlap(F.col("removed_question"), F.col("duplicate_of_question"))
    return unique, full.withColumn("lexical_overlap", overlap).select("i", "removed_question", "removed_answer", "duplicate_of_question", "duplicate_of_answer", "similarity", "lexical_overlap", "source", "page", "question_type", "quality_score")


def removed_summary(duplicates: DataFrame) -> DataFrame:
    """Least, largest and upper median similarity of removals, and how many share little wording.

    Similarities have four places, so the median comes from at most 10,001 counts.
    """
    known = duplicates.filter("similarity is not null")
    counts = known.groupBy(F.round(F.col("similarity") * 10_000).cast("bigint").alias("s")).agg(F.count("*").alias("n"))
    run = counts.select("s", F.sum("n").over(Window.orderBy("s").rowsBetween(Window.unboundedPreceding, 0)).alias("upto"), F.sum("n").over(Window.partitionBy()).alias("all"))
    median = run.filter(F.col("upto") > F.floor(F.col("all") / 2)).agg(F.min("s").alias("median_similarity_1e4"))
    ends = known.agg(F.count("*").alias("removed"), F.round(F.min("similarity") * 10_000).cast("bigint").alias("least_similarity_1e4"), F.round(F.max("similarity") * 10_000).cast("bigint").alias("most_similarity_1e4"), F.count_if(F.col("lexical_overlap") < 0.6).alias("little_shared_wording"))
    return ends.crossJoin(median)  # one row each


def opener_diversity(pairs: DataFrame, order: Column, top: int = 12) -> DataFrame:
    """The commonest question openings: ``opener, n, total, distinct_openers``; ties to the first seen."""
    by = cut(pairs.select(opener(F.col("question")).alias("opener"), order.alias("o")).filter("opener is not null").groupBy("opener").agg(F.count("*").alias("n"), F.min("o").alias("first")))
    whole = by.agg(F.sum("n").alias("total"), F.count("*").alias("distinct_openers"))
    return by.orderBy(F.desc("n"), "first").limit(top).crossJoin(F.broadcast(whole)).select("opener", "n", "total", "distinct_openers")  # one row on the right
