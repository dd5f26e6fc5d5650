"""Pages, chunks, the boilerplate filter, and samples of pages and chunks."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.functions.text import stripped_length
from sievework.operators.ordinals import with_ordinal
from sievework.session import broadcast_if_small, cut

#: Sizes in characters.
MIN_PAGE, MIN_CHUNK, PAGE_CHARS, CHUNK_SIZE, CHUNK_OVERLAP, SCANNED_BELOW = 200, 100, 3000, 600, 80, 100
SEPARATORS = ("\n\n", "\n", ". ", "; ")

#: Patterns of text that is not worth a question.
DOT_LEADER = r"\.{5,}"
FRONT_MATTER = (
    r"ISBN|CC BY-NC-SA|©|All rights reserved|WHO Press|book-orders"
    r"|rights and licensing|mediation rules|Suggested citation"
    r"|Cataloguing-in-Publication|Design and layout|Printed in"
    r"|General disclaimers|designations employed|do not imply the expression"
    r"|legal status of any country|delimitation of its frontiers"
    r"|dotted and dashed lines|approximate border lines"
    r"|endorsed or recommended by WHO|preference to those of a similar nature"
    r"|preference to others of a similar nature"
    r"|distinguished by initial capital letters|third-party-owned component"
    r"|interpretation and use of the material|shall WHO be liable"
    r"|liable for damages|views expressed .{0,30}named authors"
)
LINK = r"doi\.org|https?://"
JOURNAL = r"\b(19|20)\d{2}[;:]\s?\d+|\bLancet\b|\bN Engl J Med\b|\bPLoS\b|\bBMJ\b|\bJ Acquir\b|\bClin Infect Dis\b"
NAME_AFFILIATION = r"[A-Z][a-z]+(?:\s+[A-Z][a-zA-Z.'\-]+)+\s*\("
REASONS = ("table_of_contents", "front_matter", "reference_list", "contributor_list", "numeric_table")


def file_name(path: Column) -> Column:
    """The last part of a path."""
    return F.element_at(F.split(path, r"[/\\]"), -1)


def keep_pages(pages: DataFrame, text: str = "page_content") -> DataFrame:
    """Pages with at least 200 characters between their ends."""
    return pages.filter(stripped_length(F.col(text)) >= MIN_PAGE)


def pages_of(text: str, page_chars: int = PAGE_CHARS) -> list[str]:
    """Pages of whole paragraphs of one text, stripped, without blank ones."""
    pages: list[list[str]] = []
    size = 0
    for para in text.replace("\r\n", "\n").strip().split("\n\n"):
        if size and size + len(para) > page_chars:
            size = 0
        if size:
            pages[-1].append(para)
            size += len(para) + 2
        else:
            pages.append([para])
            size = len(para)
    return [p for p in ("\n\n".join(p).strip() for p in pages) if p]


def pseudo_pages(files: DataFrame, text: str = "content", page_chars: int = PAGE_CHARS) -> DataFrame:
    """Cut unpaged texts into pages of whole paragraphs: ``page`` from 0 and ``page_content`` beside the other columns.

    A page is closed when the next paragraph would make it longer than ``page_chars``; a
    paragraph is never divided. Texts that are null or blank give no page.
    """
    rest = [c for c in files.columns if c != text]
    kinds = dict(files.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 64):  # some texts are long
                part = batch.slice(low, 64)
                pages = [pages_of(t or "", page_chars) for t in part.column(0).to_pylist()]
                at = pa.array([i for i, p in enumerate(pages) for _ in p], pa.int64())
                numbers = pa.array([n for p in pages for n in range(len(p))], pa.int32())
                own = [part.column(k + 1).take(at) for k in range(len(rest))]
                yield pa.record_batch([*own, numbers, pa.array([x for p in pages for x in p], pa.string())], [*rest, "page", "page_content"])

    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in rest), "page int", "page_content string"])
    return files.select(text, *rest).mapInArrow(run, schema)


def window_chunks(pages: DataFrame, keys: list[str], text: str = "page_content", size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> DataFrame:
    """Windows of ``size`` characters, ``size - overlap`` apart: keys, ``start_index``, ``page_content``."""
    stride = size - overlap
    starts = F.when(F.length(text) > 0, F.sequence(F.lit(0), F.length(text) - 1, F.lit(stride))).otherwise(F.array().cast("array<int>"))
    # cut inside the array, so that the whole text isn't repeated for every window
    windows = F.transform(starts, lambda s: F.struct(s.alias("start_index"), F.substring(F.col(text), s + 1, F.lit(size)).alias("page_content")))
    return pages.select(*keys, F.inline(windows))


def _split_points(text: str, low: int, high: int, size: int, separators: tuple[str, ...]) -> Iterator[tuple[int, int]]:
    """Pieces of text[low:high], at most ``size`` long where a separator allows it; separators stay at piece starts."""
    if high - low <= size or not separators:
        yield low, high
        return
    sep, rest = separators[0], separators[1:]
    at = text.find(sep, low + 1, high)
    if at < 0:
        yield from _split_points(text, low, high, size, rest)
        return
    begin = low
    while at >= 0:
        yield from _split_points(text, begin, at, size, rest)
        begin, at = at, text.find(sep, at + len(sep), high)
    yield from _split_points(text, begin, high, size, rest)


def recursive_chunks_of(text: str, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP, separators: tuple[str, ...] = SEPARATORS) -> list[tuple[int, str]]:
    """Start and text of chunks: pieces cut at the coarsest separators, merged up to ``size``.

    Each chunk after the first begins with the last pieces of the one before, as far as these
    are at most ``overlap`` long. Chunks are stripped; blank ones are left out.
    """
    out: list[tuple[int, str]] = []
    held: list[tuple[int, int]] = []

    def close() -> None:
        raw = text[held[0][0] : held[-1][1]]
        bare = raw.strip()
        if bare:
            out.append((held[0][0] + raw.index(bare), bare))

    for low, high in _split_points(text, 0, len(text), size, separators):
        if held and high - held[0][0] > size:
            close()
            while held and (held[-1][1] - held[0][0] > overlap or high - held[0][0] > size):
                held.pop(0)
        held.append((low, high))
    if held:
        close()
    return out


def recursive_chunks(pages: DataFrame, keys: list[str], text: str = "page_content", size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> DataFrame:
    """recursive_chunks_of() over a table: keys, ``start_index``, ``page_content``."""
    kinds = dict(pages.dtypes)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(i, s, c) for i, t in enumerate(pdf[text]) for s, c in recursive_chunks_of(t or "", size, overlap)]
            at = pd.Index([r[0] for r in rows], dtype="int64")
            yield pdf[keys].take(at).assign(start_index=[r[1] for r in rows], page_content=[r[2] for r in rows])

    schema = ", ".join(f"`{k}` {kinds[k]}" for k in keys) + ", start_index int, page_content string"
    return pages.select(*keys, text).mapInPandas(run, schema)


def keep_chunks(chunks: DataFrame) -> DataFrame:
    """Chunks with at least 100 characters between their ends."""
    return chunks.filter(stripped_length(F.col("page_content")) >= MIN_CHUNK)


def boilerplate_reason(c: Column) -> Column:
    """What makes a chunk boilerplate, the first that applies; null for content."""
    digits = F.regexp_count(c, F.lit(r"\p{Nd}"))
    return (
        F.when(c.rlike(DOT_LEADER), REASONS[0])
        .when(c.rlike(f"(?iud){FRONT_MATTER}"), REASONS[1])
        .when(c.rlike(f"(?iu){LINK}") & c.rlike(f"(?iu){JOURNAL}"), REASONS[2])
        .when(F.regexp_count(c, F.lit(NAME_AFFILIATION)) >= 3, REASONS[3])
        .when(digits * 4 > F.length(c), REASONS[4])
    )


def drop_boilerplate(chunks: DataFrame, active: bool = True) -> DataFrame:
    """Chunks that are content; all of them if not ``active``."""
    return chunks.filter(boilerplate_reason(F.col("page_content")).isNull()) if active else chunks


def boilerplate_report(chunks: DataFrame) -> DataFrame:
    """Chunks by reason; reason null stands for content."""
    return chunks.groupBy(boilerplate_reason(F.col("page_content")).alias("reason")).agg(F.count("*").alias("chunks"))


def scan_quality(pages: DataFrame, source: str, text: str) -> DataFrame:
    """Per source: pages, characters, characters a page (whole), and whether it looks scanned."""
    by = pages.groupBy(source).agg(F.count("*").alias("pages"), F.sum(F.length(F.coalesce(F.col(text), F.lit("")))).alias("chars"), F.count_if(stripped_length(F.col(text)) >= MIN_PAGE).alias("kept_pages"))
    return by.withColumn("chars_per_page", F.expr("chars div pages")).withColumn("scanned", F.col("chars_per_page") < SCANNED_BELOW)


def page_budget(max_chunks: int) -> int:
    """Pages to read for so many chunks."""
    return max(8, int(max_chunks / 3 / 0.75 * 1.8))


def sampled_pages(counts: DataFrame, budget: int) -> DataFrame:
    """Page indices to read of every source, from ``source_file, pages``: all if they fit the budget.

    Otherwise each gets its share, three at least, evenly spaced; indices come as ``page``.
    """
    total = counts.agg(F.sum("pages").alias("total"))
    share = F.greatest(F.lit(3), F.bround(F.lit(float(budget)) * F.col("pages") / F.col("total")).cast("int"))
    all_pages = (F.col("total") <= budget) | (share >= F.col("pages"))
    n = F.when(all_pages, F.col("pages")).otherwise(share)
    wide = counts.crossJoin(F.broadcast(total)).filter("pages > 0").select("source_file", "pages", n.cast("int").alias("n"))  # one row on the right
    page = F.floor(F.col("i") * (F.col("pages").cast("double") / F.col("n").cast("double"))).cast("int")
    return wide.select("source_file", "pages", "n", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("i")).select("source_file", page.alias("page")).distinct()


def evenly_spaced(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """``k`` rows evenly spaced in ``order``; all if there are not more or k is 0. Adds ``ord``.

    Row i of the sample is row floor(i * (n / k)), in doubles and in this order of operations.
    """
    numbered = cut(with_ordinal(df, order))
    n = numbered.count()
    if k <= 0 or k >= n:
        return numbered
    wanted = df.sparkSession.range(k).select(F.floor(F.col("id") * F.lit(float(n) / float(k))).cast("bigint").alias("ord")).distinct()
    return numbered.join(broadcast_if_small(wanted), "ord", "left_semi")


def chunk_estimate(chars: Column) -> Column:
    """About how many chunks so many characters make."""
    return F.floor(chars / F.lit(520) * F.lit(0.8)).cast("bigint")


def chunk_key(source: Column, page: Column, start: Column) -> Column:
    """Source, page and start joined by a bar; what is missing is ?, 0 and 0."""
    return F.concat_ws("|", F.coalesce(source, F.lit("?")), F.coalesce(page, F.lit(0)).cast("string"), F.coalesce(start, F.lit(0)).cast("string"))


def source_chunk_counts(chunks: DataFrame, source: str) -> DataFrame:
    return chunks.groupBy(source).agg(F.count("*").alias("chunks"))

