"""Files in: documents, JSON lines under three policies, uploads, listings."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable, Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.functions.text import strip
from sievework.operators.ingest import file_name, pages_of, pseudo_pages
from sievework.schemas import PAGE, SCORES

#: What may be read, and what an upload may be.
TEXT_SUFFIXES, PAGED_SUFFIXES = ("txt", "md", "markdown"), ("pdf", "docx")
MAX_UPLOADS, MAX_UPLOAD_MB, PROBE_PAGES = 8, 50, 3

#: A page reader: file bytes to the texts of its pages, in order; it may raise.
PageReader = Callable[[bytes], list[str]]


def scan(spark: SparkSession, folder: str) -> DataFrame:
    """Readable files of a folder and below: ``path, source_file, suffix, length, content``; an error if there is none."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    suffix = F.lower(F.regexp_extract("path", r"\.([^./\\]+)$", 1))
    found = files.select("path", file_name(F.col("path")).alias("source_file"), suffix.alias("suffix"), "length", "content").filter(F.col("suffix").isin(*TEXT_SUFFIXES, *PAGED_SUFFIXES))
    if found.select("path").isEmpty():
        raise FileNotFoundError(f"no readable file in {folder}")
    return found


def text_pages(files: DataFrame) -> DataFrame:
    """Pseudo-pages of text and Markdown files; bytes that are no UTF-8 are replaced."""
    texts = files.filter(F.col("suffix").isin(*TEXT_SUFFIXES)).select("source_file", F.call_function("make_valid_utf8", F.col("content").cast("string")).alias("content"))
    return pseudo_pages(texts).select("source_file", "page", "page_content")


def read_paged(files: DataFrame, suffix: str, reader: PageReader, wanted: DataFrame | None = None) -> DataFrame:
    """Pages of files that know pages (or of one text, with pseudo-pages after it), by a given reader.

    ``wanted`` may name the pages to read (source_file, page); then blank pages and files that
    fail are skipped, and page numbers stay true. Without it a failing file fails the query.
    """
    own = files.filter(F.col("suffix") == suffix)
    if wanted is not None:
        picks = wanted.groupBy("source_file").agg(F.collect_set("page").alias("picks"))
        own = own.join(picks, "source_file")
    else:
        own = own.withColumn("picks", F.lit(None).cast("array<int>"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for name, content, picks in zip(pdf["source_file"], pdf["content"], pdf["picks"]):
                try:
                    texts = reader(bytes(content))
                except Exception:
                    if picks is None:
                        raise
                    continue
                chosen = range(len(texts)) if picks is None else sorted(p for p in picks if 0 <= p < len(texts))
                rows += [(name, i, texts[i]) for i in chosen if picks is None or texts[i].strip()]
            yield pd.DataFrame(rows, columns=["source_file", "page", "page_content"])

    return own.select("source_file", "content", "picks").mapInPandas(run, PAGE)


_WORDS = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


def docx_pages(content: bytes) -> list[str]:
    """A page reader for DOCX: the text of all paragraphs in order, tables included, in pages of whole paragraphs.

    Tabs and line breaks stay. A file that is no DOCX raises an error.
    """
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        root = ElementTree.fromstring(z.read("word/document.xml"))
    own = {f"{_WORDS}tab": "\t", f"{_WORDS}br": "\n", f"{_WORDS}cr": "\n"}
    paras = ["".join((x.text or "") if x.tag == f"{_WORDS}t" else own.get(x.tag, "") for r in p.iter(f"{_WORDS}r") for x in r) for p in root.iter(f"{_WORDS}p")]
    return pages_of("\n\n".join(paras))


def page_counts(files: DataFrame, suffix: str, counter: Callable[[bytes], int]) -> DataFrame:
    """``source_file, pages``; 0 where a file can't be read."""

    def count(contents: pd.Series) -> pd.Series:
        def one(c: bytes) -> int:
            try:
                return int(counter(bytes(c)))
            except Exception:
                return 0

        return contents.map(one)

    return files.filter(F.col("suffix") == suffix).select("source_file", F.pandas_udf(count, "int")("content").alias("pages"))


def listing(files: DataFrame) -> DataFrame:
    """Name, type, size in MB and how it is cut into pages."""
    note = F.when(F.col("suffix") == "pdf", "real page numbers").otherwise("split into pages of about 3000 characters")
    return files.select(F.col("source_file").alias("name"), F.upper("suffix").alias("type"), F.round(F.col("length") / 1e6, 2).alias("size_mb"), note.alias("note"))


def upload_status(files: DataFrame) -> DataFrame:
    """``source_file, status`` of uploads: saved, or why not. The first eight by name count."""
    first = files.select("source_file").orderBy("source_file").limit(MAX_UPLOADS).agg(F.max("source_file").alias("_last"))
    text = strip(F.call_function("make_valid_utf8", F.col("content").cast("string")))
    status = (
        F.when(F.col("source_file") > F.col("_last"), "too many files").when(~F.col("suffix").isin(*TEXT_SUFFIXES, *PAGED_SUFFIXES), "unsupported type").when(F.col("length") > MAX_UPLOAD_MB * 1_000_000, "too large")
        .when(F.col("suffix").isin(*TEXT_SUFFIXES) & (F.length(text) == 0), "no readable text").otherwise("saved")
    )
    return files.crossJoin(F.broadcast(first)).select("source_file", status.alias("status"))  # one row on the right


def probe(pages: DataFrame, total_pages: DataFrame) -> DataFrame:
    """Estimated characters of each file from its first three pages: ``source_file, pages, chars``."""
    head = pages.filter(F.col("page") < PROBE_PAGES).groupBy("source_file").agg(F.sum(F.length("page_content")).alias("c"), F.count("*").alias("n"))
    return total_pages.join(head, "source_file", "left").select("source_file", "pages", F.floor(F.coalesce(F.col("c") / F.col("n"), F.lit(0.0)) * F.col("pages")).cast("bigint").alias("chars"))


def read_jsonl(spark: SparkSession, path: str, schema: str, policy: str = "skip") -> DataFrame:
    """JSON lines with a declared schema. Broken lines are skipped (``skip``) or fail the read (``fail``)."""
    return spark.read.schema(schema).option("mode", {"skip": "DROPMALFORMED", "fail": "FAILFAST"}[policy]).json(path)


def read_jsonl_until_broken(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The JSON lines of one file before its first broken one."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\r?\n")).alias("at", "line")).filter("line <> ''")
    got = lines.select("at", F.from_json("line", schema).alias("r"), F.try_parse_json("line").isNull().alias("bad"))
    stop = got.filter("bad").agg(F.min("at").alias("stop"))
    return got.crossJoin(F.broadcast(stop)).filter(F.col("stop").isNull() | (F.col("at") < F.col("stop"))).select("r.*")  # one row on the right


def read_json_object(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One JSON object over several lines."""
    return spark.read.schema(schema).option("multiLine", "true").json(path)


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """A JSON object from question to scores, as rows."""
    whole = spark.read.text(path, wholetext=True).select(F.from_json("value", f"map<string, {SCORES}>").alias("m"))
    return whole.select(F.explode("m").alias("question", "scores"))
