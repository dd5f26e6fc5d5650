"""Files out."""

from __future__ import annotations

import io
import json
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.functions.text import strip
from sievework.operators.statistics import assert_no_internals, chat_records, clean_records


#: Rows of a table that the statistics hold.
STATS_ROWS = 10_000


def write_jsonl(df: DataFrame, path: str, order: list[Column] | None = None, single: bool = False) -> None:
    """JSON lines with nulls written out; ``single`` for one file, for small tables only."""
    rows = df.orderBy(*order) if order else df
    (rows.coalesce(1) if single else rows).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header."""
    df.write.mode("overwrite").option("header", "true").option("escape", '"').csv(path)


def csv_with_bom(df: DataFrame, limit: int = 100_000) -> bytes:
    """A small table as one CSV with a byte order mark, for spreadsheets; an error beyond ``limit`` rows."""
    rows = df.limit(limit + 1).toPandas()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} rows; use write_csv")
    return rows.to_csv(index=False).encode("utf-8-sig")


def export_run(final: DataFrame, rejected: DataFrame, graded: DataFrame, duplicates: DataFrame, unanswerable: DataFrame, folder: str, order: list[Column]) -> None:
    """All files of a run. Only the graded file keeps passages."""
    exported = clean_records(final)
    assert_no_internals(exported)
    write_jsonl(exported, f"{folder}/synthetic_dataset.jsonl")
    write_jsonl(chat_records(final), f"{folder}/synthetic_dataset_chatml.jsonl")
    write_jsonl(rejected.drop("chunk_text"), f"{folder}/rejected_pairs.jsonl")
    write_jsonl(graded, f"{folder}/graded_pairs.jsonl", order)
    write_jsonl(duplicates, f"{folder}/duplicate_pairs.jsonl")
    write_jsonl(unanswerable, f"{folder}/unanswerable_pairs.jsonl")


def write_grounding(found: DataFrame, summary: DataFrame, folder: str) -> None:
    """Grounding records and their summary, one JSON object."""
    write_jsonl(found, f"{folder}/grounding_records.jsonl")
    write_jsonl(summary, f"{folder}/grounding_summary.json", single=True)  # one row


def write_stats(counted: DataFrame, folder: str, **more: DataFrame) -> None:
    """All statistics of a run as one JSON object: the counts, and a list of objects for each further table."""
    one = {**counted.first().asDict(), **{k: [r.asDict(recursive=True) for r in t.limit(STATS_ROWS).collect()] for k, t in more.items()}}
    text = json.dumps(one, ensure_ascii=False, default=str)
    counted.sparkSession.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/pipeline_stats.json")


def file_facts(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``path, there, size, records, changed``: records are lines that are not blank; changed is when it was written last."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    rows = []
    for p in paths:
        at = jvm.org.apache.hadoop.fs.Path(p)
        fs = at.getFileSystem(conf)
        there = fs.exists(at)
        size = fs.getContentSummary(at).getLength() if there else 0
        n = spark.read.text(p).filter(F.length(strip(F.col("value"))) > 0).count() if there and size else 0
        changed = fs.getFileStatus(at).getModificationTime() if there else None
        rows.append((p, there, size, n, changed))
    facts = spark.createDataFrame(rows, "path string, there boolean, size bigint, records bigint, _ms bigint")
    return facts.withColumn("changed", F.timestamp_millis("_ms")).drop("_ms")


def archive(folder: str, facts: list[dict]) -> bytes:
    """A ZIP of the small files below a local folder with a manifest."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(Path(folder).rglob("*")):
            if p.is_file() and not p.name.startswith((".", "_")):
                z.write(p, p.relative_to(folder).as_posix())
        z.writestr("MANIFEST.json", json.dumps(facts, indent=1, default=str))
    return out.getvalue()
