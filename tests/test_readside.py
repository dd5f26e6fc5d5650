"""Passage resolution, lists and tables for reading, rates, files of a run, and the hourly stream."""

import json
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sievework.operators import agreement, budget, checkpoints, deliveries, explorer, grounding, ingest, judging, statistics, sweeps
from sievework.schemas import SCORES
from sievework.sources import files, sinks
from sievework.streaming.ingest import log_counts


def test_own_passage_counts_before_the_page(spark):
    pairs = spark.createDataFrame(
        [(1, "The crop dries 9 days", "a.pdf", 1, "Crop dries for 9 days."), (2, "The crop dries 9 days", "a.pdf", 1, ""), (3, "The crop dries 9 days", "A.PDF", 2, None), (4, "", None, None, None)],
        "id int, answer string, source string, page int, chunk_text string",
    )
    pages = spark.createDataFrame([("a.pdf", 1, "the crop"), ("a.pdf", 1, "takes 8 days")], "source string, page int, text string")
    got = {r.id: r for r in grounding.with_findings(grounding.checked_either(pairs, pages, "id")).collect()}
    assert [got[i].passage_from for i in (1, 2, 3, 4)] == ["own", "page", "none", "none"]
    assert (got[1].answer_words, got[1].matched_words, got[1].has_unsupported_number) == (3, 3, False)
    assert (got[2].matched_words, got[2].has_unsupported_number) == (2, True) and not got[3].passage_found
    one = grounding.coverage(grounding.checked_either(pairs, pages, "id")).first()
    assert (one.analysed, one.not_matched) == (2, 2)
    assert grounding.checked_either(pairs.limit(0), pages, "id").count() == 0


def _found(spark):
    rows = [(1, True, 0.2, True, 4, "factual"), (2, True, 0.9, False, None, "factual"), (3, False, 0.0, True, 6, "definitional"), (4, True, 0.5, True, 6, "procedural")]
    return spark.createDataFrame(rows, "id int, passage_found boolean, lexical_overlap double, has_unsupported_number boolean, quality_score int, question_type string")


def test_lists_for_reading(spark):
    found = _found(spark)
    assert {r.id for r in explorer.judged_and_matched(found).collect()} == {1, 4}
    assert {r.id for r in explorer.unsupported_numbers(found).collect()} == {1, 4}
    assert [r.id for r in explorer.lowest_overlap(found, [F.col("id")], 2).collect()] == [1, 4]
    assert explorer.weakest_type(found.filter("passage_found")).first().question_type == "procedural"
    table = spark.createDataFrame([(i,) for i in range(60)], "k int")
    assert [(r.k, r.ord) for r in explorer.page_of(table, [F.desc("k")], 2).collect()] == [(59 - i, i) for i in range(50, 60)]
    assert explorer.page_of(table, [F.col("k")], 9).count() == 0


def test_abstention_tables(spark):
    rows = [("q1", "s", 1, True, (True, True, True)), ("q2", "s", None, False, (False, True, True)), ("q3", None, 2, None, None), ("q4", "s", 1, True, (True, False, True))]
    un = spark.createDataFrame(rows, "question string, source string, page int, in_dataset boolean, abstention_check struct<unanswerable boolean, plausible boolean, abstention_answer boolean>")
    got = {r.question: (r.outcome, r.note) for r in explorer.abstention_table(un).collect()}
    assert got["q1"] == ("passed", None) and got["q3"][0] == "not_assessed" and got["q2"][0] == got["q4"][0] == "failed" and got["q2"][1] != got["q4"][1]
    final = spark.createDataFrame([(True,), (False,), (None,)], "answerable boolean")
    assert tuple(statistics.abstention_block(un, final).first()) == (4, 4, 1, 1, 2)
    assert statistics.abstention_block(un, final, F.lit(9)).first().requested == 9


def test_rates(spark):
    final = spark.createDataFrame([(True,), (None,), (False,)], "answerable boolean")
    rejected = spark.createDataFrame([(True, 2), (True, None), (False, 0)], "answerable boolean, quality_score int")
    got = {r.answerable: (r.passed, r.assessed, r.pass_rate) for r in statistics.answerable_rates(final, rejected).collect()}
    assert got == {True: (2, 3, 666), False: (1, 2, 500)}
    log = spark.createDataFrame([("a", "{}"), ("a", "{"), ("b", None), ("c", "{}")], "chunk_key string, payload string")
    one = statistics.per_chunk(log, checkpoints.broken(F.col("payload")), final).first()
    assert (one.chunks, one.failed_chunks, one.failed_share, one.pairs_a_chunk_1e2) == (3, 1, 333, 100)
    assert statistics.per_chunk(log.limit(0), F.lit(True), final.limit(0)).first().failed_share == 0


def test_kappas_of_criteria_and_of_the_keep_rule(spark):
    rows = [((2, 2, 2), (2, 2, 1)), ((2, 1, 1), (0, 1, 1)), ((0, 0, 0), (0, 0, 1)), ((1, 2, 2), (1, 2, 2)), ((2, 2, 1), (2, 2, 0)), (None, (2, 2, 2))]
    df = spark.createDataFrame(rows, f"a {SCORES}, b {SCORES}")
    by = {r.criterion: r for r in agreement.criteria_kappas(df, "a", "b").collect()}
    assert by["groundedness"].n == 5 and by["groundedness"].agree == 4 and by["specificity"].kappa == 1.0
    weakest = explorer.weakest_kappa(agreement.criteria_kappas(df, "a", "b")).first()
    assert weakest.criterion == "completeness" and weakest.kappa == min(r.kappa for r in by.values()) and weakest.warn == (weakest.kappa < 0.4)
    kept = agreement.keep_agreement(df, "a", "b").first()
    assert (kept.n, kept.agree) == (6, 3)


def test_least_similar_removals(spark):
    edges = spark.createDataFrame([(1, 0, 0.8), (2, 0, 0.9), (3, 0, 0.76), (4, 0, 0.96), (5, 0, 0.79), (5, 3, 0.99)], "i bigint, j bigint, similarity double")
    got = {(r.threshold, r.nth): r.i for r in sweeps.least_similar_removals(edges, (0.75, 0.95)).collect()}
    assert got == {(0.75, 1): 3, (0.75, 2): 5, (0.75, 3): 1, (0.95, 1): 4, (0.95, 2): 5}


def test_work_left_and_stale_runs(spark):
    pairs = spark.createDataFrame([("q1",), ("q2",), ("q2",)], "question string")
    assert [r.question for r in judging.unscored(pairs, spark.createDataFrame([("q2",), ("q9",)], "question string")).collect()] == ["q1"]
    rows = spark.createDataFrame([(True, 421), (True, 420), (False, 900)], "running boolean, age int")
    assert [r[0] for r in rows.select(budget.stale(F.col("running"), F.col("age"))).collect()] == [True, False, False]


def test_files_of_a_run(spark, tmp_path):
    sinks.write_grounding(_found(spark), spark.createDataFrame([(3, 1)], "analysed int, weak int"), str(tmp_path))
    assert spark.read.json(f"{tmp_path}/grounding_records.jsonl").count() == 4 and spark.read.json(f"{tmp_path}/grounding_summary.json").first().weak == 1
    sinks.write_stats(spark.createDataFrame([(5, 2)], "final int, rejected int"), str(tmp_path), per_type=spark.createDataFrame([("a", 1), (None, 2)], "t string, n int"))
    stats = json.loads(spark.read.text(f"{tmp_path}/pipeline_stats.json").first()[0])
    assert stats["final"] == 5 and sorted(x["n"] for x in stats["per_type"]) == [1, 2]
    assert sinks.file_facts(spark, [f"{tmp_path}/pipeline_stats.json"]).first().changed > datetime(2020, 1, 1)
    checkpoints.clear(spark, f"{tmp_path}/pipeline_stats.json", f"{tmp_path}/never.there")
    assert not Path(f"{tmp_path}/pipeline_stats.json").exists()


def test_every_upload_gets_a_status(spark):
    rows = [(f"f{i:04}.txt", "txt", 10, b"words") for i in range(1200)]
    got = {r.source_file: r.status for r in files.upload_status(spark.createDataFrame(rows, "source_file string, suffix string, length bigint, content binary")).collect()}
    assert len(got) == 1200 and [k for k, v in got.items() if v == "saved"] == [f"f{i:04}.txt" for i in range(8)]


def _docx(paragraphs):
    import io
    import zipfile

    body = "".join(f"<w:p><w:r><w:t>{p}</w:t><w:tab/><w:t>end</w:t></w:r></w:p>" for p in paragraphs)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f'<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:body>{body}<w:tbl><w:tr><w:tc><w:p><w:r><w:t>cell</w:t></w:r></w:p></w:tc></w:tr></w:tbl></w:body></w:document>')
    return out.getvalue()


def test_docx_pages(spark):
    assert files.docx_pages(_docx(["Dry &amp; store", "Zé"])) == ["Dry & store\tend\n\nZé\tend\n\ncell"]
    assert len(files.docx_pages(_docx(["x" * 1000] * 9))) == 5 and files.docx_pages(_docx([])) == ["cell"]
    found = spark.createDataFrame([("a.docx", "docx", bytearray(_docx(["One", "Two"]))), ("b.docx", "docx", bytearray(b"no zip")), ("c.txt", "txt", bytearray(b"x"))], "source_file string, suffix string, content binary")
    wanted = spark.createDataFrame([("a.docx", 0), ("b.docx", 0)], "source_file string, page int")
    assert [(r.source_file, r.page, r.page_content) for r in files.read_paged(found, "docx", files.docx_pages, wanted).collect()] == [("a.docx", 0, "One\tend\n\nTwo\tend\n\ncell")]
    with pytest.raises(Exception):
        files.read_paged(found, "docx", files.docx_pages).collect()


def test_pages_of_a_long_text():
    paras = [f"para {i}x{'x' * (i % 50)}" for i in range(20_000)]
    pages = ingest.pages_of("\n\n".join(paras), 300)
    assert "\n\n".join(pages) == "\n\n".join(paras) and all(len(p) <= 302 for p in pages)  # the blank line is not counted
    assert ingest.pages_of("  \n\n ") == [] and ingest.pages_of("a\r\n\r\nb") == ["a\n\nb"]
    assert ingest.pages_of("y" * 900, 300) == ["y" * 900]


@pytest.mark.parametrize("limit", [10**6, 0])
def test_latest_deliveries(spark, monkeypatch, limit):
    monkeypatch.setattr("sievework.session.BROADCAST_ROWS", limit)
    rows = [(1, "old", 1), (1, "new", 2), (2, "a", None), (2, "b", 1), (3, "x", 5), (3, "y", 5), (None, "z", 1), (4, None, None)]
    df = spark.createDataFrame(rows, "id int, text string, at int").withColumn("_n", F.lit("clash")).drop("_n")
    assert {(r.id, r.text) for r in deliveries.latest(df, "id", F.col("at")).collect()} == {(1, "new"), (2, "b"), (3, "y"), (4, None)}
    assert sorted((r.id, str(r.text)) for r in deliveries.without_older(df, "id", F.col("at")).collect()) == [(1, "new"), (2, "b"), (3, "x"), (3, "y"), (4, "None")]
    assert deliveries.latest(df.limit(0), "id", F.col("at")).count() == 0


def test_calls_by_the_hour_as_a_stream(spark, tmp_path):
    rows = [(f"k{i % 4}", "run", datetime(2025, 1, 1, i % 3, 5)) for i in range(30)]
    spark.createDataFrame(rows, "chunk_key string, fingerprint string, appended_at timestamp").write.parquet(f"{tmp_path}/log")
    log = spark.readStream.schema("chunk_key string, fingerprint string, appended_at timestamp").parquet(f"{tmp_path}/log")
    query = log_counts(log).writeStream.format("memory").queryName("by_hour").outputMode("complete").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    query.awaitTermination(60)
    got = spark.sql("select calls, keys from by_hour").collect()
    assert [r.calls for r in got] == [10] * 3 and all(3 <= r["keys"] <= 4 for r in got)
