import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F

from sievework.operators import generation
from sievework.plans import catalogue, pipeline
from sievework.schemas import DATASET, PAGE
from sievework.sources import external, files, sinks
from sievework.streaming.ingest import page_stream, stream_chunks


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "b.TXT").write_bytes(b"First para.\r\n\r\nSecond \xff para." + b" x" * 2000)
    (tmp_path / "a.md").write_text("# Head\n\nText")
    (tmp_path / "c.pdf").write_bytes(b"page one\fpage two\f \fpage four")
    (tmp_path / "d.pdf").write_bytes(b"broken")
    (tmp_path / "skip.exe").write_bytes(b"x")
    (tmp_path / "empty.txt").write_bytes(b"  ")
    return str(tmp_path)


def make_reader():
    def reader(content):
        if content == b"broken":
            raise ValueError("broken")
        return content.decode().split("\f")

    return reader


def test_scan_and_pages(spark, folder, tmp_path):
    found, reader = files.scan(spark, folder), make_reader()
    assert sorted(r.source_file for r in found.collect()) == ["a.md", "b.TXT", "c.pdf", "d.pdf", "empty.txt"]
    pages = files.text_pages(found).collect()
    assert {p.source_file for p in pages} == {"a.md", "b.TXT"} and any("\ufffd" in p.page_content for p in pages)
    with pytest.raises(Exception):
        files.read_paged(found, "pdf", reader).collect()
    wanted = spark.createDataFrame([("c.pdf", 3), ("c.pdf", 2), ("c.pdf", 0), ("d.pdf", 0), ("c.pdf", 9)], "source_file string, page int")
    assert sorted((p.page, p.page_content) for p in files.read_paged(found, "pdf", reader, wanted).collect()) == [(0, "page one"), (3, "page four")]
    assert {r.source_file: r.pages for r in files.page_counts(found, "pdf", lambda c: len(reader(c))).collect()} == {"c.pdf": 4, "d.pdf": 0}
    assert {r.source_file: r.status for r in files.upload_status(found).collect()}["empty.txt"] == "no readable text"
    assert {r.name: r.type for r in files.listing(found).collect()}["b.TXT"] == "TXT"
    (tmp_path / "none").mkdir()
    with pytest.raises(Exception):
        files.scan(spark, str(tmp_path / "none"))


def test_probe(spark):
    pages = spark.createDataFrame([("a", i, "x" * 100) for i in range(9)], PAGE)
    total = spark.createDataFrame([("a", 9), ("b", 4)], "source_file string, pages int")
    assert {r.source_file: r.chars for r in files.probe(pages, total).collect()} == {"a": 900, "b": 0}


def test_jsonl_policies(spark, tmp_path):
    p = tmp_path / "x.jsonl"
    p.write_text('{"question":"a","page":1}\n{"question":"b"\n\n{"question":"c","quality_score":null}\n')
    assert sorted(r.question for r in files.read_jsonl(spark, str(p), DATASET).collect()) == ["a", "c"]
    assert [r.question for r in files.read_jsonl_until_broken(spark, str(p), DATASET).collect()] == ["a"]
    with pytest.raises(Exception):
        files.read_jsonl(spark, str(p), DATASET, "fail").collect()
    o = tmp_path / "o.json"
    o.write_text('{\n "a": 1\n}')
    assert files.read_json_object(spark, str(o), "a int").first().a == 1
    o.write_text('{"q1": {"groundedness": 2, "specificity": 1, "completeness": 0}, "q2": {"groundedness": 1}}')
    assert {r.question: r.scores.groundedness for r in files.read_labels(spark, str(o)).collect()} == {"q1": 2, "q2": 1}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("b", "x", "s", 1, "factual", None, None), ("a", "é", "s", 2, "factual", True, 6)], DATASET)
    path = str(tmp_path / "out")
    sinks.write_jsonl(df, path, [F.col("question")], single=True)
    lines = [json.loads(x) for f in (tmp_path / "out").glob("part-*") for x in f.read_text().splitlines()]
    assert [x["question"] for x in lines] == ["a", "b"] and lines[1]["quality_score"] is None and "answerable" in lines[1]
    facts = {r.path: (r.there, r.records) for r in sinks.file_facts(spark, [path, str(tmp_path / "no")]).collect()}
    assert facts == {path: (True, 2), str(tmp_path / "no"): (False, 0)}
    assert sinks.csv_with_bom(df).startswith(b"\xef\xbb\xbfquestion,")
    assert sinks.archive(path, [{"a": 1}])[:2] == b"PK"
    more = df.withColumn("chunk_text", F.lit("secret"))
    sinks.export_run(more, more, more, df, df, str(tmp_path / "run"), [F.col("question")])
    assert "secret" not in "".join(f.read_text() for f in (tmp_path / "run/synthetic_dataset.jsonl").glob("part-*"))
    assert "secret" in "".join(f.read_text() for f in (tmp_path / "run/graded_pairs.jsonl").glob("part-*"))


def test_token_bucket_and_meter():
    now, waits = [0.0], []

    def sleep(s):
        waits.append(s)
        now[0] += s

    b = external.TokenBucket(600, 1.0, lambda: now[0], sleep)
    b.ask(600)
    b.ask(10)
    b.ask(9999)
    assert waits[0] == pytest.approx(1.0) and sum(waits) == pytest.approx(61.0)
    b.give_back(10**6)
    assert b.level == b.capacity
    m = external.Meter(10_000)
    m.record("judge", 6_000)
    assert not m.exhausted() and m.exhausted(0.45)


def test_models_outside(spark):
    prompts = spark.createDataFrame([("a", "x"), ("b", "fail"), ("c", "y")], "key string, prompt string")

    def client():
        def call(p):
            if p == "fail":
                raise RuntimeError("no")
            return p.upper()

        return call

    said = external.ask_model(prompts, client, tasks=2)
    assert {r.key: r.raw for r in said.collect()} == {"a": "X", "b": None, "c": "Y"}
    assert [r.key for r in external.missing(prompts, said).collect()] == ["b"]
    assert external.replay(prompts, said).count() == 3
    out = external.embed(prompts, "prompt", lambda: lambda texts: [[float(len(t))] for t in texts])
    assert {r.key: r.vector for r in out.collect()} == {"a": [1.0], "b": [4.0], "c": [1.0]}


def test_streamed_pages(spark, tmp_path):
    inbox, out, mark = (str(tmp_path / k) for k in ("in", "out", "mark"))
    pages = spark.createDataFrame([("a.pdf", 0, "word " * 300), ("a.pdf", 1, "short"), ("a.pdf", 2, None)], PAGE)
    pages.write.json(inbox)
    for _ in range(2):  # the second run finds nothing new
        stream_chunks(page_stream(spark, inbox), out, mark).awaitTermination()
    assert spark.read.parquet(out).count() == 3
    pages.limit(1).write.mode("append").json(inbox)
    stream_chunks(page_stream(spark, inbox), out, mark).awaitTermination()
    assert spark.read.parquet(out).count() == 6


def test_pipeline(spark):
    text = "Growers dry the maize of the valley in the shade before they store it in closed bins near the river. " * 8
    pages = spark.createDataFrame([("who.pdf", i, f"Lot {i}. " + text) for i in range(4)] + [("who.pdf", 9, "ISBN " + text), ("x.pdf", 0, "short")], PAGE)

    def generator():
        return lambda p: json.dumps([{"question": "How do growers dry the maize of the valley?", "answer": "They dry it in the shade before storing it.", "question_type": "procedural"}, {"question": "bad", "answer": "x"}])

    def abstainer():
        return lambda p: json.dumps({"question": "What does a new closed bin cost near the river?"})

    def judge():
        return lambda p: json.dumps([{"index": i + 1, "groundedness": 2, "specificity": 2, "completeness": 2, "reason": "ok"} for i in range(p.count("] Q: "))])

    def checker():
        return lambda p: json.dumps({"unanswerable": True, "plausible": True})

    got = pipeline.run(pages, generator, abstainer, judge, checker)
    graded = got.graded.collect()
    assert len(graded) > 4 and {x.outcome for x in graded} == {"kept"} and all(x.page >= 1 for x in graded)
    final = got.final.collect()
    assert len({x.question for x in final}) == len(final) and any(not x.answerable for x in final)
    assert len(final) + got.duplicates.count() == len(graded)
    assert len(pipeline.Settings().name()) == 16


def test_pipeline_asks_again(spark, tmp_path):
    text = "Growers dry the maize of the valley in the shade before they store it in closed bins near the river. " * 8
    pages = spark.createDataFrame([("who.pdf", i, f"Lot {i}. " + text) for i in range(4)], PAGE)
    good = {
        "generator": lambda p: json.dumps([{"question": f"How do growers {w} the maize of lot {p.split('Lot ')[1][:1] if 'Lot ' in p else 9}?", "answer": "They do it in the shade before storing it."} for w in ("dry", "store")]),
        "abstainer": lambda p: json.dumps({"question": "What does a new closed bin cost near the river?"}),
        "judge": lambda p: json.dumps([{"index": i + 1, "groundedness": 2, "specificity": 2, "completeness": 2} for i in range(p.count("] Q: "))]),
        "checker": lambda p: json.dumps({"unanswerable": True, "plausible": True}),
    }

    def makers(folder, bad):
        """Clients that say what bad() says, if anything, and note their calls."""
        os.makedirs(folder)

        def make(name):
            def client():
                def call(p):
                    mark = hashlib.md5((name + p).encode()).hexdigest()
                    nth = sum(f.startswith(mark) for f in os.listdir(folder))
                    open(f"{folder}/{mark}-{nth}-{name}", "x").close()
                    out = bad(name, p, nth)
                    return good[name](p) if out is None else out

                return call

            return client

        return [make(k) for k in good]

    def poor(name, p, nth):
        """First calls fail, and batches never work out."""
        if nth == 0 and name == "generator":
            raise RuntimeError("429: try again in 0.2s")
        if name == "judge":
            return "[1, 2" if p.count("] Q: ") > 1 or nth == 0 else None
        return None if nth else "so sorry" if name == "checker" else '{"question": "What does this passage say?"}'

    saved = str(tmp_path / "saved")
    outcome = lambda run: sorted((x.question, x.outcome, x.quality_score) for x in run.graded.collect())
    got = outcome(pipeline.run(pages, *makers(str(tmp_path / "a"), poor), saved=saved))
    assert len(got) == 17 and {x[1] for x in got} == {"kept"} and sum("cost" in x[0] for x in got) == 1
    # what is saved isn't asked for again, except batches that never worked out
    assert outcome(pipeline.run(pages, *makers(str(tmp_path / "b"), poor), saved=saved)) == got
    assert {f.rpartition("-")[2] for f in os.listdir(tmp_path / "b")} == {"judge"}


def test_retry_wait(spark):
    for m, a in [("429: try again in 4m24.383s", 0), ("try again in 7s", 3), ("try again in 9m1s", 0), ("429", 1), ("429", 9)]:
        told = spark.range(1).select(generation.retry_seconds(F.lit(m), F.lit(a))).first()[0]
        assert external.retry_wait(m, a) == pytest.approx(told)


def test_every_query_runs(spark, small):
    for name, query in catalogue.QUERIES.items():
        assert query(spark, small).columns, name
    assert set(catalogue.SQL) <= set(catalogue.QUERIES)
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
