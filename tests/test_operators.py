import random
import re
import zlib

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sievework.operators import agreement, budget, checkpoints, dedup, explorer, generation, grounding, ingest, judging, statistics, sweeps
from sievework.operators.ordinals import with_ordinal, with_running_total
from sievework.schemas import SCORES
from sievework.session import cut


def paginate(text, size=3000):
    pages, open_ = [], ""
    for para in text.replace("\r\n", "\n").strip().split("\n\n"):
        if open_ and len(open_) + len(para) > size:
            pages.append(open_)
            open_ = para
        else:
            open_ = para if not open_ else open_ + "\n\n" + para
    return [p.strip() for p in [*pages, open_] if p.strip()]


def test_pseudo_pages(spark):
    r = random.Random(2)
    texts = ["\n\n".join("x" * r.randint(0, 40) for _ in range(r.randint(0, 12))) for _ in range(60)] + ["", None, " \r\n ", "a\r\n\r\nb", "y" * 500]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, content string")
    got = ingest.pseudo_pages(df, page_chars=60).collect()
    for i, t in enumerate(texts):
        assert [x.page_content for x in sorted(got, key=lambda x: x.page) if x.i == i] == paginate(t or "", 60)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["word", "longer sentence here", ". ", "; ", "\n", "\n\n", " ", "z" * 90]), max_size=60))
def test_recursive_chunks(parts):
    text = "".join(parts)
    chunks = ingest.recursive_chunks_of(text, 100, 20)
    starts = [s for s, _ in chunks]
    assert starts == sorted(starts)
    for s, c in chunks:
        assert text[s : s + len(c)] == c and c == c.strip() and c
        assert len(c) <= 100 or not any(x in c[1:-1] for x in ("\n", ". ", "; "))
    for (s, c), (t, _) in zip(chunks, chunks[1:]):
        assert s + len(c) - t <= 20 + 2
    covered = set()
    for s, c in chunks:
        covered |= set(range(s, s + len(c)))
    assert all(text[i].isspace() for i in range(len(text)) if i not in covered)


def test_windows(spark):
    df = spark.createDataFrame([(1, "a" * 1041), (2, ""), (3, None), (4, "é" * 5)], "k int, page_content string")
    got = sorted((x.k, x.start_index, len(x.page_content)) for x in ingest.window_chunks(df, ["k"]).collect())
    assert got == [(1, 0, 600), (1, 520, 521), (1, 1040, 1), (4, 0, 5)]


@pytest.mark.parametrize("text,want", [
    ("Contents .......... 4", "table_of_contents"), ("ISBN 978", "front_matter"), ("© the authors", "front_matter"), ("Views expressed by the\u0085 named authors", "front_matter"), ("see doi.org/1 Lancet 2004", "reference_list"),
    ("see doi.org/1", None), ("Ann Lee (Rome) Bo Ek (Oslo) Cy Fu (Lima)", "contributor_list"), ("12 34 5", "numeric_table"), ("12 of 34 farms", "numeric_table"), ("Feed 12 cows each day", None), ("", None),
])
def test_boilerplate(spark, text, want):
    assert spark.createDataFrame([(text,)], "t string").select(ingest.boilerplate_reason(F.col("t"))).first()[0] == want


def test_page_plan(spark):
    counts = spark.createDataFrame([("a", 100), ("b", 3), ("c", 40), ("d", 0)], "source_file string, pages bigint")
    got = ingest.sampled_pages(counts, 30).collect()
    by = {k: sorted(x.page for x in got if x.source_file == k) for k in "abcd"}
    assert by["b"] == [0, 1, 2] and by["d"] == [] and len(by["a"]) == 21 and by["a"] == [int(i * (100 / 21)) for i in range(21)]
    assert len(ingest.sampled_pages(counts, 500).collect()) == 143
    assert ingest.page_budget(75) == 60 and ingest.page_budget(1) == 8


@pytest.mark.parametrize("n,k", [(30, 22), (30, 0), (30, 30), (30, 99), (0, 5), (100, 7)])
def test_evenly_spaced(spark, n, k):
    df = spark.createDataFrame([(i,) for i in range(n)], "x int").repartition(5)
    got = sorted(r.x for r in ingest.evenly_spaced(df, [F.col("x")], k).collect())
    assert got == (list(range(n)) if not 0 < k < n else [int(i * (n / k)) for i in range(k)])


def test_ordinals(spark):
    df = spark.createDataFrame([(i * 7 % 101, i) for i in range(101)], "x int, v int").repartition(6)
    assert all(r.x == r.ord for r in with_ordinal(df, [F.col("x")]).collect())
    run = {r.x: r.s for r in with_running_total(df, [F.col("x")], F.col("v"), "s").collect()}
    order = sorted((i * 7 % 101, i) for i in range(101))
    assert run == {x: sum(v for _, v in order[: k + 1]) for k, (x, _) in enumerate(order)}


def test_abstention_picks(spark):
    assert len(generation.exact_pick(100)) == 10 and generation.exact_pick(100) == generation.exact_pick(100)
    assert generation.exact_pick(0) == [] and generation.exact_pick(9, 0) == [] and len(generation.exact_pick(3)) == 1
    df = spark.createDataFrame([(i,) for i in range(95)], "k int")
    a, b = ({r.k for r in generation.pick_by_hash(df.repartition(n), F.col("k")).collect()} for n in (2, 7))
    assert a == b and len(a) == 10
    assert {r.k for r in generation.pick_exact(df, [F.col("k")]).collect()} == set(generation.exact_pick(95))


def test_parsed_and_flattened(spark):
    raw = '```json\n[{"question":"How long must dry seed rest?","answer":"It rests for nine days in the shade.","question_type":" Procedural"},7,{"question":"What does the text say?","answer":"It says very many things here."},{"question":"Short?","answer":null}]\n```'
    df = spark.createDataFrame([(0, raw), (1, "sorry"), (2, None)], "chunk_ord int, raw string")
    got = generation.parsed_pairs(df, keep=["chunk_ord"]).collect()
    assert [(x.chunk_ord, x.pos, x.question_type) for x in got] == [(0, 0, "procedural")]
    ab = generation.abstention_pairs(spark.createDataFrame([(0, '{"question":"What does a new seed dryer cost?"}'), (1, '{"question":"x"}')], "chunk_ord int, raw string"), keep=["chunk_ord"])
    flat = generation.flattened(generation.parsed_pairs(df, keep=["chunk_ord"]).withColumn("answerable", F.lit(True)), ab).orderBy("pair_ord").collect()
    assert [x.answerable for x in flat] == [True, False] and flat[1].answer == "This information is not available in the provided document."


def test_retry_seconds(spark):
    df = spark.createDataFrame([("try again in 4m24.383s", 0), ("try again in 7s", 0), ("try again in 90m1s", 0), ("no", 1), ("no", 9)], "m string, a int")
    assert [r[0] for r in df.select(generation.retry_seconds(F.col("m"), F.col("a"))).collect()] == pytest.approx([265.383, 8.0, 300.0, 40.0, 120.0])


def test_judging(spark):
    pairs = spark.createDataFrame([(i, "p" if i < 7 else "q" if i < 9 else None, f"question {i}", f"answer {i}") for i in range(10)], "pair_ord bigint, chunk_text string, question string, answer string")
    groups = judging.passage_groups(pairs, batch=4).collect()
    assert sorted(x.pair_ord for g in groups for x in g.pairs) == list(range(10)) and max(len(g.pairs) for g in groups) <= 4
    one = judging.passage_groups(pairs.filter("pair_ord < 4"))
    prompt = one.select(judging.batch_prompt(F.col("passage"), F.col("pairs"))).first()[0]
    assert "[1] Q: question 0" in prompt and "[4] Q: question 3" in prompt
    raw = '[{"index":2,"groundedness":2,"specificity":"1","completeness":9,"reason":" good "},{"groundedness":1},{"index":"x","groundedness":0},{"index":99},{"index":2,"groundedness":1},"no"]'
    got = {x.pair_ord: x for x in judging.aligned_scores(one.withColumn("raw", F.lit(raw))).collect()}
    assert set(got) == {1, 2} and got[1].scores.groundedness == 1 and got[2].scores.groundedness == 0
    checks = judging.abstention_checks(spark.createDataFrame([('{"unanswerable": true, "plausible": "true"}',), ('{"unanswerable": true, "plausible": false}',), (None,)], "raw string")).collect()
    assert [(c.check.unanswerable, c.check.plausible) for c in checks] == [(True, None), (True, False), (None, None)]
    rows = [(True, (2, 2, 2), None, None), (True, (0, 2, 2), "no", None), (True, None, None, None), (False, None, None, (True, True, True)), (False, None, None, (True, False, True)), (False, None, None, None)]
    out = judging.graded(spark.createDataFrame(rows, f"answerable boolean, scores {SCORES}, reason string, check struct<unanswerable boolean, plausible boolean, abstention_answer boolean>")).collect()
    assert [(x.outcome, x.quality_score) for x in out] == [("kept", 6), ("rejected", 4), ("not_assessed", None), ("kept", None), ("rejected", None), ("not_assessed", None)]
    assert out[5].reject_reason == out[2].reject_reason == "judge call failed - not assessed" and out[3].reject_reason is None
    assert out[4].reject_reason == "abstention check failed: question is off-topic or implausible"


def greedy(v, t, numbers=None):
    kept, gone = [], {}
    for i in range(len(v)):
        best = None
        for j in kept:
            if numbers and numbers[i] and numbers[j] and numbers[i] != numbers[j]:
                continue
            s = float(v[i] @ v[j])
            if s >= t and (best is None or s > best[0]):
                best = (s, j)
        if best is None:
            kept.append(i)
        else:
            gone[i] = best[1]
    return kept, gone


@pytest.mark.parametrize("t,guarded,pivots", [(0.3, False, 20_000), (0.6, True, 20_000), (0.9, False, 10), (0.8, True, 10)])
def test_greedy_dedup(spark, monkeypatch, t, guarded, pivots):
    monkeypatch.setattr(dedup, "PIVOT_ROWS", pivots)
    monkeypatch.setattr(dedup, "CHUNK", 40)
    r = np.random.default_rng(int(t * 100))
    base = r.normal(size=(30, 8))
    v = base[r.integers(0, 30, 160)] + 0.25 * r.normal(size=(160, 8))
    v /= np.linalg.norm(v, axis=1)[:, None]
    v = v.astype(np.float32).astype(np.float64)
    numbers = [r.choice(["", "1", "2"]) for _ in range(160)]
    df = spark.createDataFrame([(i, v[i].tolist(), [numbers[i]] if numbers[i] else []) for i in range(160)] + [(500, None, [])], "ord bigint, vector array<float>, nums array<string>")
    edges = dedup.similarity_edges(df, t, number_col="nums" if guarded else None)
    rows = edges.collect()
    want = {(i, j) for i in range(160) for j in range(i) if v[i] @ v[j] >= t and not (guarded and numbers[i] and numbers[j] and numbers[i] != numbers[j])}
    assert {(x.i, x.j) for x in rows} == want and len(rows) == len(want)
    gone = dedup.resolve(edges)
    kept, match = greedy(v, t, numbers if guarded else None)
    assert {x.i for x in gone.collect()} == set(match) and len(kept) + len(match) == 160
    assert {x.i: x.duplicate_of for x in dedup.matches(edges, gone).collect()} == match


@pytest.mark.parametrize("pivots,chunk", [(20_000, 65_536), (100, 700)])
def test_edges_without_copies_of_vectors(spark, monkeypatch, pivots, chunk):
    """All pairs, of rows that pivots part badly, while few bytes a row are shuffled; cells and chunks lose none."""
    monkeypatch.setattr(dedup, "PIVOT_ROWS", pivots)
    monkeypatch.setattr(dedup, "CHUNK", chunk)
    r = np.random.default_rng(5)
    n = 12_000
    family = r.poisson(0.2, (12, 256)) * r.choice([-1, 1], (12, 256))
    v = (family[r.integers(0, 12, n)] + r.poisson(0.05, (n, 256)) * r.choice([-1, 1], (n, 256))).astype(np.float64)
    twice = r.integers(0, n, 1000)
    v[twice] = v[r.integers(0, n, 1000)] + r.poisson(0.02, (1000, 256))
    v[:50] += 0.01 * r.normal(size=(50, 256))
    v = (v / np.linalg.norm(v, axis=1)[:, None]).astype(np.float32)
    df = spark.createDataFrame(pd.DataFrame({"ord": range(n), "vector": list(v)}), "ord bigint, vector array<float>").repartition(8)
    bus, store = spark.sparkContext._jsc.sc().listenerBus(), spark.sparkContext._jsc.sc().statusStore()

    def shuffled():
        bus.waitUntilEmpty(30_000)
        return sum(store.executorList(False).apply(k).totalShuffleWrite() for k in range(store.executorList(False).size()))

    df = cut(df)
    before = shuffled()
    got = {(x.i, x.j) for x in dedup.similarity_edges(df, 0.9).collect()}
    per_row = (shuffled() - before) / n
    sure, sim = v.astype(np.float64), v @ v.T
    first = {x.tobytes(): i for i, x in reversed(list(enumerate(v)))}
    stay = np.array([first[x.tobytes()] == i for i, x in enumerate(v)])
    i, j = np.nonzero(np.tril(sim >= 0.8999, -1) & stay & stay[:, None])
    want = {(a, b) for a, b in zip(i.tolist(), j.tolist()) if sure[a] @ sure[b] >= 0.9} | {(k, first[v[k].tobytes()]) for k in np.flatnonzero(~stay).tolist()}
    assert len(want) > 500 and got == want
    if pivots == 20_000:  # before, every chunk of 4,096 rows had all vectors sent
        assert per_row < 300


def test_packed_vectors(spark):
    """Packed or not, the vectors are those of words hashed one at a time."""
    texts = ["", None, "Dose of 1.5 g_x, for ÄRZTE and Ärzte", "a " * 300, "one two\x1fone\u0130 two"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select(dedup.hashed_vector(F.col("t")).alias("v"), dedup.hashed_vector(F.col("t"), packed=True).alias("p")).collect()
    for t, row in zip(texts, rows):
        v, w = np.zeros(256), re.findall(r"[^\W_]+", (t or "").lower())
        for g in [*w, *(" ".join(p) for p in zip(w, w[1:]))]:
            h = zlib.crc32(g.encode())
            v[h % 256] += 1.0 if h >> 31 else -1.0
        want = (v / (np.linalg.norm(v) or 1.0)).astype(np.float32)
        assert row.v == want.tolist() and dedup._unpacked([bytes(row.p)])[0].tolist() == want.tolist()
        assert dedup._unpacked(dedup._packed(want[None]))[0].tolist() == want.tolist()


@pytest.mark.parametrize("guarded", [False, True])
def test_equal_vectors_are_compared_once(spark, guarded):
    """Copies go, whatever becomes of their first, and resemble the nearest that stays."""
    r = np.random.default_rng(4)
    base = r.normal(size=(6, 8))
    base[3] = base[1] + 0.3 * r.normal(size=8)
    base[4] = base[3] + 0.3 * r.normal(size=8)
    v = base[r.integers(0, 6, 120)]
    v = (v / np.linalg.norm(v, axis=1)[:, None]).astype(np.float32).astype(np.float64)
    numbers = [r.choice(["", "1", "2"]) for _ in range(120)]
    df = spark.createDataFrame([(i, v[i].tolist(), [numbers[i]] if numbers[i] else []) for i in range(120)] + [(500 + i, [0.0] * 8, []) for i in range(5)], "ord bigint, vector array<float>, nums array<string>")
    edges = dedup.similarity_edges(df, 0.9, number_col="nums" if guarded else None)
    gone = dedup.resolve(edges)
    kept, match = greedy(v, 0.9, numbers if guarded else None)
    assert {x.i for x in gone.collect()} == set(match)
    got = {x.i: x.duplicate_of for x in dedup.matches(edges, gone).collect()}
    assert got.keys() == match.keys() and all(abs(v[i] @ v[got[i]] - v[i] @ v[match[i]]) < 1e-6 for i in match)
    assert edges.filter("not copy").count() < 60


def test_very_many_equal_vectors(spark):
    df = spark.range(50_000).select(F.col("id").alias("ord"), F.when(F.col("id") % 2 == 0, F.array(F.lit(1.0), F.lit(0.0))).otherwise(F.array(F.lit(0.0), F.lit(1.0))).cast("array<float>").alias("vector"))
    edges = dedup.similarity_edges(df, 0.9)
    assert edges.count() == 49_998 and dedup.resolve(edges).count() == 49_998


@pytest.mark.parametrize("seed", range(3))
def test_resolve_on_random_graphs(spark, seed):
    r = random.Random(seed)
    edges = {(i, j) for i, j in ((r.randrange(80), r.randrange(80)) for _ in range(150)) if j < i}
    kept = []
    for i in range(80):
        if not any((i, j) in edges for j in kept):
            kept.append(i)
    got = {x.i for x in dedup.resolve(spark.createDataFrame(sorted(edges), "i bigint, j bigint")).collect()}
    assert got == set(range(80)) - set(kept)
    assert dedup.resolve(spark.createDataFrame([], "i bigint, j bigint")).count() == 0


def test_number_guard_and_rewording(spark):
    rows = [(0, "What dose for adults?", "Give 25 g to adults each day.", "s", 1, "factual", 6), (1, "What dose for adults?", "Give 15 g to adults each day.", "s", 1, "factual", 6), (2, "What is the dose for adults?", "Give 25 g to adults each day.", "s", 1, "factual", 5)]
    df = spark.createDataFrame(rows, "ord bigint, question string, answer string, source string, page int, question_type string, quality_score int")
    df = df.withColumn("vector", dedup.hashed_vector(dedup.dedup_text(F.col("question"), F.col("answer"))))
    unique, gone = dedup.greedy_dedup(df, "ord", "vector", 0.7)
    assert sorted(x.ord for x in unique.collect()) == [0, 1]
    x = gone.first()
    assert x.removed_question == rows[2][1] and x.duplicate_of_question == rows[0][1] and 0.6 < x.lexical_overlap <= 1


def test_removed_summary(spark):
    df = spark.createDataFrame([(0.9, 0.5), (0.8, 0.7), (1.0, None), (None, 0.1), (0.95, 0.3)], "similarity double, lexical_overlap double")
    assert dedup.removed_summary(df).first() == (4, 8000, 10000, 2, 9500)


def test_openers(spark):
    df = spark.createDataFrame([(0, "What is it?"), (1, "How do I?"), (2, "what IS that"), (3, "123"), (4, "Why"), (5, "how do we")], "o int, question string")
    got = [tuple(x) for x in dedup.opener_diversity(df, F.col("o")).collect()]
    assert got == [("what is", 2, 5, 3), ("how do", 2, 5, 3), ("why", 1, 5, 3)]


def test_grounding(spark):
    p = "Children under five receive 200 mg twice daily with clean water for seven days."
    rows = [(p, "Children under five receive 200 mg twice daily."), (p, "Children receive 300 mg of syrup hourly at noon."), (p, ""), (p, "Utterly different wording everywhere."), (p, "Give 1,000 or 200.0 mg")]
    got = grounding.checked(spark.createDataFrame(rows, "passage string, answer string")).collect()
    assert got[0].grounding_band == "strong" and not got[0].has_unsupported_number
    assert got[1].unsupported_numbers == ["300"] and got[1].novel_words[0] == "hourly"
    assert got[2].overlap == 1.0 and got[3].overlap == 0.0 and got[3].grounding_band == "weak"
    assert got[4].unsupported_numbers == ["1000"]
    found = spark.createDataFrame([(0.05, 2), (0.7, 2), (1.0, 1), (0.699, 2), (0.4, 2)], "lexical_overlap double, g int")
    bins = {x.bin: x.n for x in grounding.histogram(found).collect()}
    assert len(bins) == 10 and bins[9] == 1 and bins[0] == 1 and bins[6] == 1 and bins[7] == 1
    assert grounding.judge_agreement(found, F.col("g")).first() == (5, 1, 2, 1)


def test_grounding_by_page(spark):
    pairs = spark.createDataFrame([(1, "A.pdf", 1, "Dry maize for 9 days"), (2, "a.pdf", 2, "Dry maize"), (3, None, 1, "Dry"), (4, "a.pdf", 1, "")], "k int, source string, page int, answer string")
    pages = spark.createDataFrame([("x/a.pdf", 1, "Maize is dried"), ("a.pdf", 1, "dry it 9 days"), ("a.pdf", None, "lost")], "source string, page int, text string")
    got = {x.k: tuple(x)[1:] for x in grounding.checked_by_page(pairs, pages, "k").collect()}
    assert got == {1: (True, 3, 3, 1, 1), 2: (False, 2, 0, 0, 0), 3: (False, 1, 0, 0, 0), 4: (True, 0, 0, 0, 0)}


def test_exports(spark):
    df = spark.createDataFrame([("Q", "A", "clinic.pdf", 1, "secret")], "question string, answer string, source string, page int, chunk_text string")
    out = statistics.clean_records(df)
    assert out.columns == ["question", "answer", "source", "page", "question_type", "answerable", "quality_score"] and out.first().quality_score is None
    with pytest.raises(ValueError):
        statistics.assert_no_internals(df)
    full = df.withColumns({"question_type": F.lit("factual"), "answerable": F.lit(None).cast("boolean"), "quality_score": F.lit(6)})
    rec = statistics.chat_records(full).first()
    assert [m.role for m in rec.messages] == ["system", "user", "assistant"] and rec.answerable is True and "chunk_text" not in rec
    assert [m.role for m in statistics.chat_records(full, False).first().messages] == ["user", "assistant"]
    assert "who" in statistics.CLINICAL and statistics.dataset_card("x", {"final": 3}).startswith("# x")


def test_kappa(spark):
    r = random.Random(1)
    rows = [(r.randint(0, 2), r.choice([0, 1, 2, 2])) for _ in range(200)] + [(None, 1), (2, None)]
    got = agreement.kappa(spark.createDataFrame(rows, "a int, b int"), "a", "b").first()
    o = np.zeros((3, 3))
    for a, b in rows[:200]:
        o[a, b] += 1
    e = np.outer(o.sum(1), o.sum(0)) / 200
    w = np.subtract.outer(range(3), range(3)) ** 2
    assert got.n == 200 and got.agree == int(np.trace(o))
    assert got.kappa == pytest.approx(1 - (o.sum() - np.trace(o)) / (e.sum() - np.trace(e)), abs=1e-5)
    assert got.weighted_kappa == pytest.approx(1 - (w * o).sum() / (w * e).sum(), abs=1e-5)
    flat = agreement.kappa(spark.createDataFrame([(1, 1), (1, 2)], "a int, b int"), "a", "b").first()
    assert flat.constant and flat.kappa is None
    words = spark.createDataFrame([(x,) for x in (None, -0.1, 0.1, 0.3, 0.5, 0.7, 0.9)], "k double").select(agreement.strength(F.col("k"))).collect()
    assert [x[0] for x in words] == ["undefined", "none", "slight", "fair", "moderate", "substantial", "almost perfect"]


def test_seeded_sample(spark):
    df = spark.createDataFrame([(i,) for i in range(90)], "x int").repartition(4)
    got = {r.draw: r.x for r in agreement.seeded_sample(df, [F.col("x")]).collect()}
    assert [got[i] for i in range(40)] == random.Random(42).sample(range(90), 40)
    assert agreement.seeded_sample(df.filter("x < 5"), [F.col("x")]).count() == 5


def test_sweeps(spark):
    rows = [("What is it?", (2, 2, 2)), ("What is it?", (2, 1, 1)), ("How so?", (1, 2, 2)), ("Why?", None), ("Why not?", (2, 2, 0))]
    df = spark.createDataFrame(rows, f"question string, scores {SCORES}")
    got = {(x.min_score, x.floors): (x.graded, x.passed, x.score_sum, x.unique_openers) for x in sweeps.threshold_sweep(df).collect()}
    assert got[4, True] == (4, 2, 10, 1) and got[4, False] == (4, 4, 19, 3) and got[6, True] == (4, 1, 6, 1)
    v = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.96, 0.28]), (2, [0.8, 0.6]), (3, [0.0, 1.0])], "ord bigint, vector array<float>")
    assert {x.threshold: x.survivors for x in sweeps.dedup_sweep(v, "ord", "vector").collect()} == {0.75: 2, 0.85: 3, 0.90: 3, 0.95: 3}


def test_explorer(spark):
    rows = [(0, True, 5, "factual", "a", "Dry MAIZE?", "yes"), (1, None, None, "factual", "b", "x", "maize too"), (2, False, None, "unanswerable", "a", "y", "z"), (3, True, 2, "other", "a", "y", "z")]
    df = spark.createDataFrame(rows, "k int, answerable boolean, quality_score int, question_type string, source string, question string, answer string")
    pick = lambda c: sorted(r.k for r in df.filter(c).collect())
    assert pick(explorer.explorer_filter(0, ["answerable", "abstention"])) == [0, 1, 2, 3]
    assert pick(explorer.explorer_filter(3, ["answerable"])) == [0] and pick(explorer.explorer_filter(3, ["abstention"])) == [2]
    assert pick(explorer.explorer_filter(0, [])) == [] and pick(explorer.explorer_filter(0, ["answerable"], ["factual"], ["b"])) == [1]
    assert pick(explorer.search("M.ize")) == [0, 1]
    assert [r.k for r in explorer.best_kept(df, [F.col("k")], 2).collect()] == [0, 3]
    assert [r.k for r in explorer.worst_rejected(df, [F.col("k")]).collect()] == [3, 0]
    assert [r.k for r in explorer.page_of(df, [F.col("k")], 1, 3).collect()] == [3]
    rec, nested = explorer.preview(df.withColumn("s", F.struct("k")), 1)
    assert rec[0]["s"]["k"] == rec[0]["k"] and nested["s"] and not nested["k"]


def test_budget(spark):
    df = spark.createDataFrame([(45,), (250,), (0,)], "c int")
    cost = df.select(*[v.alias(k) for k, v in budget.run_cost(F.col("c")).items()]).collect()
    assert (cost[0].generation_tokens, cost[0].judge_tokens, cost[0].requests, cost[0].over_budget) == (41760, 35100, 99, False) and cost[1].over_budget
    assert df.select(budget.affordable_chunks(F.lit(200_000))).first()[0] == int(200_000 / (860 + 68 + 450 + 330))
    plan = budget.plan_seconds(F.col("c"), F.lit(0))
    row = df.select(plan["total"].alias("t"), budget.overall_percent(plan, "generate", F.lit(0), F.lit(0)).alias("p"), budget.seconds_left(plan, "ingest", F.lit(0), F.lit(0), F.lit(10.0)).alias("e"), budget.seconds_left(plan, "validate", F.lit(0), F.lit(5), F.lit(400.0)).alias("l")).first()
    total, spent = 35 + 45 * 10.2 + 16, 35 + 45 * 5.4
    assert row.t == pytest.approx(total) and row.p == round(35 / total * 100, 1) and row.e == pytest.approx(total - 10)
    part = spent / total
    assert row.l == pytest.approx(total * (1 - part) + 400 / part * part - 400)
    spend = budget.running_spend(spark.createDataFrame([(i, 10) for i in range(9)], "i int, t int"), [F.col("i")], F.col("t"), 45).collect()
    assert sum(x.within for x in spend) == 4


def test_checkpoints(spark):
    rows = [(1, "f", "a", '{"n":1}'), (2, "f", "a", '{"n":2}'), (3, "g", "a", '{"n":9}'), (4, "f", "b", '{"n":'), (5, "f", "b", '{"n":3}'), (6, "f", "c", None)]
    log = spark.createDataFrame(rows, "log_ord int, fingerprint string, chunk_key string, payload string")
    got = {(x.fingerprint, x.key): x.payload for x in checkpoints.latest(log, [F.col("log_ord")]).collect()}
    assert got == {("f", "a"): '{"n":2}', ("g", "a"): '{"n":9}', ("f", "b"): '{"n":3}'}
    assert {x.key for x in checkpoints.latest(log, [F.col("log_ord")], "f", stop_at_broken=True).collect()} == {"a"}
    work = spark.createDataFrame([("a",), ("z",)], "key string")
    assert [x.key for x in checkpoints.open_work(work, checkpoints.latest(log, [F.col("log_ord")], "f")).collect()] == ["z"]
    assert checkpoints.fingerprint(a=1, b=2) == checkpoints.fingerprint(b=2, a=1) != checkpoints.fingerprint(a=1, b=3) and len(checkpoints.fingerprint()) == 16
