import json
import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sievework.functions import model_json, rules, text
from sievework.schemas import SCORES


def one(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"t {kind}").select(column(F.col("t"))).first()[0]


@pytest.mark.parametrize("raw,want", [("a/b/C.PDF ", "c.pdf"), ("C:\\x\\Y.md", "y.md"), ("\t z.txt \t", "z.txt"), ("a/ ", None), ("", None), (None, None), ("a\nb.pdf", "a\nb.pdf")])
def test_source_name(spark, raw, want):
    assert one(spark, raw, text.source_name) == want


@pytest.mark.parametrize("raw,want", [("\t a \n", "a"), ("\u00a0x\u2003", "x"), ("", ""), ("  ", ""), ("a b", "a b")])
def test_strip(spark, raw, want):
    assert one(spark, raw, text.strip) == want


@pytest.mark.parametrize("raw,want", [("Give 1,500 units", ["1500"]), ("Give 1500 units", ["1500"]), ("none", []), (None, []), ("3.0 and 3 and 3.0", ["3", "3.0"])])
def test_number_set(spark, raw, want):
    assert one(spark, raw, text.number_set) == want


@pytest.mark.parametrize("raw,want", [("1,000 or 1000 or 3.0", ["1000", "3"]), ("1.2.3", []), ("10 9 0.5", ["0.5", "10", "9"]), ("", []), ("7" * 25, ["7777777777777777777777777"])])
def test_plain_numbers(spark, raw, want):
    got = one(spark, raw, text.plain_numbers)
    assert got == want or len(raw) == 25 and len(got) == 1


def test_words_and_openers(spark):
    assert one(spark, "The well-known farmer's Cow, it's 5 cows!", text.content_words) == ["cow", "cows", "farmer's", "it's", "well-known"]
    assert one(spark, "Éa x_y 12b", text.words) == ["éa", "x", "y", "12b"]
    assert one(spark, "  What's the", text.opener) == "what s"
    assert one(spark, "12 34", text.opener) is None


KEEP = [((2, 2, 2), True), ((2, 1, 1), True), ((1, 2, 2), False), ((0, 2, 2), False), ((2, 2, 0), False), ((2, 0, 2), False), ((None, None, None), False), ((2, None, 2), False), (None, False)]


@pytest.mark.parametrize("scores,keep", KEEP)
def test_keep_rule(spark, scores, keep):
    df = spark.createDataFrame([(scores,)], f"scores {SCORES}")
    assert df.select(rules.keep_expr(F.col("scores"))).first()[0] is keep


def test_keep_rule_without_floors(spark):
    df = spark.createDataFrame([((1, 2, 2),)], f"scores {SCORES}")
    assert df.select(rules.keep_expr(F.col("scores"), floors={}), rules.keep_expr(F.col("scores"), 6, {})).first() == (True, False)


@pytest.mark.parametrize("scores,said,want", [
    ((2, 2, 2), None, None), ((1, 2, 2), "made up", "UNGROUNDED (groundedness 1/2): made up"), ((0, 2, 2), " ", "UNGROUNDED (groundedness 0/2): claims not traceable to passage"),
    ((2, 0, 0), "vague", "below floor on specificity 0/1, completeness 0/1: vague"), ((2, 2, 0), None, "below floor on completeness 0/1"), (None, None, rules.NOT_ASSESSED),
])
def test_reject_reasons(spark, scores, said, want):
    df = spark.createDataFrame([(scores, said)], f"scores {SCORES}, said string")
    assert df.select(rules.reject_reason(F.col("scores"), F.col("said"))).first()[0] == want


def test_threshold_reason(spark):
    df = spark.createDataFrame([((2, 1, 1),)], f"scores {SCORES}")
    assert df.select(rules.reject_reason(F.col("scores"), F.lit(None).cast("string"), 5)).first()[0] == "scored 4/6, below threshold 5"


@pytest.mark.parametrize("token,want", [("2", 2), ("2.9", 2), ('"2"', 2), ('"2.0"', 0), ("7", 2), ("-3", 0), ("true", 1), ("false", 0), ("null", 0), ('"x"', 0), (None, 0), ("[1]", 0)])
def test_clamped_scores(spark, token, want):
    assert one(spark, token, rules.clamp_score) == want


@pytest.mark.parametrize("q,leans,about", [
    ("What does the passage say?", True, False), ("According to the above, why?", True, False), ("Which page lists the doses?", False, True), ("What is the ISBN?", False, True),
    ("How long must seed rest?", False, False), ("What do dotted and dashed lines mean?", False, True), (None, False, False),
])
def test_question_gates(spark, q, leans, about):
    row = spark.createDataFrame([(q,)], "q string").select(rules.leans_on_passage(F.col("q")), rules.about_the_document(F.col("q"))).first()
    assert row == (leans, about)


def test_types(spark):
    for raw, want in ((" Factual ", "factual"), ("PROCEDURAL\t", "procedural"), ("causal", "factual"), (None, "factual")):
        assert one(spark, raw, rules.normal_type) == want


@pytest.mark.parametrize("check,want,note", [((True, True, True), "passed", None), ((False, True, True), "failed", "passage does answer the question"), ((True, False, True), "failed", "question is off-topic or implausible"), ((False, False, False), "failed", "answer is not the fixed abstention string"), ((None, True, True), "not_assessed", None), (None, "not_assessed", None)])
def test_abstention(spark, check, want, note):
    df = spark.createDataFrame([(check,)], "c struct<unanswerable boolean, plausible boolean, abstention_answer boolean>")
    assert df.select(rules.abstention_outcome(F.col("c")), rules.abstention_note(F.col("c"))).first() == (want, note)


@pytest.mark.parametrize("raw,array,obj", [
    ('```json\n[{"a":1}]\n```', [{"a": 1}], None), ('Sure! [{"a":1}] hope that helps', [{"a": 1}], {"a": 1}), ("not json at all", None, None), ('{"question":"Q?"}', None, {"question": "Q?"}),
    ("[1,2]", [1, 2], None), ('{"z": [3], "a": [4]}', [3], {"z": [3], "a": [4]}), ("", None, None), ("[" * 5000, None, None), ('```\n{"a": true}\n```', None, {"a": True}),
])
def test_json_repair(spark, raw, array, obj):
    bare = one(spark, raw, model_json.strip_fences)
    assert model_json.first_array(bare) == array and model_json.first_object(bare) == obj


def test_json_columns(spark):
    df = spark.createDataFrame([('[{"q": "a \\"b\\"", "n": 2.9}, 3, {"n": null}]',), ("none",), (None,)], "t string")
    rows = [r[0] for r in df.select(model_json.json_objects(F.col("t"))).collect()]
    assert [x.at for x in rows[0]] == [0, 2] and rows[0][0].fields == {"q": '"a \\"b\\""', "n": "2.9"} and rows[1:] == [None, None]
    assert one(spark, json.dumps('tab\t"q"é'), model_json.as_text) == 'tab\t"q"é'
    assert one(spark, "12", model_json.as_text) == "12"
    assert one(spark, '"true"', model_json.as_boolean) is None and one(spark, "true", model_json.as_boolean) is True


@settings(max_examples=25, deadline=None)
@given(st.text(max_size=30))
def test_strip_is_pythons(spark, t):
    assert one(spark, t, text.strip) == t.strip() or any(0x1C <= ord(c) <= 0x1F for c in t)


def test_sampling_arithmetic_differs_from_whole_numbers():
    assert any(math.floor(i * (n / k)) != i * n // k for n in range(1, 60) for k in range(1, n) for i in range(k))
    assert random.Random(42).sample(range(3), 1)
