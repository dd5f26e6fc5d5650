import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievework.llm.pair_defects import _clusters, find_defects, is_copy, is_empty, other_language, stopped
from sievework.llm.unfit_text import clean_labels, fit_model, normalise, score_documents, sentences, train

Q = "What moisture may maize from the valley have at most?"


@pytest.mark.parametrize("a", [None, "", "  \n", "\u00a0", "\u200b", "-", "?", "...", "N/A", "None", "NaN", "<p></p>", "&nbsp;", "[ ]", "(no answer)", "Answer:", "A: ", "#VALUE!", "[empty]", "TBD"])
def test_empty(a):
    assert is_empty(a)


@pytest.mark.parametrize("a", ["5 ml", "Yes", "No", "44 scoops", "Nothing grows there.", "The Lamatina clinic", "12", "An answer is given."])
def test_not_empty(a):
    assert not is_empty(a)


@pytest.mark.parametrize("a,is_it", [(Q, True), (Q.upper(), True), (f"{Q} {Q}", True), (f'You asked: "{Q}"', True), (f"<p>{Q}</p>", True), (Q.rstrip("?") + "...", True), ("Maize may have 14 percent.", False), (f"{Q} It may have 14 percent, and in wet years 15.", False), ("What moisture may maize have?", False), ("", False)])
def test_copies(a, is_it):
    assert is_copy(Q, a) is is_it


@pytest.mark.parametrize("q,a,is_it", [
    (Q, "Die Ernte wird im Schatten getrocknet und danach von dem Amt geprüft.", True), (Q, "Рекомендуется сушить зерно в тени.", True), (Q, "谷物应在阴凉处晾干", True), (Q, "穀物は日陰で乾かす。", True), (Q, "日", False), ("种子应该放多久？", "九天。", False), (None, "谷物应在阴凉处晾干", False), (Q, "Recomendam-se 74 quilos por hectare, e o grupo verifica a quantidade antes do plantio.", True),
    (Q, "Growers in the valley call this 'la tierra abierta de los campesinos' and teach it at budding.", False), (Q, "44 scoops", False), (Q, "Kelovan and Dubaris", False), ("Wie lange muss das Saatgut ruhen, bevor es gesät wird?", "Das Saatgut ruht 9 Tage im Schatten.", False),
    ("Wie lange muss das Saatgut ruhen, bevor es gesät wird?", "The store takes grain up to 9 percent of moisture.", True), (None, "Die Ernte wird im Schatten getrocknet.", False), ("Wie lange muss das Saatgut ruhen, bevor es gesät wird?", "Das Saatgut ruht of the", False),
])
def test_languages(q, a, is_it):
    assert other_language(q, a) is is_it


@pytest.mark.parametrize("a,end", [("It is so.", 1), ("It is (mostly) so.", 1), ("Is it “so”?", 1), ("Mix it,", -1), ("Mix it with (see", -1), ("they follow “as the", -1), ("and let the…", -1), ("closes after the", -1), ("44 scoops", 0), ("in the same way", 0)])
def test_stops(a, end):
    assert stopped(a) == end


def test_find_defects(spark):
    r = random.Random(4)
    towns = [f"{a}{b}{c}" for a in ("Ka", "Lo", "Mi", "Su") for b in ("ne", "ri", "ta") for c in ("bor", "vul", "dan")]
    kinds = [
        ("How should growers near {} dry their maize?", "Dry the crop for {} days, fill the bin to the rim, and let {} check the seal."),
        ("Which store takes the grain of {} in a wet year?", "The store takes grain up to {} percent moisture and sends wet lots to the {} dryer."),
        ("Who trains the keepers of goats around {} in spring?", "The course is run by the office, which trains {} keepers with help from the {} board."),
    ]
    rows, want = [], {}

    def add(q, a, able=True, defect=None):
        rows.append((len(rows), q, a, able))
        if defect:
            want[len(rows) - 1] = defect

    for i in range(900):
        q, a = r.choice(kinds)
        q, a = q.format(r.choice(towns)), a.format(r.randint(2, 99), r.choice(towns))
        if i % 10 == 0:
            a = a.rstrip(".")
        if i % 30 == 1:
            add(q, "The document does not contain the requested information.", r.choice([True, None]), "refusal")
        elif i % 30 == 2:
            add(q, "This information is not available in the provided document.", False)
        elif i % 30 == 3:
            add(q, " ".join(a.split()[: r.randint(4, 7)]), True, "truncated")
        elif i % 30 == 4:
            add(q, q, True, "copied_question")
        elif i % 30 == 5:
            add(q, "Diese Ernte wird von den Bauern im Schatten getrocknet und nicht verkauft.", False, "other_language")
        elif i % 30 == 6:
            add(q, r.choice([None, "", "n/a"]), True, "empty")
        elif i % 30 == 7:
            add(q, f"{r.randint(2, 99)} sacks")
        else:
            add(q, a)
    add(None, None, None, "empty")
    add(None, "The store takes grain up to 9 percent moisture and sends wet lots to the Kanebor dryer.")
    add(Q, "Very long. " * 20_000)
    df = spark.createDataFrame(rows + rows[:50] + [(None, Q, None, True)], "pair_id bigint, question string, answer string, answerable boolean").withColumn("id", F.lit("clash")).withColumn("opening", F.lit(1))
    got = find_defects(df, "pair_id", "question", "answer", F.col("answerable")).collect()
    assert len(got) == len({x.pair_id for x in got})
    assert {x.pair_id: x.defect for x in got} == want
    assert find_defects(df.limit(0), "pair_id", "question", "answer", F.col("answerable")).count() == 0


PROMPTS = [
    "How deep should a well be dug?", "Which month suits the sowing of lentils?", "Who repairs broken pumps?", "Where may goats graze after harvest?",
    "What does the blue form ask for?", "Why do leaves turn yellow early?", "When is the dryer switched off?", "How many sacks fit on one cart?",
    "Are children vaccinated at school?", "Can compost be made from reeds?", "Does frost harm young vines?", "Is rain water safe to drink?",
    "Name three kinds of millet.", "Give the price of a hand mill.", "Tell me about bees in winter.", "List tools needed for grafting.",
    "Explain crop rotation to beginners.", "Should hens sleep indoors?", "Must visitors wear boots?", "Whose duty is it to lock gates?",
]


def test_templates_that_recur(spark):
    """Recurrence over unrelated prompts reveals refusals of any wording; related prompts, or answers that bring something, reveal none."""
    said = [
        ("Kindly consult a local expert on such matters.", "refusal"),
        ("Alas, let us rather talk of something pleasant instead.", "refusal"),
        ("Thanks for writing. Nobody here may speak on that.", "refusal"),
        ("Twice a week, at dusk, by Guvirodi staff.", None),
        ("Each animal receives 26 ml a day.", None),
        ("It depends.", None),
    ]
    rows, want = [], {}

    def add(q, a, defect=None):
        rows.append((len(rows), q, a, True))
        if defect:
            want[len(rows) - 1] = defect

    for k, q in enumerate(PROMPTS):
        for a, defect in said:
            add(q, a.replace("Guvirodi", f"Guv{chr(97 + k)}rodi").replace("26", str(20 + k)), defect)
    for k in range(30):  # one kind of prompt
        add(f"How should growers near Kane{chr(97 + k % 26)}or treat their maize?", "Spread it thinly above ground beneath open sheds.")
    add("When may the dryer be used?", "We cannot use the dryer below ten degrees.")
    add("What are the fees?", "The document contains no mention of fees, so the service is free.")
    df = spark.createDataFrame(rows, "pair_id bigint, question string, answer string, answerable boolean")
    got = find_defects(df, "pair_id", "question", "answer", F.col("answerable")).collect()
    assert {x.pair_id: x.defect for x in got} == want


def test_alike_prompts_reveal_nothing(spark):
    """Where all prompts are of one kind, what recurs may well be their answer."""
    begins = [f"{a} {b} {c}" for a in ("How", "Where", "Why") for b in ("should", "might") for c in ("growers", "keepers", "carriers", "millers")]
    rows = [(i, f"{b} near Kanebor treat and store their maize?", a, True) for i, (b, a) in enumerate((b, a) for b in begins for a in ("They keep all of it in cool shade.", "Nobody does that around here any more."))]
    df = spark.createDataFrame(rows, "pair_id bigint, question string, answer string, answerable boolean")
    assert find_defects(df, "pair_id", "question", "answer", F.col("answerable")).count() == 0


def test_clusters_against_all_pairs(spark):
    """Links between similar clauses that end up in one cluster: at least nine tenths of all."""
    r = random.Random(5)
    base = [" ".join(f"w{r.randrange(40)}" for _ in range(r.randint(12, 30))) for _ in range(40)]
    texts = list(dict.fromkeys(base + [" ".join((w := b.split())[: r.randint(0, 1) or None] + [f"v{r.randrange(6)}"] * r.randint(0, 2) + w[r.randint(0, 2) :]) for b in base for _ in range(12)]))
    rows = [(i, t) for i, t in enumerate(texts)]
    got = {x.key: x.cluster for x in _clusters(spark.createDataFrame(rows, "key bigint, word string")).collect()}
    assert len(got) == len(rows)
    shingles = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in (t.split() for t in texts)]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if len(shingles[i] & shingles[j]) >= 0.8 * len(shingles[i] | shingles[j])]
    assert len(links) > 300
    assert sum(got[i] == got[j] for i, j in links) >= 0.9 * len(links)


def test_short_clauses_that_differ_by_a_word_are_one_cluster(spark):
    base = ["answering this goes beyond what we may do", "it would not be fitting for us to comment on @", "we are unable to give details on @ or @"]
    rows = [(10 * i + j, lead + b) for i, b in enumerate(base) for j, lead in enumerate(("", "but ", "however ", "well "))]
    got = {x.key: x.cluster for x in _clusters(spark.createDataFrame(rows, "key bigint, word string")).collect()}
    assert sum(got[k] == k // 10 * 10 for k, _ in rows) >= 11  # each pair meets with a chance over 0.999


def test_latest_delivery_of_a_pair_holds(spark):
    rows = [(1, Q, "It may have 14 percent.", True, 1), (1, Q, None, True, 2), (2, Q, "", True, 1), (2, Q, "It may have 14 percent.", True, 2), (3, Q, None, True, None)]
    df = spark.createDataFrame(rows, "pair_id bigint, question string, answer string, answerable boolean, at int")
    got = find_defects(df, "pair_id", "question", "answer", F.col("answerable"), delivered=F.col("at")).collect()
    assert {x.pair_id: x.defect for x in got} == {1: "empty", 3: "empty"}


def test_placeholder_texts_are_empty():
    assert is_empty("Lorem ipsum dolor sit amet, consectetur adipiscing elit.") and is_empty("N/A " * 20) and not is_empty("Lore and legend are no guide to sowing, says the handbook.")


@pytest.mark.parametrize("s", ["She stripped n a k e d there", "she stripped n.a.k.e.d there", "She  stripped na\u200bked there", "SHE STRIPPED NAAAAKED THERE", "she stripped nаkеd there", "she 5tr1pp3d n4k3d there"])
def test_disguises(s):
    assert normalise(s) == "she stripped naked there"


def test_sentences():
    assert sentences(None) == [] and sentences(" \n ") == []
    assert sentences("One. Two!\nThree 3.5") == ["one.", "two!", "three #"]


def _labelled(n, seed):
    r = random.Random(seed)
    fit = ["The store takes grain up to {} percent moisture.", "Dirty tools spread mildew near {}.", "Naked barley from {} threshes without loss.", "Cocks and hens of {} are kept apart.", "Rats must be driven out of the {} store."]
    bad = {
        "abusive": ["Shut your mouth, you idiot of {}.", "I will break your fingers, {}.", "Go to hell, {}, you moron."],
        "hateful": ["The Drovani are vermin and must leave {}.", "Never hire a Kelmari in {}, they are thieves by blood."],
        "sexual": ["Hot nude pics of lonely singles in {}.", "She stripped naked and kissed {} all night."],
    }
    texts, labels = [], []
    for i in range(n):
        names = [f"{r.choice('BDKLM')}{r.choice('aeiou')}{r.choice('bdkl')}{r.choice('aeiou')}n" for _ in range(6)]
        s = [r.choice(fit).format(x) for x in names[:5]]
        label = "none"
        if i % 4 == 0:
            label = r.choice(list(bad))
            s.insert(r.randrange(6), r.choice(bad[label]).format(names[5]))
        texts.append(" ".join(s))
        labels.append(label)
    return texts, labels


def test_classifier_on_held_out_texts():
    texts, labels = _labelled(600, 1)
    noisy = ["none" if i % 40 == 0 else x for i, x in enumerate(labels)]
    model = train(texts, noisy)
    texts, labels = _labelled(300, 2)
    right = sum(("none" if (b := model.sentence_scores(sentences(t)).max(0)).max() < 0.75 else ("abusive", "hateful", "sexual")[int(b.argmax())]) == x for t, x in zip(texts, labels))
    assert right >= 294


def test_training_on_little_or_nothing():
    for texts, labels in (([], []), ([None, ""], ["none", "abusive"]), (["Only fit text."], ["none"]), (["Bad."], ["abusive"])):
        assert train(texts, labels).sentence_scores(["some text"]).max() < 0.5


def test_scoring(spark):
    texts, labels = _labelled(400, 3)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(900, None), (901, ""), (902, "Dirty tools spread mildew near Kaben. " * 30_000), (None, "x"), (0, texts[0])], "doc_id bigint, text string").withColumn("category", F.lit("clash"))
    marks = [(i, x.upper() + " " if i % 5 == 0 else x, "rater_a1") for i, x in enumerate(labels)] + [(1, "none", "rater_b1"), (2, "nonsense", "b"), (3, None, "b"), (None, "none", "b")]
    known = spark.createDataFrame(marks, "doc_id bigint, category string, rater string")
    assert clean_labels(known).count() == 400
    scored = score_documents(docs, fit_model(docs, known)).collect()
    assert len(scored) == 404
    by = {x.doc_id: x for x in scored}
    assert np.mean([(by[i].category or "none") == x for i, x in enumerate(labels)]) > 0.97
    assert by[900].category is None and by[901].abusive == 0 and by[902].category is None
    nothing = fit_model(docs, known.limit(0))
    assert all(x.category is None for x in score_documents(docs, nothing).collect())
    assert score_documents(docs.limit(0), nothing).count() == 0
    assert fit_model(docs.limit(0), known).bias.max() < 0


def test_queries_keep_their_columns(spark, small):
    from sievework.llm import oracle, queries

    columns = {
        "p1_found": ["plan_id", "cell_id"], "p2_found": ["pair_id"], "p3_found": ["pair_id_a", "pair_id_b"], "p4_found": ["pair_id", "defect"],
        "p5_found": ["source", "group_source"], "p6_found": ["doc_id"], "p7_found": ["doc_id", "item_id"], "p8_found": ["doc_id", "category"],
    }
    known = queries.queries()
    assert set(oracle.oracle_sql()) <= set(known)
    for name, want in columns.items():
        df = known[name](spark, small)
        assert df.columns == want
        assert df.count() == df.distinct().count()
