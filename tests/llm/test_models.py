import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import edge
from crestline.llm import language_id, quality_model, toxicity, sampling
from crestline.llm.common import table

DATA = "/root/testdata/sf0.01"


def auc(rows, label):
    scores = sorted((r.score, label[r.doc_id]) for r in rows if r.held_out and r.doc_id in label)
    rank = [i + 1 for i, (_, y) in enumerate(scores) if y]
    n = len(rank)
    return (sum(rank) - n * (n + 1) / 2) / (n * (len(scores) - n))


def labels_of(spark, name):
    return {r.doc_id: r[name] for r in table(spark, DATA, "labels").collect()}


def test_language_held_out(spark):
    got = language_id.op4_language_id(spark, DATA).collect()
    lang = {r.doc_id: r.lang for r in table(spark, DATA, "documents").collect()}
    held = [r for r in got if r.held_out]
    assert len(got) == len(lang) and np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in got)


def test_language_of_awkward_rows(spark):
    df = edge.frame(spark)
    model = language_id.train(df)
    rows = language_id.identify(df, model).collect()
    assert len(rows) == df.count() and rows[0].asDict().keys() == {*df.columns, "lang_pred"}  # score replaced
    by_id = {r.doc_id: (r.lang_pred, r.score) for r in rows if r.doc_id is not None}
    assert by_id[100] == by_id[101] == by_id[102] == by_id[112] == ("und", 0.0)
    assert by_id[108][0] in ("en", "fr", "de")
    empty = language_id.train(df.limit(0))
    assert {r.lang_pred for r in language_id.identify(df, empty).collect()} == {"und"}
    assert language_id.identify(df.limit(0), model).count() == 0


def test_ngrams_are_counted_per_letter_run():
    at, counts = language_id.grams("Ab1b")
    # letters a b b; pairs _a ab b_ _b b_; triples _ab ab_ b_b _b_
    assert counts.sum() == 3 + 5 + 4
    assert language_id.grams("AB b")[0].tolist() == at.tolist()


def test_temperature_is_the_best_of_the_grid():
    z = np.array([[4.0, 0], [4, 0], [0, 4], [4, 0]])
    y = np.array([0, 0, 1, 1])
    t = language_id.calibrated(z, y)
    loss = lambda t: -np.log(language_id.softmax(z / t)[np.arange(4), y]).mean()
    assert loss(t) <= min(loss(t * 1.1), loss(t * 0.9))


def test_quality_held_out(spark):
    got = quality_model.op3_quality_classifier(spark, DATA).collect()
    assert auc(got, labels_of(spark, "quality")) > 0.97


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 19), min_size=1, max_size=8, unique=True), st.integers(0, 1000))
def test_pairwise_term_equals_the_double_sum(at, seed):
    turn = np.random.default_rng(seed)
    m = quality_model.Machine(0.3, turn.normal(size=20), turn.normal(size=(20, 3)))
    at, x = np.array(at), turn.normal(size=len(at))
    want = 0.3 + m.weights[at] @ x
    for i in range(len(at)):
        for j in range(i):
            want += m.factors[at[i]] @ m.factors[at[j]] * x[i] * x[j]
    assert m.raw(at, x) == pytest.approx(want)


def test_classifiers_of_awkward_rows(spark):
    df = edge.frame(spark)
    labels = spark.createDataFrame(
        [(i, i % 2, (i + 1) % 2) for i in range(20)] + [(None, 1, 1), (100, None, 0), (5, 1, 0)],
        "doc_id bigint, quality int, toxic int",
    )
    for labelled in (labels, labels.limit(0)):
        machine = quality_model.train(df, labelled, "quality")
        model = toxicity.train(df, labelled)
        for out in (quality_model.classify(df, machine), toxicity.classify(df, model)):
            rows = out.collect()
            assert len(rows) == df.count() and all(0 <= r.score <= 1 for r in rows)
    assert quality_model.classify(df.limit(0), machine).count() == 0 and toxicity.classify(df.limit(0), model).count() == 0


# --- toxicity -------------------------------------------------------------------------


def test_toxicity_held_out(spark):
    got = toxicity.op2_toxicity(spark, DATA).collect()
    label = labels_of(spark, "toxic")
    assert auc(got, label) > 0.85
    clean = [r.predicted for r in got if label.get(r.doc_id) == 0]
    assert np.mean(clean) < 0.01


def test_automaton_equals_edit_distance():
    terms = ["moron", "worthless", "scum", "straße", "pathetic"]
    found = toxicity.automaton(terms)
    turn = random.Random(4)
    letters = sorted({c for t in terms for c in t} | set("xyz"))
    words = set(terms)
    for t in terms:
        for _ in range(250):
            w = list(t)
            for _ in range(turn.randint(0, 3)):
                k = turn.randrange(len(w) + 1)
                what = turn.randrange(3)
                if what == 0:
                    w.insert(k, turn.choice(letters))
                elif k < len(w) and len(w) > 1:
                    w[k : k + 1] = [turn.choice(letters)] if what == 1 else []
            words.add("".join(w))
    words = sorted(words)
    codes = np.array([found.classes.get(c, 0) for c in "".join(words)], np.int16)
    sizes = np.array([len(w) for w in words])
    got = found.run(codes, np.cumsum(sizes) - sizes, sizes)
    for w, e in zip(words, got.tolist()):
        # the first letter is fixed: the distance is that of the rests
        fits = [d for t in terms if w[:1] == t[:1] and (d := edge.edits(w[1:], t[1:])) <= toxicity.allowed(t)]
        assert e == (min(fits) if fits else -1), w


def test_signs_are_read_as_letters_and_quotation_lowers_the_score():
    reader = toxicity.Reader(toxicity.automaton(["idiot", "scum"]))
    hits = lambda t: reader.features(t)
    assert hits("such an 1d10t")[1] == 1 and hits("you $cum")[1] == 1 and hits("id*ot he")[3] > 0
    assert hits("IDIOT!")[1] == 1 and not hits("idyllic riot")[0] and not hits(None).any() and not hits("").any()
    assert hits('he said "idiot" again')[5] > 0 and hits('he said "idiot" again')[4] < hits("you idiot")[4]
    assert hits("scum and idiot")[4] > hits("scum and nothing")[4]


def test_samples_are_bounded_whatever_is_copied(spark):
    rows = [(i, "the same text", "en") for i in range(400)] + [(7, "one row many times", "en")] * 300 + [(i, f"t{i}", "fr") for i in range(30)]
    df = spark.createDataFrame(rows, "id int, text string, lang string")
    counts = sampling.class_counts(df, "lang")
    for parts in (1, 6):
        got = sampling.first_rows(df.repartition(parts), "lang", counts, 50, "id", "text").groupBy("lang").count().collect()
        assert {r["lang"]: r["count"] for r in got} == {"en": 50, "fr": 30}
