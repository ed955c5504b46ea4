"""Operator 13 against kernels of plain sets, and on texts it never saw."""

import math
import re

import numpy as np
import pyarrow as pa
import pytest

from maillage.llm import language, queries
from maillage.llm.toxicity import held_out
from tests.llm.conftest import awkward_rows

SF = "/root/testdata/sf0.01"


def sets(text, longest=4):
    """n-grams of a text, by plain loops."""
    found = set()
    for word in re.sub(r"[\W\d_]+", " ", (text or "").lower()).split():
        padded = f" {word} "
        found |= {padded[i : i + n] for n in range(1, longest + 1) for i in range(len(padded) - n + 1)} - {" "}
    return found


@pytest.fixture(scope="module")
def model(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    return language.train(documents.where(~held_out()), language.Setting(sample=200, landmarks=20))


def test_kernels_are_those_of_sets(spark):
    texts = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(60).collect()]
    texts += ["Été 12 à l'est", "", "x", "漢字 word", "don't"]
    langs = ["a" if i % 3 else "b" for i in range(len(texts))]
    model = language.fit(pa.array(texts), langs, language.Setting(landmarks=9))
    got = np.concatenate(list(language.kernels(pa.array(texts), model.letters, model.grams, model.landmarks, 4)))
    turn = sorted(range(len(texts)), key=lambda i: (sum(langs[j] == langs[i] for j in range(i)), i))[:9]
    marks = [sets(texts[i]) for i in sorted(turn)]
    known = set().union(*marks)
    for i, text in enumerate(texts):
        own = sets(text) & known
        want = [len(own & m) / math.sqrt(max(len(own), 1) * max(len(m), 1)) for m in marks]
        np.testing.assert_allclose(got[i], want, atol=1e-6)


def test_scores_are_those_of_the_formula(model):
    text = "Ein neuer Text über alles und nichts"
    present = np.zeros((1, len(model.grams)))
    own = language.Grams(pa.array([text]), model.letters, 4, model.grams)
    present[own.of(0, 1)] = 1
    near = present @ model.landmarks / math.sqrt(present.sum())
    scores = np.exp((near @ model.weights + model.constants) * model.scale)[0]
    best, score = language.predicted_texts(model, pa.array([text]))
    assert best[0] == scores.argmax() and score[0] == pytest.approx(scores.max() / scores.sum(), rel=1e-4)


def test_held_out_documents(spark):
    got = queries.op13_language(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (got["lang"] == got["lang_pred"]).mean() > 0.98
    assert got["score"].between(0, 1).all()


def test_awkward_rows(docs, model):
    frame = docs([*awkward_rows(), (90, "1234 !!"), (91, "漢字 だけ"), (92, "the and of " * 30)]).withColumnRenamed("mark", "lang_pred")
    got = language.predicted(frame, model).toPandas()
    assert len(got) == len(awkward_rows()) + 3 and list(got.columns).count("lang_pred") == 1
    by_text = {r.text: r for r in got.itertuples()}
    for text in (None, "", " \n\t", "1234 !!"):
        assert by_text[text].lang_pred == "und" and by_text[text].score == 0
    assert by_text["漢字 だけ"].lang_pred in model.labels and by_text["the and of " * 30].lang_pred == "en"
    assert language.predicted(docs([]), model).collect() == []


def test_alone_or_in_a_batch(model):
    texts = ["la casa de", "word " * 5000, None, "der die das", "le la les " * 700]
    whole = language.predicted_texts(model, pa.array(texts))
    for i, text in enumerate(texts):
        one = language.predicted_texts(model, pa.array([text], pa.string()))
        assert one[0][0] == whole[0][i] and one[1][0] == pytest.approx(whole[1][i], rel=1e-5)


def test_nothing_to_learn(docs):
    for rows in ([], [(1, None), (2, "123")]):
        model = language.train(docs(rows))
        assert model is None
        assert [(r["lang_pred"], r["score"]) for r in language.predicted(docs([(1, "a")]), model).collect()] == [("und", 0.0)]
    one = language.train(docs([(1, "hello world"), (2, "hello there")]))
    assert [r["lang_pred"] for r in language.predicted(docs([(1, "hello"), (2, None)]), one).orderBy("doc_id").collect()] == ["en", "und"]
