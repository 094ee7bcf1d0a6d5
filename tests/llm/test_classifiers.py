import random
import zlib

import numpy as np
import pytest

from serpscope.llm import quality as Q
from serpscope.llm import toxicity as X

LABELS = "doc_id long, quality int, toxic int, text string"
DOCS = "doc_id long, text string, label int, score double"


@pytest.fixture(scope="module")
def tables(spark):
    draw = random.Random(9)
    names = ["".join(draw.choice("abcdefgh") for _ in range(draw.randint(2, 8))) for _ in range(300)]
    rows, labels = [], []
    for i in range(700):
        words = [draw.choice(names) for _ in range(draw.randint(5, 300))]
        bad, toxic = i % 6 == 0, i % 5 == 0
        if bad:
            at = draw.randrange(len(words))
            words[at:at] = ["###" + w.upper() + "!!" for w in words[at : at + 60]]
        if toxic:
            for _ in range(draw.randint(1, 4)):
                words.insert(draw.randrange(len(words)), draw.choice(["zorkish", "zorked", "quuxer"]))
        rows.append((i, " ".join(words), 1, 0.5))
        if i % 4:
            labels.append((i, int(not bad), int(toxic), "x"))
    labels += [(1, None, None, "x"), (None, 1, 1, "x"), (9999, 0, 1, "x"), (2, 1, 0, "x")]
    rows += [(None, "some text", 1, 0.5), (1000, None, None, None), (1001, "", 1, 0.5)]
    rows += [(1002, "word " * 40_000, 1, 0.5), (1002, "word " * 40_000, 1, 0.5)]
    return spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS)


def test_quality_on_held_out_rows(tables):
    got = Q.score_quality(*tables).collect()
    assert len(got) == 705 and all(0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"] and r["doc_id"] < 700]
    good = [r["score"] for r in held if r["doc_id"] % 6]
    bad = [r["score"] for r in held if r["doc_id"] % 6 == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.95
    assert all(r["predicted"] == (r["score"] >= 0.3) for r in got)
    same = [r["score"] for r in got if r["doc_id"] == 1002]
    assert len(same) == 2 and same[0] == same[1]
    empty = {r["score"] for r in got if r["doc_id"] in (1000, 1001)}
    assert len(empty) == 1


def test_scores_repeat_and_ignore_other_columns(spark, tables):
    docs, labels = tables
    other = docs.withColumn("lang", docs["text"]).withColumn("doc_id", docs["doc_id"])
    a = {(r["doc_id"], r["score"]) for r in Q.score_quality(docs, labels).collect()}
    b = {(r["doc_id"], r["score"]) for r in Q.score_quality(other, labels).collect()}
    assert a == b


def test_held_out_rows_are_not_learnt_from(spark, tables):
    docs, labels = tables
    turned = labels.withColumn("quality", Q.F.when(Q.held_out(labels["doc_id"]), 0).otherwise(labels["quality"]))
    a = {(r["doc_id"], r["score"]) for r in Q.score_quality(docs, labels).collect()}
    b = {(r["doc_id"], r["score"]) for r in Q.score_quality(docs, turned).collect()}
    assert a == b


def test_gradient():
    draw = np.random.default_rng(0)
    bags = [draw.random((n, Q.FEATURES)) for n in (1, 3, 2)]
    model = Q.fit(bags, np.array([1.0, 0.0, 1.0]))
    w = {k: v.astype(float) for k, v in model.weights.items()}
    x, start, y = np.concatenate(bags), np.array([0, 1, 4]), np.array([1.0, 0.0, 1.0])

    def loss():
        p = Q._forward(w, x, start)["p"]
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    found = Q._gradient(w, x, start, y)
    for name, value in w.items():
        at = tuple(draw.integers(s) for s in value.shape)
        value[at] += 1e-5
        up = loss()
        value[at] -= 2e-5
        down = loss()
        value[at] += 1e-5
        assert abs((up - down) / 2e-5 - found[name][at]) < 1e-5, name


def test_toxicity_on_held_out_rows(tables):
    got = X.score_toxicity(*tables).collect()
    assert len(got) == 705
    held = [r for r in got if r["held_out"] and r["doc_id"] < 700]
    toxic = [r for r in held if r["doc_id"] % 5 == 0]
    clean = [r for r in held if r["doc_id"] % 5]
    assert np.mean([r["toxic"] for r in toxic]) > 0.95
    assert np.mean([r["toxic"] for r in clean]) < 0.02
    assert all(0 <= r[f"p_{c}"] <= 1 for r in got for c in X.CATEGORIES)


def test_later_models_use_earlier_ones():
    draw = np.random.default_rng(2)
    documents = [np.unique(draw.integers(0, 60, 12)).astype(np.int32) for _ in range(800)]
    first = np.array([(3 in d) or (5 in d) for d in documents], dtype=float)
    second = first * np.array([7 in d for d in documents])
    chain = X.fit_chain(documents, np.column_stack((first, second)))
    assert len(chain.models[1]) == len(chain.models[0]) + 1 and chain.models[1][-2] > 0.3
    assert ((chain.predict(documents) > 0.5) == np.column_stack((first, second))).mean() > 0.97


def test_without_labels_or_rows(spark, tables):
    docs, labels = tables
    none = labels.where("false")
    assert {r["score"] for r in Q.score_quality(docs, none).collect()} == {0.5}
    assert {r["p_toxic"] for r in X.score_toxicity(docs, none).collect()} == {0.0}
    assert Q.score_quality(docs.where("false"), labels).count() == 0
    assert X.score_toxicity(docs.where("false"), labels).count() == 0


def test_passages_are_counted_in_slices(monkeypatch):
    text = ("Some words, in 12 LINES! é-ü\n\n" * 900).encode() + b" end"
    whole = Q.passages(text)
    monkeypatch.setattr(Q, "COUNTED", 1)
    assert (Q.passages(text) == whole).all() and len(whole) > 50


def test_an_id_that_repeats_is_learnt_from_once(spark):
    rows = [(3, f"text {i}") for i in range(200)] + [(4, "other")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(3, 1), (4, 0), (3, 1)], "doc_id long, quality int")
    got = Q.drawn(docs, labels, "quality", 10).collect()
    kept = [r for r in (3, 4) if zlib.crc32(str(r).encode()) % 5]
    assert sorted(r["doc_id"] for r in got) == kept and kept
