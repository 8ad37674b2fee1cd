"""Toxicity: held-out accuracy, learned pairs, awkward rows."""

import zlib

import numpy as np
from frames import LONG, awkward, clashing, values

from venuelens.llm import queries, toxicity

SF_DIR = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    got = {r.doc_id: r for r in queries.op1_toxicity(spark, SF_DIR).collect()}
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    held = [(got[i].score, y) for i, y in labels.items() if got[i].held_out]
    scores, truth = np.array(held).T
    assert ((scores >= 0.5) == truth).mean() > 0.98
    assert (scores[truth == 1][:, None] > scores[truth == 0][None, :]).mean() > 0.92


def test_pairs_are_learned_that_weights_cannot():
    """A word from each of two groups is toxic, two of one group are not."""
    random = np.random.default_rng(2)
    rows, labels = [], []
    for _ in range(1200):
        a, b = random.integers(0, 2, 2)
        noise = random.integers(100, 400, 6)
        rows.append(np.unique([*noise, 10 + a, 20 + b]))
        labels.append(float(a == b))
    settings = toxicity.Settings(epochs=60, factors=4)
    model = toxicity.fit(rows[:900], np.array(labels[:900]), settings)
    right = (toxicity.predict(model, [set(r) for r in rows[900:]]) >= 0.5) == np.array(labels[900:])
    assert right.mean() > 0.9


def test_awkward_rows(spark):
    docs = clashing(awkward(spark))
    labelled = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (3, None), (None, 1), (99, 1)], "doc_id long, toxic int")
    model = toxicity.train(docs, labelled)
    scored = docs.withColumn("got", toxicity.score(docs, model))
    scores = dict(values(scored.where("doc_id is not null"), "doc_id", "got"))
    assert len(scores) == 9 and all(0 <= s <= 1 for s in scores.values())
    assert scores[3] == scores[4] == scores[5]
    assert toxicity.keep_clean(docs, model).columns == docs.columns


def test_no_labels_and_empty_tables(spark):
    docs = awkward(spark)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.train(docs, none)
    assert toxicity.predict(model, [set(), toxicity.terms("a b")]).tolist() == [0.5, 0.5]
    assert docs.limit(0).select(toxicity.score(docs, model)).count() == 0


def test_length_does_not_move_a_score(spark):
    model = toxicity.Model(-3.0, np.sort(np.array(sorted(toxicity.terms("idiot")))), np.full(2, 4.0), np.zeros((2, 4)))
    short, long = toxicity.predict(model, [toxicity.terms("you idiot"), toxicity.terms(LONG + " you idiot")])
    assert short == long > 0.5


def test_pairs_are_learned_from_texts(spark):
    """The same through train() and score(): no word tells anything alone."""
    random = np.random.default_rng(2)
    rows = []
    for i in range(1200):
        a, b = random.integers(0, 2, 2)
        noise = " ".join(f"n{j}" for j in random.integers(100, 400, 6))
        rows.append((i, f"{noise} a{a} b{b}", int(a == b)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.train(docs, docs.where("doc_id < 900").select("doc_id", "toxic"), settings=toxicity.Settings(epochs=60))
    rated = docs.where("doc_id >= 900").select("toxic", toxicity.score(docs, model).alias("got")).collect()
    assert np.mean([(r.got >= 0.5) == r.toxic for r in rated]) > 0.9


def test_a_neutral_word_is_learned_with_an_insult(spark):
    """An insult is toxic with a group's name only; the name is as frequent in both classes."""
    rows = [(i, "insult group" if i < 20 else "insult" if i < 60 else "group" if i < 220 else "plain", int(i < 20 or i >= 900)) for i in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.train(docs, docs.select("doc_id", "toxic"))
    assert toxicity.terms("group") <= set(model.terms.tolist())


def test_a_score_is_the_sum_over_all_pairs():
    random = np.random.default_rng(3)
    model = toxicity.Model(-0.3, np.arange(50), random.normal(size=50), random.normal(size=(50, 4)))
    rows = [set(random.choice(70, size, replace=False).tolist()) for size in (0, 1, 2, 9, 40)]
    for row, got in zip(rows, toxicity.predict(model, rows)):
        known = sorted(t for t in row if t < 50)
        z = model.bias + sum(model.weights[t] for t in known)
        for i, a in enumerate(known):
            for b in known[i + 1 :]:
                z += sum(model.factors[a, f] * model.factors[b, f] for f in range(4))
        assert abs(got - 1 / (1 + np.exp(-z))) < 1e-9


def test_telling_pairs_are_those_of_a_double_loop():
    """A term is in a telling pair exactly if a plain double loop over all pairs says so."""
    random = np.random.default_rng(4)
    labels = (random.random(400) < 0.3).astype(float)
    rows = [np.flatnonzero(random.random(30) < 0.2 + 0.15 * y * (np.arange(30) < 6)).astype(np.int64) for y in labels]
    rows = [np.union1d(r, [28, 29]) if y and i % 2 else r for i, (r, y) in enumerate(zip(rows, labels))]
    settings = toxicity.Settings(pair_evidence=15.0)

    def ratio(has):
        toxic, count = float((has & (labels == 1)).sum()), float(has.sum())
        return float(toxicity._ratios(np.array(toxic), np.array(count), float(labels.sum()), 400.0))

    has = [np.array([t in set(r.tolist()) for r in rows]) for t in range(30)]
    expected = {t for a in range(30) for b in range(30)
                if ratio(has[a] & has[b]) - max(ratio(has[a]), ratio(has[b])) >= 15 for t in (a, b)}
    assert expected and set(toxicity.in_telling_pairs(rows, labels, np.arange(30), settings).tolist()) == expected
