"""Features against plain Python, held-out accuracy, and edge cases of the grades."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfwise.llm.quality import LEAST_DOCUMENTS, SHRINK, features_of, fit, good_documents, graded, graded_documents, score, train
from shelfwise.llm.wordhash import SPACE, chunks, word_hashes

SF_DIR = "/root/testdata/sf0.1"


def test_words_like_split():
    texts = ["a bb\tccc", "", "ccc", "  x ", "é\x0bé", "bb" * 4000, "\n"]
    found = []
    for chunk in chunks(pa.array(texts), limit=12):
        s, e, first = chunk.words()
        hashes = word_hashes(chunk, s, e)
        for i in range(len(first) - 1):
            at = range(first[i], first[i + 1])
            found.append(([chunk.data[s[k] : e[k]].tobytes() for k in at], hashes[first[i] : first[i + 1]].tolist()))
    assert [w for w, _ in found] == [t.encode().split() for t in texts]
    hash_of = {}
    for words, hashes in found:
        for word, h in zip(words, hashes):
            assert hash_of.setdefault(word, h) == h
    assert len(set(hash_of.values())) == len(hash_of) and SPACE.sum() == 6


def test_features_do_not_depend_on_neighbours():
    texts = ["The same, THE end!!", "", "x x x x", "The same, THE end!!"]
    together = next(chunks(pa.array(texts)))
    flat, first = features_of(together)
    for i, text in enumerate(texts):
        alone, _ = features_of(next(chunks(pa.array([text]))))
        assert flat[first[i] : first[i + 1]].tolist() == alone.tolist()


def test_thresholds_are_ordered_and_grades_recovered():
    rng = np.random.default_rng(1)
    grades = rng.integers(0, 3, 600)
    features = [np.unique(np.append(rng.integers(10, 5000, 30), grade)).astype(np.uint32) for grade in grades]
    model = fit(features, grades)
    assert (np.diff(model.thresholds) > 0).all()
    first = np.cumsum([0, *map(len, features)])
    below = model.at_most(model.scores(np.concatenate(features), first))
    assert (((below < 0.5).sum(axis=1)) == grades).mean() > 0.99


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    held_out = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(4)) == 0
    model = train(docs, graded(labels.filter(~held_out)))
    rows = score(docs.select("doc_id", "text"), model).join(graded(labels.filter(held_out)), "doc_id").toPandas()
    kept = rows.tail_probability >= 0.5
    assert kept[rows.grade == 2].mean() > 0.98
    assert (~kept)[rows.grade == 0].mean() > 0.97
    assert (~kept)[rows.grade == 1].mean() > 0.7


@pytest.fixture
def labelled(table):
    rows = [(i, ("good words here " if i % 2 else "bad### things&&& ") * (1 + i % 5), i, "x") for i in range(200)]
    docs = table("doc_id long, text string, quality int, whole_text string", *rows, (None, None, 0, ""), (500, "", 0, None), (1, rows[1][1], 1, "x"))
    return docs, table("doc_id long, quality int, toxic int", *((i, i % 2, 0) for i in range(150)), (1, 1, 0), (None, 1, 1), (3, None, None))


def test_grades(spark, labelled):
    docs, labels = labelled
    out = graded_documents(docs, labels).collect()
    assert len(out) == 203
    assert all(r.kept == bool(r.doc_id % 2) for r in out if r.doc_id is not None and r.doc_id < 200)
    model = train(docs, graded(labels))
    stay = good_documents(docs, model)
    assert stay.columns == docs.columns and {r.doc_id for r in stay.collect()} >= set(range(1, 200, 2))


def test_empty_tables(spark, table, labelled):
    docs, labels = labelled
    assert graded_documents(docs.limit(0), labels).collect() == []
    out = graded_documents(docs, labels.limit(0)).collect()
    assert len(out) == 203 and all(r.kept and r.tail_probability == 1 for r in out)
    assert LEAST_DOCUMENTS > 1


def test_fit_against_an_independent_optimiser():
    """Thresholds and probabilities of a small problem against a plain descent with numerical slopes."""
    rng = np.random.default_rng(11)
    x = rng.random((900, 3)) < [0.5, 0.4, 0.3]
    latent = x @ np.array([2.0, -2.5, 2.0]) + rng.logistic(size=900)
    grades = np.digitize(latent, [-0.5, 1.0])
    model = fit([np.flatnonzero(row).astype(np.uint32) for row in x], grades)
    assert model.features.tolist() == [0, 1, 2]

    def probabilities(p):
        cuts = np.array([p[3], p[3] + np.exp(p[4])])
        below = 1 / (1 + np.exp(-(cuts[None, :] - (x @ p[:3])[:, None])))
        return np.hstack([below, np.ones((len(x), 1))]) - np.hstack([np.zeros((len(x), 1)), below])

    def loss(p):
        return -np.log(probabilities(p)[np.arange(len(x)), grades]).mean() + SHRINK / 2 * (p[:3] ** 2).sum()

    def slope(f, p, h=1e-5):
        return np.array([(f(p + h * e) - f(p - h * e)) / (2 * h) for e in np.eye(len(p))])

    p = np.zeros(5)
    for _ in range(60):  # Newton steps from numerical second derivatives
        down = slope(loss, p)
        curve = np.array([slope(lambda q: slope(loss, q)[i], p, 1e-3) for i in range(5)])
        move = np.linalg.solve(curve + 1e-6 * np.eye(5), down)
        size = 1.0
        while loss(p - size * move) > loss(p) and size > 1e-6:
            size /= 2
        p = p - size * move
    assert np.abs(slope(loss, p)).max() < 1e-6
    assert np.allclose(model.weights, p[:3], atol=0.02)
    assert np.allclose(model.thresholds, [p[3], p[3] + np.exp(p[4])], atol=0.02)
    first = np.concatenate([[0], np.cumsum(x.sum(axis=1))])
    below = model.at_most(model.scores(np.nonzero(x)[1].astype(np.uint32), first))
    assert np.abs(below[:, 0] - probabilities(p)[:, 0]).max() < 0.01
