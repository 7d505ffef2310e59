"""Grams and machines against plain Python, held-out accuracy, and edge cases."""

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfwise.llm.language import (
    BUCKET_BITS, COST, Sample, family_of, fit, grams, has_letter, languages, margins, predict, train,
)
from shelfwise.llm.wordhash import chunks

SF_DIR = "/root/testdata/sf0.1"


def bucket(gram: bytes) -> int:
    number = int.from_bytes(gram, "big") + ((1 << 24) if len(gram) == 2 else 0)
    return (number * 0x9E3779B1 % (1 << 32)) >> (32 - BUCKET_BITS)


def plain_grams(text: str) -> Counter:
    data = b" " + bytes(b + 32 if 65 <= b < 91 else b if 97 <= b < 123 or b >= 128 else 32 for b in text.encode()) + b" "
    found = [data[i : i + n] for n in (2, 3) for i in range(len(data) - n + 1)]
    return Counter(bucket(gram) for gram in found if gram.strip(b" "))


def test_grams_like_plain_ones_and_apart_from_neighbours():
    texts = ["Ab c", "", "x", "É!", "  ", "a" * 5000, "12", "zz top"]
    for limit in (1, 9, 1 << 20):
        got = []
        for part in chunks(pa.array(texts), limit=limit):
            found, first = grams(part)
            got += [Counter(found[first[i] : first[i + 1]].tolist()) for i in range(len(first) - 1)]
        assert got == [plain_grams(t) for t in texts]


def test_machine_solves_the_dual():
    """At the optimum no single dual variable can be moved to lower the loss."""
    rng = np.random.default_rng(5)
    shares = rng.dirichlet(np.ones(40), 100)
    sign = np.where(shares[:, :8].sum(axis=1) > shares[:, 8:16].sum(axis=1), 1.0, -1.0)
    sample = Sample(np.tile(np.arange(40), 100), shares.ravel(), np.arange(101) * 40)
    machine = fit(sample, np.arange(100), sign, (0, 1), epochs=1000)
    scale = 1 / np.sqrt(shares.mean(axis=0) + 1e-6)
    weights = machine.weights[:40] / scale
    x = shares * scale
    x /= np.linalg.norm(x, axis=1)[:, None]
    seen = np.arange(100) % 5 > 0
    slack = np.maximum(0, 1 - sign[seen] * (x[seen] @ weights))
    # stationary point of |w|^2 / 2 + cost * squared hinge
    slope = weights - 2 * COST * (slack * sign[seen]) @ x[seen]
    assert np.abs(slope).max() < 0.05 * np.abs(weights).max()
    assert ((shares @ machine.weights[:40] > 0) == (sign > 0)).mean() > 0.9


def test_margins_of_empty_texts():
    sample = Sample(np.array([1, 2]), np.array([1.0, 1.0]), np.array([0, 1, 2]))
    machine = fit(sample, np.arange(2), np.array([1.0, -1.0]), (0, 1))
    out = margins([machine], np.array([1, 2, 2]), np.array([0, 0, 1, 3, 3]))
    assert out[0, 0] == out[3, 0] == 0 and out[2, 0] == machine.weights[2]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = languages(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert len(out) == docs.count() and out.score.between(0, 1).all()
    assert (out.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in out.doc_id]).all()
    right = out[out.held_out].assign(right=lambda t: t.lang_pred == t.lang).groupby("lang").right.mean()
    assert right.min() > 0.97 and len(right) == 4


def sentences(words, n, seed):
    rng = np.random.default_rng(seed)
    return [" ".join(rng.choice(words.split(), rng.integers(3, 30))) + "." for _ in range(n)]


@pytest.fixture
def small(table):
    tongues = {
        "en": "the of and to that with for this which have", "de": "der und die das nicht mit sich auf eine auch",
        "nl": "het een van niet met voor zijn ook maar naar", "fr": "les des une pour dans que avec sur pas est",
        "tlh": "tlhIngan maH qapla Hol ghoS vaj jIH SoH", "zh": "的 是 不 我们 中国 人 在 有 他 这",
    }
    rows = [(lang, text) for k, lang in enumerate(tongues) for text in sentences(tongues[lang], 80, k)]
    docs = [(i, text, lang, "x", 1) for i, (lang, text) in enumerate(rows)]
    docs += [(9000, None, "en", "x", 1), (9001, "", "en", "x", 1), (9002, "12 !! 345", "en", "x", 1), (9003, "the und", None, "x", 1)]
    docs += [(9004, docs[0][1], "en", "x", 1)] * 3 + [(None, "the of and to that", "en", "x", 1), (9005, "der die das " * 30_000, "de", "x", 1)]
    return table("doc_id long, text string, lang string, letters string, `a.b` int", *docs).repartition(5)


def test_families_then_languages(spark, small):
    model = train(small.filter("doc_id < 480"))
    assert model.families == ["germanic", "romance", "tlh", "zh"]
    assert model.languages == [["de", "en", "nl"], ["fr"], ["tlh"], ["zh"]]
    assert len(model.between) == 6 and [len(m) for m in model.within] == [3, 0, 0, 0]
    out = {r.doc_id: r for r in predict(small.filter("doc_id >= 480 OR doc_id IS NULL").dropDuplicates(["doc_id"]), model).collect()}
    assert [(out[i].lang_pred, out[i].score) for i in (9000, 9001, 9002)] == [("und", 0.0)] * 3
    assert out[9005].lang_pred == "de" and out[None].lang_pred == "en" and not out[None].held_out
    lang = dict(small.select("doc_id", "lang").collect())
    rows = languages(small).collect()
    assert len(rows) == small.count()
    held = [r for r in rows if r.held_out and r.doc_id < 480]
    assert len(held) > 80 and np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.97
    assert len({(r.lang_pred, r.score) for r in rows if r.doc_id == 9004}) == 1


def test_lang_is_no_input(spark, small):
    model = train(small.filter("doc_id < 480"))
    as_rows = lambda df: sorted((tuple(r) for r in df.collect()), key=str)
    assert as_rows(predict(small, model)) == as_rows(predict(small.withColumn("lang", F.lit("xx")), model))


def test_little_to_learn(spark, small, table):
    nothing = languages(small.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in nothing} == {("und", 0.0)}
    one = languages(small.filter("lang = 'fr'")).collect()
    assert {(r.lang_pred, r.score) for r in one} == {("fr", 1.0)}
    assert languages(small.limit(0)).collect() == []


def test_sample_is_bounded(spark, small):
    model = train(small, per_language=3, sample=8)
    assert sum(map(len, model.languages)) >= 4


def test_families_by_code():
    assert [family_of(c) for c in ("en", "DE-at", "pt_BR", "xx")] == ["germanic", "germanic", "romance", "xx"]


def test_letters(spark, table):
    out = table("t string", ("a",), ("é1",), ("中",), ("1 2",), ("",), (None,), ("٣",)).select(has_letter(F.col("t")).alias("l")).collect()
    assert [r.l for r in out] == [True, True, True, False, False, False, False]
