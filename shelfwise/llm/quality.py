"""Quality grades by ordinal cumulative-link regression on hashed text.

Labelled documents carry graded ratings: 0 for low quality, 1 for good but toxic, 2 for good
and clean. One set of weights on hashed features gives a text a score; ordered thresholds
turn it into P(grade <= k) = logistic(threshold_k - score). The expected grade and the tail
probability P(grade >= 2) follow, and a document stays if the latter is at least one half.

The model is fitted on at most ``SAMPLE`` labelled documents, those with the smallest hashed
ids; every document is scored on its whole text. A missing text is empty; without features
the score is zero. Without any labelled document all are kept with a tail probability of 1.
Missing labels, and labels of missing ids, do not count; of repeated labels the lowest grade
does. Repeated rows are scored each. Other columns pass through or do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.tables import ids_and_texts, quoted
from shelfwise.llm.wordhash import Texts, chunks, mix, word_hashes
from shelfwise.session import stage

SAMPLE = 20_000
GRADES = 3
# features are numbered by 24 bits of their hash; those in fewer sampled documents, or as
# frequent in every grade within this many standard errors, carry no weight
FEATURE_BITS = 24
LEAST_DOCUMENTS = 4
LEAST_CONTRAST = 5.0
STEPS = 300
RATE = 0.05
SHRINK = 2e-5
KEEP_AT = 0.5

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
# kinds of bytes for the ends of words: capital, other letter, digit; punctuation is its own kind
_KIND = np.arange(256, dtype=np.uint64)
_KIND[97:123] = _KIND[128:] = 97
_KIND[65:91] = 65
_KIND[48:58] = 48


class Model(NamedTuple):
    features: np.ndarray  # sorted
    weights: np.ndarray
    thresholds: np.ndarray

    def scores(self, features: np.ndarray, first: np.ndarray) -> np.ndarray:
        if not len(self.features):
            return np.zeros(len(first) - 1)
        at = np.minimum(np.searchsorted(self.features, features), len(self.features) - 1)
        weights = np.where(self.features[at] == features, self.weights[at], 0.0)
        total = np.concatenate([[0.0], np.cumsum(weights)])
        return total[first[1:]] - total[first[:-1]]

    def at_most(self, scores: np.ndarray) -> np.ndarray:
        """P(grade <= k), one column for each k but the highest."""
        return 1 / (1 + np.exp(np.clip(scores[:, None] - self.thresholds[None, :], -500, 500)))


def _share(part: np.ndarray, whole: np.ndarray, steps: int) -> np.ndarray:
    return np.round(steps * part / np.maximum(whole, 1)).astype(np.uint64)


def features_of(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features of each text, one text after the other, and where each text's begin.

    Features are lower-case words, how words end (kinds of their last three bytes), and steps
    of the shares of repeated words, distinct words, capitals and punctuation.
    """
    n = len(texts.offsets) - 1
    text_of = lambda first: np.repeat(np.arange(n), np.diff(first))
    lower = _LOWER[texts.data]
    s, e, first = texts.runs(_LETTER[texts.data])
    words = word_hashes(texts, s, e, lower)
    owner = text_of(first)
    found = [(owner, mix(words, 1))]

    ws, we, wfirst = texts.words()
    kinds = np.concatenate([np.zeros(2, dtype=np.uint64), _KIND[texts.data]])
    ending = kinds[we + 1]
    for back in (1, 2):
        ending = ending << np.uint64(8) | np.where(we - back > ws, kinds[np.maximum(we + 1 - back, 0)], np.uint64(0))
    wowner = text_of(wfirst)
    found.append((wowner, mix(ending, 2)))

    count = np.diff(first)
    again = np.zeros(len(words), dtype=bool)
    again[1:] = (words[1:] == words[:-1]) & (owner[1:] == owner[:-1])
    per_text = lambda mask, of: np.bincount(of[mask], minlength=n)
    total = np.diff(texts.offsets)
    byte_owner = np.repeat(np.arange(n), total)
    pairs = mix(words ^ mix(owner.astype(np.uint64), 9), 9)
    _, where = np.unique(pairs, return_index=True)
    distinct = np.bincount(owner[where], minlength=n)
    capital = (texts.data >= 65) & (texts.data <= 90)
    mark = (texts.data > 32) & ~_LETTER[texts.data]
    length = np.log2(count + 1).astype(np.uint64)
    shares = [
        _share(per_text(again, owner), count, 10),
        _share(distinct, count, 10) * np.uint64(32) + length,
        _share(per_text(capital, byte_owner), total, 20),
        _share(per_text(mark, byte_owner), total, 20),
    ]
    for salt, share in enumerate(shares, 3):
        found.append((np.arange(n), mix(share, salt)))

    owner = np.concatenate([o for o, _ in found]).astype(np.uint64)
    ids = np.concatenate([f for _, f in found]) >> np.uint64(64 - FEATURE_BITS)
    both = np.unique(owner << np.uint64(FEATURE_BITS) | ids)
    owner = both >> np.uint64(FEATURE_BITS)
    return (both & np.uint64((1 << FEATURE_BITS) - 1)).astype(np.uint32), np.searchsorted(owner, np.arange(n + 1, dtype=np.uint64))


def telling(column: np.ndarray, row: np.ndarray, grades: np.ndarray, count: int, grade_count: int) -> np.ndarray:
    """Which of ``count`` features are in clearly more or fewer documents of a grade than of the others."""
    n = len(grades)
    inside = np.bincount(column, minlength=count)
    found = np.zeros(count, dtype=bool)
    for grade in range(grade_count):
        share = (grades == grade).mean()
        got = np.bincount(column[grades[row] == grade], minlength=count)
        spread = np.sqrt(np.maximum(inside * share * (1 - share) * (1 - inside / n), 1e-9))
        found |= np.abs(got - inside * share) >= LEAST_CONTRAST * spread
    return found & (inside < n)


def fit(features: list[np.ndarray], grades: np.ndarray, grade_count: int = GRADES) -> Model:
    """Weights and thresholds of the sampled documents, by Adam on the mean log loss."""
    every, seen = np.unique(np.concatenate(features), return_counts=True) if features else (np.zeros(0, np.uint32), np.zeros(0))
    used = every[seen >= LEAST_DOCUMENTS]
    if not len(grades) or not len(used):
        return Model(used[:0], np.zeros(0), np.full(grade_count - 1, -500.0))
    lengths = np.array([len(f) for f in features])
    flat = np.concatenate(features)
    at = np.minimum(np.searchsorted(used, flat), len(used) - 1)
    held = used[at] == flat
    column, row = at[held], np.repeat(np.arange(len(features)), lengths)[held]
    n = len(grades)
    kept = telling(column, row, grades, len(used), grade_count)
    held = kept[column]
    column, row, used = (np.cumsum(kept) - 1)[column[held]], row[held], used[kept]
    weights = np.zeros(len(used))
    # cuts start at the observed shares of grades; gaps are kept positive by their logarithm
    below = np.clip([(grades <= k).mean() for k in range(grade_count - 1)], 1e-3, 1 - 1e-3)
    cuts = np.log(below / (1 - below))
    shape = np.concatenate([cuts[:1], np.log(np.maximum(np.diff(cuts), 1e-2))])
    rest = np.concatenate([weights, shape])
    mean, square = np.zeros_like(rest), np.zeros_like(rest)
    logistic = lambda x: 1 / (1 + np.exp(-np.clip(x, -500, 500)))
    for step in range(1, STEPS + 1):
        weights, shape = rest[: len(used)], rest[len(used) :]
        cuts = shape[0] + np.concatenate([[0.0], np.cumsum(np.exp(shape[1:]))])
        scores = np.bincount(row, weights=weights[column], minlength=n)
        upper = logistic(np.append(cuts, np.inf)[grades] - scores)
        lower = logistic(np.insert(cuts, 0, -np.inf)[grades] - scores)
        share = np.maximum(upper - lower, 1e-12)
        slope_up, slope_low = upper * (1 - upper) / share, lower * (1 - lower) / share
        pull = (slope_up - slope_low) / n
        by_cut = np.array([-(slope_up[grades == k].sum() - slope_low[grades == k + 1].sum()) / n for k in range(grade_count - 1)])
        by_shape = np.append(by_cut.sum(), np.exp(shape[1:]) * by_cut[::-1].cumsum()[::-1][1:])
        slope = np.concatenate([np.bincount(column, weights=pull[row], minlength=len(used)) + SHRINK * weights, by_shape])
        mean = 0.9 * mean + 0.1 * slope
        square = 0.999 * square + 0.001 * slope**2
        rest = rest - RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    weights, shape = rest[: len(used)], rest[len(used) :]
    return Model(used, weights, shape[0] + np.concatenate([[0.0], np.cumsum(np.exp(shape[1:]))]))


def graded(labels: DataFrame) -> DataFrame:
    """(doc_id, grade) of the labels (doc_id, quality, toxic)."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when(F.col("toxic") == 0, 2)
    return (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), grade.alias("grade"))
        .dropna()
        .groupBy("doc_id")
        .agg(F.min("grade").alias("grade"))
    )


def _telling_features(rows: DataFrame) -> np.ndarray:
    """``telling`` as a Spark aggregate, so that only features of use reach the driver."""
    shares = {r.grade: r["count"] for r in rows.groupBy("grade").count().collect()}
    n = sum(shares.values())
    counted = (
        rows.select("grade", F.explode("features").alias("feature"))
        .groupBy("feature")
        .agg(F.count(F.lit(1)).alias("inside"), *(F.count_if(F.col("grade") == g).alias(f"got_{g}") for g in range(GRADES)))
        .filter((F.col("inside") >= LEAST_DOCUMENTS) & (F.col("inside") < n))
    )
    contrast = F.lit(False)
    for g in range(GRADES):
        share = shares.get(g, 0) / max(n, 1)
        spread = F.sqrt(F.greatest(F.col("inside") * (share * (1 - share)) * (1 - F.col("inside") / max(n, 1)), F.lit(1e-9)))
        contrast = contrast | (F.abs(F.col(f"got_{g}") - F.col("inside") * share) >= LEAST_CONTRAST * spread)
    found = counted.filter(contrast).select("feature").toPandas()["feature"]
    return np.sort(found.to_numpy(dtype=np.int32))


def train(docs: DataFrame, grades: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit on at most ``sample`` documents of ``grades`` (doc_id, grade).

    Features are made where the texts are; what reaches the driver is bounded by the sample.
    """
    # as many rows as the sample at most, so the broadcast has a bound
    chosen = grades.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in chunks(batch.column("text")):
                found, first = features_of(texts)
                part = batch.slice(texts.first, len(first) - 1)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("grade"), pa.ListArray.from_arrays(first.astype("i4"), pa.array(found.astype("i4")))],
                    names=["doc_id", "grade", "features"],
                )

    # of a repeated id with different texts the one with the least features counts
    rows = stage(
        ids_and_texts(docs, id_col, text_col)
        .join(F.broadcast(chosen), "doc_id", "inner")
        .mapInArrow(features, "doc_id long, grade int, features array<int>")
        .groupBy("doc_id", "grade")
        .agg(F.min("features").alias("features")),
        "graded_features",
    )
    known = _telling_features(rows)

    def only_known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("features")
            flat, first = column.flatten().to_numpy(), np.concatenate([[0], np.cumsum(pa.compute.list_value_length(column))])
            held = np.isin(flat, known)
            kept = np.concatenate([[0], np.cumsum(held)])[first]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("grade"), pa.ListArray.from_arrays(kept.astype("i4"), pa.array(flat[held]))],
                names=["doc_id", "grade", "features"],
            )

    few = rows.mapInArrow(only_known, "doc_id long, grade int, features array<int>").toPandas()
    rows = few.sort_values("doc_id", kind="stable")
    return fit([np.asarray(f, dtype=np.uint32) for f in rows["features"]], rows["grade"].to_numpy(dtype=np.int64))


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with expected_grade and tail_probability; columns of those names are replaced."""
    bare = docs.drop("expected_grade", "tail_probability")
    columns, at = bare.columns, bare.columns.index(text_col)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in chunks(pa.compute.fill_null(batch.column(at), "")):
                found, first = features_of(texts)
                below = model.at_most(model.scores(found, first))
                part = batch.slice(texts.first, len(first) - 1)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i) for i in range(len(columns))), pa.array((1 - below).sum(axis=1)), pa.array(1 - below[:, -1])],
                    names=[*columns, "expected_grade", "tail_probability"],
                )

    grades = T.StructType().add("expected_grade", "double").add("tail_probability", "double")
    return bare.mapInArrow(scored, T.StructType([*bare.schema.fields, *grades.fields]))


def graded_documents(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per document: doc_id, expected_grade, tail_probability, kept."""
    model = train(docs, graded(labels), sample)
    rows = ids_and_texts(docs)
    return score(rows, model).select(
        "doc_id", "expected_grade", "tail_probability", (F.col("tail_probability") >= KEEP_AT).alias("kept")
    )


def good_documents(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The documents that stay, with the columns of ``docs``, whatever their names are."""
    others = [quoted(c).alias(f"c{i}") for i, c in enumerate(docs.columns) if c != text_col]
    packed = docs.select(quoted(text_col).alias("text"), F.struct(F.lit(True).alias("row"), *others).alias("others"))
    back = [
        F.col("text").alias(c) if c == text_col else F.col(f"others.c{i}").alias(c) for i, c in enumerate(docs.columns)
    ]
    return score(packed, model).filter(F.col("tail_probability") >= KEEP_AT).select(*back)
