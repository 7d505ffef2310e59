"""Language of texts in two steps: the family first, then the language within it.

A text is its pairs and triples of adjacent bytes, letters in lower case and all else as blanks,
numbered by a hash; their shares are its features. Linear support vector machines compare
families one against one, then the languages of the chosen family one against one. A class wins by
the comparisons it wins, then by the sum of margins, then by code point. The score is the least
confidence among the winner's comparisons within families, times that among families; confidence
is a logistic function of the margin, its slope fitted on sampled texts the machines have not seen.

The machines are fitted on at most ``PER_LANGUAGE`` different texts of a language and ``SAMPLE`` in
all, those with the smallest hashes; every text is predicted from the whole of it. Missing texts
and texts without a letter are ``und`` with score 0, and so is every text if nothing was learned. With
one language learned, each text with a letter is in it with score 1. Repeated texts are learned
once per language and predicted alike; very long ones count by their shares like others. Missing
languages are not learned; a missing id is not held out. An empty table gives an empty result.
Columns that are not read do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.tables import quoted
from shelfwise.llm.wordhash import Texts, chunks
from shelfwise.session import stage, unstage

PER_LANGUAGE = 800
SAMPLE = 8000
BUCKET_BITS = 14
EPOCHS = 40
# misclassification is weighed by this in the machines
COST = 4.0
SLOPES = np.geomspace(0.25, 4.0, 17)
UNKNOWN = "und"

# related languages by their codes; a language that is not listed is a family of its own
FAMILIES = {
    "germanic": "af da de en fy is lb nb nl nn no sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "baltic": "lt lv",
    "celtic": "br cy ga gd",
    "uralic": "et fi hu",
    "turkic": "az kk ky tr tt uz",
    "indic": "as bn gu hi mr ne or pa ur",
    "semitic": "am ar he mt",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

# letters in lower case, every byte of longer characters as it is, all else as a blank
_PLAIN = np.full(256, 32, dtype=np.uint8)
_PLAIN[65:91] = _PLAIN[97:123] = np.arange(97, 123)
_PLAIN[128:] = np.arange(128, 256)


def family_of(language: str, families: Mapping[str, str] = FAMILY_OF) -> str:
    code = language.lower().replace("_", "-").split("-")[0]
    return families.get(code, language)


def grams(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the pairs and triples of each text, one text after the other, and where each begins.

    Each text has a blank at either end; grams of blanks alone are left out.
    """
    n = len(texts.offsets) - 1
    starts = texts.offsets + 2 * np.arange(n + 1)
    padded = np.full(starts[-1] + 2, 32, dtype=np.uint32)
    padded[np.arange(len(texts.data)) + np.repeat(2 * np.arange(n) + 1, np.diff(texts.offsets))] = _PLAIN[texts.data]
    pairs = padded[:-1] << np.uint32(8) | padded[1:]
    triples = pairs[:-1] << np.uint32(8) | padded[2:]
    pairs = pairs[: len(triples)]
    shift = np.uint32(32 - BUCKET_BITS)
    found = np.empty((len(triples), 2), dtype=np.uint32)
    found[:, 0] = (pairs + np.uint32(1 << 24)) * np.uint32(0x9E3779B1) >> shift
    found[:, 1] = triples * np.uint32(0x9E3779B1) >> shift
    held = np.empty(found.shape, dtype=bool)
    held[:, 0], held[:, 1] = pairs != 0x2020, triples != 0x202020
    # the last place of a text begins no pair of it, the last two no triple
    last = starts[1:] - 1
    held[last[last < len(held)]] = False
    held[last - 1, 1] = False
    kept = np.concatenate([[0], np.cumsum(held.sum(axis=1))])
    return found[held], kept[np.minimum(starts, len(held))]


class Machine(NamedTuple):
    """Margins above zero are for the first of two classes."""

    first: int
    second: int
    weights: np.ndarray
    slope: float


class Sample(NamedTuple):
    """Shares of buckets in some texts; text i has the places first[i] to first[i + 1]."""

    buckets: np.ndarray
    shares: np.ndarray
    first: np.ndarray

    def row(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        at = slice(self.first[i], self.first[i + 1])
        return self.buckets[at], self.shares[at]


def fit(sample: Sample, rows: np.ndarray, sign: np.ndarray, classes: tuple[int, int], epochs: int = EPOCHS) -> Machine:
    """Squared-hinge support vector machine by dual coordinate descent, on four fifths of ``rows``.

    Shares are weighed down by the root of their mean, as counts spread, and each text to length one.
    """
    size = 1 << BUCKET_BITS
    mean = np.full(size, 1e-6)
    for i in rows:
        buckets, shares = sample.row(i)
        mean[buckets] += shares / len(rows)
    scale = 1 / np.sqrt(mean)
    weights, diagonal = np.zeros(size), 1 / (2 * COST)
    learned = [k for k in range(len(rows)) if k % 5] or list(range(len(rows)))
    parts = []
    for k in learned:
        buckets, shares = sample.row(rows[k])
        x = shares * scale[buckets]
        parts.append((buckets, x / max(np.sqrt((x**2).sum()), 1e-12), sign[k]))
    dual = np.zeros(len(parts))
    rng = np.random.default_rng(1)
    for _ in range(epochs):
        for k in rng.permutation(len(parts)):
            buckets, x, y = parts[k]
            pull = y * (weights[buckets] @ x) - 1 + diagonal * dual[k]
            moved = max(dual[k] - pull / (1 + diagonal), 0.0)
            weights[buckets] += (moved - dual[k]) * y * x
            dual[k] = moved
    weights *= scale
    unseen = [k for k in range(len(rows)) if k % 5 == 0]
    margins = np.array([sign[k] * (weights[sample.row(rows[k])[0]] @ sample.row(rows[k])[1]) for k in unseen])
    losses = [np.logaddexp(0, -slope * margins).mean() for slope in SLOPES]
    return Machine(*classes, weights, float(SLOPES[int(np.argmin(losses))]))


class Model(NamedTuple):
    families: list[str]
    languages: list[list[str]]  # of each family
    between: list[Machine]  # families
    within: list[list[Machine]]  # languages of each family

    @staticmethod
    def choose(machines: list[Machine], classes: int, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Winner of each row of margins (one column per machine), and the least confidence in it."""
        n = len(sums)
        wins, margin = np.zeros((n, classes)), np.zeros((n, classes))
        for m, by in zip(machines, sums.T):
            wins[:, m.first] += by >= 0
            wins[:, m.second] += by < 0
            margin[:, m.first] += by
            margin[:, m.second] -= by
        winner = np.zeros(n, dtype=np.int64)
        for c in range(1, classes):
            at = np.arange(n)
            better = (wins[:, c] > wins[at, winner]) | ((wins[:, c] == wins[at, winner]) & (margin[:, c] > margin[at, winner]))
            winner[better] = c
        sure = np.ones(n)
        for m, by in zip(machines, sums.T):
            for mine, sign in ((m.first, 1.0), (m.second, -1.0)):
                confidence = 1 / (1 + np.exp(-np.clip(sign * m.slope * by, -500, 500)))
                sure = np.where(winner == mine, np.minimum(sure, confidence), sure)
        return winner, sure

    def predict(self, buckets: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Language and score of each text."""
        family, sure = self.choose(self.between, len(self.families), margins(self.between, buckets, first))
        names = np.full(len(family), UNKNOWN, dtype=object)
        for f, languages in enumerate(self.languages):
            mine = np.flatnonzero(family == f)
            if not len(mine):
                continue
            lengths = np.diff(first)
            inside = np.repeat(family == f, lengths)
            part = np.concatenate([[0], np.cumsum(lengths[mine])])
            chosen, confidence = self.choose(self.within[f], len(languages), margins(self.within[f], buckets[inside], part))
            names[mine] = np.array(languages, dtype=object)[chosen]
            sure[mine] *= confidence
        return names, sure


def margins(machines: list[Machine], buckets: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Mean weight of the grams of each text, one column per machine; zero without grams."""
    count = np.diff(first)
    out = np.zeros((len(count), len(machines)))
    some = np.flatnonzero(count)
    if len(some):
        for column, machine in enumerate(machines):
            out[some, column] = np.add.reduceat(machine.weights[buckets], first[some]) / count[some]
    return out


def fit_all(languages: np.ndarray, sample: Sample, families: Mapping[str, str] = FAMILY_OF) -> Model:
    """Machines between families and between the languages of each."""
    learned = sorted(set(languages), key=lambda name: name.encode())
    names = sorted({family_of(name, families) for name in learned}, key=lambda name: name.encode())
    members = [[name for name in learned if family_of(name, families) == family] for family in names]

    def machines(groups: list[list[str]]) -> list[Machine]:
        found = []
        for a, b in combinations(range(len(groups)), 2):
            rows = np.flatnonzero(np.isin(languages, groups[a] + groups[b]))
            found.append(fit(sample, rows, np.where(np.isin(languages[rows], groups[a]), 1.0, -1.0), (a, b)))
        return found

    return Model(names, members, machines(members), [machines([[name] for name in group]) for group in members])


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def held_out(id_col: str = "doc_id") -> Column:
    """Rows no prediction learns from: those whose id, as text, has a checksum of 2 modulo 4."""
    return F.coalesce(F.crc32(quoted(id_col).cast("string")) % 4 == 2, F.lit(False))


def train(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    per_language: int = PER_LANGUAGE,
    sample: int = SAMPLE,
    families: Mapping[str, str] = FAMILY_OF,
) -> Model:
    """Fit on different texts of ``docs`` with a language; grams are counted where the texts are."""
    rows = docs.select(quoted(lang_col).cast("string").alias("lang"), quoted(text_col).alias("text")).filter(
        F.col("lang").isNotNull() & has_letter(F.col("text"))
    )
    ticket = F.xxhash64("text")
    tickets = stage(rows.select("lang", ticket.alias("ticket")).distinct(), "tickets")
    # tickets are spread evenly, so a bound on them leaves about twice the wanted texts of a
    # language to be ranked, however many it has
    count = stage(tickets.groupBy("lang").agg(F.count(F.lit(1)).alias("texts")), "texts_by_language")
    place = F.row_number().over(Window.partitionBy("lang").orderBy("ticket"))
    chosen = (
        tickets.join(count, "lang", "inner")
        .filter((F.col("ticket") / 2.0**64 + 0.5) * F.col("texts") <= 2 * per_language + 50)
        .withColumn("place", place)
        .filter(F.col("place") <= per_language)
        .orderBy("place", "ticket", "lang")
        .limit(sample)
    )

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in chunks(batch.column("text")):
                buckets, first = grams(texts)
                owner = np.repeat(np.arange(len(first) - 1, dtype=np.int64), np.diff(first))
                both, count = np.unique(owner << BUCKET_BITS | buckets, return_counts=True)
                begins = np.searchsorted(both, np.arange(len(first)) << BUCKET_BITS).astype("i4")
                part = batch.slice(texts.first, len(first) - 1)
                lists = [pa.ListArray.from_arrays(begins, pa.array(v.astype("i4"))) for v in (both & ((1 << BUCKET_BITS) - 1), count)]
                yield pa.RecordBatch.from_arrays([part.column("lang"), part.column("ticket"), *lists], names=["lang", "ticket", "buckets", "counts"])

    found = stage(
        rows.withColumn("ticket", ticket)
        .join(F.broadcast(chosen.select("lang", "ticket")), ["lang", "ticket"], "left_semi")
        .select("lang", "ticket", "text")
        .mapInArrow(counted, "lang string, ticket long, buckets array<int>, counts array<int>")
        .dropDuplicates(["lang", "ticket"]),
        "language_sample",
    )
    table = found.orderBy("ticket", "lang").toArrow().combine_chunks()
    unstage(found)
    buckets, counts = (table.column(c).combine_chunks() for c in ("buckets", "counts"))
    first = np.concatenate([[0], np.cumsum(pa.compute.list_value_length(buckets).to_numpy())]).astype(np.int64)
    total = counts.flatten().to_numpy().astype(np.float64)
    lengths = np.diff(first)
    whole = np.add.reduceat(total, first[:-1]) if len(lengths) else np.zeros(0)
    shares = total / np.repeat(whole, lengths)
    return fit_all(np.array(table.column("lang").to_pylist(), dtype=object), Sample(buckets.flatten().to_numpy(), shares, first), families)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row, from its text alone."""
    text = F.coalesce(quoted(text_col), F.lit(""))
    rows = docs.select(quoted(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), has_letter(text).alias("letters"), text.alias("text"))

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in chunks(batch.column("text")):
                names, score = model.predict(*grams(texts))
                part = batch.slice(texts.first, len(names))
                known = part.column("letters").to_numpy(zero_copy_only=False) & bool(model.families)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(np.where(known, names, UNKNOWN), pa.string()), pa.array(np.where(known, score, 0.0))],
                    names=["doc_id", "held_out", "lang_pred", "score"],
                )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(predicted, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def languages(docs: DataFrame) -> DataFrame:
    """Predictions of a model that learns from all rows but those held out."""
    return predict(docs, train(docs.filter(~held_out())))
