"""Removing passages of ``WINDOW`` words that an earlier document also has, by recompression.

Words are named by their hash. In rounds, runs of one name and then pairs of names are
replaced by new names. Which pairs are replaced hangs on coins drawn from the names alone, so
equal passages are rewritten equally but for a few words at their ends, in every task and
without a shuffle. ``GROUP`` neighbouring names form a high-level symbol, and of
``NEIGHBOURS`` such symbols in a row the least is an anchor. Names span at most ``SPAN``
words; so a passage loses at most ``SPAN - 1`` words on either side in each round, and a
window of 50 words still holds ``GROUP + NEIGHBOURS - 1`` whole names, that is an anchor.

Spark counts in which documents each anchor occurs. Only windows around anchors of several
documents can be repeats; these are named by two hashes, compared over all documents, and
decide what goes. Runs of ``SPAN`` words or more stay apart: a window that touches one is
compared in any case. Windows are judged on the input, and a window repeats if it also starts in a
document with a smaller id.

Words are what blanks and control characters from tab to carriage return separate. A missing
text has none. A missing id is larger than all others, and such documents do not repeat one
another. Rows that repeat an id are judged each, never against one another. An empty table
gives an empty result. Other columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.tables import whole_text
from shelfwise.llm.wordhash import chunks, mix, range_hashes, word_hashes
from shelfwise.session import stage, unstage

WINDOW = 50
SPAN = 4
PAIR_ROUNDS = 3
GROUP = 4
NEIGHBOURS = 4
# a window keeps at least this many words of whole names after runs and pairs have taken theirs
assert WINDOW - 2 * (SPAN - 1) * (1 + PAIR_ROUNDS) >= SPAN * (GROUP + NEIGHBOURS - 2) + 1

_LAST = (1 << 63) - 1
# first word and number of words of an anchor as one number
PLACE = 32
assert SPAN * GROUP < PLACE


def recompress(names: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, ...]:
    """Names, texts, first words and spans after the rounds, and which are long runs."""
    start = np.arange(len(names))
    if not len(names):
        return names, owner, start, start, np.zeros(0, dtype=bool)
    fresh = np.ones(len(names), dtype=bool)
    fresh[1:] = (names[1:] != names[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(fresh)
    span = np.diff(np.append(first, len(names)))
    names, owner, start = names[first], owner[first], start[first]
    names = np.where(span > 1, mix(names ^ mix(span.astype(np.uint64), 21), 22), names)
    long = span >= SPAN  # these join no pair
    for turn in range(PAIR_ROUNDS):
        coin = (mix(names, 30 + turn) >> np.uint64(63)).astype(bool)
        joins = ~coin[:-1] & coin[1:] & (owner[1:] == owner[:-1]) & (span[1:] + span[:-1] <= SPAN)
        at = np.flatnonzero(joins)
        names = names.copy()
        names[at] = mix(names[at] ^ mix(names[at + 1], 40 + turn), 50 + turn)
        span = span.copy()
        span[at] += span[at + 1]
        stay = np.ones(len(names), dtype=bool)
        stay[at + 1] = False
        names, owner, start, span, long = names[stay], owner[stay], start[stay], span[stay], long[stay]
    return names, owner, start, span, long


def anchors(names: np.ndarray, owner: np.ndarray, start: np.ndarray, span: np.ndarray, long: np.ndarray) -> tuple[np.ndarray, ...]:
    """Name, text, first and last word (excluded) of the chosen high-level symbols."""
    n = len(names) - GROUP - NEIGHBOURS + 2
    if n <= 0:
        return names[:0], owner[:0], start[:0], start[:0]
    symbols = range_hashes(names, np.arange(len(names) - GROUP + 1), np.arange(GROUP, len(names) + 1))
    # all names of the neighbourhood in one text and none a long run
    long_before = np.concatenate([[0], np.cumsum(long)])
    reach = GROUP + NEIGHBOURS - 1
    whole = (owner[reach - 1 :][:n] == owner[:n]) & (long_before[reach:][:n] == long_before[:n])
    least = np.argmin(np.stack([symbols[k : k + n] for k in range(NEIGHBOURS)]), axis=0) + np.arange(n)
    chosen = np.unique(least[whole])
    last = chosen + GROUP - 1
    return symbols[chosen], owner[chosen], start[chosen], start[last] + span[last]


def window_hashes(names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of every window of the words of one or more texts."""
    first = np.arange(len(names) - WINDOW + 1)
    return range_hashes(names, first, first + WINDOW), range_hashes(mix(names, 60), first, first + WINDOW)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, part, text): ids with missing ones last, those told apart by their text."""
    return docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("doc"),
        F.when(F.col(id_col).isNull(), F.xxhash64(whole_text(text_col))).otherwise(0).alias("part"),
        whole_text(text_col).alias("text"),
        F.col(id_col).isNull().alias("no_id"),
    )


def _parsed(docs: DataFrame) -> DataFrame:
    """Of each document the number and the digest of its words, its anchors, and its long runs."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in chunks(batch.column("text")):
                s, e, first = texts.words()
                count = np.diff(first)
                owner = np.repeat(np.arange(len(count)), count)
                # texts without a window take no part
                long_enough = count[owner] >= WINDOW
                hashes = word_hashes(texts, s, e)[long_enough]
                within = (np.arange(len(owner)) - first[owner])[long_enough]
                got = recompress(hashes, owner[long_enough])
                names, of, begin, end = anchors(*got)
                runs = got[4]
                word = lambda places: within[places].astype("i4")
                lists = lambda of, *columns: [
                    pa.ListArray.from_arrays(np.searchsorted(of, np.arange(len(count) + 1)).astype("i4"), pa.array(c)) for c in columns
                ]
                data = texts.data.tobytes()
                digests = [
                    hashlib.sha256(b" ".join(data[a:b].split())).hexdigest() for a, b in zip(texts.offsets[:-1], texts.offsets[1:])
                ]
                part = batch.slice(texts.first, len(count))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(c) for c in ("doc", "part", "no_id")),
                        pa.array(count),
                        pa.array(digests),
                        *lists(of, names.view(np.int64), word(begin) * PLACE + (end - begin).astype("i4")),
                        *lists(got[1][runs], word(got[2][runs]), word(got[2][runs]) + got[3][runs].astype("i4")),
                    ],
                    names=["doc", "part", "no_id", "n_words", "words_sha256", "names", "places", "run_begins", "run_ends"],
                )

    columns = "doc long, part long, no_id boolean, n_words long, words_sha256 string, names array<long>, places array<int>, run_begins array<int>, run_ends array<int>"
    return docs.mapInArrow(parse, columns)


def _places(parsed: DataFrame) -> DataFrame:
    """(doc, part, begins, ends): per document the first windows to compare, and the last, by stretch."""
    listed = parsed.select("doc", "part", F.explode(F.arrays_zip("names", "places")).alias("a")).select(
        "doc", "part", F.col("a.names").alias("name"), F.col("a.places").alias("place")
    )
    shared = stage(
        listed.groupBy("name").agg(F.min("doc").alias("least"), F.max("doc").alias("most")).filter("least < most").select("name"),
        "shared_anchors",
    )
    runs = parsed.select("doc", "part", F.explode(F.arrays_zip("run_begins", "run_ends")).alias("r")).select(
        "doc", "part", (F.col("r.run_begins") - WINDOW + 1).alias("since"), F.col("r.run_ends").alias("until")
    )
    around = listed.join(shared, "name", "inner").select(
        "doc",
        "part",
        F.expr(f"int(place div {PLACE}) + place % {PLACE} - {WINDOW}").alias("since"),
        F.expr(f"int(place div {PLACE}) + 1").alias("until"),
    )
    return (
        around.unionByName(runs)
        .groupBy("doc", "part")
        .agg(F.sort_array(F.collect_list(F.struct("since", "until"))).alias("zones"))
        .select("doc", "part", F.col("zones.since").alias("since"), F.col("zones.until").alias("until"))
    )


def _covered(since: np.ndarray, until: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` places lie in a stretch [since, until)."""
    steps = np.zeros(n + 1, dtype=np.int64)
    np.add.at(steps, np.clip(since, 0, n), 1)
    np.add.at(steps, np.clip(until, 0, n), -1)
    return np.cumsum(steps[:n]) > 0


def _each_text(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, bytes]]:
    """Number, word hashes and bytes of each text of a batch."""
    for texts in chunks(batch.column("text")):
        s, e, first = texts.words()
        hashes = word_hashes(texts, s, e)
        for i, (a, b) in enumerate(zip(first[:-1], first[1:])):
            yield texts.first + i, hashes[a:b], texts.data[texts.offsets[i] : texts.offsets[i + 1]].tobytes()


def _windows(candidates: DataFrame, key: list[str]) -> DataFrame:
    """(one, two, *key) of every window in the zones of the candidates, named by 64 and 32 bits."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            since, until = batch.column("since"), batch.column("until")
            for i, names, _ in _each_text(batch):
                if len(names) < WINDOW:
                    continue
                held = _covered(since[i].values.to_numpy(), until[i].values.to_numpy(), len(names) - WINDOW + 1)
                one, two = window_hashes(names)
                one, first = np.unique(one[held], return_index=True)
                two = (two[held][first] >> np.uint64(32)).astype("u4")
                row = pa.array(np.full(len(one), i))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(one.view(np.int64)), pa.array(two.view(np.int32)), *(batch.column(k).take(row) for k in key)],
                    names=["one", "two", *key],
                )

    columns = ", ".join(f"{k} long" for k in key)
    return candidates.select(*key, "text", "since", "until").mapInArrow(hashed, f"one long, two int, {columns}")


def _later_windows(candidates: DataFrame, repeated: DataFrame, key: list[str]) -> DataFrame:
    """(*key, gone): the names of the windows of each text that an earlier document has."""
    return (
        _windows(candidates, key)
        .join(repeated, ["one", "two"], "inner")
        .filter("doc > least")
        .groupBy(*key)
        .agg(F.collect_set(F.struct("one", "two")).alias("gone"))
    )


def _cut(repeats: DataFrame) -> DataFrame:
    """(doc, part, words_sha256, n_removed, kept_sha256) of texts with their repeated windows."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            gone = batch.column("gone")
            for i, names, data in _each_text(batch):
                words = data.split()
                keep = np.ones(len(words), dtype=bool)
                if len(names) >= WINDOW:
                    # both names count
                    one, two = window_hashes(names)
                    found = gone[i].values
                    known = found.field("one").to_numpy().view(np.uint64)
                    order = np.argsort(known)
                    known, other = known[order], found.field("two").to_numpy().view(np.uint32)[order]
                    place = np.minimum(np.searchsorted(known, one), len(known) - 1)
                    at = np.flatnonzero((known[place] == one) & (other[place] == (two >> np.uint64(32)).astype(np.uint32)))
                    keep = ~_covered(at, at + WINDOW, len(words))
                left = b" ".join(w for w, k in zip(words, keep.tolist()) if k)
                rows.append((hashlib.sha256(b" ".join(words)).hexdigest(), int((~keep).sum()), hashlib.sha256(left).hexdigest(), left.decode()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), batch.column("part"), *(pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 4, (pa.string(), pa.int64(), pa.string(), pa.string())))],
                names=["doc", "part", "words_sha256", "n_removed", "kept_sha256", "kept_text"],
            )

    return repeats.select("doc", "part", "text", "gone").mapInArrow(
        cut, "doc long, part long, words_sha256 string, n_removed long, kept_sha256 string, kept_text string"
    )


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256, and kept_text where words go.

    ``kept_text`` is the kept words joined by one blank, or null if the document keeps them all.
    """
    keyed = _keyed(docs, id_col, text_col)
    own = ["doc", "part", "words_sha256"]
    parsed = stage(_parsed(keyed), "parsed_words")
    # what an earlier document has word for word goes as a whole and is not looked into
    earlier = parsed.groupBy("words_sha256").agg(F.min("doc").alias("least"), F.max("doc").alias("most")).filter("least < most")
    copies = stage(
        parsed.select(*own).join(earlier, "words_sha256", "inner").filter("doc > least").select(*own).distinct(), "later_copies"
    )
    zones = stage(_places(parsed.join(copies, own, "left_anti")), "zones")
    stats = stage(parsed.select(*own, "no_id", "n_words"), "word_counts")
    unstage(parsed)
    candidates = stage(keyed.drop("no_id").join(zones, ["doc", "part"], "inner"), "candidates")
    unstage(zones)
    # named twice rather than written: the names are many times the texts
    repeated = stage(
        _windows(candidates, ["doc"])
        .groupBy("one", "two")
        .agg(F.min("doc").alias("least"), F.max("doc").alias("most"))
        .filter("least < most")
        .drop("most"),
        "repeated_windows",
    )
    # only documents without an id are told apart by their text
    named, nameless = (candidates.filter(c) for c in (F.col("doc") < _LAST, F.col("doc") == _LAST))
    later = stage(
        _later_windows(named, repeated, ["doc"])
        .withColumn("part", F.lit(0).cast("long"))
        .unionByName(_later_windows(nameless, repeated, ["doc", "part"])),
        "later_windows",
    )
    unstage(repeated)
    cut = stage(_cut(candidates.join(later, ["doc", "part"], "inner")).dropDuplicates(own), "cut_texts")
    unstage(candidates, later)
    copy = F.col("copy").isNotNull() & (F.col("n_words") >= WINDOW)
    return (
        stats.join(copies.withColumn("copy", F.lit(True)), own, "left")
        .join(cut, own, "left")
        .select(
            F.when(~F.col("no_id"), F.col("doc")).alias("doc_id"),
            "n_words",
            F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0).cast("long"))).alias("n_removed"),
            F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "words_sha256")).alias("kept_sha256"),
            F.when(copy, F.lit("")).otherwise(F.col("kept_text")).alias("kept_text"),
        )
    )
