"""Removing ``DEPTH``-byte strings that start earlier, by fingerprints of suffixes.

Only suffixes up to ``DEPTH`` bytes matter, and only whether they are equal. So no suffix array is
built: nothing is sorted or ranked. Each is named by a polynomial hash of its ``DEPTH`` bytes,
put together from the hashes of 3, 9, 27 and 81 bytes at positions of a difference cover; this
gives the plain hash at every position, so the cover decides nothing. Spark
groups equal names: of equal suffixes the one in the smallest document stays, in a document the
first.

Few suffixes need a name of their own. From all positions the least of every stretch, by the hash
of ``GRAM`` bytes, are anchors, and each suffix is owned by the first least one it holds: equal
strings have their owner at the same place. The suffixes of one owner make pieces. Pieces are
keyed by the bytes that all their suffixes share, so a key that one document alone has needs
no names; and of pieces with the same content (64 bits besides the key's), all but those of the
smallest document go as a whole. Only suffixes in the rest, the ends of passages that documents
share and those that meet by the key alone, are named one by one. Repeats within a text are found
where the text is.

Texts are their UTF-8 bytes and a missing text is empty. A missing id is larger than all
others, and documents without one remove nothing from each other, nor do rows that repeat an
id. An empty table gives an empty result. Other columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.substrings import _covered, _keyed
from shelfwise.llm.wordhash import Texts, chunks, mix, range_hashes
from shelfwise.session import stage, unstage

DEPTH = 100
GRAM = 32
# grams in a suffix of DEPTH bytes, one of which is its anchor
STRETCH = DEPTH - GRAM + 1
PIECE = 35
# of the keys, shuffled one after the other
SLICES = 2

_M = 1 << 64
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_BYTES = [mix(np.arange(256, dtype=np.uint64), 100 + k) | np.uint64(1) for k in range(2)]


def _extreme(values: np.ndarray, width: int, of) -> np.ndarray:
    """``of`` (minimum or maximum) of every ``width`` values in a row, by doubling."""
    size = 1
    while size * 2 <= width:
        values = of(values[:-size], values[size:])
        size *= 2
    return of(values[: len(values) - (width - size)], values[width - size :])


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and names of the anchors of the texts that ``offsets`` cut ``data`` into."""
    n = len(data) - DEPTH + 1
    none = np.zeros(0, dtype=np.int64)
    if n <= 0:
        return none, none.astype(np.uint64)
    at = np.arange(len(data) - GRAM + 1)
    grams = np.maximum(range_hashes(_BYTES[0][data], at, at + GRAM), np.uint64(1))
    least = _extreme(grams, STRETCH, np.minimum)
    # suffixes that would run on into the next text do not count
    steps = np.zeros(len(data) + 1, dtype=np.int64)
    np.add.at(steps, np.maximum(offsets[1:] - DEPTH + 1, offsets[:-1]), 1)
    np.add.at(steps, offsets[1:], -1)
    least[np.cumsum(steps[:n]) > 0] = 0
    pad = np.zeros(STRETCH - 1, dtype=np.uint64)
    most = _extreme(np.concatenate([pad, least, pad]), STRETCH, np.maximum)[: len(grams)]
    chosen = np.flatnonzero(most == grams)
    return chosen, grams[chosen]


def suffix_names(data: np.ndarray, turn: int) -> np.ndarray:
    """A name for the first ``DEPTH`` bytes of every suffix of one text that has as many.

    The kind of a position is its remainder by 3. The name of parts u and v, of which v begins
    after L bytes, is u + B ** L * v.
    """
    n = len(data) - DEPTH + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    power = lambda e: np.uint64(pow(_BASES[turn], e, _M))
    letters = _BYTES[turn][data]
    full = np.zeros(n, dtype=np.uint64)
    by_length: dict[int, list[np.ndarray]] = {}
    for kind in (1, 2):
        # names of 3, 9, 27 and 81 bytes at the sampled positions kind, kind + 3, ...
        count = max(0, (len(letters) - kind) // 3)
        own = letters[kind : kind + 3 * count].reshape(-1, 3)
        names = own[:, 0] + power(1) * own[:, 1] + power(2) * own[:, 2]
        by_length.setdefault(3, []).append(names)
        length, apart = 3, 1
        while length < 81:
            names = names[: -2 * apart] + power(length) * names[apart:-apart] + power(2 * length) * names[2 * apart :] if len(names) > 2 * apart else names[:0]
            length, apart = length * 3, apart * 3
            by_length.setdefault(length, []).append(names)
    name = lambda length, kind: by_length[length][kind - 1]
    for kind in (1, 2):
        # 81 bytes, then 9, 9 and a last byte: 100 in all, each at a sampled position of the kind
        places = np.arange(kind, n, 3)
        j = np.arange(len(places))
        full[places] = (
            name(81, kind)[j] + power(81) * name(9, kind)[j + 27] + power(90) * name(9, kind)[j + 30] + power(99) * letters[places + 99]
        )
    # the rest: a byte, 81 and 9 and 9 bytes from the next sampled position on
    places = np.arange(0, n, 3)
    j = np.arange(len(places))
    full[places] = letters[places] + power(1) * (
        name(81, 1)[j] + power(81) * name(9, 1)[j + 27] + power(90) * name(9, 1)[j + 30]
    )
    return mix(full, 110 + turn)


def owners(places: np.ndarray, names: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each anchor its text and the suffixes [since, until) whose first least gram it is; each suffix has one owner."""
    text = np.searchsorted(offsets, places, side="right") - 1
    since = np.maximum(places - STRETCH + 1, offsets[text])
    until = np.minimum(places, offsets[text + 1] - DEPTH) + 1
    for side in (-1, 1):
        # anchors not yet stopped by one as small before them, or by a smaller one after them
        open_, k = np.arange(len(places)), 0
        while len(open_):
            k += side
            open_ = open_[(open_ + k >= 0) & (open_ + k < len(places))]
            open_ = open_[np.abs(places[open_ + k] - places[open_]) < STRETCH]
            stops = names[open_ + k] <= names[open_] if side < 0 else names[open_ + k] < names[open_]
            own, other = open_[stops], places[open_[stops] + k]
            if side < 0:
                since[own] = np.maximum(since[own], other + 1)
            else:
                until[own] = np.minimum(until[own], other - STRETCH + 1)
            open_ = open_[~stops]
    return text, since, until


class Pieces(NamedTuple):
    """Runs [since, until) of at most ``PIECE`` suffixes with one owner. ``key`` names the bytes that all suffixes that
    near to the owner have in common, ``content`` all the bytes of these ones and where in them the owner lies."""

    text: np.ndarray
    key: np.ndarray
    content: np.ndarray
    since: np.ndarray
    until: np.ndarray


def pieces_of(data: np.ndarray, offsets: np.ndarray) -> Pieces:
    """The pieces of all suffixes of the texts that ``offsets`` cut ``data`` into."""
    places, names = anchors(data, offsets)
    text, since, until = owners(places, names, offsets)
    some = until > since
    places, text, since, until = places[some], text[some], since[some], until[some]
    first, last = (places - until + 1) // PIECE, (places - since) // PIECE
    row, number = _runs(first, last + 1)
    begin = places[row] - PIECE * number  # of the last suffix a piece of this number can have
    since = np.maximum(since[row], begin - PIECE + 1)
    until = np.minimum(until[row], begin + 1)
    key = mix(range_hashes(_BYTES[0][data], begin, begin + DEPTH - PIECE + 1) ^ mix(number.astype(np.uint64), 120), 121)
    content = mix(range_hashes(_BYTES[1][data], since, until + DEPTH - 1) ^ mix((begin - since).astype(np.uint64), 122), 123)
    return Pieces(text[row], key, content, since, until)


def _runs(since: np.ndarray, until: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of all runs [since, until), one run after the other, and which run each is of."""
    size = until - since
    row = np.repeat(np.arange(len(size)), size)
    return row, np.arange(len(row)) - (np.cumsum(size) - size)[row] + since[row]


def _named(data: np.ndarray, since: np.ndarray, until: np.ndarray, turns: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Run, place and names of the suffixes [since, until) of ``data``, whose bytes are put one run after the other for it."""
    row, places = _runs(since, until)
    _, bytes_ = _runs(since, until + DEPTH - 1)
    at = np.arange(len(row)) + row * (DEPTH - 1)
    return row, places, [suffix_names(data[bytes_], turn)[at] if len(at) else np.zeros(0, dtype=np.uint64) for turn in range(turns)]


def repeated(data: np.ndarray, pieces: Pieces) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which pieces are the first of their content in their text, and the text and place of suffixes in these that
    are not the first in their text.

    What the others hold is repeated as a whole.
    """

    def first(*of: np.ndarray) -> np.ndarray:
        order = np.lexsort(of[::-1])  # stable, so the first place comes first
        new = np.ones(len(order), dtype=bool)
        new[1:] = np.any([c[order][1:] != c[order][:-1] for c in of], axis=0)
        out = np.zeros(len(order), dtype=bool)
        out[order[new]] = True
        return out

    firsts = first(pieces.text, pieces.key, pieces.content)
    kept = np.flatnonzero(firsts)
    order = kept[np.lexsort((pieces.key[kept], pieces.text[kept]))]
    same = (pieces.key[order][1:] == pieces.key[order][:-1]) & (pieces.text[order][1:] == pieces.text[order][:-1])
    several = np.sort(order[np.append(same, False) | np.append(False, same)]) if len(order) else order
    row, places, (names,) = _named(data, pieces.since[several], pieces.until[several], 1)
    order = np.argsort(places, kind="stable")
    text, places, names = pieces.text[several][row][order], places[order], names[order]
    again = ~first(text, names)
    return firsts, text[again], places[again]


def _pieces(docs: DataFrame) -> DataFrame:
    """(key, content, span, doc, part, own) of the pieces of all texts; those that are ``own`` are suffixes that their
    text has before, and go for that.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in chunks(batch.column("text")):
                got = pieces_of(texts.data, texts.offsets)
                firsts, again_text, again = repeated(texts.data, got)
                # later pieces of a content as a whole, then single suffixes
                order = np.argsort(~firsts, kind="stable")
                text = np.concatenate([got.text[order], again_text])
                since = np.concatenate([got.since[order], again]) - texts.offsets[text]
                until = np.concatenate([got.until[order], again + 1]) - texts.offsets[text]
                own = np.arange(len(text)) >= firsts.sum()
                named = lambda c: pa.array(np.where(own, 0, np.concatenate([c[order], np.zeros(len(again), dtype=np.uint64)]).view(np.int64)))
                row = pa.array(texts.first + text)
                yield pa.RecordBatch.from_arrays(
                    [
                        named(got.key),
                        named(got.content),
                        pa.array(since << 32 | until),
                        batch.column("doc").take(row),
                        batch.column("part").take(row),
                        pa.array(own),
                    ],
                    names=["key", "content", "span", "doc", "part", "own"],
                )

    return docs.select("doc", "part", "text").mapInArrow(
        parse, "key long, content long, span long, doc long, part long, own boolean"
    )


def _shared(pieces: DataFrame) -> list[DataFrame]:
    """The pieces whose key several documents have; a slice of the keys at a time, so that not all are shuffled at once."""
    out = []
    for i in range(SLICES):
        some = pieces.filter(F.pmod("key", F.lit(SLICES)) == i)
        keys = stage(
            some.groupBy("key").agg(F.min("doc").alias("least"), F.max("doc").alias("most")).filter("least < most").select("key"),
            "shared_keys",
        )
        out.append(stage(some.join(keys, "key", "left_semi"), "shared_pieces"))
        unstage(keys)
    return out


def _zones(pieces: DataFrame) -> DataFrame:
    """(doc, part, gone, look): spans of suffixes that go, and of those to be named. The same content goes from all
    documents but the smallest; there its suffixes may still occur in other contents with the key.
    """
    shared = _shared(pieces.filter("NOT own").drop("own"))
    found = shared[0]
    for more in shared[1:]:
        found = found.unionByName(more)
    contents = stage(found.groupBy("key", "content").agg(F.min("doc").alias("least")), "contents")
    several = contents.groupBy("key").agg((F.count(F.lit(1)) > 1).alias("several"))
    spans = (
        found.join(contents.join(several, "key", "inner"), ["key", "content"], "inner")
        .withColumn("goes", F.col("doc") > F.col("least"))
        .filter("goes OR several")
        .select("doc", "part", "span", "goes")
        .unionByName(pieces.filter("own").select("doc", "part", "span", F.lit(True).alias("goes")))
    )
    zones = stage(
        spans.groupBy("doc", "part").agg(
            F.collect_set(F.when(F.col("goes"), F.col("span"))).alias("gone"),
            F.collect_set(F.when(~F.col("goes"), F.col("span"))).alias("look"),
        ),
        "byte_zones",
    )
    unstage(*shared, contents)
    return zones


def _spans(batch: pa.RecordBatch, name: str, texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, since and until of the spans of some texts, as places in their bytes."""
    lists = batch.column(name).slice(texts.first, len(texts.offsets) - 1)
    size = np.asarray(pa.compute.fill_null(pa.compute.list_value_length(lists), 0))
    text = np.repeat(np.arange(len(size)), size)
    span = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return text, (span >> 32) + texts.offsets[text], (span & 0xFFFFFFFF) + texts.offsets[text]


def _suffixes(candidates: DataFrame) -> DataFrame:
    """(one, two, doc, part, span) of the suffixes to be looked at, named by 64 and 32 bits."""

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in chunks(batch.column("text")):
                text, since, until = _spans(batch, "look", texts)
                run, places, (one, two) = _named(texts.data, since, until, 2)
                text = text[run]
                at = places - texts.offsets[text]
                row = pa.array(texts.first + text)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(one.view(np.int64)),
                        pa.array((two >> np.uint64(32)).astype("u4").view(np.int32)),
                        batch.column("doc").take(row),
                        batch.column("part").take(row),
                        pa.array(at << 32 | at + 1),
                    ],
                    names=["one", "two", "doc", "part", "span"],
                )

    looked = candidates.filter(F.size("look") > 0).select("doc", "part", "text", "look")
    return looked.mapInArrow(name, "one long, two int, doc long, part long, span long")


def _cut(candidates: DataFrame) -> DataFrame:
    """What goes from each candidate: spans, their bytes, and the digest of the rest."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in chunks(batch.column("text")):
                found = [_spans(batch, name, texts) for name in ("gone", "later")]
                since, until = (np.concatenate([f[k] for f in found]) for k in (1, 2))
                gone = _covered(since, until + DEPTH - 1, len(texts.data))
                begins, ends, before = texts.runs(gone)
                begins_at, ends_at = (c - np.repeat(texts.offsets[:-1], np.diff(before)) for c in (begins, ends))
                removed = np.concatenate([[0], np.cumsum(gone)])[texts.offsets]
                digests = [
                    hashlib.sha256(texts.data[a:b][~gone[a:b]].tobytes()).hexdigest()
                    for a, b in zip(texts.offsets[:-1], texts.offsets[1:])
                ]
                part = batch.slice(texts.first, len(texts.offsets) - 1)
                lists = lambda c: pa.ListArray.from_arrays(before.astype("i4"), pa.array(c))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc"), part.column("part"), pa.array(np.diff(removed)), pa.array(digests, pa.string()), lists(begins_at), lists(ends_at)],
                    names=["doc", "part", "n_removed", "rest_sha256", "begins", "ends"],
                )

    return candidates.select("doc", "part", "text", "gone", "later").mapInArrow(
        cut, "doc long, part long, n_removed long, rest_sha256 string, begins array<long>, ends array<long>"
    )


def remove_repeated_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and the spans that go
    as begins and ends in bytes.
    """
    # rows that repeat an id are told apart by their text
    keyed = _keyed(docs, id_col, text_col).withColumn("part", F.xxhash64("text"))
    own = ["doc", "part"]
    pieces = stage(_pieces(keyed), "byte_pieces")
    zones = _zones(pieces)
    unstage(pieces)
    candidates = stage(keyed.drop("no_id").join(zones, own, "inner"), "candidates")
    unstage(zones)
    # named twice rather than written: the names are many times the bytes they come from
    first = stage(
        _suffixes(candidates)
        .groupBy("one", "two")
        .agg(F.min("doc").alias("least"), F.max("doc").alias("most"))
        .filter("least < most")
        .drop("most"),
        "first_suffixes",
    )
    later = stage(
        _suffixes(candidates)
        .join(first, ["one", "two"], "inner")
        .filter("doc > least")
        .groupBy(*own)
        .agg(F.collect_set("span").alias("later")),
        "later_suffixes",
    )
    unstage(first)
    cut = stage(_cut(candidates.join(later, own, "left")).dropDuplicates(own), "cut_bytes")
    unstage(candidates, later)
    zero = F.lit(0).cast("long")
    nothing = F.array().cast("array<long>")
    stats = keyed.select(*own, "no_id", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha256"))
    return stats.join(cut, own, "left").select(
        F.when(~F.col("no_id"), F.col("doc")).alias("doc_id"),
        "n_bytes",
        F.coalesce("n_removed", zero).alias("n_removed"),
        F.coalesce(F.size(F.coalesce("begins", nothing)), F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("rest_sha256", "sha256").alias("kept_sha256"),
        F.coalesce("begins", nothing).alias("begins"),
        F.coalesce("ends", nothing).alias("ends"),
    )
