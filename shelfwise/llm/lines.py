"""Lines that differ by few edits, by a segment-partition join.

Distinct lines are linked when at most ``EDITS`` insertions, deletions or substitutions of
characters lead from one to the other, whatever their lengths. A line is cut into ``EDITS + 1``
even segments. Of two linked lines the shorter has a segment that no edit touches, and the
longer holds it nearly where it was; so segments are indexed by length, number and content, and
a line probes the index with its substrings of segment length whose shift the edits before and
after can explain. Lines too short for segments of ``LEAST_SEGMENT`` characters, and those up to
``EDITS`` longer, meet instead by what is left of them after at most ``EDITS`` deletions: two
linked lines have such a rest in common. What meets is compared by the parities of its counts of
adjacent characters, inside the join, and then by a banded bit-parallel edit distance. Lines of at most
``EDITS`` characters are all linked with each other, so these links are counted without being
listed. Classes are what links connect.

Lines are what line feeds separate. A missing text is one empty line. Equal lines are one;
its place is the first, by document and then by number, missing ids last. Repeated rows are
copies of each other's lines. An empty table gives an empty result. Other columns do not
matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.components import components
from shelfwise.llm.tables import ids_and_texts
from shelfwise.llm.wordhash import _BASE, _power, mix, range_hasher
from shelfwise.session import stage, unstage

EDITS = 2
LEAST_LENGTH = 0  # of lines that can be linked: all
LEAST_SEGMENT = 4
# bits of a line's parities that an edit can change
FLIPS = 4
CHUNK = 1 << 20
SLICE = 1 << 11


def segments(length: np.ndarray, edits: int = EDITS) -> list[tuple[np.ndarray, np.ndarray]]:
    """Start and size of each of ``edits + 1`` even segments; the last ones are the longer ones."""
    parts = edits + 1
    size, rest = length // parts, length % parts
    out = []
    for i in range(parts):
        longer = np.maximum(i - (parts - rest), 0)
        out.append((i * size + longer, size + (i >= parts - rest)))
    return out


def index_keys(points: np.ndarray, first: np.ndarray, length: np.ndarray, edits: int = EDITS) -> Iterator[np.ndarray]:
    """One key per line for each segment."""
    hashes = range_hasher(points)
    for i, (start, size) in enumerate(segments(length, edits)):
        yield _key(hashes, first + start, size, length, i)


def probe_keys(points: np.ndarray, first: np.ndarray, length: np.ndarray, edits: int = EDITS) -> Iterator[np.ndarray]:
    """One key per line for each length, segment and shift that may hold the segment of a line not longer."""
    hashes = range_hasher(points)
    for less in range(edits + 1):
        for i, (start, size) in enumerate(segments(np.maximum(length - less, 0), edits)):
            # at most i edits before the segment, and at most edits - i after it
            for shift in range(max(-i, less - (edits - i)), min(i, less + (edits - i)) + 1):
                # only in lines that are not longer than the edits, where segments may be empty, is it ever outside
                at = np.clip(start + shift, 0, length - size)
                yield _key(hashes, first + at, size, length - less, i)


def _key(hashes, start, size, length, number: int) -> np.ndarray:
    return mix(hashes(start, start + size) ^ mix(length.astype(np.uint64), 70 + number), 80)


def rest_keys(points: np.ndarray, first: np.ndarray, length: int, edits: int = EDITS) -> tuple[np.ndarray, np.ndarray]:
    """Of lines of one length: a key for each different rest after at most ``edits`` deletions, and the place of its line.

    The empty rest has no key: it says nothing, and only lines of at most ``edits`` characters have no other in common.
    """
    letters = points[first[:, None] + np.arange(length)]
    keys = [
        mix((letters[:, kept] * _power(_BASE, length - n)).sum(axis=2, dtype=np.uint64) ^ mix(np.uint64(length - n), 75), 80)
        for n in range(min(edits + 1, length))
        for kept in [np.array(list(combinations(range(length), length - n)))]
    ]
    if not keys:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    keys = np.sort(np.concatenate(keys, axis=1), axis=1)
    new = np.ones(keys.shape, dtype=bool)
    new[:, 1:] = keys[:, 1:] != keys[:, :-1]
    return keys[new], np.nonzero(new)[0]


def parities(points: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """64 bits per line, the parity of the counts of adjacent characters that hash to each: an edit flips four at most."""
    follows = np.append(points[1:], np.uint64(0))
    bits = np.uint64(1) << (mix(points * np.uint64(0x9E3779B97F4A7C15) + follows, 90) >> np.uint64(58))
    total = np.concatenate([np.zeros(1, dtype=np.uint64), np.bitwise_xor.accumulate(bits)])
    return total[first + np.maximum(length - 1, 0)] ^ total[first]


def _points(lines: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all lines, where each begins, and their lengths."""
    length = np.array([len(x) for x in lines], dtype=np.int64)
    points = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    return points, np.cumsum(length) - length, length


def within_edits(a: list[str], b: list[str], edits: int = EDITS) -> np.ndarray:
    """Which pairs are at most ``edits`` apart; column by column for all pairs at once.

    Only the diagonals within ``edits`` of the main one are held: bit 63 of a pair's word is the
    cell ``edits`` rows below it. A bit of ``up`` or ``down`` says that a cell is one more or one
    less than the one above it.
    """
    trimmed = [_middle(x, y) for x, y in zip(a, b)]
    close = np.array([abs(len(x) - len(y)) <= edits for x, y in trimmed], dtype=bool)
    easy = np.array([min(len(x), len(y)) <= edits for x, y in trimmed], dtype=bool)
    result = close & easy
    for k in np.flatnonzero(result):
        result[k] = _distance(*trimmed[k]) <= edits
    rest = np.flatnonzero(close & ~easy)
    order = rest[np.argsort([len(trimmed[k][1]) for k in rest], kind="stable")]
    for part in np.array_split(order, max(1, len(order) // 4096)):
        if len(part):
            result[part] = _banded([trimmed[k][0] for k in part], [trimmed[k][1] for k in part], edits) <= edits
    return result


def _middle(x: str, y: str) -> tuple[str, str]:
    """Both without the beginning and the end they share."""
    n = min(len(x), len(y))
    if x[:n] == y[:n]:
        return x[n:], y[n:]
    low, high = 0, n
    while high - low > 1:
        at = (low + high) // 2
        low, high = (at, high) if x[low:at] == y[low:at] else (low, at)
    x, y = x[low:], y[low:]
    n = min(len(x), len(y))
    low, high = 0, n + 1
    while high - low > 1:
        at = (low + high) // 2
        low, high = (at, high) if x[len(x) - at :] == y[len(y) - at :] else (low, at)
    return x[: len(x) - low], y[: len(y) - low]


def _distance(x: str, y: str) -> int:
    row = list(range(len(y) + 1))
    for i, c in enumerate(x, 1):
        before, row[0] = row[0], i
        for j, d in enumerate(y, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (c != d))
    return row[-1]


def _banded(patterns: list[str], texts: list[str], edits: int) -> np.ndarray:
    """Edit distances, right where they are at most ``edits``; all strings are longer than that."""
    one = np.uint64(1)
    (p, p_first, p_length), (t, t_first, t_length) = _points(patterns), _points(texts)
    n = len(patterns)
    up = np.full(n, (~0 << (63 - edits)) & ((1 << 64) - 1), dtype=np.uint64)
    down = np.zeros(n, dtype=np.uint64)
    distance = np.full(n, edits, dtype=np.int64)
    diagonal = p_length - edits  # columns in which the lowest row of the band is followed
    for column in range(int(t_length.max())):
        live = column < t_length
        letter = t[np.minimum(t_first + column, len(t) - 1)]
        equal = np.zeros(n, dtype=np.uint64)
        for bit in range(2 * edits + 1):
            row = column + edits - bit
            same = (row >= 0) & (row < p_length)
            same &= p[np.clip(p_first + row, 0, len(p) - 1)] == letter
            equal |= same.astype(np.uint64) << np.uint64(63 - bit)
        zero = (((equal & up) + up) ^ up) | equal | down
        more, less = down | ~(zero | up), zero & up
        slanted = column < diagonal
        distance += live & slanted & ((zero >> np.uint64(63)) == 0)
        # past it the last row of the pattern is followed, one bit lower in each column
        bit = (np.uint64(62) - np.maximum(column - diagonal, 0).astype(np.uint64)) & np.uint64(63)
        level = live & ~slanted
        distance += level & ((more >> bit & one) == 1)
        distance -= level & ((less >> bit & one) == 1)
        up = np.where(live, less | ~((zero >> one) | more), up)
        down = np.where(live, (zero >> one) & more, down)
    return distance


def _keys(lines: DataFrame, edits: int, probe: bool) -> DataFrame:
    """(key, line, parity) of the distinct lines (line, content) as index or as probe: who may be linked meets by a
    key of both, but for two lines of at most ``edits`` characters.
    """
    short = LEAST_SEGMENT * (edits + 1)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.cumsum([len(x) for x in batch.column("content").to_pylist()]) // CHUNK
            for some in np.split(np.arange(batch.num_rows), np.flatnonzero(np.diff(sizes)) + 1):
                part = batch.slice(some[0], len(some)) if len(some) else batch
                points, first, length = _points(part.column("content").to_pylist())
                parity = parities(points, first, length).view(np.int64)
                number = part.column("line").to_numpy()

                def rows(key: np.ndarray, of: np.ndarray) -> pa.RecordBatch:
                    return pa.RecordBatch.from_arrays(
                        [pa.array(key.view(np.int64)), pa.array(number[of]), pa.array(parity[of])], names=["key", "line", "parity"]
                    )

                long = np.flatnonzero(length >= short)
                if len(long):
                    for key in (probe_keys if probe else index_keys)(points, first[long], length[long], edits):
                        yield rows(key, long)
                # two lines of at most the edits never meet, and two that have segments do not meet here
                for n in range(1, short) if probe else range(edits + 1, short + edits):
                    same = np.flatnonzero(length == n)
                    for at in range(0, len(same), SLICE):
                        of = same[at : at + SLICE]
                        key, place = rest_keys(points, first[of], n, edits)
                        yield rows(key, of[place])

    return lines.select("line", "content").mapInArrow(make, "key long, line long, parity long")


def _linked(pairs: DataFrame, lines: DataFrame, edits: int) -> DataFrame:
    """The pairs (a, b) of lines that are at most ``edits`` apart."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = pa.array(within_edits(batch.column("a_content").to_pylist(), batch.column("b_content").to_pylist(), edits), pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"])

    side = lambda c: lines.select(F.col("line").alias(c), F.col("content").alias(f"{c}_content"))
    return (
        pairs.join(side("a"), "a", "inner")
        .join(side("b"), "b", "inner")
        .select("a", "b", "a_content", "b_content")
        .mapInArrow(compare, "a long, b long")
    )


def near_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits: int = EDITS) -> DataFrame:
    """One row per distinct line: its first place (doc_id, line_no), n_copies, n_links, its class's
    first place (class_doc_id, class_line_no), kept, and the line.
    """
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "line_no")
    lines = stage(
        ids_and_texts(docs, id_col, text_col)
        .select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "content"))
        .groupBy("content")
        .agg(F.min(place).alias("place"), F.count(F.lit(1)).alias("n_copies"))
        .withColumn("line", F.monotonically_increasing_id()),
        "distinct_lines",
    )
    index, probes = _keys(lines, edits, probe=False), _keys(lines, edits, probe=True)
    flips = F.bit_count(F.col("i.parity").bitwiseXOR(F.col("p.parity")))
    pairs = stage(
        index.alias("i")
        .join(probes.alias("p"), (F.col("i.key") == F.col("p.key")) & (F.col("i.line") != F.col("p.line")) & (flips <= FLIPS * edits), "inner")
        .select(F.least("i.line", "p.line").alias("a"), F.greatest("i.line", "p.line").alias("b"))
        .distinct(),
        "line_pairs",
    )
    links = stage(_linked(pairs, lines, edits), "line_links")
    unstage(pairs)
    degrees = links.select("a").unionByName(links.select(F.col("b").alias("a"))).groupBy("a").agg(F.count(F.lit(1)).alias("n_links"))
    # each of them is linked with all others of them: for the classes, links with one are enough
    tiny = lines.filter(F.length("content") <= edits).select("line")
    n_tiny, least = tiny.agg(F.count(F.lit(1)), F.min("line")).first()
    joining = tiny.filter(F.col("line") != F.lit(least)).select(F.lit(least).cast("long").alias("a"), F.col("line").alias("b"))
    among_tiny = F.when(F.length("content") <= edits, n_tiny - 1).otherwise(0)
    found = components(links.unionByName(joining)).join(degrees.withColumnRenamed("a", "node"), "node", "left")
    placed = stage(found.withColumnRenamed("node", "line").join(lines.select("line", "place"), "line", "inner"), "line_classes")
    # only lines with links have a class, and can have another first place than their own; the
    # many others meet no class, so they are not joined by one
    firsts = placed.groupBy("component").agg(F.min("place").alias("first"))
    of_line = stage(placed.join(firsts, "component", "inner").select("line", "n_links", "first"), "line_firsts")
    return lines.join(of_line, "line", "left").select(
        F.col("place.doc_id").alias("doc_id"),
        F.col("place.line_no").alias("line_no"),
        "n_copies",
        (F.coalesce("n_links", F.lit(0)) + among_tiny).cast("long").alias("n_links"),
        F.coalesce("first", "place").getField("doc_id").alias("class_doc_id"),
        F.coalesce("first", "place").getField("line_no").alias("class_line_no"),
        F.coalesce(F.col("first") == F.col("place"), F.lit(True)).alias("kept"),
        F.col("content").alias("line"),
    )
