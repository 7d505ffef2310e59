"""Near lines against all pairs, the bit-parallel distance and the segments against plain code."""

import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfwise.llm.lines import EDITS, FLIPS, LEAST_LENGTH, _distance, _points, index_keys, near_lines, parities, probe_keys, segments, within_edits
from shelfwise.llm.queries import op6_line_dedup
from tests.llm.test_minhash import classes_of


def edited(rng, line, edits):
    s = list(line)
    for _ in range(edits):
        at, kind = rng.randrange(len(s) + 1), rng.randrange(3)
        if kind == 0 or not s:
            s.insert(at, rng.choice("abcé"))
        elif kind == 1:
            del s[min(at, len(s) - 1)]
        else:
            s[min(at, len(s) - 1)] = rng.choice("abc€")
    return "".join(s)


@settings(max_examples=300, deadline=None)
@given(st.text("ab", max_size=14), st.text("ab", max_size=14))
def test_distance_of_any_two(x, y):
    assert bool(within_edits([x], [y])[0]) == (_distance(x, y) <= EDITS)


def test_distance_of_many():
    rng = random.Random(2)
    a = ["".join(rng.choice("abcdé") for _ in range(rng.randrange(3, 120))) for _ in range(1500)]
    b = [edited(rng, x, rng.randrange(0, 6)) for x in a]
    assert within_edits(a, b).tolist() == [_distance(x, y) <= EDITS for x, y in zip(a, b)]


def test_segments_cover_a_line():
    length = np.arange(3, 200)
    parts = segments(length)
    assert (parts[0][0] == 0).all() and all((s + n == t).all() for (s, n), (t, _) in zip(parts, parts[1:]))
    assert (parts[-1][0] + parts[-1][1] == length).all() and all((parts[-1][1] - n <= 1).all() for _, n in parts)


def test_linked_lines_share_a_key_and_parities():
    rng = random.Random(3)
    for _ in range(400):
        x = "".join(rng.choice("abcde ") for _ in range(rng.randrange(LEAST_LENGTH, 90)))
        y = edited(rng, x, rng.randrange(0, EDITS + 1))
        short, long = sorted((x, y), key=len)
        keys = {int(k[0]) for k in index_keys(*_points([short]))}
        assert keys & {int(k[0]) for k in probe_keys(*_points([long]))}
        assert bin(int(parities(*_points([x]))[0] ^ parities(*_points([y]))[0])).count("1") <= FLIPS * EDITS


def by_all_pairs(rows):
    first, copies = {}, {}
    order = lambda place: (place[0] is None, place[0] or 0, place[1])
    for i, text in rows:
        for n, line in enumerate((text or "").split("\n")):
            first[line] = min(first.get(line, (i, n)), (i, n), key=order)
            copies[line] = copies.get(line, 0) + 1
    lines = list(first)
    counts = {x: Counter(x) for x in lines}
    links, parent = dict.fromkeys(lines, 0), {x: x for x in lines}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, x in enumerate(lines):
        for y in lines[:i]:
            if min(len(x), len(y)) < LEAST_LENGTH or abs(len(x) - len(y)) > EDITS:
                continue
            # an edit changes at most two letter counts
            if sum((counts[x] - counts[y]).values()) + sum((counts[y] - counts[x]).values()) <= 2 * EDITS and _distance(x, y) <= EDITS:
                links[x] += 1
                links[y] += 1
                parent[find(x)] = find(y)
    least = {}
    for x in lines:
        least[find(x)] = min(least.get(find(x), first[x]), first[x], key=order)
    return sorted(((*first[x], copies[x], links[x], *least[find(x)], least[find(x)] == first[x], x) for x in lines), key=str)


def got(df):
    columns = ("doc_id", "line_no", "n_copies", "n_links", "class_doc_id", "class_line_no", "kept", "line")
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def corpus():
    rng = random.Random(5)
    base = ["".join(rng.choice("abcdef ") for _ in range(rng.randrange(15, 60))) for _ in range(25)]
    rows = [(i, "\n".join(edited(rng, rng.choice(base), rng.randrange(0, 4)) for _ in range(rng.randrange(1, 6)))) for i in range(50)]
    return rows + [(None, base[0]), (None, None), (60, ""), (3, rows[3][1]), (61, "\n\n"), (62, "x" * 60_000), (63, "y" * 300), (64, "y" * 299 + "z\r\n")]


def test_all_pairs(spark, table):
    docs = table("doc_id long, text string, line int, place string", *((*r, 0, "") for r in corpus())).repartition(3)
    assert got(near_lines(docs)) == by_all_pairs(corpus())


def test_empty(spark, table):
    assert near_lines(table("doc_id long, text string")).collect() == []


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    want = by_all_pairs(rows)
    out = op6_line_dedup(spark, "/root/testdata/sf0.001").collect()
    assert sorted((r.doc_id, r.line_no, r.n_copies, r.n_links, r.class_doc_id, r.class_line_no, r.kept) for r in out) == sorted(w[:7] for w in want)
    assert len(classes_of(range(len(out)), [(r.class_doc_id, r.class_line_no) for r in out])) == sum(w[6] for w in want)
