"""Exact copies against a dictionary."""

import hashlib
from collections import defaultdict

import pytest

from shelfwise.llm.exact import drop_copies, exact_copies, heavy_candidates


def by_dictionary(rows):
    groups = defaultdict(list)
    for i, text, *_ in rows:
        groups[text or ""].append(i)
    key = lambda i: (i is not None, i)
    return sorted(
        (i, max(groups[t or ""], key=key), len(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest())
        for i, t, *_ in rows
    )


ROWS = [(i, f"text {i % 7}" if i % 3 else "the same") for i in range(90)] + [(90, None), (91, ""), (92, " "), (93, "é" * 50_000)]


@pytest.mark.parametrize("counters", [1, 3, 1024])
def test_groups(spark, table, counters):
    docs = table("doc_id long, text string, keep_id string", *((*r, "x") for r in ROWS)).repartition(5)
    out = exact_copies(docs, counters=counters).collect()
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in out) == by_dictionary(ROWS)
    assert all(r.kept == (r.doc_id == r.keep_id) for r in out)


@pytest.mark.parametrize("counters", [1, 1024])
def test_rows_that_stay(spark, table, counters):
    docs = table("doc_id long, text string, digest int, place string", *((*r, 1, None) for r in ROWS))
    out = drop_copies(docs, counters=counters)
    assert out.columns == docs.columns
    assert sorted(r.doc_id for r in out.collect()) == sorted({k for _, k, _, _ in by_dictionary(ROWS)})


@pytest.mark.parametrize("counters", [1, 1024])
def test_repeated_rows_and_missing_ids(spark, table, counters):
    rows = [(None, "a"), (None, "a"), (5, "b"), (5, "b"), (4, "b"), (None, "b")]
    docs = table("doc_id long, text string", *rows)
    out = exact_copies(docs, counters=counters).collect()
    assert sorted(((str(r.doc_id), r.keep_id, r.group_size) for r in out), key=str) == [
        ("4", 5, 4), ("5", 5, 4), ("5", 5, 4), ("None", 5, 4), ("None", None, 2), ("None", None, 2),
    ]
    assert sum(r.kept for r in out) == 2
    assert sorted(drop_copies(docs, counters=counters).collect(), key=str) == [(5, "b"), (None, "a")]


def test_empty(spark, table):
    docs = table("doc_id long, text string")
    assert exact_copies(docs).collect() == [] and drop_copies(docs).collect() == []


def test_candidates_hold_every_heavy_digest(spark, table):
    rows = [(i, "hot" if i % 2 else f"t{i}") for i in range(2000)]
    docs = table("doc_id long, text string", *rows).repartition(7)
    found = [r.text for r in heavy_candidates(docs, "text", 4).collect()]
    assert "hot" in found and len(found) <= 5
