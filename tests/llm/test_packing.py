"""Packing: exact round trip, cheapest cuts by brute force, and the ids of the public tokenizer."""

import zlib
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from shelfwise.llm.packing import HARD_CUT, SENTENCE_CUT, boundaries, pack, plan_cuts, split_tail
from shelfwise.llm.queries import op1_packing
from shelfwise.llm.tokens import default_vocabulary

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def exact():
    return Tokenizer.from_file(default_vocabulary()[0])


def cheapest(places, penalties, size):
    @lru_cache(None)
    def cost(j):
        return 0 if j == 0 else penalties[j] + min(
            cost(i) + size - (places[j] - places[i]) for i in range(j) if places[j] - places[i] <= size
        )

    return cost(len(places) - 1)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 9), st.integers(0, 20)), min_size=1, max_size=40))
def test_cuts_are_cheapest(gaps):
    places = np.cumsum([0, *(g for g, _ in gaps)])
    penalties = np.array([0, *(p for _, p in gaps)])
    cuts = plan_cuts(places, penalties, 10)
    found = sum(int(penalties[np.searchsorted(places, c)]) for c in cuts[1:]) + sum(10 - np.diff(cuts))
    assert cuts[0] == 0 and cuts[-1] == places[-1] and max(np.diff(cuts)) <= 10
    assert found == cheapest(tuple(places.tolist()), tuple(penalties.tolist()), 10)


def test_boundaries():
    places, penalties = boundaries(np.array([5, 20]), np.array([3, 5]), step=4)
    assert list(zip(places, penalties))[1:] == [(3, SENTENCE_CUT), (5, 0), (9, HARD_CUT), (13, HARD_CUT), (17, HARD_CUT), (20, 0)]


@pytest.mark.parametrize("length", [1, 2, 3, 1387, 2047, 2048, 1025])
def test_tail(length):
    parts = split_tail(length)
    assert sum(parts) == length and all(p & (p - 1) == 0 for p in parts[:-1])


def rebuilt(rows):
    """Checks that sequences are gapless and documents whole; ids by document in the order of pieces."""
    sequences, docs = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        docs[r.doc_id].append((r.start, r.length, r.doc_tokens, r))
    padding = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    return docs, padding


def test_round_trip(spark, table, exact):
    texts = {1: "One. Two three.", 2: None, 3: "", 4: "word " * 9000, 5: "a" * 20_000, 6: "x <|endoftext|> y", 7: "é\n" * 300, 8: "Ab. " * 70_000}
    docs = table("doc_id long, text string, ids int, start int", *((i, t, 0, 0) for i, t in texts.items())).repartition(2)
    rows = pack(docs, block=5000).collect()
    by_doc, _ = rebuilt(rows)
    assert set(by_doc) == set(texts)
    for i, parts in by_doc.items():
        parts.sort(key=lambda p: p[0])
        whole = b"".join(p[3].ids for p in parts)
        want = [*exact.encode(texts[i] or "", add_special_tokens=False).ids, 1]
        assert np.frombuffer(whole, dtype="<u4").tolist() == want
        assert [p[0] for p in parts] == np.cumsum([0, *(p[1] for p in parts[:-1])]).tolist()
        assert all(p[2] == len(want) for p in parts)


def test_query(spark, exact):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    rows = op1_packing(spark, SF_DIR).collect()
    by_doc, padding = rebuilt(rows)
    assert len(by_doc) == len(docs)
    for d in docs:
        ids = np.array([*exact.encode(d.text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        at = 0
        for start, length, total, r in sorted(by_doc[d.doc_id], key=lambda p: p[0]):
            assert start == at and total == len(ids) and zlib.crc32(ids[start : start + length].tobytes()) == r.ids_crc32
            at += length
        assert at == len(ids)
    assert padding < 0.01 * sum(r.length for r in rows)


def test_empty_repeated_and_missing_ids(spark, table):
    assert pack(table("doc_id long, text string")).collect() == []
    rows = pack(table("doc_id long, text string", (None, "a"), (3, "b"), (3, "b"))).collect()
    assert sorted((str(r.doc_id), r.length) for r in rows) == [("3", 2), ("3", 2), ("None", 2)]
