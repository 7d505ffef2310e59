"""Repeated bytes against brute force, and names against the bytes they stand for."""

import hashlib
import random

import numpy as np
import pytest

from shelfwise.llm.queries import op9_suffix_array_dedup
from shelfwise.llm.suffixes import DEPTH, STRETCH, anchors, remove_repeated_bytes, suffix_names


def by_brute_force(rows):
    key = lambda i: float("inf") if i is None else i
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - DEPTH + 1):
            k = b[p : p + DEPTH]
            first[k] = min(first.get(k, float("inf")), key(i))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone, seen = bytearray(len(b)), set()
        for p in range(len(b) - DEPTH + 1):
            k = b[p : p + DEPTH]
            if first[k] < key(i) or k in seen:
                gone[p : p + DEPTH] = b"\1" * DEPTH
            seen.add(k)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for p, g in enumerate(gone) if g and (p == 0 or not gone[p - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()), key=str)


def corpus(seed, n=40):
    rng = random.Random(seed)
    letters = lambda k: "".join(rng.choice("abé ") for _ in range(k))
    passages = [letters(rng.randrange(60, 300)) for _ in range(6)] + ["xyz" * 80, "q" * 350]
    rows = []
    for i in range(n):
        text = ""
        for _ in range(rng.randrange(0, 4)):
            p = rng.choice(passages)
            text += letters(rng.randrange(0, 50)) + p[rng.randrange(0, 9) : len(p) - rng.randrange(0, 9)]
        rows.append((i, text))
    return rows + [(n, rows[7][1]), (n + 1, rows[7][1])]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_brute_force(spark, table, seed):
    rows = corpus(seed)
    docs = table("doc_id long, text string, names string, doc int", *((*r, "", 0) for r in rows)).repartition(3)
    assert got(remove_repeated_bytes(docs)) == by_brute_force(rows)


def test_spans(spark, table):
    rows = corpus(4, 20)
    for r in remove_repeated_bytes(table("doc_id long, text string", *rows)).collect():
        data = rows[r.doc_id][1].encode()
        kept, at = b"", 0
        for a, b in zip(r.begins, r.ends):
            kept, at = kept + data[at:a], b
        assert hashlib.sha256(kept + data[at:]).hexdigest() == r.kept_sha256


def test_missing_repeated_and_long(spark, table):
    p = "".join(chr(97 + k * k % 26) for k in range(150))
    rows = [(5, p), (None, p), (None, p), (None, "-" + p), (9, None), (10, ""), (5, p), (5, "x" + p), (3, "one"), (11, "long " * 30_000), (12, "a" * 99), (13, "a" * 99)]
    assert got(remove_repeated_bytes(table("doc_id long, text string", *rows))) == by_brute_force(rows)
    assert remove_repeated_bytes(table("doc_id long, text string")).collect() == []


@pytest.mark.parametrize("turn", [0, 1])
def test_names_stand_for_bytes(turn):
    rng = np.random.default_rng(turn)
    window = rng.integers(97, 99, DEPTH).astype(np.uint8)
    names = set()
    for before in range(7):
        data = np.concatenate([rng.integers(0, 256, before), window, rng.integers(0, 256, before * 3)]).astype(np.uint8)
        found = suffix_names(data, turn)
        names.add(int(found[before]))
        assert len(found) == len(data) - DEPTH + 1 and len(set(found.tolist())) == len(found)
    assert len(names) == 1 and len(suffix_names(window[1:], turn)) == 0


def test_every_suffix_holds_its_anchor():
    rng = np.random.default_rng(4)
    texts = [rng.integers(97, 97 + k, n).astype(np.uint8) for k, n in ((2, 500), (1, 300), (9, 99), (4, 100), (6, 0), (3, 250))]
    offsets = np.cumsum([0, *map(len, texts)])
    places, names = anchors(np.concatenate(texts), offsets)
    for text, since, until in zip(texts, offsets[:-1], offsets[1:]):
        own = (places >= since) & (places < until)
        alone, alone_names = anchors(text, np.array([0, len(text)]))
        assert (places[own] - since).tolist() == alone.tolist() and names[own].tolist() == alone_names.tolist()
        for p in range(len(text) - DEPTH + 1):
            assert ((alone >= p) & (alone < p + STRETCH)).any()


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert got(op9_suffix_array_dedup(spark, "/root/testdata/sf0.001")) == by_brute_force(rows)
