"""Repeated passages against brute force, and the promise that repeated windows share an anchor."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from shelfwise.llm.queries import op7_substring_dedup
from shelfwise.llm.substrings import WINDOW, anchors, recompress, remove_repeats
from shelfwise.llm.wordhash import chunks, word_hashes

SF_DIR = "/root/testdata/sf0.001"


def by_brute_force(rows):
    key = lambda i: float("inf") if i is None else i
    split = [(i, (t or "").encode().split()) for i, t in rows]
    first = {}
    for i, w in split:
        for p in range(len(w) - WINDOW + 1):
            k = tuple(w[p : p + WINDOW])
            first[k] = min(first.get(k, float("inf")), key(i))
    out = []
    for i, w in split:
        gone = [False] * len(w)
        for p in range(len(w) - WINDOW + 1):
            if first[tuple(w[p : p + WINDOW])] < key(i):
                gone[p : p + WINDOW] = [True] * WINDOW
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()), key=str)


def corpus(seed=1, n=60):
    rng = random.Random(seed)
    word = lambda: rng.choice(["a", "b", "the", "of"]) if rng.random() < 0.4 else f"w{rng.randrange(400)}"
    passages = [[word() for _ in range(rng.randrange(30, 140))] for _ in range(8)]
    passages += [["er"] * 120, ["x", "y"] * 60, ["q"] * 7 + [word() for _ in range(45)] + ["r"] * 9]
    rows = []
    for i in range(n):
        words = []
        for _ in range(rng.randrange(0, 5)):
            words += [word() for _ in range(rng.randrange(0, 40))]
            p = rng.choice(passages)
            words += p[rng.randrange(0, 5) : len(p) - rng.randrange(0, 5)]
        rows.append((i, rng.choice([" ", "\n", "\t "]).join(words)))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_brute_force(spark, table, seed):
    rows = corpus(seed)
    docs = table("doc_id long, text string, doc string, n_words string", *((*r, "", "") for r in rows)).repartition(3)
    assert got(remove_repeats(docs)) == by_brute_force(rows)


def test_kept_text(spark, table):
    rows = corpus(4, 20)
    for r in remove_repeats(table("doc_id long, text string", *rows)).collect():
        text = r.kept_text if r.n_removed else " ".join(rows[r.doc_id][1].split())
        assert hashlib.sha256(text.encode()).hexdigest() == r.kept_sha256


def test_missing_repeated_and_long(spark, table):
    passage = " ".join(f"p{k}" for k in range(60))
    rows = [(5, passage), (None, passage), (None, passage), (9, None), (10, ""), (5, passage), (5, "x " + passage), (3, "one"), (11, "long " * 40_000), (12, "é long " * 3 + "long " * 60)]
    assert got(remove_repeats(table("doc_id long, text string", *rows))) == by_brute_force(rows)
    assert remove_repeats(table("doc_id long, text string")).collect() == []


def test_repeated_windows_share_an_anchor():
    rng = random.Random(7)
    word = lambda: rng.choice("abc") if rng.random() < 0.5 else f"w{rng.randrange(50)}"
    for _ in range(300):
        window = [word() for _ in range(WINDOW)]
        if max(len(list(g)) for g in runs(window)) >= 4:
            continue
        found = []
        for _ in range(2):
            text = " ".join([word() for _ in range(rng.randrange(60))] + window + [word() for _ in range(rng.randrange(60))])
            chunk = next(chunks(pa.array([text])))
            s, e, _ = chunk.words()
            h = word_hashes(chunk, s, e)
            at = next(p for p in range(len(h)) if (h[p : p + WINDOW] == word_hashes(*own(window))).all())
            names, _, begin, end = anchors(*recompress(h, np.zeros(len(h), dtype=int)))
            inside = (begin >= at) & (end <= at + WINDOW)
            found.append(set(zip(names[inside].tolist(), (begin[inside] - at).tolist())))
        assert found[0] & found[1]


def own(window):
    chunk = next(chunks(pa.array([" ".join(window)])))
    s, e, _ = chunk.words()
    return chunk, s, e


def runs(words):
    part = [words[0]]
    for w in words[1:]:
        if w == part[-1]:
            part.append(w)
        else:
            yield part
            part = [w]
    yield part


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    assert got(op7_substring_dedup(spark, SF_DIR)) == by_brute_force(rows)
