"""Signatures against the weighted similarity, classes against brute force."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfwise.llm.components import components
from shelfwise.llm.minhash import (
    MOST_FLIPS, _apart, _prefixes, _units, band_keys, drop_near_copies, near_copies, overlaps, shingles, signatures, sketch_bits,
)
from shelfwise.llm.queries import op5_minhash_near_dedup
from shelfwise.llm.wordhash import chunks

SF_DIR = "/root/testdata/sf0.001"


def bag(text):
    w = (text or "").encode().split()
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def similarity(a, b):
    less = sum((a & b).values())
    return less, sum((a | b).values())


def by_brute_force(rows):
    """Class of each row by its place: rows are linked when identical or similar."""
    bags = [bag(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            less, more = similarity(bags[i], bags[j])
            if (rows[i][1] or "") == (rows[j][1] or "") or (more and less * 5 >= more * 4):
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(rows))]


def classes_of(ids, classes):
    groups = {}
    for i, c in zip(ids, classes):
        groups.setdefault(c, []).append(i)
    return sorted(sorted(g, key=str) for g in groups.values())


def test_shingles():
    texts = ["a b c d e f", "", "x y", "a b c d e a b c d e a b c d e", " a\tb c d e"]
    for chunk in chunks(pa.array(texts), limit=20):
        owner, x, count = shingles(chunk)
        for i in range(len(chunk.offsets) - 1):
            assert sorted(count[owner == i].tolist()) == sorted(bag(texts[chunk.first + i]).values())


@pytest.mark.parametrize("heavy", [1, 5, 40])
def test_registers_agree_like_the_weighted_similarity(heavy):
    rng = np.random.default_rng(heavy)
    x = rng.integers(0, 1 << 60, 60).astype(np.uint64)
    counts = rng.integers(1, heavy + 1, (2, 60))
    counts[0, :15] = 0
    owner = np.repeat([0, 1], 60)
    held = counts.reshape(-1) > 0
    m = 4096
    values = signatures(owner[held], np.tile(x, 2)[held], counts.reshape(-1)[held], 2, m)
    want = np.minimum(*counts).sum() / np.maximum(*counts).sum()
    assert abs((values[0] == values[1]).mean() - want) < 4 * np.sqrt(want * (1 - want) / m)


def test_few_registers_are_unbiased_and_independent():
    rng = np.random.default_rng(8)
    n, m = 400, 64
    agree, spread = [], []
    for _ in range(20):
        x = rng.integers(0, 1 << 60, (n, 1, 50)).astype(np.uint64)
        counts = rng.integers(0, 3, (n, 2, 50))
        owner = np.repeat(np.arange(2 * n), 50)
        held = counts.reshape(-1) > 0
        values = signatures(owner[held], np.repeat(x, 2, axis=1).reshape(-1)[held], counts.reshape(-1)[held], 2 * n, m)
        want = np.minimum(counts[:, 0], counts[:, 1]).sum(axis=1) / np.maximum(counts[:, 0], counts[:, 1]).sum(axis=1)
        got = (values[0::2] == values[1::2]).mean(axis=1)
        agree.append((got - want).mean())
        spread.append(((got - want) ** 2).mean() / (want * (1 - want) / m).mean())
    assert abs(np.mean(agree)) < 0.003 and 0.9 < np.mean(spread) < 1.1


def test_recall_at_the_border():
    """Ten thousand pairs of exactly the similarity sought: nearly all share a band and pass the sketch."""
    rng = np.random.default_rng(12)
    pairs, found = 10_000, 0
    for _ in range(10):
        n = pairs // 10
        shared, own = rng.integers(0, 1 << 62, (n, 1, 40)), rng.integers(0, 1 << 62, (n, 2, 5))
        x = np.concatenate([np.repeat(shared, 2, axis=1), own], axis=2).astype(np.uint64)
        owner = np.repeat(np.arange(2 * n), 45)
        values = signatures(owner, x.reshape(-1), np.ones(x.size, dtype=np.int64), 2 * n)
        keys, bits = band_keys(values), sketch_bits(values)
        flips = np.bitwise_count(bits[0::2] ^ bits[1::2]).sum(axis=1)
        found += ((keys[0::2] == keys[1::2]).any(axis=1) & (flips <= MOST_FLIPS)).sum()
    assert found >= 0.999 * pairs


def test_texts_across_classes_meet_by_a_rare_shingle(spark, table):
    """A bucket of near copies, mostly just unlinked: the candidates hold every link and few other pairs."""
    rng = random.Random(9)
    base = [f"w{k}" for k in range(150)]
    texts = []
    for i in range(300):
        words = list(base)
        for place in rng.sample(range(150), rng.choice([0, 1, 2, 3, 4, 6])):
            words[place] = f"x{i}_{place}"
        texts.append(" ".join(words))
    nodes = spark.createDataFrame(list(enumerate(texts)), "node long, text string").repartition(4)
    prefixes = _prefixes(_units(nodes)).withColumn("class", F.col("node"))
    pairs = {(r.a, r.b) for r in _apart(prefixes).collect()}
    bags = [bag(t) for t in texts]
    linked = set()
    for b in range(300):
        for a in range(b):
            less, more = similarity(bags[a], bags[b])
            if less * 5 >= more * 4:
                linked.add((a, b))
    assert linked and linked <= pairs and len(pairs) < 300 * 299 / 2
    lone = [i for i in range(300) if not any(i in p for p in linked)]
    assert lone and len(pairs) <= 3 * len(linked)
    # texts of one class are never paired
    assert _apart(_prefixes(_units(nodes)).withColumn("class", F.lit(1).cast("long"))).isEmpty()


def test_overlaps():
    a = ["a b c d e f g", "", "x", "a a a a a a a a"]
    b = ["b c d e f g h", "z", "x", "a a a a a a"]
    less, more = overlaps(pa.array(a), pa.array(b))
    assert list(zip(less, more)) == [similarity(bag(s), bag(t)) for s, t in zip(a, b)]


def variants():
    rng = random.Random(3)
    rows = []
    for g in range(12):
        base = [f"w{g}_{k}" for k in range(60)]
        for v in range(8):
            words = base[:]
            for _ in range(v % 4):
                words[rng.randrange(60)] = f"new{rng.random()}"
            rows.append((len(rows), " ".join(words)))
    rows += [(len(rows), rows[5][1]), (len(rows) + 1, None), (len(rows) + 2, ""), (len(rows) + 3, "a b"), (len(rows) + 4, "a  b"), (len(rows) + 5, "é " * 20_000)]
    return rows


def test_classes(spark, table):
    rows = variants()
    docs = table("doc_id long, text string, class string, node int", *((*r, "x", 1) for r in rows)).repartition(3)
    out = near_copies(docs).collect()
    want = classes_of([i for i, _ in rows], by_brute_force(rows))
    assert classes_of([r.doc_id for r in out], [r.class_id for r in out]) == want
    assert all(r.kept == (r.doc_id == r.class_id) for r in out)
    assert all(r.class_size == sum(q.class_id == r.class_id for q in out) for r in out)
    stay = drop_near_copies(docs)
    assert stay.columns == docs.columns and sorted(r.doc_id for r in stay.collect()) == sorted(min(g) for g in want)


def test_a_bucket_of_several_classes(spark, table):
    # neighbours of the chain are similar, its ends are not; all share most of their shingles
    words = [f"w{k}" for k in range(400)]
    chain = [" ".join(words[:300] + [f"c{j}_{k}" for k in range(j * 8)] + words[300 : 400 - j * 8]) for j in range(10)]
    rows = list(enumerate(chain))
    out = near_copies(table("doc_id long, text string", *rows)).collect()
    assert classes_of([r.doc_id for r in out], [r.class_id for r in out]) == classes_of(range(10), by_brute_force(rows))


def test_repeated_rows_missing_ids_and_empty(spark, table):
    assert near_copies(table("doc_id long, text string")).collect() == []
    docs = table("doc_id long, text string", (None, "q w e"), (4, "q w e"), (4, "q w e"), (None, "z"), (None, "z"))
    out = near_copies(docs).collect()
    assert sorted((str(r.doc_id), str(r.class_id)) for r in out) == [("4", "4"), ("4", "4"), ("None", "4"), ("None", "None"), ("None", "None")]
    assert sum(r.kept for r in out) == 2
    assert sorted(map(tuple, drop_near_copies(docs).collect()), key=str) == [(4, "q w e"), (None, "z")]


def test_components(spark, table):
    chain = [(i, i + 1) for i in range(60)] + [(100, 200 + i) for i in range(50)] + [(7, 7), (3, 2)]
    out = {r.node: r.component for r in components(table("a long, b long", *chain)).collect()}
    assert out == {i: 0 for i in range(61)} | {100: 100} | {200 + i: 100 for i in range(50)}
    assert components(table("a long, b long")).collect() == []


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    out = op5_minhash_near_dedup(spark, SF_DIR).collect()
    assert classes_of([r.doc_id for r in out], [r.class_id for r in out]) == classes_of([i for i, _ in rows], by_brute_force(rows))
