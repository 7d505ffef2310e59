"""Merkle manifests against hashlib and lists."""

import hashlib
import string
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from registry.check import compare, connect
from shelfwise.llm.merkle import FIELDS, levels, manifest, numbered, sibling_indices

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climb(digests, arity):
    """Root, and of each leaf the siblings before and after it on its way up."""
    paths, at, level = [[] for _ in digests], list(range(len(digests))), list(digests)
    while len(level) > 1:
        for i, place in enumerate(at):
            begin = place - place % arity
            run = level[begin : begin + arity]
            paths[i].append((run[: place - begin], run[place - begin + 1 :]))
            at[i] = place // arity
        level = [sha("".join(level[b : b + arity])) for b in range(0, len(level), arity)]
    return level[0], paths


def by_hand(rows, arity=8):
    trees = defaultdict(list)
    for row in rows:
        trees[row[2]].append(row)
    names = sorted(trees, key=lambda n: (n is not None, (n or "").encode()))
    order = lambda r: (r[0] is not None, r[0] or 0, leaf_of(r))
    built = {n: climb([leaf_of(r) for r in sorted(trees[n], key=order)], arity) for n in names}
    root, above = climb([built[n][0] for n in names], arity)
    out = []
    for name, upper in zip(names, above):
        for row, path in zip(sorted(trees[name], key=order), built[name][1]):
            path = path + upper
            tampered = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0
            node = leaf_of((*row[:4], row[4].translate(LOWER))) if tampered and row[4] is not None else leaf_of(row)
            for left, right in path:
                node = sha("".join(left) + node + "".join(right))
            proof = sha("".join("".join(left) + "".join(right) for left, right in path))
            out.append((row[0], leaf_of(row), built[name][0], root, proof, node, node == root))
    return sorted(out, key=str)


def tampered():
    return F.crc32(F.col("doc_id").cast("string")) % 3 == 0


def made_rows():
    rows = [(i, f"s{i % 3}", ("en", "de", None, "é", "")[0 if i % 3 else i % 5], i * 7, f"Text {i}") for i in range(400)]
    return rows + [
        (900, None, "one", None, None), (None, "s", "en", 1, "no id"), (None, "s", "en", 1, "no ID"),
        (901, "s", "en", 3, ""), (901, "s", "en", 3, ""), (901, "s", "en", 3, "Z"),
        (902, "s", "de", 5, "É Ü A" * 60_000), (903, "5:x", "=", -4, "-"), (904, "s", "-", 0, "\n"),
    ]


@pytest.mark.parametrize("arity", [2, 3, 8])
def test_every_row(spark, table, arity):
    rows = made_rows()
    docs = table(SCHEMA + ", tree string, `left` int, `a.b` int", *((*r, "x", 1, 2) for r in rows)).repartition(7)
    out = manifest(docs, tampered(), arity=arity)
    assert out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    got = sorted((tuple(r) for r in out.collect()), key=str)
    assert got == by_hand(rows, arity)
    assert any(r[6] for r in got) and not all(r[6] for r in got)


def test_single_rows_and_trees(spark, table):
    for rows in ([(1, "s", "en", 2, "ab")], [(i, "s", "en", 2, "ab") for i in range(9)], [(i, "s", f"l{i:02}", 2, "AB") for i in range(20)]):
        got = sorted((tuple(r) for r in manifest(table(SCHEMA, *rows), tampered()).collect()), key=str)
        assert got == by_hand(rows)
    one = manifest(table(SCHEMA, (1, "s", "en", 2, "ab"))).first()
    assert one.leaf == one.subroot == one.root == one.folded_root and one.verified and one.proof_sha256 == sha("")


def test_empty(spark, table):
    assert manifest(table(SCHEMA), tampered()).collect() == []


def test_other_names(spark, table):
    docs = table("`the.id` long, body string, tongue string", (2, "B", "x"), (1, None, "x"))
    out = manifest(docs, fields=["the.id", "body"], id_col="the.id", tree_col="tongue", text_col="body")
    assert {(r[0], r.leaf) for r in out.collect()} == {(2, leaf_of((2, "B"))), (1, leaf_of((1, None)))}


def test_places_and_parents(spark, table):
    rows = table("tree string, id long, digest binary", *(("abc"[i % 3], i // 2, bytes([i])) for i in range(100))).repartition(5)
    placed = numbered(rows, "tree", ["id", "digest"], "places").collect()
    for tree in "abc":
        mine = sorted((r for r in placed if r.tree == tree), key=lambda r: r["index"])
        assert [r["index"] for r in mine] == list(range(len(mine))) and {r.total for r in mine} == {len(mine)}
        assert [(r.id, r.digest) for r in mine] == sorted((r.id, r.digest) for r in mine)
    found = levels(numbered(rows, "tree", ["id", "digest"], "places").select("tree", "index", "total", "digest"), 2, "level")
    assert [level.count() for level in found] == [100, 51, 27, 15, 9, 6, 3][: len(found)]
    got = spark.range(6).select(sibling_indices(F.col("id"), 2).alias("two"), sibling_indices(F.col("id"), 4).alias("four")).collect()
    assert [r.two for r in got] == [[1], [0], [3], [2], [5], [4]]
    assert [sorted(r.four) for r in got[:5]] == [[1, 2, 3], [0, 2, 3], [0, 1, 3], [0, 1, 2], [5, 6, 7]]


def test_query(spark):
    df = queries()["op13_merkle_manifest"](spark, SF_DIR)
    assert compare(df, connect(SF_DIR), oracle_sql()["op13_merkle_manifest"]) is None
    assert FIELDS == ("doc_id", "source", "lang", "n_chars", "text")
