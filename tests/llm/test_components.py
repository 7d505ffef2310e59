"""Few rounds over small graphs, and the same classes wherever the rounds end."""

import random

import numpy as np
import pytest

import shelfwise.llm.components as module
import shelfwise.llm.minhash as minhash
from shelfwise.llm.components import components, least_nodes


def classes(links):
    parent = {n: n for link in links for n in link}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        low, high = sorted((find(a), find(b)))
        parent[high] = low
    return {n: find(n) for n in parent}


def shuffled_chains():
    rng = random.Random(5)
    names = rng.sample(range(1 << 40), 150)
    return [*zip(names[:80], names[1:81]), *zip(names[81:120], names[82:121]), *((names[121], n) for n in names[122:])]


@pytest.fixture
def written(monkeypatch):
    """Names of the stage tables that are written."""
    names, inner = [], module.stage

    def counted(df, name):
        names.append(name)
        return inner(df, name)

    monkeypatch.setattr(module, "stage", counted)
    monkeypatch.setattr(minhash, "stage", counted)
    return names


def test_least_nodes():
    links = shuffled_chains()
    nodes, least = least_nodes(*np.array(links).T)
    assert dict(zip(nodes.tolist(), least.tolist())) == classes(links)


@pytest.mark.parametrize("few", [0, 3, 40])
def test_rounds_before_few_links_are_left(spark, table, few):
    links = shuffled_chains()
    out = {r.node: r.component for r in components(table("a long, b long", *links), few).collect()}
    assert out == classes(links)


def test_a_few_links_take_no_rounds(spark, table, written):
    links = shuffled_chains()
    assert {r.node: r.component for r in components(table("a long, b long", *links)).collect()} == classes(links)
    assert len(written) <= 3


def test_near_copies_of_a_chain_write_few_tables(spark, table, written):
    # each turn had its own rounds over all links found so far
    words = [f"w{k}" for k in range(400)]
    rows = [(j, " ".join(words[:300] + [f"c{j}_{k}" for k in range(j * 8)] + words[300 : 400 - j * 8])) for j in range(10)]
    rows += [(100 + 10 * g + v, " ".join([f"g{g}_{k}" for k in range(60 - v)])) for g in range(20) for v in range(4)]
    out = minhash.near_copies(table("doc_id long, text string", *rows)).collect()
    assert len(out) == len(rows) and len(written) <= 24
