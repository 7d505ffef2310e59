"""Mixing against brute force apportionment and the rules of the mix."""

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from shelfwise.llm.mixing import apportion, mix, mixed_documents


def highest_quotients(votes, seats):
    best = sorted((-v / (2 * k - 1), p, k) for p, v in votes.items() if v for k in range(1, seats + 1))[:seats]
    won = Counter(p for _, p, _ in best)
    return {p: won[p] for p in votes}


@pytest.mark.parametrize("seats", [0, 1, 7, 50, 999])
def test_apportionment(spark, table, seats):
    groups = {1: {i: float((i * 37) % 101) for i in range(30)}, 2: {0: 5.0, 1: 5.0, 2: 0.0}, 3: {4: 1000.0}, 4: {9: 0.0}}
    rows = [(g, p, v, seats) for g, parties in groups.items() for p, v in parties.items()]
    out = apportion(table("g int, p int, v double, s long", *rows), ["g"], "p", "v", "s").collect()
    got = {(r.g, r.p): r.won for r in out}
    assert got == {(g, p): n for g, parties in groups.items() for p, n in highest_quotients(parties, seats).items()}


def targets(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    capped = set()
    while True:
        rest = share * sum(sizes.values()) - sum(cap * sizes[s] for s in capped)
        free = sum(weight[s] for s in names if s not in capped)
        want = {s: cap * sizes[s] if s in capped else rest * weight[s] / free for s in names}
        over = {s for s in names if want[s] > cap * sizes[s] * (1 + 1e-12)}
        if not over:
            return want
        capped |= over


def corpus(n=400):
    hot = lambda i: "src0" if i % 3 else f"src{i % 11}"
    rows = [(i, " ".join(f"w{i}_{k}" for k in range(i * 7 % 90)), None if i % 29 == 0 else hot(i), i) for i in range(n)]
    return rows + [(None, "a b c", "src1", 0), (7, None, "src2", 0), (7, "", "only", 0), (8, "long " * 30_000, "src3", 0)]


COLUMNS = "doc_id long, text string, source string, size int"


def test_rules(spark, table):
    rows = corpus()
    docs = table(COLUMNS, *rows).repartition(3)
    out = mix(docs).collect()
    assert len(out) == len(rows) and all(0 <= r.taken <= 2 * r.size for r in out)
    assert Counter(r.size for r in out) == Counter(len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _, _ in rows)
    sizes = defaultdict(int)
    for _, t, s, _ in rows:
        sizes[s] += len((t or "").split())
    want = targets(sizes)
    assert Counter(round(t, 6) for t in {r.target for r in out}) == Counter({round(t, 6) for t in want.values()})
    taken = defaultdict(int)
    for r in out:
        taken[r.target] += r.taken
    for t, n in taken.items():
        assert abs(n - t) <= 1
    again = mix(docs.repartition(9)).collect()
    assert Counter(map(tuple, out)) == Counter(map(tuple, again))


def test_mixed_texts_hold_the_words_taken(spark, table):
    docs = table(COLUMNS, *corpus())
    taken = {(r.doc_id, r.size): r.taken for r in mix(docs).collect()}
    out = mixed_documents(docs)
    assert out.columns == docs.columns
    words = Counter()
    texts = {(i, len((t or "").split())): t for i, t, _, _ in corpus()}
    for r in out.withColumn("n", F.size(F.split(F.trim("text"), r"\s+"))).collect():
        key = next(k for k in texts if k[0] == r.doc_id and (k[0] not in (7, 8) or (k[1] > 100) == (r.source == "src3")))
        words[key] += r.n
        assert set(r.text.split()) <= set(texts[key].split())
    assert words == Counter({k: n for k, n in taken.items() if n})


def test_empty_and_wordless(spark, table):
    assert mix(table(COLUMNS)).collect() == [] and mixed_documents(table(COLUMNS)).collect() == []
    blank = table(COLUMNS, (1, None, "a", 0), (2, "  ", None, 0))
    assert sorted(map(tuple, mix(blank).collect())) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
    assert mixed_documents(blank).collect() == []


def test_small_sources_reach_their_targets(spark, table):
    """Sources of fewer words than a block, in small and in larger company."""
    for sizes in ([20, 25, 30, 40, 70], [1, 2, 3], [14], [5, 5, 5, 20_000], [63, 64, 65, 1]):
        words = {f"s{k}": n for k, n in enumerate(sizes)}
        rows = [(k, "w " * (n // 2), s, 0) for k, (s, n) in enumerate(words.items())]
        rows += [(100 + k, "v " * (n - n // 2), s, 0) for k, (s, n) in enumerate(words.items())]
        out = mix(table(COLUMNS, *rows)).collect()
        want, taken = targets(words), Counter()
        for r in out:
            taken[rows[r.doc_id % 100][2]] += r.taken
            assert 0 <= r.taken <= 2 * r.size
        assert all(abs(taken[s] - want[s]) <= 0.5 for s in words)
        assert sum(taken.values()) > 0


def test_sources_with_many_shards(spark, table):
    rows = [(i, f"{'x ' * (i % 50)}", "big" if i % 4 else "rest", 0) for i in range(4000)]
    with_one_long = [*rows, (9000, "y " * 70_000, "big", 0)]
    for part in (rows, with_one_long):
        sizes = Counter()
        for _, t, s, _ in part:
            sizes[s] += len(t.split())
        taken = Counter()
        source = {i: s for i, _, s, _ in part}
        for r in mix(table(COLUMNS, *part)).collect():
            taken[source[r.doc_id]] += r.taken
        for s, t in targets(sizes).items():
            assert abs(taken[s] - t) <= 64 * 5
