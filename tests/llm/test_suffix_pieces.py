"""Pieces of suffixes: each suffix in one, equal suffixes under one key, and few of them named one by one."""

import random

import numpy as np
from shelfwise.llm.suffixes import DEPTH, PIECE, _keyed, _pieces, _suffixes, _zones, pieces_of, remove_repeated_bytes, repeated
from shelfwise.session import stage
from tests.llm.test_suffixes import by_brute_force, got


def letters(rng, n, of="abcdefgh "):
    return "".join(rng.choice(of) for _ in range(n))


def arrays(texts):
    data = np.frombuffer("".join(texts).encode(), dtype=np.uint8)
    return data, np.cumsum([0, *(len(t.encode()) for t in texts)])


def test_each_suffix_is_in_one_piece_and_equal_ones_share_a_key():
    rng = random.Random(1)
    p, q = letters(rng, 180), letters(rng, 90, "ab")
    texts = [letters(rng, 40) + p, p[20:] + letters(rng, 60), q + "xyz" * 70 + q, "e" * 250, "", "a" * 99, p + p, letters(rng, 400, "ab")]
    data, offsets = arrays(texts)
    got_ = pieces_of(data, offsets)
    key_of, held = {}, []
    for text, key, since, until in zip(got_.text, got_.key, got_.since, got_.until):
        assert 0 < until - since <= PIECE and offsets[text] <= since and until + DEPTH - 1 <= offsets[text + 1]
        for at in range(since, until):
            held.append(at)
            assert key_of.setdefault(data[at : at + DEPTH].tobytes(), key) == key
    assert sorted(held) == [at for a, b in zip(offsets[:-1], offsets[1:]) for at in range(a, b - DEPTH + 1)]


def test_repeats_within_a_text():
    rng = random.Random(2)
    p = letters(rng, 150)
    texts = [p + letters(rng, 30) + p[:120] + "-" + p, "xyz" * 60, p, "q" * 130]
    data, offsets = arrays(texts)
    pieces = pieces_of(data, offsets)
    firsts, _, again = repeated(data, pieces)
    marked = {at for a, b in zip(pieces.since[~firsts], pieces.until[~firsts]) for at in range(a, b)} | set(again.tolist())
    wanted = set()
    for a, b in zip(offsets[:-1], offsets[1:]):
        seen = set()
        for at in range(a, b - DEPTH + 1):
            wanted |= {at} if data[at : at + DEPTH].tobytes() in seen else set()
            seen.add(data[at : at + DEPTH].tobytes())
    assert marked == wanted and wanted


def test_only_ends_of_shared_passages_are_named(spark, table):
    """Not each suffix around a shared anchor, as there are as many as bytes."""
    rng = random.Random(3)
    p = letters(rng, 4000)
    rows = [(i, letters(rng, 300) + p + letters(rng, 300)) for i in range(5)]
    keyed = _keyed(table("doc_id long, text string", *rows), "doc_id", "text")
    candidates = stage(keyed.join(_zones(stage(_pieces(keyed), "pieces")), ["doc", "part"]), "candidates")
    assert candidates.count() == 5 and _suffixes(candidates).count() < 1500
    assert got(remove_repeated_bytes(table("doc_id long, text string", *rows))) == by_brute_force(rows)


def test_strings_around_the_length(spark, table):
    """Passages of 60 to 140 bytes between others, one id with several texts, and texts without an id."""
    rng = random.Random(4)
    passages = [letters(rng, n) for n in (60, 66, 67, 90, 99, 100, 101, 134, 135, 140)] + ["ab" * 60]
    text = lambda: "".join(letters(rng, rng.randrange(0, 8)) + rng.choice(passages) for _ in range(rng.randrange(1, 9)))
    rows = [(rng.choice([None, *range(25)]), text()) for _ in range(60)]
    assert got(remove_repeated_bytes(table("doc_id long, text string", *rows).repartition(4))) == by_brute_force(rows)
