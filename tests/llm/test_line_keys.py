"""Index and probe keys of lines are made apart, each from one prefix sum."""

import random

import pytest

from shelfwise.llm import lines
from shelfwise.llm.lines import EDITS, LEAST_SEGMENT, _keys, _points, index_keys, probe_keys

SHORT = LEAST_SEGMENT * (EDITS + 1)


def texts():
    rng = random.Random(5)
    return ["".join(rng.choice("abcé ") for _ in range(n)) for n in [*range(SHORT + EDITS + 3), 40, 41, 200]]


@pytest.mark.parametrize("keys", [index_keys, probe_keys])
def test_one_prefix_sum_for_all_keys(monkeypatch, keys):
    made = []
    of = lines.range_hasher
    monkeypatch.setattr(lines, "range_hasher", lambda points: made.append(1) or of(points))
    some = [t for t in texts() if len(t) >= SHORT]
    together = [k.tolist() for k in keys(*_points(some))]
    assert len(made) == 1 and len(together) > EDITS
    # the same wherever a line lies
    assert together == [list(k) for k in zip(*([int(k[0]) for k in keys(*_points([t]))] for t in some))]


def test_each_side_has_only_its_own_keys(spark, table):
    rows = list(enumerate(texts()))
    df = table("line long, content string", *rows)
    index = [r.line for r in _keys(df, EDITS, probe=False).collect()]
    probes = [r.line for r in _keys(df, EDITS, probe=True).collect()]
    for line, text in rows:
        if len(text) >= SHORT + EDITS:
            assert index.count(line) == EDITS + 1
            assert probes.count(line) == sum(1 for _ in probe_keys(*_points([text])))
        elif len(text) >= SHORT:
            assert index.count(line) > EDITS + 1 and probes.count(line) == sum(1 for _ in probe_keys(*_points([text])))
        else:
            assert (index.count(line) > 0) == (len(text) > EDITS) and (probes.count(line) > 0) == (len(text) > 0)
