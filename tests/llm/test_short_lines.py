"""Near lines of any length against all pairs by the textbook distance, without the bounds of the operator."""

import random

import pytest

from shelfwise.llm.lines import near_lines


def apart(x, y):
    row = list(range(len(y) + 1))
    for i, c in enumerate(x, 1):
        last, row = row, [i]
        for j, d in enumerate(y, 1):
            row.append(min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (c != d)))
    return row[-1]


def expected(lines, edits):
    near = {x: {y for y in lines if x != y and apart(x, y) <= edits} for x in lines}
    first = {}
    for x in lines:  # in the order of their documents
        if x not in first:
            first[x], todo = x, [x]
            while todo:
                for y in near[todo.pop()]:
                    if y not in first:
                        first[y] = x
                        todo.append(y)
    return {x: (len(near[x]), lines.index(first[x]), first[x] == x) for x in lines}


def lines_of(letters, lengths, n, seed):
    rng = random.Random(seed)
    return list(dict.fromkeys("".join(rng.choice(letters) for _ in range(rng.choice(lengths))) for _ in range(n)))


def around(lengths, seed):
    """Groups of lines few edits apart, about each length."""
    rng, out = random.Random(seed), []
    for n in lengths:
        line = [rng.choice("abcdefghij é€") for _ in range(n)]
        for k in (0, 1, 2, 3, 2, 1):
            near = list(line)
            for _ in range(k):
                at = rng.randrange(len(near) + 1)
                near[at : at + rng.randrange(2)] = rng.choice(["", "z", "q"])
            out.append("".join(near))
    return list(dict.fromkeys(out))


CASES = {
    "tiny": ["", "a", "bc", "x", "yz", "abc", "zbc", "abcd", "xyzw", "pqrs", "😀", "😀é"],
    "dense": lines_of("abc", range(0, 8), 120, 1),
    "sparse": lines_of("abcdefghijklmnopqrstuvwxyz", range(0, 6), 150, 2),
    "lengths": around([*range(0, 26), *range(3, 26)], 3),
    "across": ["Terms and condition", "Terms and conditions", "Starters, menu 11", "Starters menu 12", "MIT License", "MIT Licence."],
}


@pytest.mark.parametrize("edits", [2, 1])
@pytest.mark.parametrize("case", CASES)
def test_lines_of_any_length(spark, table, case, edits):
    lines = CASES[case]
    docs = table("doc_id long, text string", *enumerate(lines)).repartition(3)
    got = {r.line: (r.n_links, r.class_doc_id, r.kept) for r in near_lines(docs, edits=edits).collect()}
    assert got == expected(lines, edits)
