"""Flat token files against a plain scan of their bytes."""

from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from shelfwise.llm.queries import op2_token_counts
from shelfwise.llm.tokencount import END_OF_DOCUMENT as END
from shelfwise.llm.tokencount import STRETCH, token_counts, write_flat
from shelfwise.llm.tokens import default_vocabulary

SF_DIR = "/root/testdata/sf0.001"


def plain(ids):
    """(document, start, tokens, closed) of one file."""
    out, start = [], 0
    for i, t in enumerate(ids):
        if t == END:
            out.append((len(out), start, i - start, True))
            start = i + 1
    return out + ([(len(out), start, len(ids) - start, False)] if start < len(ids) else [])


@pytest.mark.parametrize("block_bytes", [2, 6, 64, 1 << 20])
def test_scan(spark, tmp_path, block_bytes):
    rng = np.random.default_rng(block_bytes)
    # 50256 is 0x50 0xC4; these ids also hold the two bytes across a border
    files = {
        "part-a": rng.choice([END, 0x5001, 0x11C4, 0xC450, 7], 700).tolist(),
        "part-b": [],
        "part-c": [3] * 500,
        "part-d": [END] * 40,
        "part-e": [5, END],
        "part-f": [END, 5],
    }
    for name, ids in files.items():
        (tmp_path / name).write_bytes(np.array(ids, dtype="<u2").tobytes())
    out = token_counts(spark, str(tmp_path), block_bytes=block_bytes).collect()
    got = Counter((r.file.rsplit("/", 1)[1], r.document, r.start, r.n_tokens, r.closed) for r in out)
    assert got == Counter((name, *row) for name, ids in files.items() for row in plain(ids))


def test_more_than_one_stretch(spark, tmp_path):
    ids = ([1, 2, 3, END] * (STRETCH // 3)) + [4] * (3 * STRETCH) + [END, 9]
    (tmp_path / "part-0").write_bytes(np.array(ids, dtype="<u2").tobytes())
    out = token_counts(spark, str(tmp_path), block_bytes=2).collect()
    assert sorted((r.document, r.start, r.n_tokens, r.closed) for r in out) == plain(ids)


def test_odd_bytes(spark, tmp_path):
    (tmp_path / "part-0").write_bytes(b"abc")
    with pytest.raises(Exception, match="not whole ids"):
        token_counts(spark, str(tmp_path)).collect()


def test_round_trip(spark, table, tmp_path):
    texts = ["one two", None, "", "x <|endoftext|> y", "é" * 30_000, "one two", "PÄ \n"]
    docs = table("doc_id long, text string", *enumerate(texts)).coalesce(1)
    write_flat(docs.selectExpr("doc_id", "coalesce(text, '') AS text"), f"{tmp_path}/flat")
    exact = Tokenizer.from_file(default_vocabulary()[0])
    exact.encode_special_tokens = True
    out = sorted(token_counts(spark, f"{tmp_path}/flat").collect(), key=lambda r: r.document)
    want = [len(exact.encode(t or "", add_special_tokens=False).ids) for t in texts]
    assert [r.n_tokens for r in out] == want and all(r.closed for r in out)
    assert [r.start for r in out] == np.cumsum([0, *(w + 1 for w in want[:-1])]).tolist()


def test_query(spark):
    exact = Tokenizer.from_file(default_vocabulary()[0])
    texts = [r.text or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    out = op2_token_counts(spark, SF_DIR).collect()
    assert Counter(r.n_tokens for r in out) == Counter(len(exact.encode(t, add_special_tokens=False).ids) for t in texts)
    assert len(set((r.file, r.document) for r in out)) == len(texts)
