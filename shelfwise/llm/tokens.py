"""Token ids of texts by a byte-level BPE vocabulary given as files."""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import public_tokenizers

END_OF_TEXT = "<|endoftext|>"


class Tokenizer:
    """The ids ``tokenizers`` gives for ``vocabulary``, made by the faster ``tiktoken`` from ``ranks``.

    Both files hold the same vocabulary. A text that contains the name of the special token is
    left to ``tokenizers``, which by default reads it as that token.
    """

    def __init__(self, vocabulary: str, ranks: str):
        import tiktoken

        self.vocabulary = vocabulary
        with open(ranks, "rb") as lines:
            self.bytes_of = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self._fast = tiktoken.Encoding(
            "byte-level", pat_str=public_tokenizers.PATTERN, mergeable_ranks=self.bytes_of, special_tokens={}
        )
        self._exact = None

    def ids(self, text: str, special: bool = True) -> np.ndarray:
        """Ids of one text. Without ``special`` the special token's name is ordinary text."""
        if special and END_OF_TEXT in text:
            if self._exact is None:
                from tokenizers import Tokenizer as Exact

                self._exact = Exact.from_file(self.vocabulary)
            return np.array(self._exact.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
        return self._fast.encode_to_numpy(text, allowed_special=set(), disallowed_special=())

    def ends_of_sentences(self) -> np.ndarray:
        """For each id, whether its bytes end a sentence or a line."""
        flags = np.zeros(max(self.bytes_of.values()) + 2, dtype=bool)
        for token, number in self.bytes_of.items():
            flags[number] = token.endswith((b".", b"!", b"?", b"\n"))
        return flags


@lru_cache(maxsize=2)
def tokenizer(vocabulary: str, ranks: str) -> Tokenizer:
    """One per Python worker, loaded when the first text comes."""
    return Tokenizer(vocabulary, ranks)


def default_vocabulary() -> tuple[str, str]:
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
