"""Packing documents into training sequences of a fixed size, in order, with few cuts.

The documents of a partition form one stream of tokens. Dynamic programming chooses where a
sequence ends: at the end of a document (free), at the end of a sentence, or, inside very
long sentences, at every ``STEP`` tokens, for a penalty. It minimises padding and penalties
together; the best start of a sequence among the last ``size`` tokens is kept in a monotone
queue, so the work grows with the tokens. Each partition is planned in its own task, block
by block, so nothing is shuffled and a lost task repeats with the same result.

A missing text is empty and gives one piece with the end id alone. Repeated rows are packed
each. Ids may be missing. An empty table gives an empty result. Other columns do not matter.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from shelfwise.llm.tables import ids_and_texts
from shelfwise.llm.tokens import default_vocabulary, tokenizer

SIZE = 2048
END_ID = 1
# what a cut costs, in tokens of padding
SENTENCE_CUT = 8
HARD_CUT = 24
STEP = 32
# tokens planned together; more would only save the slack of one sequence in each block
BLOCK = 1 << 18

PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
_SCHEMA = pa.schema(
    [(n, pa.int64()) for n in ("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset")] + [("ids", pa.binary())]
)


def boundaries(ends: np.ndarray, sentence_ends: np.ndarray, step: int = STEP) -> tuple[np.ndarray, np.ndarray]:
    """Places where the stream may be cut, from 0 on, and the penalty of each.

    ``ends`` and ``sentence_ends`` are the places after documents and after sentences.
    """
    places = np.unique(np.concatenate([[0], sentence_ends, ends]))
    gaps = np.diff(places)
    # a gap of g tokens gets a hard place after each step that is not at its end
    more = np.maximum((gaps - 1) // step, 0)
    within = np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more)
    hard = np.repeat(places[:-1], more) + (within + 1) * step
    every = np.concatenate([places, hard])
    order = np.argsort(every, kind="stable")
    penalties = np.concatenate([np.full(len(places), SENTENCE_CUT), np.full(len(hard), HARD_CUT)])[order]
    every = every[order]
    penalties[np.searchsorted(every, ends)] = 0
    return every, penalties


def plan_cuts(places: np.ndarray, penalties: np.ndarray, size: int = SIZE, last: bool = False) -> np.ndarray:
    """The places of a cheapest partition into sequences of at most ``size``, both ends included.

    cost(j) = penalty(j) + size + min cost(i) over places i within ``size`` before j: padding
    and tokens together are ``size`` per sequence, so fewest sequences is least padding. The
    ``last`` sequence of a partition may be split further and costs what ``split_tail`` leaves.
    """
    at, fine = places.tolist(), penalties.tolist()
    cost, came = [0] * len(at), [0] * len(at)
    queue: deque[int] = deque([0])
    for j in range(1, len(at)):
        reach = at[j] - size
        while at[queue[0]] < reach:
            queue.popleft()
        came[j] = queue[0]
        own = cost[j] = fine[j] + size + cost[queue[0]]
        # of equal costs the earlier place leaves first, so the later one is worth keeping
        while queue and cost[queue[-1]] >= own:
            queue.pop()
        queue.append(j)
    if last:
        near = range(int(np.searchsorted(places, at[-1] - size)), len(at) - 1)
        came[-1] = min(near, key=lambda i: cost[i] + _tail(at[-1] - at[i], size)[0])
    cuts = [len(at) - 1]
    while cuts[-1]:
        cuts.append(came[cuts[-1]])
    return places[cuts[::-1]]


def _tail(length: int, size: int) -> tuple[int, list[int]]:
    """Tokens, padding and penalties of a last sequence split at powers of two, and the parts.

    A sequence as long as a power of two needs no padding; each split is a hard cut.
    """
    parts = [1 << b for b in range(length.bit_length() - 1, -1, -1) if length >> b & 1]
    choices = []
    for split in range(len(parts)):
        rest = sum(parts[split:])
        padding = size - rest if split < len(parts) - 1 else 0
        choices.append((length + split * HARD_CUT + padding, parts[:split] + [rest]))
    return min(choices)


def split_tail(length: int, size: int = SIZE) -> list[int]:
    """Lengths a last sequence is split into."""
    return _tail(length, size)[1]


class _Stream:
    """The tokens of a partition, planned block by block."""

    def __init__(self, size: int, block: int, first_sequence: int):
        self.size, self.block, self.sequence = size, block, first_sequence
        self.ids: list[np.ndarray] = []
        self.docs: list[tuple] = []  # doc_id, tokens already given out, tokens in all
        self.held = 0

    def add(self, doc_id, ids: np.ndarray) -> None:
        self.ids.append(ids)
        self.docs.append((doc_id, 0, len(ids)))
        self.held += len(ids)

    def pieces(self, ends_sentence: np.ndarray, last: bool) -> pa.RecordBatch | None:
        """Pieces of the sequences that are settled; but for ``last`` the final two are planned again."""
        if not self.docs:
            return None
        ids = np.concatenate(self.ids)
        lengths = np.array([total - given for _, given, total in self.docs])
        ends = np.cumsum(lengths)
        cuts = plan_cuts(*boundaries(ends, np.flatnonzero(ends_sentence[ids]) + 1), self.size, last)
        if last:
            tail = split_tail(int(cuts[-1] - cuts[-2]), self.size)
            cuts = np.concatenate([cuts[:-2], cuts[-2] + np.cumsum([0, *tail])])
        else:
            cuts = cuts[:-2]
            if len(cuts) < 2:
                return None
        settled = int(cuts[-1])
        starts = ends - lengths
        edges = np.unique(np.concatenate([cuts, starts[starts < settled]]))
        doc = np.searchsorted(starts, edges[:-1], side="right") - 1
        row = np.searchsorted(cuts, edges[:-1], side="right") - 1
        given = np.array([g for _, g, _ in self.docs])
        raw = ids[:settled].astype("<u4", copy=False).tobytes()
        batch = pa.RecordBatch.from_arrays(
            [
                pa.array([d for d, _, _ in self.docs], pa.int64()).take(pa.array(doc)),
                pa.array(given[doc] + edges[:-1] - starts[doc]),
                pa.array(np.diff(edges)),
                pa.array(np.array([t for _, _, t in self.docs])[doc]),
                pa.array(self.sequence + row),
                pa.array(edges[:-1] - cuts[row]),
                pa.Array.from_buffers(pa.binary(), len(doc), [None, pa.py_buffer((edges * 4).astype("<i4")), pa.py_buffer(raw)]),
            ],
            schema=_SCHEMA,
        )
        self.sequence += len(cuts) - 1
        self._keep(ids, starts, ends, settled)
        return batch

    def _keep(self, ids, starts, ends, settled: int) -> None:
        left = int(np.searchsorted(ends, settled, side="right"))
        docs = self.docs[left:]
        if docs and starts[left] < settled:
            doc_id, given, total = docs[0]
            docs[0] = (doc_id, given + settled - int(starts[left]), total)
        self.docs, self.held = docs, len(ids) - settled
        self.ids = [ids[settled:].copy()]


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SIZE,
    end_id: int = END_ID,
    block: int = BLOCK,
    vocabulary: tuple[str, str] | None = None,
) -> DataFrame:
    """Pieces of documents with their place in sequences: the columns of ``PIECES``.

    ``ids`` are the piece's token ids as little-endian unsigned 32-bit numbers; the pieces of
    a sequence, by offset, are the sequence. Sequence ids are unique and grow along a partition.
    """
    files = vocabulary or default_vocabulary()

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = tokenizer(*files)
        ends_sentence = words.ends_of_sentences()
        stream = _Stream(size, block, TaskContext.get().partitionId() << 33)
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                stream.add(doc_id.as_py(), np.append(words.ids(text.as_py()), np.uint32(end_id)))
                if stream.held >= stream.block:
                    piece = stream.pieces(ends_sentence, last=False)
                    if piece is not None:
                        yield piece
        piece = stream.pieces(ends_sentence, last=True)
        if piece is not None:
            yield piece

    return ids_and_texts(docs, id_col, text_col).mapInArrow(packed, PIECES)
