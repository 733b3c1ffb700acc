"""Packing: window cuts by order-preserving dynamic programming.

A task's documents, in the order read, form one stream of tokens. Cuts may fall at the
end of a document (free), at the end of a sentence (a small penalty) and, in stretches
without either, at every 32nd of a window (a larger one). The cuts that minimise padding plus
penalties follow from f(j) = c(j) + min over i of f(i) + capacity - (p(j) - p(i)): the
minimum slides over a window and is kept in a monotone queue, so a block of n possible
cuts takes n steps. Windows whose length is a power of two need no padding; they are
further transitions.

The stream is solved in blocks; the last windows of a block are solved again with the
next one, so memory is bounded by a block and the longest document. No shuffle is
needed: sequence ids carry the task's partition number. Word ids are looked up by word:
the tokenizer never joins what white space parts.

A NULL text counts as empty; an empty document is its end token alone. Rows are packed
each, repeated ones too. An empty table gives no pieces.
"""

from __future__ import annotations

import os
import re
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from intentmill.llm.common import texts, trimmed

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,]?)")
_IDS: dict[str, dict[str, bytes]] = {}  # by tokenizer file; outlives a task in its worker


class WordIds:
    """A text's ids as little-endian 32-bit bytes, put together from its words' ids."""

    def __init__(self, path: str, remembered: int = 1_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known = _IDS.setdefault(path, {})
        self.remembered = remembered
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = iter(range(256, 512))  # how byte-level alphabets write the remaining bytes
        self.letter = {b: chr(b) if b in printable else chr(next(other)) for b in range(256)}

    def _run(self, letters: str) -> list[int]:
        """Ids of a run that the pre-tokenizer keeps together."""
        if not letters.isascii():
            letters = "".join(map(self.letter.__getitem__, letters.encode()))
        return [t.id for t in self.tokenizer.model.tokenize(letters)]

    def _word(self, word: str) -> bytes:
        plain = _PLAIN.fullmatch(word)
        if plain:  # letters and a mark: two runs, nothing to normalise but case
            ids = self._run(plain[1].lower()) + (self._run(plain[2]) if plain[2] else [])
        else:
            ids = self.tokenizer.encode(word, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def __call__(self, text: str) -> bytes:
        words = text.replace("\n", " ").split(" ")
        known = self.known
        for word in set(words).difference(known):
            known[word] = self._word(word)
        ids = b"".join(map(known.__getitem__, words))
        if len(known) > self.remembered:
            known.clear()
        return ids

    def sentence_ends(self) -> np.ndarray:
        """By id, whether a sentence may end with it."""
        vocab = self.tokenizer.get_vocab()
        ends = np.zeros(max(vocab.values()) + 1, bool)
        for token, i in vocab.items():
            ends[i] = token.removesuffix("</w>").endswith((".", "!", "?"))
        return ends


def cuts(
    at: list[int], cost: list[float], capacity: int, unpadded: tuple[int, ...] = ()
) -> list[int]:
    """Indices of the cuts that minimise padding plus penalties.

    `at` holds rising positions, first the start, last the end, none further than
    `capacity` from the next; `cost` the penalty of a cut at each.
    """
    best, before, index = [0.0] * len(at), [0] * len(at), {at[0]: 0}
    queue: deque[int] = deque([0])  # indices with rising best + position
    for j in range(1, len(at)):
        p = at[j]
        while at[queue[0]] < p - capacity:
            queue.popleft()
        i = queue[0]
        value, of = best[i] + at[i] + capacity - p, i
        for length in unpadded:
            i = index.get(p - length)
            if i is not None and best[i] < value:
                value, of = best[i], i
        best[j], before[j] = value + cost[j], of
        index[p] = j
        rank = best[j] + p
        while queue and best[queue[-1]] + at[queue[-1]] >= rank:
            queue.pop()
        queue.append(j)
    chosen, j = [], len(at) - 1
    while j:
        chosen.append(j)
        j = before[j]
    return chosen[::-1]


class Packer:
    """Collects documents, solves blocks, yields pieces."""

    def __init__(self, capacity: int, ends: np.ndarray, sentence_cost: float, forced_cost: float, first_id: int):
        self.capacity, self.ends = capacity, ends
        self.sentence_cost, self.forced_cost = sentence_cost, forced_cost
        self.unpadded = tuple(1 << k for k in range(8, capacity.bit_length()) if 1 << k < capacity)
        self.sequence = first_id
        self.docs: list[tuple[int | None, bytes, int]] = []  # id, ids, tokens already placed
        self.tokens = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.docs.append((doc_id, ids, 0))
        self.tokens += len(ids) // 4

    def _nodes(self) -> tuple[list[int], list[float]]:
        at, cost, base = [0], [0.0], 0
        for _, ids, placed in self.docs:
            tokens = np.frombuffer(ids, "<u4")[placed:]
            inner = np.flatnonzero(self.ends[tokens[:-1]]) + 1
            inner = inner[inner < len(tokens)]
            steps = np.diff(np.concatenate([[0], inner, [len(tokens)]]))
            marks = inner.tolist()
            costs = [self.sentence_cost] * len(marks)
            every = max(1, self.capacity // 32)
            if steps.max() > 2 * every:  # a long stretch without a boundary may be cut anywhere near
                full, last = {}, 0
                for mark in [*marks, len(tokens)]:
                    if mark - last > 2 * every:
                        full.update(dict.fromkeys(range(last + every, mark, every), self.forced_cost))
                    full[mark], last = self.sentence_cost, mark
                full.pop(len(tokens))
                marks, costs = list(full), list(full.values())
            at += [base + m for m in marks]
            cost += costs
            base += len(tokens)
            at.append(base)
            cost.append(0.0)
        return at, cost

    def solve(self, last: bool) -> Iterator[tuple]:
        """Pieces of the block's windows; unless it is the last, of all but its last four."""
        if not self.docs:
            return
        at, cost = self._nodes()
        chosen = cuts(at, cost, self.capacity, self.unpadded)
        if not last:
            chosen = chosen[:-4]
        k, begin = 0, 0  # document, position of its first open token
        low = 0
        for j in chosen:
            high, offset = at[j], 0
            while low < high:
                doc_id, ids, placed = self.docs[k]
                total = len(ids) // 4
                take = min(high - low, total - placed)
                piece = ids[4 * placed : 4 * (placed + take)]
                yield doc_id, placed, take, zlib.crc32(piece), total, self.sequence, offset
                offset += take
                low += take
                self.docs[k] = (doc_id, ids, placed + take)
                k += placed + take == total
            self.sequence += 1
        self.docs = self.docs[k:]
        self.tokens = sum(len(ids) // 4 - placed for _, ids, placed in self.docs)


def pack(
    docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 1, sentence_cost: float = 4.0,
    forced_cost: float = 16.0, block_tokens: int = 1_000_000,
) -> DataFrame:
    """Pieces of documents in sequences of at most `capacity` tokens.

    `tokenizer` is the path of a tokenizer file of words, the same on every executor; a
    document's ids end with `end_id`. Costs are counted in padding tokens.
    """
    end = np.array([end_id], "<u4").tobytes()
    names = [f.split()[0] for f in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = WordIds(tokenizer)
        first = TaskContext.get().partitionId() << 36
        packer = Packer(capacity, encode.sentence_ends(), sentence_cost, forced_cost, first)

        def rows(last: bool) -> pa.RecordBatch:
            columns = list(zip(*packer.solve(last))) or [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                packer.add(doc_id, encode(text.as_py()) + end)
                if packer.tokens >= block_tokens:
                    yield rows(False)
        yield rows(True)

    return texts(docs).mapInArrow(trimmed(run), SCHEMA)
