"""Token counts: lengths alone, encoded in batches of even bytes.

Arrow batches of texts are cut anew into batches of about the same number of
characters. A text is split where one space stands between two characters that are not
white space: the byte-level pre-tokenizer starts a token there whatever follows, so the
pieces' counts add up to the text's. Each distinct piece of a batch that the worker has
not met is encoded by the tokenizer in one call; only lengths are kept. A text without
such a boundary is encoded whole.

A NULL text counts as empty: no bytes, no tokens. Repeated rows are counted each; an
empty table gives an empty result.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from intentmill.llm.common import texts

_BOUNDARY = re.compile(r"(?<=\S) (?=\S)")
_IRREGULAR = re.compile(r"\s\s|^\s|\s\Z")

_LENGTHS: dict[str, dict[str, int]] = {}  # by tokenizer file; outlives a task in its worker


def split_safely(text: str) -> list[str]:
    """Pieces between the spaces at which a text may be cut; each but the first lost one space."""
    return _BOUNDARY.split(text) if _IRREGULAR.search(text) else text.split(" ")


def _even(sizes: Iterable[tuple[str, int]], most: int) -> Iterator[list[str]]:
    """Groups of items of about `most` in all."""
    group, total = [], 0
    for item, size in sizes:
        group.append(item)
        total += size
        if total >= most:
            yield group
            group, total = [], 0
    if group:
        yield group


class Counter:
    """Counts tokens with a tokenizer file, remembering the lengths of pieces."""

    def __init__(self, path: str, batch_chars: int, remembered: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known = _LENGTHS.setdefault(path, {})
        self.batch_chars, self.remembered = batch_chars, remembered

    def lengths(self, pieces: list[str]) -> Iterator[int]:
        for batch in _even(((p, len(p) + 8) for p in pieces), self.batch_chars):
            yield from map(len, self.tokenizer.encode_batch_fast(batch, add_special_tokens=False))

    def __call__(self, batch: list[str]) -> list[int]:
        cut = [split_safely(t) for t in batch]
        heads = dict.fromkeys(words[0] for words in cut)
        heads = dict(zip(heads, self.lengths(list(heads))))
        if len(self.known) > self.remembered:
            self.known.clear()
        new = set()
        for words in cut:
            new.update(words[1:])
        new = list(new.difference(self.known))
        self.known.update(zip(new, self.lengths([" " + w for w in new])))
        known = self.known.__getitem__
        return [heads[words[0]] + sum(map(known, words[1:])) for words in cut]


def count_tokens(
    docs: DataFrame, tokenizer: str, limit: int = 512, batch_chars: int = 1 << 20, remembered: int = 1_000_000
) -> DataFrame:
    """Per row: doc_id, n_bytes, n_tokens, over_limit.

    `tokenizer` is the path of a byte-level tokenizer file, the same on every executor;
    `remembered` bounds the pieces whose lengths a worker keeps.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(tokenizer, batch_chars, remembered)
        for batch in batches:
            rows = batch.column("text").to_pylist()
            n_tokens = []
            for group in _even(((t, len(t) + 1) for t in rows), batch_chars):
                n_tokens += counter(group)
            n_bytes = [len(t) if t.isascii() else len(t.encode()) for t in rows]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64()),
                    pa.array([n > limit for n in n_tokens], pa.bool_()),
                ],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return texts(docs).mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
