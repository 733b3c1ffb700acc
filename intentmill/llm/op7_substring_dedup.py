"""Substring dedup: a count-min sketch first, exact grouping of what it leaves.

A window is 20 words in a row. Each window is counted through its anchor, the smallest
hash of the 6-word grams inside it (the last of equal ones): equal windows have equal
anchors, so an anchor's count is never below a window's. Anchors are a seventh of the
windows and are all that the first pass shuffles. They are dealt by hash to shards whose
number grows with the input; in a shard, sketches of the parts that each partition sent
are merged, and anchors estimated to occur twice or more are reported to their documents.
No window that repeats can be missed. The second pass hashes (96 bits) only the windows
of reported anchors, groups them exactly, and marks all but the first in order of
document and place. A third step removes the words that marked windows cover.

Frequent windows do not gather: each batch of documents decides what repeats inside it
and sends one entry for each anchor or window, so a group has at most one row a batch.
Texts are shuffled once, by a hash of the row; both joins use that exchange.

A NULL text has no words. A NULL id comes before all others; rows that share an id are
ordered by a hash of the row; rows with equal id and text are one document for the
search, and each gets the result. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from intentmill.llm.common import texts
from intentmill.llm.hashing import WordHashes, mixed, runs

_ANCHOR = np.dtype([("row", "<i8"), ("at", "<i4"), ("gram", "<u8")])
_WINDOW = np.dtype([("hash", "<u8"), ("more", "<u4"), ("doc", "<i8"), ("row", "<i8"), ("at", "<i4")])
_PLACE = np.dtype([("row", "<i8"), ("at", "<i4")])
_FIRST_ID = -(2**63)


class CountMin:
    """A sketch whose estimates are never below the true counts."""

    def __init__(self, width_bits: int, depth: int = 2):
        self.bits = width_bits
        self.counts = np.zeros((depth, 1 << width_bits), np.uint32)

    def _cells(self, keys: np.ndarray) -> Iterator[np.ndarray]:
        for row in range(len(self.counts)):
            yield (mixed(keys + np.uint64(row + 1)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def add(self, keys: np.ndarray) -> None:
        for counts, cells in zip(self.counts, self._cells(keys)):
            np.add.at(counts, cells, 1)

    def merge(self, other: CountMin) -> None:
        self.counts += other.counts

    def estimate(self, keys: np.ndarray) -> np.ndarray:
        return np.min([counts[cells] for counts, cells in zip(self.counts, self._cells(keys))], axis=0)


def _smallest(grams: np.ndarray, width: int) -> np.ndarray:
    """Place of the smallest of every `width` grams in a row, the last of equal ones."""
    at = np.arange(len(grams))
    span = 1
    while span < width:
        step = min(span, width - span)
        left, right = at[: len(at) - step], at[step:]
        at = np.where(grams[left] < grams[right], left, right)
        span += step
    return at


class _Anchors:
    """Words, their hashes and each window's anchor, for one text after another."""

    def __init__(self, window: int, k: int):
        self.window, self.k = window, k
        self.hashes = WordHashes()

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        """Hashes of words, hashes of grams, gram of each window; None without a window."""
        words = text.encode().split()  # at ASCII white space
        if len(words) < self.window:
            return None
        hashes = self.hashes(words)
        grams = runs(hashes, self.k, 0)
        return hashes, grams, _smallest(grams, self.window - self.k + 1)


def _dealt(shards: np.ndarray, entries: np.ndarray, kind: int) -> Iterator[tuple[int, int, bytes]]:
    """The entries of each shard as one row."""
    order = np.argsort(shards, kind="stable")
    shards, entries = shards[order], entries[order]
    cuts = np.flatnonzero(np.diff(shards)) + 1
    if len(entries):
        for shard, part in zip(shards[np.r_[0, cuts]], np.split(entries, cuts)):
            yield int(shard), kind, part.tobytes()


def _to_buckets(places: np.ndarray, buckets: int) -> pd.DataFrame:
    """Places for each bucket of documents, so that rows do not follow shards times documents."""
    rows = list(_dealt(places["row"] % buckets, places, 0))
    return pd.DataFrame({"bucket": [r[0] for r in rows], "entries": [r[2] for r in rows]}).astype(
        {"bucket": "int64", "entries": object}
    )


def _by_row(bucket: pd.DataFrame) -> pd.DataFrame:
    """One line for each document of a bucket: its places as bytes."""
    places = np.unique(_joined([np.frombuffer(x, _PLACE) for x in bucket["entries"]], _PLACE))
    cuts = np.flatnonzero(np.diff(places["row"])) + 1
    parts = np.split(places, cuts) if len(places) else []
    return pd.DataFrame(
        {"row": [int(p["row"][0]) for p in parts], "places": [p["at"].tobytes() for p in parts]}
    ).astype({"row": "int64", "places": object})


def _read(group: pd.DataFrame, kind: int, dtype: np.dtype) -> list[np.ndarray]:
    return [np.frombuffer(x, dtype) for x in group.loc[group["kind"] == kind, "entries"]]


def _joined(parts: list[np.ndarray], dtype: np.dtype) -> np.ndarray:
    return np.concatenate(parts) if parts else np.empty(0, dtype)


_ROWS = "shard long, kind int, entries binary"


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    shard, kind, entries = list(zip(*rows)) or [(), (), ()]
    return pa.RecordBatch.from_arrays(
        [pa.array(shard, pa.int64()), pa.array(kind, pa.int32()), pa.array(entries, pa.binary())],
        names=["shard", "kind", "entries"],
    )


def _send_anchors(window: int, k: int, shards: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = _Anchors(window, k)
        for batch in batches:
            rows, found = batch.column("row").to_pylist(), []
            for row, text in zip(rows, batch.column("text")):
                if (cut := anchors(text.as_py())) is not None:
                    _, grams, smallest = cut
                    at = smallest[np.r_[True, np.diff(smallest) != 0]]
                    part = np.empty(len(at), _ANCHOR)
                    part["row"], part["at"], part["gram"] = row, at, grams[at]
                    found.append(part)
            all_ = _joined(found, _ANCHOR)
            _, first, back, count = np.unique(all_["gram"], return_index=True, return_inverse=True, return_counts=True)
            told = all_[count[back] > 1]
            places = np.empty(len(told), _PLACE)
            places["row"], places["at"] = told["row"], told["at"]
            one = all_[first]
            yield _batch(
                [*_dealt((one["gram"] % np.uint64(shards)).astype(np.int64), one, 0), *_dealt(places["row"] % shards, places, 1)]
            )

    return send


def _report(buckets: int):
    def report(group: pd.DataFrame) -> pd.DataFrame:
        """Places of the anchors that a shard's sketch counts twice or more."""
        parts = _read(group, 0, _ANCHOR)
        merged = CountMin(max(10, (8 * sum(map(len, parts))).bit_length()))
        for part in parts:  # what one batch sent; within it each anchor is new
            merged.add(part["gram"])
        repeated = [part[merged.estimate(part["gram"]) > 1][["row", "at"]].astype(_PLACE) for part in parts]
        return _to_buckets(_joined([*repeated, *_read(group, 1, _PLACE)], _PLACE), buckets)

    return report


def _send_windows(window: int, k: int, shards: int):
    base = np.uint64(0x9E3779B97F4A7C15)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = _Anchors(window, k)
        powers = np.ones(1, np.uint64)
        inverse = np.uint64(pow(int(base), -1, 1 << 64))
        for batch in batches:
            found = []
            columns = [batch.column(c).to_pylist() for c in ("doc_id", "row", "places")]
            for doc_id, row, places, text in zip(*columns, batch.column("text")):
                hashes, _, smallest = anchors(text.as_py())
                starts = np.flatnonzero(np.isin(smallest, np.frombuffer(places, "<i4")))
                if len(powers) < len(hashes):
                    powers = np.cumprod(np.r_[np.uint64(1), np.full(2 * len(hashes), base)], dtype=np.uint64)
                    back = np.cumprod(np.r_[np.uint64(1), np.full(2 * len(hashes), inverse)], dtype=np.uint64)
                part = np.empty(len(starts), _WINDOW)
                for name, values in (("hash", hashes), ("more", mixed(hashes))):
                    sums = np.r_[np.uint64(0), np.cumsum(values * powers[: len(values)], dtype=np.uint64)]
                    rolled = mixed((sums[starts + window] - sums[starts]) * back[starts])
                    part[name] = rolled if name == "hash" else rolled >> np.uint64(32)
                part["doc"], part["row"], part["at"] = _FIRST_ID if doc_id is None else doc_id, row, starts
                found.append(part)
            first, later = _first_of_each(_joined(found, _WINDOW))
            yield _batch(
                [*_dealt((first["hash"] % np.uint64(shards)).astype(np.int64), first, 0), *_dealt(later["row"] % shards, later, 1)]
            )

    return send


def _first_of_each(windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first occurrence of each window, and the places of the others."""
    windows = np.sort(windows, order=["hash", "more", "doc", "row", "at"])
    new = np.ones(len(windows), bool)
    new[1:] = (windows["hash"][1:] != windows["hash"][:-1]) | (windows["more"][1:] != windows["more"][:-1])
    lead = windows[np.flatnonzero(new)[np.cumsum(new) - 1]] if len(windows) else windows
    same = (windows["row"] == lead["row"]) & (windows["at"] == lead["at"])  # a row that comes twice
    places = np.empty((~same).sum(), _PLACE)
    places["row"], places["at"] = windows["row"][~same], windows["at"][~same]
    return windows[new], places


def _mark(buckets: int):
    def mark(group: pd.DataFrame) -> pd.DataFrame:
        """Places of all windows of a shard that are not the first of their kind."""
        _, later = _first_of_each(_joined(_read(group, 0, _WINDOW), _WINDOW))
        return _to_buckets(_joined([later, *_read(group, 1, _PLACE)], _PLACE), buckets)

    return mark


def _kept(window: int):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, kept_text = [], [], []
            for text, places in zip(batch.column("text"), batch.column("places").to_pylist()):
                words = text.as_py().encode().split()
                n_words.append(len(words))
                if places:
                    starts = np.frombuffer(places, "<i4")
                    step = np.zeros(len(words) + 1, np.int64)
                    step[starts] += 1
                    step[starts + window] -= 1
                    words = [words[i] for i in np.flatnonzero(np.cumsum(step[:-1]) == 0)]
                n_removed.append(n_words[-1] - len(words))
                kept_text.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                    pa.array(kept_text, pa.binary()),
                ],
                names=["doc_id", "n_words", "n_removed", "kept"],
            )

    return keep


def remove_repeats(docs: DataFrame, window: int = 20, k: int = 6, shard_bytes: int = 16 << 20) -> DataFrame:
    """Per row: doc_id, n_words, n_removed and kept, the words left, joined by one space."""
    rows = texts(docs).withColumn("row", F.xxhash64(F.coalesce("doc_id", F.lit(_FIRST_ID)), "text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-size // shard_bytes))

    def gathered(sent: DataFrame, decide) -> DataFrame:
        """What shards decide about places, as a row for each document."""
        decided = sent.groupBy("shard").applyInPandas(decide(shards), "bucket long, entries binary")
        return decided.groupBy("bucket").applyInPandas(_by_row, "row long, places binary")

    repeated = gathered(rows.select("row", "text").mapInArrow(_send_anchors(window, k, shards), _ROWS), _report)
    asked = rows.join(repeated, "row").select("doc_id", "row", "places", "text")
    marked = gathered(asked.mapInArrow(_send_windows(window, k, shards), _ROWS), _mark)
    return rows.join(marked, "row", "left").select("doc_id", "text", "places").mapInArrow(
        _kept(window), "doc_id long, n_words long, n_removed long, kept binary"
    )


def digests(kept: DataFrame) -> DataFrame:
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
