"""Collocations of two and three words: best-first growth under score bounds.

A phrase of `a` occurrences, cut into a first part of `l` and a rest of `r` occurrences, scores
a * a / (l * r), at its worst cut. Words and pairs are counted in one pass over the texts. Three
words xyz score at most f(xy) / f(x), as they occur no more often than xy and yz, and likewise at most
f(yz) / f(z); so counts of the first two, or last two, words bound what can grow from them.

The growth is best first. The frontier of a round, per language, is what may reach the score of
that language's k-th best pair: triples of which both bounds do, and triples around a pair that
scores as much, as they decide whether the pair is dropped. Only these are counted, in one pass.
Then every phrase of at least that score is known, with its fate. A language that has its `top`
survivors there is settled, ties included, since all that is left scores less; for others the
next round reaches deeper (k grows `deeper` times), in the end to all triples. What was counted
before is not counted again.

Tasks learn the frontier from bitmaps of bounded size, made from hashes of pairs. A pair
more by accident only means triples counted beyond need, in every task alike, so counts are
exact. Tasks count runs of words as numbers, over `flush_words` words at a time, before
anything is shuffled, so a hot language or phrase costs a row a run.

A NULL lang is `und`, a NULL text empty. Repeated rows count each. Pieces without words, empty
texts and an empty table give nothing; phrases of equal score go by count, then by bytes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from intentmill.llm.common import stored
from intentmill.llm.hashing import mixed

_BREAK = b"\xff"  # a byte that UTF-8 never has
_MAP = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\n\v\f\r", b"abcdefghijklmnopqrstuvwxyz " + _BREAK * 10)
_BITS = 21  # of a word's number inside a run of three
_MILLION = 1_000_000
COUNTS = "lang string, words int, phrase string, n long"


# --- counting in tasks ---


class _Words:
    """Numbers and hashes of words; number 0 is a break between pieces."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.known: dict[bytes, int] = {_BREAK: 0}
        self.hashes = np.zeros(1 << 12, np.uint64)
        self.size = 0

    def __call__(self, text: bytes) -> np.ndarray:
        words = text.translate(_MAP).replace(_BREAK, b" \xff ").split()
        known = self.known
        for word in set(words).difference(known):
            if len(known) == len(self.hashes):
                self.hashes = np.r_[self.hashes, np.zeros(len(known), np.uint64)]
            self.hashes[len(known)] = xxhash.xxh3_64_intdigest(word)
            known[word] = len(known)
            self.size += len(word) + 100
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))

    def names(self) -> pa.Array:
        return pa.array(list(self.known), pa.binary())


def _pair_hash(lang: int, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mixed(first * np.uint64(0x9E3779B97F4A7C15) + mixed(second + np.uint64(lang)))


def _lang_hash(lang: str) -> int:
    return xxhash.xxh3_64_intdigest(lang.encode())


def _has(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the bits of the hashes are set; the bitmap has a power of two of bytes."""
    slot = hashes >> np.uint64(64 - (len(bitmap).bit_length() + 2))
    return bitmap[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8) & 1 != 0


class Frontier:
    """The triples of a round, told by the bitmaps of their pairs."""

    def __init__(self, left: np.ndarray, right: np.ndarray, sure: np.ndarray):
        self.left, self.right, self.sure = left, right, sure

    def __call__(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Whether triples with these hashes of their first and last pairs are in it."""
        grown = _has(self.left, first) & _has(self.right, second)
        return grown | _has(self.sure, first) | _has(self.sure, second)


class _Runs:
    """Counts of words and pairs, or of a frontier's triples, over a bounded number of words."""

    def __init__(self, frontiers: list[Frontier]):
        self.frontiers = frontiers  # the last one is wanted, those before are done
        self.words = _Words()
        self.clear()

    def clear(self) -> None:
        self.codes: dict[str, list[np.ndarray]] = {}
        self.single: dict[str, list[np.ndarray]] = {}
        self.held = 0

    def add(self, lang: str, text: bytes) -> None:
        ids = self.words(text)
        self.held += len(ids)
        if not self.frontiers:
            self.single.setdefault(lang, []).append(ids[ids > 0])
            together = (ids[:-1] > 0) & (ids[1:] > 0)
            codes = (ids[:-1] << _BITS | ids[1:])[together]
        else:
            at = np.flatnonzero((ids[:-2] > 0) & (ids[1:-1] > 0) & (ids[2:] > 0)) if len(ids) > 2 else np.zeros(0, np.int64)
            hashes = self.words.hashes[ids]
            pairs = _pair_hash(_lang_hash(lang), hashes[:-1], hashes[1:])
            first, second = pairs[at], pairs[at + 1]
            wanted = self.frontiers[-1](first, second)
            for before in self.frontiers[:-1]:
                wanted &= ~before(first, second)
            at = at[wanted]
            codes = (ids[at] << _BITS | ids[at + 1]) << _BITS | ids[at + 2]
        self.codes.setdefault(lang, []).append(codes)

    def _rows(self, lang: str, codes: np.ndarray, words: int, names: pa.Array) -> Iterator[pa.RecordBatch]:
        found, counts = np.unique(codes, return_counts=True)
        for at in range(0, len(found), 1 << 16):
            part = found[at : at + (1 << 16)]
            parts = [names.take(pa.array(part >> (_BITS * k) & ((1 << _BITS) - 1))) for k in reversed(range(words))]
            phrase = pc.binary_join_element_wise(*parts, b" ") if words > 1 else parts[0]
            n = counts[at : at + (1 << 16)]
            yield self._batch([lang] * len(part), [words] * len(part), phrase.cast(pa.string()), n)

    @staticmethod
    def _batch(langs, words, phrases, n) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(words, pa.int32()), phrases, pa.array(n, pa.int64())],
            names=["lang", "words", "phrase", "n"],
        )

    def flush(self) -> Iterator[pa.RecordBatch]:
        names = self.words.names()
        for lang, ids in self.single.items():
            ids = np.concatenate(ids)
            yield self._batch([lang], [0], pa.array([""]), [len(ids)])  # all words of the language
            yield from self._rows(lang, ids, 1, names)
        for lang, codes in self.codes.items():
            yield from self._rows(lang, np.concatenate(codes), 3 if self.frontiers else 2, names)
        self.clear()
        if self.words.size > 1 << 25 or len(self.words.known) > 1 << (_BITS - 1):
            self.words.clear()


def _counter(frontiers: list[Frontier], flush_words: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = _Runs(frontiers)
        for batch in batches:
            by_lang: dict[str, list[bytes]] = {}
            held = 0

            def pour():
                for lang, texts in by_lang.items():
                    runs.add(lang, _BREAK.join(texts))
                by_lang.clear()

            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                raw = text.as_py().encode()
                by_lang.setdefault(lang, []).append(raw)
                held += len(raw)
                if held > 1 << 21:
                    pour()
                    held = 0
                    if runs.held >= flush_words or len(runs.words.known) > 1 << (_BITS - 1):
                        yield from runs.flush()
            pour()
            if runs.held >= flush_words or len(runs.words.known) > 1 << (_BITS - 1):
                yield from runs.flush()
        yield from runs.flush()

    return count


def _counts(docs: DataFrame, frontiers: list[Frontier], least: int, flush_words: int) -> DataFrame:
    given = docs.select(
        F.coalesce(docs["lang"].cast("string"), F.lit("und")).alias("lang"), F.coalesce(docs["text"], F.lit("")).alias("text")
    )
    rows = given.mapInArrow(_counter(frontiers, flush_words), COUNTS)
    return rows.groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n")).where((F.col("words") == 0) | (F.col("n") >= least))


# --- the frontier ---


def _bitmaps(pairs: DataFrame, names: list[str], most_bits: int) -> list[np.ndarray]:
    """A bitmap of pair hashes for each of the boolean columns, of at most 2^most_bits bits."""
    bits = min(most_bits, max(12, (8 * pairs.count()).bit_length()))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, phrases = batch.column("lang").to_pylist(), batch.column("phrase").to_pylist()
            parts = [p.encode().split(b" ") for p in phrases]
            word = lambda k: np.array([xxhash.xxh3_64_intdigest(p[k]) for p in parts], np.uint64)
            lang_hash = {x: _lang_hash(x) for x in set(langs)}
            hashes = mixed(word(0) * np.uint64(0x9E3779B97F4A7C15) + mixed(word(1) + np.array([lang_hash[x] for x in langs], np.uint64)))
            slots = (hashes >> np.uint64(64 - bits)).astype(np.int64)
            for i, name in enumerate(names):
                there = slots[batch.column(name).to_numpy(zero_copy_only=False)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(there), i, np.int32)), pa.array(there >> 3),
                        pa.array((1 << (there & 7)).astype(np.int32)),
                    ],
                    names=["which", "at", "bit"],
                )

    found = (
        pairs.select("lang", "phrase", *names).mapInArrow(mark, "which int, at long, bit int")
        .groupBy("which", F.expr("at >> 3").alias("at"))
        .agg(F.bit_or(F.expr("shiftleft(cast(bit as bigint), cast(8 * (at & 7) as int))")).alias("bits"))
    ).toArrow()  # 2^most_bits / 64 rows a bitmap at most
    out = []
    for i in range(len(names)):
        rows = found.filter(pc.equal(found["which"], i))
        words = np.zeros(1 << (bits - 6), np.int64)
        words[rows["at"].to_numpy()] = rows["bits"].to_numpy()
        out.append(words.view(np.uint8))
    return out


def _score(a: Column, l: Column, r: Column) -> Column:  # noqa: E741
    """floor(1000000 * a * a / (l * r)), exactly."""
    wide = lambda c: c.cast("decimal(38,0)")
    return F.call_function("div", wide(a) * a * F.lit(_MILLION), wide(l) * r)


def _scored_pairs(counts: DataFrame) -> DataFrame:
    """lang, phrase, n, l, r, score and the bounds of what begins (left) or ends (right) with it."""
    word = counts.where("words = 1").select("lang", F.col("phrase").alias("word"), F.col("n").alias("of"))
    pairs = counts.where("words = 2").select(
        "lang", "phrase", F.col("n").alias("a"), F.substring_index("phrase", " ", 1).alias("x"),
        F.substring_index("phrase", " ", -1).alias("y"),
    )
    first, second = word.toDF("lang", "x", "l"), word.toDF("lang", "y", "r")
    known = pairs.join(first, ["lang", "x"]).join(second, ["lang", "y"])
    return known.select(
        "lang", "phrase", "a", "l", "r", _score(F.col("a"), F.col("l"), F.col("r")).alias("score"),
        F.expr(f"cast(a as decimal(38,0)) * {_MILLION} div l").alias("left_bound"),
        F.expr(f"cast(a as decimal(38,0)) * {_MILLION} div r").alias("right_bound"),
    )


def _scored_triples(triples: DataFrame, pairs: DataFrame) -> DataFrame:
    head = pairs.select("lang", F.col("phrase").alias("head"), F.col("a").alias("of_head"), F.col("l").alias("of_first"))
    tail = pairs.select("lang", F.col("phrase").alias("tail"), F.col("a").alias("of_tail"), F.col("r").alias("of_last"))
    known = (
        triples.select(
            "lang", "phrase", F.col("n").alias("a"), F.substring_index("phrase", " ", 2).alias("head"),
            F.substring_index("phrase", " ", -2).alias("tail"),
        ).join(head, ["lang", "head"]).join(tail, ["lang", "tail"])
        .withColumn("s1", _score(F.col("a"), F.col("of_first"), F.col("of_tail")))
        .withColumn("s2", _score(F.col("a"), F.col("of_head"), F.col("of_last")))
    )
    early = F.col("s1") <= F.col("s2")
    return known.select(
        "lang", "phrase", "head", "tail", "a", F.when(early, F.col("of_first")).otherwise(F.col("of_head")).alias("l"),
        F.when(early, F.col("of_tail")).otherwise(F.col("of_last")).alias("r"), F.least("s1", "s2").alias("score"),
    )


def _best(rows: DataFrame, order: list[Column], k: int, parts: int = 64) -> DataFrame:
    """The first k rows of each language, with their `rank`; a hot language is first cut down in parts."""
    number = lambda *by: F.row_number().over(Window.partitionBy("lang", *by).orderBy(*order))
    dealt = rows.withColumn("part", F.pmod(F.xxhash64(*rows.columns), F.lit(parts)))
    some = dealt.withColumn("rank", number("part")).where(F.col("rank") <= k).drop("part", "rank")
    return some.withColumn("rank", number().cast("long")).where(F.col("rank") <= k)


def _floors(pairs: DataFrame, rank: int) -> DataFrame:
    """Per language the score of its `rank`-th best pair, 0 if it has fewer."""
    return (
        _best(pairs.select("lang", "phrase", "score"), [F.desc("score")], rank)
        .groupBy("lang").agg(F.when(F.count("*") == rank, F.min("score")).otherwise(F.lit(0)).alias("floor"))
    )


def collocations(
    docs: DataFrame, least: int = 10, top: int = 2000, inside: int = 50, start: int = 2, deeper: int = 8,
    flush_words: int = 4_000_000, most_bits: int = 26,
) -> DataFrame:
    """The `top` phrases per language: lang, rank, phrase, a, l, r, n, score.

    Phrases occur `least` times or more. A pair is dropped if a triple that holds it occurs at
    least `inside` per cent as often. The first round goes down to the score of pair
    `start` * `top`, each further one `deeper` times as far.
    """
    counts = stored(_counts(docs, [], least, flush_words), "counts")
    pairs = stored(_scored_pairs(counts), "pairs")
    rank, frontiers, triples, settled = start * top, [], None, None
    while True:
        floors = _floors(pairs, rank)
        if settled is not None:
            floors = floors.join(settled, "lang", "left_anti")
        floors = stored(floors, "floors")
        reach = lambda c: F.col(c) >= F.col("floor")
        marked = pairs.join(floors, "lang").select(
            "lang", "phrase", reach("left_bound").alias("left"), reach("right_bound").alias("right"), reach("score").alias("sure")
        ).where("left or right")
        frontiers.append(Frontier(*_bitmaps(stored(marked, "frontier"), ["left", "right", "sure"], most_bits)))
        new = stored(_scored_triples(_counts(docs, frontiers, least, flush_words), pairs), "triples")
        triples = new if triples is None else triples.union(new)
        ranked = stored(_ranked(pairs, triples, floors, top, inside), "ranked")
        done = stored(_settled(floors, ranked, top), "settled")
        out = ranked.join(done, "lang", "left_semi") if settled is None else out.union(ranked.join(done, "lang", "left_semi"))
        settled = done if settled is None else settled.union(done)
        if floors.join(done, "lang", "left_anti").isEmpty():
            break
        rank *= deeper
    total = counts.where("words = 0").select("lang", "n")
    return out.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _ranked(pairs: DataFrame, triples: DataFrame, floors: DataFrame, top: int, inside: int) -> DataFrame:
    """The best survivors of each language among phrases that reach its floor; all of these are known."""
    around = triples.select("lang", F.col("head").alias("phrase"), F.col("a").alias("longer")).union(
        triples.select("lang", "tail", "a")
    ).groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    high = pairs.join(floors, "lang").where("score >= floor").join(around, ["lang", "phrase"], "left")
    columns = ["lang", "phrase", "a", "l", "r", "score"]
    kept = high.where(F.col("longer").isNull() | (100 * F.col("longer") < inside * F.col("a"))).select(*columns)
    grown = triples.join(floors, "lang").where("score >= floor").select(*columns)
    return _best(kept.union(grown), [F.desc("score"), F.desc("a"), F.asc("phrase")], top)


def _settled(floors: DataFrame, ranked: DataFrame, top: int) -> DataFrame:
    """Languages whose `top` survivors reach their floor, or that have nothing left to count."""
    found = ranked.groupBy("lang").agg(F.count("*").alias("k"))
    return floors.join(found, "lang", "left").where((F.col("floor") == 0) | (F.col("k") >= top)).select("lang")
