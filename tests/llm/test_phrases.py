"""Collocations against a plain version, in one round and in several."""

import random
import re
from collections import Counter

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from intentmill.llm import op12_collocations as op

DRAW = random.Random(5)
VOCABULARY = [f"w{i}" for i in range(40)] + ["É", "über", "日本", "x'y"]


def sentence():
    words = [DRAW.choice(VOCABULARY[: DRAW.choice((6, 15, 44))]) for _ in range(DRAW.randint(0, 14))]
    if DRAW.random() < 0.4:
        words[1:1] = DRAW.choice((["New", "york", "city"], ["new", "YORK"], ["strong", "tea"], ["a", "a", "a", "a"]))
    return "".join(w + DRAW.choice((" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\r", "?", "-", " ! ")) for w in words)


ROWS = [(i, DRAW.choice(("en", "en", "en", "fr", None, "")), " ".join(sentence() for _ in range(DRAW.randint(0, 9)))) for i in range(300)]
ROWS += [(900, "en", None), (901, "en", ""), (902, "de", " ., \t"), (903, "es", "one"), (903, "es", "one"), (None, "es", "one two")]
ROWS += [(904, "long", "p q r. " * 20_000)]


def expected(rows, least, top, inside=50):
    counts, total = {}, Counter()
    for _, lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(brute.LOW)):
            w = re.findall("[^ \t]+", piece)
            total[lang] += len(w)
            for k in (1, 2, 3):
                for i in range(len(w) - k + 1):
                    counts.setdefault(lang, Counter())[tuple(w[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        found = []
        for p, a in f.items():
            if len(p) < 2 or a < least:
                continue
            if len(p) == 2 and any(len(q) == 3 and p in (q[:2], q[1:]) and b >= least and 100 * b >= inside * a for q, b in f.items()):
                continue
            score, k = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            found.append((score, a, " ".join(p), f[p[:k]], f[p[k:]]))
        found.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        out += [(lang, i + 1, p, a, x, y, total[lang], s) for i, (s, a, p, x, y) in enumerate(found[:top])]
    return sorted(out)


@pytest.fixture(scope="module")
def table(spark):
    frame = spark.createDataFrame(ROWS, "doc_id long, lang string, text string")
    return frame.withColumns({"phrase": F.lit("p"), "words": F.lit(1), "n": F.lit("x"), "score": F.lit(0.5)}).repartition(5).cache()


@pytest.mark.parametrize(
    "least, top, how",
    [
        (10, 2000, {}), (2, 7, {"start": 1, "deeper": 2}), (3, 20, {"flush_words": 500, "most_bits": 12}),
        (1, 3, {"start": 1, "deeper": 3}), (2, 40, {"start": 1}),
    ],
)
def test_phrases(table, least, top, how):
    found = op.collocations(table, least, top, **how)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, found.collect())) == expected(ROWS, least, top)


def test_dropped_pairs_take_a_second_round(spark):
    # The best pairs all lie in triples, so the first round's survivors are too few.
    text = [f"{a}{i} {b}{i} {c}{i}." for i in range(30) for a, b, c in ["abc"] * 4] + [f"{x} {y}." * 2 for x in "pqrst" for y in "uvwxyz"]
    rows = [(0, "en", " ".join(text))]
    frame = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    for top in (10, 40, 200):
        found = op.collocations(frame, 2, top, start=1, deeper=2)
        assert sorted(map(tuple, found.collect())) == expected(rows, 2, top)


def test_triples_outside_the_frontier_are_not_counted(table):
    counts = op._counts(table, [], 2, 1 << 22)
    pairs = op._scored_pairs(counts)
    marked = pairs.select("lang", "phrase", (F.col("left_bound") >= 10**6).alias("left"), (F.col("right_bound") >= 10**6).alias("right"), (F.col("score") >= 10**6).alias("sure"))
    frontier = op.Frontier(*op._bitmaps(marked, ["left", "right", "sure"], 20))
    zero = np.zeros(512, np.uint8)
    some = op._counts(table, [frontier], 2, 1 << 22)
    every = op._counts(table, [op.Frontier(~zero, ~zero, zero)], 2, 1 << 22)
    assert 0 < some.count() < every.count()
    assert some.subtract(every).isEmpty()
    rest = op._counts(table, [frontier, op.Frontier(~zero, ~zero, zero)], 2, 1 << 22)
    assert sorted(map(tuple, rest.union(some).collect())) == sorted(map(tuple, every.collect()))


def test_scores_are_exact(spark):
    draw = random.Random(1)
    rows = []
    for _ in range(300):
        a = draw.randint(1, 10**13)
        rows.append((a, a + draw.randint(0, 10**13), a + draw.randint(0, 10**6)))
    rows += [(10**13, 10**13, 10**13), (3, 3, 3), (1, 10**13, 10**13)]
    found = spark.createDataFrame(rows, "a long, l long, r long").select("*", op._score(F.col("a"), F.col("l"), F.col("r"))).collect()
    assert all(s == 10**6 * a * a // (x * y) for a, x, y, s in found)


def test_empty_table(table):
    assert op.collocations(table.limit(0)).count() == 0
