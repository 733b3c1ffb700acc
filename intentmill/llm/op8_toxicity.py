"""Toxicity: a learned lexicon, Levenshtein automata, and the context of each hit.

From a bounded sample of labelled rows come the lexicon's terms: words, and beginnings of
words, that toxic documents have far more often than others. They form a trie. A word of
a text that is not a term is met by the automaton of all strings one edit away from it;
walking the trie and the automaton together finds terms that it misspells. Words that
share neither half with a term can't be one edit away and are not tried.

Each hit is judged by the window around it: whether it stands inside quotation marks, and
whether other hits are near. A logistic model over plain, misspelled and quoted weight,
clustering and density gives the score.

Every text is scored whole, in one pass without a shuffle. A NULL or empty text has no
hits and the score of a text without any. Repeated rows get equal scores. Without labelled
rows the score is 0; an empty table gives an empty result.
"""

from __future__ import annotations

import pickle
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from intentmill.llm.common import held_out, texts
from intentmill.llm.learning import labelled_sample, learned

_WORD = re.compile(r"[^\W\d_]+")
_QUOTES = re.compile(r"[\"“”„«»‹›]")
_STEMS = range(4, 9)  # lengths of beginnings
_SHORTEST_FUZZY = 5  # shorter terms have too many neighbours


class LevenshteinAutomaton:
    """Strings within `edits` insertions, deletions or replacements of a word.

    A state is the set of (letters read, edits made) that are still open.
    """

    def __init__(self, word: str, edits: int = 1):
        self.word, self.edits = word, edits

    def _closed(self, open_: set[tuple[int, int]]) -> frozenset:
        todo = list(open_)
        while todo:
            at, made = todo.pop()
            skip = (at + 1, made + 1)
            if at < len(self.word) and made < self.edits and skip not in open_:
                open_.add(skip)
                todo.append(skip)
        return frozenset(open_)

    def start(self) -> frozenset:
        return self._closed({(0, 0)})

    def step(self, state: frozenset, letter: str) -> frozenset:
        to = set()
        for at, made in state:
            if at < len(self.word) and self.word[at] == letter:
                to.add((at + 1, made))
            elif made < self.edits:
                to.add((at, made + 1))
                if at < len(self.word):
                    to.add((at + 1, made + 1))
        return self._closed(to)

    def accepts(self, state: frozenset) -> bool:
        return any(at == len(self.word) for at, _ in state)


class Trie:
    """Terms as nested letters; a term's weight stands under the empty string."""

    def __init__(self, terms: dict[str, float]):
        self.top: dict = {}
        for term, weight in terms.items():
            node = self.top
            for letter in term:
                node = node.setdefault(letter, {})
            node[""] = weight

    def heaviest(self, automaton: LevenshteinAutomaton) -> float:
        """Weight of the heaviest term that the automaton accepts; 0 if none."""
        best, todo = 0.0, [(self.top, automaton.start())]
        while todo:
            node, state = todo.pop()
            for letter, below in node.items():
                if letter == "":
                    best = max(best, below) if automaton.accepts(state) else best
                elif to := automaton.step(state, letter):
                    todo.append((below, to))
        return best


class Lexicon:
    """Weights of words: as terms, by their beginning, or one edit from a term."""

    def __init__(self, words: dict[str, float], stems: dict[str, float], remembered: int = 1_000_000):
        self.words, self.stems, self.remembered = words, stems, remembered
        self.stem_lengths = sorted({len(s) for s in stems})
        fuzzy = {t: w for t, w in words.items() if len(t) >= _SHORTEST_FUZZY}
        self.trie = Trie(fuzzy)
        self.heads = {t[: len(t) // 2] for t in fuzzy}
        self.tails = {t[len(t) // 2 :] for t in fuzzy}
        self.head_lengths = sorted({len(h) for h in self.heads})
        self.tail_lengths = sorted({len(t) for t in self.tails})
        self.known: dict[str, tuple[float, bool] | None] = {}

    def _look(self, word: str) -> tuple[float, bool] | None:
        if word in self.words:
            return self.words[word], False
        for n in self.stem_lengths:
            if word[:n] in self.stems:
                return self.stems[word[:n]], False
        if len(word) < _SHORTEST_FUZZY - 1:
            return None
        if any(word[:n] in self.heads for n in self.head_lengths) or any(word[-n:] in self.tails for n in self.tail_lengths):
            weight = self.trie.heaviest(LevenshteinAutomaton(word))
            return (weight, True) if weight else None
        return None

    def hits(self, text: str) -> tuple[int, list[tuple[int, float, bool, bool]]]:
        """Number of words, and (place, weight, misspelled, quoted) of each hit."""
        low = text.lower()
        words = _WORD.findall(low)
        if len(self.known) > self.remembered:
            self.known.clear()
        distinct, known = set(words), self.known
        for word in distinct.difference(known):
            known[word] = self._look(word)
        if not any(known[w] for w in distinct):
            return len(words), []
        found = []
        for place, match in enumerate(_WORD.finditer(low)):
            if hit := known[match[0]]:
                before, after = low[max(0, match.start() - 60) : match.start()], low[match.end() : match.end() + 60]
                quoted = len(_QUOTES.findall(before)) % 2 == 1 and bool(_QUOTES.search(after))
                found.append((place, *hit, quoted))
        return len(words), found

    def features(self, text: str) -> np.ndarray:
        n, found = self.hits(text)
        out = np.zeros(7)
        if found:
            place, weight, wrong, quoted = (np.array(x) for x in zip(*found))
            near = np.minimum(np.diff(place, prepend=-99), np.diff(place, append=place[-1] + 99)) <= 10
            plain = ~wrong & ~quoted
            out[:] = (
                np.log1p(weight[plain].sum()), np.log1p(weight[wrong & ~quoted].sum()), np.log1p(weight[quoted].sum()),
                np.log1p(near.sum()), np.sqrt(len(found) / n), plain.any(), np.log1p(len({*place.tolist()})),
            )
        return out


# --- learning ---


def _distinct(rows: pd.DataFrame) -> pd.DataFrame:
    """One row of each label and whole text, whatever its case and spaces."""
    whole = rows["text"].map(lambda t: " ".join(t.lower().split()))
    return rows[~pd.DataFrame({"text": whole, "label": rows["label"]}).duplicated()]


def _terms(rows: pd.DataFrame, least: int, purity: float) -> tuple[dict[str, float], dict[str, float]]:
    """Words and beginnings that mark toxic documents, with log odds as weights."""
    counts = (Counter(), Counter()), (Counter(), Counter())  # words, stems; by label
    under: dict[str, set] = {}
    for text, label in zip(rows["text"], rows["label"]):
        words = {w for w in _WORD.findall(text.lower()) if len(w) >= 3}
        counts[0][label].update(words)
        stems = {w[:n] for w in words for n in _STEMS if len(w) > n}
        counts[1][label].update(stems)
        if label:
            for w in words:
                for n in _STEMS:
                    if len(w) > n:
                        under.setdefault(w[:n], set()).add(w)
    many = max(1, int((rows["label"] == 1).sum()))
    rest = max(1, len(rows) - many)

    def chosen(clean: Counter, toxic: Counter, few: int) -> dict[str, float]:
        return {
            t: float(np.log((n + 0.5) / (many + 1)) - np.log((clean[t] + 0.5) / (rest + 1)))
            for t, n in toxic.items()
            if n >= few and n / many * purity > clean[t] / rest and n / (n + clean[t]) >= 0.8
        }

    words = chosen(*counts[0], least)
    stems = {t: w for t, w in chosen(*counts[1], 2 * least).items() if len(under[t]) >= 4}
    stems = {t: w for t, w in stems.items() if not any(t[:n] in stems for n in range(_STEMS[0], len(t)))}
    return words, stems


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, steps: int = 50) -> np.ndarray:
    """Weights by Newton's method, the last for a constant."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + ridge * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        move = np.linalg.solve(curve, slope)
        w -= move
        if np.abs(move).max() < 1e-8:
            break
    return w


def train(
    docs: DataFrame, labels: DataFrame, sample: int = 8000, least: int = 6, purity: float = 0.1
) -> tuple[Lexicon, np.ndarray] | None:
    """Lexicon and weights from at most `sample` labelled rows; None without any.

    A term must be in `least` toxic documents of different texts (copies count once) and
    have at least 1 / `purity` times the odds of one. Beginnings need twice as many. The
    weights are fitted to all rows of the sample.
    """

    def learn(rows: pd.DataFrame) -> bytes:
        if not len(rows):
            return pickle.dumps(None)
        lexicon = Lexicon(*_terms(_distinct(rows), least, purity))
        weights = _logistic(np.array([lexicon.features(t) for t in rows["text"]]), rows["label"].to_numpy(float))
        lexicon.known.clear()
        return pickle.dumps((lexicon, weights))

    return pickle.loads(learned(labelled_sample(docs, labels, "toxic", sample), learn))


def toxicity(text: Column, model: tuple[Lexicon, np.ndarray] | None) -> Column:
    """The probability of label 1."""
    if model is None:
        return F.lit(0.0)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        lexicon, weights = model
        for batch in batches:
            x = np.array([lexicon.features(t or "") for t in batch]).reshape(len(batch), len(weights) - 1)
            yield pd.Series(1 / (1 + np.exp(-np.clip(x @ weights[:-1] + weights[-1], -30, 30))))

    return score(text)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **how) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    model = train(docs, labels, **how)
    return (
        texts(docs).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), toxicity(F.col("text"), model).alias("score"))
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
    )
