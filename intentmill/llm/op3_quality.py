"""Quality classifier: attention-based multiple-instance learning over passages.

A document is a bag of passages of 100 words. Each passage is described by its make-up
(kinds of characters, repetition, word lengths) and encoded by a small layer; a gated
attention, tanh times sigmoid, weighs the encodings; their weighted mean gives the score.
Encoder, attention and output are learned together from document labels alone.

Learning uses a bounded sample of labelled rows (`sample`), as a parameter; scoring reads
every passage of every text and needs no shuffle. A NULL or empty text is one passage of
nothing. Repeated rows get equal scores. Without labelled rows the score is 0.5; an empty
table gives an empty result.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from intentmill.llm.common import held_out, texts
from intentmill.llm.learning import labelled_sample, learned

PASSAGE = 100
_MARKS = [b for b in range(33, 127) if not chr(b).isalnum()]
_KINDS = np.zeros((256, len(_MARKS) + 5), np.float32)
for _b in range(256):
    _kind = (
        0 if 97 <= _b <= 122 else 1 if 65 <= _b <= 90 else 2 if 48 <= _b <= 57 else 3 if _b >= 128
        else 5 + _MARKS.index(_b) if _b in _MARKS else 4
    )
    _KINDS[_b, _kind] = 1
N_FEATURES = _KINDS.shape[1] + 5


def bag(text: str) -> np.ndarray:
    """Features of each passage; one row of zeros for a text without words."""
    words = text.split()
    if not words:
        return np.zeros((1, N_FEATURES), np.float32)
    rows, counts = [], []
    for i in range(0, len(words), PASSAGE):
        part = words[i : i + PASSAGE]
        data = " ".join(part).encode("utf-8", "surrogatepass")
        counts.append(np.bincount(np.frombuffer(data, np.uint8), minlength=256))
        n = len(part)
        rows.append((n, len(data), len(set(part)) / n, sum(map(eq, part, part[1:])) / n, len(set(map(len, part))) / n))
    n, size, distinct, doubled, lengths = np.array(rows, np.float32).T
    made = np.sqrt(np.array(counts, np.float32) @ _KINDS / size[:, None])
    return np.column_stack([made, np.log(n), size / n / 10, distinct, np.sqrt(doubled), lengths]).astype(np.float32)


# --- the network ---


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class AttentionModel:
    """Encoder, gated attention and output, as plain arrays."""

    def __init__(self, width: int = 24, depth: int = 12, seed: int = 0):
        draw = np.random.default_rng(seed)
        near = lambda *shape: draw.normal(0, 1 / np.sqrt(shape[0]), shape)
        self.mean, self.scale = np.zeros(N_FEATURES), np.ones(N_FEATURES)
        self.weights = {
            "encode": near(N_FEATURES, width), "encode_0": np.zeros(width),
            "content": near(width, depth), "gate": near(width, depth), "attend": near(depth, 1),
            "out": near(width, 1), "out_0": np.zeros(1),
        }

    def forward(self, passages: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
        """Everything from passages (bags begin at `starts`) to probabilities."""
        w = self.weights
        x = (passages - self.mean) / self.scale
        h = np.tanh(x @ w["encode"] + w["encode_0"])
        content, gate = np.tanh(h @ w["content"]), _sigmoid(h @ w["gate"])
        raw = ((content * gate) @ w["attend"])[:, 0]
        bags = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(x)]))
        grown = np.exp(raw - np.maximum.reduceat(raw, starts)[bags])
        share = grown / np.add.reduceat(grown, starts)[bags]
        whole = np.add.reduceat(share[:, None] * h, starts)
        score = _sigmoid(whole @ w["out"] + w["out_0"])[:, 0]
        return {"x": x, "h": h, "content": content, "gate": gate, "share": share, "bags": bags, "whole": whole, "score": score}

    def gradients(self, at: dict[str, np.ndarray], starts: np.ndarray, truth: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean log loss."""
        w, h, share, bags = self.weights, at["h"], at["share"], at["bags"]
        error = (at["score"] - truth)[:, None] / len(truth)
        to_whole = (error @ w["out"].T)[bags]
        to_share = (to_whole * h).sum(axis=1)
        mean = np.add.reduceat(share * to_share, starts)[bags]
        to_raw = (share * (to_share - mean))[:, None]
        mixed = to_raw @ w["attend"].T
        to_content = mixed * at["gate"] * (1 - at["content"] ** 2)
        to_gate = mixed * at["content"] * at["gate"] * (1 - at["gate"])
        to_h = share[:, None] * to_whole + to_content @ w["content"].T + to_gate @ w["gate"].T
        to_encode = to_h * (1 - h**2)
        return {
            "encode": at["x"].T @ to_encode, "encode_0": to_encode.sum(axis=0),
            "content": h.T @ to_content, "gate": h.T @ to_gate,
            "attend": (at["content"] * at["gate"]).T @ to_raw,
            "out": at["whole"].T @ error, "out_0": error.sum(axis=0),
        }

    def fit(self, bags: list[np.ndarray], truth: np.ndarray, steps: int, rate: float = 0.02, decay: float = 1e-4) -> None:
        """Adam over all bags at once."""
        passages = np.concatenate(bags).astype(np.float64)
        starts = np.cumsum([0, *map(len, bags[:-1])])
        self.mean, self.scale = passages.mean(axis=0), passages.std(axis=0) + 0.02
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        for t in range(1, steps + 1):
            slopes = self.gradients(self.forward(passages, starts), starts, truth)
            for k, weight in self.weights.items():
                slope = slopes[k] + decay * weight
                first[k] += 0.1 * (slope - first[k])
                second[k] += 0.001 * (slope**2 - second[k])
                weight -= rate * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.999**t)) + 1e-8)

    def scores(self, bags: list[np.ndarray]) -> np.ndarray:
        if not bags:
            return np.empty(0)
        return self.forward(np.concatenate(bags), np.cumsum([0, *map(len, bags[:-1])]))["score"]


def train(docs: DataFrame, labels: DataFrame, sample: int = 4000, steps: int = 300) -> AttentionModel | None:
    """A model of `quality` from at most `sample` labelled rows; None without any."""

    def learn(rows: pd.DataFrame) -> bytes:
        if not len(rows):
            return pickle.dumps(None)
        model = AttentionModel()
        model.fit([bag(t) for t in rows["text"]], rows["label"].to_numpy(np.float64), steps)
        return pickle.dumps(model)

    return pickle.loads(learned(labelled_sample(docs, labels, "quality", sample), learn))


def quality(text: Column, model: AttentionModel | None) -> Column:
    """The probability of label 1."""
    if model is None:
        return F.lit(0.5)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            found = [
                model.scores([bag(t or "") for t in batch.iloc[i : i + 500]]) for i in range(0, len(batch), 500)
            ]
            yield pd.Series(np.concatenate(found) if found else np.empty(0))

    return score(text)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **how) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    model = train(docs, labels, **how)
    return (
        texts(docs).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), quality(F.col("text"), model).alias("score"))
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
    )
