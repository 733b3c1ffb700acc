import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))


@pytest.fixture
def docs(spark):
    """A table of documents from {id: text} or [(id, text)], with columns whose names operators use."""

    def build(texts):
        rows = texts.items() if isinstance(texts, dict) else texts
        return spark.createDataFrame(
            [(i, t, "x", 1, -1, "k") for i, t in rows],
            "doc_id long, text string, score string, n_tokens int, row int, text_hash string",
        )

    return build


@pytest.fixture(scope="session")
def prose():
    """200 texts of invented words, with copies, near copies, shared passages and odd cases."""
    import random

    draw = random.Random(7)
    words = ["".join(draw.choice("aeiourstnlé") for _ in range(draw.randint(2, 7))) for _ in range(900)]
    make = lambda n: [draw.choice(words) for _ in range(n)]
    shared = make(60)
    texts = {}
    for i in range(150):
        w = make(draw.randint(1, 250))
        if i % 5 == 0:
            w[len(w) // 2 : len(w) // 2] = shared[draw.randint(0, 20) :]
        texts[i] = " ".join(w)
    for i in range(150, 180):  # near copies, of each other too
        w = texts[10 * (i % 3)].split(" ")
        for _ in range(draw.randint(1, 5)):
            w[draw.randrange(len(w))] = draw.choice(words)
        texts[i] = " ".join(w)
    for i in range(180, 190):
        texts[i] = texts[i - 100]
    texts |= {190: "", 191: None, 192: "a", 193: "A", 194: "a b", 195: " \n\t ", 196: "x " * 100, 197: "p q " * 60}
    texts |= {198: "Wort mit Raum " * 30, 199: "one two  three\n\nfour\tfive " * 9}
    return texts
