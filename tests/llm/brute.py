"""Plain versions of the corpus operators, over dicts of texts."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LETTERS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
VISIBLE = re.compile(r"[^\x20\x09-\x0D]+")
ASSIGN = re.compile(
    r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII
)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def secrets(text: str) -> list[tuple[int, int, int, str]]:
    """(start, rank of kind, end, kind) of the base rules."""
    found = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found)


def contamination(docs: dict[int, str], items: dict[int, str], window: int = 13) -> dict[int, tuple]:
    cut = lambda t: LETTERS.findall((t or "").translate(LOW))
    known = defaultdict(set)
    for item, text in items.items():
        w = cut(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            known[tuple(w[i : i + n])].add(item)
    out = {}
    for doc, text in docs.items():
        w, hit, found = cut(text), set(), set()
        for n in {len(x) for x in known}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in known:
                    hit.update(range(i, i + n))
                    found |= known[tuple(w[i : i + n])]
        out[doc] = (
            len(w), len(hit), len(found), sha(",".join(sorted(map(str, found)))), bool(hit) and 20 * len(hit) >= len(w)
        )
    return out


def repeats(docs: dict[int, str], window: int = 20) -> dict[int, tuple]:
    seen, out = set(), {}
    for doc in sorted(docs):
        w = VISIBLE.findall(docs[doc] or "")
        gone = set()
        for i in range(len(w) - window + 1):
            if tuple(w[i : i + window]) in seen:
                gone.update(range(i, i + window))
            seen.add(tuple(w[i : i + window]))
        out[doc] = (len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def shingles(text: str | None) -> set:
    w = VISIBLE.findall((text or "").translate(LOW))
    return {tuple(w[i : i + 3]) for i in range(len(w) - 2)} if len(w) >= 3 else {tuple(w)} if w else set()


def jaccard(docs: dict[int, str]) -> dict[int, tuple]:
    sets = {d: shingles(t) for d, t in docs.items()}
    parent, lists = {d: d for d in docs}, defaultdict(list)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for d, s in sets.items():
        common = Counter()
        for x in s:
            common.update(lists[x])
            lists[x].append(d)
        for e, k in common.items():
            if 100 * k >= 90 * (len(s) + len(sets[e]) - k):
                a, b = root(d), root(e)
                parent[max(a, b)] = min(a, b)
    return {d: (len(sets[d]), root(d)) for d in docs}
