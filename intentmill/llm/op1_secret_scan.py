"""Secret scans: all rules in one minimised automaton, one pass over the bytes.

Every rule is a small regular expression. Their union, preceded by any bytes, is turned
into one deterministic automaton by subset construction over byte classes and minimised
by partition refinement; its states say which rules end at a byte. A text is scanned
once with it. Where a rule ends, that rule's own reverse automaton finds the leftmost
start and its forward one the longest end, so spans are leftmost and do not overlap
within a rule.

A NULL or empty text has no spans. Repeated rows are scanned each. A text of any length
is one pass in constant memory besides its spans. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c.lower()}]" if c.isalpha() else c for c in word)


def _long_value(match: bytes) -> bool:
    """Whether what is assigned has eight characters or more."""
    cut = min(i for i in (match.find(b":"), match.find(b"=")) if i >= 0)
    value = match[cut + 1 :].lstrip(b" ")
    return len(value) - (value[:1] in (b'"', b"'")) >= 8


def _at_least(length: int) -> Callable[[bytes], bool]:
    """A length that is looked at after the match: counting states would multiply."""
    return lambda match: len(match) >= length


@dataclass(frozen=True)
class Rule:
    """A kind, its pattern over bytes, and what a match must pass to be kept.

    Patterns know literals, \\xHH, [classes], groups, |, ?, *, + and {m,n}.
    """

    kind: str
    pattern: str
    keep: Callable[[bytes], bool] | None = None


_KEYS = "|".join(_either_case(w) for w in ("password", "passwd", "secret", "token"))
BASE = (
    Rule(
        "assign",
        f"({_KEYS}|{_either_case('api')}_?{_either_case('key')})[\"']?\\x20*[:=]\\x20*[\"']?[A-Za-z0-9+/_.=-]+",
        _long_value,
    ),
    Rule("access", "AKIA[A-Z0-9]+", _at_least(16)),
    Rule("hex", "[0-9a-f]{32,}"),
)
ADDED = (
    Rule("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("repo_token", "gh[pousr]_[A-Za-z0-9]+", _at_least(40)),
    Rule("chat_token", "xox[abprs]-[A-Za-z0-9-]+", _at_least(15)),
)
RULES = BASE + ADDED


# --- pattern to tree ---


def _parse(pattern: str):
    """A tree of ("set", mask), ("cat", parts), ("or", parts), ("rep", part, least, most)."""
    at = 0

    def char() -> int:
        nonlocal at
        c = pattern[at]
        at += 1
        if c != "\\":
            return ord(c)
        at += 1
        if pattern[at - 1] == "x":
            at += 2
            return int(pattern[at - 2 : at], 16)
        return ord(pattern[at - 1])

    def charset() -> int:
        nonlocal at
        mask = 0
        while pattern[at] != "]":
            low = high = char()
            if pattern[at] == "-" and pattern[at + 1] != "]":
                at += 1
                high = char()
            mask |= (1 << (high + 1)) - (1 << low)
        at += 1
        return mask

    def piece():
        nonlocal at
        if pattern[at] == "(":
            at += 1
            node = either()
            at += 1
        elif pattern[at] == "[":
            at += 1
            node = ("set", charset())
        else:
            node = ("set", 1 << char())
        while at < len(pattern) and pattern[at] in "?*+{":
            if pattern[at] == "{":
                end = pattern.index("}", at)
                low, comma, high = pattern[at + 1 : end].partition(",")
                node = ("rep", node, int(low), int(high) if high else None if comma else int(low))
                at = end + 1
            else:
                node = ("rep", node, *{"?": (0, 1), "*": (0, None), "+": (1, None)}[pattern[at]])
                at += 1
        return node

    def either():
        nonlocal at
        options = []
        while True:
            parts = []
            while at < len(pattern) and pattern[at] not in "|)":
                parts.append(piece())
            options.append(("cat", parts))
            if at >= len(pattern) or pattern[at] == ")":
                return ("or", options)
            at += 1

    return either()


def _reversed(node):
    kind = node[0]
    if kind == "set":
        return node
    if kind == "rep":
        return ("rep", _reversed(node[1]), *node[2:])
    parts = [_reversed(p) for p in node[1]]
    return (kind, parts[::-1] if kind == "cat" else parts)


# --- tree to nondeterministic automaton ---


class _Nfa:
    def __init__(self):
        self.free: list[list[int]] = []  # moves that read nothing
        self.steps: list[list[tuple[int, int]]] = []  # (mask of bytes, next)

    def state(self) -> int:
        self.free.append([])
        self.steps.append([])
        return len(self.free) - 1

    def add(self, node, start: int) -> int:
        """Append the node after a state; the state in which it ends."""
        kind = node[0]
        if kind == "set":
            end = self.state()
            self.steps[start].append((node[1], end))
            return end
        if kind == "cat":
            for part in node[1]:
                start = self.add(part, start)
            return start
        end = self.state()
        if kind == "or":
            for part in node[1]:
                self.free[self.add(part, start)].append(end)
            return end
        _, part, least, most = node
        for _ in range(least):
            start = self.add(part, start)
        if most is None:
            loop = self.state()
            self.free[start].append(loop)
            self.free[self.add(part, loop)].append(loop)
            self.free[loop].append(end)
            return end
        self.free[start].append(end)
        for _ in range(most - least):
            start = self.add(part, start)
            self.free[start].append(end)
        return end


# --- subset construction and minimisation ---


@dataclass(frozen=True)
class Automaton:
    """Transition array (state, byte class), class of each byte, rules that end in each state.

    State 0 is the start; without `searching`, the state `dead` can't be left.
    """

    moves: np.ndarray
    classes: bytes
    ends: np.ndarray
    dead: int


def _subsets(trees: list, searching: bool) -> Automaton:
    nfa = _Nfa()
    start = nfa.state()
    final = {nfa.add(tree, start): 1 << k for k, tree in enumerate(trees)}
    masks = sorted({mask for steps in nfa.steps for mask, _ in steps})
    kinds: dict[tuple, int] = {}
    classes = bytes(kinds.setdefault(tuple(m >> b & 1 for m in masks), len(kinds)) for b in range(256))
    one = [classes.index(k) for k in range(len(kinds))]  # a byte of each class
    by_class = [
        [frozenset(to for mask, to in steps if mask >> b & 1) for b in one] for steps in nfa.steps
    ]

    @lru_cache(maxsize=None)
    def closure(state: int) -> frozenset:
        seen, todo = {state}, [state]
        while todo:
            for to in nfa.free[todo.pop()]:
                if to not in seen:
                    seen.add(to)
                    todo.append(to)
        return frozenset(s for s in seen if nfa.steps[s] or s in final)

    first = closure(start)
    number, order, rows = {first: 0}, [first], []
    for states in order:
        row = []
        for c in range(len(one)):
            to = set(first) if searching else set()
            for s in states:
                for t in by_class[s][c]:
                    to |= closure(t)
            to = frozenset(to)
            if to not in number:
                number[to] = len(order)
                order.append(to)
            row.append(number[to])
        rows.append(row)
    ends = np.array([sum({final[s] for s in states if s in final}) for states in order])
    return _minimised(np.array(rows), classes, ends)


def _minimised(moves: np.ndarray, classes: bytes, ends: np.ndarray) -> Automaton:
    """Merge states that no further bytes tell apart, by refining the partition by ends."""
    block = np.unique(ends, return_inverse=True)[1]
    while True:
        finer = block
        for to in moves.T:  # one byte class after another, so that numbers stay small
            finer = np.unique(finer * len(moves) + block[to], return_inverse=True)[1]
        if finer.max() == block.max():
            break
        block = finer
    _, chosen = np.unique(block, return_index=True)
    rank = np.argsort(np.argsort(chosen))  # blocks by first state, so the start is 0
    keep = np.sort(chosen)
    moves, ends = rank[block[moves[keep]]], ends[keep]
    stuck = (moves == np.arange(len(moves))[:, None]).all(axis=1) & (ends == 0)
    return Automaton(moves, classes, ends, int(np.flatnonzero(stuck)[0]) if stuck.any() else -1)


@dataclass(frozen=True)
class Scanner:
    """The combined automaton, and forward and reverse ones of each rule."""

    rules: tuple[Rule, ...]
    combined: Automaton
    forward: tuple[Automaton, ...]
    backward: tuple[Automaton, ...]


@lru_cache(maxsize=8)
def compile_rules(rules: tuple[Rule, ...] = RULES) -> Scanner:
    trees = [_parse(r.pattern) for r in rules]
    return Scanner(
        rules,
        _subsets(trees, searching=True),
        tuple(_subsets([t], searching=False) for t in trees),
        tuple(_subsets([_reversed(t)], searching=False) for t in trees),
    )


# --- scanning ---


def _linked(automaton: Automaton) -> list:
    """Rows that hold the next rows themselves and, last, the rules that end there."""
    rows = [[None] * automaton.moves.shape[1] for _ in automaton.moves]
    for row, to, ends in zip(rows, automaton.moves.tolist(), automaton.ends.tolist()):
        row[:] = [rows[t] for t in to]
        row.append(ends)
    return rows[0]


def _longest(automaton: Automaton, data: Iterator[int]) -> int:
    """Bytes of the longest match at the beginning of the data; 0 if none."""
    moves, classes, state, best = automaton.moves, automaton.classes, 0, 0
    for n, byte in enumerate(data, 1):
        state = moves[state, classes[byte]]
        if automaton.ends[state]:
            best = n
        elif state == automaton.dead:
            break
    return best


class _Scan:
    def __init__(self, scanner: Scanner):
        self.scanner = scanner
        self.start = _linked(scanner.combined)

    def __call__(self, text: str) -> list[tuple[int, int, int]]:
        """(start, end, rule) in code points, by start and rule."""
        data = text.encode("utf-8", "surrogatepass")
        row, hits = self.start, []
        for end, c in enumerate(data.translate(self.scanner.combined.classes), 1):
            row = row[c]
            if row[-1]:
                hits.append((end, row[-1]))
        if not hits:
            return []
        found = []
        for k, rule in enumerate(self.scanner.rules):
            low = 0
            for end, ends in hits:
                if end <= low or not ends >> k & 1:
                    continue
                back = _longest(self.scanner.backward[k], (data[i] for i in range(end - 1, low - 1, -1)))
                if not back:
                    continue
                start = end - back
                low = start + _longest(self.scanner.forward[k], (data[i] for i in range(start, len(data))))
                if rule.keep is None or rule.keep(data[start:low]):
                    found.append((start, low, k))
        found.sort(key=lambda x: (x[0], x[2]))
        if not data.isascii():
            bytes_ = np.frombuffer(data, np.uint8)
            inner = np.flatnonzero((bytes_ & 0xC0) == 0x80)
            shift = lambda x: int(x - np.searchsorted(inner, x))
            found = [(shift(a), shift(b), k) for a, b, k in found]
        return found


def _spans_of(rules: tuple[Rule, ...]):
    scanner = compile_rules(rules)

    @F.pandas_udf("string")
    def spans(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scan = _Scan(scanner)
        for batch in batches:
            yield pd.Series(
                [",".join(f"{rules[k].kind}:{a}:{b}" for a, b, k in scan(t or "")) for t in batch],
                dtype=object,
            )

    return spans


def find_secrets(docs: DataFrame, text: Column, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The frame with `spans`: kind:start:end of each secret, by start, comma-joined."""
    return docs.withColumn("spans", _spans_of(rules)(text))


def redacted(text: Column, rules: tuple[Rule, ...] = RULES, mark: str = "[REDACTED]") -> Column:
    """The text with every secret replaced by a mark; overlapping spans become one."""
    scanner = compile_rules(rules)

    @F.pandas_udf("string")
    def redact(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scan = _Scan(scanner)
        for batch in batches:
            out = []
            for t in batch:
                if t:
                    parts, at = [], 0
                    for a, b, _ in scan(t):
                        if a >= at:
                            parts += [t[at:a], mark]
                        at = max(at, b)
                    t = "".join(parts) + t[at:]
                out.append(t)
            yield pd.Series(out, dtype=object)

    return redact(text)
