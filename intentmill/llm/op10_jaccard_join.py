"""N-gram Jaccard join: T-occurrence search with DivideSkip, inside exact candidate groups.

A document's set holds its distinct shingles of `n` words as 64-bit hashes. Equal sets are
one set from the start, so copies cost nothing later. Two sets link at a Jaccard similarity
of `per_cent` or more; at 90 they then differ in at most a ninth of either, at 80 in at most
a quarter. Sets are therefore cut by hash into a few more segments than that, the number
depending on the size class, and any two that link have an equal segment in a class both
take part in. A set also has as many equal segments with a linked one as it has segments
more than differences; sets of which fewer segments occur in any other set can't link and
are left out, so a passage that many texts share does not make one group of them.

Of all segments only this is kept: how many a set has in common with each center, the smallest
set of a segment. Links are found in rounds, one by default, and a rest. In a round a set goes
to that center of another component with which it has most segments in common, and enough for a
link. Sets that meet there are joined, in blocks, and links found make components. A segment
whose sets are all in one component has nothing left to say and goes; so do sets that have too few
segments left. Each set travels once a round. What is still open after the rounds is searched in
full by prefixes: with elements in one order for all sets, the rarest first, two sets that link have
an element in common among the first of either. So a passage that many texts share brings only
those together that are little else. Pairs of different components are bounded by short forms
of their sets, 16 bits an element, before whole sets travel.

In a block the join is a T-occurrence search: each set asks the inverted lists of its
shingles for sets that occur in at least T of them. Following DivideSkip, the longest
lists are left aside, the short ones are merged, and what the merge leaves is
looked up in the long ones by binary search until T is reached or out of reach. Sets
already connected are not counted again, so a group of copies takes one count a set, not
one a pair. A large group is cut into blocks that all hold its center, so no task holds more than a
block; tasks return spanning forests, never pairs.

Similarity is exact up to 64-bit hashes. A NULL or empty text has an empty set, links with
nothing, and is its own component. Rows that repeat are in one component; a NULL id counts
last when the smallest id is taken, and a component of NULL ids alone is NULL. An empty
table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from intentmill.llm.common import Among, components, discard, fresh, stored, texts, trimmed, with_least
from intentmill.llm.hashing import WordHashes, mixed, runs

PER_CENT = 90  # of similarity, unless a caller asks for another; segments and thresholds follow from it


# --- sets and their segments ---


def shingles(hashes: np.ndarray, n: int) -> np.ndarray:
    """Rising distinct hashes of n words in a row; of the whole sequence if it is shorter."""
    if not len(hashes):
        return hashes
    return np.unique(runs(hashes, n, 1) if len(hashes) >= n else runs(hashes, len(hashes), 1))


def most_apart(size: int, per_cent: int = PER_CENT) -> int:
    """How many elements a linked set may have more and less, together, than one of this size."""
    return size * (100 - per_cent) // per_cent


def size_class(size: int) -> int:
    """Classes of sizes from a power of 1.6 to the next."""
    return int(np.log(size) / np.log(1.6) + 1e-9)


def segment_keys(elements: np.ndarray, per_cent: int = PER_CENT) -> np.ndarray:
    """Hashes of (class, segment, the elements in it); linked sets have one in common.

    A set takes part in its size class and, if a linked set may be in them, in the next
    ones. The lowest six bits of a key are its class.
    """
    return _segments(elements, per_cent)[0]


def _segments(elements: np.ndarray, per_cent: int) -> tuple[np.ndarray, list[int]]:
    """Segment keys; per class, how many of them a linked set has at least, above the class in six bits."""
    size, keys, needs = len(elements), [], []
    own = size_class(size)
    for cls in range(own, size_class(size * 100 // per_cent + 1) + 1):
        apart = most_apart(int(1.6 ** (cls + 1)) + 1, per_cent)
        count = apart + 2 + apart // 16
        where = ((elements >> np.uint64(32)) * np.uint64(count) >> np.uint64(32)).astype(np.int64)
        starts = np.flatnonzero(np.r_[True, np.diff(where) != 0])
        sums = np.add.reduceat(mixed(elements), starts)
        names = where[starts]
        needs.append(max(1, len(starts) - most_apart(size, per_cent)) << 6 | cls)
        if len(starts) <= most_apart(size, per_cent):  # differences could touch every filled segment
            empty = np.setdiff1d(np.arange(count), names)
            names, sums = np.r_[names, empty], np.r_[sums, np.zeros(len(empty), np.uint64)]
        hashes = mixed(sums ^ mixed(names.astype(np.uint64) + np.uint64(cls << 32)))
        keys.append(hashes & ~np.uint64(63) | np.uint64(cls))
    return np.concatenate(keys).view(np.int64), needs


class _Sets:
    def __init__(self, n: int):
        self.n, self.hashes = n, WordHashes(300_000)

    def __call__(self, text: str) -> np.ndarray:
        return shingles(self.hashes(text.encode().lower().split()), self.n)


def _slot_counts(elements, bits: int) -> np.ndarray:
    return np.bincount((np.frombuffer(elements, np.uint64) >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)


def _set_id(elements: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(elements.tobytes()) - (1 << 63)


def _describe(n: int, per_cent: int):
    """doc_id, text_hash, size, set_id; segment keys and needs once for each set of a batch."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = _Sets(n)
        for whole in batches:
            seen = set()
            for at in range(0, whole.num_rows, 1000):  # keys are longer than texts
                batch = whole.slice(at, 1000)
                sizes, ids, keys, needs = [], [], [], []
                for text in batch.column("text"):
                    elements = sets(text.as_py())
                    sizes.append(len(elements))
                    ids.append(_set_id(elements) if len(elements) else None)
                    new = len(elements) and ids[-1] not in seen
                    seen.add(ids[-1])
                    own = _segments(elements, per_cent) if new else (None, None)
                    keys.append(own[0])
                    needs.append(own[1])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"), batch.column("text_hash"), pa.array(sizes, pa.int64()),
                        pa.array(ids, pa.int64()), pa.array(keys, pa.list_(pa.int64())), pa.array(needs, pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "text_hash", "size", "set_id", "keys", "needs"],
                )

    return trimmed(describe)


# --- T-occurrence search ---


class Index:
    """Inverted lists of the sets of a group, one after another in `owners`."""

    def __init__(self, sets: list[np.ndarray]):
        elements = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        order = np.argsort(elements, kind="stable")
        self.owners = owner[order].astype(np.int32)
        self.keys, starts = np.unique(elements[order], return_index=True)
        self.starts = np.r_[starts, len(elements)]

    def lists(self, query: np.ndarray) -> list[tuple[int, int]]:
        """Where the lists of the query's elements begin and end, the shortest first."""
        at = np.searchsorted(self.keys, query)
        at = at[at < len(self.keys)]
        at = at[np.isin(self.keys[at], query)]
        at = at[np.argsort(self.starts[at + 1] - self.starts[at], kind="stable")]
        return list(zip(self.starts[at].tolist(), self.starts[at + 1].tolist()))


def t_occurrence(
    owners: Sequence[int], lists: list[tuple[int, int]], least: Callable[[int | None], int], worth: Callable[[int], bool]
) -> Iterator[int]:
    """Numbers that occur in at least `least(number)` of the lists, by DivideSkip.

    The lists are parts of `owners`, rising inside, the shortest first. `least(None)` is
    a lower bound of all thresholds. Numbers that are not `worth` it when their turn
    comes are passed over.
    """
    owners = np.asarray(owners)
    t = least(None)
    aside = max(0, min(len(lists), t) - 1)
    short, long_ = lists[: len(lists) - aside], lists[len(lists) - aside :]
    if not short:
        return
    long_.reverse()  # the longest first: likeliest to hold a number
    merged = np.unique(np.concatenate([owners[a:b] for a, b in short]), return_counts=True)
    owners = memoryview(owners)  # single numbers are read faster there
    for number, count in zip(*(x.tolist() for x in merged)):
        if not worth(number):
            continue
        need = least(number)
        misses = count + aside - need  # as many long lists may be without it
        for begin, end in long_:
            if misses < 0 or count >= need:
                break
            at = bisect_left(owners, number, begin, end)
            if at < end and owners[at] == number:
                count += 1
            else:
                misses -= 1
        if count >= need:
            yield number


def _forest(
    ids: list[int], blocks: list[int], sets: list[np.ndarray], per_cent: int = PER_CENT,
    labels: list[int] | None = None,
) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links between sets of two blocks, or inside one.

    Sets of equal labels are known to be connected.
    """
    order = sorted(range(len(sets)), key=lambda i: (len(sets[i]), ids[i]))
    ids, blocks, sets, labels = ([x[i] for i in order] for x in (ids, blocks, sets, labels or ids))
    sizes = [len(s) for s in sets]
    index, first = Index(sets), {}
    parent = [first.setdefault(label, i) for i, label in enumerate(labels)]
    crossing = len(set(blocks)) > 1

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def overlap(a: int, b: int) -> int:
        return -(-per_cent * (a + b) // (100 + per_cent))

    edges, apart = [], 0  # apart: components among the sets so far
    for i, query in enumerate(sets):
        apart += first[labels[i]] == i
        if apart == 1:
            continue
        size = sizes[i]
        smallest = -(-per_cent * size // 100)

        def least(j: int | None) -> int:
            return overlap(size, smallest if j is None else sizes[j])

        def worth(j: int) -> bool:  # each pair once: from the larger, later one
            return (
                j < i and sizes[j] >= smallest and (not crossing or blocks[i] != blocks[j])
                and root(i) != root(j)
            )

        for j in t_occurrence(index.owners, index.lists(query), least, worth):
            parent[root(i)] = root(j)
            edges.append((ids[i], ids[j]))
            apart -= 1
            if apart == 1:
                break
    return edges


def _at_smallest(edges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Each node of a forest and the smallest of its tree, so that chains inside a block are no longer there."""
    up: dict[int, int] = {}

    def root(i: int) -> int:
        while up.setdefault(i, i) != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for a, b in edges:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return [(i, root(i)) for i in list(up) if root(i) != i]


def _join_blocks(per_cent: int):
    def join(group: pd.DataFrame) -> pd.DataFrame:
        group = group.drop_duplicates("set_id")
        sets = [np.frombuffer(x, np.uint64) for x in group["elements"]]
        own = [group[x].tolist() for x in ("set_id", "block", "label")]
        edges = _forest(own[0], own[1], sets, per_cent, own[2])
        return pd.DataFrame(_at_smallest(edges), columns=["a", "b"]).astype("int64")

    return join


def _short(elements: DataFrame) -> DataFrame:
    """Sets with the last 16 bits of each element."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            short = [np.frombuffer(x.as_buffer(), np.uint64).astype(np.uint16).tobytes() for x in batch.column("elements")]
            yield pa.RecordBatch.from_arrays([batch.column("set_id"), pa.array(short, pa.binary())], names=["set_id", "elements"])

    return elements.mapInArrow(cut, "set_id long, elements binary")


def _may_link(per_cent: int):
    """Pairs of a center and a set that have as many short elements in common as a link needs: no fewer than whole ones."""

    def keep(group: pd.DataFrame) -> pd.DataFrame:
        center = group["center"].iloc[0]
        sets = {i: np.frombuffer(x, np.uint16) for i, x in zip(group["set_id"], group["elements"])}
        own = sets.pop(center)
        counts, found = np.bincount(own, minlength=1 << 16), []
        for i, other in sets.items():
            values, times = np.unique(other, return_counts=True)
            if int(np.minimum(counts[values], times).sum()) * (100 + per_cent) >= per_cent * (len(own) + len(other)):
                found.append((center, i))
        return pd.DataFrame(found, columns=["a", "b"]).astype("int64")

    return keep


def _elements(n: int, wanted: Among):
    """doc_id, text_hash, elements of rows whose key may be wanted."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = _Sets(n)
        for batch in batches:
            batch = batch.filter(pa.array(wanted(batch.column("key").to_numpy())))
            for at in range(0, batch.num_rows, 1000):
                some = batch.slice(at, 1000)
                built = pa.array([sets(t.as_py()).tobytes() for t in some.column("text")], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [some.column("doc_id"), some.column("text_hash"), built], names=["doc_id", "text_hash", "elements"]
                )

    return trimmed(build)


def described(docs: DataFrame, n: int = 3, per_cent: int = PER_CENT) -> DataFrame:
    """Per row: doc_id, text_hash, size, set_id and, once for each set of a batch, segment keys and needs."""
    rows = texts(docs).withColumn("text_hash", F.xxhash64("text"))
    return rows.select("doc_id", "text_hash", "text").mapInArrow(
        _describe(n, per_cent), "doc_id long, text_hash long, size long, set_id long, keys array<long>, needs array<long>"
    )


def _class() -> Column:
    return F.col("key").bitwiseAND(F.lit(63)).alias("cls")


def _shared(postings: DataFrame) -> DataFrame:
    """(set_id, center, cls, n): of how many keys that several sets have this one is center is, and the set has.

    The center of a key is its smallest set, for which there are rows too. Keys are sorted once;
    no row knows more than the first set of its key and its neighbours, so reading on needs no memory.
    """
    key = Window.partitionBy("key").orderBy("set_id")
    center = F.first("set_id").over(key.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    seen = postings.select(
        "key", "set_id", center.alias("center"), F.lag("set_id").over(key).alias("before"), F.lead("set_id").over(key).alias("after")
    )
    # A set may have several rows for a key: the last counts for a center, the first for others.
    once = seen.where("if(set_id = center, after <> set_id, before <> set_id)")
    return once.groupBy("set_id", "center", _class()).agg(F.count("*").alias("n"))


def _able(shared: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows of sets that share as many keys of the class as a link needs, with that number and the set's size."""
    needs = rows.select("set_id", "size", F.explode("needs").alias("need"))
    wanted = needs.groupBy("set_id", F.col("need").bitwiseAND(F.lit(63)).alias("cls")).agg(
        F.max(F.shiftright("need", 6)).alias("least"), F.max("size").alias("size")
    )
    total = F.sum("n").over(Window.partitionBy("set_id", "cls"))
    return shared.withColumn("total", total).join(wanted, ["set_id", "cls"]).where("total >= least").drop("total")


def _labelled(shared: DataFrame, linked: DataFrame | None) -> DataFrame:
    """With the components of set and center, as far as known."""
    if linked is None:
        return shared.withColumns({"label": F.col("set_id"), "center_label": F.col("center")})
    one = linked.select(F.col("node").alias("set_id"), F.col("root").alias("x"))
    other = linked.select(F.col("node").alias("center"), F.col("root").alias("y"))
    return shared.join(one, "set_id", "left").join(other, "center", "left").withColumns(
        {"label": F.coalesce("x", "set_id"), "center_label": F.coalesce("y", "center")}
    ).drop("x", "y")


def _open(labelled: DataFrame) -> DataFrame:
    """The rows at whose centers any further link to another component is found.

    A key all of whose sets are in one component tells of none. Of a center's keys at most as
    many have sets of another component as their rows say; a set in the center's component
    has no more of them. With centers in one order for all sets, two linked sets meet at the
    first center of a key of both, and from there on either has as many keys as a link needs.
    A set thus stays away from its last centers, those of the most sets, that have fewer.
    """
    across = labelled.where("label <> center_label").groupBy("center", "cls").agg(F.sum("n").alias("across"))
    left = F.when(F.col("label") != F.col("center_label"), F.col("n")).otherwise(F.least("n", "across"))
    last_first = Window.partitionBy("set_id", "cls").orderBy(F.desc("across"), F.desc("center"))
    from_here = F.sum("left").over(last_first.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    joined = labelled.join(across, ["center", "cls"]).withColumn("left", left).withColumn("from_here", from_here)
    return joined.where("from_here >= least").select("set_id", "label", "center_label", "size").distinct()


def _round(labelled: DataFrame, elements: DataFrame, turn: int, block_elements: int, per_cent: int) -> DataFrame:
    """Links between each set and those that have the same nearest center."""
    near = labelled.where("label <> center_label and n >= least")
    order = F.struct("n" if not turn else F.lit(0), F.xxhash64("center", F.lit(turn)))
    best = near.groupBy("set_id").agg(F.max_by(F.struct("center", "label", "center_label", "size"), order).alias("x")).select(
        F.col("x.center").alias("a"), F.col("set_id").alias("b"), "x.label", "x.center_label", "x.size"
    )
    best = stored(best, "best")
    found = _met(best, elements, block_elements, _join_blocks(per_cent))
    discard(best)
    return found


def _met(stars: DataFrame, elements: DataFrame, block_elements: int, join: Callable) -> DataFrame:
    """What `join` finds among each center a and its sets b, in blocks of bounded size that all hold the center."""
    weight = stars.groupBy("a").agg(
        F.ceil(F.sum("size") / block_elements).cast("int").alias("m"), F.first("center_label").alias("center_label")
    )
    sent = with_least(stars.select("a", "b", "label"), weight.select("a", "m"), salts=8).select(
        F.col("b").alias("set_id"), "label", F.col("a").alias("center"),
        F.pmod(F.xxhash64("b"), F.col("m")).cast("int").alias("part"),
    )
    heads = weight.select(
        F.col("a").alias("set_id"), F.col("center_label").alias("label"), F.col("a").alias("center"),
        F.explode(F.sequence(F.lit(0), F.col("m") - 1)).alias("part"),
    )
    met = sent.union(heads).join(elements, "set_id").withColumn("block", F.lit(0))
    return stored(met.groupBy("center", "part").applyInPandas(join, "a long, b long"), "found")


def _counts(elements: DataFrame, bits: int) -> np.ndarray:
    """How many elements of all sets begin with each number of so many bits; of the same size for any input."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << bits, np.int64)
        for batch in batches:
            for x in batch.column("elements"):
                total += _slot_counts(x.as_buffer(), bits)
        slots = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(total[slots])], names=["slot", "n"])

    found = elements.select("elements").mapInArrow(count, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    total = np.zeros(1 << bits, np.int64)
    for batch in found.toArrow().to_batches():  # 2^bits rows at most
        total[batch.column("slot").to_numpy()] = batch.column("n").to_numpy()
    return total


def prefix(elements: np.ndarray, ranks: np.ndarray, bits: int, per_cent: int) -> np.ndarray:
    """The first elements of a set, in the order of the ranks of their first bits.

    A set has one of them in common with any it links with, whatever the order, if that is the
    same for all sets: without them too few are left. With the rarest first, these are seldom
    what many texts share.
    """
    order = np.lexsort((elements, ranks[(elements >> np.uint64(64 - bits)).astype(np.int64)]))
    return elements[order[: len(elements) - -(-per_cent * len(elements) // 100) + 1]]


def _prefixes(elements: DataFrame, per_cent: int, bits: int = 18) -> DataFrame:
    """set_id, size, prefix of each set."""
    ranks = np.empty(1 << bits, np.int32)
    ranks[np.argsort(_counts(elements, bits), kind="stable")] = np.arange(1 << bits)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column("elements")]
            firsts = [prefix(x, ranks, bits, per_cent).view(np.int64) for x in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column("set_id"), pa.array([len(x) for x in sets], pa.int64()), pa.array(firsts, pa.list_(pa.int64()))],
                names=["set_id", "size", "prefix"],
            )

    return elements.mapInArrow(build, "set_id long, size long, prefix array<long>")


def _rest(labelled: DataFrame, elements: DataFrame, block_elements: int, per_cent: int) -> DataFrame:
    """All further links: each open set with those of other components that share an element of its prefix.

    Of an element's sets those of its commonest component are not paired with each other, so a group
    of copies takes one row a set. From its first common element on, a pair has as many left as a
    link needs. What the pairs have in common is first bounded by short forms of their sets.
    """
    open_ = stored(_open(labelled).select("set_id", "label").distinct(), "open")
    first = _prefixes(elements, per_cent).join(open_, "set_id").select("set_id", "label", "size", F.posexplode("prefix").alias("at", "element"))
    first = stored(first, "first")
    sets_of = first.groupBy("element", "label").agg(F.count("*").alias("n"))
    common = sets_of.groupBy("element").agg(F.max_by("label", "n").alias("common"), F.count("*").alias("labels")).where("labels > 1")
    several = stored(first.join(common.drop("labels"), "element"), "several")
    discard(open_, first)
    x, y = several.where("label <> common").alias("x"), several.alias("y")
    linkable = F.expr(
        f"least(x.size, y.size) * 100 >= greatest(x.size, y.size) * {per_cent} and "
        f"least(x.size - x.at, y.size - y.at) * {100 + per_cent} >= (x.size + y.size) * {per_cent}"
    )
    ends = [F.struct(F.col(f"{i}.size"), F.col(f"{i}.set_id"), F.col(f"{i}.label")) for i in ("x", "y")]
    pairs = x.join(y, F.expr("x.element = y.element and x.label <> y.label") & linkable).select(
        F.greatest(*ends).alias("large"), F.least(*ends).alias("small")
    ).distinct()
    pairs = pairs.select(
        F.col("large.set_id").alias("a"), F.col("small.set_id").alias("b"), "small.label",
        F.col("large.label").alias("center_label"), "small.size",
    )
    pairs = stored(pairs, "pairs")
    discard(several)
    may = _met(pairs, _short(elements), 4 * block_elements, _may_link(per_cent))
    some = stored(pairs.join(may, ["a", "b"]), "some")
    found = _met(some, elements, block_elements, _join_blocks(per_cent))
    discard(pairs, may, some)
    return found


def jaccard_components(
    docs: DataFrame, n: int = 3, block_elements: int = 250_000, per_cent: int = PER_CENT, rounds: int = 1
) -> DataFrame:
    """Per row: doc_id, text_hash, n_shingles, component_id, the smallest id linked with it.

    `root` names the component; it is NULL for an empty set. The result is the same for any
    number of `rounds` and size of blocks.
    """
    sets = stored(described(docs, n, per_cent), "sets")
    rows = stored(sets.drop("keys"), "rows")
    shared = stored(_shared(sets.where("keys is not null").select("set_id", F.explode("keys").alias("key"))), "shared")
    discard(sets)
    able = stored(_able(shared, rows), "able")
    discard(shared)

    chosen = rows.where("set_id is not null").groupBy("set_id").agg(F.min(F.struct("doc_id", "text_hash")).alias("first"))
    open_ = able.select("set_id").distinct()
    texts_of = stored(
        chosen.join(open_, "set_id").select("set_id", F.col("first.doc_id").alias("w_id"), F.col("first.text_hash").alias("w_hash")),
        "texts_of",
    )
    # Only the sets of texts that may be wanted are built and shuffled.
    wanted = Among(texts_of.select(F.xxhash64("w_id", "w_hash").alias("key")))
    source = texts(docs).withColumn("text_hash", F.xxhash64("text"))
    source = source.select("doc_id", "text_hash", F.xxhash64("doc_id", "text_hash").alias("key"), "text")
    built = source.mapInArrow(_elements(n, wanted), "doc_id long, text_hash long, elements binary")
    built = built.join(
        texts_of, built["doc_id"].eqNullSafe(texts_of["w_id"]) & (built["text_hash"] == texts_of["w_hash"])
    ).select("set_id", "elements")
    elements = stored(built.dropDuplicates(["set_id"]), "elements")  # rows may be equal in id and text
    discard(texts_of)

    linked = None
    for turn in range(rounds + 1):
        now = _labelled(able, linked)
        last = turn == rounds
        found = _rest(now, elements, block_elements, per_cent) if last else _round(now, elements, turn, block_elements, per_cent)
        known = [] if linked is None else [linked.select(F.col("node").alias("a"), F.col("root").alias("b"))]
        before, linked = linked, stored(components(reduce(DataFrame.union, known, found)), "linked")
        discard(found, *([before] if before is not None else []))
    discard(able, elements)
    linked = linked.union(linked.select("root", "root").distinct())

    least = rows.where("set_id is not null").groupBy("set_id").agg(F.min("doc_id").alias("least"))
    joined = stored(least.join(linked, least["set_id"] == linked["node"]).select(F.col("root").alias("a"), F.col("set_id").alias("b"), "least"), "joined")
    smallest = joined.groupBy("a").agg(F.min("least").alias("m"))
    named = with_least(joined.drop("least"), smallest, salts=8).select(
        F.col("b").alias("key"), F.col("a").alias("root"), F.col("m").alias("component_id")
    )
    alone = least.select(F.col("set_id").alias("key"), "least")
    named = alone.join(named, "key", "left").select(
        "key", F.coalesce("root", "key").alias("root"),
        F.when(F.col("root").isNull(), F.col("least")).otherwise(F.col("component_id")).alias("component_id"),
    )
    # Rows without a set get a key of their own each, so that they do not meet in one task.
    key = F.coalesce("set_id", F.xxhash64("doc_id", "text_hash"))
    keyed = rows.select("doc_id", "text_hash", "size", "set_id", key.alias("key"))
    return keyed.join(named, "key", "left").select(
        "doc_id", "text_hash", F.col("size").alias("n_shingles"),
        F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(F.col("set_id").isNotNull(), F.col("root")).alias("root"),
    )


def one_of_each(docs: DataFrame, **how) -> DataFrame:
    """One row of each component, with all columns: that of the smallest id, then text hash.

    Rows without a set are components of their own; of rows equal in id and text one stays.
    """
    found = jaccard_components(docs, **how)
    first = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("text_hash"))).alias("x")
    one = found.where("root is not null").groupBy("root").agg(first).select("root", "x.doc_id", "x.text_hash")
    again = found.groupBy("doc_id", "text_hash").agg(F.count("*").alias("n"), F.max("root").alias("root"))
    same = again["doc_id"].eqNullSafe(one["doc_id"]) & (again["text_hash"] == one["text_hash"]) & (again["root"] == one["root"])
    away = again.join(one, same, "left_anti").where("root is not null")
    go = stored(away.select("doc_id", "text_hash").union(again.where("n > 1").select("doc_id", "text_hash")).distinct(), "go")
    names = [fresh(docs, x) for x in ("text_hash", "go_id", "go_hash")]
    key, go_id, go_hash = names
    go = go.toDF(go_id, go_hash)
    hashed = docs.withColumn(key, F.xxhash64(F.coalesce("text", F.lit(""))))
    match = F.col("doc_id").eqNullSafe(F.col(go_id)) & (F.col(key) == F.col(go_hash))
    # Only rows that may go are shuffled.
    may_go = Among(go.select(F.xxhash64(go_id, go_hash).alias("key"))).column(F.xxhash64(F.col("doc_id").cast("long"), key))
    some = hashed.where(may_go)
    kept = hashed.where(~may_go).select(*docs.columns).union(some.join(go, match, "left_anti").select(*docs.columns))
    # Of rows that repeat as a whole group's first, or without a set, one comes back.
    gone = away.select(F.col("doc_id").alias("a_id"), F.col("text_hash").alias("a_hash"))
    back = again.where("n > 1").join(gone, F.expr("doc_id <=> a_id and text_hash = a_hash"), "left_anti")
    back = stored(back.select(F.col("doc_id").alias(go_id), F.col("text_hash").alias(go_hash)), "back")
    rows = F.struct(*[F.col(c) for c in docs.columns])
    some = some.join(back, match, "left_semi").groupBy("doc_id", key).agg(F.min_by(rows, F.xxhash64(*docs.columns)).alias("row"))
    return kept.union(some.select("row.*"))
