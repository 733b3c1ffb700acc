"""Sharding: minimum-cost-flow resharding of blocks.

Rows belong to blocks by a hash of their text, so equal texts share a block, and blocks
lie in the old shards. Block sizes are the only thing the driver sees, and their number
is a parameter. From old shard sizes and new capacities a flow of least cost, where a
byte costs 0 if it stays and 1 if it moves, says how many bytes go from each old shard to
each new one; whole blocks then carry the flow. A text of many bytes (one may be a third
of all rows) leaves its block for one of its own, which is split by row into parts, as
often as its size asks, so that no task numbers it alone; its parts are placed together
unless it is more than a twelfth of all bytes. A large block of the other texts is split
by their hash, so equal texts stay together.

Each row's place in its shard is its block's first place plus its rank in the block, so
no task numbers a whole shard. Texts are never shuffled: the plan works on ids, sizes and
hashes, and `rewrite` moves files of the shards that change.

A NULL text has size 1. Repeated rows are rows of their own with slots of their own; rows
that agree in everything may take each other's slot. An empty table gives an empty result.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from intentmill.llm.common import stored


def min_cost_flow(supply: list[int], capacity: list[int], cost: list[list[int]]) -> list[list[int]]:
    """Flow from sources to sinks that places all supply at the least total cost.

    Successive shortest paths on the residual graph; a handful of shards a side.
    """
    n, m = len(supply), len(capacity)
    flow = [[0] * m for _ in range(n)]
    left, room = list(supply), list(capacity)
    while any(left):
        far, come = {("s", i): 0 for i in range(n) if left[i]}, {}
        for _ in range(n + m):  # Bellman-Ford: residual arcs may have negative cost
            changed = False
            for i in range(n):
                for j in range(m):
                    a, b = ("s", i), ("t", j)
                    if a in far and far[a] + cost[i][j] < far.get(b, float("inf")):
                        far[b], come[b], changed = far[a] + cost[i][j], a, True
                    if flow[i][j] and b in far and far[b] - cost[i][j] < far.get(a, float("inf")):
                        far[a], come[a], changed = far[b] - cost[i][j], b, True
            if not changed:
                break
        ends = [("t", j) for j in range(m) if room[j] and ("t", j) in far]
        if not ends:
            raise ValueError("the capacities are less than the supply")
        end = node = min(ends, key=far.get)
        path = []
        while node in come:
            path.append((come[node], node))
            node = come[node]
        amount = min(left[node[1]], room[end[1]], *[flow[b[1]][a[1]] for a, b in path if a[0] == "t"])
        for a, b in path:
            if a[0] == "s":
                flow[a[1]][b[1]] += amount
            else:
                flow[b[1]][a[1]] -= amount
        left[node[1]] -= amount
        room[end[1]] -= amount
    return flow


@dataclass(frozen=True)
class Block:
    block: int
    part: int
    size: int
    rows: int
    old: int


def place(blocks: list[Block], n_old: int, n_new: int, whole: float = 1 / 12) -> list[int]:
    """The new shard of each block, sizes near equal, with the flow of fewest moved bytes.

    Parts of a block stay together if the block is at most that share of all bytes.
    """
    total = sum(b.size for b in blocks)
    sizes = defaultdict(int)
    for b in blocks:
        sizes[b.block] += b.size
    members = defaultdict(list)
    for k, b in enumerate(blocks):
        members[(b.block, -1 if sizes[b.block] <= whole * total else b.part)].append(k)
    units = [Block(*name, sum(blocks[k].size for k in own), 0, blocks[own[0]].old) for name, own in members.items()]
    shard = [0] * len(blocks)
    for own, j in zip(members.values(), _place_units(units, n_old, n_new)):
        for k in own:
            shard[k] = j
    return shard


def _place_units(units: list[Block], n_old: int, n_new: int) -> list[int]:
    total = sum(u.size for u in units)
    supply = [0] * n_old
    for u in units:
        supply[u.old] += u.size
    capacity = [total * (j + 1) // n_new - total * j // n_new for j in range(n_new)]
    cost = [[int(i != j) for j in range(n_new)] for i in range(n_old)]
    need = min_cost_flow(supply, capacity, cost)
    shard, load = [0] * len(units), [0] * n_new
    by_old = defaultdict(list)
    for k, u in enumerate(units):
        by_old[u.old].append(k)
    for i, own in by_old.items():
        heap = [(-need[i][j], j) for j in range(n_new) if need[i][j]]
        heapify(heap)
        for k in sorted(own, key=lambda k: (-units[k].size, units[k].block, units[k].part)):
            open_, j = heappop(heap)
            shard[k] = j
            load[j] += units[k].size
            heappush(heap, (open_ + units[k].size, j))
    _even_out(units, shard, load)
    return shard


def _even_out(blocks: list[Block], shard: list[int], load: list[int]) -> None:
    """Move single blocks from the fullest to the emptiest shard while that helps."""
    inside = defaultdict(set)
    for k, j in enumerate(shard):
        inside[j].add(k)
    for _ in range(1000):
        full, empty = max(range(len(load)), key=load.__getitem__), min(range(len(load)), key=load.__getitem__)
        gap = load[full] - load[empty]
        fits = [k for k in inside[full] if 0 < blocks[k].size < gap]
        if not fits:
            break
        k = min(fits, key=lambda k: (abs(2 * blocks[k].size - gap), blocks[k].block, blocks[k].part))
        shard[k] = empty
        inside[full].remove(k)
        inside[empty].add(k)
        load[full] -= blocks[k].size
        load[empty] += blocks[k].size


def reshard(
    docs: DataFrame, n_new: int = 8, n_old: int = 6, n_blocks: int = 8192, parts: int = 512
) -> DataFrame:
    """Per row: doc_id, size, text_crc32, old_shard, shard, slot.

    The old layout has `n_old` shards of consecutive blocks. A text of more than one
    `parts`-th of all bytes is split by row, and a block of more without such texts by
    hash, into pieces of about that size, so the driver sees at most n_blocks + 3 * parts
    rows.
    """
    narrow = stored(
        docs.select(
            docs["doc_id"].cast("long").alias("doc_id"),
            (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
            F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
            F.xxhash64("text").alias("hash"),
            F.monotonically_increasing_id().alias("row"),
        ).withColumn("home", F.pmod("hash", F.lit(n_blocks)).cast("int")),
        "sizes",
    )
    sums = narrow.groupBy("home").agg(F.sum("size").alias("size"))
    total = sums.agg(F.sum("size")).first()[0] or 0
    share = max(1, total // parts)
    pieces = F.ceil(F.col("size") / share).cast("int")
    full = stored(sums.where(F.col("size") > share), "full")  # 2 * parts blocks at most
    # Only texts of full blocks are summed one by one.
    inside = narrow.join(F.broadcast(full.select("home")), "home", "left_semi")
    by_text = inside.groupBy("hash").agg(F.sum("size").alias("size"), F.first("home").alias("home"))
    hot = stored(by_text.where(F.col("size") > share).withColumn("pieces", pieces), "hot")  # as few
    names = sorted((r.hash, r.home, r.pieces, r.size) for r in hot.toLocalIterator())
    own = docs.sparkSession.createDataFrame(
        [(h, n_blocks + k, n) for k, (h, _, n, _) in enumerate(names)], "hash long, own int, own_pieces int"
    )
    home_of = {n_blocks + k: home for k, (_, home, _, _) in enumerate(names)}
    gone = hot.groupBy("home").agg(F.sum("size").alias("gone"))
    cold = (
        full.join(F.broadcast(gone), "home", "left")
        .select("home", (F.col("size") - F.coalesce("gone", F.lit(0))).alias("size"))
        .select("home", F.greatest(pieces, F.lit(1)).alias("cold_pieces"))
    )
    by_row = F.pmod(F.hash("row"), F.col("own_pieces"))
    by_hash = F.pmod(F.hash("hash"), F.coalesce("cold_pieces", F.lit(1)))
    spread = narrow.join(F.broadcast(own), "hash", "left").join(F.broadcast(cold), "home", "left").select(
        "doc_id", "size", "text_crc32", "row", F.coalesce("own", "home").alias("block"),
        F.when(F.col("own").isNotNull(), by_row).otherwise(by_hash).alias("part"),
    )
    found = spread.groupBy("block", "part").agg(F.sum("size").alias("size"), F.count("*").alias("rows"))
    blocks = sorted(
        (Block(r.block, r.part, r.size, r.rows, home_of.get(r.block, r.block) * n_old // n_blocks) for r in found.toLocalIterator()),
        key=lambda b: (b.block, b.part),
    )
    shards = place(blocks, n_old, n_new) if blocks else []
    first, plan = [0] * n_new, []
    for b, j in zip(blocks, shards):
        plan.append((b.block, b.part, b.old, j, first[j]))
        first[j] += b.rows
    names = [("block", pa.int32()), ("part", pa.int32()), ("old_shard", pa.int32()), ("shard", pa.int32()), ("first", pa.int64())]
    columns = list(zip(*plan)) or [()] * len(names)
    planned = docs.sparkSession.createDataFrame(
        pa.table([pa.array(c, t) for c, (_, t) in zip(columns, names)], names=[n for n, _ in names])
    )
    order = Window.partitionBy("block", "part").orderBy("doc_id", "size", "text_crc32", "row")
    return (
        spread.withColumn("rank", F.row_number().over(order) - 1)
        .join(F.broadcast(planned), ["block", "part"])  # n_blocks + 3 * parts rows at most
        .select(
            "doc_id", "size", "text_crc32", "old_shard", "shard",
            (F.col("first") + F.col("rank")).cast("long").alias("slot"), "row",
        )
    )


def rewrite(docs: DataFrame, plan: DataFrame, path: str) -> list[int]:
    """Write, under one folder a shard, the shards that gain or lose rows; their numbers.

    `docs` must read the same rows in the same order as for the plan, whose `row` is
    their position; shards that keep exactly their rows need no new files.
    """
    changed = sorted(
        r[0]
        for r in plan.where("old_shard <> shard")
        .select(F.explode(F.array("old_shard", "shard"))).distinct().toLocalIterator()
    )
    placed = plan.select("row", "shard", "slot").where(F.col("shard").isin(changed))
    key = F.monotonically_increasing_id()
    (
        docs.withColumn("row", key).join(placed, "row").drop("row")
        .repartition("shard", F.floor(F.col("slot") / 100_000))
        .write.mode("overwrite").partitionBy("shard").parquet(path)
    )
    return changed
