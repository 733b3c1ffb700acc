"""Exact, repeatable samples as a row predicate.

Rows are ordered by a hash of their id, and the sample is the smallest hashes. Without
classes the cut-off hash is bounded by mergeable quantile sketches and then counted exactly
between the bounds, in two passes as a rule. Per class it is found from counts: a histogram
over leading hash digits, then finer ones inside the bucket that holds the cut. The sample
itself is then a filter on one scan: nothing is sorted, ranked or gathered, whatever its
size, and the same rows come out on any partitioning. The frame is read a few times, so it
should be a stored table or cheap to compute, and give the same rows each time.

Histograms, quotas and cut-offs of classes are tables, stored between rounds, for any number of
classes; a round leaves at most 4,096 counts per class. Only single numbers reach the
driver, and for a sample without classes some thirty rows of 257 quantiles and its cut-off.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from intentmill.functions.text import canonical_label
from intentmill.sources.results import save_step

_COPIES_PER_ROW = 10_000
_DIGITS = 32                 # length of a hex digest
_FINER = 3                   # digits added in a round, so 4,096 counts per class
_PAST_BUCKET = "g"           # sorts after every hex digit
_HEAD = 15                   # hex digits that fit in a long
_DETAIL = 1024               # size parameter of a sketch: ranks are right to about half a per cent
_GRID = 256                  # quantiles read from a sketch
_MARGIN = 0.01               # share of a sketch's rows left on each side of the cut
_EXACT = 100_000             # more rows than this between the bounds are sketched again


def rank_hash(seed: int | str, column: str = "qid") -> Column:
    """Hex digest that orders the rows of a sample."""
    return F.md5(
        F.concat(
            F.lit(f"{seed}:"), F.coalesce(F.col(column).cast("string"), F.lit(""))
        )
    )


def _row_digest(columns: list[str]) -> Column:
    return F.md5(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}))


def _bucket(digest: Column) -> Column:
    """Leading zeros and the digit after them.

    No bucket name is a prefix of another, so bucket order is hash order. However deep
    the cut lies, its bucket holds at most half of the rows up to its end; and a task
    with many rows still counts only a few dozen buckets.
    """
    zeros = F.length(digest) - F.length(F.ltrim(digest, F.lit("0")))
    return F.substring(digest, F.lit(1), zeros + 1)


def _counts(keyed: DataFrame, bucket: Column) -> DataFrame:
    return keyed.groupBy("cls", bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def _reaching(counts: DataFrame, quota: str, order: str) -> DataFrame:
    """Per class the count in which `quota` is reached, with `need`, what is taken of its `n`."""
    upto = F.sum("n").over(W.partitionBy("cls").orderBy(order))
    before = F.col("upto") - F.col("n")
    return (
        counts.withColumn("upto", upto)
        .where((F.col("upto") >= F.col(quota)) & (before < F.col(quota)))
        .withColumn("need", F.col(quota) - before)
    )


def _last_hashes(keyed: DataFrame, counts: DataFrame, quotas: DataFrame) -> DataFrame:
    """Per class with more rows than its quota: `cut`, and of its `total` rows how many to `take`.

    `cut` is a whole hash, or the beginning of one if all rows that begin so are taken.
    `quotas` has the classes' row counts as `size`.
    """
    full = quotas.where("size > quota").select("cls", "quota")
    edges = save_step(
        _reaching(counts.join(full, "cls"), "quota", "bucket").select(
            "cls", "bucket", F.col("bucket").alias("cut"), "need", "n"
        )
    )
    done = None
    while True:
        is_open = (F.col("need") < F.col("n")) & (F.length("cut") < _DIGITS)
        settled = edges.where(~is_open)
        done = settled if done is None else done.unionByName(settled)
        most = edges.where(is_open).agg(F.max("n")).first()[0]
        if most is None:
            return done.select("cls", "cut", F.col("need").alias("take"), F.col("n").alias("total"))
        depth = F.lit(_DIGITS) if most <= 16**_FINER else F.length("cut") + _FINER
        inside = (
            keyed.withColumn("bucket", _bucket(F.col("h")))
            .join(edges.where(is_open).drop("n"), ["cls", "bucket"])
            .where(F.col("h").startswith(F.col("cut")))
            .groupBy("cls", "bucket", "need", F.substring(F.col("h"), F.lit(1), depth).alias("finer"))
            .agg(F.count(F.lit(1)).alias("n"))
            .withColumnRenamed("need", "open")
        )
        edges = save_step(
            _reaching(inside, "open", "finer").select("cls", "bucket", F.col("finer").alias("cut"), "need", "n")
        )


@dataclass
class _Cut:
    """A population split in two: the rows up to each class's cut-off, and the others."""

    marked: DataFrame       # every row with its hashes and its class's cut-off
    columns: list[str]
    bound: str | None       # no row of the sample has a larger hash
    copies: bool            # a cut-off falls among identical rows
    tied: bool              # a cut-off falls among rows with the same hash

    @property
    def inside(self) -> Column:
        c = {name: F.col(f"_{name}") for name in
             ("listed", "h", "cut", "whole", "digest", "cut2", "whole2")}
        tie = c["whole"] | (c["digest"] < c["cut2"]) | (
            (c["digest"] == c["cut2"]) & c["whole2"]
        )
        return c["listed"] & (
            c["cut"].isNull() | (c["h"] < c["cut"]) | ((c["h"] == c["cut"]) & tie)
        )

    @property
    def _is_copy(self) -> Column:
        return F.coalesce(
            (F.col("_h") == F.col("_cut"))
            & (F.col("_digest") == F.col("_cut2"))
            & ~F.col("_whole2"),
            F.lit(False),
        )

    def _copied(self, count: str) -> DataFrame:
        """The identical rows at the cut, made from one of them and their number."""
        step = F.lit(_COPIES_PER_ROW)
        left = F.col("_n") - F.col("_part") * step
        return (
            self.marked.where(self._is_copy)
            .groupBy("_cls", F.col(count).alias("_n"))
            .agg(F.any_value(F.struct(*self.columns)).alias("_row"))
            .where("_n > 0")
            .withColumn("_part", F.explode(F.sequence(F.lit(0), F.floor((F.col("_n") - 1) / step))))
            .repartition("_cls", "_part")
            .select("_row", F.explode(F.sequence(F.lit(1), F.least(step, left))).alias("_i"))
            .select("_row.*")
        )

    def taken(self) -> DataFrame:
        rows = self.marked
        if self.bound is not None:
            rows = rows.where(F.col("_h") <= self.bound)
        rows = rows.where(self.inside).select(*self.columns)
        return rows.unionByName(self._copied("_take2")) if self.copies else rows

    def rest(self) -> DataFrame:
        outside = ~F.coalesce(self.inside, F.lit(False))
        if not self.copies:
            return self.marked.where(outside).select(*self.columns)
        return (
            self.marked.where(outside & ~self._is_copy)
            .select(*self.columns)
            .unionByName(self._copied("_spare2"))
        )


def _cut(df: DataFrame, cls: Column, digest: Column, counts: DataFrame, quotas: DataFrame) -> _Cut:
    """Split `df` at the quotas (cls, size, quota) of smallest digests per class."""
    keyed = df.select(cls.alias("cls"), digest.alias("h"))
    cuts = save_step(_last_hashes(keyed, counts, quotas))
    ties = cuts.where("take < total").select(
        "cls", "cut", F.col("total").alias("size"), F.col("take").alias("quota")
    )
    tied = not ties.isEmpty()
    row_digest, finer = F.lit(None).cast("string"), None
    if tied:
        # several rows share the cut-off hash: go on by a digest of the whole row
        row_digest = _row_digest(df.columns)
        rows = (
            df.select(cls.alias("cls"), digest.alias("cut"), row_digest.alias("h"))
            .join(ties.select("cls", "cut"), ["cls", "cut"])
            .select("cls", "h")
        )
        finer = _last_hashes(rows, _counts(rows, _bucket(F.col("h"))), ties)
    else:
        finer = cuts.limit(0)
    end = lambda part, whole: F.when(whole, F.concat(part, F.lit(_PAST_BUCKET))).otherwise(part)
    whole, whole2 = F.col("take") == F.col("total"), F.col("take2") == F.col("total2")
    table = save_step(
        quotas.select("cls")
        .join(cuts, "cls", "left")
        .join(finer.toDF("cls", "cut2", "take2", "total2"), "cls", "left")
        .select(
            F.col("cls").alias("_cls"),
            F.lit(True).alias("_listed"),
            end(F.col("cut"), whole).alias("_cut"),
            whole.alias("_whole"),
            end(F.col("cut2"), whole2).alias("_cut2"),
            whole2.alias("_whole2"),
            F.col("take2").alias("_take2"),
            (F.col("total2") - F.col("take2")).alias("_spare2"),
        )
    )
    bounds = table.agg(F.max("_cut"), F.count("*") - F.count("_cut"), F.count(F.when(F.col("_spare2") > 0, 1))).first()
    # by class and first digit of the hash: a class of very many rows is sixteen groups
    digits = F.explode(F.array(*[F.lit(c) for c in "0123456789abcdef"]))
    marked = (
        df.withColumns({"_cls": cls, "_h": digest, "_digest": row_digest})
        .withColumn("_digit", F.substring("_h", 1, 1))
        .join(table.withColumn("_digit", digits), ["_cls", "_digit"], "left")
        .drop("_digit")
    )
    return _Cut(
        marked, df.columns, bound=None if bounds[1] else bounds[0], copies=bounds[2] > 0, tied=tied
    )


def _value(digest: Column) -> Column:
    """The first 15 hex digits as a number: same order as the digest, ties aside."""
    return F.conv(F.substring(digest, 1, _HEAD), 16, 10).cast("long")


def _kth_hash(hashes: DataFrame, k: int) -> tuple[str, int, int] | None:
    """The k-th smallest digest `h`, how many of its rows to take, and how many there are.

    None if there are no more than k rows. One pass makes a quantile sketch per number of
    leading zeros, so the error is relative to k and not to all rows. The sketches bound
    the cut; the next pass counts what lies below the bounds and, digest by digest, what
    lies between them. Bounds that leave too much are sketched again; bounds that miss the
    cut, which the counts show, are widened. So the result is exact whatever the sketch says.
    """
    value = _value(F.col("h"))
    zeros = F.length("h") - F.length(F.ltrim("h", F.lit("0")))
    ranks = F.expr(f"array({', '.join(f'{i / _GRID}D' for i in range(_GRID + 1))})")
    low, high, margin, total = 0, 16**_HEAD - 1, _MARGIN, None
    while True:
        near = hashes.where(value <= high)
        found = (
            near.groupBy(F.when(value >= low, zeros).alias("zeros"))
            .agg(
                F.count(F.lit(1)).alias("n"),
                F.kll_sketch_agg_bigint(value, F.lit(_DETAIL)).alias("sketch"),
            )
            .select("zeros", "n", F.kll_sketch_get_quantile_bigint("sketch", ranks).alias("grid"))
            .collect()
        )
        seen = sum(r.n for r in found)
        if total is None and k >= seen:
            return None
        total = seen if total is None else total
        below = sum(r.n for r in found if r.zeros is None)
        bounds, inside = None, 0
        for r in sorted((r for r in found if r.zeros is not None), key=lambda r: -r.zeros):
            if below < k <= below + r.n:
                bounds, inside = r, r.n
                break
            below += r.n
        if bounds is None:  # the range missed the cut
            low, high, margin = 0, 16**_HEAD - 1, min(1.0, margin * 4)
            continue
        while True:
            at, wide = (k - below) / inside, margin + 1 / _GRID
            first, last = math.floor((at - wide) * _GRID), math.ceil((at + wide) * _GRID)
            before = low, high
            low = max(low, bounds.grid[first] if first > 0 else _first_of(bounds.zeros))
            high = min(high, bounds.grid[last] if last < _GRID else _last_of(bounds.zeros))
            if 2 * wide * inside > _EXACT and margin < 0.25 and before != (low, high) and low < high:
                break  # still many: sketch what lies between the bounds
            counts = (
                hashes.where(value <= high)
                .groupBy(F.when(value >= low, F.col("h")).otherwise("").alias("finer"))
                .agg(F.count(F.lit(1)).alias("n"))
                .coalesce(1)  # a bounded number of digests: the window needs no second shuffle
                .withColumns({"cls": F.lit(""), "open": F.lit(k)})
            )
            hit = _reaching(counts, "open", "finer").select("finer", "need", "n").first()
            if hit is not None and hit.finer:
                return hit.finer, hit.need, hit.n
            low, high, margin = *before, min(1.0, margin * 4)


def _first_of(zeros: int) -> int:
    """The smallest value whose digest begins with so many zeros."""
    return 16 ** (_HEAD - 1 - zeros) if zeros < _HEAD else 0


def _last_of(zeros: int) -> int:
    return 16 ** (_HEAD - zeros) - 1 if zeros < _HEAD else 0


def _split(df: DataFrame, digest: Column, k: int) -> _Cut | None:
    """Split `df` after its k smallest digests; None if it has no more rows than that."""
    edge = _kth_hash(df.select(digest.alias("h")), k)
    if edge is None:
        return None
    cut, take, total = edge
    row_digest, cut2, take2, total2 = F.lit(None).cast("string"), None, None, None
    if take < total:
        # several rows share the cut-off hash: go on by a digest of the whole row
        row_digest = _row_digest(df.columns)
        cut2, take2, total2 = _kth_hash(df.where(digest == cut).select(row_digest.alias("h")), take)
    values = {
        "_cls": ("", "string"), "_listed": (True, "boolean"),
        "_cut": (cut, "string"), "_whole": (take == total, "boolean"),
        "_cut2": (cut2, "string"), "_whole2": (take2 == total2, "boolean"),
        "_take2": (take2, "long"), "_spare2": (total2 - take2 if total2 else None, "long"),
    }
    marked = df.withColumns(
        {"_h": digest, "_digest": row_digest}
        | {name: F.lit(value).cast(kind) for name, (value, kind) in values.items()}
    )
    return _Cut(marked, df.columns, bound=cut, copies=take2 != total2, tied=take < total)


def random_sample(df: DataFrame, k: int | None, seed: int = 42) -> DataFrame:
    """Exactly min(k, n) rows without replacement; all rows if no size is given."""
    if k is None:
        return df
    if k <= 0:
        return df.limit(0)
    split = _split(df, rank_hash(seed), k)
    return df if split is None else split.taken()


def balanced_sample(df: DataFrame, k: int, by: str = "label", seed: int = 42) -> DataFrame:
    """Exactly min(k, n) rows, spread evenly over the classes of `by`.

    Every class gets k div m rows and the first k mod m classes by name one more. A
    class with fewer rows gives all it has; what is then short is filled at random
    from all rows left, those without a class included. If there are more classes than
    rows to take, the first k classes get a row each.
    """
    if k <= 0:
        return df.limit(0)
    cls, digest = canonical_label(F.col(by)), rank_hash(seed)
    counts = save_step(_counts(df.select(cls.alias("cls"), digest.alias("h")), _bucket(F.col("h"))))
    by_class = counts.groupBy("cls").agg(F.sum("n").alias("size"))
    n, classes = by_class.agg(F.sum("size"), F.count("cls")).first()
    if k >= (n or 0):
        return df
    if not classes:
        return random_sample(df, k, seed)
    named = by_class.where("cls is not null")
    base, extra = divmod(k, classes)
    quota = F.lit(base).cast("long")
    if extra:
        last = named.select("cls").orderBy("cls").limit(extra).agg(F.max("cls")).first()[0]
        quota = quota + (F.col("cls") <= last).cast("long")
    quotas = save_step(named.withColumn("quota", quota).where("quota > 0"))
    taken = quotas.agg(F.sum(F.least("size", "quota"))).first()[0]
    split = _cut(df, cls, digest, counts, quotas)
    return split.taken() if taken == k else _top_up(split, k - taken, seed)


def _top_up(split: _Cut, short: int, seed: int) -> DataFrame:
    """The sample plus `short` of the rows outside it.

    Another salt ranks these: with the first one, rows that have no class and so
    never competed would win too often.
    """
    digest = rank_hash(f"{seed}:topup")
    rest = split.rest()
    extra = _split(rest, digest, short)
    if extra is None:
        return split.taken().unionByName(rest)
    if split.copies or extra.tied:
        return split.taken().unionByName(extra.taken())
    # both parts are row predicates, so one scan serves them
    return split.marked.where(
        F.coalesce(split.inside, F.lit(False)) | (digest <= extra.bound)
    ).select(*split.columns)


def sample_queries(df: DataFrame, k: int | None, seed: int = 42) -> DataFrame:
    """All rows if no size is given, a balanced sample if rows are labelled, else a plain one."""
    if not k or k <= 0:
        return df
    if "label" in df.columns:
        return balanced_sample(df, k, "label", seed)
    return random_sample(df, k, seed)
