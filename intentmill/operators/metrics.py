"""Label quality: counts of (human, model) label pairs, and what follows from them.

The table is read once, down to its two label columns, into a tally of a few dozen
rows: labels outside the class list are folded together, so its size is fixed by the
class list however dirty the labels are. Every metric is arithmetic on the tally.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from intentmill.functions.text import canonical_label
from intentmill.options import CLASSES, EvalOptions
from intentmill.sources.results import in_plan

_CLASS_FIELDS = (
    "class", "precision", "recall", "f1", "support", "judge_score", "cohen_kappa",
)


def pick_ai_column(df: DataFrame, candidates: tuple[str, ...]) -> str:
    """The first candidate that exists; decided while planning."""
    for name in candidates:
        if name in df.columns:
            return name
    raise ValueError(f"no model label column among {candidates}")


def any_label(df: DataFrame, human: str = "human_label_gold") -> Column:
    """Whether any row has a human label; every task stops at its first one."""
    found = df.where(F.col(human).isNotNull()).limit(1).select(F.lit(True))
    return found.scalar().isNotNull()


def drop_missing_gold(df: DataFrame, human: str = "human_label_gold") -> DataFrame:
    """Drop rows without a human label, unless no row has one."""
    if human not in df.columns:
        return df
    return df.where(F.col(human).isNotNull() | ~any_label(df, human))


def label_tally(
    df: DataFrame, options: EvalOptions = EvalOptions(), ai: str | None = None
) -> DataFrame:
    """Counts by (has_gold, y, p, same).

    `y` and `p` are NULL outside the class list; `same` tells whether the labels were
    equal, in the list or not.
    """
    ai = ai or pick_ai_column(df, options.ai_columns)
    human = options.human_column
    gold = F.col(human) if human in df.columns else F.lit(None).cast("string")
    pairs = df.select(
        gold.isNotNull().alias("has_gold"),
        canonical_label(gold).alias("y"),
        canonical_label(F.col(ai)).alias("p"),
    )
    return (
        pairs.groupBy(
            "has_gold",
            F.when(F.col("y").isin(*options.allowed), F.col("y")).alias("y"),
            F.when(F.col("p").isin(*options.allowed), F.col("p")).alias("p"),
            F.col("y").eqNullSafe(F.col("p")).alias("same"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )


def judge_tally(judged: DataFrame, allowed: tuple[str, ...] = CLASSES) -> DataFrame:
    """Counts of judged rows by (p, y, same): model label, judge label, verdict.

    `y` is NULL where the judge gave no label of its own.
    """
    label = (
        F.col("judge_label") if "judge_label" in judged.columns
        else F.lit(None).cast("string")
    )
    known = canonical_label(F.col("ai_label"))
    return judged.groupBy(
        F.when(label.isin(*allowed), label).alias("y"),
        F.when(known.isin(*allowed), known).alias("p"),
        (F.col("judge_decision") == "correct").alias("same"),
    ).agg(F.count(F.lit(1)).alias("n"))


def confusion(tally: DataFrame, allowed: tuple[str, ...] = CLASSES) -> DataFrame:
    """Every (human, model) pair of classes with its count, zeros included."""
    grid = in_plan(
        tally.sparkSession,
        [{"y": y, "p": p} for y in allowed for p in allowed],
        {"y": "string", "p": "string"},
    )
    # a filter here would be pushed into the scan, and whatever made the labels with it
    counts = (
        tally.selectExpr("coalesce(y, '') y", "coalesce(p, '') p", "if(has_gold, n, 0L) n")
        .groupBy("y", "p").agg(F.sum("n").alias("n"))
    )
    return grid.join(counts, ["y", "p"], "left").na.fill(0, ["n"])


# What one row of the tally adds to the counts of its human label, of its model label
# and of the whole table. `kept` rows count once any human label is known, `verdict`
# rows come from the judge.
_COUNTS = {
    "hit": ("kept and y = p", None, None),
    "gold_in": ("kept and p is not null", None, None),
    "gold": ("kept", None, None),
    "judge_hit": ("verdict and y = p", None, None),
    "judge_in": ("verdict and p is not null", None, None),
    "ai_in": (None, "kept and y is not null", None),
    "ai": (None, "kept", None),
    "ai_any": (None, "not verdict", None),
    "judged_in": (None, "verdict and y is not null", None),
    "judged": (None, "verdict", "verdict and p is not null"),
    "approved": (None, "verdict and same", "verdict and p is not null and same"),
    "n": (None, None, "kept"),
    "same_n": (None, None, "kept and same"),
    "n_any": (None, None, "not verdict"),
    "n_gold": (None, None, "has_gold"),
}


def _class_counts(
    tally: DataFrame, judged: DataFrame | None, options: EvalOptions
) -> DataFrame:
    """One row of counts per class and one for `ALL`, in reporting order (`ord`)."""
    kept = "has_gold" if options.drop_missing_gold else "true"
    pairs = tally
    if "verdict" not in tally.columns:
        pairs = tally.selectExpr("false verdict", f"{kept} kept", "has_gold", "y", "p", "same", "n")
    if judged is not None:
        pairs = pairs.union(
            judged.selectExpr("true", "false", "false", "y", "p", "same", "n")
        )

    def share(of: str, place: int) -> str:
        counts = [
            f"if({conditions[place]}, n, 0L)" if conditions[place] else "0L"
            for conditions in _COUNTS.values()
        ]
        return f"{of}, {', '.join(counts)}"

    shares = ", ".join((share("y", 0), share("p", 1), share("'ALL'", 2)))
    sums = (
        pairs.selectExpr(f"stack(3, {shares}) as (class, {', '.join(_COUNTS)})")
        .groupBy("class")
        .agg(*[F.sum(name).alias(name) for name in _COUNTS])
    )
    names = in_plan(
        tally.sparkSession,
        [{"ord": i, "class": c} for i, c in enumerate((*options.allowed, "ALL"))],
        {"ord": "bigint", "class": "string"},
    )
    return names.join(sums, "class", "left").na.fill(0)


def _kappa(n: str, agreed: str, chance: str) -> str:
    """Cohen's kappa from whole numbers: `chance` is the sum of marginal products.

    Squares of counts outgrow 64 bits, so the products are decimals.
    """
    n, agreed = f"cast({n} as decimal(19,0))", f"cast({agreed} as decimal(19,0))"
    return (
        f"if({n} * {n} = {chance}, 0D, "
        f"cast({n} * {agreed} - {chance} as double) / cast({n} * {n} - {chance} as double))"
    )


def _product(a: str, b: str) -> str:
    return f"cast({a} as decimal(19,0)) * cast({b} as decimal(19,0))"


def measures(
    tally: DataFrame, judged: DataFrame | None = None, options: EvalOptions = EvalOptions()
) -> DataFrame:
    """The metrics of each class, and on the `ALL` row those of the whole table.

    `judged` is a `judge_tally`, or None if no judge was asked; `tally` may be one of
    `judge.both_tallies`, which has the verdicts too.
    """
    total = "class = 'ALL'"
    rows = (
        "over (partition by 0 order by ord "
        "rows between unbounded preceding and unbounded following)"
    )

    def of_table(name: str) -> str:
        return f"sum(if({total}, {name}, null)) {rows}"

    def over_classes(value: str) -> str:
        return f"sum(if({total}, null, {value})) {rows}"

    counted = (
        _class_counts(tally, judged, options)
        .selectExpr(
            "*",
            f"{of_table('n')} n_rows",
            f"{of_table('n_gold')} > 0 human",
            f"{over_classes('hit')} agreed",
            f"{over_classes('gold_in')} inside",
            f"{over_classes(_product('gold_in', 'ai_in'))} chance",
            f"{over_classes('judge_hit')} judge_agreed",
            f"{over_classes('judge_in')} judge_inside",
            f"{over_classes(_product('judge_in', 'judged_in'))} judge_chance",
            "if(ai_in = 0, 0D, hit / ai_in) p",
            "if(gold_in = 0, 0D, hit / gold_in) r",
        )
        .selectExpr("*", "if(p + r = 0, 0D, 2 * p * r / (p + r)) f")
        .selectExpr("*", *[f"{over_classes(c)} / {len(options.allowed)}D macro_{c}" for c in "prf"])
    )
    against_rest = _kappa(
        "n_rows", "(n_rows - gold - ai + 2 * hit)",
        f"({_product('gold', 'ai')} + {_product('(n_rows - gold)', '(n_rows - ai)')})",
    )
    asked = judged is not None or "verdict" in tally.columns
    audited = asked and options.judge_mode != "compare_to_human"
    prf, kappa = ("human" if on else "false" for on in (options.use_prf, options.use_kappa))
    mode = F.lit(options.judge_mode if options.judge_on else None).cast("string")
    return counted.selectExpr(
        "ord",
        "class",
        *[
            f"if({prf}, if({total}, macro_{c}, {c}), null) {name}"
            for c, name in (("p", "precision"), ("r", "recall"), ("f", "f1"))
        ],
        f"if(human, if({total}, n_rows, if({prf}, gold_in, null)), "
        f"if({total}, n_any, ai_any)) support",
        "approved / nullif(judged, 0) judge_score",
        f"if({kappa}, if({total}, {_kappa('inside', 'agreed', 'chance')}, {against_rest}), null)"
        " cohen_kappa",
        f"if({prf}, if(n_rows = 0, 0D, same_n / n_rows), null) accuracy",
        (_kappa("judge_inside", "judge_agreed", "judge_chance") if audited
         else "cast(null as double)") + " ai_judge_kappa",
        "human has_human_labels",
    ).withColumn("judge_mode", mode)


def metrics_table(measured: DataFrame) -> DataFrame:
    """The class rows and the `ALL` row, in fixed column order.

    Without a kappa against human labels the `ALL` row shows the one against the judge.
    """
    kappa = F.when(
        F.col("class") == "ALL", F.coalesce("cohen_kappa", "ai_judge_kappa")
    ).otherwise(F.col("cohen_kappa"))
    return measured.withColumn("cohen_kappa", kappa).select(*_CLASS_FIELDS)


def by_class(measured: DataFrame, *fields: str) -> DataFrame:
    return measured.where(F.col("class") != "ALL").select("class", *fields)


def summary(measured: DataFrame) -> DataFrame:
    """The metrics of the whole table, one row."""
    return measured.where(F.col("class") == "ALL").select(
        "accuracy",
        F.col("precision").alias("macro_precision"),
        F.col("recall").alias("macro_recall"),
        F.col("f1").alias("macro_f1"),
        "cohen_kappa", "judge_score", "ai_judge_kappa", "has_human_labels", "judge_mode",
    )
