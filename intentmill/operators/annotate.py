"""Annotation: replies from a table, from cue words or from a function."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from intentmill.functions.cues import CUE_WORDS, has_cue
from intentmill.functions.text import clean_query
from intentmill.options import AnnotateOptions
from intentmill.sources.results import Steps

FAILED_REPLY = '{"type": "abstain", "confidence": 0.0}'
TRIES = 2
PROVENANCE = ("model_name", "provider", "prompt_version", "taxonomy_version")


def needs_annotation(df: DataFrame) -> Column:
    """No label yet, or sent back by validation; absent columns count as NULL."""
    unlabelled = F.col("ai_label").isNull() if "ai_label" in df.columns else F.lit(True)
    if "needs_retry" not in df.columns:
        return unlabelled
    return unlabelled | F.coalesce(F.col("needs_retry"), F.lit(False))


def replay_join(queries: DataFrame, replies: DataFrame) -> DataFrame:
    """Each query with its stored replies; `pending_requests` finds those without any.

    A query may have very many replies. An inner join lets adaptive execution split
    such a partition on either side, which an outer join would not. Where only the
    outcome is wanted, vote first and join the result.
    """
    return queries.join(replies, "qid")


def with_provenance(rows: DataFrame, options: AnnotateOptions = AnnotateOptions()) -> DataFrame:
    return rows.withColumns({name: F.lit(getattr(options, name)) for name in PROVENANCE})


def rule_annotate(queries: DataFrame, cleaned: bool = False) -> DataFrame:
    """Add `ai_label` and `ai_confidence` from cue words; `cleaned` queries are taken as is.

    The first class with a cue wins. Confidence is 0.9 if it is the only one with a
    cue, 0.7 if there are others, 0.4 if no class has one.
    """
    text = F.col("query") if cleaned else clean_query(F.col("query"))
    padded = F.concat(F.lit(" "), text, F.lit(" "))
    marked = (
        queries.withColumn("_words", padded)
        # most texts hold no cue at all: one look tells, before asking class by class
        .withColumn("_any", has_cue(F.col("_words"), *CUE_WORDS))
        .withColumns(
            {f"_{name}": F.col("_any") & has_cue(F.col("_words"), name) for name in CUE_WORDS}
        )
    )
    label, found = F.lit("abstain"), F.lit(0)
    for name in reversed(CUE_WORDS):
        label = F.when(F.col(f"_{name}"), F.lit(name)).otherwise(label)
        found = found + F.coalesce(F.col(f"_{name}"), F.lit(False)).cast("int")
    return marked.select(
        *queries.columns,
        label.alias("ai_label"),
        F.when(found == 0, 0.4).when(found == 1, 0.9).otherwise(0.7).alias("ai_confidence"),
    )


def pending_requests(rows: DataFrame) -> DataFrame:
    """Rows without an accepted label, with the number of the attempt to make next.

    `rows` is the query log after the fold: `ai_label`, `needs_retry`, `retry_count`.
    """
    return rows.where(needs_annotation(rows)).select(
        "qid",
        F.coalesce(F.col("retry_count") + 1, F.lit(0)).alias("attempt"),
        "query",
    )


def merge_labels(
    rows: DataFrame, labels: DataFrame, options: AnnotateOptions | None = None
) -> DataFrame:
    """Put new labels (qid, ai_label, ai_confidence) into the rows that wait for one.

    A merged retry counts up `retry_count`; other rows, and rows no label has come
    for, stay as they are. With `options`, merged rows get the provenance of the new labels.
    """
    new = labels.select(
        "qid", F.col("ai_label").alias("_label"), F.col("ai_confidence").alias("_confidence")
    )
    for name, kind in (("ai_label", "string"), ("ai_confidence", "double"),
                       ("needs_retry", "boolean"), ("retry_count", "int")):
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None).cast(kind))
    taken = needs_annotation(rows) & F.col("_label").isNotNull()
    retried = F.coalesce(F.col("needs_retry"), F.lit(False))
    return (
        rows.join(new, "qid", "left")
        .withColumn("_taken", taken)
        .withColumns(
            {
                "ai_label": F.when(F.col("_taken"), F.col("_label")).otherwise(F.col("ai_label")),
                "ai_confidence": F.when(F.col("_taken"), F.col("_confidence")).otherwise(
                    F.col("ai_confidence")
                ),
                "retry_count": F.when(
                    F.col("_taken") & retried, F.coalesce("retry_count", F.lit(0)) + 1
                ).otherwise(F.col("retry_count")),
                "needs_retry": F.when(F.col("_taken"), F.lit(False)).otherwise(
                    F.col("needs_retry")
                ),
            }
        )
        .withColumns(_merged_provenance(rows, options))
        .drop("_label", "_confidence", "_taken")
    )


def _merged_provenance(rows: DataFrame, options: AnnotateOptions | None) -> dict[str, Column]:
    if options is None:
        return {}

    def merged(name: str) -> Column:
        old = F.col(name) if name in rows.columns else F.lit(None).cast("string")
        return F.when(F.col("_taken"), F.lit(getattr(options, name))).otherwise(old)

    return {name: merged(name) for name in PROVENANCE}


def ask_model(
    requests: DataFrame,
    ask: Callable[[str, str], str],
    tries: int = TRIES,
    failed: str = FAILED_REPLY,
    parallel: int | None = None,
    concurrency: int = 1,
    slices: int = 1,
) -> DataFrame:
    """Replies from `ask(system_prompt, prompt)`, asked by `parallel` tasks, `concurrency` calls at a time in each.

    Requests are dealt out by their keys, as many tasks as the session has cores if
    nothing else is said: a small file is one partition, which one core would serve. A
    prompt is tried again if the call raises; after the last try the reply is
    `failed`. A lost task asks again, so store the result before using it; with at least so many
    `slices`, that many smaller tasks follow one another and a lost one repeats its slice alone. With a `concurrency`
    above 1, `ask` is called from several threads; at most that many prompts wait for a reply, and
    rows keep their order.
    """
    keys = [c for c in requests.columns if c not in ("system_prompt", "prompt")]
    schema = T.StructType(
        [requests.schema[c] for c in keys] + [T.StructField("raw", T.StringType())]
    )

    def reply(system: str, prompt: str) -> str:
        for _ in range(tries):
            try:
                return ask(system, prompt) or ""
            except Exception:
                continue
        return failed

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(concurrency) as threads:
            for batch in batches:
                raw = list(threads.map(reply, batch["system_prompt"], batch["prompt"]))
                yield batch[keys].assign(raw=pd.Series(raw, index=batch.index, dtype="object"))

    tasks = parallel or requests.sparkSession.sparkContext.defaultParallelism
    return requests.repartition(max(tasks, slices), *keys).mapInPandas(run, schema)


def ask_in_commits(
    steps: Steps,
    name: str,
    requests: DataFrame,
    n: int,
    ask: Callable[[str, str], str],
    tries: int = TRIES,
    failed: str = FAILED_REPLY,
    options: AnnotateOptions = AnnotateOptions(),
) -> DataFrame:
    """As `ask_model` for `n` stored requests, with replies stored about every `commit_rows` calls.

    Requests are dealt out by a hash of their keys, so each commit holds the same ones
    whenever the run is started again; only commits without a mark are asked for. Inside a
    commit a task has about `slice_rows` calls, which is all that a lost task repeats.
    """
    keys = [c for c in requests.columns if c not in ("system_prompt", "prompt")]
    commits = max(1, -(-n // options.commit_rows))
    slices = -(-n // (commits * options.slice_rows))
    dealt: list[DataFrame] = []

    def asked(i: int) -> DataFrame:
        if not dealt:
            dealt.append(_dealt(requests, keys, commits, slices, f"{steps.out}/{name}-dealt"))
        mine = dealt[0].where(F.col("_commit") == i).drop("_commit")
        return ask_model(mine, ask, tries, failed, options.parallel, options.concurrency, slices)

    unanswered = F.col("raw") == failed
    parts = [
        steps.table(f"{name}/commit={i}", lambda i=i: asked(i), commits, tries, unanswered=unanswered)
        for i in range(commits)
    ]
    if commits == 1:
        return parts[0]
    paths = [f"{steps.out}/{name}/commit={i}" for i in range(commits)]
    return requests.sparkSession.read.schema(parts[0].schema).parquet(*paths)


def _dealt(requests: DataFrame, keys: list[str], commits: int, slices: int, path: str) -> DataFrame:
    """Requests with their `_commit`; if there are several, a folder each, so that one is read alone."""
    marked = requests.withColumn("_commit", F.pmod(F.xxhash64(*keys), F.lit(commits)))
    if commits == 1:
        return marked
    part = F.pmod(F.xxhash64(*keys, F.lit("part")), F.lit(slices))
    marked.repartition("_commit", part).write.partitionBy("_commit").mode("overwrite").parquet(path)
    return requests.sparkSession.read.schema(marked.schema).parquet(path)
