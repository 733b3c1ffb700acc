"""Loading step: from a raw query log to clean, labelled rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from intentmill.functions.text import clean_query
from intentmill.operators.sampling import sample_queries
from intentmill.options import QUERY_LOG_COLUMNS, REQUIRED_COLUMNS, LoadOptions
from intentmill.sources.tables import check_columns


def keep_columns(df: DataFrame, wanted: tuple[str, ...] | None = None) -> DataFrame:
    """The wanted columns that exist, in wanted order.

    Comes before the split filter and the sample: leaving out `data_split` turns the
    filter off, leaving out `label` turns balancing off.
    """
    return df.select(*[c for c in (wanted or QUERY_LOG_COLUMNS) if c in df.columns])


def drop_missing_keys(df: DataFrame) -> DataFrame:
    return df.na.drop(subset=[c for c in REQUIRED_COLUMNS if c in df.columns])


def filter_split(df: DataFrame, split: str) -> DataFrame:
    """Rows of one data split, compared without case; `all` keeps every row."""
    if "data_split" not in df.columns or split.lower() == "all":
        return df
    return df.where(F.lower("data_split") == split.lower())


def rename_labels(df: DataFrame) -> DataFrame:
    """Label columns to their long names, plus `human_label` if there is a gold one."""
    df = df.withColumnsRenamed(
        {
            "level_1": "human_label_coarse",
            "level_2": "human_label_fine",
            "label": "human_label_gold",
        }
    )
    if "human_label_gold" in df.columns:
        df = df.withColumn("human_label", F.col("human_label_gold"))
    return df


def clean_queries(df: DataFrame, lowercase: bool = True, strip_punct: bool = True) -> DataFrame:
    return df.withColumn("query", clean_query(F.col("query"), lowercase, strip_punct))


def load_queries(df: DataFrame, options: LoadOptions = LoadOptions()) -> DataFrame:
    """Select, filter, sample, clean and rename; the sample sees the raw rows."""
    df = keep_columns(check_columns(df), options.keep_columns)
    if options.drop_missing:
        df = drop_missing_keys(df)
    df = filter_split(df, options.split)
    df = sample_queries(df, options.sample_size, options.seed)
    df = clean_queries(df, options.lowercase, options.strip_punct)
    return rename_labels(df)
