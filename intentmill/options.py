"""Options of each step, and the label set they share."""

from __future__ import annotations

from dataclasses import dataclass

# The five intent classes, in reporting order.
CLASSES = ("navigational", "factual", "transactional", "instrumental", "abstain")

# The columns a query log may carry, in output order.
QUERY_LOG_COLUMNS = (
    "qid", "query", "label", "level_1", "level_2", "data_split", "did", "url",
)
REQUIRED_COLUMNS = ("qid", "query")


@dataclass(frozen=True)
class LoadOptions:
    split: str = "validation"            # "all" keeps every split
    multiline: bool = True               # records of text files may hold quoted line breaks
    lowercase: bool = True
    strip_punct: bool = True
    keep_columns: tuple[str, ...] | None = None
    drop_missing: bool = True
    sample_size: int | None = None
    seed: int = 42


@dataclass(frozen=True)
class AnnotateOptions:
    mode: str = "zeroshot"               # or "fewshot"
    votes: int = 1
    parallel: int | None = None          # tasks that ask the model; None: one per core
    concurrency: int = 1                 # model calls at a time in each task
    slice_rows: int = 1_000              # calls of a task, repeated if it is lost
    commit_rows: int = 1_000_000         # calls between two commits, repeated if the run dies
    model_name: str = "replayed"
    provider: str = "table"
    prompt_version: str = "v1"
    taxonomy_version: str = "v1"
    allowed: tuple[str, ...] = CLASSES


@dataclass(frozen=True)
class ValidateOptions:
    low_confidence: float = 0.60
    max_retries: int = 1
    allowed: tuple[str, ...] = CLASSES


@dataclass(frozen=True)
class EvalOptions:
    human_column: str = "human_label_gold"
    ai_columns: tuple[str, ...] = ("final_type", "ai_label")
    allowed: tuple[str, ...] = CLASSES
    use_prf: bool = True
    use_kappa: bool = True
    use_judge: bool | None = None        # None: follow judge_enabled
    judge_enabled: bool = False
    judge_mode: str = "compare_to_human"  # or "audit"
    judge_sample_size: int | None = 500  # None: judge every row
    judge_seed: int = 42
    drop_missing_gold: bool = True

    @property
    def judge_on(self) -> bool:
        return self.judge_enabled if self.use_judge is None else self.use_judge
