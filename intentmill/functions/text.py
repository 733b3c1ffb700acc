"""Query cleaning and label normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python counts as white space.
WHITE_SPACE = (
    "\t\n\u000b\u000c\r\u001c\u001d\u001e\u001f \u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Synonyms a model may answer with, by the class they stand for.
LABEL_ALIASES = {
    "factual": ("info", "informational", "informative"),
    "navigational": ("nav", "navigation"),
    "transactional": ("transact", "purchase"),
    "instrumental": ("howto", "how-to", "procedural"),
}


def strip(text: Column) -> Column:
    """Remove white space of any kind from both ends."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def clean_query(text: Column, lowercase: bool = True, strip_punct: bool = True) -> Column:
    """Lower-case, blank out punctuation, squeeze white space, strip.

    White space is itself outside the word characters, so with `strip_punct` one
    pass over runs of non-word characters does both replacements.
    """
    if lowercase:
        text = F.lower(text)
    # the plain ranges are part of \p{L} and \p{N}, but quicker to test
    runs = r"[^a-zA-Z0-9_\p{L}\p{N}]+" if strip_punct else r"(?U)[\s\x1c-\x1f]+"
    return F.btrim(F.regexp_replace(text, runs, " "))


def canonical_label(label: Column) -> Column:
    """Stripped, lower-case form used for every label comparison."""
    return F.lower(strip(label.cast("string")))


def resolve_type(canonical: Column, allowed: tuple[str, ...]) -> Column:
    """A canonical label's class: synonyms are mapped first, then what is unknown or NULL abstains."""
    mapped = canonical
    for target, names in LABEL_ALIASES.items():
        mapped = F.when(canonical.isin(*names), F.lit(target)).otherwise(mapped)
    return F.when(mapped.isin(*allowed), mapped).otherwise(F.lit("abstain"))


def normalize_type(label: Column, allowed: tuple[str, ...]) -> Column:
    """The class that a label as written stands for."""
    return resolve_type(canonical_label(label), allowed)
