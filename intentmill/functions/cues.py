"""Labels from cue words, for runs without a model."""

from __future__ import annotations

from pyspark.sql import Column

# Cue words per class, in order of priority.
CUE_WORDS = {
    "navigational": ("www", "http", "https", "com", "url", "domain", "login", "homepage"),
    "transactional": (
        "buy", "subscribe", "register", "download", "apply", "pay", "book",
        "reserve", "renew", "cancel",
    ),
    "instrumental": (
        "how to", "steps", "use", "install", "fix", "reset", "configure", "setup",
        "recipe", "tutorial", "guide",
    ),
    "factual": ("what", "when", "who", "why", "meaning", "symptoms", "definition", "info"),
}


def has_cue(cleaned: Column, *classes: str) -> Column:
    """Whether a cleaned query with a space at both ends holds a cue of these classes."""
    words = "|".join(word for name in classes for word in CUE_WORDS[name])
    return cleaned.rlike(f" (?:{words}) ")
