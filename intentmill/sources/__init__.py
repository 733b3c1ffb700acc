"""Readers and writers for query logs, few-shot examples and result tables."""
