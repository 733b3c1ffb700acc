"""Whole runs chained from the operators, and the registered queries."""
