"""Column-to-Column helpers; all built-in expressions, no Python on executors."""
