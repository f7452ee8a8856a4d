"""Operators that prepare training text, each with a registered query."""
