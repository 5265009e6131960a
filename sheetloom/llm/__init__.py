"""Operators for preparing language-model training data; see the table in README.md."""
