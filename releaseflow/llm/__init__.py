"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage. Queries and their SQL
live in ``queries``; ``corpus_pipeline.py`` at the repository top chains five
of the operators.
"""
