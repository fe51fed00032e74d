"""Operators for preparing language-model training data.

Nothing outside this package imports it, apart from the registry, which adds the
queries of ``queries.py`` when the package is there.
"""
