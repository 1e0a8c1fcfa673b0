"""Operators for large training corpora: deduplication, filtering, tokens and search.

Nothing else in the library imports this package; its registered queries are in
``queries.py`` and are added by the entry module only where the package is present.
"""
