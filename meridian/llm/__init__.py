"""Training-data operators (deduplication, scoring, encoding, packing, sharding).

Nothing else in the library imports this subpackage.  Queries: ``queries.py``.
"""
