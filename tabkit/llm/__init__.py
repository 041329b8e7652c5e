"""Training-data operators: search, sharding, filtering, deduplication, packing.

Nothing else in the library imports this subpackage.
"""
