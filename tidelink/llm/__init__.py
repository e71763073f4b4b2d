"""Training-data operators: scoring, tokenising, mixing, deduplication, archives.

Nothing outside this package imports it; ``queries.py`` lists its queries.
"""
