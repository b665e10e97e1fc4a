"""Training-data operators: sharding, deduplication, filtering, mixing, formatting, tokenising, search.

Each module holds one operator; ``queries`` holds the thin queries over the driver's tables.
Nothing outside this subpackage imports it.
"""
