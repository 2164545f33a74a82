"""Operators that prepare training text: cleaning, deduplication, scoring, mixing, sharding, archives."""
