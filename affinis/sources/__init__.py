"""Reading ratings and writing sorted results."""

from affinis.sources.addressable import read_range, write_addressable
from affinis.sources.csv import RATING_SCHEMA, read_pairs, read_ratings, read_ratings_apart, write_sorted

__all__ = [
    "RATING_SCHEMA",
    "read_pairs",
    "read_range",
    "read_ratings",
    "read_ratings_apart",
    "write_addressable",
    "write_sorted",
]
