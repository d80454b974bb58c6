"""Column expressions: hashing and word shingles."""

from affinis.functions.hashing import PRIME, coefficients, element_hash, linear_hash
from affinis.functions.text import word_runs, word_shingles, words

__all__ = ["PRIME", "coefficients", "element_hash", "linear_hash", "word_runs", "word_shingles", "words"]
