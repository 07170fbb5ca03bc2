"""Column helpers: every one is a built-in expression, evaluated in the JVM."""

from ratingloom.functions.hashing import hash_bucket, sample_key
from ratingloom.functions.numbers import strip, to_id, to_number
from ratingloom.functions.vectors import dot

__all__ = ["dot", "hash_bucket", "sample_key", "strip", "to_id", "to_number"]
