"""Arithmetic on factor arrays."""

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(left: Column, right: Column, rank: int) -> Column:
    """Inner product of two arrays of ``rank`` numbers; null if either is null. Written out term
    by term it is compiled with the rest of the stage, where array lambdas are interpreted."""
    terms = [
        F.get(left, F.lit(k)).cast("double") * F.get(right, F.lit(k)).cast("double")
        for k in range(rank)
    ]
    return reduce(add, terms)
