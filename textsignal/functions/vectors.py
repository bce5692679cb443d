"""Arrays and ML vectors."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column


def as_vector(array: Column) -> Column:
    """A numeric array as a dense vector."""
    return array_to_vector(array.cast("array<double>"))


def as_array(vector: Column, dtype: str = "float32") -> Column:
    """A vector, dense or sparse, as an array with every element present."""
    return vector_to_array(vector, dtype)


def element(vector: Column, index: int) -> Column:
    """One element of a vector, also where a sparse vector does not store it."""
    return vector_to_array(vector)[index]
