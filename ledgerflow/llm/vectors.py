"""Vectors that take part in a search or comparison."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def vectors_of(table: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(vec_id, embedding) of the vectors that take part.

    Left out are null and zero vectors, those with null or infinite or NaN components, and rows without an id. Vectors of
    any number of components take part; they are compared with those that have as many.
    """
    rows = table.select(
        F.col(f"`{id_column}`").cast("bigint").alias("vec_id"), F.col(f"`{vector_column}`").cast("array<float>").alias("embedding")
    )
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(F.col("vec_id").isNotNull() & sound & F.exists("embedding", lambda x: x != 0))


def by_length(column: pa.Array) -> Iterator[np.ndarray]:
    """Rows of a column of lists, one group per length."""
    lengths = np.diff(np.asarray(column.offsets))
    for length in np.unique(lengths):
        yield np.flatnonzero(lengths == length)


def matrix(column: pa.Array) -> np.ndarray:
    """A column of equally long lists as an array of doubles."""
    values = np.asarray(column.flatten()).astype(np.float64)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 0)
