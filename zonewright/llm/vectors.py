"""What the two vector searches share: which rows take part, and no more copies of one vector
than a result can hold."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def usable(vector: Column) -> Column:
    """An array without null or non-finite components."""
    bound = F.lit(float("inf"))
    whole = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < bound)
    )
    return vector.isNotNull() & F.coalesce(whole, F.lit(False))


def first_copies(rows: DataFrame, key: str, vector: str, copies: int) -> DataFrame:
    """Of the rows with one vector, those of the ``copies`` smallest keys. As
    ties go to the smaller key, no other row can be among a query's ``copies - 1`` best. Spark
    limits each vector's rows before the shuffle, so a vector that many rows have is no load."""
    rank = F.row_number().over(Window.partitionBy(vector).orderBy(key))
    return rows.withColumn("copy", rank).where(F.col("copy") <= copies).drop("copy")


def matrix(vectors: pd.Series, dtype: str = "float64") -> np.ndarray:
    return np.stack(vectors.to_list()).astype(dtype, copy=False)


def best_of_rows(scores: np.ndarray, keys: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row by row, the columns of the ``k`` highest scores, ties to the smaller key; and the scores."""
    k = min(k, scores.shape[1])
    if k < scores.shape[1]:
        # Ties at the k-th score need care: all columns that reach it are looked at.
        kth = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
        width = int((scores >= kth[:, None]).sum(axis=1).max())
        near = np.argpartition(-scores, min(width, scores.shape[1]) - 1, axis=1)[:, :width]
    else:
        near = np.broadcast_to(np.arange(scores.shape[1]), scores.shape)
    got = np.take_along_axis(scores, near, axis=1)
    at = np.take_along_axis(keys, near, axis=1) if keys.ndim == 2 else keys[near]
    order = np.lexsort((at, -got), axis=1)[:, :k]
    return np.take_along_axis(near, order, axis=1), np.take_along_axis(got, order, axis=1)
