"""Valid vectors of a table: not null, not empty, no null or non-finite component, not zero."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def valid(df: DataFrame, vec_col: str = "embedding") -> DataFrame:
    """The rows whose vector can be compared."""
    v = F.col(vec_col)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.where(v.isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0))


def matrix(column: pa.Array) -> np.ndarray:
    """rows x dimensions in double precision; all vectors must have one length."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)
