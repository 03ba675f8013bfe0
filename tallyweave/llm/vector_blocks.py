"""Arrow columns of vectors as numpy matrices, and which vectors count."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

#: A vector counts if it is not null, not all zero, and all components are finite.
VALID = (
    "{v} IS NOT NULL AND size({v}) > 0 AND NOT exists({v}, x -> x IS NULL OR isnan(x) OR abs(x) = double('infinity'))"
    " AND exists({v}, x -> x <> 0)"
)


def valid(rows: DataFrame, vector: str) -> DataFrame:
    return rows.where(VALID.format(v=vector))


def matrix(column: pd.Series) -> np.ndarray:
    """One row a vector, in double precision."""
    return np.array(column.tolist(), dtype=np.float64) if len(column) else np.zeros((0, 0))
