"""User callbacks as Arrow-batched pandas UDFs (row 99)."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import functions as F


def row_predictor(fn: Callable[[str, str, str], float]):
    """Wrap ``fn(sample_id, catalog_content, image_link) -> price`` as a column
    function.  Rows travel to Python in Arrow batches; the callback itself is
    per row because that is its contract."""

    @F.pandas_udf("double")
    def run(ids: pd.Series, texts: pd.Series, links: pd.Series) -> pd.Series:
        return pd.Series([float(fn(i, t, u)) for i, t, u in zip(ids, texts, links)])

    return run
