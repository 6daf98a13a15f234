"""Text to vectors through a user-supplied encoder."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Called once per task; returns the function that encodes a batch of texts as a matrix.
EncoderFactory = Callable[[], Callable[[list[str]], np.ndarray]]


def embed(
    df: DataFrame, encoder: EncoderFactory, text_col: str = "text", out: str = "embedding"
) -> DataFrame:
    """Add unit-length vectors, each text encoded once. NULL counts as ''."""

    @F.pandas_udf("array<float>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        run = encoder()
        for texts in batches:
            if not len(texts):
                yield pd.Series([], dtype=object)
                continue
            m = np.asarray(run(texts.fillna("").tolist()), dtype=np.float64)
            size = np.linalg.norm(m, axis=1, keepdims=True)
            unit = np.divide(m, size, out=np.zeros_like(m), where=size > 0)
            yield pd.Series(list(unit.astype(np.float32)))

    # The optimizer repeats deterministic functions in filters on their result.
    return df.withColumn(out, encode.asNondeterministic()(F.col(text_col)))
