"""Size checks before anything is broadcast or brought to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20


def small_copy(df: DataFrame, max_rows: int = 50_000, max_bytes: int = BROADCAST_BYTES) -> DataFrame | None:
    """The frame's rows as a local relation when they fit, else None.

    Fetches no further than one row past the limit; spares computing a derived table once
    to measure it and once more to use it.
    """
    rows = df.limit(max_rows + 1).toArrow()
    if rows.num_rows > max_rows or rows.nbytes > max_bytes:
        return None
    return df.sparkSession.createDataFrame(rows, df.schema)
