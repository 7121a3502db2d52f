"""What may come to the driver: a bounded sample by hash of the key, and tables known to be small."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def first_by_hash(df: DataFrame, key: str, size: int) -> DataFrame:
    """The `size` rows with the smallest hash of `key`.

    Rows above a hash that leaves twice as many as wanted are filtered where they are read, so that no task sends
    more than its share to the driver; the result is that of sorting all rows."""
    total = df.count()
    h = F.xxhash64(key)
    if total > 4 * size:
        df = df.filter(h < F.lit(-(1 << 63) + int(2 * size / total * (1 << 64))))
    return df.orderBy(h, key).limit(size)


def bounded(rows: DataFrame, most: int, what: str) -> list:
    """The rows of a table that must be small, for the driver; an error where it is larger than `most`."""
    out = rows.limit(most + 1).collect()
    if len(out) > most:
        raise ValueError(f"more than {most} {what}")
    return out
