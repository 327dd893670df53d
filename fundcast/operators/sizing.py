"""Broadcast only behind a size check.

A side is broadcast when its measured size is under the session's
``spark.sql.autoBroadcastJoinThreshold`` (the cluster's own limit); above
it, or with broadcasting disabled, the frame is returned unchanged and the
planner keeps a shuffle join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_UNITS = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}


def broadcast_limit(spark) -> int:
    """The session's broadcast threshold in bytes (-1 = disabled)."""
    raw = str(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10MB")).strip().lower()
    if raw.lstrip("-").isdigit():
        return int(raw)
    for unit in sorted(_UNITS, key=len, reverse=True):
        if raw.endswith(unit):
            return int(float(raw[: -len(unit)]) * _UNITS[unit])
    return 10 << 20


def broadcast_if_within(df: DataFrame, size_bytes: int) -> DataFrame:
    """``broadcast(df)`` when ``size_bytes`` (measured by the caller) is within
    the limit, else ``df`` as is."""
    limit = broadcast_limit(df.sparkSession)
    if 0 <= size_bytes <= limit:
        return F.broadcast(df)
    return df
