"""Readers: driver tables, CSV (three flavours), text lines, Parquet."""

from fundcast.sources.csv import read_campaign_csv, read_plain_csv, read_strict_csv
from fundcast.sources.files import read_lines, read_parquet
from fundcast.sources.tables import table

__all__ = [
    "read_campaign_csv",
    "read_plain_csv",
    "read_strict_csv",
    "read_lines",
    "read_parquet",
    "table",
]
