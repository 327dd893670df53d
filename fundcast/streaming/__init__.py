"""Incremental execution of the batch jobs (Structured Streaming).

The original jobs are batch only; the preparation job is a stateless chain of
projections and filters, so the same plan runs over a growing folder of
campaign CSV files and appends prepared rows, with progress kept in a
checkpoint in the shared folder (restarts resume where they stopped).
"""

from fundcast.streaming.prepare_stream import CAMPAIGN_CSV_SCHEMA, prepare_stream

__all__ = ["CAMPAIGN_CSV_SCHEMA", "prepare_stream"]
