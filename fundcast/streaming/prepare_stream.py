"""Campaign preparation as a streaming query: CSV folder → prepared Parquet."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from fundcast.plans.prepare import prepare
from fundcast.session import use_utc
from fundcast.sources.csv import LOSSLESS_READ, NULL_TOKEN

# A stream cannot infer types per micro-batch: the raw campaign columns as
# the CSV reader types them (text columns stay strings until the lenient casts).
CAMPAIGN_CSV_SCHEMA = (
    "project_id BIGINT, name STRING, desc STRING, goal STRING, keywords STRING, "
    "disable_communication BOOLEAN, country STRING, currency STRING, deadline STRING, "
    "state_changed_at STRING, created_at STRING, launched_at STRING, backers_count STRING, "
    "final_status STRING"
)


def prepare_stream(
    spark: SparkSession,
    csv_dir: str,
    out_path: str,
    checkpoint_path: str,
    schema: str = CAMPAIGN_CSV_SCHEMA,
    every: str | None = None,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start the query. It processes what is there and stops, or keeps watching
    ``csv_dir`` at the interval ``every``. Started again with the same
    ``checkpoint_path`` it takes only new files."""
    use_utc(spark)
    reader = spark.readStream.schema(schema).option("header", "true").option("nullValue", NULL_TOKEN)
    for k, v in LOSSLESS_READ.items():
        reader = reader.option(k, v)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    prepared = prepare(reader.csv(csv_dir), null_token_value=None)
    writer = (
        prepared.writeStream.format("parquet")
        .outputMode("append")
        .option("path", out_path)
        .option("checkpointLocation", checkpoint_path)
    )
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()
