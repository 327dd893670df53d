"""CSV readers.

Files split freely by default. Text cells that hold quotes or line breaks need
``lossless=True`` (``LOSSLESS_READ``, with the matching writer options in
``fundcast.sinks``): multi-line parsing makes a file one split, so keep many
moderate files rather than one huge one for such texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

NULL_TOKEN = "false"

LOSSLESS_READ = {"escape": '"', "multiLine": "true"}


def read_campaign_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    null_token: str = NULL_TOKEN,
    lossless: bool = False,
) -> DataFrame:
    """Header row, cells equal to ``null_token`` read as null (case-sensitive),
    PERMISSIVE mode. Types are inferred unless ``schema`` is given; inference
    is a full extra pass over the files, so pass a schema at scale."""
    reader = spark.read.option("header", "true").option("nullValue", null_token)
    if lossless:
        reader = reader.options(**LOSSLESS_READ)
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", "true")
    return reader.csv(path)


def read_strict_csv(
    spark: SparkSession,
    path: str,
    null_token: str = NULL_TOKEN,
    header: bool = True,
    schema: StructType | str | None = None,
) -> DataFrame:
    """All-string columns; rows whose cell count differs from the header are
    dropped (DROPMALFORMED). Without a header, ``schema`` fixes the expected
    number of cells.

    By default the CSV reader parses only the columns a query uses, so which
    rows count as malformed would depend on the query (a bare ``count()``
    kept every row). This reader turns that pruning off for its own scan, so
    every query sees the same rows.
    """
    reader = (
        spark.read.option("header", str(header).lower())
        .option("mode", "DROPMALFORMED")
        .option("columnPruning", "false")
        .option("nullValue", null_token)
    )
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


#: Where ``read_csv_with_malformed`` keeps the text of a row that does not fit.
MALFORMED = "malformed"


def read_csv_with_malformed(
    spark: SparkSession, path: str, schema: StructType | str | None = None, null_token: str = NULL_TOKEN, header: bool = True
) -> DataFrame:
    """The rows of ``read_strict_csv``, and beside them those it drops: string columns
    and ``malformed``, which holds the whole text of a row whose number of cells differs
    and is null for all others. One scan gives both; without ``schema`` the columns are
    those of the header (its first line is read for them)."""
    if schema is None:
        names = spark.read.option("header", "true").csv(path).columns
        schema = StructType([StructField(n, StringType()) for n in names])
    elif isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    wide = StructType([*schema.fields, StructField(MALFORMED, StringType())])
    return (
        spark.read.option("header", str(header).lower())
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", MALFORMED)
        .option("columnPruning", "false")
        .option("nullValue", null_token)
        .schema(wide)
        .csv(path)
    )


def read_plain_csv(spark: SparkSession, path: str) -> DataFrame:
    """No header, no options: string columns ``_c0, _c1, …``."""
    return spark.read.csv(path)
