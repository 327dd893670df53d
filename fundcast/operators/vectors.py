"""ML vector columns as plain columns and back, JVM-side.

A vector is stored in Parquet as a struct (type, size, indices, values). Reading a
written table with that struct as the column's type shows the parts of every vector,
and reading it with the vector type turns such structs into vectors: O(non-zeros)
both ways, with neither Python workers nor a detour through text. ``vector_to_array``
would densify, which costs O(vocabulary) per row for count vectors.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from fundcast.session import scratch_path

#: A vector's parts as Parquet holds them; type 0 is sparse, 1 dense.
PARTS = VectorUDT.sqlType()


def read_parts(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A Parquet table of ``schema`` with its vector columns as structs."""
    plain = [StructField(f.name, PARTS if isinstance(f.dataType, VectorUDT) else f.dataType) for f in schema.fields]
    return spark.read.schema(StructType(plain)).parquet(path)


def written_parts(df: DataFrame, name: str = "parts") -> DataFrame:
    """``df`` written once and read with its vector columns as structs."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return read_parts(df.sparkSession, path, df.schema)


def entries(parts: Column) -> Column:
    """array<struct<index, value>> of the stored entries of a vector's parts: the
    non-zeros of a sparse vector, every slot of a dense one."""
    return F.when(
        parts["type"] == 0, F.arrays_zip(parts["indices"].alias("index"), parts["values"].alias("value"))
    ).otherwise(F.transform(parts["values"], lambda x, i: F.struct(i.alias("index"), x.alias("value"))))


def entry(parts: Column, index: Column) -> Column:
    """The value of a vector's parts at ``index``; 0 where none is stored."""
    at = F.when(parts["type"] == 0, F.nullif(F.array_position(parts["indices"], index), F.lit(0)) - 1).otherwise(index)
    return F.coalesce(F.get(parts["values"], at.cast("int")), F.lit(0.0))


def sparse_entries(df: DataFrame, keys: list[str], vector_col: str) -> DataFrame:
    """(keys…, index, value) for the stored entries of each vector. The vectors are
    written once, to be read as structs."""
    parts = written_parts(df.select(*keys, vector_col), "vector-entries")
    return parts.select(*keys, F.inline(entries(F.col(vector_col))))


def dense_entries(df: DataFrame, keys: list[str], vector_col: str) -> DataFrame:
    """(keys…, pos, value) for every slot; for short vectors (assembled
    features), where zeros matter."""
    return df.select(*keys, F.posexplode(vector_to_array(F.col(vector_col))).alias("pos", "value"))


def sparse_vectors(rows: DataFrame, key: str, size: int, name: str = "features", path: str | None = None) -> DataFrame:
    """(key, name): one sparse vector of ``size`` slots for every key of the entries
    (key, index, value), the slots in rising order. A key's entries meet in one row,
    so it should have no more than a document has terms. The vectors are written to
    ``path``, where ``read_parts`` finds their parts."""
    spark = rows.sparkSession
    # dealt by key before they are gathered: lists of a few entries each would be sorted and moved instead
    gathered = rows.repartition(F.col(key)).groupBy(key).agg(F.sort_array(F.collect_list(F.struct("index", "value"))).alias("_e"))
    part = F.struct(
        F.lit(0).cast("tinyint").alias("type"), F.lit(size).cast("int").alias("size"),
        F.col("_e.index").cast("array<int>").alias("indices"), F.col("_e.value").cast("array<double>").alias("values"),
    )
    path = path or scratch_path(spark, "sparse-vectors")
    gathered.select(key, part.alias(name)).write.parquet(path, compression="zstd")
    return spark.read.schema(StructType([rows.schema[key], StructField(name, VectorUDT())])).parquet(path)
