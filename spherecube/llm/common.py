"""Small helpers of the operators: input columns, intermediate tables, bounded broadcasts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from spherecube.session import scratch_path

#: tables up to this many narrow rows may be broadcast after they have been counted
BROADCAST_ROWS = 1_000_000


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator reads; other columns can't clash with its own."""
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def schema_with(df: DataFrame, ddl: str) -> StructType:
    """The columns of ``df`` followed by those of ``ddl``."""
    return StructType([*df.schema.fields, *StructType.fromDDL(ddl).fields])


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the file: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, already stored, marked for broadcast if its counted rows are few; otherwise joined by shuffle."""
    return F.broadcast(df) if df.count() <= limit else df
