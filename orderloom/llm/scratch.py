"""Tables that cut lineage, in the shared folder the cluster names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orderloom.session import fresh_path

#: Rows in one Arrow batch. Rows here are whole texts or blocks of some ten KB, of which the usual 10,000 would be too many.
ARROW_ROWS = 256


def settle(spark: SparkSession) -> SparkSession:
    """The session setting that these operators are written for."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df``, written as Parquet and read again; later reads don't compute them anew."""
    return df.sparkSession.read.schema(df.schema).parquet(store(df, name))


def store(df: DataFrame, name: str) -> str:
    path = fresh_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table that only its writer knows and has read to the end."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
