"""The annotation lookup stored by position, for runs that share it.

At genome scale the lookup is far larger than a run's variants. Stored in
buckets of (chrom, pos), it is shuffled once; a join then moves the variants to
the buckets and leaves the lookup where it is.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

from locusframe.operators.annotate import position_lookup

BUCKETS = 512
PLACE = ("chrom", "pos")


def table_name(path: str) -> str:
    """Name in the catalog of the store below ``path``."""
    return "annotation_lookup_" + hashlib.sha256(path.encode()).hexdigest()[:24]


def store_lookup(lookup: DataFrame, path: str, buckets: int = BUCKETS) -> DataFrame:
    """Write ``position_lookup`` of the rows below ``path`` and open it.

    A bucket is one file: choose ``buckets`` so that a file is some 100 MB. The
    layout is written last, so a store without one is not complete.
    """
    path, spark = path.rstrip("/"), lookup.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {table_name(path)}")
    rows = position_lookup(lookup).repartition(buckets, *PLACE)
    rows.write.mode("overwrite").option("path", f"{path}/rows").bucketBy(buckets, *PLACE).sortBy(*PLACE).saveAsTable(table_name(path))
    layout = spark.createDataFrame([(buckets,)], "buckets int")
    layout.coalesce(1).write.mode("overwrite").parquet(f"{path}/layout")
    return open_lookup(spark, path)


def open_lookup(spark: SparkSession, path: str) -> DataFrame:
    """The store below ``path`` as a table whose buckets Spark knows.

    The session's catalog is told of the files if it has not seen them.
    """
    path = path.rstrip("/")
    buckets = spark.read.parquet(f"{path}/layout").first().buckets
    if not spark.catalog.tableExists(table_name(path)):
        columns = spark.read.parquet(f"{path}/rows")._jdf.schema().toDDL()
        spark.sql(
            f"CREATE TABLE {table_name(path)} ({columns}) USING parquet CLUSTERED BY ({', '.join(PLACE)}) "
            f"SORTED BY ({', '.join(PLACE)}) INTO {buckets} BUCKETS LOCATION '{path}/rows'"
        )
    return spark.table(table_name(path))
