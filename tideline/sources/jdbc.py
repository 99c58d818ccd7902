"""JDBC table reads, split into parallel range scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, url: str, table: str, partition_column: str | None = None,
               lower_bound: int | None = None, upper_bound: int | None = None,
               num_partitions: int | None = None, fetch_size: int = 10_000,
               properties: dict[str, str] | None = None) -> DataFrame:
    """A database table as a DataFrame.

    Without ``partition_column`` the read is one query on one task; give a
    numeric, indexed column with its bounds and ``num_partitions`` to split
    it into range queries read in parallel. Filters and projections on the
    result are pushed into the SQL sent to the database.
    """
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table).option("fetchsize", fetch_size)
    if partition_column:
        if None in (lower_bound, upper_bound, num_partitions):
            raise ValueError("partition_column needs lower_bound, upper_bound and num_partitions")
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower_bound)
              .option("upperBound", upper_bound).option("numPartitions", num_partitions))
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    return r.load()
