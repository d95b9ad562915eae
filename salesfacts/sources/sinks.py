"""Sink for the job's result.

The original statement only returns a relation; loading happens outside. This
is the Spark equivalent of that load: Parquet partitioned by year and month,
so readers of one month prune the rest. The job recomputes every month, so by
default the whole output is replaced; ``only_written_months`` keeps the months
that a run did not produce.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

PARTITION_COLUMNS = ("calendar_year", "calendar_month")
MAX_RECORDS_PER_FILE = 5_000_000


def write_sales_fact(df: DataFrame, path: str, mode: str = "overwrite", only_written_months: bool = False,
                     max_records_per_file: int = MAX_RECORDS_PER_FILE) -> None:
    """Write ``df`` by month. The rebalance hint groups a month's rows into few
    files, and AQE splits a month larger than the advisory partition size over
    several tasks."""
    (df.hint("rebalance", *PARTITION_COLUMNS)
       .write.mode(mode).partitionBy(*PARTITION_COLUMNS)
       .option("partitionOverwriteMode", "dynamic" if only_written_months else "static")
       .option("maxRecordsPerFile", max_records_per_file).parquet(path))
