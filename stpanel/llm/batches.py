"""How many rows travel between Spark and Python together."""

from __future__ import annotations

from pyspark.sql import SparkSession

ROWS = 1000
_NAME, _DEFAULT = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"


def small_batches(spark: SparkSession) -> None:
    """Send texts to Python in batches of some megabytes, unless the session has set a size itself.

    Spark's default of 10,000 rows is meant for narrow rows; with whole texts, each
    task would hold tens of megabytes on both sides.
    """
    if spark.conf.get(_NAME) == _DEFAULT:
        spark.conf.set(_NAME, str(ROWS))
