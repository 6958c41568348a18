"""How much goes to a Python worker at once."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Rows and bytes of a batch of texts that goes to Python; Spark's own default is 10,000 rows however long.
BATCH_ROWS, BATCH_BYTES = 1000, 4 << 20


def small_batches(spark: SparkSession | None) -> None:
    """Lowers the session's Arrow batches, so that a worker and its executor hold few long texts at once."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark and not 0 < int(spark.conf.get(key, "10000")) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
