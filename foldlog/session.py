"""Runtime settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Needed for right results: epoch text is rendered in UTC, and a repeated JSON key keeps its
# last value.
_RESULT_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
}

# Needed for even load. Splitting a skewed join is kept even where it costs one more exchange,
# since one key may hold a third of all rows. Generated methods above 8000 bytes of code are not
# compiled by the JVM: wide projections run faster as several small methods.
_SCALE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Rows of whole documents: a batch for Python stays a few megabytes.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings to ``spark`` and return it; cluster sizing stays with the caller."""
    for key, value in {**_RESULT_SETTINGS, **_SCALE_SETTINGS}.items():
        spark.conf.set(key, value)
    return spark
