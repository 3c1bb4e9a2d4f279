"""sparksignal: daily market/news analytics as pure Spark DataFrame operators.

Every public operator is a function ``DataFrame -> DataFrame`` (plus plain
parameters) built from ``pyspark.sql.functions``, windows and joins.  Nothing
is collected to the driver; the caller owns the SparkSession.
"""

from sparksignal.session import checkpoint_dir, get_spark

__all__ = ["get_spark", "checkpoint_dir"]
