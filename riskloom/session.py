"""Session settings the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# HotSpot never compiles a method above 8000 bytes of bytecode.  The wide
# projections of this package would give such methods in whole-stage code and
# then run interpreted; with this limit Spark splits them instead.
SETTINGS = {
    "spark.sql.codegen.hugeMethodLimit": ("65535", "8000"),
}


def configure(spark: SparkSession) -> SparkSession:
    """Change settings that still have the value given first."""
    for name, (default, wanted) in SETTINGS.items():
        if spark.conf.get(name, default) == default:
            spark.conf.set(name, wanted)
    return spark
