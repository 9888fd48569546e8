"""Reference lists: one value per line (SRC-3).

Lines are trimmed like Java ``trim`` (every char <= U+0020), blank lines and
lines starting with ``#`` are skipped, values are de-duplicated. A missing
file gives an empty list and a warning, never a failure.
"""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardstream.sources.json_lines import java_trim


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def load_reference_list(spark: SparkSession, path: str) -> DataFrame:
    """One-column DataFrame ``value`` with the distinct list entries."""
    if not path_exists(spark, path):
        warnings.warn(f"reference list {path} not found - using an empty list")
        return spark.createDataFrame([], "value string")
    text = spark.read.text(path)
    value = java_trim(F.col("value"))
    return (text.select(value.alias("value"))
            .where((F.col("value") != "") & ~F.col("value").startswith("#"))
            .distinct())
