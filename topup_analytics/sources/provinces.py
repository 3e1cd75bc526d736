"""The province dimension."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topup_analytics.schema import PROVINCES


def province_dim(spark: SparkSession) -> DataFrame:
    """The built-in 31 provinces as ``(province_code, province)``."""
    rows = ", ".join(f"('{code}', '{name}')" for code, name in PROVINCES)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS dim(province_code, province)")


def province_file(spark: SparkSession, path: str) -> DataFrame:
    """A dimension from a text file of ``code name`` lines, one row per code."""
    parts = F.split(F.trim("value"), r"\s+", 2)
    return (
        spark.read.text(path)
        .select(parts[0].alias("province_code"), F.get(parts, F.lit(1)).alias("province"))
        .filter(F.col("province").isNotNull())
        .groupBy("province_code")
        .agg(F.max("province").alias("province"))
    )
