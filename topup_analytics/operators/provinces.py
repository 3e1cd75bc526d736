"""Province lookup."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topup_analytics.schema import UNKNOWN_PROVINCE
from topup_analytics.sources.provinces import province_dim


def one_name_a_code(dim: DataFrame) -> DataFrame:
    """A dimension with one row for each code; reading it fails where a code has two names."""
    named = dim.where("province_code is not null").groupBy("province_code").agg(
        F.min("province").alias("first"), F.max("province").alias("last")
    )
    message = F.concat(F.lit("two names for province code "), F.col("province_code"))
    name = F.when(F.col("first").eqNullSafe(F.col("last")), F.col("first")).otherwise(F.raise_error(message))
    return named.select("province_code", name.alias("province"))


def with_province(orders: DataFrame, dim: DataFrame | None = None) -> DataFrame:
    """Add ``province`` for ``provinceCode``; null and unknown codes give ``none``.

    The built-in dimension has 31 rows, so it is always broadcast. One passed by
    the caller is left to Spark, which broadcasts it only below its own size
    threshold. Its repeated rows count as one, and a code with two names fails the
    job: an order must not be counted for both.
    """
    if dim is None:
        dim = F.broadcast(province_dim(orders.sparkSession))
    else:
        dim = one_name_a_code(dim)
    joined = orders.join(dim, orders["provinceCode"] == dim["province_code"], "left")
    name = F.coalesce(dim["province"], F.lit(UNKNOWN_PROVINCE))
    return joined.withColumn("province", name).drop("province_code")
