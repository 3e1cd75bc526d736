"""Helpers that several operators share."""

from __future__ import annotations

import math
import os
import shutil
import tempfile
from collections.abc import Iterator, Sequence
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from topup_analytics.plans.workspace import new_folder

#: Words are runs of anything but ASCII white space (\x20, \x09 to \x0D), which is what Java's class excludes.
WORD = r"\S+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


_SHIPPED: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once per application.

    Functions that run there import it, and need not find it installed.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if os.path.isdir(package):  # else it came as an archive itself
        root, name = os.path.split(package)
        target = os.path.join(os.path.realpath(tempfile.mkdtemp()), name)
        context.addPyFile(shutil.make_archive(target, "zip", root, name))
    _SHIPPED.add(context.applicationId)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(rows: DataFrame) -> DataFrame:
    """``rows``, written once to the shared folder and read back.

    Cuts the lineage: what comes later reads files that outlive any executor.
    """
    return Scratch(rows.sparkSession).stored(rows)


class Scratch:
    """A folder for tables that are not needed once an operator's result is stored.

    Where a table's rows are known to be few, it is written in few files. Every file costs the tasks
    that write and read it, and some stores a process, so that many small ones outweigh the work itself.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.folder, self.tables = spark, new_folder(spark), 0

    def counted(self, rows: DataFrame, most: int | None = None, a_file: int = 250_000) -> tuple[DataFrame, int]:
        """``rows``, stored and read back, and how many there are.

        ``most`` is a bound of the rows, if there is one; then a task gets about ``a_file`` of them.
        """
        self.tables += 1
        path = f"{self.folder}/{self.tables}"
        schema, seen = rows.schema, Observation()
        if most is not None:
            rows = rows.coalesce(max(1, -(-most // a_file)))
        rows.observe(seen, F.count(F.lit(1)).alias("n")).write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(schema).parquet(path), seen.get["n"]

    def stored(self, rows: DataFrame, most: int | None = None, a_file: int = 250_000) -> DataFrame:
        """``rows``, stored and read back."""
        return self.counted(rows, most, a_file)[0]

    def bucketed(self, rows: DataFrame, key: str, buckets: int) -> DataFrame:
        """``rows``, stored in buckets by the hash of ``key`` and read back.

        Tables with equal numbers of buckets are joined on their keys without a shuffle. The catalog knows
        the table only until it is read back; the files stay until ``drop``.
        """
        self.tables += 1
        name = f"topup_{uuid4().hex}"
        writer = rows.write.option("compression", "zstd").option("path", f"{self.folder}/{self.tables}")
        writer.bucketBy(buckets, key).saveAsTable(name)
        found = self.spark.table(name)
        self.spark.sql(f"DROP TABLE {name}")
        return found

    def drop(self) -> None:
        """Deletes the folder; nothing may read it any more."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def slices(batch: pa.RecordBatch, rows: int = 256) -> Iterator[pa.RecordBatch]:
    """A batch in parts of some rows, so that Python objects exist for one part at a time."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def filled(text: Column | str) -> Column:
    """A text, empty where it is null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def held_out(id: str = "doc_id", folds: int = 3, fold: int = 1) -> Column:
    """Whether a row belongs to the fold that is not learned from; a null id counts as empty text."""
    return F.crc32(filled(F.col(id).cast("string"))) % folds == fold


def lower_ascii(text: Column) -> Column:
    """Lower-cases A to Z and nothing else; ``lower`` does just that to pure ASCII."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


def words(text: Column, pattern: str = WORD) -> Column:
    """All matches of a word pattern, in order."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def bound(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, as the variable of a lambda.

    Catalyst repeats a projected expression wherever a lambda uses it, so an
    array would be rebuilt for each of its elements.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def seeded_key(seed: str, *columns: Column) -> Column:
    """A hexadecimal sort key that puts rows into a shuffled order fixed by the seed."""
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in columns]
    return F.md5(F.concat_ws("\n", F.lit(seed), *parts))


def hex_bucket(key: Column, buckets: int) -> Column:
    """The bucket of a hexadecimal key; buckets follow the order of the keys."""
    return (F.conv(F.substring(key, 1, 8), 16, 10).cast("bigint") * buckets / 2**32).cast("bigint")


def even_buckets(n_rows: int) -> int:
    """As many buckets as rows in each, so neither sums nor rows pile up in one task."""
    return max(1, math.isqrt(n_rows))


def running_sum(
    rows: DataFrame,
    group: Sequence[str],
    bucket: Column,
    order: Sequence[str],
    amount: str,
    start: str,
    total: str,
    narrow: DataFrame | None = None,
) -> DataFrame:
    """Adds the sum of ``amount`` before each row of its group, and the group's total.

    ``bucket`` must follow ``order`` within a group. Rows are ordered only
    within a bucket; the buckets' own sums come from one partial aggregation,
    so a group of any size is spread over as many tasks as it has buckets.
    ``group`` columns must not be null. ``narrow`` may hold the same rows with no
    more than the columns that the sums need.
    """
    keys = [*group, "_bucket"]
    narrow = (rows if narrow is None else narrow).withColumn("_bucket", bucket)
    rows = rows.withColumn("_bucket", bucket)
    parts = narrow.groupBy(*keys).agg(F.sum(amount).alias("_part"))
    whole = Window.partitionBy(*group)
    sums = parts.select(
        *keys,
        (F.sum("_part").over(whole.orderBy("_bucket")) - F.col("_part")).alias("_base"),
        F.sum("_part").over(whole).alias(total),
    )
    inside = Window.partitionBy(*keys).orderBy(*order)
    return (
        rows.withColumn("_upto", F.sum(amount).over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        .join(sums, keys)
        .withColumn(start, F.col("_base") + F.col("_upto") - F.col(amount))
        .drop("_base", "_upto", "_bucket")
    )
