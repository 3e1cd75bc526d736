"""Sharding by proportional stratified interleaving."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topup_analytics.llm.common import (
    even_buckets,
    filled,
    hex_bucket,
    read_table,
    running_sum,
    seeded_key,
    stored,
)

SHARDS = 24
SEED = "shards"


def stratified_shards(
    docs: DataFrame, shards: int = SHARDS, seed: str = SEED, id: str = "doc_id", text: str = "text", source: str = "source"
) -> DataFrame:
    """Deals rows into shards that all hold the sources in the corpus' proportions.

    Rows are put into a seeded order within their source; a row's fractional
    rank is its rank there over the size of the source. Sorted by fractional
    rank, any run of rows holds each source in proportion, and the order is cut
    into shards whose row counts differ by one at most.

    Returns ``doc_id, source, size, text_crc32, shard, slot``, where ``slot``
    counts from 0 within a shard. A null text has size 8 and the checksum of the
    empty text, null sources are one source, rows with null or repeated ids are
    rows like any other, equal rows are interchangeable, and an empty table
    gives no rows. Other columns are ignored.
    """
    whole = filled(text)
    narrow = stored(
        docs.select(
            F.col(id).cast("bigint").alias("doc_id"),
            F.col(source).cast("string").alias("source"),
            (F.octet_length(whole) + 8).cast("bigint").alias("size"),
            F.crc32(whole).alias("text_crc32"),
            seeded_key(seed, F.col(id), F.col(source), whole).alias("key"),
        )
    )
    n_rows = narrow.count()
    buckets = even_buckets(n_rows)
    one = narrow.withColumn("one", F.lit(1).cast("bigint")).withColumn(
        "stratum", F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n"))
    )
    ranked = running_sum(one, ["stratum"], hex_bucket(F.col("key"), buckets), ["key", "doc_id"], "one", "rank", "n_source")
    fraction = (2 * F.col("rank") + 1) / (2 * F.col("n_source"))
    placed = running_sum(
        ranked.withColumn("fraction", fraction),
        [],
        (F.col("fraction") * buckets).cast("bigint"),
        ["fraction", "stratum", "key", "doc_id"],
        "one",
        "place",
        "n_rows",
    )
    shard = F.expr(f"place * {shards} div n_rows")
    first = F.expr(f"(place * {shards} div n_rows * n_rows + {shards - 1}) div {shards}")
    return placed.select(
        "doc_id",
        "source",
        "size",
        "text_crc32",
        shard.cast("int").alias("shard"),
        (F.col("place") - first).alias("slot"),
    )


def op4_stratified_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards."""
    rows = stratified_shards(read_table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "source",
    )


#: The checksum has no counterpart in DuckDB, so it is folded over the bytes with
#: a table made by the polynomial's rule.
OP4_SQL = f"""
WITH RECURSIVE steps(n, k, c) AS (
  SELECT n, 0, n FROM range(256) t(n)
  UNION ALL
  SELECT n, k + 1, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END FROM steps WHERE k < 8
),
crc_table AS (SELECT list(c ORDER BY n) AS t FROM steps WHERE k = 8),
docs AS (
  SELECT doc_id, source, octet_length(encode(coalesce(text, ''))) + 8 AS size,
    md5(concat('{SEED}', chr(10), coalesce(doc_id::VARCHAR, ''), chr(10), coalesce(source, ''), chr(10), coalesce(text, ''))) AS key,
    xor(list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(range(1, 2 * octet_length(encode(coalesce(text, ''))), 2),
        lambda i: ('0x' || substr(hex(encode(coalesce(text, ''))), i, 2))::BIGINT)),
      lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1])), 4294967295) AS text_crc32
  FROM documents, crc_table
),
ranked AS (
  SELECT *, (2 * (row_number() OVER s - 1) + 1)::DOUBLE / (2 * count(*) OVER (PARTITION BY source)) AS fraction
  FROM docs WINDOW s AS (PARTITION BY source ORDER BY key, doc_id)
),
placed AS (
  SELECT *, row_number() OVER (ORDER BY fraction, coalesce('s' || source, 'n'), key, doc_id) - 1 AS place,
    count(*) OVER () AS n
  FROM ranked
)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'rows' AS law, (place * {SHARDS} // n)::INTEGER AS shard,
  row_number() OVER (PARTITION BY place * {SHARDS} // n ORDER BY place) - 1 AS slot,
  NULL::INTEGER AS grown_shard, source
FROM placed
"""
