"""Mixing sources to target weights by Sainte-Lague apportionment of token blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from topup_analytics.llm.common import (
    WORD,
    even_buckets,
    filled,
    hex_bucket,
    read_table,
    running_sum,
    seeded_key,
    stored,
    words,
)

SEED = "mix"
#: Weights of the sources in the order of their names, repeating.
WEIGHTS = (1, 2, 3)
#: No source is read more than so many times.
MOST_REPEATS = 3
SHARDS = 8
#: The smallest target is worth this many blocks in each shard, so rounding to blocks stays below 1 %.
BLOCKS_OF_SMALLEST = 256


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """Adds ``weight`` and ``target`` to rows ``stratum, source_size``.

    Targets share the sum of all sizes by weight. A target stops at ``most``
    times its source, and the excess is shared anew by weight: sources fill up in
    the order of ``most * size / weight``, and the first that does not fill sets
    the level of the rest. One row per source.
    """
    every = Window.partitionBy()
    by_name = Window.orderBy("stratum")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    weighted = sizes.withColumn("weight", weight.cast("bigint"))
    limit = F.lit(most) * F.col("source_size")
    filling = Window.orderBy("ratio", "stratum")
    before = filling.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = weighted.withColumn("ratio", limit / F.col("weight")).select(
        "*",
        (F.sum("source_size").over(every) - F.sum(limit).over(before) + limit).alias("left"),
        (F.sum("weight").over(every) - F.sum("weight").over(before) + F.col("weight")).alias("left_weight"),
        F.row_number().over(filling).alias("turn"),
    )
    level = F.col("left") / F.col("left_weight")
    common = F.min_by(level, F.when(F.col("ratio") > level, F.col("turn"))).over(every)
    return ranked.withColumn(
        "target", F.least(limit.cast("double"), F.coalesce(F.col("weight") * common, limit.cast("double")))
    ).select("stratum", "source_size", "weight", "target")


def block_quotas(targets: DataFrame, shards: int = SHARDS, most: int = MOST_REPEATS) -> DataFrame:
    """Adds ``block`` (words), ``quota`` (blocks per shard) and ``line`` (blocks of the source) to targets.

    A shard has ``seats = total / (block * shards)`` blocks. They go to the
    sources by the highest quotients ``target / (2 * seats held + 1)``, ties to
    the earlier source; every shard gets the same quotas. Seats that any source
    is sure to win are given at once, and only the last few are ranked: at the
    divisor ``total / (seats - n / 2)`` at most ``seats`` and at least
    ``seats - n`` are won by ``n`` sources. One seat less is taken as sure, so
    rounding cannot decide a tie.

    A block has ``1 / (BLOCKS_OF_SMALLEST * shards)`` of the smallest target, and one word at least; so small
    sources come within a word a shard of their targets, at any size of the corpus. The windows order one row for each source.
    """
    every = Window.partitionBy()
    total = F.sum("source_size").over(every)
    least = F.min(F.when(F.col("target") > 0, F.col("target"))).over(every)
    fine = F.floor(least / (BLOCKS_OF_SMALLEST * F.col("shards")))
    rows = (
        targets.withColumn("shards", F.lit(shards).cast("bigint"))
        .withColumn("total", total)
        .withColumn("n", F.count("*").over(every))
        # The second bound keeps block numbers below 2 ** 31: a source under a millionth of a very large
        # corpus then gets its target to within a block of that size.
        .withColumn("block", F.greatest(F.lit(1), F.ceil(F.col("total") / 2**31), F.coalesce(fine, F.lit(1))))
        .withColumn("seats", F.round(F.col("total") / (F.col("block") * F.col("shards"))).cast("bigint"))
    )
    share = F.when(F.col("total") > 0, F.col("target") / F.col("total")).otherwise(0.0)
    sure = F.floor(share * (F.col("seats") - F.col("n") / 2) + 0.5) - 1
    rows = rows.withColumn("sure", F.greatest(F.lit(0), sure).cast("bigint"))
    rows = rows.withColumn("all_sure", F.sum("sure").over(every))
    last = F.col("sure") + F.ceil(share * F.col("n")).cast("bigint") + 3
    contested = rows.where("target > 0").withColumn("seat", F.explode(F.sequence("sure", last)))
    quotient = F.col("target") / (2 * F.col("seat") + 1)
    won = contested.withColumn(
        "rank", F.row_number().over(Window.orderBy(quotient.desc(), "stratum", "seat"))
    ).where(F.col("rank") <= F.col("seats") - F.col("all_sure"))
    extra = won.groupBy("stratum").agg(F.count("*").alias("extra"))
    line = F.ceil(F.col("source_size") / F.col("block"))
    quota = F.col("sure") + F.coalesce(F.col("extra"), F.lit(0))
    return rows.join(extra, "stratum", "left").select(
        "stratum",
        "source_size",
        "weight",
        "target",
        "shards",
        "block",
        line.alias("line"),
        F.least(quota, F.floor(most * line / F.col("shards"))).cast("bigint").alias("quota"),
    )


def _overlap(start: Column, end: Column, low: Column, high: Column) -> Column:
    return F.greatest(F.lit(0), F.least(end, high) - F.greatest(start, low))


def mixed(
    docs: DataFrame,
    weights: tuple = WEIGHTS,
    shards: int = SHARDS,
    most: int = MOST_REPEATS,
    seed: str = SEED,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    keep: list[str] | None = None,
) -> DataFrame:
    """Which words of which documents a mixture of the sources takes.

    The documents of a source, in a seeded order, form a line of words, cut into
    blocks of equal length. Sainte-Lague apportionment gives each source its
    blocks per shard (:func:`block_quotas`). A source is read from a seeded block
    on, around the end of its line, until all quotas are filled; so every
    document is taken the same number of times, but for one run of the line that
    is taken once more, and only the documents at its two ends are taken in part.

    Returns ``row``, a struct of the columns ``keep`` (all by default), and ``mix``, a struct of
    ``size`` (words), ``source_size``, ``target``, ``taken`` (words, repeats counted) and
    what :func:`pieces` needs. A null or blank text has size 0 and is not taken.
    Null sources are one source, last in order. Equal rows are rows like any
    other. An empty table gives no rows.
    """
    row = F.struct(*map(F.col, docs.columns if keep is None else keep))
    sized = docs.select(
        row.alias("row"),
        F.coalesce(F.concat(F.lit("a"), F.col(source).cast("string")), F.lit("b")).alias("stratum"),
        F.size(words(filled(text))).cast("bigint").alias("size"),
        seeded_key(seed, F.col(id), F.col(source), F.col(text)).alias("key"),
    )
    narrow = stored(sized.drop("row"))
    sources = stored(narrow.groupBy("stratum").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_rows")))
    plan = block_quotas(source_targets(sources.select("stratum", "source_size"), weights, most), shards, most)
    n_rows = sources.agg(F.coalesce(F.sum("n_rows"), F.lit(0))).first()[0]
    bucket = hex_bucket(F.col("key"), even_buckets(n_rows))
    lined = running_sum(sized, ["stratum"], bucket, ["key"], "size", "start", "_size_of_source", narrow)
    offset = F.pmod(F.conv(F.substring(F.md5(F.concat(F.lit(seed), "stratum")), 1, 8), 16, 10).cast("bigint"), "line")
    plan = plan.select(
        "stratum",
        "source_size",
        "target",
        (F.col("block") * F.col("line")).alias("line"),
        F.when(F.col("line") > 0, F.col("block") * offset).otherwise(0).alias("origin"),
        (F.col("block") * F.col("quota")).alias("per_shard"),
        (F.col("block") * F.col("quota") * F.col("shards")).alias("read"),
    )
    rows = lined.join(plan, "stratum")
    laps = F.when(F.col("line") > 0, F.expr("read div line")).otherwise(0)
    rest = F.col("origin") + F.col("read") - laps * F.col("line")
    end = F.col("start") + F.col("size")
    once_more = _overlap(F.col("start"), end, F.col("origin"), rest) + _overlap(
        F.col("start"), end, F.col("origin") - F.col("line"), rest - F.col("line")
    )
    taken = (laps * F.col("size") + once_more).cast("bigint")
    kept = ["size", "source_size", "target", "start", "line", "origin", "per_shard", "read"]
    return rows.select("row", F.struct(*kept, taken.alias("taken")).alias("mix"))


def pieces(mix: DataFrame) -> DataFrame:
    """One row for each time a document, or a part of one, is read by the mixture of :func:`mixed`.

    Adds ``shard``, ``first_word`` and ``n_words`` to ``row`` and ``mix``. A piece
    belongs to the shard in which it starts.
    """
    start, size, line = F.col("mix.start"), F.col("mix.size"), F.col("mix.line")
    read = F.col("mix.read")
    place = F.pmod(start - F.col("mix.origin"), line)
    head = F.least(size, line - place)

    def cut(at: Column, first: Column, length: Column, lap: Column) -> Column:
        begins = at + lap * line
        return F.struct(
            first.cast("bigint").alias("first_word"),
            F.least(length, read - begins).cast("bigint").alias("n_words"),
            begins.cast("bigint").alias("at"),
        )

    laps = F.sequence(F.lit(0).cast("bigint"), F.expr("mix.read div mix.line"))
    both = F.flatten(
        F.transform(
            laps,
            lambda lap: F.array(
                cut(place, F.lit(0), head, lap),
                cut(F.lit(0), head, size - head, lap),
            ),
        )
    )
    found = F.when(F.col("mix.taken") > 0, F.filter(both, lambda x: x["n_words"] > 0))
    rows = mix.select("row", "mix", F.explode(found).alias("piece"))
    shard = F.expr("piece.at div mix.per_shard").cast("int")
    return rows.select("row", "mix", shard.alias("shard"), "piece.first_word", "piece.n_words")


def mixed_documents(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """The mixture itself, with the columns of ``docs``: one row for each piece, cut to its words."""
    rows = pieces(mixed(docs, text=text, **options))
    body = F.col("row")[text]
    spaced = F.regexp_extract_all(body, F.lit(rf"\s*{WORD}"), F.lit(0))
    part = F.array_join(F.slice(spaced, F.col("first_word").cast("int") + 1, F.col("n_words").cast("int")), "")
    whole = F.col("n_words") == F.col("mix.size")
    return rows.select(F.col("row").withField(text, F.when(whole, body).otherwise(part)).alias("row")).select("row.*")


def op6_source_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the weights 1, 2, 3 of their sources."""
    rows = mixed(read_table(spark, sf_dir, "documents"), keep=["doc_id", "source"])
    return rows.select("row.doc_id", "mix.size", "mix.source_size", "mix.target", "mix.taken", "row.source")


#: Seats are ranked one by one here, where the operator ranks only the last few.
OP6_SQL = f"""
WITH docs AS (
  SELECT doc_id, source, coalesce('a' || source, 'b') AS stratum,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
    md5(concat('{SEED}', chr(10), coalesce(doc_id::VARCHAR, ''), chr(10), coalesce(source, ''), chr(10), coalesce(text, ''))) AS key
  FROM documents
),
sources AS (
  SELECT stratum, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY stratum) - 1) % 3 + 1 AS weight
  FROM docs GROUP BY stratum
),
filling AS (
  SELECT *, (sum(source_size) OVER () - sum(3 * source_size) OVER f + 3 * source_size)::DOUBLE
      / (sum(weight) OVER () - sum(weight) OVER f + weight) AS level,
    3 * source_size / weight AS ratio, row_number() OVER f AS turn
  FROM sources
  WINDOW f AS (ORDER BY 3 * source_size / weight, stratum ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
),
targets AS (
  SELECT stratum, source_size, least((3 * source_size)::DOUBLE, coalesce(weight * (
      SELECT min_by(level, turn) FROM filling WHERE ratio > level), 3 * source_size)) AS target
  FROM filling
),
blocks AS (
  SELECT *, sum(source_size) OVER () AS total,
    {SHARDS}::BIGINT AS shards,
    min(CASE WHEN target > 0 THEN target END) OVER () AS smallest
  FROM targets
),
sized AS (
  SELECT *, greatest(1, ceil(total / 2147483648), coalesce(floor(smallest / ({BLOCKS_OF_SMALLEST} * shards)), 1))::BIGINT AS block
  FROM blocks
),
seats AS (
  SELECT stratum, row_number() OVER (ORDER BY target / (2 * seat + 1) DESC, stratum, seat) AS rank,
    round(total / (block * shards)) AS seats
  FROM sized, range((SELECT max(round(total / (block * shards)))::BIGINT FROM sized)) r(seat)
  WHERE target > 0 AND seat <= target / total * (total / (block * shards)) + 2
),
plan AS (
  SELECT stratum, source_size, target, block, shards, ceil(source_size / block)::BIGINT AS n_blocks,
    least(coalesce(won, 0), floor(3 * ceil(source_size / block) / shards))::BIGINT AS quota
  FROM sized LEFT JOIN (SELECT stratum, count(*) AS won FROM seats WHERE rank <= seats GROUP BY stratum) USING (stratum)
),
lines AS (
  SELECT *, block * n_blocks AS line, block * quota * shards AS read,
    CASE WHEN n_blocks > 0 THEN block * (('0x' || substr(md5('{SEED}' || stratum), 1, 8))::BIGINT % n_blocks) ELSE 0 END AS origin
  FROM plan
),
placed AS (
  SELECT *, (sum(size) OVER (PARTITION BY stratum ORDER BY key ROWS UNBOUNDED PRECEDING))::BIGINT - size AS start
  FROM docs JOIN lines USING (stratum)
),
reading AS (
  SELECT *, CASE WHEN line > 0 THEN read // line ELSE 0 END AS laps,
    origin + read - (CASE WHEN line > 0 THEN read // line ELSE 0 END) * line AS rest
  FROM placed
)
SELECT doc_id, size, source_size, target, (laps * size
  + greatest(0, least(start + size, rest) - greatest(start, origin))
  + greatest(0, least(start + size, rest - line) - greatest(start, origin - line)))::BIGINT AS taken, source
FROM reading
"""
