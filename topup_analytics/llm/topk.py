"""Exact top-k inner products with a bit-sliced index."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from topup_analytics.llm.common import read_table, ship_code, stored

SCALE = 256
#: Components and scores are bigints; those that would not fit fail the query.
LIMIT = 1 << 63
BLOCK_ROWS = 8192
BLOCK_QUERIES = 256
#: A row of the search has one block of the index and up to so many blocks of queries.
MOST_TOGETHER = 16
K = 5

_INDEX = "block bigint, ids binary, low binary, sizes binary, slices binary"


def quantised(vector: Column) -> Column:
    """floor(256 * x) of each component; null for vectors that are null or hold null or non-finite components.

    Fails where a component does not fit a bigint.
    """
    value = lambda x: x.cast("double")
    usable = F.forall(vector, lambda x: x.isNotNull() & (F.abs(value(x)) < float("inf")) & ~F.isnan(value(x)))
    fits = lambda x: (value(x) * SCALE >= float(-LIMIT)) & (value(x) * SCALE < float(LIMIT))
    too_large = F.raise_error(F.lit("a quantised component does not fit a bigint")).cast("bigint")
    return F.when(usable, F.transform(vector, lambda x: F.when(fits(x), F.floor(value(x) * SCALE)).otherwise(too_large)))


def _matrix(vectors: pd.Series) -> np.ndarray:
    """Rows of components; shorter vectors end in zeros."""
    width = max((len(v) for v in vectors), default=0)
    rows = np.zeros((len(vectors), max(width, 1)), dtype=np.int64)
    for row, vector in zip(rows, vectors):
        row[: len(vector)] = vector
    return rows


def build_block(ids: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids in order, the lowest value and number of slices of each attribute, and the slices as bitmaps.

    An attribute is stored as its distance from its lowest value in the block.
    Slice ``i`` of an attribute is a bitmap of bit ``i`` over the block's rows.
    """
    order = np.argsort(ids, kind="stable")
    ids, rows = ids[order], rows[order]
    low = rows.min(axis=0)
    # Modulo 2**64, so that the distance of any two bigints fits.
    raised = (rows.astype(np.uint64) - low.astype(np.uint64)).T
    sizes = np.array([int(m).bit_length() for m in raised.max(axis=1)], dtype=np.int64)
    padded = np.zeros((len(raised), -(-len(ids) // 64) * 64), dtype=np.uint64)
    padded[:, : len(ids)] = raised
    slices = [np.packbits((padded[d] >> np.uint64(i)).astype(np.uint8) & 1, bitorder="little") for d in range(len(raised)) for i in range(sizes[d])]
    joined = np.concatenate(slices).view(np.uint64) if slices else np.zeros(0, dtype=np.uint64)
    return ids, low, sizes, joined


def _added(weighed: dict[int, list[np.ndarray]], words: int) -> list[np.ndarray]:
    """The slices of the sum of weighed bitmaps, by carry-save and half adders on whole bitmaps."""
    total, weight = [], 0
    while weighed:
        parts = weighed.pop(weight, [])
        bits = np.concatenate(parts) if parts else np.zeros((0, words), dtype=np.uint64)
        while len(bits) > 1:
            if len(bits) == 2:
                carry = bits[:1] & bits[1:]
                bits = bits[:1] ^ bits[1:]
            else:
                third = len(bits) // 3
                a, b, c = bits[:third], bits[third : 2 * third], bits[2 * third : 3 * third]
                half = a ^ b
                carry = (a & b) | (half & c)
                bits = np.concatenate([half ^ c, bits[3 * third :]])
            weighed.setdefault(weight + 1, []).append(carry)
        total.append(bits[0] if len(bits) else np.zeros(words, dtype=np.uint64))
        weight += 1
    return total


class Block:
    """A block of the index, and searches in it."""

    def __init__(self, ids: np.ndarray, low: np.ndarray, sizes: np.ndarray, slices: np.ndarray):
        self.ids, self.low, self.sizes = ids, low, sizes
        self.words = -(-len(ids) // 64)
        bits = slices.reshape(-1, self.words)
        # Complements stand behind the slices, for negative factors.
        self.bits = np.concatenate([bits, ~bits])
        self.n_slices = len(bits)
        self.attribute = np.repeat(np.arange(len(sizes)), sizes)
        self.bit = np.concatenate([np.arange(s) for s in sizes]) if len(bits) else np.zeros(0, dtype=np.int64)
        valid = np.zeros(self.words * 64, dtype=np.uint8)
        valid[: len(ids)] = 1
        self.valid = np.packbits(valid, bitorder="little").view(np.uint64)

    def scores(self, query: np.ndarray) -> tuple[list[np.ndarray], int]:
        """Slices of (score - offset) of every row, and the offset.

        A positive factor adds its multiple of an attribute: slice i of the
        attribute has weight i + j for each bit j of the factor. A negative factor
        adds its absolute multiple of the complement, and the offset makes up.
        """
        width = max(len(query), len(self.low))
        factor = np.zeros(width, dtype=np.int64)
        factor[: len(query)] = query
        factor = factor[: len(self.low)]
        size = np.abs(factor).astype(np.uint64)
        # In Python's integers, which do not overflow.
        each = zip(factor.tolist(), self.low.tolist(), self.sizes.tolist())
        offset = sum(f * (low + (1 << n) - 1 if f < 0 else low) for f, low, n in each)
        weighed: dict[int, list[np.ndarray]] = {}
        place = np.arange(self.n_slices) + np.where(factor < 0, self.n_slices, 0)[self.attribute]
        of_slice = size[self.attribute]
        for j in range(int(size.max()).bit_length()):
            used = (of_slice >> np.uint64(j)) & np.uint64(1) == 1
            weight = self.bit[used] + j
            rows = place[used]
            for w in np.unique(weight):
                weighed.setdefault(int(w), []).append(self.bits[rows[weight == w]])
        return _added(weighed, self.words), offset

    def best(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, list[int]]:
        """Ids and scores of the ``k`` best rows but those with the query's own id; ties to smaller ids."""
        slices, offset = self.scores(query)
        equal = self.valid.copy()
        first, last = np.searchsorted(self.ids, [own, own + 1])
        for row in range(first, last):
            equal[row // 64] &= ~(np.uint64(1) << np.uint64(row % 64))
        above = np.zeros_like(equal)
        n_above = 0
        for bits in reversed(slices):
            with_bit = equal & bits
            n = n_above + int(np.bitwise_count(with_bit).sum())
            if n > k:
                equal = with_bit
            else:
                above |= with_bit
                n_above = n
                equal &= ~bits
                if n == k:
                    break
        chosen = _rows(above)
        if n_above < k:  # The rows left have equal scores, and rows are in the order of their ids.
            chosen = np.concatenate([chosen, _rows(equal)[: k - n_above]])
        bits = [(s[chosen // 64] >> (chosen % 64).astype(np.uint64)) & np.uint64(1) for s in slices]
        scores = [offset + sum(int(b[i]) << w for w, b in enumerate(bits)) for i in range(len(chosen))]
        if any(not -LIMIT <= score < LIMIT for score in scores):
            raise OverflowError("a score does not fit a bigint")
        return self.ids[chosen], scores


def _rows(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def bit_sliced_index(rows: DataFrame, n_blocks: int) -> DataFrame:
    """The index of rows ``vec_id, vector``: one row for each block of about ``BLOCK_ROWS``."""
    ship_code(rows.sparkSession)

    def build(group: pd.DataFrame) -> pd.DataFrame:
        ids, low, sizes, slices = build_block(group["vec_id"].to_numpy(), _matrix(group["vector"]))
        return pd.DataFrame(
            {
                "block": [group["block"].iloc[0]],
                "ids": [ids.tobytes()],
                "low": [low.tobytes()],
                "sizes": [sizes.tobytes()],
                "slices": [slices.tobytes()],
            }
        )

    block = F.pmod(F.xxhash64("vec_id", "vector"), F.lit(n_blocks))
    return rows.withColumn("block", block).groupBy("block").applyInPandas(build, _INDEX)


def top_k(
    vectors: DataFrame, is_query: Column, k: int = K, id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """The ``k`` highest integer inner products of every query row with every other row.

    Components are quantised to floor(256 * x); one that does not fit a bigint, or a
    score among a block's best that does not, fails the query. Rows are indexed in blocks of
    about ``BLOCK_ROWS``; queries, in blocks of ``BLOCK_QUERIES``, are sent to every
    block of the index, where bitmap arithmetic adds up the scores of all rows, the
    best are picked from the most significant slice downward, and rows that tie at
    the boundary go in the order of their ids. Up to ``MOST_TOGETHER`` blocks of queries travel with a
    block of the index, fewer if there would be too few tasks. The blocks' winners, ``k`` for each,
    are then ranked.

    ``is_query`` is an expression over ``vec_id``. Returns ``query_id, rank, vec_id,
    score``; fewer than ``k`` rows if there are fewer. Rows whose id is null, or
    whose vector is null or holds null or non-finite components, take no part.
    Shorter vectors count as ending in zeros. Equal rows are one row; different
    rows of one id are rows of their own, as queries too, but never find their id.
    An empty table gives no rows. Columns other than the two are not read, whatever their names.
    """
    ship_code(vectors.sparkSession)
    rows = stored(
        vectors.select(F.col(id).cast("bigint").alias("vec_id"), quantised(F.col(vector)).alias("vector"))
        .where("vec_id is not null and vector is not null")
        .distinct()
    )
    queries = rows.where(is_query)
    n_blocks = max(1, -(-rows.count() // BLOCK_ROWS))
    n_groups = max(1, -(-queries.count() // BLOCK_QUERIES))
    index = stored(bit_sliced_index(rows, n_blocks))

    def gather(group: pd.DataFrame) -> pd.DataFrame:
        matrix = _matrix(group["vector"])
        return pd.DataFrame(
            {
                "query_block": [group["query_block"].iloc[0]],
                "query_ids": [group["vec_id"].to_numpy().tobytes()],
                "queries": [matrix.tobytes()],
            }
        )

    grouped = queries.withColumn("query_block", F.pmod(F.xxhash64("vec_id", "vector", F.lit(1)), F.lit(n_groups)))
    blocks = grouped.groupBy("query_block").applyInPandas(
        gather, "query_block bigint, query_ids binary, queries binary"
    )
    # So many rows of the search for each block of the index, that tasks are many and none is large.
    enough = -(-4 * vectors.sparkSession.sparkContext.defaultParallelism // n_blocks)
    n_together = min(n_groups, max(-(-n_groups // MOST_TOGETHER), enough))
    together = blocks.withColumn("together", F.col("query_block") % n_together)
    together = together.groupBy("together").agg(F.collect_list(F.struct(*blocks.columns)).alias("queries"))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))
    # Adaptive execution would put rows that are small, and take long, into few tasks; a given number of partitions stays.
    n_tasks = min(n_blocks * n_together * 4, 100_000)
    key = ["block", "together"]
    everywhere = together.withColumn("block", every(n_blocks)).repartition(n_tasks, *key)
    there = index.withColumn("together", every(n_together)).repartition(n_tasks, *key)

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                words = [np.frombuffer(x, dtype=np.int64) for x in (row.ids, row.low, row.sizes)]
                block = Block(*words, np.frombuffer(row.slices, dtype=np.uint64))
                for group in row.queries:
                    ids = np.frombuffer(group["query_ids"], dtype=np.int64)
                    queries = np.frombuffer(group["queries"], dtype=np.int64).reshape(len(ids), -1)
                    out = []
                    for i, (own, query) in enumerate(zip(ids, queries)):
                        for found, score in zip(*block.best(query, int(own), k)):
                            out.append((group["query_block"], i, int(own), int(found), score))
                    yield pd.DataFrame(out, columns=["query_block", "i", "query_id", "vec_id", "score"])

    found = there.join(everywhere.hint("shuffle_hash"), key).mapInPandas(
        search, "query_block bigint, i int, query_id bigint, vec_id bigint, score bigint"
    )
    best = Window.partitionBy("query_block", "i").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def op2_bit_sliced_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best rows for every row whose id is divisible by 50."""
    return top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


OP2_SQL = """
WITH rows AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS vector
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
pairs AS (
  SELECT q.vec_id AS query_id, r.vec_id, list_inner_product(q.vector, r.vector)::BIGINT AS score
  FROM rows q JOIN rows r ON q.vec_id % 50 = 0 AND q.vec_id <> r.vec_id
)
SELECT query_id, (row_number() OVER b)::INTEGER AS rank, vec_id, score FROM pairs
WINDOW b AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER b <= 5
"""
