"""Language identification by a mixture of languages in each document."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructType

from topup_analytics.llm.common import filled, held_out, read_table, ship_code, slices

#: Character trigrams are hashed to so many buckets.
BUCKET_BITS = 12
BUCKETS = 1 << BUCKET_BITS
#: Different texts of each language that the model is learned from, about; all if there are fewer.
FIT_TEXTS = 20_000
SMOOTHING = 0.5
#: Languages whose logarithms are held at once.
LANGUAGE_BLOCK = 256
#: Documents inferred together; bounds the memory of a task.
BLOCK = 256
#: A further language must raise the log likelihood by this many times the log of the number
#: of trigrams. Each letter is in three trigrams, so the usual half is taken three times.
PENALTY = 1.5
#: Shares are settled once no others can raise the log likelihood by this part of the penalty.
SETTLED = 0.05
UNDETERMINED = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point, itself if it is a letter, else a space."""
    table = np.arange(0x110000, dtype=np.uint32)
    table[[i for i in range(0x110000) if not chr(i).isalpha()]] = 32
    return table


def trigram_counts(text: str) -> np.ndarray | None:
    """Counts by bucket of the trigrams inside words, with a space at their ends; None without letters."""
    lowered = f" {text.lower()} ".encode("utf-32-le", "surrogatepass")
    points = _letters()[np.frombuffer(lowered, dtype=np.uint32)]
    blank = points == 32
    points = points[~(blank & np.concatenate(([False], blank[:-1])))]
    if len(points) < 3:
        return None
    a, b, c = points[:-2], points[1:-1], points[2:]
    mixed = (a * np.uint32(0x9E3779B1)) ^ (b * np.uint32(0x85EBCA6B)) ^ (c * np.uint32(0xC2B2AE35))
    mixed = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    buckets = (mixed >> np.uint32(32 - BUCKET_BITS))[b != 32]
    return np.bincount(buckets, minlength=BUCKETS)


def learn(docs: DataFrame, text: str = "text", lang: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages, and the probability of each trigram bucket in them (buckets by languages).

    Learned from about ``FIT_TEXTS`` different texts of each language, chosen by a
    hash of the text; copies count as one. Texts are compared by 64-bit hashes, and
    only chosen ones are shuffled. Every labelled language is learned; its counts are as many as there
    are buckets, and a row for each label comes to the driver. Rows with a null text or language are left out; other
    columns, whatever their names are, are not read.
    """
    ship_code(docs.sparkSession)
    labelled = docs.select(filled(text).alias("text"), F.col(lang).alias("lang")).where("lang is not null and text <> ''")
    hashed = labelled.withColumn("hash", F.xxhash64("text"))
    sizes = hashed.select("lang", "hash").distinct().groupBy("lang").count().collect()
    if not sizes:
        return [], np.zeros((BUCKETS, 0))
    share = F.create_map(*[x for row in sizes for x in (F.lit(row["lang"]), F.lit(FIT_TEXTS / row["count"]))])
    chosen = F.pmod("hash", F.lit(1 << 40)) < F.try_element_at(share, F.col("lang")) * float(1 << 40)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in slices(batch):
                for body, name in zip(*(c.to_pylist() for c in part.columns)):
                    found = trigram_counts(body)
                    if found is not None:
                        totals[name] = totals.get(name, 0) + found
        for name, found in totals.items():
            used = np.flatnonzero(found)
            columns = [pa.array([name] * len(used)), pa.array(used, pa.int32()), pa.array(found[used], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "bucket", "n"])

    different = hashed.where(chosen).groupBy("lang", "hash").agg(F.first("text").alias("text")).select("text", "lang")
    counted = different.mapInArrow(count, "lang string, bucket int, n bigint")
    rows = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    names = sorted(set(rows["lang"].to_pylist()))
    counts = np.full((BUCKETS, len(names)), SMOOTHING)
    at = [names.index(name) for name in rows["lang"].to_pylist()]
    counts[rows["bucket"].to_numpy(), at] += rows["n"].to_numpy()
    return names, counts / counts.sum(axis=0)


def _settle(counts: np.ndarray, parts: np.ndarray, shares: np.ndarray, known: float, penalty: float) -> tuple[np.ndarray, float]:
    """Expectation-maximisation of one text's shares in a set of languages, and their log likelihood.

    ``parts`` has the set's probabilities of the text's buckets. The largest slope
    less the number of trigrams bounds what any other shares of the set could add:
    steps end once that is little, or once the set cannot exceed ``known`` by the penalty.
    """
    n = counts.sum()
    while True:
        mixed = parts @ shares
        likelihood = counts @ np.log(mixed)
        slope = (counts / mixed) @ parts
        left = slope.max() - n
        if left <= SETTLED * penalty + 1e-9 * n or likelihood + left <= known + penalty:
            return shares, likelihood
        moved = shares * slope / n
        if np.array_equal(moved, shares):
            return shares, likelihood
        shares = moved


def _languages(counts: np.ndarray, model: np.ndarray, single: np.ndarray) -> np.ndarray:
    """The shares of one text's languages, from the likelihoods of each language alone."""
    used = np.flatnonzero(counts)
    n_here = counts[used].astype(np.float64)
    n = n_here.sum()
    penalty = PENALTY * np.log(n)
    members, shares = [int(single.argmax())], np.ones(1)
    parts = model[used][:, members].astype(np.float64)
    likelihood = n_here @ np.log(parts[:, 0])
    while len(members) < model.shape[1]:
        ratio = np.zeros(len(counts), dtype=model.dtype)
        ratio[used] = n_here / (parts @ shares)
        # No language adds more to the likelihood than its slope exceeds the number of trigrams.
        slope = ratio @ model
        slope[members] = 0
        hopeful = np.flatnonzero(slope - n > penalty)
        best = None
        for other in hopeful[np.argsort(-slope[hopeful], kind="stable")]:
            wider = np.column_stack([parts, model[used, other]])
            part = 1 / (len(members) + 1)
            known = likelihood if best is None else best[0] - penalty
            found, fit = _settle(n_here, wider, np.append(shares * (1 - part), part), known, penalty)
            if fit > known + penalty:
                best = fit, int(other), wider, found
        if best is None:
            break
        likelihood, other, parts, shares = best
        members.append(other)
    chosen = np.zeros(model.shape[1])
    chosen[members] = shares / shares.sum()
    return chosen


def infer(counts: np.ndarray, model: np.ndarray) -> np.ndarray:
    """The languages' shares in each row of counts (rows by buckets); 0 for languages not chosen.

    A text starts with the language that explains it best. The language that raises
    the likelihood most is added as long as that exceeds the penalty; neither the
    number of languages nor their shares are limited.
    """
    blocks = [model[:, at : at + LANGUAGE_BLOCK] for at in range(0, model.shape[1], LANGUAGE_BLOCK)]
    single = np.concatenate([counts @ np.log(block) for block in blocks], axis=1)
    return np.stack([_languages(row, model, own) for row, own in zip(counts, single)]).astype(counts.dtype)


def with_languages(
    docs: DataFrame, names: list[str], model: np.ndarray, text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """The struct ``row`` of the columns ``keep`` (all by default), and the languages of every whole text.

    ``languages`` is the chosen set, largest share first, with its ``shares``;
    ``lang_pred`` is its first member and ``score`` that member's share. A text that
    is null or has no letters is undetermined, with score 0 and no languages; so is
    every text where the model knows no language. Each row is predicted from its
    text alone, so ids may be null or repeated; an empty table gives no rows. Whole texts are read, however long, and
    the columns in ``row`` may have any names.
    """
    ship_code(docs.sparkSession)
    small, names = model.astype(np.float32), list(names)
    rows = docs.select(F.struct(*(docs.columns if keep is None else keep)).alias("row"), filled(text).alias("text"))
    schema = StructType([rows.schema["row"], *_PREDICTED.fields])

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, BLOCK):
                found = _predict(part.column(1).to_pylist(), names, small)
                columns = [pa.array(v, t) for v, t in zip(zip(*found), _ARROW)]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], schema.names)

    return rows.mapInArrow(predicted, schema)


_PREDICTED = (
    StructType()
    .add("lang_pred", StringType())
    .add("score", DoubleType())
    .add("languages", ArrayType(StringType()))
    .add("shares", ArrayType(DoubleType()))
)
_ARROW = [pa.string(), pa.float64(), pa.list_(pa.string()), pa.list_(pa.float64())]


def _predict(texts: list[str], names: list[str], model: np.ndarray) -> list[tuple]:
    found = [trigram_counts(t) if names else None for t in texts]
    rows = [i for i, x in enumerate(found) if x is not None]
    out = [(UNDETERMINED, 0.0, [], [])] * len(found)
    if rows:
        shares = infer(np.stack([found[i] for i in rows]).astype(np.float32), model)
        order = np.argsort(-shares, axis=1, kind="stable")
        for row, own, ranked in zip(rows, shares, order):
            kept = [k for k in ranked if own[k] > 0]
            parts = [min(1.0, float(own[k])) for k in kept]
            out[row] = (names[kept[0]], parts[0], [names[k] for k in kept], parts)
    return out


def op8_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all whole documents, learned from two thirds of them."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    names, model = learn(docs.where(~held_out()))
    rows = with_languages(docs, names, model, keep=["doc_id"])
    return rows.select("row.doc_id", held_out("row.doc_id").alias("held_out"), *_PREDICTED.names)
