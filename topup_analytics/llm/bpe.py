"""Byte-level BPE: encoding whole texts to ids and decoding ids to bytes."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructType

from topup_analytics.llm.common import filled, read_table, ship_code, slices

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
#: Longer texts are split at safe boundaries near this many characters.
CHUNK = 65_536
#: The white space of the pattern (Unicode's White_Space).
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: No match of the pattern spans these places, and none looks across them: white
#: space only ever starts a match, and of a run of it all but the last character
#: go to one match whether or not something follows.
_BOUNDARY = regex.compile(rf"(?<=[^{_SPACE}])(?=[{_SPACE}])|(?<=[{_SPACE}])(?=[{_SPACE}][^{_SPACE}])")
_LONG_SPACE = regex.compile(rf"[{_SPACE}]{{{CHUNK},}}")


@lru_cache(maxsize=4)
def encoding(ranks: str = RANKS, pattern: str = PATTERN) -> tiktoken.Encoding:
    """The tokenizer of a local rank file, once per Python worker."""
    with open(ranks, "rb") as lines:
        merges = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=merges, special_tokens={})


def split_safely(text: str, chunk: int = CHUNK) -> Iterator[tuple[str, bool]]:
    """Cuts a text so that its parts encode as the whole does; True marks white space of one match.

    Parts run on where no boundary follows. Very long white space is a part of
    its own, because the pattern's matcher runs out of stack on it.
    """
    if len(text) <= chunk:
        yield text, False
        return
    at = 0
    for run in _LONG_SPACE.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        yield from _cut(text[at : run.start()], chunk)
        if end > run.start():
            yield text[run.start() : end], True
        at = end
    yield from _cut(text[at:], chunk)


def _cut(text: str, chunk: int) -> Iterator[tuple[str, bool]]:
    at = 0
    while len(text) - at > chunk and (found := _BOUNDARY.search(text, at + chunk)):
        yield text[at : found.start()], False
        at = found.start()
    yield text[at:], False


def encode_text(text: str, tokenizer: tiktoken.Encoding, chunk: int = CHUNK) -> np.ndarray:
    """The ids of one text, as the tokenizer gives them for all of it at once."""
    parts = [
        np.array(tokenizer._encode_single_piece(part), dtype=np.int32)
        if one_match
        else np.asarray(tokenizer.encode_to_numpy(part, disallowed_special=()), dtype=np.int32)
        for part, one_match in split_safely(text, chunk)
    ]
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def encode(
    rows: DataFrame,
    text: str = "text",
    ids: str = "ids",
    data: str | None = None,
    keep: list[str] | None = None,
    ranks: str = RANKS,
    pattern: str = PATTERN,
) -> DataFrame:
    """The columns ``keep`` (all by default), the ids of a text column and, if named, the bytes they decode to.

    A null or empty text has no ids. Each text is encoded whole and by itself, so
    repeated rows get equal ids. Columns named like the results are replaced. A
    batch from Spark is worked off and returned in slices, so a task holds one
    batch of texts and the ids of one slice; where texts are very long throughout,
    lower ``spark.sql.execution.arrow.maxRecordsPerBatch``.
    """
    added = [pa.field(ids, pa.list_(pa.int32()))] + ([pa.field(data, pa.binary())] if data else [])
    kept = [c for c in (rows.columns if keep is None else keep) if c not in [f.name for f in added]]
    source = rows.select(*[F.col(c) for c in kept], filled(text).alias("_text"))
    schema = StructType(source.schema.fields[:-1]).add(ids, ArrayType(IntegerType()))
    if data:
        schema = schema.add(data, BinaryType())
    ship_code(rows.sparkSession)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = encoding(ranks, pattern)
        for batch in batches:
            for part in slices(batch):
                arrays = [encode_text(t, tokenizer) for t in part.column(len(kept)).to_pylist()]
                columns = [*part.columns[:-1], pa.array(arrays, added[0].type)]
                if data:
                    columns.append(pa.array([tokenizer.decode_bytes(a.tolist()) for a in arrays], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, [*kept, *[f.name for f in added]])

    return source.mapInArrow(encoded, schema)


def decode(rows: DataFrame, ids: str = "ids", data: str = "data", ranks: str = RANKS, pattern: str = PATTERN) -> DataFrame:
    """Adds the raw bytes of an id column, which need not be whole characters; null ids give no bytes.

    An id that the rank file lacks fails the job. A column named ``data`` is
    replaced.
    """
    ship_code(rows.sparkSession)

    @F.pandas_udf("binary")
    def decoded(arrays: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokenizer = encoding(ranks, pattern)
        for batch in arrays:
            yield pd.Series([tokenizer.decode_bytes(a.tolist()) for a in batch], dtype=object)

    known = F.coalesce(F.col(ids), F.array().cast("array<int>"))
    return rows.withColumn(data, decoded(known))


def ids_digest(ids: str = "ids"):
    """Lower-case hex SHA-256 of decimal ids joined by commas."""
    return F.sha2(F.array_join(F.col(ids).cast("array<string>"), ","), 256)


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids of all whole documents and of their decoded bytes."""
    docs = read_table(spark, sf_dir, "documents")
    return encode(docs, data="data", keep=["doc_id"]).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        ids_digest().alias("ids_sha256"),
        F.sha2("data", 256).alias("decoded_sha256"),
    )
