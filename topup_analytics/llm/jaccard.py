"""Near duplicates: an n-gram Jaccard join with adaptive multi-match prefixes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topup_analytics.llm.common import Scratch, filled, read_table, ship_code, slices, stored
from topup_analytics.llm.components import components
from topup_analytics.llm.shingles import mix, shingle_set

#: Shingles are counted in so many buckets, and the table that orders them has a byte for each.
COUNT_BITS = 23
#: Counts travel in slices of so many buckets.
SLICE = 65_536
#: Slices are summed in groups of so many tasks, and these again.
FAN_IN = 64
#: A prefix asks for one of these numbers of shared shingles.
MATCHES = np.array([1, 2, 3, 5, 8, 13, 21, 34])
#: What it costs to verify a pair, in prefix rows looked up.
VERIFY_COST = 20.0
#: Texts, or pairs of them, that a task takes to verify.
TEXTS = 4096
#: Rows of one token that meet in a task, on either side.
SIDE_ROWS = 4096
#: Words of 64 bits in the parity sketch that goes with prefix rows.
SKETCH = 8
#: The sketch that pairs are checked by has at least two bits for each shingle, within these bounds.
LEAST_WIDE, MOST_WIDE = 1024, 16_384
#: A bitmap that picks rows by a hash has 16 bits for each value, up to 2 ** this many.
MOST_BITMAP_BITS = 27


def least_overlap(n: int, percent: int) -> int:
    """The fewest shingles that a set of ``n`` shares with any set it is linked with."""
    return -(-percent * n // 100)


def set_id(hashes: np.ndarray) -> int:
    """A 64-bit identity of a set of hashes."""
    total = mix(hashes ^ np.uint64(0xA0761D6478BD642F)).sum(dtype=np.uint64) + np.uint64(len(hashes))
    return int(mix(np.array([total], dtype=np.uint64)).view(np.int64)[0])


def parity_sketch(hashes: np.ndarray, bits: int) -> np.ndarray:
    """For each of some hash classes, whether the set has an odd number in it; bits in bytes.

    Shared members cancel, so two sketches differ in at most as many bits as the
    sets have members that they do not share.
    """
    odd = np.bincount((hashes & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little")


def wide_sketch(hashes: np.ndarray) -> bytes:
    """A parity sketch whose size follows that of the set."""
    bits = 1 << (2 * len(hashes) - 1).bit_length()
    return parity_sketch(hashes, min(MOST_WIDE, max(LEAST_WIDE, bits))).tobytes()


def unshared(x: bytes, y: bytes) -> int:
    """A lower bound of the members that two sets do not share, from their wide sketches.

    Folding a sketch in halves gives the sketch of fewer classes.
    """
    small = min(len(x), len(y))
    a, b = (np.bitwise_xor.reduce(np.frombuffer(s, dtype=np.uint8).reshape(-1, small), axis=0) for s in (x, y))
    return int(np.bitwise_count(a ^ b).sum())


def most_unshared(sizes: int, percent: int) -> int:
    """How many members two linked sets of ``sizes`` members in all may not share."""
    return sizes - 2 * -(-percent * sizes // (100 + percent))


#: A load is kept as a byte: 8 times the logarithm of one more.
_LOADS = np.exp2(np.arange(256) / 8) - 1


def choose_prefix(hashes: np.ndarray, loads: np.ndarray, percent: int) -> tuple[int, np.ndarray]:
    """How many matches to ask for, and the prefix that guarantees them.

    Shingles are ordered by their bucket's load, then by hash: one order for all
    sets, rare first. If two sets are linked, their first ``n - overlap + m``
    shingles share ``m``. A longer prefix looks up more rows but leaves fewer pairs
    with enough matches to verify; ``loads`` estimates how many other sets hold a
    shingle, and the cheapest ``m`` is taken.
    """
    n = len(hashes)
    overlap = least_overlap(n, percent)
    spare = n - overlap
    matches = MATCHES[MATCHES <= overlap]
    codes = loads[(hashes >> np.uint64(64 - COUNT_BITS)).astype(np.int64)]
    order = np.lexsort((hashes, codes))[: spare + matches[-1]]
    lengths = spare + matches
    candidates = np.cumsum(_LOADS[codes[order]])[lengths - 1]
    cost = lengths + candidates * (1 + VERIFY_COST / matches)
    best = int(cost.argmin())
    return int(matches[best]), hashes[order[: lengths[best]]]


def _measured(texts: DataFrame, width: int) -> DataFrame:
    """For each text its set's identity and size; and, from each task, the counts of its shingles by bucket."""
    ship_code(texts.sparkSession)
    schema = "doc_id bigint, text_id bigint, node bigint, n int, slice int, counts binary"
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
    names = ["doc_id", "text_id", "node", "n", "slice", "counts"]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << COUNT_BITS, dtype=np.uint32)
        for batch in batches:
            for part in slices(batch):
                sets = [shingle_set(t, width) for t in part.column(2).to_pylist()]
                buckets = np.concatenate(sets) >> np.uint64(64 - COUNT_BITS)
                found, times = np.unique(buckets.astype(np.int32), return_counts=True)
                counts[found] += times.astype(np.uint32)
                nodes = [set_id(s) if len(s) else None for s in sets]
                none = [None] * len(sets)
                values = [part.column(0), part.column(1), nodes, [len(s) for s in sets], none, none]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types)], names)
        task = TaskContext.get().partitionId()
        for number, part in enumerate(counts.reshape(-1, SLICE)):
            if part.any():
                # The number of the task stands in for the text's.
                values = [[None], [task], [None], [None], [number], [_pack(part)]]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types)], names)

    return texts.select("doc_id", "text_id", "text").mapInArrow(measure, schema)


def _pack(counts: np.ndarray) -> bytes:
    """A slice's counts: those that are not zero, with their places, or all of them where that is shorter."""
    used = np.flatnonzero(counts)
    if 6 * len(used) < 4 * len(counts):
        return counts[used].astype("<u4").tobytes() + used.astype("<u2").tobytes()
    return counts.astype("<u4").tobytes()


def _unpack(data: bytes, into: np.ndarray) -> None:
    """Adds packed counts to a slice."""
    if len(data) == 4 * len(into):
        into += np.frombuffer(data, dtype="<u4")
    else:
        used = len(data) // 6
        into[np.frombuffer(data, dtype="<u2", offset=4 * used)] += np.frombuffer(data, dtype="<u4", count=used)


def _loads(measured: DataFrame) -> np.ndarray:
    """For each bucket, how many more shingles it holds than a bucket does by chance, as a byte."""
    usual = (measured.agg(F.sum("n")).first()[0] or 0) / (1 << COUNT_BITS)

    def added(group: pa.Table) -> np.ndarray:
        counts = np.zeros(SLICE, dtype=np.int64)
        for data in group["counts"]:
            _unpack(data.as_py(), counts)
        return counts

    def total(group: pa.Table) -> pa.Table:
        kept = np.minimum(added(group), 2**32 - 1)
        return pa.table({"slice": group["slice"][:1], "task": group["task"][:1], "counts": pa.array([_pack(kept)])})

    def coded(group: pa.Table) -> pa.Table:
        more = np.maximum(0, added(group) - usual - 2 * np.sqrt(usual))
        return pa.table({"slice": group["slice"][:1], "codes": pa.array([np.rint(8 * np.log2(1 + more)).clip(0, 255).astype(np.uint8).tobytes()])})

    rows = measured.where("slice is not null").select("slice", F.col("text_id").alias("task"), "counts")
    for _ in range(2):
        rows = rows.withColumn("task", F.expr(f"task div {FAN_IN}"))
        rows = rows.groupBy("slice", "task").applyInArrow(total, "slice int, task bigint, counts binary")
    loads = np.zeros(1 << COUNT_BITS, dtype=np.uint8)
    for row in rows.groupBy("slice").applyInArrow(coded, "slice int, codes binary").toArrow().to_pylist():
        loads[row["slice"] * SLICE : (row["slice"] + 1) * SLICE] = np.frombuffer(row["codes"], dtype=np.uint8)
    return loads


def _prefixes(texts: DataFrame, loads: np.ndarray, width: int, percent: int) -> DataFrame:
    """For each set its size, matches to ask for, prefix and sketch; equal sets have equal rows, and one from a task."""
    ship_code(texts.sparkSession)
    schema = "node bigint, n int, matches int, prefix array<bigint>, sketch array<bigint>, wide binary"
    arrow = pa.schema(
        [("node", pa.int64()), ("n", pa.int32()), ("matches", pa.int32())]
        + [("prefix", pa.list_(pa.int64())), ("sketch", pa.list_(pa.int64())), ("wide", pa.binary())]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # of one partition's texts
        for batch in batches:
            for part in slices(batch, 64):
                found = {}
                for text in part.column(0).to_pylist():
                    if len(hashes := shingle_set(text, width)) and (node := set_id(hashes)) not in seen:
                        seen.add(node)
                        found[node] = hashes
                sets = list(found.values())
                chosen = [choose_prefix(s, loads, percent) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(list(found), pa.int64()),
                        pa.array([len(s) for s in sets], pa.int32()),
                        pa.array([m for m, _ in chosen], pa.int32()),
                        pa.array([p.view(np.int64) for _, p in chosen], arrow[3].type),
                        pa.array([parity_sketch(s, 64 * SKETCH).view(np.int64) for s in sets], arrow[4].type),
                        pa.array([wide_sketch(s) for s in sets], pa.binary()),
                    ],
                    schema=arrow,
                )

    return texts.select("text").mapInArrow(cut, schema)


def _bitmap(values: DataFrame, n: int) -> np.ndarray:
    """A bitmap of the lowest bits of the first column's ``n`` values.

    It is bounded: as it fills up it lets more rows pass, and the joins that follow
    are exact.
    """
    bits = min(MOST_BITMAP_BITS, max(16, (16 * n).bit_length()))
    place = F.col(values.columns[0]).bitwiseAND(F.lit((1 << bits) - 1))
    words = values.select(F.shiftright(place, 6).alias("word"), place.bitwiseAND(F.lit(63)).cast("int").alias("bit"))
    found = words.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")).toArrow()
    bitmap = np.zeros(1 << (bits - 6), dtype=np.uint64)
    bitmap[found["word"].to_numpy().astype(np.int64)] = found["bits"].to_numpy().view(np.uint64)
    return bitmap


def _hits(bitmap: np.ndarray, values: np.ndarray) -> np.ndarray:
    places = values & (64 * len(bitmap) - 1)
    return (bitmap[places >> 6] >> (places & 63).astype(np.uint64)) & np.uint64(1) == 1


def _wanted_texts(texts: DataFrame, measured: DataFrame, nodes: DataFrame, most: int, scratch: Scratch) -> DataFrame:
    """One text for each of the nodes, ``most`` at most. The other texts are not shuffled."""
    of_node = measured.where("node is not null").groupBy("node").agg(F.min("text_id").alias("text_id"))
    wanted, n = scratch.counted(nodes.join(of_node, "node").select("text_id", "node"), most)
    bitmap = _bitmap(wanted, n)
    ship_code(texts.sparkSession)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_hits(bitmap, batch.column(0).to_numpy())))

    picked = texts.select("text_id", "text").mapInArrow(pick, "text_id bigint, text string")
    once = picked.groupBy("text_id").agg(F.first("text").alias("text"))
    return scratch.stored(once.join(wanted, "text_id").select("node", "text"), n, TEXTS)


def _not_ruled_out(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs whose wide sketches do not show that too few shingles are shared."""
    side = lambda name: sketches.select(F.col("node").alias(name), F.struct("set.n", "wide").alias(f"of_{name}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    flat = both.select("a", "b", (F.col("of_a.n") + F.col("of_b.n")).alias("sizes"), "of_a.wide", F.col("of_b.wide").alias("other"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                sizes, x, y = (c.to_pylist() for c in part.columns[2:])
                fits = [unshared(i, j) <= most_unshared(n, percent) for n, i, j in zip(sizes, x, y)]
                yield pa.RecordBatch.from_arrays(part.columns[:2], ["a", "b"]).filter(pa.array(fits))

    return flat.mapInArrow(compare, "a bigint, b bigint")


def _verified(
    pairs: DataFrame, most: int | None, sketches: DataFrame, texts: DataFrame, measured: DataFrame, width: int, percent: int, scratch: Scratch
) -> tuple[DataFrame, int]:
    """The pairs ``a, b`` whose sets are linked, and their number. ``a`` may be one node in very many pairs."""
    ship_code(pairs.sparkSession)
    pairs, n = scratch.counted(pairs.select("a", "b"), most)
    pairs, n = scratch.counted(_not_ruled_out(pairs, sketches, percent), n, TEXTS)
    both = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    wanted = _wanted_texts(texts, measured, both, 2 * n, scratch)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, np.ndarray] = {}
        for batch in batches:
            for part in slices(batch, 64):
                a, b, text_a, text_b = (c.to_pylist() for c in part.columns)
                hits = []
                for x, y, tx, ty in zip(a, b, text_a, text_b):
                    if x not in kept:
                        if len(kept) >= 64:
                            kept.clear()
                        kept[x] = shingle_set(tx, width)
                    one, other = kept[x], shingle_set(ty, width)
                    shared = len(np.intersect1d(one, other, assume_unique=True))
                    hits.append(100 * shared >= percent * (len(one) + len(other) - shared))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1)], ["a", "b"]).filter(pa.array(hits))

    with_a = pairs.join(wanted.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    with_b = with_a.join(wanted.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    return scratch.counted(with_b.select("a", "b", "text_a", "text_b").mapInArrow(verify, "a bigint, b bigint"), n, TEXTS)


def _members(nodes: DataFrame, scratch: Scratch) -> tuple[DataFrame, int, int]:
    """Rows ``token, node`` of the prefix shingles that more than one set has; the number of rows and of shingles.

    All prefix shingles are shuffled once, to be counted. A bitmap of those that
    count then picks their rows, so that the others are not shuffled again.
    """
    tokens = nodes.select("node", F.explode("prefix").alias("token"))
    ends = tokens.groupBy("token").agg(F.min("node").alias("least"), F.max("node").alias("most"))
    shared, n_shared = scratch.counted(ends.where("least < most").select("token"))
    bitmap = _bitmap(shared, n_shared)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(1).flatten().to_numpy()
            node = np.repeat(batch.column(0).to_numpy(), batch.column(1).value_lengths().to_numpy())
            hit = _hits(bitmap, values)
            yield pa.RecordBatch.from_arrays([pa.array(values[hit]), pa.array(node[hit])], ["token", "node"])

    picked = nodes.select("node", "prefix").mapInArrow(pick, "token bigint, node bigint")
    members, n = scratch.counted(picked.distinct().join(shared, "token").select("token", "node"))
    return members, n, n_shared


def _may_link(percent: int) -> Column:
    """Whether two sets of rows ``x`` and ``y`` can be linked, by size and by what their sketches show not to be shared."""
    sizes = F.col("x.n") + F.col("y.n")
    fits = 100 * F.least("x.n", "y.n") >= percent * F.greatest("x.n", "y.n")
    differing = sum(
        (F.bit_count(F.get("x.sketch", F.lit(i)).bitwiseXOR(F.get("y.sketch", F.lit(i)))) for i in range(1, SKETCH)),
        F.bit_count(F.get("x.sketch", F.lit(0)).bitwiseXOR(F.get("y.sketch", F.lit(0)))),
    )
    overlap = F.ceil(percent * sizes / (100 + percent))
    return fits & (differing <= sizes - 2 * overlap)


def links(texts: DataFrame, measured: DataFrame, width: int, percent: int, scratch: Scratch) -> tuple[DataFrame, int]:
    """Links ``a, b`` between distinct sets that connect all sets which links connect, and their number.

    Sets are joined by the shingles in their prefixes. The centre of a shingle is
    the set, of those with it, that shares the largest part of its prefix with
    others: of a family of copies, the one with the fewest changes. First every set
    is verified against the centre that it has most shingles in common with and
    that size and sketch allow, which groups most copies by one pair for each. Then
    all pairs of different groups that share enough prefix shingles, whose sizes
    fit and whose sketches do not rule them out are verified. So no link between
    groups is missed, and the pairs within a group are not formed.
    """
    stored = scratch.stored
    nodes, n_nodes = scratch.counted(_prefixes(texts, _loads(measured), width, percent))
    members, n_members, n_shared = _members(nodes, scratch)
    weight = (F.col("count") / F.size("prefix")).alias("weight")
    sketched = nodes.join(members.groupBy("node").count(), "node").select(
        "node", F.struct(F.struct("n", "matches", "sketch").alias("set"), "wide", weight).alias("of")
    )
    sketches, n_nodes = scratch.counted(sketched.groupBy("node").agg(F.first("of").alias("of")).select("node", "of.*"), n_nodes, TEXTS)
    weighted = stored(members.join(sketches.select("node", "weight"), "node"), n_members)

    # Complements reverse the order, so ties go to the smallest.
    first = F.max(F.struct("weight", F.bitwise_not("node").alias("other")))
    centres = weighted.groupBy("token").agg(first.alias("best")).select("token", F.bitwise_not("best.other").alias("centre"))
    centres = stored(centres, n_shared)
    meets = weighted.join(centres, "token").where("node <> centre").groupBy("node", "centre").count()
    paired = meets.join(sketches.select("node", F.col("set").alias("x")), "node")
    paired = paired.join(sketches.select(F.col("node").alias("centre"), F.col("set").alias("y")), "centre")
    order = F.struct("count", F.bitwise_not("centre").alias("other"))
    best = paired.where(_may_link(percent)).groupBy("node").agg(F.max(order).alias("best"))
    pairs = best.select(F.bitwise_not("best.other").alias("a"), F.col("node").alias("b"))
    linked, n_linked = _verified(pairs, n_nodes, sketches, texts, measured, width, percent, scratch)
    parents = linked.select(F.col("b").alias("node"), F.col("a").alias("parent"))
    above = linked.select(F.col("b").alias("parent"), F.col("a").alias("grandparent"))
    groups = parents.join(above, "parent", "left").select("node", F.coalesce("grandparent", "parent").alias("label"))
    groups = stored(groups, n_linked)
    members = weighted.join(groups, "node", "left").select("token", "node", F.coalesce("label", "node").alias("label"))
    members = stored(members, n_members)

    ends = members.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("n"))
    parts = ends.where("low < high").select("token", F.ceil(F.col("n") / SIDE_ROWS).cast("int").alias("parts"))
    parts = stored(parts, n_shared)
    rows = members.join(parts, "token").join(sketches, "node").select("token", "node", "label", "parts", "set.*")
    rows = stored(rows, n_members)
    # The rows of a very frequent token meet in squares, each in a task of its own.
    own = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    x = rows.select("*", own.alias("row"), every.alias("column")).alias("x")
    y = rows.select("*", own.alias("column"), every.alias("row")).alias("y")
    meet = (F.col("x.token") == F.col("y.token")) & (F.col("x.row") == F.col("y.row")) & (F.col("x.column") == F.col("y.column"))
    meet = meet & (F.col("x.node") < F.col("y.node")) & (F.col("x.label") != F.col("y.label"))
    pairs = x.join(y, meet & _may_link(percent))
    enough = pairs.groupBy(F.col("x.node").alias("a"), F.col("y.node").alias("b")).agg(
        F.count("*").alias("shared"), F.first(F.least("x.matches", "y.matches")).alias("matches")
    )
    more, n_more = _verified(enough.where("shared >= matches"), None, sketches, texts, measured, width, percent, scratch)
    return linked.union(more), n_linked + n_more


def near_duplicates(
    docs: DataFrame, width: int, percent: int, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The component of each document under the Jaccard similarity of its word shingles.

    A document's set is its distinct shingles of ``width`` words (lower-cased A to
    Z), or its whole sequence of words if that is shorter. Two documents are linked
    if 100 * intersection >= ``percent`` * union, so equal sets are; a null text or
    one without words has an empty set and no links. Sets are compared by 64-bit
    hashes of their shingles: of n different sets, about n * n / 2 ** 65 pairs are taken for equal. Texts are read whole;
    one of millions of words costs memory in proportion, in the tasks that hash it. Columns other than the two are not read,
    whatever their names.

    Returns ``doc_id, text_id`` (a hash of the text), ``n_shingles`` and
    ``component_id``, the smallest id in the component: one row for each row of
    ``docs``, repeated rows included. Null ids are left out of that minimum, and a
    component with no other id has a null one. An empty table gives no rows.
    """
    return _placed(docs, width, percent, id, text).drop("root")


def _placed(docs: DataFrame, width: int, percent: int, id: str, text: str) -> DataFrame:
    texts = docs.select(F.col(id).cast("bigint").alias("doc_id"), filled(text).alias("text"))
    texts = texts.withColumn("text_id", F.xxhash64("text"))
    scratch = Scratch(docs.sparkSession)
    measured, n = scratch.counted(_measured(texts, width))
    found, n_links = links(texts, measured, width, percent, scratch)
    roots = components(found, scratch, n_links)
    rows = measured.where("slice is null").drop("slice", "counts")
    rooted = scratch.stored(
        rows.join(roots, "node", "left").select(
            "doc_id", "text_id", F.col("n").cast("bigint").alias("n_shingles"), F.coalesce("root", "node").alias("root")
        ),
        n,
    )
    least = scratch.stored(rooted.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("component_id")), n)
    joined = rooted.join(least, "root", "left")
    component = F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    result = Scratch(docs.sparkSession).stored(joined.select("doc_id", "text_id", "n_shingles", component.alias("component_id"), "root"), n)
    scratch.drop()
    return result


def one_of_each(docs: DataFrame, width: int, percent: int, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of ``docs`` for each component of :func:`near_duplicates`: the one with the smallest id.

    Equal rows of that id count as one. Of different texts with that id, the one
    with the smallest hash stays. Rows without words are not linked and all stay. The columns may have any names.
    """
    keys = ["no_id", "id", "text_id"]
    found = _placed(docs, width, percent, id, text).where("root is not null")
    order = [F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("text_id")]
    stay = stored(found.groupBy("root").agg(F.min(F.struct(*order)).alias("first")).select("first.*"))
    marked = docs.select(
        F.struct("*").alias("row"),
        F.col(id).isNull().alias("no_id"),
        F.coalesce(F.col(id).cast("bigint"), F.lit(0)).alias("id"),
        F.xxhash64(filled(text)).alias("text_id"),
        filled(text).rlike(r"\S").alias("has_words"),
    )
    kept = marked.where("has_words").join(stay, keys, "left_semi").dropDuplicates(keys)
    return kept.unionByName(marked.where("not has_words")).select("row.*")


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents at three words and a similarity of 0.9."""
    rows = near_duplicates(read_table(spark, sf_dir, "documents"), 3, 90)
    return rows.select("doc_id", "n_shingles", "component_id")


#: The twin counts the shared shingles of all pairs.
OP10_SQL = r"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS nr, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
),
shingles AS (
  SELECT DISTINCT nr, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 1), lambda i: array_to_string(list_slice(words, i, i + 2), ' ')) END) AS shingle
  FROM docs
),
sizes AS (SELECT nr, count(*) AS n FROM shingles GROUP BY nr),
shared AS (
  SELECT a.nr AS x, b.nr AS y, count(*) AS n
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.nr <> b.nr GROUP BY a.nr, b.nr
),
links AS (
  SELECT x, y FROM shared JOIN sizes a ON a.nr = x JOIN sizes b ON b.nr = y
  WHERE 100 * shared.n >= 90 * (a.n + b.n - shared.n)
),
reached(nr, other) AS (
  SELECT nr, nr FROM docs UNION SELECT reached.nr, links.y FROM reached JOIN links ON reached.other = links.x
)
SELECT any_value(docs.doc_id) AS doc_id, coalesce(any_value(sizes.n), 0)::BIGINT AS n_shingles, min(others.doc_id) AS component_id
FROM reached JOIN docs USING (nr) JOIN docs others ON others.nr = reached.other LEFT JOIN sizes ON sizes.nr = docs.nr
GROUP BY docs.nr
"""
