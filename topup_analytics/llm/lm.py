"""Language-model scores: a hashed maximum-entropy model of classes, slots and words, factored like a tree."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Collection, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from topup_analytics.llm.common import Scratch, filled, held_out, read_table, ship_code, slices, stored
from topup_analytics.llm.shingles import mix

#: Documents are tokenised in chunks of about so many tokens, each with its own dictionary.
CHUNK_TOKENS = 2_000_000
#: What a token adds to its count.
SMOOTHING = 0.1
#: Classes: the end, the most frequent words, and the other words by their last two bytes.
FREQUENT = 11
SPELLED = 12
CLASSES = 1 + FREQUENT + SPELLED
#: Slots of a spelled class: its most frequent words, and its other words by their first two bytes.
SINGLES = 8
BEGINNINGS = 8
SLOTS = SINGLES + BEGINNINGS
#: A word's cell is its class, or its class and slot.
CELLS = 1 + FREQUENT + SPELLED * SLOTS
#: Features are hashed to 2 ** bits rows of weights: one for so many words of the training vocabulary, within these bounds.
WORDS_A_ROW = 2
LEAST_BITS, MOST_BITS = 12, 14
#: The words of a slot are the leaves of a tree, whose decisions have so many hashed weights for each row of the other weights.
NODES_A_ROW = 64
#: Words of a slot are in one band if their counts are equal, or in the same of so many parts of an octave from twice this number on.
BAND_STEPS = 16
_MOST_BANDS = 1 << 12
#: The words of a band are numbered in parts of about so many.
PART_WORDS = 16_384
#: Tokens of a step whose logits and decisions are in memory at once, so that they stay in a core's cache.
BLOCK_TOKENS = 4096
#: A task trains on the chunks of so many partitions, but where there are few, there are up to so many tasks.
PARTS_A_TASK, FEW_TASKS = 4, 16
#: Tokens of one gradient step.
STEP_TOKENS = 65_536
#: Tokens that are scored with one copy of the weights by row.
SCORED_TOKENS = 262_144
RATE = 0.4
NODE_RATE = 0.1
#: The training chunks are dealt into so many rounds; after each, the tasks' weights are averaged.
ROUNDS = 2
#: Averaging merges the weights of at most so many tasks, or of so many groups, at a time.
FAN_IN = 64
_SLICE = 8192
_END = b""


def _pack(ids: np.ndarray) -> bytes:
    """Numbers in two planes of 16 bits, compressed; the upper one is mostly zero."""
    planes = np.ascontiguousarray(ids.astype("<u4").view("<u2").reshape(-1, 2).T).tobytes()
    return len(planes).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def _unpack(data: bytes) -> np.ndarray:
    planes = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)
    low, high = np.frombuffer(planes, dtype="<u2").reshape(2, -1).astype(np.int32)
    return low | (high << 16)


def tokenise(text: str) -> list[bytes]:
    """Words with A to Z in lower case; ASCII white space separates."""
    return text.encode("utf-8", "surrogatepass").lower().split()


_CHUNK = pa.schema(
    [
        ("ids", pa.list_(pa.int64())),
        ("held", pa.list_(pa.bool_())),
        ("lengths", pa.list_(pa.int32())),
        ("tokens", pa.binary()),
        ("hashes", pa.list_(pa.int64())),
        ("spellings", pa.list_(pa.int32())),
        ("counts", pa.list_(pa.int32())),
    ]
)


def chunked(docs: DataFrame) -> DataFrame:
    """Tokenised documents ``doc_id, held, text``, one row for each chunk.

    ``tokens`` are packed numbers into the chunk's dictionary, which holds the
    hash, the last and first two bytes and the count in training documents of each token. Each
    document ends in the token ``_END``.
    """
    ship_code(docs.sparkSession)

    def tokenised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, docs_here, n = _new_dictionary(), [], 0
        for batch in batches:
            for part in slices(batch):
                for doc, held, text in zip(*(c.to_pylist() for c in part.columns)):
                    words = tokenise(text)
                    tokens = np.fromiter(map(numbers.__getitem__, words), np.int32, len(words))
                    docs_here.append((doc, held, np.append(tokens, numbers[_END])))
                    n += len(words) + 1
                    if n >= CHUNK_TOKENS:
                        yield _chunk(numbers, docs_here)
                        numbers, docs_here, n = _new_dictionary(), [], 0
        if docs_here:
            yield _chunk(numbers, docs_here)

    schema = (
        "ids array<bigint>, held array<boolean>, lengths array<int>, tokens binary, hashes array<bigint>, "
        "spellings array<int>, counts array<int>"
    )
    return docs.select("doc_id", "held", "text").mapInArrow(tokenised, schema)


def _new_dictionary() -> defaultdict:
    """Numbers new keys in the order of their first use."""
    numbers: defaultdict = defaultdict()
    numbers.default_factory = numbers.__len__
    return numbers


def _chunk(numbers: dict, docs: list) -> pa.RecordBatch:
    tokens = np.concatenate([t for _, _, t in docs])
    lengths = np.array([len(t) for _, _, t in docs], dtype=np.int32)
    held = np.array([h for _, h, _ in docs])
    counts = np.bincount(tokens[np.repeat(~held, lengths)], minlength=len(numbers)).astype(np.int32)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, numbers), np.uint64, len(numbers)).view(np.int64)
    row = [[d for d, _, _ in docs], held, lengths, _pack(tokens), hashes, spellings_of(numbers), counts]
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _CHUNK)], schema=_CHUNK)


def spellings_of(words: Collection[bytes]) -> np.ndarray:
    """The last two bytes of each word, and 16 bits higher the first two; both as little-endian numbers, shorter for shorter words."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    letters = np.frombuffer(b"".join(words) + b"\0\0", dtype=np.uint8).astype(np.uint32)
    ends = np.cumsum(lengths)
    first = letters[ends - lengths] | np.where(lengths > 1, letters[ends - lengths + 1] << 8, 0)
    last = np.where(lengths > 1, letters[ends - 2] | letters[ends - 1] << 8, first)
    return np.where(lengths > 0, last | first << 16, 0).astype(np.uint32).view(np.int32)


def spelled_class(spellings: np.ndarray) -> np.ndarray:
    """One of the spelled classes, by the last two bytes."""
    ending = spellings.astype(np.uint32).astype(np.uint64) & np.uint64(0xFFFF)
    return (mix(ending + np.uint64(77)) % np.uint64(SPELLED)).astype(np.int64)


def beginning_slot(spellings: np.ndarray) -> np.ndarray:
    """One of the slots for words that are not singled out, by the first two bytes."""
    beginning = spellings.astype(np.uint32).astype(np.uint64) >> np.uint64(16)
    return (SINGLES + mix(beginning + np.uint64(78)) % np.uint64(BEGINNINGS)).astype(np.int64)


@dataclass
class Vocabulary:
    """What the training tokens' counts say about the cells. Its size does not depend on the corpus."""

    n_tokens: int
    n_types: int
    single_hashes: np.ndarray  # of the words that have a cell of their own
    single_cells: np.ndarray
    cell_tokens: np.ndarray
    cell_types: np.ndarray
    bands: "Bands | None" = None

    @property
    def bits(self) -> int:
        """Of the rows of weights: more words, more rows."""
        return min(MOST_BITS, max(LEAST_BITS, (self.n_types // WORDS_A_ROW).bit_length()))

    def cells(self, hashes: np.ndarray, spellings: np.ndarray) -> np.ndarray:
        """The cell of each dictionary entry."""
        found = 1 + FREQUENT + SLOTS * spelled_class(spellings) + beginning_slot(spellings)
        order = np.argsort(self.single_hashes)
        at = np.minimum(np.searchsorted(self.single_hashes[order], hashes), len(order) - 1)
        own = self.single_hashes[order][at] == hashes
        found[own] = self.single_cells[order][at[own]]
        return found

    def base(self, counts: np.ndarray) -> np.ndarray:
        """log10 of the smoothed share of tokens with these counts."""
        return np.log10((counts + SMOOTHING) / (self.n_tokens + SMOOTHING * (self.n_types + 1)))

    def seen(self, counts: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """log10 of the share of the cell's known tokens, together, or, for an unknown token, of the one share kept for those."""
        known = self.cell_tokens + SMOOTHING * self.cell_types
        return np.log10(np.where(counts > 0, known[cells], SMOOTHING) / (known + SMOOTHING)[cells])

    @property
    def parts(self) -> int:
        """Of each cell's words, for building their tree."""
        return 1 + self.n_types // (SPELLED * BEGINNINGS * PART_WORDS)

    def biases(self) -> tuple[np.ndarray, np.ndarray]:
        """Logarithms of the classes' shares (classes by 1), and of the slots' in each class (slots by classes)."""
        alone, spelled = self.cell_tokens[: 1 + FREQUENT], self.cell_tokens[1 + FREQUENT :].reshape(SPELLED, SLOTS)
        classes = np.concatenate([alone, spelled.sum(axis=1)]) + 1
        shares = (spelled + 1) / (spelled + 1).sum(axis=1)[:, None]
        return np.log(classes / classes.sum()).astype(np.float32)[:, None], np.log(shares.T).astype(np.float32)


def class_and_slot(cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The class of each cell, and its slot there, -1 for a cell that is a whole class."""
    spelled = cells - (1 + FREQUENT)
    return np.where(spelled < 0, cells, 1 + FREQUENT + spelled // SLOTS), np.where(spelled < 0, -1, spelled % SLOTS)


def vocabulary(totals: DataFrame) -> Vocabulary:
    """Totals of the rows ``hash, spelling, c``, one for each token of the corpus.

    Every task adds up the cells of its tokens and picks the most frequent of each class. A few hundred rows come to the driver.
    """
    ship_code(totals.sparkSession)
    end = int(np.uint64(xxhash.xxh3_64_intdigest(_END)).view(np.int64))
    most = FREQUENT + SINGLES

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, types = np.zeros(CELLS, dtype=np.int64), np.zeros(CELLS, dtype=np.int64)
        top: list[np.ndarray] = [np.zeros((0, 3), dtype=np.int64) for _ in range(SPELLED)]
        for batch in batches:
            hashes, spellings, counts = (batch.column(i).to_numpy() for i in range(3))
            of_class, cells = spelled_class(spellings), 1 + FREQUENT + SLOTS * spelled_class(spellings) + beginning_slot(spellings)
            tokens += np.bincount(cells, weights=counts, minlength=CELLS).astype(np.int64)
            types += np.bincount(cells, minlength=CELLS)
            for k in range(SPELLED):
                own = np.flatnonzero((of_class == k) & (hashes != end))
                rows = np.concatenate([top[k], np.stack([hashes[own], cells[own], counts[own]], axis=1)])
                top[k] = rows[np.lexsort((rows[:, 0], -rows[:, 2]))[:most]]
        # A sum has no hash; a word that may be singled out has no types.
        rows = [(c, None, int(tokens[c]), int(types[c])) for c in np.flatnonzero(types).tolist()]
        rows += [(int(cell), int(h), int(c), 0) for t in top for h, cell, c in t.tolist()]
        columns = zip(*rows) if rows else [[]] * 4
        types_of = [pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns, types_of)], ["cell", "hash", "tokens", "types"])

    known = totals.where("c > 0").select("hash", "spelling", "c")
    parts = stored(known.mapInArrow(summed, "cell int, hash bigint, tokens bigint, types bigint"))
    tokens, types = np.zeros(CELLS), np.zeros(CELLS)
    for row in parts.where("hash is null").groupBy("cell").agg(F.sum("tokens").alias("tokens"), F.sum("types").alias("types")).collect():
        tokens[row["cell"]], types[row["cell"]] = row["tokens"], row["types"]
    whole = int(tokens.sum()), int(types.sum())
    of_class = ((F.col("cell") - (1 + FREQUENT)) / SLOTS).cast("int")
    best = Window.partitionBy("of").orderBy(F.desc("tokens"), "hash")
    words = parts.where("hash is not null").withColumn("of", of_class).withColumn("rank", F.row_number().over(best))
    ranked = sorted(words.where(F.col("rank") <= most).collect(), key=lambda r: (-r["tokens"], r["hash"]))
    alone = totals.where((F.col("hash") == end) & (F.col("c") > 0)).collect()
    spelled_end = int(1 + FREQUENT + SLOTS * spelled_class(np.zeros(1, np.int32))[0] + beginning_slot(np.zeros(1, np.int32))[0])
    singles = [(0, end, spelled_end, row["c"]) for row in alone]
    singles += [(number, r["hash"], r["cell"], r["tokens"]) for number, r in enumerate(ranked[:FREQUENT], 1)]
    held = [0] * SPELLED
    for r in ranked[FREQUENT:]:
        if held[r["of"]] < SINGLES:
            singles.append((1 + FREQUENT + SLOTS * r["of"] + held[r["of"]], r["hash"], r["cell"], r["tokens"]))
            held[r["of"]] += 1
    for cell, _, before, c in singles:
        for sums, amount in ((tokens, c), (types, 1)):
            sums[before] -= amount
            sums[cell] += amount
    hashes = np.array([s[1] for s in singles] or [end], dtype=np.int64)
    return Vocabulary(*whole, hashes, np.array([s[0] for s in singles] or [0], dtype=np.int64), tokens, types)


def bands_of(counts: np.ndarray) -> np.ndarray:
    """The band of each count: small ones have their own, larger ones share it with those a few per cent apart."""
    octave = np.maximum(np.frexp(counts.astype(np.float64))[1] - 1, (2 * BAND_STEPS).bit_length() - 2)
    step = octave - (BAND_STEPS.bit_length() - 1)
    return (step * BAND_STEPS + (counts >> step)).astype(np.int64)


def paths(shares: np.ndarray) -> list[list[tuple[int, bool, float]]]:
    """A binary tree with leaves in this order: to each leaf the nodes, the sides (whether right) and the log-odds of that side.

    Nodes are numbered by their turns. A node is cut where the halves' shares are most alike, so a leaf's depth follows its share, and
    the products of the decisions' odds are the leaves' shares.
    """
    found: list[list[tuple[int, bool, float]]] = [[] for _ in shares]
    before = np.concatenate([[0.0], np.cumsum(shares)])
    todo = [(1, 0, len(shares))]
    while todo:
        node, begin, end = todo.pop()
        if end - begin < 2:
            continue
        half = (before[begin] + before[end]) / 2
        cut = begin + 1 + int(np.argmin(np.abs(before[begin + 1 : end] - half)))
        odds = float(np.log((before[end] - before[cut]) / (before[cut] - before[begin])))
        for leaf in range(begin, end):
            found[leaf].append((node, leaf >= cut, odds if leaf >= cut else -odds))
        todo += [(mixed_turn(node, 0), begin, cut), (mixed_turn(node, 1), cut, end)]
    return found


def mixed_turn(node: int, side: int) -> int:
    """The number of a node's child."""
    return (node * 2 + side) * 0x9E3779B97F4A7C15 % 2**64


@dataclass
class Bands:
    """The bands of every cell, and the trees of a cell's bands. As many as counts have octaves, whatever the corpus."""

    keys: np.ndarray  # of cell and band, ascending
    sizes: np.ndarray  # words of each
    first: np.ndarray  # decisions on the way to each: their places in the next two, and how many
    depths: np.ndarray
    nodes: np.ndarray
    odds: np.ndarray

    @staticmethod
    def of(rows: list[tuple[int, int, int, int]]) -> "Bands":
        """From the rows ``cell, band, n, c``: words and their counts."""
        rows = sorted(rows)
        keys = np.array([cell * _MOST_BANDS + band for cell, band, _, _ in rows], dtype=np.int64)
        cells = np.array([r[0] for r in rows], dtype=np.int64)
        shares = np.array([c + SMOOTHING * n for _, _, n, c in rows])
        ways = [way for cell in np.unique(cells) for way in paths(shares[cells == cell])]
        depths = np.array([len(way) for way in ways], dtype=np.int64)
        turns = np.array([node for way in ways for node, _, _ in way], dtype=np.uint64)
        sides = np.array([side for way in ways for _, side, _ in way], dtype=bool)
        odds = np.array([value for way in ways for _, _, value in way], dtype=np.float32)
        nodes = sided(turns, mix(np.repeat(cells, depths).astype(np.uint64) + np.uint64(1 << 41)), sides)
        sizes = np.array([n for _, _, n, _ in rows], dtype=np.int64)
        return Bands(keys, sizes, np.cumsum(depths) - depths, depths, nodes, odds)


def sided(turns: np.ndarray, trees: np.ndarray, sides: np.ndarray) -> np.ndarray:
    """32 bits for each decision: a hash of the node, and the side in the lowest bit."""
    found = (((turns * np.uint64(0xD1342543DE82EF95)) ^ trees) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(32)).astype(np.uint32)
    return (found & np.uint32(0xFFFFFFFE)) | sides.astype(np.uint32)


def numbered(totals: DataFrame, words: Vocabulary) -> DataFrame:
    """``hash, c, cell, band, number`` of each known token; those of a cell and band are numbered from 0.

    They are numbered in parts of bounded size, dealt by hash.
    """
    ship_code(totals.sparkSession)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = pa.array(words.cells(batch.column(0).to_numpy(), batch.column(1).to_numpy()), pa.int32())
            bands = pa.array(bands_of(batch.column(2).to_numpy()), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), cells, bands], ["hash", "c", "cell", "band"])

    known = totals.where("c > 0").select("hash", "spelling", "c").mapInArrow(placed, "hash bigint, c bigint, cell int, band int")
    group = ["cell", "band", "part"]
    known = known.withColumn("part", F.pmod("hash", F.lit(words.parts)))
    known = known.withColumn("number", F.row_number().over(Window.partitionBy(*group).orderBy("hash")) - 1)
    if words.parts > 1:
        sizes = known.groupBy(*group).agg(F.count(F.lit(1)).alias("n"))
        before = F.sum("n").over(Window.partitionBy("cell", "band").orderBy("part")) - F.col("n")
        known = known.join(sizes.select(*group, before.alias("before")), group).withColumn("number", F.col("number") + F.col("before"))
    return known.select("hash", "c", "cell", "band", F.col("number").cast("int").alias("number"))


class Chunk:
    """A chunk's tokens and the hashed features of what precedes each in its document."""

    def __init__(self, tokens: bytes, lengths: np.ndarray, hashes: np.ndarray, spellings: np.ndarray):
        self.tokens = _unpack(tokens)
        self.starts = np.cumsum(lengths, dtype=np.int64) - lengths
        self.place = (np.arange(len(self.tokens)) - np.repeat(self.starts, lengths)).astype(np.int32)
        self.words = mix(hashes.view(np.uint64))
        self.endings = (spellings.astype(np.uint32).astype(np.uint64) & np.uint64(0xFFFF)) + np.uint64(1)
        self.depths = self.first = np.zeros(len(hashes), dtype=np.int32)
        self.nodes, self.odds = np.zeros(0, np.uint32), np.zeros(0, np.float32)

    def grow(self, cells: np.ndarray, at: np.ndarray, counts: np.ndarray, numbers: np.ndarray, bands: Bands) -> None:
        """Finds the way to the dictionary entries ``at``: through the bands of their cells, then by halves through the band's words."""
        of = np.searchsorted(bands.keys, cells[at] * _MOST_BANDS + bands_of(counts))
        sizes, depths = bands.sizes[of], bands.depths[of]
        halvings = np.frexp((sizes - 1).astype(np.float64))[1]
        ends = np.cumsum(depths + halvings)
        starts = ends - depths - halvings
        n = int(ends[-1]) if len(ends) else 0
        self.nodes, self.odds = np.zeros(n, dtype=np.uint32), np.zeros(n, dtype=np.float32)
        for level in range(int(depths.max(initial=0))):
            more = np.flatnonzero(depths > level)
            place = bands.first[of[more]] + level
            self.nodes[starts[more] + level], self.odds[starts[more] + level] = bands.nodes[place], bands.odds[place]
        trees = mix(bands.keys.view(np.uint64) + np.uint64(1 << 42))[of]
        levels, more = depths.copy(), np.flatnonzero(sizes > 1)
        low, high, turn = np.zeros(len(more), dtype=np.int64), sizes[more], np.ones(len(more), dtype=np.uint64)
        place, tree, number = (starts + depths)[more], trees[more], numbers[more]
        while len(more):
            middle = (low + high) >> 1
            right = number >= middle
            odds = np.log(((high - middle) / (middle - low)).astype(np.float32))
            self.nodes[place], self.odds[place] = sided(turn, tree, right), np.where(right, odds, -odds)
            low, high = np.where(right, middle, low), np.where(right, high, middle)
            turn = turn * np.uint64(2) + right.astype(np.uint64)
            place += 1
            open_ = high - low > 1
            if not open_.all():
                levels[more[~open_]] = place[~open_] - starts[more[~open_]]
                more, low, high, turn, place, tree, number = (of[open_] for of in (more, low, high, turn, place, tree, number))
        self.depths, self.first = np.zeros(len(cells), dtype=np.int32), np.zeros(len(cells), dtype=np.int32)
        self.depths[at], self.first[at] = levels, starts

    def _before(self, values: np.ndarray, distance: int, at: np.ndarray) -> np.ndarray:
        found = values[self.tokens[np.maximum(at - distance, 0)]]
        found[self.place[at] < distance] = 0
        return found

    def seeds(self, at: np.ndarray) -> list[np.ndarray]:
        """What precedes tokens: the word before (n-gram), and the endings of the words one to three before (skips)."""
        return [self._before(self.words, 1, at)] + [self._before(self.endings, k, at) + np.uint64(k << 20) for k in (1, 2, 3)]


def rows_of(seeds: list[np.ndarray], bits: int, within: np.ndarray | None = None) -> list[np.ndarray]:
    """The rows of weights of some seeds; in a class they are that class's own."""
    if within is not None:
        own = mix(within.astype(np.uint64) + np.uint64(1 << 40))
        seeds = [s ^ own for s in seeds]
    return [(mix(s) & np.uint64((1 << bits) - 1)).astype(np.int64) for s in seeds]


def logits_of(rows: list[np.ndarray], by_row: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """For each outcome and token, the sum of the active rows' weights (rows by outcomes), at most 0."""
    sums = by_row.take(rows[0], axis=0)
    for more in rows[1:]:
        sums += by_row.take(more, axis=0)
    logits = np.ascontiguousarray(sums.T)
    logits += bias
    logits -= logits.max(axis=0)
    return logits


class Model:
    """Weights of the classes, of the slots in a class, and of the decisions in a slot, as one vector."""

    def __init__(self, words: Vocabulary, flat: np.ndarray | None = None):
        self.words, self.bits = words, words.bits
        self.biases = words.biases()
        n, m = CLASSES << self.bits, (CLASSES + SLOTS) << self.bits
        self.flat = np.zeros(m + (NODES_A_ROW << self.bits), dtype=np.float32) if flat is None else flat
        self.classes, self.slots = self.flat[:n].reshape(CLASSES, -1), self.flat[n:m].reshape(SLOTS, -1)
        self.nodes = self.flat[m:]

    def levels(self, chunk: Chunk, cells: np.ndarray, at: np.ndarray):
        """Of each level, block by block: the tokens (places in ``at``) it decides, their rows, outcomes, logits, and whether it is inner."""
        by_row = [np.ascontiguousarray(weights.T) for weights in (self.classes, self.slots)]
        for begin in range(0, len(at), BLOCK_TOKENS):
            block = at[begin : begin + BLOCK_TOKENS]
            classes, slots = class_and_slot(cells[chunk.tokens[block]])
            seeds = chunk.seeds(block)
            rows = rows_of(seeds, self.bits)
            yield begin + np.arange(len(block)), rows, classes, logits_of(rows, by_row[0], self.biases[0]), 0
            inner = np.flatnonzero(slots >= 0)
            if len(inner):
                of = classes[inner]
                rows = rows_of([s[inner] for s in seeds], self.bits, of)
                bias = self.biases[1][:, of - (1 + FREQUENT)]
                yield begin + inner, rows, slots[inner], logits_of(rows, by_row[1], bias), 1

    def log_cells(self, chunk: Chunk, cells: np.ndarray, at: np.ndarray) -> np.ndarray:
        """log10 of the probability of the cells of the tokens ``at``, given what precedes them."""
        total = np.zeros(len(at))
        for tokens, _, outcomes, logits, _ in self.levels(chunk, cells, at):
            own = logits[outcomes, np.arange(len(tokens))]
            total[tokens] += own - np.log(np.exp(logits, out=logits).sum(axis=0))
        return total / np.log(10)

    def decisions(self, chunk: Chunk, at: np.ndarray):
        """Block by block, the decisions down to the tokens: tokens (places in ``at``) that have any, how many, rows, nodes and margins."""
        all_of = chunk.depths[chunk.tokens[at]]
        inside, shift = np.flatnonzero(all_of), np.uint32(33 - len(self.nodes).bit_length())
        for begin in range(0, len(inside), BLOCK_TOKENS):
            inner = inside[begin : begin + BLOCK_TOKENS]
            depths = all_of[inner]
            ends = np.cumsum(depths)
            places = np.repeat(chunk.first[chunk.tokens[at[inner]]] - (ends - depths), depths) + np.arange(ends[-1])
            nodes, logits, rows = chunk.nodes[places], np.zeros(len(places), dtype=np.float32), []
            own = nodes | np.uint32(1)
            for seed in chunk.seeds(at[inner]):
                row = np.repeat((mix(seed) >> np.uint64(32)).astype(np.uint32), depths)
                row ^= own
                row *= np.uint32(0x9E3779B1)
                row >>= shift
                row = row.astype(np.int64)
                rows.append(row)
                logits += self.nodes.take(row)
            sides = (nodes & np.uint32(1)).astype(np.float32) * 2 - 1
            margins = np.clip(chunk.odds[places] + sides * logits, -80, 80)
            yield inner, ends - depths, rows, sides, margins

    def log_words(self, chunk: Chunk, at: np.ndarray) -> np.ndarray:
        """log10 of the probability of the known tokens ``at`` among those of their cells, given what precedes them."""
        total = np.zeros(len(at))
        for inner, starts, _, _, margins in self.decisions(chunk, at):
            total[inner] = -np.add.reduceat(np.log1p(np.exp(-margins)), starts, dtype=np.float64)
        return total / np.log(10)

    def descend(self, chunk: Chunk, cells: np.ndarray, at: np.ndarray, squares: "Model") -> None:
        """One gradient step (AdaGrad) over the tokens ``at``; changes the weights and ``squares``."""
        # Of two outcomes at a time, as the parts of a complex number: a scattered sum costs about as much for both as for one.
        gradients = [np.zeros((n // 2, 1 << self.bits), dtype=np.complex64) for n in (CLASSES, SLOTS)]
        for tokens, rows, outcomes, logits, level in self.levels(chunk, cells, at):
            slope = np.exp(logits, out=logits)
            slope /= slope.sum(axis=0)
            slope[outcomes, np.arange(len(tokens))] -= 1
            active, pairs = np.concatenate(rows), np.empty((len(slope) // 2, len(tokens)), dtype=np.complex64)
            pairs.real, pairs.imag = slope[::2], slope[1::2]
            for own, share in zip(gradients[level], pairs):
                np.add.at(own, active, np.tile(share, len(rows)))
        for weights, pairs, sums in zip((self.classes, self.slots), gradients, (squares.classes, squares.slots)):
            gradient = np.empty_like(weights)
            gradient[::2], gradient[1::2] = pairs.real, pairs.imag
            scale = gradient * gradient
            sums += scale
            np.sqrt(sums, out=scale)
            gradient *= RATE
            gradient /= scale
            weights -= gradient
        gradient = np.zeros(len(self.nodes), dtype=np.float32)
        for _, _, rows, sides, margins in self.decisions(chunk, at):
            share = -sides / (1 + np.exp(margins))
            for row in rows:
                np.add.at(gradient, row, share)
        changed = np.flatnonzero(gradient != 0)
        gradient = gradient[changed]
        squares.nodes[changed] += gradient * gradient
        self.nodes[changed] -= NODE_RATE * gradient / np.sqrt(squares.nodes[changed])


def train(chunks: DataFrame, words: Vocabulary) -> np.ndarray:
    """The weights learned from all training tokens.

    In each round every task starts from the same weights, takes gradient steps
    over its chunks and returns its weights; these are averaged by the tokens
    they have seen. Slices of the weights are merged by key, and they come to the driver once a round: their size
    follows the vocabulary's up to ``MOST_BITS`` and not the corpus'.
    """
    ship_code(chunks.sparkSession)
    flat = Model(words).flat
    schema = "slice int, task bigint, n double, weights array<float>"
    n_parts = chunks.rdd.getNumPartitions()
    tasks = max(1, min(n_parts, FEW_TASKS), n_parts // PARTS_A_TASK)
    for number in range(ROUNDS):

        def steps(batches: Iterator[pa.RecordBatch], begin=flat) -> Iterator[pa.RecordBatch]:
            own, n, task = Model(words, begin.copy()), 0, 0
            squares = Model(words, np.full(begin.shape, 0.1, dtype=np.float32))
            for batch in batches:
                for row in range(batch.num_rows):
                    task, chunk, held, lengths, cells, _ = _read(batch, row, words)
                    learned = np.flatnonzero(np.repeat(~held, lengths))
                    for at in range(0, len(learned), STEP_TOKENS):
                        own.descend(chunk, cells, learned[at : at + STEP_TOKENS], squares)
                    n += len(learned)
            if n:
                for at, part in enumerate(own.flat.reshape(-1, _SLICE)):
                    values = [[at], [task], [float(n)], [part]]
                    kinds = [pa.int32(), pa.int64(), pa.float64(), pa.list_(pa.float32())]
                    arrays = [pa.array(v, k) for v, k in zip(values, kinds)]
                    yield pa.RecordBatch.from_arrays(arrays, ["slice", "task", "n", "weights"])

        dealt = chunks.where(F.pmod(F.xxhash64("chunk"), F.lit(ROUNDS)) == number)
        read = ["chunk", "held", "lengths", "tokens", "hashes", "spellings", "at", "c", "numbers"]
        rows = dealt.select(*read).coalesce(tasks).mapInArrow(steps, schema)
        groups = tasks
        while groups > 1:
            groups = -(-groups // FAN_IN)
            key = F.pmod(F.xxhash64("task", F.lit(groups)), F.lit(groups))
            rows = rows.withColumn("task", key).groupBy("slice", "task").applyInArrow(_average, schema)
        flat = flat.copy()
        for row in rows.toArrow().to_pylist():
            flat.reshape(-1, _SLICE)[row["slice"]] = row["weights"]
    return flat


def _average(group: pa.Table) -> pa.Table:
    """One row for a group of weights: their mean, weighed by the tokens they have seen."""
    seen = group["n"].to_numpy()
    rows = group["weights"].combine_chunks().flatten().to_numpy().reshape(len(seen), -1)
    mean = (seen @ rows.astype(np.float64) / seen.sum()).astype(np.float32)
    return pa.table(
        {
            "slice": group["slice"][:1],
            "task": group["task"][:1],
            "n": pa.array([seen.sum()]),
            "weights": pa.array([mean], pa.list_(pa.float32())),
        }
    )


def _read(batch: pa.RecordBatch, row: int, words: Vocabulary) -> tuple:
    value = lambda name: batch.column(batch.schema.get_field_index(name))[row]
    array = lambda name: value(name).values.to_numpy(zero_copy_only=False)
    hashes, spellings, lengths = array("hashes"), array("spellings"), array("lengths")
    chunk, cells = Chunk(value("tokens").as_py(), lengths, hashes, spellings), words.cells(hashes, spellings)
    counts = np.zeros(len(hashes), dtype=np.int64)
    if value("at").is_valid:
        counts[array("at")] = array("c")
        chunk.grow(cells, array("at"), array("c"), array("numbers"), words.bands)
    return value("chunk").as_py(), chunk, array("held"), lengths, cells, counts


def scores(docs: DataFrame, is_held: Column, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Scores of all whole texts by a model of those that are not held out.

    A token's probability is that of its class, given what precedes it, times, but for the most frequent words, that of
    its slot in the class, given the class and what precedes it, times that of the word in the slot, given the slot and what precedes it.
    All are maximum-entropy models of hashed
    features: the word before, and the endings of the three words before; inside a class the features are the class's own. The words of a
    slot are the leaves of a binary tree, first of bands of like counts, then of the words in a band, and each decision on the way to a
    word has features of its own and begins with the odds of the counts. A slot keeps one smoothed share for all unknown words. The rows of
    weights grow with the vocabulary up to ``2 ** MOST_BITS``; beyond, words share them. Counts
    are exact, over all training tokens: every chunk of documents sends each of its
    tokens once with its count, these are added up before and after the shuffle, and the corpus' counts of its own tokens are
    joined to each chunk with their numbers, so no task holds the whole vocabulary, and a token that is in every chunk is a sum like any other.

    Returns ``doc_id``, ``held_out``, ``n_tokens`` (words and one end), ``n_known``
    (tokens that training has seen), ``train_tokens``, ``base_score`` (log10
    probability by smoothed counts alone) and ``score`` (by the model). A null
    text is empty and has the end only. ``is_held`` is an expression over ``docs``;
    null counts as false. Repeated rows are documents like any other, null ids
    stay, an empty table gives no rows; columns other than the two are not read, whatever their names. A very long text is
    a chunk of its own, and must fit into a row. Without training documents every token is
    unknown and the classes are equally likely. Gradient steps follow the chunks, so ``score`` varies a little with how the
    table is dealt to tasks; the other columns do not.
    """
    ship_code(docs.sparkSession)
    rows = docs.select(
        F.col(id).cast("bigint").alias("doc_id"), F.coalesce(is_held, F.lit(False)).alias("held"), filled(text).alias("text")
    )
    scratch, kept = Scratch(docs.sparkSession), Scratch(docs.sparkSession)
    # The chunks are most of the data: they are written once, in buckets, so that what is learned of their words is joined to them in place.
    n_buckets = max(rows.rdd.getNumPartitions(), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    chunks = kept.bucketed(chunked(rows).withColumn("chunk", F.monotonically_increasing_id()), "chunk", n_buckets)
    entries = chunks.select("chunk", F.posexplode(F.arrays_zip("hashes", "spellings", "counts")).alias("at", "entry"))
    counted = entries.groupBy(F.col("entry.hashes").alias("hash")).agg(
        F.sum(F.col("entry.counts").cast("bigint")).alias("c"), F.min("entry.spellings").alias("spelling")
    )
    totals = scratch.stored(counted)
    words = vocabulary(totals)
    places = entries.select("chunk", "at", F.col("entry.hashes").alias("hash"))
    # Stored apart, so that Spark can split the many rows of one token in the join.
    numbers = scratch.stored(numbered(totals, words))
    sums = numbers.groupBy("cell", "band").agg(F.count(F.lit(1)).alias("n"), F.sum("c").alias("c"))
    words.bands = Bands.of([tuple(row) for row in sums.collect()])
    known = places.join(numbers.select("hash", "c", "number"), "hash").repartition(n_buckets, "chunk").groupBy("chunk")
    # Lists of one aggregation have the same order; lists of numbers take a fraction of the memory that lists of rows do.
    known = known.agg(F.collect_list("at").alias("at"), F.collect_list("c").alias("c"), F.collect_list("number").alias("numbers"))
    known = kept.bucketed(known, "chunk", n_buckets)
    scratch.drop()
    joined = chunks.drop("counts").join(known.hint("merge"), "chunk", "left")
    weights = train(joined, words)
    schema = (
        "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(words, weights)
        for batch in batches:
            for row in range(batch.num_rows):
                _, chunk, held, lengths, cells, counts = _read(batch, row, words)
                base, seen = words.base(counts), words.seen(counts, cells)
                log_word = np.empty(len(chunk.tokens))
                for begin in range(0, len(chunk.tokens), SCORED_TOKENS):
                    places = np.arange(begin, min(begin + SCORED_TOKENS, len(chunk.tokens)))
                    log_word[places] = model.log_cells(chunk, cells, places) + model.log_words(chunk, places)
                sums = lambda per_token: np.add.reduceat(per_token, chunk.starts)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(batch.schema.get_field_index("ids"))[row].values,
                        pa.array(held),
                        pa.array(lengths.astype(np.int64)),
                        pa.array(sums((counts > 0)[chunk.tokens].astype(np.int64))),
                        pa.array(np.full(len(lengths), words.n_tokens, dtype=np.int64)),
                        pa.array(sums(base[chunk.tokens])),
                        pa.array(sums(seen[chunk.tokens] + log_word)),
                    ],
                    ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    return joined.mapInArrow(score, schema)


def op1_maxent_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all whole documents, learned from nine tenths of them."""
    return scores(read_table(spark, sf_dir, "documents"), held_out("doc_id", 10, 0))
