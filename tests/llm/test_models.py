"""Language-model scores and top-k search against plain versions."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from tests.llm.conftest import odd_rows
from topup_analytics.llm import lm, topk
from topup_analytics.llm.common import read_table
from topup_analytics.llm.language import held_out
from topup_analytics.llm.shingles import mix


def is_held():
    return held_out("doc_id", 10, 0)


def plain_base(rows):
    tokens = [(d, zlib.crc32(("" if d is None else str(d)).encode()) % 10 == 0, (t or "").encode().lower().split() + [b""]) for d, t in rows]
    counts = Counter(w for _, held, words in tokens if not held for w in words)
    n, v = sum(counts.values()), len(counts)
    for doc, held, words in tokens:
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words)
        yield doc, held, len(words), sum(counts[w] > 0 for w in words), n, base


def by_row(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: [(v is None, v or 0) for v in r[:5]] + [round(r[5], 6)])


@pytest.mark.parametrize("tokens", [2_000_000, 500])
def test_base_scores(spark, small, odd, monkeypatch, tokens):
    monkeypatch.setattr(lm, "CHUNK_TOKENS", tokens)
    for docs in (read_table(spark, small, "documents").repartition(3), odd):
        rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        got = by_row(lm.scores(docs, is_held()).collect())
        want = by_row(plain_base(rows))
        assert len(got) == len(want) == len(rows)
        for mine, other in zip(got, want):
            assert mine[:6] == pytest.approx(other)


def test_no_training_documents(spark, odd, none):
    assert lm.scores(none, is_held()).count() == 0
    for held in (F.lit(True), F.lit(None).cast("boolean")):
        rows = lm.scores(odd, held).collect()
        assert len(rows) == len(odd_rows()) and all(math.isfinite(r["score"]) for r in rows)
    assert all(r["base_score"] == 0 and r["n_known"] == 0 for r in lm.scores(odd, F.lit(True)).collect())


def test_model_beats_the_base_on_held_out_texts(spark):
    rows = lm.scores(read_table(spark, "/root/testdata/sf0.1", "documents"), is_held()).where("held_out").collect()
    n = sum(r["n_tokens"] for r in rows)
    assert (sum(r["score"] for r in rows) - sum(r["base_score"] for r in rows)) / n > 0.25


def hashed(word):
    return int(xxhash.xxh3_64_intdigest(word))


def mixed(x):
    return int(mix(np.array([x], dtype=np.uint64))[0])


def plain_seeds(words, at):
    """What precedes a word, by plain numbers."""
    found = [mixed(hashed(words[at - 1])) if at else 0]
    for k in (1, 2, 3):
        found.append((int.from_bytes(words[at - k][-2:], "little") + 1 if at >= k else 0) + (k << 20))
    return found


def plain_log_softmax(weights, rows, bias, k):
    logits = [sum(float(w[r]) for r in rows) + float(b) for w, b in zip(weights, bias)]
    top = max(logits)
    return logits[k] - top - math.log(sum(math.exp(x - top) for x in logits))


def plain_log_cell(model, seeds, cell):
    """Natural logarithm of a cell's probability, summed up weight by weight."""
    mask = (1 << model.bits) - 1
    spelled = cell - 1 - lm.FREQUENT
    of = cell if spelled < 0 else 1 + lm.FREQUENT + spelled // lm.SLOTS
    total = plain_log_softmax(model.classes, [mixed(s) & mask for s in seeds], model.biases[0][:, 0], of)
    if spelled >= 0:
        rows = [mixed(s ^ mixed(of + (1 << 40))) & mask for s in seeds]
        total += plain_log_softmax(model.slots, rows, model.biases[1][:, of - 1 - lm.FREQUENT], spelled % lm.SLOTS)
    return total


def small_corpus():
    rng = random.Random(6)
    stock = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 5))) for _ in range(60)]
    texts = [" ".join(rng.choice(stock[: 3 + i]) for _ in range(rng.randint(0, 40))) for i in range(50)]
    return [(i, t if i % 9 else t + " never seen Before") for i, t in enumerate(texts)] + [(None, None), (50, ""), (51, "A a\tA")]


def test_scores_by_plain_loops(spark, monkeypatch):
    """Every score again, from the counts and the trained weights, token by token; and probabilities that sum to 1."""
    kept, train = {}, lm.train

    def trained(chunks, words):
        kept["model"] = lm.Model(words, train(chunks, words))
        return kept["model"].flat

    monkeypatch.setattr(lm, "train", trained)
    monkeypatch.setattr(lm, "CHUNK_TOKENS", 300)
    rows = small_corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(map(tuple, lm.scores(docs, is_held()).collect()), key=lambda r: (r[0] is None, r[0]))
    model = kept["model"]
    words, counts = model.words, Counter()
    for doc, held, *_ in got:
        if not held:
            counts.update(lm.tokenise(dict(rows)[doc] or "") + [b""])
    spelling = lambda w: np.array([int.from_bytes(w[-2:], "little") | int.from_bytes(w[:2], "little") << 16], np.uint32).view(np.int32)
    cell = {w: int(words.cells(np.array([hashed(w)], np.uint64).view(np.int64), spelling(w))[0]) for w in [*counts, b"never", b"seen", b"before"]}
    of_cell = Counter()
    for w, c in counts.items():
        of_cell[cell[w]] += c
    assert [of_cell[k] for k in range(lm.CELLS)] == words.cell_tokens.tolist()
    assert Counter(cell[w] for w in counts) == {k: n for k, n in enumerate(words.cell_types.tolist()) if n}
    frequent = sorted((w for w in counts if w), key=lambda w: -counts[w])
    assert cell[b""] == 0 and {cell[w] for w in frequent[:3]} <= set(range(1, 1 + lm.FREQUENT))

    def log_share(word, k):
        return math.log10((counts[word] + 0.1) / (words.cell_tokens[k] + 0.1 * (words.cell_types[k] + 1)))

    assert np.abs(model.flat).max() > 0
    for doc, _, n, _, _, _, score in got:
        tokens = lm.tokenise(dict(rows)[doc] or "") + [b""]
        want = sum(plain_log_cell(model, plain_seeds(tokens, i), cell[w]) / math.log(10) + log_share(w, cell[w]) for i, w in enumerate(tokens))
        assert n == len(tokens) and score == pytest.approx(want, abs=1e-3, rel=1e-5)
    for before in ([], [b"a"], [b"never", b"seen"], frequent[:5]):
        seeds = plain_seeds([*before, b"x"], len(before))
        of = [math.exp(plain_log_cell(model, seeds, k)) for k in range(lm.CELLS)]
        assert sum(of) == pytest.approx(1, abs=1e-5)
        known = sum(of[cell[w]] * 10 ** log_share(w, cell[w]) for w in counts)
        unknown = sum(of[k] * 10 ** log_share(b"?", k) for k in range(lm.CELLS))
        assert known + unknown == pytest.approx(1, abs=1e-5)


def test_gradient_steps_raise_the_likelihood():
    rng = np.random.default_rng(2)
    lengths = np.array([300, 200], dtype=np.int32)
    tokens = np.tile(np.arange(5, dtype=np.int32), 100)
    entries = rng.integers(1, 2**62, 5)
    chunk = lm.Chunk(lm._pack(tokens), lengths, entries, np.arange(5, dtype=np.int32))
    assert (chunk.tokens == tokens).all()
    assert (chunk.place == np.concatenate([np.arange(300), np.arange(200)])).all()
    sums = np.zeros(lm.CELLS)
    words = lm.Vocabulary(500, 5, entries[:1], np.array([0]), sums, sums)
    cells, at = words.cells(entries, np.arange(5, dtype=np.int32)), np.arange(500)
    assert cells[0] == 0 and (cells[1:] > lm.FREQUENT).all()
    model = lm.Model(words)
    squares = lm.Model(words, np.full(model.flat.shape, 0.1, np.float32))
    first = model.log_cells(chunk, cells, at).mean()
    for _ in range(30):
        model.descend(chunk, cells, at, squares)
    assert first < 0 and model.log_cells(chunk, cells, at).mean() > 0.1 * first


@pytest.mark.parametrize("words_a_part", [16_384, 1])
def test_words_of_one_slot_follow_what_precedes_them(spark, monkeypatch, words_a_part):
    """Words with the same first and last bytes and the same count: only the word before tells which of them comes."""
    monkeypatch.setattr(lm, "PART_WORDS", words_a_part)
    n = 60
    pair = lambda i, j: f"{'abc'[i % 3]}{i:03d}left ab{j:03d}yz"
    learned = [(i, " ".join(pair(j, j) for j in range(n))) for i in range(100)]
    asked = [(1000 + i, pair(i, i)) for i in range(n)] + [(2000 + i, pair(i, (i + 7) % n)) for i in range(n)]
    docs = spark.createDataFrame(learned + asked, "doc_id long, text string").repartition(2)
    score = {r["doc_id"]: r["score"] for r in lm.scores(docs, F.col("doc_id") >= 1000).collect()}
    assert sum(score[1000 + i] > score[2000 + i] + 0.1 for i in range(n)) > 0.7 * n


def test_chunks_are_written_once_and_stay_in_place(spark, monkeypatch):
    """The tokens are in one stored table, and what is trained on is joined to them without a shuffle."""
    written, plans, train = [], [], lm.train

    def noting(write):
        def noted(self, *args, **options):
            written.append(self._df.columns)
            return write(self, *args, **options)

        return noted

    def trained(chunks, words):
        plans.append(chunks._jdf.queryExecution().executedPlan().toString())
        return train(chunks, words)

    for name in ("parquet", "saveAsTable"):
        monkeypatch.setattr(DataFrameWriter, name, noting(getattr(DataFrameWriter, name)))
    monkeypatch.setattr(lm, "train", trained)
    monkeypatch.setattr(lm, "CHUNK_TOKENS", 300)
    tables = spark.catalog.listTables()
    rows = small_corpus()
    got = lm.scores(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), is_held())
    assert sum("tokens" in columns and "hashes" in columns for columns in written) == 1
    assert "tokens" in plans[0] and "Exchange" not in plans[0]
    assert got.count() == len(rows) and spark.catalog.listTables() == tables


def word_model(rng, n=700):
    """Words with counts, all in the dictionary of one chunk, with a document for each pair of a few of them and any."""
    spellings = rng.integers(0, 2**16, n).astype(np.int32)
    hashes, counts = rng.integers(1, 2**62, n), np.minimum(rng.zipf(1.5, n), 500).astype(np.int64)
    words = lm.Vocabulary(int(counts.sum()), n, hashes[:1], np.array([0]), None, None)
    cells = words.cells(hashes, spellings)
    words.cell_tokens, words.cell_types = (np.bincount(cells, weights=w, minlength=lm.CELLS) for w in (counts, np.ones(n)))
    groups, numbers = {}, np.zeros(n, dtype=np.int32)
    for i, key in enumerate(zip(cells.tolist(), lm.bands_of(counts).tolist())):
        numbers[i] = len(groups.setdefault(key, []))
        groups[key].append(int(counts[i]))
    words.bands = lm.Bands.of([(*key, len(of), sum(of)) for key, of in groups.items()])
    pairs = np.stack([np.repeat(np.arange(1, 4), n), np.tile(np.arange(n), 3)], axis=1)
    chunk = lm.Chunk(lm._pack(pairs.ravel()), np.full(3 * n, 2, np.int32), hashes, spellings)
    chunk.grow(cells, np.arange(n), counts, numbers, words.bands)
    return words, chunk, cells, counts


def test_words_of_a_cell_sum_to_one():
    rng = np.random.default_rng(3)
    words, chunk, cells, counts = word_model(rng)
    n, places = len(cells), np.arange(1, len(chunk.tokens), 2)
    model = lm.Model(words)
    share = np.log10((counts + 0.1) / (words.cell_tokens + 0.1 * words.cell_types)[cells])
    exact = counts < 2 * lm.BAND_STEPS
    plain = model.log_words(chunk, places).reshape(3, n)
    assert exact.sum() > 500 and np.abs(plain - share)[:, exact].max() < 1e-5 and np.abs(plain - share).max() < 0.03
    model.flat[:] = rng.normal(size=len(model.flat))
    found = model.log_words(chunk, places).reshape(3, n)
    assert np.abs(found - share).max() > 1 and np.abs(found[0] - found[1]).max() > 1
    for of in found:
        sums = np.bincount(cells, weights=10**of, minlength=lm.CELLS)
        assert sums[np.unique(cells)] == pytest.approx(1, abs=1e-5)
    squares = lm.Model(words, np.full(model.flat.shape, 0.1, np.float32))
    learned = places[: 40]
    before = model.log_words(chunk, learned).mean()
    for _ in range(30):
        model.descend(chunk, cells, learned, squares)
    assert model.log_words(chunk, learned).mean() > 0.5 * before


def test_bands_are_in_order():
    counts = np.concatenate([np.arange(1, 5000), 2 ** np.arange(13, 50)])
    bands = lm.bands_of(counts)
    assert (bands[:31] == np.arange(1, 32)).all() and (np.diff(bands) >= 0).all() and bands.max() < lm._MOST_BANDS
    for band in np.unique(bands[:4999]):
        own = counts[:4999][bands[:4999] == band]
        assert own.max() < own.min() * (1 + 1 / lm.BAND_STEPS)


def test_rows_grow_with_the_vocabulary():
    rows = [lm.Vocabulary(0, n, *[np.zeros(1)] * 4).bits for n in (0, 10**3, 5 * 10**5, 10**7, 10**12)]
    assert rows == [lm.LEAST_BITS, lm.LEAST_BITS, 14, lm.MOST_BITS, lm.MOST_BITS]


def test_planes():
    ids = np.array([0, 1, 65535, 65536, 200_000, 2**31 - 1], dtype=np.int32)
    assert (lm._unpack(lm._pack(ids)) == ids).all()


def test_spellings():
    words = [b"", b"a", b"ab", b"abc", "é".encode(), b"\x00", b"a\x00", bytes(range(200, 256)), b"\xff"]
    plain = [int.from_bytes(w[-2:], "little") | int.from_bytes(w[:2], "little") << 16 for w in words]
    for order in (slice(None), slice(None, None, -1)):
        assert (lm.spellings_of(words[order]).view(np.uint32) == np.array(plain[order], dtype=np.uint32)).all()
    assert len(lm.spellings_of([])) == 0


def plain_top(rows, k=5):
    """rows: (id, integer vector); queries have ids divisible by 50."""
    width = max(len(v) for _, v in rows)
    padded = sorted({(i, tuple([*v, *[0] * (width - len(v))]), tuple(v)) for i, v in rows})
    out = []
    for i, v, _ in padded:
        if i % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w, _ in padded if j != i)[:k]
            out += [(i, r, j, -s) for r, (s, j) in enumerate(scored, 1)]
    return sorted(out)


def test_top_k_of_odd_vectors(spark):
    rng = random.Random(4)
    vectors = [[rng.uniform(-1, 1) for _ in range(8)] for _ in range(150)]
    rows = [(i, v) for i, v in enumerate(vectors)]
    rows += [(1000 + i, vectors[0]) for i in range(40)] + [(2000, [0.0] * 8), (2050, [1.0, -1.0]), (2100, []), (-50, [300.0] * 8)]
    odd = [(5000, None), (5050, [1.0, None]), (5100, [float("nan")] * 8), (5150, [float("inf")] * 8), (None, vectors[1])]
    docs = spark.createDataFrame([(i, v, 1, 2) for i, v in rows + odd + rows[:3]], "vec_id long, embedding array<double>, rank int, block int")
    got = sorted(tuple(r) for r in topk.top_k(docs.repartition(3), F.col("vec_id") % 50 == 0).collect())
    assert got == plain_top([(i, [math.floor(256 * x) for x in v]) for i, v in rows])


def test_top_k_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 30)
    monkeypatch.setattr(topk, "BLOCK_QUERIES", 2)
    rng = random.Random(8)
    rows = [(i, [rng.choice([-0.25, 0.0, 0.125, 0.5]) for _ in range(5)]) for i in range(301)]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted(tuple(r) for r in topk.top_k(docs, F.col("vec_id") % 50 == 0).collect())
    assert got == plain_top([(i, [math.floor(256 * x) for x in v]) for i, v in rows])


def test_top_k_of_large_components(spark):
    rng = random.Random(12)
    rows = [(i, [rng.uniform(-1, 1) * 10 ** rng.randint(3, 6) for _ in range(4)]) for i in range(130)]
    rows += [(200, [2.0**54, 0.0, 0.0, 0.0]), (201, [-(2.0**55), 0.0, 0.0, 0.0]), (250, [0.0, 0.0, 1.0, 2.0])]
    rows = [(i, [0.0, *v[1:]] if i < 200 else v) for i, v in rows]
    vectors = lambda of: spark.createDataFrame(of, "vec_id long, embedding array<double>")
    is_query = F.col("vec_id").isin(0, 50, 100, 250)
    got = sorted(tuple(r) for r in topk.top_k(vectors(rows), is_query).collect())
    assert got == [r for r in plain_top([(i, [math.floor(256 * x) for x in v]) for i, v in rows]) if r[0] != 200]
    for x, message in ((1e17, "component"), (-1e300, "component"), (1e13, "score")):
        with pytest.raises(Exception, match=f"{message} does not fit a bigint"):
            topk.top_k(vectors([(0, [x]), (1, [x])]), F.col("vec_id") == 0).collect()


def test_few_or_no_vectors(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(empty, F.col("vec_id") % 50 == 0).count() == 0
    two = spark.createDataFrame([(0, [1.0]), (50, [2.0])], "vec_id long, embedding array<float>")
    got = sorted(tuple(r) for r in topk.top_k(two, F.col("vec_id") % 50 == 0).collect())
    assert got == [(0, 1, 50, 131072), (50, 1, 0, 131072)]


components = st.integers(-700, 700)


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 6).flatmap(lambda d: st.lists(st.lists(components, min_size=d, max_size=d), min_size=1, max_size=90)), st.integers(1, 7))
def test_bitmap_arithmetic(vectors, k):
    ids = np.arange(len(vectors), dtype=np.int64) * 3
    rows = np.array(vectors, dtype=np.int64)
    block = topk.Block(*topk.build_block(ids, rows))
    query = rows[0]
    slices, offset = block.scores(query)
    got = [offset + sum(int(s[i // 64] >> np.uint64(i % 64)) % 2 << w for w, s in enumerate(slices)) for i in range(len(ids))]
    assert got == (rows @ query).tolist()
    found, scores = block.best(query, 0, k)
    want = sorted(zip((-(rows @ query)).tolist(), ids.tolist()))
    want = [(i, -s) for s, i in want if i != 0][:k]
    assert sorted(zip(found.tolist(), scores)) == sorted(want)
