"""The Jaccard join and its components against plain versions."""

import random
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import odd_rows, sentence
from topup_analytics.llm import jaccard
from topup_analytics.llm.common import Scratch
from topup_analytics.llm.components import components
from topup_analytics.llm.shingles import shingle_set, word_hashes


def plain_sets(texts, width):
    out = []
    for text in texts:
        words = (text or "").encode().lower().split()
        out.append({tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set())
    return out


def roots(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        parent[find(a)] = find(b)
    return [find(x) for x in range(n)]


def plain_components(rows, width, percent):
    """Component ids of rows (id, text), by comparing all pairs."""
    sets = plain_sets([t for _, t in rows], width)
    links = [
        (a, b)
        for a in range(len(rows))
        for b in range(a)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    least = {}
    found = roots(len(rows), links)
    for (doc, _), root in zip(rows, found):
        least[root] = min([x for x in (least.get(root), doc) if x is not None], default=None)
    return [(doc, len(s), least[root]) for (doc, _), s, root in zip(rows, sets, found)]


def family(rng, n, words, edits, first):
    """Copies of a text, each with up to so many words changed."""
    base = sentence(rng, words).split()
    rows = []
    for i in range(n):
        copy = list(base)
        for _ in range(rng.randint(0, edits)):
            copy[rng.randrange(words)] = sentence(rng, 1)
        rows.append((first + i, " ".join(copy)))
    return rows


def corpus(seed):
    rng = random.Random(seed)
    passage = sentence(rng, 60)
    rows = [(i, sentence(rng, rng.randint(1, 80))) for i in range(60)]
    # Many documents share a passage and little else.
    rows += [(100 + i, passage + " " + sentence(rng, rng.randint(1, 9))) for i in range(40)]
    rows += family(rng, 60, 150, 6, 200) + family(rng, 30, 400, 20, 300) + family(rng, 25, 30, 2, 400)
    # A chain: each text differs from the next by one word, and its ends by many.
    words = sentence(rng, 130).split()
    for i in range(20):
        words[5 * i] = sentence(rng, 1)
        rows.append((500 - i, " ".join(words)))
    rows += [(600 + i, rows[i][1].upper() + " \n") for i in range(10)]
    rows += [(700 + i, t) for i, t in enumerate([None, "", " \n", "a", "A", "a b", "a  B", "b a", "a b c", "a b c a b c a b c"])]
    return rows


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: [(v is None, v or 0) for v in r])


@pytest.mark.parametrize("width, percent, seed", [(3, 90, 1), (5, 80, 2), (1, 50, 3)])
def test_components_of_all_links(spark, width, percent, seed):
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = jaccard.near_duplicates(docs, width, percent).select("doc_id", "n_shingles", "component_id").collect()
    assert ordered(got) == ordered(plain_components(rows, width, percent))


@pytest.mark.parametrize("most", [0, 120])
def test_any_order_of_shingles_gives_the_same(spark, monkeypatch, most):
    """Loads decide only the order and the number of matches, never the result."""
    rows = corpus(9)[:220]
    loads = np.random.default_rng(most).integers(0, most + 1, 1 << jaccard.COUNT_BITS).astype(np.uint8)
    monkeypatch.setattr(jaccard, "_loads", lambda measured: loads)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard.near_duplicates(docs, 3, 90).select("doc_id", "n_shingles", "component_id").collect()
    assert ordered(got) == ordered(plain_components(rows, 3, 90))


def test_odd_rows(odd, none):
    rows = [(r[0], r[1]) for r in odd_rows()]
    got = jaccard.near_duplicates(odd, 3, 90).select("doc_id", "n_shingles", "component_id").collect()
    assert ordered(got) == ordered(plain_components(rows, 3, 90))
    assert jaccard.near_duplicates(none, 3, 90).count() == 0
    kept = jaccard.one_of_each(odd, 3, 90)
    assert kept.columns == odd.columns
    texts = [r["text"] for r in kept.collect()]
    sets = plain_sets(texts, 3)
    assert sum(not s for s in sets) == sum(not s for s in plain_sets([t for _, t in rows], 3))
    # Of the three equal rows 7, the near copy 8 and the upper-case copy 9, one stays.
    assert [r["doc_id"] for r in kept.collect()].count(7) == 1
    assert not {8, 9} & {r["doc_id"] for r in kept.collect()}
    classes = len({c for d, n, c in plain_components([(i, t) for i, (_, t) in enumerate(rows)], 3, 90) if n})
    assert len([s for s in sets if s]) == classes
    assert jaccard.one_of_each(none, 3, 90).count() == 0


sets = st.sets(st.integers(0, 60), min_size=1, max_size=50)


@settings(max_examples=300, deadline=None)
@given(sets, sets, st.integers(1, 100), st.integers(0, 2**32))
def test_filters_lose_no_link(a, b, percent, seed):
    rng = np.random.default_rng(seed)
    table = rng.integers(0, 2**63, 61, dtype=np.uint64)
    x, y = (np.unique(table[list(s)]) for s in (a, b))
    shared = len(np.intersect1d(x, y))
    if 100 * shared < percent * (len(x) + len(y) - shared):
        return
    loads = np.resize(rng.integers(0, 60, 4093), 1 << jaccard.COUNT_BITS).astype(np.uint8)
    (mx, px), (my, py) = (jaccard.choose_prefix(s, loads, percent) for s in (x, y))
    assert len(np.intersect1d(px, py)) >= min(mx, my)
    assert 100 * min(len(x), len(y)) >= percent * max(len(x), len(y))
    most = jaccard.most_unshared(len(x) + len(y), percent)
    sketches = [jaccard.parity_sketch(s, 64 * jaccard.SKETCH) for s in (x, y)]
    assert int(np.bitwise_count(sketches[0] ^ sketches[1]).sum()) <= most
    assert jaccard.unshared(jaccard.wide_sketch(x), jaccard.wide_sketch(y)) <= most


def test_wide_sketches_of_different_widths():
    rng = np.random.default_rng(1)
    pool = np.unique(rng.integers(0, 2**63, 9000, dtype=np.uint64))
    for n in (10, 500, 700, 3000, 8900):
        a, b = np.sort(rng.choice(pool, n, replace=False)), pool[: n + 60]
        bound = jaccard.unshared(jaccard.wide_sketch(a), jaccard.wide_sketch(b))
        assert bound <= len(np.setxor1d(a, b))
        assert bound > 0 and jaccard.unshared(jaccard.wide_sketch(a), jaccard.wide_sketch(a)) == 0


def test_hashes_follow_words():
    texts = ["a b c", "A\tB\x0bC", " a b c\n", "a b\x1cc", "é B c", "É b c", "a b", "ab", "", "a b c d"]
    words = [t.encode().lower().split() for t in texts]
    for t, w in zip(texts, words):
        assert len(word_hashes(t)) == len(w)
    flat = {}
    for t, w in zip(texts, words):
        for word, h in zip(w, word_hashes(t)):
            assert flat.setdefault(word, h) == h
    assert len(set(flat.values())) == len(flat)
    assert (shingle_set("a b c", 3) == shingle_set("A B C", 3)).all()
    assert len(shingle_set("a b", 3)) == 1 and len(shingle_set("", 3)) == 0
    assert shingle_set("a b", 3)[0] != shingle_set("b a", 3)[0] != shingle_set("a", 3)[0]


def test_pieces_of_long_texts(monkeypatch):
    from topup_analytics.llm import shingles

    text = sentence(random.Random(3), 5000) + " " + "y" * 3000
    whole = word_hashes(text)
    monkeypatch.setattr(shingles, "PIECE", 700)
    assert (word_hashes(text) == whole).all()


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(-9, 30), st.integers(-9, 30)), max_size=40))
def test_components_of_random_links(spark, links):
    got = components(spark.createDataFrame(links, "a long, b long"), Scratch(spark)).collect()
    nodes = sorted({x for link in links for x in link})
    found = roots(len(nodes), [(nodes.index(a), nodes.index(b)) for a, b in links])
    groups = defaultdict(list)
    for node, root in zip(nodes, found):
        groups[root].append(node)
    want = {(x, min(g)) for g in groups.values() for x in g if x != min(g)}
    assert {tuple(r) for r in got} == want


def test_a_long_path(spark):
    rng = random.Random(5)
    ids = rng.sample(range(10_000), 300)
    got = components(spark.createDataFrame(list(zip(ids, ids[1:])), "a long, b long"), Scratch(spark)).collect()
    assert {tuple(r) for r in got} == {(x, min(ids)) for x in ids if x != min(ids)}


def test_loads_are_counts(spark):
    rows = corpus(3)
    texts = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "coalesce(text, '') text", "xxhash64(text) text_id")
    found = jaccard._loads(jaccard._measured(texts.repartition(5), 3))
    counts = np.zeros(1 << jaccard.COUNT_BITS)
    for _, text in rows:
        counts[(shingle_set(text or "", 3) >> np.uint64(64 - jaccard.COUNT_BITS)).astype(np.int64)] += 1
    usual = counts.mean()
    assert (found == np.rint(8 * np.log2(1 + np.maximum(0, counts - usual - 2 * np.sqrt(usual))))).all()
    rng = np.random.default_rng(2)
    for used in (0, 1, 500, 43_000, 44_000, jaccard.SLICE):
        counts = np.zeros(jaccard.SLICE, dtype=np.int64)
        counts[rng.choice(jaccard.SLICE, used, replace=False)] = rng.integers(1, 2**32, used)
        data, back = jaccard._pack(counts), np.ones(jaccard.SLICE, dtype=np.int64)
        jaccard._unpack(data, back)
        assert (back == counts + 1).all() and len(data) <= min(6 * used, 4 * jaccard.SLICE)


def test_frequent_tokens_meet_in_squares(spark, monkeypatch):
    """However few rows of a token meet in a task, the links are the same."""
    monkeypatch.setattr(jaccard, "SIDE_ROWS", 3)
    rows = corpus(4)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = jaccard.near_duplicates(docs, 3, 90).select("doc_id", "n_shingles", "component_id").collect()
    assert ordered(got) == ordered(plain_components(rows, 3, 90))
