from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from topup_analytics.llm.common import read_table
from topup_analytics.llm.mixing import block_quotas, mixed, mixed_documents, pieces, source_targets
from topup_analytics.llm.sharding import stratified_shards


def check_shards(rows, shards):
    sizes = Counter(r["shard"] for r in rows)
    assert max(sizes.values()) - min(sizes.get(s, 0) for s in range(shards)) <= 1
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_hold_the_mixture(spark, small):
    rows = stratified_shards(read_table(spark, small, "documents"), 4).collect()
    check_shards(rows, 4)
    whole = Counter(r["source"] for r in rows)
    for shard in range(4):
        own = Counter(r["source"] for r in rows if r["shard"] == shard)
        assert all(abs(own[s] - n / 4) <= 2 for s, n in whole.items())


def test_shards_of_odd_rows(odd):
    rows = stratified_shards(odd, 3).collect()
    assert len(rows) == odd.count()
    check_shards(rows, 3)
    assert {(r["size"], r["text_crc32"]) for r in rows if r["doc_id"] in (1, 2)} == {(8, 0)}
    again = stratified_shards(odd.repartition(7), 3).collect()
    assert Counter(map(tuple, rows)) == Counter(map(tuple, again))


def test_no_rows(none):
    assert stratified_shards(none, 3).count() == 0
    assert mixed(none).count() == 0
    assert mixed_documents(none).columns == none.columns
    assert mixed_documents(none).count() == 0


def fill(sizes, weights, most=3):
    """Targets by filling and sharing anew until no target is too large."""
    left, capped = sum(sizes.values()), {}
    while True:
        rest = [s for s in sizes if s not in capped]
        total = sum(weights[s] for s in rest)
        over = {s: most * sizes[s] for s in rest if left * weights[s] / total > most * sizes[s]}
        if not over:
            return capped | {s: left * weights[s] / total for s in rest}
        capped |= over
        left -= sum(over.values())


def seats(targets, n):
    won = Counter()
    for _ in range(n):
        won[max(sorted(targets), key=lambda s: targets[s] / (2 * won[s] + 1))] += 1
    return won


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 100_000, "b": 5_000, "c": 40_000, "d": 1_000, "e": 40_000},
        {"a": 7, "b": 900_000, "c": 120_000},
        {"a": 50_000},
        {"a": 12, "b": 0, "c": 5},
        {"a": 300_000, "b": 300_000, "c": 300_000, "d": 300_000, "e": 300_000, "f": 10_000},
    ],
)
def test_targets_and_quotas(spark, sizes):
    frame = spark.createDataFrame(list(sizes.items()), "stratum string, source_size bigint")
    rows = {r["stratum"]: r for r in block_quotas(source_targets(frame)).collect()}
    want = fill(sizes, {s: i % 3 + 1 for i, s in enumerate(sorted(sizes))})
    for s, target in want.items():
        assert rows[s]["target"] == pytest.approx(target)
    plan = rows[max(sizes)]
    n = round(sum(sizes.values()) / (plan["block"] * plan["shards"]))
    won = seats({s: t for s, t in want.items() if t > 0}, n)
    for s, r in rows.items():
        assert r["quota"] == min(won[s], 3 * r["line"] // plan["shards"])


def test_mixture_of_real_rows(spark, small):
    docs = read_table(spark, small, "documents")
    rows = mixed(docs).select("row.source", "mix.*").collect()
    taken, target = Counter(), {}
    for r in rows:
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    assert all(abs(taken[s] - target[s]) <= 0.01 * target[s] + 1 for s in target)


def test_pieces_are_what_is_taken(spark, small):
    mix = mixed(read_table(spark, small, "documents"))
    words = {r["doc_id"]: (r["text"].split(), r["taken"]) for r in mix.select("row.doc_id", "row.text", "mix.taken").collect()}
    read = Counter()
    shards = Counter()
    for r in pieces(mix).select("row.doc_id", "first_word", "n_words", "shard").collect():
        read[r["doc_id"]] += r["n_words"]
        shards[r["shard"]] += r["n_words"]
        assert 0 <= r["first_word"] < r["first_word"] + r["n_words"] <= len(words[r["doc_id"]][0])
    assert all(read[d] == taken for d, (_, taken) in words.items())
    texts = Counter()
    for r in mixed_documents(read_table(spark, small, "documents")).collect():
        whole = " ".join(words[r["doc_id"]][0])
        assert " ".join(r["text"].split()) in whole
        texts[r["doc_id"]] += len(r["text"].split())
    assert texts == +read


def test_mixture_of_odd_rows(odd):
    rows = mixed(odd).select("row.doc_id", "row.text", "mix.*").collect()
    assert len(rows) == odd.count()
    assert all(r["size"] == r["taken"] == 0 for r in rows if not (r["text"] or "").split())
    assert all(r["taken"] <= 3 * r["size"] for r in rows)
    assert mixed_documents(odd).columns == odd.columns
    again = mixed(odd.repartition(5)).select("row.doc_id", "mix.*").collect()
    assert Counter(map(tuple, again)) == Counter(tuple(v for k, v in r.asDict().items() if k != "text") for r in rows)


def test_sources_in_code_point_order(spark):
    frame = spark.createDataFrame([("b", 1), ("aé", 1), ("aZ", 1), ("a\U0001f600", 1), ("a！", 1)], "stratum string, source_size long")
    rows = source_targets(frame).orderBy(F.col("stratum")).select("stratum", "weight").collect()
    assert [tuple(r) for r in rows] == [("aZ", 1), ("aé", 2), ("a！", 3), ("a\U0001f600", 1), ("b", 2)]
