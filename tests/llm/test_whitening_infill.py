"""Whitening against numpy's eigenvectors; infilling against plain loops."""

import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from topup_analytics.llm import infill, whitening
from topup_analytics.llm.common import read_table


def plain_whitening(vectors, components=8):
    x = np.floor(1024 * np.array(vectors, dtype=np.float64)).astype(np.int64) + 100_000
    n, total = len(x), x.sum(axis=0)
    centred = x - total / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    return n, ((n * x - total) ** 2).sum(axis=1), centred @ axes / np.sqrt(values), values / np.trace(centred.T @ centred / n)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_whitening_of_the_test_tables(spark, sf):
    table = read_table(spark, f"/root/testdata/{sf}", "embeddings")
    rows = table.orderBy("vec_id").collect()
    n, deviation, white, explained = plain_whitening([r["embedding"] for r in rows])
    found = whitening.op12_embedding_whitening(spark, f"/root/testdata/{sf}").orderBy("vec_id", "component").collect()
    assert len(found) == 8 * len(rows) and {r["n"] for r in found} == {n}
    ours = np.array([r["whitened"] for r in found]).reshape(-1, 8)
    signs = np.sign((ours * white).sum(axis=0))
    assert np.allclose(ours * signs, white, atol=1e-9)
    assert [r["deviation"] for r in found[::8]] == deviation.tolist()
    assert np.allclose([r["explained"] for r in found[:8]], explained, rtol=1e-9)
    assert len({r["identity_error"] for r in found}) == 1 and found[0]["identity_error"] < 1e-9


KIND = "vec_id long, embedding array<float>, n int, component string, whitened double"


def test_odd_vectors(spark):
    rng = random.Random(3)
    sound = [(i, [rng.random() * 9 for _ in range(5)]) for i in range(40)]
    sound += [(50, [0.5]), (None, [1.0, 2.0]), (51, []), (52, [1e4, -1e4, 0.0, 0.0, 0.0]), sound[0], sound[0]]
    odd = [(60, None), (61, [1.0, None]), (62, [float("nan")] * 5), (63, [float("inf")]), (None, None)]
    frame = spark.createDataFrame([(*r, 1, "x", 2.0) for r in sound + odd], KIND).repartition(4)
    found = whitening.whitened(frame).collect()
    padded = [v + [0.0] * (5 - len(v)) for _, v in sound]
    padded = np.array(padded, dtype=np.float32).astype(np.float64)
    n, deviation, white, explained = plain_whitening(padded)
    assert len(found) == 5 * len(sound) and {r["n"] for r in found} == {n}
    assert sorted(r["deviation"] for r in found if r["component"] == 1) == sorted(deviation.tolist())
    for k in range(5):
        ours = sorted(abs(r["whitened"]) for r in found if r["component"] == k + 1)
        assert np.allclose(ours, sorted(np.abs(white[:, k])), atol=1e-7)
    assert found[0]["identity_error"] < 1e-9


def test_layout_does_not_matter(spark, small):
    table = read_table(spark, small, "embeddings")
    first, second = (sorted(map(tuple, whitening.whitened(table.repartition(p)).drop("identity_error").collect())) for p in (1, 7))
    assert first == second


def test_vectors_without_variance(spark):
    empty = spark.createDataFrame([], KIND)
    assert whitening.whitened(empty).collect() == []
    assert whitening.whitened(spark.createDataFrame([(1, [1.0, 2.0], 1, "", 0.0)] * 3, KIND)).collect() == []
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 3.0], 1, "", 0.0) for i in range(9)], KIND)
    assert {r["component"] for r in whitening.whitened(line).collect()} == {1}
    huge = spark.createDataFrame([(1, [3e38], 1, "", 0.0)], KIND)
    with pytest.raises(Exception, match="does not fit a bigint"):
        whitening.whitened(huge).collect()


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 12), st.integers(1, 12), st.integers(0, 10**6))
def test_factor_and_rotations(d, rank, seed):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(d, min(rank, d))) * 10.0 ** rng.integers(-4, 4, size=min(rank, d))
    scatter = base @ base.T
    factor = whitening.pivoted_cholesky(scatter)
    assert np.allclose(factor @ factor.T, scatter, rtol=1e-9, atol=1e-12 * scatter.max())
    values, axes = whitening.one_sided_jacobi(factor)
    assert np.allclose(axes.T @ axes, np.eye(len(values)), atol=1e-10)
    assert (np.diff(values) <= 0).all()
    assert np.allclose((axes * values) @ axes.T, scatter, atol=1e-10 * scatter.max())


def plain_infill(id, text):
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if id is None else id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(units), "plain", None, None, text
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 20:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def check(rows):
    for r in rows:
        text = r["row"]["text"]
        assert tuple(r)[1:6] == plain_infill(r["row"]["doc_id"], text)
        assert r["back"] == (text or "")


def infilled(frame):
    return infill.infill(frame).withColumn("back", infill.restored(F.col("output"), F.col("form"))).collect()


def test_infilling_of_odd_documents(spark, odd, none):
    rows = infilled(odd)
    assert len(rows) == odd.count()
    check(rows)
    assert infill.infill(none).count() == 0


NEAR_MARKS = ["<", "P", "S", "M", ">", "<S", "M>", "<<P", "é", "😀", "\n", "\r\n", "ab", "$1", "\\", "{2}", "\x00", "<P>"]


def test_infilling_of_texts_like_marks(spark):
    rng = random.Random(5)
    rows = [(i, "".join(rng.choice(NEAR_MARKS[: 17 + i % 2]) for _ in range(rng.randint(0, 12)))) for i in range(1500)]
    found = infilled(spark.createDataFrame(rows, "doc_id long, text string"))
    check(found)
    assert {r["form"] for r in found} == {"plain", "psm", "spm"}


def test_infilling_of_very_long_texts(spark):
    rows = [(1, "ab cd\n" * 500_000), (2, "x" * 4_000_000), (3, "é" * 1_000_000)]
    found = infilled(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    check(found)
    assert sorted(r["n"] for r in found) == [1, 1_000_000, 2_000_000]
