"""Main text of web pages: gradient-boosted trees over DOM nodes, decoded along the tree."""

from __future__ import annotations

from collections.abc import Iterator
from random import Random

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topup_analytics.llm.common import Scratch, filled, read_table, ship_code, slices
from topup_analytics.llm.dom import features, kept_nodes, parse, text_of
from topup_analytics.llm.practice import MARK, Layout

#: The trees are fitted on about so many pages' texts, each set in so many practice layouts.
FIT_PAGES = 400
LAYOUTS = 10
TREES, DEPTH, SEED = 40, 6, 7
#: The practice rows are read in so many parts.
FIT_PARTS = 12

#: A tree as arrays: the feature a node splits on (-1: none), its threshold, its children, its value.
Tree = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _sample(pages: DataFrame, html: str, n: int) -> DataFrame:
    """About ``n`` different pages, chosen by a hash of their text."""
    rows = pages.select(F.col(html).alias("html"), F.xxhash64(html).alias("hash")).where("length(html) > 0")
    share = min(1.0, n / max(1, rows.count()))
    chosen = rows.where(F.shiftrightunsigned("hash", 24) < int(share * 2**40))
    return chosen.groupBy("hash").agg(F.first("html").alias("html"))


def _practice_rows(sample: DataFrame) -> DataFrame:
    """``features, label`` of the practice pages' nodes: 1 where main text is in it.

    Nodes below one without main text are left out: the trees learn the odds of a node whose parent has some.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, html in zip(*(c.to_pylist() for c in batch.columns)):
                page = parse(html)
                texts = [text.strip() for block in page.blocks for _, text in block if text.strip()]
                for number in range(LAYOUTS):
                    made = parse(Layout(Random(f"{SEED} {key} {number}"), texts).html())
                    label = np.zeros(len(made.parent))
                    label[0] = 1.0
                    for node in {n for block in made.blocks for n, text in block if MARK in text}:
                        while not label[node]:
                            label[node] = 1.0
                            node = made.parent[node]
                    open_nodes = label[made.parent] == 1
                    open_nodes[0] = False
                    rows = [pa.array(list(features(made)[open_nodes]), pa.list_(pa.float64())), pa.array(label[open_nodes])]
                    yield pa.RecordBatch.from_arrays(rows, ["features", "label"])

    return sample.select("hash", "html").mapInArrow(build, "features array<double>, label double")


def _arrays(tree) -> Tree:
    """A fitted tree, read from Spark's model."""
    columns: list[list] = [[], [], [], [], []]

    def add(node) -> int:
        place = len(columns[0])
        for column, value in zip(columns, (-1, 0.0, 0, 0, node.prediction())):
            column.append(value)
        if node.subtreeDepth():
            columns[0][place] = node.split().featureIndex()
            columns[1][place] = node.split().threshold()
            columns[2][place] = add(node.leftChild())
            columns[3][place] = add(node.rightChild())
        return place

    add(tree._java_obj.rootNode())
    kinds = (np.int64, np.float64, np.int64, np.int64, np.float64)
    return tuple(np.array(c, dtype=k) for c, k in zip(columns, kinds))


def fit(pages: DataFrame, html: str = "html", n_pages: int = FIT_PAGES) -> list[tuple[float, Tree]]:
    """Boosted trees that score a node's log-odds of holding main text, fitted on practice pages of a bounded sample.

    Empty where there is no page with any text.
    """
    ship_code(pages.sparkSession)
    scratch = Scratch(pages.sparkSession)
    sample = scratch.stored(_sample(pages, html, n_pages).repartition(FIT_PARTS, "hash"))
    if sample.isEmpty():
        return []
    rows = scratch.stored(_practice_rows(sample)).select(array_to_vector("features").alias("features"), "label")
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, minInstancesPerNode=10, seed=SEED).fit(rows)
    found = [(weight, _arrays(tree)) for weight, tree in zip(trees.treeWeights, trees.trees)]
    scratch.drop()
    return found


def log_odds(model: list[tuple[float, Tree]], rows: np.ndarray) -> np.ndarray:
    """Sum of the trees' values for every row of features, all rows a level at a time."""
    total = np.zeros(len(rows))
    every = np.arange(len(rows))
    for weight, (split, threshold, left, right, value) in model:
        at = np.zeros(len(rows), dtype=np.int64)
        while (inner := split[at] >= 0).any():
            to_left = rows[every, np.maximum(split[at], 0)] <= threshold[at]
            at = np.where(inner, np.where(to_left, left[at], right[at]), at)
        total += weight * value[at]
    return 2 * total


def main_text(html: str, model: list[tuple[float, Tree]]) -> str:
    """The main text of one page."""
    page = parse(html)
    return text_of(page, kept_nodes(page, log_odds(model, features(page))))


def extracted(pages: DataFrame, model: list[tuple[float, Tree]], html: str = "html") -> DataFrame:
    """``row`` (the page) and ``main_text``, for every page: the article without what stands around it.

    The whole page is read, however long or broken. Character references are decoded; white space in a block
    becomes one space; blocks are joined by line ends in the order of the page, tables by cells. A null or empty
    page, and one whose nodes are all rejected, gives the empty text. Repeated pages each give a row, and an empty
    table none. The page's own columns stay inside ``row``, whatever their names are.
    """
    ship_code(pages.sparkSession)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 64):
                read = [parse(text) for text in part.column(1).to_pylist()]
                measured = [features(page) for page in read]
                scores = np.split(log_odds(model, np.concatenate(measured)), np.cumsum([len(m) for m in measured])[:-1])
                texts = [text_of(page, kept_nodes(page, score)) for page, score in zip(read, scores)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], ["row", "main_text"])

    rows = pages.select(F.struct("*").alias("row"), filled(html).alias("html"))
    return rows.mapInArrow(extract, rows.select("row", F.col("html").alias("main_text")).schema)


def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    text = F.col("main_text")
    return extracted(pages, fit(pages)).select(
        "row.page_id", "row.url", text.alias("text"), F.char_length(text).cast("bigint").alias("n_chars")
    )
