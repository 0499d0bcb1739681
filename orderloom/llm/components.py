"""Connected components of a graph of links, by alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.scratch import remove, store

EDGE = "a long, b long"


def union(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of some links and the smallest node that each is joined to through them."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    root = np.arange(len(nodes))
    low, high = np.minimum(at[: len(a)], at[len(a) :]), np.maximum(at[: len(a)], at[len(a) :])
    while True:
        before = root.copy()
        least = np.minimum(root[low], root[high])
        np.minimum.at(root, root[low], least)
        np.minimum.at(root, root[high], least)
        root = root[root]
        if np.array_equal(root, before):
            return nodes, nodes[root]


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of a task as stars: each node with the smallest one it is joined to, a bounded number at a time."""
    held: list[np.ndarray] = []
    n = 0

    def out(parts):
        pairs = np.concatenate(parts)
        nodes, least = union(pairs[:, 0], pairs[:, 1])
        some = nodes != least
        return np.stack([nodes[some], least[some]], axis=1)

    for batch in batches:
        held.append(np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()], axis=1))
        n += batch.num_rows
        if n > 2_000_000:
            held = [out(held)]
            n = len(held[0])
            if n > 1_000_000:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in held[0].T], names=["a", "b"])
                held, n = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in out(held).T], names=["a", "b"])


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links`` (``a, b``): the smallest node it is joined to.

    Every round is written to the shared folder, so lineage stays short, and rounds grow with the logarithm of a
    component's width. A node that is linked with a third of all others is a hot key of an equi-join, which adaptive
    execution splits; minima are folded before they are shuffled. Nodes without a link to another are left out, and
    so are links with a null end.
    """
    spark = links.sparkSession
    given = links.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).where("a <> b")
    path = store(given.mapInArrow(_folded, EDGE).distinct(), "links")
    mark = None
    while True:
        edges = spark.read.schema(EDGE).parquet(path)
        seen = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == mark:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
        mark = seen
        # Large star: the neighbours above a node are moved to the smallest of its neighbourhood.
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a"), F.least("a", "low").alias("low"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        # Small star: a node and its neighbours below are moved to the smallest of them.
        down = large.where("a <> b").distinct()
        low = down.groupBy("a").agg(F.min("b").alias("low"))
        small = down.join(low, "a").select(F.explode(F.array(F.struct(F.col("a"), F.col("low").alias("b")), F.struct(F.col("b").alias("a"), F.col("low").alias("b")))).alias("e")).select("e.a", "e.b").where("a <> b").distinct()
        later = store(small, "links")
        remove(spark, path)
        path = later
