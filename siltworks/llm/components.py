"""Connected components of an edge table, without gathering it in one place.

Each round splits the edges into blocks of bounded size, replaces every block by a
spanning star per component (union-find inside the block), then joins the stars: a node
with several roots links these roots, and a root that has a root of its own hands its
members on. Both steps keep the components, and both shrink the table to about one row
per node, until every node has one root and no root has another. A table that fits one
block is done after the first round.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from siltworks.llm.common import partitions_for
from siltworks.session import stage

#: edges that one task holds
BLOCK_EDGES = 1_000_000

_STAR = "node long, root long"


def spanning_stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its component) of every node that is not the smallest one."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    root = np.arange(len(nodes))
    while True:
        rx, ry = root[x], root[y]
        open_ = rx != ry
        if not open_.any():
            break
        x, y, rx, ry = x[open_], y[open_], rx[open_], ry[open_]
        np.minimum.at(root, np.maximum(rx, ry), np.minimum(rx, ry))
        while True:  # every node points at its root again
            up = root[root]
            if np.array_equal(up, root):
                break
            root = up
    inner = root != np.arange(len(nodes))
    return nodes[inner], nodes[root[inner]]


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if b.num_rows]
    if parts:
        node, root = spanning_stars(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
        for at in range(0, len(node), 65536):
            yield pa.RecordBatch.from_arrays(
                [pa.array(node[at : at + 65536], pa.int64()), pa.array(root[at : at + 65536], pa.int64())],
                names=["node", "root"],
            )


def connected_components(edges: DataFrame, block_edges: int = BLOCK_EDGES) -> DataFrame:
    """(node, root) of every node of ``edges`` (two long columns) that is not its component's smallest.

    Loops and repeated edges do no harm; an empty table gives an empty one.
    """
    a, b = edges.columns
    now = stage(edges.select(F.col(a).alias("node"), F.col(b).alias("root")).filter("node != root"), "edges")
    while True:
        blocks = partitions_for(now.count(), block_edges, most=1 << 20)
        stars = stage(now.repartition(blocks).mapInArrow(_stars, _STAR), "stars")
        if blocks == 1:
            return stars
        parents = stars.groupBy("node").agg(F.min("root").alias("parent"))
        joined = stars.join(parents, "node")
        # a second root is linked to the smallest one; a root with a parent passes its members on
        links = joined.filter("root != parent").select(F.col("root").alias("node"), F.col("parent").alias("root"))
        up = parents.select(F.col("node").alias("root"), F.col("parent").alias("above"))
        moved = parents.withColumnRenamed("parent", "root").join(up, "root", "left")
        following = moved.select("node", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("changed"))
        following = stage(following.unionByName(links.distinct().withColumn("changed", F.lit(True))), "links")
        if following.filter("changed").isEmpty():
            return following.select("node", "root")
        now = following.select("node", "root")
