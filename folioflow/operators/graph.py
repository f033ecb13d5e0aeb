"""Connected components by distributed union-find: local forests, merged level by level."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.session import cut

#: Edges one local forest takes on. A level with more edges than this in all is spread over more tasks.
FOREST_EDGES = 2_000_000
#: A level that leaves more than this share of its edges is contracted before the next.
STUCK = 0.5


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the edges (a, b) and the least node of the tree each belongs to.

    Labels hook to the smaller root and paths are halved until no edge joins two trees.
    """
    codes, nodes = pd.factorize(np.concatenate([a, b]), sort=True)
    x, y = codes[: len(a)], codes[len(a) :]
    root = np.arange(len(nodes))
    while len(x):
        x, y = root[x], root[y]
        open_ = x != y
        x, y = x[open_], y[open_]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(up := root[root], root):
            root = up
    nodes = np.asarray(nodes)
    return nodes, nodes[root]


def _local(schema: pa.Schema):
    def grown(tables: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(tables)
        node, root = forest(t.column(0).to_numpy(), t.column(1).to_numpy())
        for k in range(0, len(node), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(node[k : k + 100_000], schema.types[0]), pa.array(root[k : k + 100_000], schema.types[1])], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for t in batches:
            if t.num_rows:
                held.append(t)
                size += t.num_rows
            if size >= FOREST_EDGES:
                yield from grown(held)
                held, size = [], 0
        if held:
            yield from grown(held)

    return run


def contracted(level: DataFrame, turn: int) -> tuple[DataFrame, DataFrame]:
    """(parents, edges): a round of random mating. A hash makes each node a host or a guest; a guest with
    hosts beside it moves to the least of them, which takes a quarter of the nodes away on average, whatever
    the graph. Equi-joins and partial aggregates only, on a table of one row a node."""
    ends = level.select("node", "root").unionByName(level.select(F.col("root").alias("node"), F.col("node").alias("root")))
    host = lambda c: F.pmod(F.xxhash64(c, F.lit(turn)), F.lit(2)) == 0
    parents = cut(ends.groupBy("node").agg(F.min(F.when(~host("node") & host("root"), F.col("root"))).alias("root")).select("node", F.coalesce("root", "node").alias("root")))
    to = lambda c: parents.select(F.col("node").alias(c), F.col("root").alias(f"_{c}"))
    moved = level.join(to("node"), "node").join(to("root"), "root").where("_node <> _root")
    return parents, cut(moved.select(F.greatest("_node", "_root").alias("node"), F.least("_node", "_root").alias("root")).distinct())


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): every node of ``edges`` with the least node it is connected to.

    Each task grows forests over FOREST_EDGES of its edges at a time and passes on one link per node,
    however often the node occurs, so a hub with a third of all edges costs one row a forest. Links of a node
    that several forests hold tie those forests' roots together; those ties, over roots only, are the next
    level's edges. A level of at most ``FOREST_EDGES`` edges is the last, in one forest; a larger one is spread
    over as many tasks as that bound asks for, so no task ever holds more. If such a level leaves more than STUCK
    of its edges (a chain in random order does), a round of random mating comes before the next, so the levels
    are logarithmic in number. Labels then flow back down, one equi-join a level.
    Edges with a null end are dropped; an edge from a node to itself keeps the node. Empty in, empty out.
    """
    kind = edges.schema[a].dataType.simpleString()
    ddl = f"node {kind}, root {kind}"
    arrow = pa.schema([("node", pa.string() if kind == "string" else pa.int64()), ("root", pa.string() if kind == "string" else pa.int64())])
    level = edges.select(F.col(a).alias("node"), F.col(b).alias("root")).where("node is not null and root is not null")
    parents: list[DataFrame] = []
    last, mated, n = False, 0, None
    while True:
        links = level.mapInArrow(_local(arrow), ddl)
        if last:
            parents.append(links)
            break
        found = cut(links.groupBy("node").agg(F.min("root").alias("root"), F.collect_set("root").alias("roots")))
        parents.append(found.select("node", "root"))
        level = found.where(F.size("roots") > 1).select(F.explode("roots").alias("node"), "root").where("node <> root")
        before, n = n, level.count()
        while n > FOREST_EDGES and before is not None and n > STUCK * before:
            above, level = contracted(level, mated)
            parents.append(above)
            mated, n = mated + 1, level.count()
        if n == 0:
            break
        last = n <= FOREST_EDGES
        level = level.coalesce(1) if last else level.repartition(-(-n // FOREST_EDGES))
    out = parents.pop()
    while parents:
        down = out.select(F.col("node").alias("root"), F.col("root").alias("top"))
        out = parents.pop().join(down, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    if mated:  # mates are not the least of their component
        out = cut(out)
        out = out.join(out.groupBy("root").agg(F.min("node").alias("top")), "root").select("node", F.col("top").alias("root"))
    return out.select("node", F.col("root").alias("component"))
