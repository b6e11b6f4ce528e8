"""Exact top-k search by inner product: a KD-tree for each shard of the vectors.

Nodes are split at the median of their widest dimension and keep tight boxes. A query goes through a
tree best first, by the largest inner product that a box allows, and stops at its k-th score so far,
which goes on from shard to shard.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from recordflow.operators.lookups import saved

#: Vectors in a shard and in a leaf, and queries in a block, about.
SHARD, LEAF, BLOCK = 4096, 128, 256
#: Query blocks whose scores so far a task remembers.
REMEMBERED = 4096
LONG = np.iinfo(np.int64)


@dataclass
class Tree:
    ids: np.ndarray
    points: np.ndarray
    low: np.ndarray
    high: np.ndarray
    spans: list[tuple[int, int]]
    children: list[tuple[int, int] | None]


def build(ids: np.ndarray, points: np.ndarray) -> Tree:
    """The tree over the rows of ``points``, reordered so that each node is a slice."""
    order = np.lexsort((ids,))
    low, high, spans, children = [], [], [], []
    todo = [(0, len(ids), None)]
    while todo:
        start, end, parent = todo.pop()
        inside = points[order[start:end]]
        low.append(inside.min(axis=0))
        high.append(inside.max(axis=0))
        spans.append((start, end))
        children.append(None)
        node = len(spans) - 1
        if parent is not None:
            children[parent] = (*(children[parent] or ()), node)
        spread = high[node] - low[node]
        if end - start > LEAF and spread.size and spread.max() > 0:
            half = (end - start) // 2
            rank = np.argpartition(inside[:, int(spread.argmax())], half)
            order[start:end] = order[start:end][rank]
            todo += [(start, start + half, node), (start + half, end, node)]
    return Tree(ids[order], points[order], np.array(low), np.array(high), spans, children)


def exact(*arrays: np.ndarray) -> list[np.ndarray]:
    """The arrays as they are if doubles hold every inner product, else as Python integers."""
    reach = 1.0
    for a in arrays:
        reach *= max(float(np.abs(a).max(initial=0)), 1.0)
    if reach * max(arrays[0].shape[-1], 1) < 2**53:
        return list(arrays)
    whole = np.vectorize(int, otypes=[object])
    return [whole(a) if a.size else a.astype(object) for a in arrays]


def search(tree: Tree, ids: np.ndarray, queries: np.ndarray, k: int, floors: list) -> Iterator[list[tuple]]:
    """For each query its best (score, id) in the tree, except for its own id and scores below its floor."""
    queries, points = exact(queries, tree.points)
    low, high = (a.astype(queries.dtype) for a in (tree.low, tree.high))
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    bounds = up @ high.T + down @ low.T
    for own, query, bound, floor in zip(ids, queries, bounds, floors):
        best: list[tuple] = []  # a heap of (score, -id), worst first
        heap = [(-bound[0], 0)]
        while heap:
            reach, node = heapq.heappop(heap)
            if floor is not None and -reach < floor:
                break
            if tree.children[node]:
                for child in tree.children[node]:
                    if floor is None or bound[child] >= floor:
                        heapq.heappush(heap, (-bound[child], child))
                continue
            start, end = tree.spans[node]
            scores = points[start:end] @ query
            near = range(end - start) if floor is None else np.flatnonzero(scores >= floor)
            for i in near:
                if (other := tree.ids[start + i]) != own:
                    entry = (int(scores[i]), -int(other))
                    if len(best) < k:
                        heapq.heappush(best, entry)
                    elif entry > best[0]:
                        heapq.heapreplace(best, entry)
            if len(best) == k:
                floor = best[0][0] if floor is None else max(floor, best[0][0])
        yield [(score, -i) for score, i in sorted(best, reverse=True)]


def top_k(vectors: DataFrame, queries: Column, k: int, scale: float = 256.0) -> DataFrame:
    """(``query_id``, ``rank``, ``vec_id``, ``score``) of the ``k`` best rows for each row of ``vectors``
    (``vec_id``, ``embedding``) for which ``queries`` holds.

    Components become floor(scale * x), and the score is their inner product, exact at any size and
    cut to the range of a long. Ties go to the smaller id.

    Vectors that are null or hold a null or non-finite component, also after scaling, and rows
    without an id take no part. Vectors of different lengths have no score. Rows that share the
    query's id are its own; other rows that repeat are candidates each, and an id that is queried
    with several vectors is queried with the lowest. An empty vector scores 0 against another. An
    empty table gives an empty result. Other columns are not looked at.

    All vectors are dealt into shards of a bounded size, and queries into blocks. A block meets one
    shard first; its k-th scores there are the floors for all others.
    """
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("double"))
    fine = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x.cast("double") * scale) < float("inf")))
    rows = (
        vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
        .filter(fine)
        .select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("point"), queries.alias("asked"))
        .withColumn("width", F.size("point"))
    )
    rows = saved(rows, "search_rows")
    sizes = rows.groupBy("width").agg(
        F.ceil(F.count(F.lit(1)) / SHARD).cast("int").alias("shards"),
        F.ceil(F.count_if("asked") / BLOCK).cast("int").alias("blocks"),
    )
    sizes = saved(sizes, "search_sizes")  # one row per length of vector

    def packed(rows: DataFrame, name: str, pack) -> DataFrame:
        def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
            ids = group["vec_id"].to_numpy(np.int64)
            points = np.array(group["point"].tolist(), float).reshape(len(ids), int(key[0]))
            return pd.DataFrame({"width": [key[0]], name: [key[1]], f"{name}_data": [pickle.dumps(pack(ids, points))]})

        return rows.groupBy("width", name).applyInPandas(run, f"width int, {name} int, {name}_data binary")

    dealt = rows.join(F.broadcast(sizes), "width")
    shard = F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.col("shards")).cast("int")
    trees = saved(packed(dealt.withColumn("shard", shard), "shard", build), "kd_trees")
    asked = rows.filter("asked").groupBy("vec_id").agg(F.min(F.struct("width", "point")).alias("q"))
    asked = asked.select("vec_id", "q.*").join(F.broadcast(sizes), "width")
    block = F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int")
    blocks = packed(asked.withColumn("block", block), "block", lambda ids, points: (ids, points))
    blocks = saved(blocks.join(F.broadcast(sizes), "width"), "query_blocks")

    def searched(pairs: DataFrame) -> DataFrame:
        def run(batches):
            floors: dict[tuple, list] = {}
            for batch in batches:
                for row in batch.to_pylist():
                    tree = pickle.loads(row["shard_data"])
                    ids, points = pickle.loads(row["block_data"])
                    if len(floors) > REMEMBERED:
                        floors.clear()
                    start = pickle.loads(row["floors"]) if row["floors"] else [None] * len(ids)
                    floor = floors.setdefault((row["width"], row["block"]), start)
                    found = list(search(tree, ids, points, k, floor))
                    for i, best in enumerate(found):
                        if len(best) == k and (floor[i] is None or best[-1][0] > floor[i]):
                            floor[i] = best[-1][0]
                    flat = [(int(q), v, min(max(s, LONG.min), LONG.max)) for q, best in zip(ids, found) for s, v in best]
                    columns = [pa.array(c, pa.int64()) for c in zip(*flat)] or [pa.array([], pa.int64())] * 3
                    extra = pa.array([pickle.dumps(floor)] + [None] * (len(flat) - 1) if flat else [], pa.binary())
                    places = [pa.array([row[c]] * len(flat), pa.int32()) for c in ("width", "block")]
                    yield pa.RecordBatch.from_arrays([*places, *columns, extra], names)

        names = ["width", "block", "query_id", "vec_id", "score", "floors"]
        return pairs.select("width", "block", "shard_data", "block_data", "floors").mapInArrow(
            run, "width int, block int, query_id long, vec_id long, score long, floors binary"
        )

    home = F.pmod(F.col("block"), F.col("shards")).cast("int")
    first = blocks.withColumn("shard", home).withColumn("floors", F.lit(None).cast("binary"))
    near = saved(searched(first.join(trees, ["width", "shard"])), "home_scores")
    floors = near.filter("floors is not null").select("width", "block", "floors")  # one row per block
    others = F.explode(F.filter(F.sequence(F.lit(0), F.col("shards") - 1), lambda s: s != home))
    rest = blocks.join(floors, ["width", "block"], "left").withColumn("shard", others)
    found = near.select("query_id", "vec_id", "score").union(
        searched(rest.join(trees, ["width", "shard"])).select("query_id", "vec_id", "score")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
