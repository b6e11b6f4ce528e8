"""Density clustering of low-dimensional points at one radius (DBSCAN*).

A point is a core point when at least ``min_pts`` points, itself included, lie within ``eps``.
Core points within ``eps`` of each other share a cluster; all other points are noise (Campello et
al. 2013). The result is exact, and no step lists the pairs of a crowded neighbourhood:

* Space is cut into cells whose diagonal is ``eps`` (Gunawan 2013; Gan and Tao 2015). A cell with
  ``min_pts`` points holds core points only, all of one cluster, however many they are. The other
  cells hold fewer than ``min_pts`` points, so the probes that can reach one cell are bounded.
* Two cells are connected when some pair of their core points is close enough. Bounding boxes
  decide most pairs of cells. Undecided ones are split into halves per dimension and compared
  again, down to single positions, as long as their clusters are not connected anyway.
* Clusters are the connected components of the cells.

Cells are counted with partial aggregation, and points meet cell tables in split lookups, so a
cell that holds a third of all rows does not end up in one task.
"""

from __future__ import annotations

import itertools
import math
from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, functions as F

from recordflow.ml.components import connected_components
from recordflow.operators.lookups import lookup, saved, saved_rows

#: Neighbour cells grow with a power of the dimensions; ``hierarchy`` takes any number of them.
MAX_DIMS = 3
MAX_DEPTH = 40


@dataclass(frozen=True)
class Grid:
    """Cells of one neighbourhood radius."""

    dims: int
    eps: float

    def __post_init__(self):
        if not 1 <= self.dims <= MAX_DIMS:
            raise ValueError(f"the grid is made for 1 to {MAX_DIMS} dimensions")
        if not self.eps > 0:
            raise ValueError("eps must be positive")

    @property
    def side(self) -> float:
        # Slightly short, so that rounding never puts two points of a cell further apart than eps.
        return self.eps / math.sqrt(self.dims) * (1 - 1e-6)

    @property
    def reach(self) -> float:
        """Distance from the origin up to which cell numbers are exact enough for that."""
        return self.side * 2.0**31

    @property
    def axes(self) -> range:
        return range(self.dims)

    def names(self, prefix: str) -> list[str]:
        return [f"{prefix}{i}" for i in self.axes]

    def cell(self, depth: int = 0, prefix: str = "c") -> list[Column]:
        """Cell numbers of the position ``x0..``; each depth halves the sides.

        The parts of a cell are numbered from its own corner, so depth takes nothing from the range.
        """
        at = [F.col(f"x{i}") / F.lit(self.side) for i in self.axes]
        if depth:
            at = [(a - F.floor(a)) * F.lit(2.0**depth) for a in at]
        return [F.floor(a).cast("bigint").alias(f"{prefix}{i}") for i, a in zip(self.axes, at)]

    def offsets(self) -> list[tuple[int, ...]]:
        """Cells that can hold a point within ``eps``, the own cell included."""
        reach = 2
        span = range(-reach, reach + 1)
        near = []
        for o in itertools.product(span, repeat=self.dims):
            gap = sum(max(abs(v) - 1, 0) ** 2 for v in o)
            if gap * self.side**2 <= self.eps**2:
                near.append(o)
        return near

    def beside(self, df: DataFrame, offsets: list[tuple[int, ...]]) -> DataFrame:
        """One row per neighbour cell ``k0..`` of the cell ``c0..``; the steps are a constant."""
        steps = F.array(*[F.array(*[F.lit(v).cast("bigint") for v in o]) for o in offsets])
        moved = df.select("*", F.explode(steps).alias("_step"))
        return moved.select(
            *df.columns, *[(F.col(f"c{i}") + F.get("_step", F.lit(i))).alias(f"k{i}") for i in self.axes]
        )

    def squared(self, parts: list[Column]) -> Column:
        return reduce(add, [p * p for p in parts])

    def distance(self, a: str, b: str) -> Column:
        """Squared distance of two positions."""
        return self.squared([F.col(f"{a}{i}") - F.col(f"{b}{i}") for i in self.axes])

    def box_gap(self, a: str, b: str) -> Column:
        """Squared smallest distance of two boxes with columns ``{a}lo0``, ``{a}hi0``, ..."""
        zero = F.lit(0.0)
        return self.squared(
            [
                F.greatest(
                    zero,
                    F.col(f"{a}lo{i}") - F.col(f"{b}hi{i}"),
                    F.col(f"{b}lo{i}") - F.col(f"{a}hi{i}"),
                )
                for i in self.axes
            ]
        )

    def box_span(self, a: str, b: str) -> Column:
        """Squared largest distance of two boxes."""
        return self.squared(
            [
                F.greatest(
                    F.col(f"{a}hi{i}") - F.col(f"{b}lo{i}"),
                    F.col(f"{b}hi{i}") - F.col(f"{a}lo{i}"),
                )
                for i in self.axes
            ]
        )

    def box(self) -> list[Column]:
        """Aggregates: bounding box of a group of positions, and its member of lowest id."""
        low = [F.min(f"x{i}").alias(f"lo{i}") for i in self.axes]
        high = [F.max(f"x{i}").alias(f"hi{i}") for i in self.axes]
        first = F.min_by(F.struct(*self.names("x")), F.col("id")).alias("first")
        return [*low, *high, first, F.min("id").alias("node")]

    def box_columns(self) -> list[str]:
        return [*self.names("lo"), *self.names("hi")]

    @property
    def limit(self) -> Column:
        return F.lit(self.eps * self.eps)


def positions(
    points: DataFrame, grid: Grid, id_name: str = "id", coords: str = "coords"
) -> tuple[DataFrame, DataFrame]:
    """(id, x0.., c0..) of all points with usable coordinates, and the other points.

    NULL and non-finite coordinates are not usable. A finite point too far out for exact cells, 2^31
    radii or so, fails the job; move the origin or scale the coordinates then.
    """
    flat = points.select(
        F.col(id_name).alias("id"),
        *[F.get(F.col(coords), F.lit(i)).cast("double").alias(f"x{i}") for i in grid.axes],
    )
    finite = reduce(
        lambda a, b: a & b,
        [F.coalesce(F.abs(F.col(x)) < F.lit(float("inf")), F.lit(False)) for x in grid.names("x")],
    )
    far = F.raise_error(F.lit("a point lies too far from the origin for this eps")).cast("double")
    checked = [F.when(F.abs(F.col(x)) < F.lit(grid.reach), F.col(x)).otherwise(far).alias(x) for x in grid.names("x")]
    placed = flat.filter(finite).select("id", *checked).select("*", *grid.cell())
    return saved(placed, "points"), flat.filter(~finite)


def _prefixed(df: DataFrame, prefix: str, columns: list[str]) -> list[Column]:
    return [F.col(c).alias(prefix + c) for c in columns]


def core_sparse_points(points: DataFrame, cells: DataFrame, grid: Grid, min_pts: int) -> DataFrame:
    """Core points among the points of cells with fewer than ``min_pts`` points."""
    c, k = grid.names("c"), grid.names("k")
    few = cells.filter(F.col("n") < min_pts).select(*c)
    sparse = saved(lookup(points, few, c, "inner").select("id", *grid.names("x"), *c), "sparse")
    probes = grid.beside(sparse, grid.offsets()).drop(*c)
    targets = cells.select(
        *[F.col(a).alias(b) for a, b in zip(c, k)], "n", *_prefixed(cells, "t", grid.box_columns())
    )
    at = [F.col(f"x{i}").alias(f"plo{i}") for i in grid.axes] + [F.col(f"x{i}").alias(f"phi{i}") for i in grid.axes]
    met = (
        probes.join(targets, k)
        .select("*", *at)
        .filter(grid.box_gap("p", "t") <= grid.limit)
        .withColumn("whole", grid.box_span("p", "t") <= grid.limit)
    )
    met = saved(met.select("id", *grid.names("x"), *k, "n", "whole"), "probes")
    sure = met.groupBy("id").agg(F.sum(F.when(F.col("whole"), F.col("n")).otherwise(0)).alias("sure"))
    sure = saved(sure, "sure")
    enough = sure.filter(F.col("sure") >= min_pts).select("id")
    open_probes = met.filter(~F.col("whole")).join(
        sure.filter(F.col("sure") < min_pts).select("id", "sure"), "id"
    )
    asked, n_asked = saved_rows(
        open_probes.select(
            F.col("id").alias("pid"),
            "sure",
            *[F.col(f"x{i}").alias(f"y{i}") for i in grid.axes],
            *[F.col(a).alias(b) for a, b in zip(k, c)],
        ),
        "asked",
    )
    # At most (neighbour cells) * (min_pts - 1) probes ask one cell; the points may be many.
    close = lookup(points.select("id", *c, *grid.names("x")), asked, c, "inner", entries=n_asked).filter(
        grid.distance("x", "y") <= grid.limit
    )
    late = (
        close.groupBy("pid")
        .agg(F.count(F.lit(1)).alias("more"), F.first("sure").alias("sure"))
        .filter(F.col("more") + F.col("sure") >= min_pts)
        .select(F.col("pid").alias("id"))
    )
    return saved(sparse.join(enough.union(late), "id", "left_semi"), "core")


def _compare(pairs: DataFrame, grid: Grid) -> DataFrame:
    """Drop pairs of boxes too far apart and mark the connected ones."""
    joined = (
        (grid.box_span("a_", "b_") <= grid.limit)
        | (
            grid.squared([F.col(f"a_first.x{i}") - F.col(f"b_first.x{i}") for i in grid.axes])
            <= grid.limit
        )
    )
    return pairs.filter(grid.box_gap("a_", "b_") <= grid.limit).withColumn("joined", joined)


def _refine(members: DataFrame, pairs: DataFrame, grid: Grid) -> DataFrame:
    """Edges (a, b) among undecided pairs of cells, by halving the cells of each pair."""
    found = None
    s, up = grid.names("s"), grid.names("u")
    open_pairs = pairs.select("a", "b")
    for depth in range(1, MAX_DEPTH + 1):
        if depth < MAX_DEPTH:
            parts = grid.cell(depth, "s")
        else:
            parts = [F.col(f"x{i}").alias(f"s{i}") for i in grid.axes]
        group = [F.col("owner"), *parts, *grid.cell(depth - 1, "u")]
        boxes = members.groupBy(*group).agg(*grid.box()).drop("node")
        boxes = saved(boxes, "boxes")
        sides = {
            end: boxes.select(
                F.col("owner").alias(end),
                *[F.col(u).alias(f"{end}_{u}") for u in up],
                *[F.col(v).alias(f"{end}_{v}") for v in s],
                *_prefixed(boxes, f"{end}_", [*grid.box_columns(), "first"]),
            )
            for end in ("a", "b")
        }
        keys = {end: [end, *([f"{end}_{u}" for u in up] if depth > 1 else [])] for end in ("a", "b")}
        joined = open_pairs
        for end in ("a", "b"):
            side = sides[end] if depth > 1 else sides[end].drop(*[f"{end}_{u}" for u in up])
            joined = joined.join(side, keys[end])
        compared, n_pairs = saved_rows(_compare(joined, grid), "compared")
        if not n_pairs:
            break
        edges = saved(compared.filter("joined").select("a", "b").distinct(), "found")
        found = edges if found is None else found.union(edges)
        rest = compared.filter(~F.col("joined")).join(edges, ["a", "b"], "left_anti")
        open_pairs, n_open = saved_rows(rest.select(
            "a", "b", *[F.col(f"{end}_{v}").alias(f"{end}_u{v[1:]}") for end in ("a", "b") for v in s]
        ), "open")
        if not n_open:
            break
    return pairs.select("a", "b").limit(0) if found is None else found


def core_labels(points: DataFrame, grid: Grid, min_pts: int) -> tuple[DataFrame, DataFrame]:
    """Cells that hold core points with their cluster, and the core points of sparse cells.

    Cells: (c0.., n, dense, node, root, first, box); ``root`` names the cluster.
    """
    c = grid.names("c")
    cells = saved(points.groupBy(*c).agg(F.count(F.lit(1)).alias("n"), *grid.box()), "cells")
    core_points = core_sparse_points(points, cells, grid, min_pts)
    dense = cells.filter(F.col("n") >= min_pts).withColumn("dense", F.lit(True))
    thin = (
        core_points.groupBy(*c)
        .agg(F.count(F.lit(1)).alias("n"), *grid.box())
        .withColumn("dense", F.lit(False))
    )
    core_cells, n_cells = saved_rows(dense.unionByName(thin), "core_cells")

    ahead = [o for o in grid.offsets() if o > (0,) * grid.dims]
    k = grid.names("k")
    box = [*grid.box_columns(), "first"]
    left = grid.beside(
        core_cells.select(F.col("node").alias("a"), *_prefixed(core_cells, "a_", box), *c), ahead
    ).drop(*c)
    right = core_cells.select(
        *[F.col(x).alias(y) for x, y in zip(c, k)],
        F.col("node").alias("b"),
        *_prefixed(core_cells, "b_", box),
    )
    compared = saved(_compare(left.join(right, k), grid).select("a", "b", "joined"), "pairs")
    nodes = core_cells.select("node")
    edges = compared.filter("joined").select("a", "b")
    roots = connected_components(nodes, edges)

    # Pairs inside one cluster need no answer.
    undecided = compared.filter(~F.col("joined"))
    for end in ("a", "b"):
        undecided = lookup(
            undecided,
            roots.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}")),
            [end],
            entries=n_cells,
        )
    undecided, n_undecided = saved_rows(undecided.filter("root_a <> root_b").select("a", "b", "root_a", "root_b"), "undecided")
    if n_undecided:
        owners = undecided.select(F.col("a").alias("node")).union(undecided.select(F.col("b").alias("node")))
        asked = core_cells.join(owners.distinct(), "node", "left_semi").select(
            *c, "dense", F.col("node").alias("owner")
        )
        asked, n_asked = saved_rows(asked, "asked_cells")
        x = ["id", *grid.names("x")]
        crowd = lookup(points, asked.filter("dense"), c, "inner", entries=n_asked).select(*x, "owner")
        few = lookup(core_points, asked.filter(~F.col("dense")), c, "inner", entries=n_asked).select(*x, "owner")
        members = saved(crowd.unionByName(few), "members")
        more = _refine(members, undecided, grid)
        links = (
            undecided.join(more.distinct(), ["a", "b"])
            .select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))
            .distinct()
        )
        merged = connected_components(roots.select(F.col("root").alias("node")).distinct(), links)
        tops = merged.select(F.col("node").alias("root"), F.col("root").alias("top"))
        roots = lookup(roots, tops, ["root"], entries=n_cells).select("node", F.col("top").alias("root"))
    # Name each cluster by its lowest core id.
    lowest = lookup(core_cells.select("node", *c, "n", "dense", *box), roots, ["node"], entries=n_cells)
    names = lowest.groupBy("root").agg(F.min("node").alias("cluster"))
    labelled = lookup(lowest, names, ["root"], entries=n_cells).drop("root")
    return saved(labelled, "labelled_cells"), core_points


def label_points(points: DataFrame, cells: DataFrame, core_points: DataFrame, grid: Grid) -> DataFrame:
    """(id, cluster): the lowest core id of the cluster, NULL for noise.

    Only points of sparse cells are looked up by id.
    """
    c = grid.names("c")
    met = lookup(points.select("id", *c), cells.select(*c, "dense", "cluster"), c)
    crowd = met.filter("dense").select("id", "cluster")
    few = met.filter(~F.coalesce("dense", F.lit(False))).join(
        core_points.select("id", F.lit(True).alias("core")), "id", "left"
    )
    return crowd.union(few.select("id", F.when(F.col("core"), F.col("cluster")).alias("cluster")))


def dbscan_star(
    points: DataFrame,
    *,
    eps: float,
    min_pts: int = 5,
    dims: int,
    id_name: str = "id",
    coords: str = "coords",
) -> DataFrame:
    """(id, cluster) for all points; ``cluster`` is the lowest core id in it, NULL for noise."""
    grid = Grid(dims, eps)
    placed, unplaced = positions(points, grid, id_name, coords)
    cells, core_points = core_labels(placed, grid, min_pts)
    labels = label_points(placed, cells, core_points, grid)
    nowhere = unplaced.select("id", F.lit(None).cast(dict(labels.dtypes)["cluster"]).alias("cluster"))
    return labels.union(nowhere).withColumnRenamed("id", id_name)
