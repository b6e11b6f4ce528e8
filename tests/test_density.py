import numpy as np
import pytest
from pyspark.sql import functions as F

from recordflow.ml import density as D
from recordflow.ml.components import connected_components
from recordflow.operators import lookups


def brute_force(x, eps, min_pts):
    """Lowest core id per point, None for noise."""
    near = ((x[:, None, :] - x[None, :, :]) ** 2).sum(-1) <= eps * eps
    core = near.sum(1) >= min_pts
    label = [None] * len(x)
    for i in range(len(x)):
        if core[i] and label[i] is None:
            label[i], stack = i, [i]
            while stack:
                for v in np.nonzero(near[stack.pop()] & core)[0]:
                    if label[v] is None:
                        label[v] = i
                        stack.append(int(v))
    return label


def frame(spark, x):
    return spark.createDataFrame(
        [(i, [float(v) for v in row]) for i, row in enumerate(x)], "id bigint, coords array<double>"
    )


def sample(dims, n, seed):
    """A blob, background, a third of all points at one place, and two thin arcs close to eps apart."""
    r = np.random.default_rng(seed)
    arc = np.linspace(0, 6, n // 6)
    arcs = np.zeros((2 * len(arc), dims))
    arcs[:, 0] = np.concatenate([arc, arc])
    if dims > 1:
        arcs[:, 1] = np.concatenate([np.sin(arc) - 8, np.sin(arc) - 8.55])
    return np.concatenate(
        [
            r.normal(0, 0.5, (n // 6, dims)),
            r.uniform(-4, 4, (n // 6, dims)),
            np.tile(r.normal(3, 0.01, (1, dims)), (n // 3, 1)),
            arcs,
        ]
    )


@pytest.mark.parametrize("dims, n, eps, min_pts", [(1, 300, 0.02, 4), (2, 600, 0.5, 5), (3, 450, 0.6, 5)])
def test_equals_brute_force(spark, dims, n, eps, min_pts):
    x = sample(dims, n, dims)
    got = {r["id"]: r["cluster"] for r in D.dbscan_star(frame(spark, x), eps=eps, min_pts=min_pts, dims=dims).collect()}
    assert [got[i] for i in range(len(x))] == brute_force(x, eps, min_pts)


def test_crowded_cells_that_face_each_other(spark):
    """Pairs of dense cells that only a few far members connect, or just fail to."""
    r = np.random.default_rng(5)
    left = np.column_stack([r.uniform(0.0, 0.1, 80), r.uniform(0, 0.3, 80)])
    touching = np.column_stack([r.uniform(1.0999, 1.2, 80), r.uniform(0, 0.3, 80)])
    apart = np.column_stack([r.uniform(5, 5.1, 80), r.uniform(0, 0.3, 80)])
    apart2 = np.column_stack([r.uniform(6.1001, 6.2, 80), r.uniform(0, 0.3, 80)])
    x = np.concatenate([left, touching, apart, apart2])
    got = {v["id"]: v["cluster"] for v in D.dbscan_star(frame(spark, x), eps=1.0, min_pts=5, dims=2).collect()}
    assert [got[i] for i in range(len(x))] == brute_force(x, 1.0, 5)


def test_shuffled_lookups_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(lookups, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(lookups.lookup, "__kwdefaults__", {"broadcast_rows": 0, "entries": None})
    x = sample(2, 240, 9)
    got = {r["id"]: r["cluster"] for r in D.dbscan_star(frame(spark, x), eps=0.5, min_pts=5, dims=2).collect()}
    assert [got[i] for i in range(len(x))] == brute_force(x, 0.5, 5)


def test_points_without_position_are_noise(spark):
    df = spark.createDataFrame(
        [(i, [1.0, 1.0]) for i in range(5)] + [(5, [float("nan"), 1.0]), (6, None), (7, [1.0, None])],
        "id bigint, coords array<double>",
    )
    got = {r["id"]: r["cluster"] for r in D.dbscan_star(df, eps=1.0, min_pts=5, dims=2).collect()}
    assert got == {**dict.fromkeys(range(5), 0), 5: None, 6: None, 7: None}


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (102, 101), (103, 103)]
    nodes = sorted({n for e in edges for n in e} | {200})
    result = connected_components(
        spark.createDataFrame([(n,) for n in nodes], "node bigint"), spark.createDataFrame(edges, "a bigint, b bigint")
    )
    groups = {}
    for r in result.collect():
        groups.setdefault(r["root"], set()).add(r["node"])
    assert sorted(map(sorted, groups.values())) == [list(range(61)), [100, 101, 102], [103], [200]]


def test_grid_limits():
    with pytest.raises(ValueError):
        D.Grid(4, 1.0)
    with pytest.raises(ValueError):
        D.Grid(2, 0.0)


@pytest.mark.parametrize("offset", [0.0, 1e7, -3e8])
def test_points_far_from_the_origin(spark, offset):
    rows = [(i, [offset + i / 100]) for i in range(10)] + [(10, [offset + 40.0])]
    df = spark.createDataFrame(rows, "id long, coords array<double>")
    found = {r[0]: r[1] for r in D.dbscan_star(df, dims=1, eps=1.0, min_pts=4).select("id", "cluster").collect()}
    assert len({found[i] for i in range(10)}) == 1 and found[0] is not None and found[10] is None


def test_points_too_far_are_not_noise(spark):
    df = spark.createDataFrame([(i, [1e12 + i]) for i in range(5)], "id long, coords array<double>")
    with pytest.raises(Exception, match="too far"):
        D.dbscan_star(df, dims=1, eps=1.0, min_pts=2).count()
