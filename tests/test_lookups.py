import pytest

from recordflow.operators.lookups import lookup


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("broadcast_rows", [0, 10**6])
def test_lookup_with_hot_missing_and_null_keys(spark, how, broadcast_rows):
    rows = [(i, 7 if i % 3 == 0 else i % 50, "x") for i in range(300)]
    rows += [(1000 + i, 99, "y") for i in range(150)]  # hot, but not in the table
    rows += [(2000 + i, None, "z") for i in range(150)]
    left = spark.createDataFrame(rows, "id bigint, k bigint, v string")
    table = {k: k * 10 for k in range(40)}
    right = spark.createDataFrame(list(table.items()), "k bigint, w bigint")
    got = lookup(left, right, ["k"], how, broadcast_rows=broadcast_rows)
    assert got.columns == ["k", "id", "v", "w"]
    want = [(k, i, v, table.get(k)) for i, k, v in rows if how == "left" or k in table]
    key = lambda r: r[1]
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(want, key=key)
