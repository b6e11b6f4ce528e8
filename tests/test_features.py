import hashlib
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F, types as T

from recordflow.functions.dates import created_at, days_between, short_date
from recordflow.functions.hashing import bucket, bucket_counts, value_text
from recordflow.operators import features as FT


@pytest.mark.parametrize(
    "text, expected", [("USA", 20), ("True", 52), ("SMB", 25), ("", 62), ("nan", 40)]
)
def test_known_buckets(texts, text, expected):
    assert texts(text).select(bucket(F.col("value"))).first()[0] == expected


@pytest.mark.parametrize("n", [2, 16, 64, 100, 1000, 4096, 999_983, 2**31])
def test_bucket_is_the_digest_modulo_n(texts, n):
    values = [f"v{i}" for i in range(50)]
    got = [r[0] for r in texts(*values).select(bucket(F.col("value"), n)).collect()]
    assert [g % 2**32 for g in got] == [int(hashlib.md5(v.encode()).hexdigest(), 16) % n for v in values]


def test_value_text(spark):
    df = spark.createDataFrame([(True, 5, None, "x")], "b boolean, i int, n string, s string")
    types = dict(zip(df.columns, [f.dataType for f in df.schema.fields]))
    row = df.select(*[value_text(F.col(c), types[c]).alias(c) for c in df.columns]).first()
    assert tuple(row) == ("True", "5", "nan", "x")
    assert spark.createDataFrame([(False,)], "b boolean").select(
        value_text(F.col("b"), T.BooleanType())
    ).first()[0] == "False"


@pytest.mark.parametrize("n", [64, 128])
def test_counts_sum_to_the_number_of_columns(spark, n):
    random.seed(1)
    rows = [(i, *[random.choice(["a", "b", None, "c d"]) for _ in range(6)]) for i in range(40)]
    df = spark.createDataFrame(rows, "Id int, a string, b string, c string, d string, e string, f string")
    out = FT.hash_features(df, list("abcdef"), n).collect()
    for r in out:
        want = [0] * n
        for c in "abcdef":
            text = r[c] if r[c] is not None else "nan"
            want[int(hashlib.md5(text.encode()).hexdigest(), 16) % n] += 1
        assert r["x"] == want


@pytest.mark.parametrize("fields", [15, 16, 256])
def test_counts_of_equal_values_fit_their_counters(spark, fields):
    df = spark.createDataFrame([(1,)], "Id int").select("Id", *[F.lit("USA").alias(f"c{i}") for i in range(fields)])
    out = FT.hash_features(df, [f"c{i}" for i in range(fields)]).first()["x"]
    assert out[20] == fields and sum(out) == fields


def test_buckets_are_counted_once_per_row(spark):
    """Every word of counters is filled in one pass over the buckets, not in one for each number unpacked."""
    rows = spark.range(1).select(F.array(*[F.lit(i) for i in range(14)]).alias("b"))
    text = rows.select(bucket_counts(F.col("b"), 64, 14).alias("x"))._jdf.queryExecution().analyzed().toString()
    unpacking = text[text.index("sequence(0, 63") :]
    assert "aggregate(" in text and "aggregate(" not in unpacking
    assert rows.select(bucket_counts(F.col("b"), 64, 14).alias("x")).first()["x"] == [1] * 14 + [0] * 50


def test_column_order_does_not_matter(spark):
    df = spark.createDataFrame([("p", "q", "r")], "a string, b string, c string")
    one = FT.hash_features(df, ["a", "b", "c"]).first()["x"]
    assert one == FT.hash_features(df, ["c", "a", "b"]).first()["x"]


def days(close, created):
    if close.year > 2068:
        close = close.replace(year=close.year - 100)
    return (close - created).days


@pytest.mark.parametrize(
    "close, created, expected",
    [
        ("5/25/21", "2016-01-16T00:00:00.000Z", 1956),
        ("12/01/20", "2020-11-30T12:00:00.000Z", 0),
        ("1/16/75", "2015-07-25T12:30:00.000Z", -14801),
        ("2/29/00", "1999-03-01T23:59:59.999Z", days(datetime(2000, 2, 29), datetime(1999, 3, 1, 23, 59, 59, 999000))),
        ("soon", "2016-01-16T00:00:00.000Z", None),
        ("5/25/21", "yesterday", None),
        (None, None, None),
    ],
)
def test_days_to_close(spark, close, created, expected):
    df = spark.createDataFrame([(close, created)], "c string, t string")
    assert df.select(days_between(short_date(F.col("c")), created_at(F.col("t")))).first()[0] == expected


def test_zscore_and_scale(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (6,)], "Amount bigint")
    params = FT.scale_params(df).first()
    assert params["mean"] == 3 and abs(params["std"] - 2.160246899469287) < 1e-12
    assert df.select(FT.zscore(F.col("Amount"), 3.0, 2.0)).first()[0] == -1.0
    assert df.select(FT.zscore(F.col("Amount"), 3.0, 0.0)).first()[0] is None


def test_split_is_stable_and_about_ninety_percent(spark):
    ids = spark.range(5000).select(F.col("id").alias("Id"))
    one = {r["Id"] for r in FT.with_split(ids).filter("split = 'train'").collect()}
    two = {r["Id"] for r in FT.with_split(ids.repartition(13)).filter("split = 'train'").collect()}
    assert one == two and 4300 < len(one) < 4700


def test_examples(spark):
    df = spark.createDataFrame([([1, 2], 3)], "x array<int>, y bigint")
    assert FT.examples(df).schema.simpleString() == "struct<x:array<float>,y:float>"
    assert FT.examples(df, label=None).columns == ["x"]
