import hashlib
from datetime import datetime, timezone

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from recordflow.schemas import REPORT
from recordflow.sinks import files
from recordflow.sources import batch as B

UTC = timezone.utc


def at(*parts):
    return datetime(*parts, tzinfo=UTC)


@pytest.mark.parametrize(
    "options, expected",
    [
        ({}, (None, None)),
        ({"after": "2024-01-01T00:00:00Z"}, (at(2024, 1, 1), None)),
        ({"before": "2024-01-01T00:00:00Z"}, (None, at(2024, 1, 1))),
        ({"duration": "6 hours"}, (at(2024, 1, 1, 3), at(2024, 1, 1, 9))),
        ({"duration": "6 hours", "offset": "1 hours"}, (at(2024, 1, 1, 2), at(2024, 1, 1, 8))),
        ({"offset": "1 hours"}, (None, at(2024, 1, 1, 8))),
        (
            {"duration": "6 hours", "after": "2024-01-01T05:00:00Z", "before": "2024-01-01T07:00:00Z"},
            (at(2024, 1, 1, 5), at(2024, 1, 1, 7)),
        ),
    ],
)
def test_range_bounds(options, expected):
    assert B.range_bounds(run_at=at(2024, 1, 1, 9), **options) == expected


def test_range_is_half_open(spark):
    df = spark.createDataFrame([(at(2024, 1, d),) for d in (1, 2, 3)], "LastModifiedDate timestamp")
    kept = B.in_range(df, (at(2024, 1, 1), at(2024, 1, 3)))
    assert kept.count() == 2


def test_range_on_schemaless_records(texts):
    df = texts(*['{"LastModifiedDate":"2024-01-0%dT00:00:00Z"}' % d for d in (1, 2, 3)])
    payload = df.select(F.parse_json("value").alias("payload"))
    assert B.in_range(payload, (at(2024, 1, 2), None)).count() == 2


def test_json_extract_fails_on_broken_text(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"a":1}\n{"b":\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        B.read_objects(spark, str(tmp_path)).collect()


def test_typed_extracts_become_records(spark):
    df = spark.createDataFrame([(1, None, "x")], "a int, b string, c string")
    assert B.as_payload(df).select(F.to_json("payload")).first()[0] in ('{"a":1,"b":null,"c":"x"}', '{"a":1,"c":"x"}')


def test_report_csv_keeps_declared_types(spark, tmp_path):
    row = ["n"] * 22
    row[5], row[6], row[10], row[21] = "123", "1", "True", "False"
    row[9], row[11], row[18] = "5/25/21", "2016-01-16T00:00:00.000Z", ""
    (tmp_path / "r.csv").write_text(",".join(REPORT.fieldNames()) + "\n" + ",".join(row) + "\n")
    got = B.read_report(spark, str(tmp_path / "r.csv")).first()
    assert (got["Amount"], got["Closed"], got["Won"]) == (123, True, False)
    assert got["Created Date"] == "2016-01-16T00:00:00.000Z" and got["Product Family"] is None


def test_json_lines_skip_missing_numbers(spark, tmp_path):
    for n in (1, 3):
        (tmp_path / f"part{n}").write_text(f'{{"n":{n}}}\n')
    assert B.read_json_lines(spark, str(tmp_path / "part")).count() == 2


def test_sample_and_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "`k k` int, v string")
    files.write_csv(B.head_sample(df, ["k k"], 2), str(tmp_path / "out"))
    back = spark.read.option("header", True).csv(str(tmp_path / "out"))
    assert sorted(tuple(r) for r in back.collect()) == [("1", "a"), ("2", "b")]


def test_examples_round_trip(spark, tmp_path):
    df = spark.createDataFrame([([1.0], 2.0, "train"), ([3.0], 4.0, "test")], "x array<float>, y float, split string")
    files.write_examples(df, str(tmp_path / "e"))
    assert B.read_examples(spark, str(tmp_path / "e" / "split=train")).collect()[0]["y"] == 2.0


def test_query_names_the_object(spark):
    df = spark.createDataFrame([("1", "n")], "Id string, Name string")
    assert B.query_objects(df, "Thing", "select Name from Thing").first()[0] == "n"


def test_rows_of_one_row_group_are_dealt_out(spark, tmp_path, monkeypatch):
    """The file has enough splits for all cores, but all rows in one row group."""
    path = str(tmp_path / "rows.parquet")
    wide = [{"id": i, "text": hashlib.sha512(str(i).encode()).hexdigest() * 8} for i in range(4000)]
    pq.write_table(pa.Table.from_pylist(wide), path, row_group_size=4000, compression="none", use_dictionary=False)
    monkeypatch.setattr(B, "TASK_ROWS", 300)
    spark.conf.set("spark.sql.files.maxPartitionBytes", 200_000)
    try:
        scan = spark.read.parquet(path)
        assert scan.rdd.getNumPartitions() > 8
        dealt = B.spread(scan.select("id"))
        sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sum(sizes) == 4000 and len(sizes) == 14 and max(sizes) <= 400


def test_even_and_empty_scans_are_left_alone(spark, tmp_path):
    even = spark.range(0, 1000, numPartitions=8)
    assert B.spread(even) is even
    none = spark.range(0)
    assert B.spread(none) is none
