import json

import pytest
from pyspark.sql import functions as F

from recordflow.operators import shaping as S
from recordflow.schemas import SCORING_RECORD

FULL = {
    "Id": "a", "Type": "New", "StageName": "S", "ForecastCategory": "F", "Amount": 12.9,
    "IsWon": True, "IsClosed": True,
}
SHOWN = ["Id", "OpportunityType", "Stage", "ForecastCategory", "Amount", "IsWon", "IsClosed"]


def event(**changes):
    return json.dumps({"sobject": {**FULL, **changes}})


LENIENT = [
    (event(), ("a", "New", "S", "F", 12, True, True)),
    (event(Amount="x"), ("a", "New", "S", "F", 0, False, False)),
    (event(Type=5), ("a", "no", "no", "no", 0, False, False)),
    (event(IsWon="true"), ("a", "New", "S", "F", 12, False, False)),
    (json.dumps({"sobject": {}}), ("", "", "", "", 0, False, False)),
    (event(**dict.fromkeys(FULL)), ("", "", "", "", 0, False, False)),
    ("{}", ("no", "no", "no", "no", 0, False, False)),
    ('{"sobject":null}', ("no", "no", "no", "no", 0, False, False)),
    ("not json", ("no", "no", "no", "no", 0, False, False)),
    (None, ("no", "no", "no", "no", 0, False, False)),
]


@pytest.mark.parametrize("value, expected", LENIENT)
def test_typed_projection_lenient(texts, value, expected):
    row = S.opportunity_rows(texts(value), mode="lenient").first()
    record = row["record"]
    assert record.__fields__ == SCORING_RECORD.fieldNames()
    assert tuple(record[c] for c in SHOWN) == expected
    assert row["error_message"] is None
    rest = set(SCORING_RECORD.fieldNames()) - set(SHOWN)
    assert {record[c] for c in rest} == {"no"}


def test_typed_projection_strict_reports_the_first_bad_field(texts):
    rows = S.opportunity_rows(texts(event(), event(Type=5, Amount="x"), "x")).collect()
    assert [r["error_message"] for r in rows] == [None, "Type: not string", "sobject: not an object"]


def test_writable_fields(texts, spark):
    keys = ["Id", "AccountId", "Name", "Order__c", "IsWon", "Amount", "StageName", "CreatedDate"]
    assert [k for k in keys if S.writable(k)] == ["Name", "Amount", "StageName"]
    df = spark.createDataFrame([tuple(keys)], keys)
    assert S.writable_columns(df).columns == ["Name", "Amount", "StageName"]
    text = json.dumps({**dict.fromkeys(keys, 1), "Name": "n", "StageName": None})
    out = texts(text).select(S.writable_json(F.parse_json("value")).alias("r")).first()["r"]
    assert json.loads(out) == {"Name": "n", "Amount": "1"}


def test_strip_and_rename(spark):
    df = spark.createDataFrame([("a-b / c", 5, None)], "`a b` string, n int, s string")
    out = S.compact_names(S.strip_text(df))
    assert out.columns == ["ab", "n", "s"]
    assert tuple(out.first()) == ("abc", 5, None)
    assert S.drop_columns(df, ["a b", "absent"]).columns == ["n", "s"]


def test_row_id_is_dense_in_order(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k")).repartition(7)
    rows = S.with_row_id(df, "i", order_by=["k"]).collect()
    assert sorted((r["k"], r["i"]) for r in rows) == [(i, i) for i in range(1000)]


def test_row_id_without_order_is_dense(spark):
    ids = [r["i"] for r in S.with_row_id(spark.range(100, numPartitions=9), "i").collect()]
    assert sorted(ids) == list(range(100))


def test_record_json_leaves_nulls_out(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "a int, b string")
    assert [r[0] for r in df.select(S.record_json(df)).collect()] == ['{"a":1}', "{}"]


def test_anomaly_rows_need_a_label(spark):
    df = spark.createDataFrame([("a", -1), ("b", None)], "Id string, cluster bigint")
    assert [tuple(r) for r in S.anomaly_rows(df).collect()] == [("a", -1)]
