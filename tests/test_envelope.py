import pytest
from pyspark.sql import functions as F

from recordflow.operators import envelope as E


@pytest.mark.parametrize(
    "value, offset",
    [
        ('{"event":{"replayId":7}}', 7),
        ('{"event":{"replayId":5.7}}', 5),
        ('{"event":{"replayId":-5.7}}', -5),
        ('{"event":{"replayId":1e3}}', 1000),
        ('{"event":{"replayId":1e300}}', 2**63 - 1),
        ('{"event":{"replayId":"8"}}', 0),
        ('{"event":{"replayId":null}}', 0),
        ('{"event":{"replayId":true}}', 0),
        ('{"event":{}}', 0),
        ('{"event":[1]}', 0),
        ('{"sobject":{"Id":"d"}}', 0),
        ("not json", 0),
        ("", 0),
        (None, 0),
    ],
)
def test_replay_offset(texts, value, offset):
    assert E.with_replay_offset(texts(value)).first()["replay_id"] == offset


@pytest.mark.parametrize(
    "value, expected",
    [
        ('{"event":{"replayId":1},"sobject":{"Id":"a"}}', '{"Id":"a"}'),
        ('{"sobject":{"Id":"f"},"event":{"replayId":9}}', '{"Id":"f"}'),
        ('{"Id":"e"}', '{"Id":"e"}'),
        (
            '{"sobject": {"Id":"g","note":"has \\"sobject\\": inside"}}',
            '{"Id":"g","note":"has \\"sobject\\": inside"}',
        ),
        ('{"a":1} trailing', '{"a":1}'),
    ],
)
def test_good_route(texts, value, expected):
    row = E.route_events(texts(value)).select("error_message", F.to_json("payload").alias("p")).first()
    assert row["error_message"] is None
    assert row["p"] == expected


@pytest.mark.parametrize(
    "value, start",
    [
        ("not json", "invalid JSON: not json"),
        ("", "invalid JSON: "),
        (None, "invalid JSON: "),
        ("[1,2]", "not an object"),
        ("null", "not an object"),
        ("5", "not an object"),
        ('{"sobject":null}', "not an object"),
        ('{"sobject":{"Id":"d","Amount":1,"Amount":2}}', "invalid JSON: "),
    ],
)
def test_failed_route(texts, value, start):
    routed = E.route_events(texts(value))
    assert routed.first()["error_message"].startswith(start)
    assert E.good(routed).count() == 0
    assert E.failed(routed).first()["value"] == value


def test_routing_keeps_every_event(texts):
    values = ['{"a":1}', "x", "", None, "[]", '{"sobject":{}}'] * 7
    routed = E.route_events(texts(*values))
    assert E.good(routed).count() + E.failed(routed).count() == len(values)


def test_start_offset_is_inclusive_and_keeps_broken_events(texts):
    df = E.with_replay_offset(texts(*['{"event":{"replayId":%d}}' % i for i in (4, 5, 6)], "broken"))
    assert sorted(r["replay_id"] for r in E.from_offset(df, 5).collect()) == [0, 5, 6]
    assert E.from_offset(df, None).count() == 4


def test_subscription_keeps_known_kinds_and_events_without_kind(texts):
    df = E.parse_events(
        texts(*['{"event":{"type":"%s"}}' % k for k in ("created", "updated", "deleted", "undeleted")], "{}", "x")
    )
    kept = {r["value"] for r in E.subscribed(df).collect()}
    assert len(kept) == 5 and not any("undeleted" in v for v in kept)


def test_dead_letter_rows(spark):
    df = spark.createDataFrame(
        [("é", "bad"), (None, "worse")], "value string, error_message string"
    ).withColumn("ingest_ts", F.lit("2024-01-01 00:00:01.5").cast("timestamp"))
    rows = {r["errorMessage"]: r for r in E.dead_letters(df).collect()}
    assert bytes(rows["bad"]["payloadBytes"]) == "é".encode()
    assert rows["worse"]["payloadString"] is None and rows["worse"]["payloadBytes"] is None
    assert rows["bad"]["attributes"] == [] and rows["bad"]["stacktrace"] is None
    text = E.dead_letters(df).select(E.stamp_text(F.col("timestamp")).alias("t")).first()["t"]
    assert text == "2024-01-01 00:00:01.500000"


def test_flatten_is_a_bag_union(texts):
    assert E.flatten(texts("a"), texts("a", "b"), texts("c")).count() == 4


def test_json_is_parsed_once(texts):
    plan = E.good(E.route_events(texts('{"a":1}')))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") + plan.count("parse_json") == 1
