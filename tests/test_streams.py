"""One commit per micro-batch, replay ids as offsets, deliveries and model versions."""

import json
from datetime import date, datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from recordflow.config import ScoringParams, StreamIngestParams
from recordflow.ml import versions
from recordflow.plans import jobs
from recordflow.schemas import ANOMALY_TARGET, DEAD_LETTER, STREAM_TARGET
from recordflow.session import scratch_path
from recordflow.sinks import delivery, tables
from recordflow.sources import batch, replay

DAY = datetime(2024, 1, 1, 12, tzinfo=timezone.utc)


def event(i, replay_id=None, **sobject):
    header = {"replayId": i if replay_id is None else replay_id, "type": "created"}
    return json.dumps({"event": header, "sobject": {"Id": str(i), "Amount": i, **sobject}}, separators=(",", ":"))


@pytest.fixture
def stream(spark, tmp_path, new_table):
    """The parameters of a stream with tables of its own."""
    main, dead = new_table(STREAM_TARGET, True), new_table(DEAD_LETTER, True)

    def make(name="feed", **more):
        return StreamIngestParams(
            object_name="O", login_url="u", push_topic="p", reference_name=name, output_table=main, dead_letter_table=dead,
            checkpoint_location=str(tmp_path / f"position_{name}"), **more,
        )

    return make


def written(spark, params):
    ids = sorted(int(r["Id"]) for r in tables.committed(spark, params.output_table).collect())
    return ids, tables.committed(spark, params.dead_letter).count()


def write(spark, params, writer, number, *lines, stamp=DAY):
    batch = spark.createDataFrame([(v,) for v in lines], "value string")
    jobs.write_ingest_batch(batch, number, params, writer, stamp)


def test_both_writes_become_visible_together(spark, stream, monkeypatch):
    params = stream()
    writer = jobs.batch_writer(spark, params, params.checkpoint_location)
    write(spark, params, writer, 0, event(1), "broken")
    append = tables.BatchWriter.append

    def fails_at_the_second(self, table, *rest):
        if table == params.dead_letter:
            raise OSError("lost")
        append(self, table, *rest)

    monkeypatch.setattr(tables.BatchWriter, "append", fails_at_the_second)
    with pytest.raises(OSError):
        write(spark, params, writer, 1, event(2), "also broken")
    assert written(spark, params) == ([1], 1)
    assert spark.table(params.output_table).count() == 2  # the row is there, but no batch has it
    monkeypatch.undo()
    again = jobs.batch_writer(spark, params, params.checkpoint_location)
    write(spark, params, again, 1, event(2), "also broken")
    assert written(spark, params) == ([1, 2], 2)
    # Handed over once more after a restart, a committed batch changes nothing.
    again = jobs.batch_writer(spark, params, params.checkpoint_location)
    write(spark, params, again, 1, event(2), event(3), "x")
    write(spark, params, again, 2, event(4))
    assert written(spark, params) == ([1, 2, 4], 2)


def test_days_are_compacted(spark, stream):
    one, two = stream("one"), stream("two")
    writers = {p.reference_name: jobs.batch_writer(spark, p, p.checkpoint_location) for p in (one, two)}
    for n in range(3, 6):
        write(spark, one, writers["one"], n, event(n), *(["bad"] if n % 2 else []))
    write(spark, two, writers["two"], 0, event(100), "bad")
    before = written(spark, one)
    assert before == ([3, 4, 5, 100], 3)
    assert spark.sql(f"SHOW PARTITIONS {one.output_table}").count() == 2  # a day of two feeds
    assert writers["one"].compact(date(2024, 1, 1)) == 3 and written(spark, one) == before
    write(spark, one, writers["one"], 6, event(6))
    assert written(spark, one) == (sorted([*before[0], 6]), 3)
    feed = f"_feed = '{writers['one'].feed}'"

    def files(table):
        spark.catalog.refreshTable(table)
        return spark.table(table).filter(feed).select(F.col("_metadata.file_path")).distinct().count()

    assert files(one.output_table) == 5
    assert writers["one"].clean(date(2024, 1, 1)) == 3 + 2 + 3
    assert written(spark, one) == (sorted([*before[0], 6]), 3) and files(one.output_table) == 2
    # The writer that comes after knows what was committed, and compacts again.
    late = jobs.batch_writer(spark, one, one.checkpoint_location)
    write(spark, one, late, 5, event(55))
    write(spark, one, late, 7, event(7), stamp=datetime(2024, 1, 2, tzinfo=timezone.utc))
    assert late.compact(date(2024, 1, 1)) == 2 and late.clean(date(2024, 1, 1)) > 0
    assert late.compact(date(2024, 1, 3)) == 0 and late.clean(date(2024, 1, 3)) == 0
    assert written(spark, one)[0] == [3, 4, 5, 6, 7, 100]


def test_tables_of_a_stream_share_a_ledger(spark, stream, new_table, tmp_path):
    params = stream()
    tables.create_table(spark, "apart_dead", DEAD_LETTER, streaming=True, location=str(tmp_path / "apart"), ledger="apart_batches")
    with pytest.raises(ValueError, match="share a ledger"):
        tables.BatchWriter(spark, [params.output_table, "apart_dead"], "f")
    with pytest.raises(ValueError, match="no ledger"):
        tables.committed(spark, new_table(STREAM_TARGET))


def test_replay_ids_are_the_offsets(spark, stream, tmp_path, texts):
    log = str(tmp_path / "log")
    params = stream(input_path=log, input_format="replay")

    def land(*lines):
        return replay.land(texts(*lines), log, width=10)

    def drain():
        jobs.ingest_stream(spark, params, changes=replay.read_replay(spark, log, width=10), drain=True).awaitTermination()
        return written(spark, params)

    assert land(event(3), event(7), event(7), event(25), "no json", event(40, replay_id="forty")) == 1
    assert drain() == ([3, 7, 25, 40], 1)
    # Repeated ids, a gap, an event without an id, and nothing at all.
    assert land(event(7), event(25), event(26), event(90), event(90), "more of it") == 2
    assert drain() == ([3, 7, 25, 26, 40, 90], 2)
    assert drain() == ([3, 7, 25, 26, 40, 90], 2)
    offsets = sorted((tmp_path / "position_feed" / "offsets").glob("[0-9]*"), key=lambda p: int(p.name))
    assert json.loads(offsets[-1].read_text().splitlines()[-1]) == {"replayId": 91, "landing": 2}


def test_replay_from_an_offset_in_bounded_batches(spark, stream, tmp_path, texts):
    log = str(tmp_path / "log")
    replay.land(texts(*[event(i) for i in range(1, 61)]), log)
    params = stream(input_path=log, input_format="replay", start_offset=21, max_ids_per_trigger=15)
    query = jobs.ingest_stream(spark, params)
    try:
        query.processAllAvailable()
        assert written(spark, params) == (list(range(21, 61)), 0)
        assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [15, 15, 10]
    finally:
        query.stop()


def test_an_empty_log_has_no_events(spark, stream, tmp_path):
    params = stream(input_path=str(tmp_path / "none"), input_format="replay")
    jobs.ingest_stream(spark, params, drain=True).awaitTermination()
    assert written(spark, params) == ([], 0)


def test_a_lost_task_sends_nothing_twice(spark, tmp_path, texts):
    class Lost(BaseException):
        """Ends the task, unlike an error of the receiver."""

    folder, got = str(tmp_path / "ledger"), tmp_path / "got"
    records = delivery.keyed(texts(*[f"r{i}" for i in range(40)], "twin", "twin"))

    def sender(lost_after):
        taken = []

        def send(record):
            if record == "r7":
                raise ValueError("refused")
            if len(taken) == lost_after:
                raise Lost
            taken.append(record)
            with open(got, "a") as f:
                f.write(record + "\n")

        return send

    options = {"senders": 3, "records_per_pause": 100, "pause": 0.0}
    with pytest.raises(Exception, match="Lost"):
        delivery.deliver(records, sender(6), folder, **options)
    assert 6 <= len(got.read_text().split()) <= 18
    failed = delivery.deliver(records, sender(None), folder, **options).collect()
    assert [(r.value, r.error_message) for r in failed] == [("r7", "ValueError: refused")]
    want = sorted([f"r{i}" for i in range(40) if i != 7] + ["twin"] * 2)
    assert sorted(got.read_text().split()) == want
    # A third run has the refused record left, and new ones.
    more = records.union(delivery.keyed(texts("new")))
    assert delivery.deliver(more, sender(None), folder, **options).count() == 1
    assert sorted(got.read_text().split()) == sorted([*want, "new"])
    assert not (tmp_path / "ledger" / "marks").exists()


def test_deliveries_are_throttled(spark, tmp_path, texts):
    paused = tmp_path / "paused"

    def sleep(seconds):
        with open(paused, "a") as f:
            f.write(f"{seconds}\n")

    records = delivery.keyed(texts(*"abcdefghijkl"))
    assert delivery.deliver(records, lambda r: None, str(tmp_path / "l"), sleep=sleep).count() == 0
    assert paused.read_text().split() == ["10.0", "10.0"]
    assert delivery.deliver(records.limit(0), lambda r: None, str(tmp_path / "m")).count() == 0


class Labels:
    """A model that gives every record one label; saved as such a number."""

    def __init__(self, spark, label):
        self.index, self.label = spark.range(1), label

    def save(self, path):
        self.index.select(F.lit(self.label).alias("label")).write.parquet(path)

    @classmethod
    def load(cls, spark, path, *_):
        return cls(spark, spark.read.parquet(path).first()["label"])

    def score(self, records, id_name="Id"):
        return records.select("Id", F.lit(self.label).alias("cluster"))


def test_a_new_model_version_takes_over(spark, tmp_path, new_table, monkeypatch):
    monkeypatch.setattr(versions, "AnomalyModel", Labels)
    main, dead = new_table(ANOMALY_TARGET, True), new_table(DEAD_LETTER, True)
    folder, landed = str(tmp_path / "models"), tmp_path / "in"
    landed.mkdir()
    params = ScoringParams(
        object_name="O", login_url="u", push_topic="p", reference_name="labels", output_table=main, dead_letter_table=dead,
        input_path=str(landed), checkpoint_location=str(tmp_path / "position"), model_uri=folder,
    )
    with pytest.raises(Exception):
        jobs.label_stream(spark, params)  # no model yet
    query = None
    try:
        for n, label in ((1, 10), (2, 20)):
            assert versions.publish(Labels(spark, label), folder) == n
            (landed / str(n)).write_text(event(n) + "\nbroken\n")
            query = query or jobs.label_stream(spark, params)
            query.processAllAvailable()
    finally:
        query.stop()
    rows = tables.committed(spark, main).collect()
    assert sorted((r["opportunityId"], r["anomalyCluster"]) for r in rows) == [("1", 10), ("2", 20)]
    assert tables.committed(spark, dead).count() == 2


def test_numbered_files(spark, tmp_path):
    files = {
        "rec1.json": '{"a":1}\n{"a":2}\n', "rec2.json": '{"a":3}\n{"a":', "rec2.json.bak": '{"a":9}\n', "rec5.json": "",
        "rec10.json": "[1]\n", "record4.json": '{"a":9}\n', "recx.json": '{"a":9}\n',
    }
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    records, manifest = batch.read_numbered(spark, str(tmp_path / "rec"))
    got = sorted((r.number, r.value, r.error_message) for r in records.drop("payload").collect())
    assert got == [
        (1, '{"a":1}', None), (1, '{"a":2}', None), (2, '{"a":', 'not a JSON object: {"a":'), (2, '{"a":3}', None),
        (10, "[1]", "not a JSON object: [1]"),
    ]
    rows = {r.number: (r.status, r.records, r.corrupt_records) for r in manifest.collect()}
    missing = {n: ("missing", 0, 0) for n in (3, 4, 6, 7, 8, 9)}
    assert rows == {1: ("read", 2, 0), 2: ("corrupt", 2, 1), 5: ("read", 0, 0), 10: ("corrupt", 1, 1), **missing}
    assert batch.read_numbered(spark, str(tmp_path / "rec"), last=12)[1].count() == 12


def test_a_ledger_left_by_an_earlier_catalog_is_taken_up(spark, tmp_path):
    spark.sql(f"CREATE DATABASE again LOCATION '{tmp_path / 'again'}'")
    home, name = str(tmp_path / "again" / "stream_batches"), "again.stream_batches"
    tables.create_table(spark, "again.first", DEAD_LETTER, streaming=True, ledger=name, ledger_location=home)
    tables.BatchWriter(spark, ["again.first"], "feed").write(3, {}, DAY)
    spark.sql(f"DROP TABLE {name}")  # the folder stays, as after a session whose catalog is lost
    tables.create_table(spark, "again.second", DEAD_LETTER, streaming=True)
    writer = tables.BatchWriter(spark, ["again.second"], "feed")
    assert writer.is_committed(3) and not writer.is_committed(4)


def test_query_streams_have_a_ledger_of_their_own(spark):
    from recordflow.plans import queries

    pairs = [queries._stream_tables(spark) for _ in range(2)]
    ledgers = [{tables.ledger_of(spark, t) for t in pair} for pair in pairs]
    assert all(len(found) == 1 for found in ledgers) and ledgers[0] != ledgers[1]
    assert all(not tables.location_of(spark, found.pop()).endswith("stream_batches") for found in ledgers)


def test_rows_of_one_split_of_a_batch_are_dealt_out(spark, stream, monkeypatch):
    params = stream()
    writer = jobs.batch_writer(spark, params, params.checkpoint_location)
    lines = [event(i) for i in range(400)] + ["broken"]
    monkeypatch.setattr(batch, "TASK_ROWS", 100)
    rows = spark.createDataFrame([(v,) for v in lines], "value string").coalesce(1)
    jobs.write_ingest_batch(rows, 0, params, writer, DAY)
    files = [f for f in spark.table(params.output_table).inputFiles() if f.endswith(".parquet")]
    assert len(files) > 1 and written(spark, params) == (list(range(400)), 1)


def test_the_receiver_of_write_back_keeps_few_files(spark, small, monkeypatch):
    from recordflow.plans import queries

    folders = []
    monkeypatch.setattr(queries, "scratch_path", lambda s, label: folders.append(scratch_path(s, label)) or folders[-1])
    rows = queries.write_back(spark, small).cache()
    assert rows.filter("times <> 1 and error_message is null").isEmpty()
    folder = next(f for f in folders if "/write_back-" in f)
    taken = list(Path(folder.removeprefix("file:")).glob("taken/*"))
    assert 1 <= len(taken) <= 8 < rows.count()
