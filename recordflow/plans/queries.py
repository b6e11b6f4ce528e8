"""Registered queries: every operator on whole tables."""

from __future__ import annotations

import os
import uuid
from datetime import datetime, timezone

from pyspark import TaskContext
from pyspark.errors import PySparkException
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from recordflow import schemas
from recordflow.config import BatchIngestParams, ScoringParams, StreamIngestParams, TextExportParams
from recordflow.functions.columns import name
from recordflow.functions.dates import created_at, short_date
from recordflow.functions.variants import is_object
from recordflow.ml import anomaly, density, hierarchy, regression, versions
from recordflow.ml.inference import batch_predictor, linear_model
from recordflow.operators import conform as C
from recordflow.operators import envelope as E
from recordflow.operators import features as FT
from recordflow.operators import shaping as S
from recordflow.operators.lookups import saved
from recordflow.plans import jobs, views
from recordflow.schemas import render
from recordflow.session import scratch_path
from recordflow.sinks import files, tables
from recordflow.sources import batch as B, replay
from recordflow.sources.folders import opened

LINEAR_WEIGHTS = [float(i % 7 - 3) for i in range(64)]


def _events(spark: SparkSession, sf: str) -> DataFrame:
    events = views.table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type")
    return views.messages(spark, B.spread(events))


def _joined(array: str, out: str):
    return F.array_join(name(array).cast("array<string>"), ",").alias(out)


def scan_range(spark, sf):
    """Half-open range on the modification time; both bounds reach the scan."""
    orders = views.table(spark, sf, "orders")
    bounds = B.range_bounds(after="1995-01-01T00:00:00Z", before="1996-07-01T00:00:00Z")
    return B.in_range(orders, bounds, "o_orderdate").select("o_orderkey", "o_totalprice", "o_orderdate")


def scan_window(spark, sf):
    """Window of a given length that ends some time before the run."""
    orders = views.table(spark, sf, "orders")
    bounds = B.range_bounds(
        duration="400 days, 12 hours",
        offset="1 days, 6 hours",
        run_at=datetime(1998, 1, 1, tzinfo=timezone.utc),
    )
    return B.in_range(orders, bounds, "o_orderdate").select("o_orderkey", "o_orderdate")


def sql_scan(spark, sf):
    query = "select Id, Amount, Stage from Opportunity where IsWon and Amount > 100000"
    return B.query_objects(views.scoring_records(spark, sf), "Opportunity", query)


def replay_offset(spark, sf):
    return E.with_replay_offset(_events(spark, sf)).select("event_id", "replay_id")


def start_offset(spark, sf):
    events = E.with_replay_offset(_events(spark, sf))
    return E.from_offset(events, 100).select("event_id", "replay_id")


def change_kind(spark, sf):
    return E.subscribed(E.parse_events(_events(spark, sf))).select("event_id")


def extract_payload(spark, sf):
    parsed = E.parse_events(_events(spark, sf))
    record = parsed.select("event_id", E.payload(F.col("doc")).alias("payload"))

    def member(path: str, alias: str):
        return F.try_variant_get("payload", path, "string").alias(alias)

    return record.select(
        "event_id",
        member("$.Id", "id"),
        member("$.OwnerId", "owner"),
        member("$.Type", "type"),
        member("$.StageName", "stage"),
        member("$.Amount", "amount"),
        member("$.Fiscal.Quarter", "quarter"),
        F.coalesce(is_object(F.variant_get("payload", "$.event", "variant")), F.lit(False)).alias("has_event"),
    )


def route_messages(spark, sf):
    routed = E.route_events(_events(spark, sf))
    return routed.select(
        "event_id",
        F.when(F.col("error_message").isNull(), "good").otherwise("failed").alias("route"),
        "error_message",
        F.when(F.col("error_message").isNull(), F.try_variant_get("payload", "$.Id", "string")).alias("id"),
    )


def dead_letter_rows(spark, sf):
    failures = E.failed(E.route_events(_events(spark, sf)))
    rows = E.dead_letters(failures, stamped="ts")
    return rows.select(
        E.stamp_text(F.col("timestamp")).alias("stamp"),
        F.col("payloadString").alias("payload_string"),
        F.hex("payloadBytes").alias("payload_hex"),
        F.size("attributes").alias("n_attributes"),
        F.col("errorMessage").alias("error_message"),
        "stacktrace",
    )


def _checked(spark, sf, unknown):
    return C.conform(E.good(E.route_events(_events(spark, sf))), schemas.STREAM_TARGET, unknown=unknown)


def _every_column(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """All columns of a target; objects as JSON, times as text."""
    def column(f: T.StructField):
        if isinstance(f.dataType, T.StructType):
            return F.to_json(name(f.name)).alias(f.name)
        if isinstance(f.dataType, T.TimestampType):
            return F.date_format(name(f.name), "yyyy-MM-dd HH:mm:ss").alias(f.name)
        return name(f.name)

    return rows.select(*map(column, schema.fields))


def conform_ignore(spark, sf):
    return _every_column(C.conforming(_checked(spark, sf, "ignore")), schemas.STREAM_TARGET)


def conform_reject(spark, sf):
    return C.rejected(_checked(spark, sf, "reject")).select("event_id", "error_message")


def union_errors(spark, sf):
    routed = E.route_events(_events(spark, sf))
    checked = C.conform(E.good(routed), schemas.STREAM_TARGET)
    both = [E.failed(routed), C.rejected(checked)]
    return E.flatten(*[f.select("event_id", "error_message") for f in both])


def batch_append(spark, sf):
    """Conform typed records, append them to an existing table and read it back."""
    records = views.opportunity(spark, sf).select(
        "Id", "Amount", F.col("Stage").alias("StageName"), "IsWon", "IsClosed", "CreatedDate",
        F.col("ProductFamily").alias("Name"),
    )
    table = _new_table(spark, "batch", schemas.BATCH_TARGET)
    tables.append_rows(C.conform_or_fail(B.as_payload(records), schemas.BATCH_TARGET), table)
    return _every_column(spark.table(table), schemas.BATCH_TARGET)


def batch_job(spark, sf):
    """Ingest a JSON extract with a range and the user's SQL, and read the table back."""
    records = views.opportunity(spark, sf).select(
        "Id", "Amount", F.col("Stage").alias("StageName"), "IsWon",
        F.date_format("CreatedDate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("LastModifiedDate"),
    )
    landed = scratch_path(spark, "extract")
    records.select(S.record_json(records).alias("value")).write.text(landed)
    table = _new_table(spark, "batch_job", schemas.BATCH_TARGET)
    params = BatchIngestParams(
        object_name="Opportunity", reference_name="batch", login_url="none", output_table=table, input_path=landed,
        datetime_after="1994-01-01T00:00:00Z", datetime_before="1997-01-01T00:00:00Z",
        query="select Id, StageName, Amount, IsWon as IsClosed from Opportunity where Amount > 50000",
    )
    jobs.ingest_batch(spark, params)
    return spark.table(table).select("Id", "StageName", "Amount", "IsClosed", "IsWon")


def json_lines_scan(spark, sf):
    """Numbered files with a gap, a backup and cut lines: all records, and the manifest."""
    customer = views.table(spark, sf, "customer")
    line = F.to_json(F.struct(F.col("c_custkey").alias("Id"), F.col("c_name").alias("Name")))
    cut = F.when(F.col("c_custkey") % 50 == 3, F.substring(line, 1, 10)).otherwise(line).alias("value")
    prefix = scratch_path(spark, "lines") + "/rec"
    for rest, number in enumerate((1, 2, 4, 5, 6)):
        customer.filter(F.col("c_custkey") % 5 == rest).select(cut).write.text(f"{prefix}{number}.json")
    customer.filter("c_custkey % 5 = 1").select(cut).write.text(f"{prefix}2.json.bak")
    records, manifest = B.read_numbered(spark, prefix)
    none = F.lit(None).cast("string")
    return records.select(
        "number", F.lit("record").alias("kind"), F.try_variant_get("payload", "$.Name", "string").alias("name"),
        F.col("error_message").alias("status"), F.lit(1).cast("long").alias("records"),
    ).union(manifest.select("number", F.lit("file"), none, "status", F.col("records") * 1000 + F.col("corrupt_records")))


def conform_types(spark, sf):
    """Numbers out of their field's width, dates that do not exist, misfits inside arrays."""
    orders = B.spread(views.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"))
    day = F.when(F.col("o_orderkey") % 7 == 0, "1995-02-30").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    payload = F.to_variant_object(
        F.struct(
            (F.col("o_orderkey") * 1_000_003).alias("n"),
            day.alias("d"),
            F.col("o_totalprice").cast("decimal(12,2)").alias("e"),
            F.array(F.col("o_orderkey") % 200, F.col("o_custkey") * 10).alias("tags"),
        )
    )
    schema = T._parse_datatype_string("n int, d date, e decimal(7,2), tags array<smallint>")
    checked = C.conform(orders.select("o_orderkey", payload.alias("payload")), schema)
    return checked.select(
        "o_orderkey",
        F.array_join("violations", "; ").alias("violations"),
        F.when(F.size("violations") == 0, F.col("row.n")).alias("n"),
        F.when(F.size("violations") == 0, F.col("row.d").cast("string")).alias("d"),
        F.when(F.size("violations") == 0, (F.col("row.e") * 100).cast("long")).alias("cents"),
        F.when(F.size("violations") == 0, F.array_join(F.col("row.tags").cast("array<string>"), ",")).alias("tags"),
    )


def _new_table(spark, label, schema, ledger=None):
    path = scratch_path(spark, label)
    table = "rf_" + path.rsplit("-", 1)[1]
    own = {"streaming": True, "ledger": "rf_" + ledger.rsplit("-", 1)[1], "ledger_location": ledger} if ledger else {}
    tables.create_table(spark, table, schema, location=path, **own)
    return table


def _drained(spark, sf):
    """Run the streaming ingest over the events table until it is drained."""
    main, dead = _stream_tables(spark)
    params = StreamIngestParams(
        object_name="Opportunity", reference_name=f"ingest_{main}", login_url="none",
        push_topic="opportunities", output_table=main, dead_letter_table=dead,
    )
    jobs.ingest_stream(spark, params, changes=_event_stream(spark, sf), drain=True).awaitTermination()
    return main, dead


def _event_stream(spark, sf):
    table_schema = views.table(spark, sf, "events").schema
    events = spark.readStream.schema(table_schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    return views.messages(spark, events)


def stream_ingest(spark, sf):
    main, _ = _drained(spark, sf)
    return _every_column(tables.committed(spark, main), schemas.STREAM_TARGET)


def _stream_tables(spark, schema=schemas.STREAM_TARGET):
    ledger = scratch_path(spark, "ledger")
    main = _new_table(spark, "stream", schema, ledger)
    return main, _new_table(spark, "dead", schemas.DEAD_LETTER, ledger)


def _both(spark, main, dead):
    """The ids of the rows and the errors of the dead letters."""
    rows = tables.committed(spark, main).select(F.col("Id").alias("id"), F.lit(None).cast("string").alias("error_message"))
    return rows.union(tables.committed(spark, dead).select(F.lit(None), "errorMessage"))


def stream_two_feeds(spark, sf):
    """Two feeds into one table and one dead letter, and then a batch of the first once more."""
    main, dead = _stream_tables(spark)

    def half(events, n):
        return events.filter(F.pmod(F.xxhash64("value"), F.lit(2)) == n)

    for n in (1, 0):
        params = StreamIngestParams(
            object_name="Opportunity", reference_name=f"feed{n}_{main}", login_url="none",
            push_topic="opportunities", output_table=main, dead_letter_table=dead,
            checkpoint_location=scratch_path(spark, f"feed{n}"),
        )
        jobs.ingest_stream(spark, params, changes=half(_event_stream(spark, sf), n), drain=True).awaitTermination()
    again = half(views.messages(spark, views.table(spark, sf, "events")), 0)
    writer = jobs.batch_writer(spark, params, params.checkpoint_location)
    jobs.write_ingest_batch(again, 0, params, writer, datetime.now(timezone.utc))
    return _both(spark, main, dead)


def stream_replay(spark, sf):
    """A log of replay ids in two landings, the second one with ids that were landed before; the stream stops in
    between and goes on at the id that it had reached."""
    main, dead = _stream_tables(spark)
    events = saved(E.with_replay_offset(_events(spark, sf)).select("event_id", "replay_id", "value"), "events")
    middle = events.agg(F.percentile_approx("event_id", 0.5)).first()[0]
    log = scratch_path(spark, "replay")
    params = StreamIngestParams(
        object_name="Opportunity", reference_name=f"replay_{main}", login_url="none", push_topic="opportunities",
        output_table=main, dead_letter_table=dead, checkpoint_location=scratch_path(spark, "replay_position"),
        input_path=log, input_format="replay", max_ids_per_trigger=max(middle // 2, 1),
    )
    for part in (F.col("event_id") <= middle, F.col("event_id") > middle):
        repeated = events.filter((F.col("event_id") <= middle) & (F.col("replay_id") > 0))
        replay.land(events.filter(part).select("value").union(repeated.select("value")), log)
        query = jobs.ingest_stream(spark, params)
        try:
            query.processAllAvailable()
        finally:
            query.stop()
    return _both(spark, main, dead)


def stream_labels(spark, sf):
    """Fit and publish an anomaly model, label events from a stream, and publish a second one on the way: the
    label of each event against batch scoring by the version of its time."""
    main, dead = _stream_tables(spark, schemas.ANOMALY_TARGET)
    records = views.scoring_records(spark, sf)
    folder, landed = scratch_path(spark, "models"), scratch_path(spark, "landed")
    events = views.messages(spark, views.table(spark, sf, "events"))
    parts = [events.filter(F.col("event_id") % 2 == n) for n in (0, 1)]
    models = [anomaly.fit(records), anomaly.fit(records, dims=2)]
    params = ScoringParams(
        object_name="Opportunity", reference_name=f"labels_{main}", login_url="none", push_topic="opportunities",
        output_table=main, dead_letter_table=dead, checkpoint_location=scratch_path(spark, "labels_position"),
        input_path=f"{landed}/*", model_uri=folder,
    )
    query, expected = None, []
    try:
        for n, (part, model) in enumerate(zip(parts, models)):
            versions.publish(model, folder)
            part.select("value").write.text(f"{landed}/{n}")
            query = query or jobs.label_stream(spark, params)
            query.processAllAvailable()
            typed = S.opportunity_rows(jobs.selected_changes(part.select("value"), params), mode="strict")
            scored = model.score(typed.filter("error_message is null").select("record.*"))
            expected.append(scored.select(F.col("Id").alias("id"), "cluster"))
    finally:
        if query is not None:
            query.stop()
    rows = tables.committed(spark, main).select(F.col("opportunityId").alias("id"), "anomalyCluster")
    met = rows.join(expected[0].union(expected[1]), "id", "full")
    same = F.coalesce(F.col("anomalyCluster") == F.col("cluster"), F.lit(False))
    return met.select("id", F.lit(None).cast("string").alias("error_message"), same.alias("as_batch")).union(
        tables.committed(spark, dead).select(F.lit(None), "errorMessage", F.lit(None))
    )


class _TaskLost(BaseException):
    """Not an error of the receiver: it ends the task."""


def write_back(spark, sf):
    """Send customers to a receiver that records them; the first run breaks off, the second one goes on."""
    customer = views.table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("Id"), F.col("c_name").alias("Name"),
        F.col("c_mktsegment").alias("Segment"), F.col("c_nationkey").alias("Nation__c"),
    )
    folder = scratch_path(spark, "write_back")
    customer.select(S.record_json(customer).alias("value")).write.text(f"{folder}/rec1")
    system, root = opened(folder)
    system.create_dir(f"{root}/taken")
    dead = _new_table(spark, "unsent", schemas.DEAD_LETTER)

    def receiver(breaks: bool):
        taken, book = [], f"{root}/taken/{uuid.uuid4().hex}"

        def send(record: str) -> None:
            if '7","Segment' in record:
                raise ValueError("refused")
            if breaks and len(taken) == 20:
                raise _TaskLost
            taken.append(record)
            with system.open_append_stream(f"{book}-{os.getpid()}-{TaskContext.get().taskAttemptId()}") as out:
                out.write(record.encode() + b"\n")

        return send

    for breaks in (True, False):
        try:
            jobs.write_back(
                spark, f"{folder}/rec", receiver(breaks), dead_letter_table=dead, ledger=f"{folder}/ledger",
                senders=4, records_per_pause=1000, pause=0.0,
            )
        except PySparkException:
            if not breaks:
                raise
    received = spark.read.text(f"{folder}/taken").groupBy("value").agg(F.count(F.lit(1)).alias("times"))
    unsent = spark.table(dead).select(F.col("payloadString"), F.lit(0).cast("long"), "errorMessage")
    return received.select("value", "times", F.lit(None).cast("string").alias("error_message")).union(unsent)


def stream_dead_letters(spark, sf):
    _, dead = _drained(spark, sf)
    return tables.committed(spark, dead).select(
        F.col("errorMessage").alias("error_message"),
        F.col("payloadString").alias("payload"),
        (F.col("payloadBytes") == F.encode("payloadString", "UTF-8")).alias("same_bytes"),
    )


def stream_text(spark, sf):
    out = scratch_path(spark, "text")
    params = TextExportParams(
        object_name="Opportunity", reference_name="text_" + out.rsplit("-", 1)[1], login_url="none",
        push_topic="opportunities", output_prefix=out,
    )
    jobs.export_text(spark, params, changes=_event_stream(spark, sf), drain=True).awaitTermination()
    return spark.read.text(out)


def _typed(spark, sf, mode):
    rows = S.opportunity_rows(_events(spark, sf), mode=mode)
    return rows.select("event_id", "error_message", "record.*")


def typed_projection_lenient(spark, sf):
    return _typed(spark, sf, "lenient").drop("error_message")


def typed_projection_strict(spark, sf):
    return _typed(spark, sf, "strict").select("event_id", "error_message", "Id", "Amount")


def drop_columns(spark, sf):
    shaped = S.drop_columns(views.report(spark, sf), FT.ANOMALY_DROPS)
    return shaped.select(F.array_join(F.array(*[F.lit(c) for c in sorted(shaped.columns)]), "|").alias("kept"), *[
        name(c).alias(c.lower().replace(" ", "_")) for c in ("Id", "Account Type", "Amount", "Stage")
    ])


def strip_text(spark, sf):
    shaped = S.strip_text(views.report(spark, sf))
    return shaped.select(
        "Id",
        name("Opportunity Type").alias("opportunity_type"),
        name("Opportunity Source").alias("opportunity_source"),
        name("Created Date").alias("created"),
        name("Stage").alias("stage"),
        name("Amount").alias("amount"),
    )


def rename_columns(spark, sf):
    shaped = S.compact_names(views.report(spark, sf))
    return shaped.select("Id", "OpportunityName", "AccountType", "CloseDate", "BillingState/Province")


def row_id(spark, sf):
    orders = views.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return S.with_row_id(orders, "row_id", order_by=["o_orderkey"])


def record_to_json(spark, sf):
    orders = views.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    return orders.select("o_orderkey", S.record_json(orders).alias("record"))


def restricted_fields(spark, sf):
    records = E.good(E.route_events(_events(spark, sf)))
    return records.select("event_id", S.writable_json(F.col("payload")).alias("record"))


def hash_features(spark, sf):
    records = views.scoring_records(spark, sf)
    hashed = FT.hash_features(records, FT.hashed_fields(records, ("Id", "Amount")))
    return hashed.select("Id", _joined("x", "x"))


def zscore(spark, sf):
    scaled = FT.zscore(F.col("Amount"), FT.PUBLISHED_AMOUNT_MEAN, FT.PUBLISHED_AMOUNT_STD)
    return views.scoring_records(spark, sf).select("Id", F.round(scaled, 9).alias("amount_z"))


def scale_params(spark, sf):
    params = FT.scale_params(views.table(spark, sf, "orders"), "o_totalprice")
    return params.select(F.round("mean", 3).alias("mean"), F.round("std", 3).alias("std"))


def parse_dates(spark, sf):
    return views.report(spark, sf).select(
        "Id",
        F.date_format(created_at(name("Created Date")), "yyyy-MM-dd HH:mm:ss").alias("created"),
        short_date(name("Close Date")).cast("string").alias("closed"),
    )


def days_to_close(spark, sf):
    records = S.compact_names(views.report(spark, sf))
    return FT.days_to_close(records, "days").select("Id", "days")


def regression_features(spark, sf):
    return FT.regression_features(views.report(spark, sf)).select("Id", _joined("x", "x"), "y")


def anomaly_features(spark, sf):
    features = FT.anomaly_report_features(
        views.report(spark, sf), FT.PUBLISHED_AMOUNT_MEAN, FT.PUBLISHED_AMOUNT_STD
    )
    return features.select("Id", _joined("x", "x"), F.round("amount_z", 9).alias("amount_z"))


def examples(spark, sf):
    """Labelled examples, written per split and read back."""
    features = FT.with_split(FT.regression_features(views.report(spark, sf)).filter("y is not null"))
    path = scratch_path(spark, "examples")
    files.write_examples(FT.examples(features, keep=["split"]), path)
    back = spark.read.schema(f"{render(schemas.EXAMPLE)}, split string").parquet(path)
    return back.select(_joined_int("x", "x"), F.col("y").cast("bigint").alias("y"), "split")


def _joined_int(array: str, out: str):
    return F.array_join(name(array).cast("array<int>").cast("array<string>"), ",").alias(out)


def split(spark, sf):
    return FT.with_split(views.scoring_records(spark, sf).select("Id"))


def result_rows(spark, sf):
    orders = views.table(spark, sf, "orders")
    label = F.when(F.col("o_orderkey") % 11 != 0, F.col("o_orderkey") % 6 - 1)
    return S.anomaly_rows(orders.select(F.col("o_orderkey").alias("Id"), label.alias("cluster")))


def prediction_text(spark, sf):
    records = FT.days_to_close(S.compact_names(views.report(spark, sf)), "days")
    hashed = FT.hash_features(records, ["AccountType", "Stage", "Won"], n=8).filter("days is not null")
    return hashed.select("Id", S.prediction_text(F.col("x"), F.col("days")).alias("line"))


def csv_report(spark, sf):
    """The report written as CSV and read again with its declared types."""
    path = scratch_path(spark, "report")
    files.write_csv(views.report(spark, sf).drop("Id"), path)
    return S.compact_names(B.read_report(spark, path)).withColumnRenamed("#", "Number")


def head_sample(spark, sf):
    report = views.report(spark, sf).select("Id", "Opportunity Name", "Amount")
    return B.head_sample(report, ["Amount", "Id"], 2).withColumnRenamed("Opportunity Name", "opportunity_name")


def batch_infer(spark, sf):
    records = views.scoring_records(spark, sf)
    hashed = FT.hash_features(records, FT.hashed_fields(records, ("Id", "Amount")))
    predict = batch_predictor(linear_model(LINEAR_WEIGHTS, 0.5), 64)
    return hashed.select("Id", predict(F.col("x").cast("array<double>")).alias("score"))


def _customer_points(spark, sf):
    """Customers in the plane of balance and nation."""
    customer = views.table(spark, sf, "customer")
    plane = F.array(F.col("c_acctbal") / 100.0, F.col("c_nationkey").cast("double") * 2.0)
    return customer.select(F.col("c_custkey").alias("id"), plane.alias("coords"))


def cluster_fit(spark, sf):
    """Density clusters at one radius, named by their lowest core id."""
    return density.dbscan_star(_customer_points(spark, sf), eps=1.5, min_pts=4, dims=2)


def cluster_tree(spark, sf):
    """The most stable clusters of the complete hierarchy."""
    return hierarchy.hierarchy(_customer_points(spark, sf), dims=2).labels


def cluster_predict(spark, sf):
    """Cluster of the nearest member within its cluster's radius, for suppliers among the customers."""
    tree = hierarchy.hierarchy(_customer_points(spark, sf), dims=2)
    suppliers = views.table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"),
        F.array(F.col("s_acctbal") / 100.0, F.col("s_nationkey").cast("double") * 2.0).alias("coords"),
    )
    return hierarchy.predict(suppliers, tree.index, 2, members=tree.members).select("id", "cluster")


def encode_pca(spark, sf):
    """Latent code of the embeddings."""
    rows = views.table(spark, sf, "embeddings").select(
        "vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("features")
    )
    return anomaly.encode(anomaly.fit_encoder(rows), rows).select("vec_id", "coords")


def score_anomalies(spark, sf):
    """Fit on the training share of the opportunities, then label all of them."""
    records = views.scoring_records(spark, sf)
    model = anomaly.fit(records)
    return model.score(records)


def regress_score(spark, sf):
    """Fit days to close on the training share, then score all rows."""
    features = saved(FT.regression_features(views.report(spark, sf)), "regression")
    return regression.predict(regression.fit(features), features).select("Id", "prediction")


QUERIES = {
    f.__name__: f
    for f in (
        route_messages, replay_offset, start_offset, change_kind, extract_payload, dead_letter_rows,
        conform_ignore, conform_reject, conform_types, union_errors, batch_append, batch_job, stream_ingest, stream_two_feeds,
        stream_replay, stream_labels, write_back, stream_dead_letters, stream_text, json_lines_scan, typed_projection_lenient, typed_projection_strict,
        scan_range, scan_window, sql_scan, drop_columns, strip_text, rename_columns, row_id,
        record_to_json, restricted_fields, hash_features, zscore, scale_params, parse_dates,
        days_to_close, regression_features, anomaly_features, examples, split, result_rows,
        prediction_text, csv_report, head_sample, batch_infer, cluster_fit, cluster_tree, cluster_predict,
        encode_pca, score_anomalies, regress_score,
    )
}
