import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F, types as T

from recordflow import schemas
from recordflow.__main__ import main
from recordflow.config import TrainingParams
from recordflow.ml import anomaly, regression, versions
from recordflow.ml.inference import affine_encoder, batch_predictor, linear_model
from recordflow.ml.stages import vectors
from recordflow.operators.features import ANOMALY_DROPS, clean_report, hash_features
from recordflow.plans import jobs, queries, views


def test_one_prediction_per_row_whatever_the_batch(spark):
    df = spark.range(1000).select("id", F.array(*[F.col("id") * (i + 1.0) for i in range(4)]).alias("x"))
    predict = batch_predictor(linear_model([1.0, 0.0, 0.0, 1.0], 2.0), 4, batch_size=7)
    rows = df.select("id", predict("x").alias("p")).collect()
    assert len(rows) == 1000 and all(r["p"] == 5.0 * r["id"] + 2 for r in rows)


def test_outside_encoder_weights(spark):
    df = spark.range(3).select("id", F.array(F.col("id") * 1.0, F.lit(1.0)).alias("x"))
    encode = batch_predictor(
        affine_encoder([[1.0, 0.0, 2.0], [0.0, 1.0, 0.0]], [0.0, 0.0, 1.0]), 2, T.ArrayType(T.DoubleType())
    )
    assert [r[0] for r in df.orderBy("id").select(encode("x")).collect()][2] == [2.0, 1.0, 5.0]


def test_regressor_beats_the_median(spark, tmp_path):
    days = {"a": 10, "b": 60, "c": 200, "d": 400}
    rows = [(i, "abcd"[i % 4], f"n{i % 7}", days["abcd"[i % 4]] + i % 5) for i in range(600)]
    df = spark.createDataFrame(rows + [(900, "a", "n1", None)], "Id bigint, s string, n string, y bigint")
    features = hash_features(df, ["s", "n"]).select("Id", "x", "y").cache()
    model = regression.fit(features, rounds=5, depth=4)
    errors = regression.holdout_errors(model, features).first()
    assert errors["n"] > 20 and errors["model_mae"] < 0.3 * errors["median_mae"]
    model.write().overwrite().save(str(tmp_path / "m"))
    again = regression.predict(PipelineModel.load(str(tmp_path / "m")), features)
    assert again.count() == 601
    a, b = (
        {r["Id"]: r["prediction"] for r in f.collect()} for f in (again, regression.predict(model, features))
    )
    assert a == b


@pytest.mark.parametrize("setting", [{}])
def test_anomaly_model_round_trip(spark, small, tmp_path, setting):
    records = views.scoring_records(spark, small).limit(300).cache()
    model = jobs.train_anomaly_model(records, str(tmp_path / "m"), **setting)
    loaded = anomaly.AnomalyModel.load(spark, str(tmp_path / "m"))
    for one, two in zip(loaded.pipeline.stages, model.pipeline.stages):
        assert (type(one), one.uid) == (type(two), two.uid)
        assert {p.name: v for p, v in one.extractParamMap().items()} == {p.name: v for p, v in two.extractParamMap().items()}
    one = {r["Id"]: r["cluster"] for r in model.score(records).collect()}
    two = {r["Id"]: r["cluster"] for r in loaded.score(records).collect()}
    assert one == two and len(one) == 300 and None not in one.values()


def test_report_and_events_get_the_same_features(spark, small, tmp_path):
    """The stripping rule travels with the model."""
    report, path = views.report(spark, small).limit(400).drop("Id"), str(tmp_path / "report")
    report.write.option("header", True).csv(path)
    params = TrainingParams.from_args([f"--reportPath={path}", f"--modelUri={tmp_path / 'models'}"])
    assert jobs.train_from_report(spark, params) == 1
    model = versions.LatestModel(spark, str(tmp_path / "models")).get()
    assert model.clean.getOrDefault("strip") and model.clusters.getOrDefault("dims") == 10
    records = views.scoring_records(spark, small)
    by_event = model.features(records).select(F.col("Id").cast("long"), vector_to_array("features").alias("x"))
    report_rows = clean_report(views.report(spark, small), ANOMALY_DROPS, strip=False)
    by_report = model.features(report_rows).select("Id", vector_to_array("features").alias("y"))
    both = by_event.join(by_report, "Id")
    assert both.count() == records.count() and both.filter("x <> y").count() == 0
    whole = anomaly.AnomalyModel.load(spark, str(tmp_path / "models" / "models" / "version=1"))
    assert whole.pipeline.transform(records).columns == ["Id", "cluster"]
    assert {r["cluster"] for r in model.score(records).collect()} > {-1}


def test_command_lines(spark, small, tmp_path, new_table, monkeypatch):
    path, prefix = str(tmp_path / "report"), str(tmp_path / "scored")
    views.report(spark, small).limit(300).drop("Id").write.option("header", True).csv(path)
    options = [f"--reportPath={path}", f"--modelUri={tmp_path / 'model'}"]
    main(["train-regressor", *options])
    main(["score-regressor", *options, f"--outputTxtFilePathPrefix={prefix}"])
    lines = [r[0] for r in spark.read.text(prefix).collect()]
    assert len(lines) == 300 and all(line.startswith("example is [") for line in lines)
    (tmp_path / "rec1").write_text('{"Name":"a"}\nbroken\n')
    dead = new_table(schemas.DEAD_LETTER)
    main([
        "write-back", f"--inputPath={tmp_path / 'rec'}", "--sender=builtins:len", f"--outputDeadletterTable={dead}",
        f"--ledgerPath={tmp_path / 'ledger'}",
    ])
    assert [r["payloadString"] for r in spark.table(dead).collect()] == ["broken"]
    with pytest.raises(ValueError, match="modelUri"):
        main(["train-anomaly", "--reportPath=x"])
    with pytest.raises(SystemExit):
        main(["no-such-job"])


def test_encoder_width(spark):
    r = np.random.default_rng(0)
    df = spark.createDataFrame(
        [(str(i), [int(v) for v in r.integers(0, 3, 64)], float(r.normal())) for i in range(100)],
        "Id string, x array<int>, amount_z double",
    )
    rows = vectors(df)
    coded = anomaly.encode(anomaly.fit_encoder(rows), rows)
    assert len(coded.first()["coords"]) == 10 and coded.count() == 100


def test_regression_job(spark, small, tmp_path):
    report = views.report(spark, small).limit(400)
    jobs.train_regressor(report, str(tmp_path / "r"), rounds=2, depth=3)
    scored = jobs.score_regressor(report, str(tmp_path / "r"))
    assert scored.count() == 400 and scored.columns == ["Id", "x", "prediction"]


def test_model_queries_use_the_defaults(spark, small, monkeypatch):
    class Stop(Exception):
        pass

    given = {}

    def recorder(name):
        def call(*_, **options):
            given[name] = options
            raise Stop

        return call

    monkeypatch.setattr(queries.hierarchy, "hierarchy", recorder("hierarchy"))
    monkeypatch.setattr(queries.anomaly, "fit", recorder("anomaly"))
    monkeypatch.setattr(queries.regression, "fit", recorder("regression"))
    expected = {"cluster_tree": {"dims": 2}, "cluster_predict": {"dims": 2}, "score_anomalies": {}, "regress_score": {}}
    for name, options in expected.items():
        given.clear()
        with pytest.raises(Stop):
            queries.QUERIES[name](spark, small)
        assert list(given.values()) == [options], name
