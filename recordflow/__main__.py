"""Command line: ``python -m recordflow JOB --name=value ...``."""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from recordflow.config import (
    BatchIngestParams,
    RegressionParams,
    ScoringParams,
    StreamIngestParams,
    TextExportParams,
    TrainingParams,
    WriteBackParams,
)
from recordflow.plans import jobs

JOBS = {
    "ingest-batch": (BatchIngestParams, jobs.ingest_batch),
    "ingest-stream": (StreamIngestParams, jobs.ingest_stream),
    "label-stream": (ScoringParams, jobs.label_stream),
    "export-text": (TextExportParams, jobs.export_text),
    "train-anomaly": (TrainingParams, jobs.train_from_report),
    "train-regressor": (TrainingParams, jobs.train_regressor_from_report),
    "score-regressor": (RegressionParams, jobs.score_report),
    "write-back": (WriteBackParams, jobs.write_back_files),
}


def main(argv: list[str]) -> None:
    if not argv or argv[0] not in JOBS:
        raise SystemExit(f"usage: python -m recordflow {{{','.join(JOBS)}}} --name=value ...")
    params_type, job = JOBS[argv[0]]
    params = params_type.from_args(argv[1:])
    name = getattr(params, "reference_name", argv[0])
    spark = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").getOrCreate()
    query = job(spark, params)
    if isinstance(query, StreamingQuery):
        query.awaitTermination()


if __name__ == "__main__":
    main(sys.argv[1:])
