"""Writes to a record system that survive retries: what was acknowledged is not sent again.

Each record has a key. A task leaves a mark under the key as soon as the receiver has taken the record, in
a folder that all tasks share, and looks for the mark before it sends. When all tasks are done, their lists of
keys become the ledger that later runs are compared with, and the marks go.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from recordflow.sinks.rest import PAUSE_SECONDS, RECORDS_PER_PAUSE
from recordflow.sources.folders import opened

FAILURES = "key string, value string, error_message string"


@dataclass
class Share(WriterCommitMessage):
    """What one task has done."""

    sent: int
    skipped: int
    failed: int
    file: str


class Delivery(DataSourceArrowWriter):
    def __init__(self, send, folder: str, run: str, senders: int, records: int, pause: float, sleep):
        self.send, self.folder, self.run = send, folder, run
        self.senders, self.records, self.pause, self.sleep = senders, records, pause, sleep

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Share:
        """Send the records of a task, pausing after each share; a failure does not stop the others."""
        system, root = opened(self.folder)
        runs = [f.path for f in system.get_file_info(fs.FileSelector(f"{root}/marks", allow_not_found=True))]
        acknowledged, failures, skipped = [], [], 0
        for batch in iterator:
            for key, value in zip(batch.column("key").to_pylist(), batch.column("value").to_pylist()):
                # Marks of this run are from an earlier try of the task, others of runs that did not end.
                places = [f"{r}/{key}" for r in {*runs, f"{root}/marks/{self.run}"}]
                if any(f.type != fs.FileType.NotFound for f in system.get_file_info(places)):
                    skipped += 1
                    acknowledged.append(key)
                    continue
                try:
                    self.send(value)
                except Exception as problem:  # noqa: BLE001 - every failure is recorded
                    failures.append((key, value, f"{type(problem).__name__}: {problem}"))
                    continue
                system.create_dir(f"{root}/marks/{self.run}", recursive=True)
                with system.open_output_stream(f"{root}/marks/{self.run}/{key}"):
                    pass
                acknowledged.append(key)
                if (len(acknowledged) - skipped) % self.records == 0:
                    self.sleep(self.pause * self.senders)
        name = uuid.uuid4().hex
        for folder, table in (
            ("sent", pa.table({"key": pa.array(acknowledged, pa.string())})),
            (f"failed/{self.run}", pa.table([pa.array(c, pa.string()) for c in zip(*failures)] or [pa.array([], pa.string())] * 3, ["key", "value", "error_message"])),
        ):
            if table.num_rows:
                system.create_dir(f"{root}/{folder}", recursive=True)
                pq.write_table(table, f"{root}/{folder}/{name}.parquet", filesystem=system)
        return Share(len(acknowledged) - skipped, skipped, len(failures), name)

    def commit(self, messages: list[Share | None]) -> None:
        """All keys are in the ledger now, so the marks of this run and of earlier ones can go."""
        system, root = opened(self.folder)
        if system.get_file_info(f"{root}/marks").type != fs.FileType.NotFound:
            system.delete_dir(f"{root}/marks")

    def abort(self, messages: list[Share | None]) -> None:
        """The marks stay, so that the next run skips what was sent."""


def ledger(spark: SparkSession, folder: str, name: str, schema: str) -> DataFrame:
    """The files that tasks have left in a folder; none yet is an empty table."""
    system, root = opened(folder)
    if system.get_file_info(f"{root}/{name}").type == fs.FileType.NotFound:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{folder.rstrip('/')}/{name}")


def keyed(records: DataFrame, value: str = "value") -> DataFrame:
    """(``key``, ``value``): the record's digest, and its number among equal ones, which are records of their own."""
    digest = F.sha2(F.col(value), 256)
    rows = records.select(digest.alias("digest"), F.col(value).alias("value"))
    number = F.row_number().over(Window.partitionBy("digest").orderBy("value"))
    return rows.select(F.concat_ws("-", "digest", number.cast("string")).alias("key"), "value")


def deliver(
    records: DataFrame,
    send: Callable[[str], None],
    folder: str,
    *,
    senders: int = 1,
    records_per_pause: int = RECORDS_PER_PAUSE,
    pause: float = PAUSE_SECONDS,
    sleep: Callable[[float], None] = time.sleep,
) -> DataFrame:
    """Send ``records`` (``key``, ``value``) that have not been acknowledged yet; the failures of this run
    as (``key``, ``value``, ``error_message``).

    The overall rate is ``records_per_pause`` per ``pause``, spread over ``senders`` tasks. ``folder`` is on a shared store and holds the
    ledger over all runs. A task that is tried again, and a run after one that broke off, skip what was
    acknowledged; only a record whose task is lost between the receiver's answer and the mark, at most
    one for each sender, can arrive twice. A record that failed is not in the ledger: the next run tries it again.
    """
    spark, run, name = records.sparkSession, uuid.uuid4().hex, f"delivery_{uuid.uuid4().hex}"
    writer = Delivery(send, folder, run, senders, records_per_pause, pause, sleep)

    class Receiver(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def writer(self, schema: T.StructType, overwrite: bool) -> Delivery:
            return writer

    spark.dataSource.register(Receiver)
    left = records.select("key", "value").join(ledger(spark, folder, "sent", "key string"), "key", "left_anti")
    left.repartition(senders).write.format(name).mode("append").save()
    return ledger(spark, folder, f"failed/{run}", FAILURES)
