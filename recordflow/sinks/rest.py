"""Throttled writes to a record system through a caller's ``send`` function."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

# Records between two pauses, and the length of a pause in seconds.
RECORDS_PER_PAUSE = 5
PAUSE_SECONDS = 10.0


def send_throttled(
    df: DataFrame,
    send: Callable[[str], None],
    *,
    value: str = "value",
    senders: int = 1,
    records: int = RECORDS_PER_PAUSE,
    pause: float = PAUSE_SECONDS,
    sleep: Callable[[float], None] = time.sleep,
) -> DataFrame:
    """Send every record once and return the failures as (value, error_message).

    The overall rate is ``records`` per ``pause``: the rows are spread over ``senders`` tasks and
    each pauses ``senders`` times as long after its share. A record that cannot be sent does not
    stop the others. The result is lazy: write it exactly once, because reading it sends. A
    retried task sends its records again, so the receiver should accept repeats.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sent = 0
        for batch in batches:
            failures = []
            for record in batch[value]:
                try:
                    send(record)
                except Exception as problem:  # noqa: BLE001 - every failure is recorded
                    failures.append((record, f"{type(problem).__name__}: {problem}"))
                    continue
                sent += 1
                if sent % records == 0:
                    sleep(pause * senders)
            yield pd.DataFrame(failures, columns=["value", "error_message"])

    spread = df.select(value).repartition(senders)
    return spread.mapInPandas(run, "value string, error_message string")
