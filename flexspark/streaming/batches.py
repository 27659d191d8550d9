"""Micro-batch processing with retries, and samples of a stream."""

from __future__ import annotations

import logging
import re
import time
from collections import deque
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from flexspark.frame import FlexFrame
from flexspark.sources.scratch import new_dir

log = logging.getLogger(__name__)

# Defaults and limits of batch retries and of stream samples.
BATCH_MAX_RETRIES = 3
RETRY_LIMITS = (0, 100)
RETRY_WAIT_SECONDS = [1, 2, 5]
POLLING_TIME_MS = 10_000
RECORD_POLLING_LIMIT = 100
NEVER_RETRIED = "CheckpointMetadataNotFound"
UNIT_MS = {"second": 1_000, "minute": 60_000, "hour": 3_600_000}
METRICS_KEPT = 1000


def window_ms(text: str) -> int:
    """``"10 seconds"`` in milliseconds; seconds, minutes and hours are known."""
    m = re.fullmatch(r"\s*(\d+)\s+(second|minute|hour)s?\s*", text.lower()) if isinstance(text, str) else None
    if m is None:
        raise ValueError(f"not a window size: {text!r}")
    return int(m.group(1)) * UNIT_MS[m.group(2)]


class _Attempts:
    """When to try again: waits RETRY_WAIT_SECONDS, the last one from then on; a success starts over."""

    def __init__(self, most: int):
        self.most, self.failed = most, 0

    def succeeded(self) -> None:
        self.failed = 0

    def wait_after(self, cause: BaseException) -> float | None:
        """Seconds until the next attempt; None for no more."""
        self.failed += 1
        if self.failed > self.most or NEVER_RETRIED in f"{type(cause).__name__}: {cause}":
            return None
        return RETRY_WAIT_SECONDS[min(self.failed, len(RETRY_WAIT_SECONDS)) - 1]


class _Batches:
    """The function Spark calls: runs ``process`` on batches with rows, reports each, and keeps what made one fail."""

    def __init__(self, process: Callable, level: StorageLevel | None, report: Callable[[dict], None]):
        self.process, self.level, self.report = process, level, report
        self.cause: BaseException | None = None

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        began = time.monotonic()
        held = batch if self.level is None else batch.persist(self.level)
        try:
            rows = None if self.level is None else held.count()
            if rows or (rows is None and not held.isEmpty()):
                self.process(held, batch_id)
        except BaseException as e:
            self.cause = e
            raise
        finally:
            if self.level is not None:
                held.unpersist()
        self.report({"batch": batch_id, "rows": rows, "ms": round((time.monotonic() - began) * 1000)})


def for_each_batch(
    stream: DataFrame,
    process: Callable[[DataFrame, int], None],
    window_size: str | None = None,
    checkpoint_location: str | None = None,
    batch_max_retries: int = BATCH_MAX_RETRIES,
    persist: bool = True,
    storage_level: str = "MEMORY_AND_DISK",
    wait: Callable[[float], None] = time.sleep,
    on_batch: Callable[[dict], None] | None = None,
) -> list[dict]:
    """Run ``process(batch, id)`` on every non-empty micro-batch until the stream ends.

    ``on_batch`` gets the metrics of every batch (``batch``, ``rows``, ``ms``) as soon as it is done; the metrics of the last METRICS_KEPT
    batches are returned. A persisted batch is counted first, which fills the cache in parallel; rows of others are unknown.
    ``window_size`` is the trigger interval, or ``"availableNow"`` to drain what is there and return. A failed batch
    is retried from the checkpoint, unless the failure says that the checkpoint's metadata are gone.
    """
    for name, value in (("window_size", window_size), ("checkpoint_location", checkpoint_location)):
        if not value:
            raise ValueError(f"{name} is missing")
    low, high = RETRY_LIMITS
    if not low <= int(batch_max_retries) <= high:
        raise ValueError(f"batch_max_retries must be between {low} and {high}")
    attempts, kept = _Attempts(int(batch_max_retries)), deque(maxlen=METRICS_KEPT)

    def report(metrics: dict) -> None:
        attempts.succeeded()
        kept.append(metrics)
        if on_batch is not None:
            on_batch(metrics)

    batches = _Batches(process, getattr(StorageLevel, storage_level.upper()) if persist else None, report)
    trigger = {"availableNow": True} if window_size == "availableNow" else {"processingTime": window_size}
    writer = stream.writeStream.foreachBatch(batches).trigger(**trigger).option("checkpointLocation", checkpoint_location)
    while True:
        batches.cause = None
        try:
            writer.start().awaitTermination()
            return list(kept)
        except Exception as failure:
            pause = attempts.wait_after(batches.cause or failure)
            if pause is None:
                log.error("a batch failed %d times", attempts.failed)
                raise
            log.warning("a batch failed, attempt %d of %d follows in %d s", attempts.failed, attempts.most, pause)
        wait(pause)


def sample_stream(
    stream: DataFrame,
    window_size: str,
    polling_time_ms: int = POLLING_TIME_MS,
    record_polling_limit: int = RECORD_POLLING_LIMIT,
    batch_function: Callable[[DataFrame, int], None] | None = None,
) -> FlexFrame:
    """At most ``record_polling_limit`` rows seen within the polling time, as a frame. ``batch_function`` sees every batch.

    Batches add their first rows to a small table in the shared folder until the limit is reached.
    """
    if window_ms(window_size) >= polling_time_ms:
        raise ValueError("the polling time must be longer than the window size")
    spark = stream.sparkSession
    target = new_dir(spark, "sample")
    schema, taken = stream.schema, {"rows": 0}

    def run(batch: DataFrame, batch_id: int) -> None:
        if batch_function is not None:
            batch_function(batch, batch_id)
        need = record_polling_limit - taken["rows"]
        if need > 0:
            path = f"{target}/batch={batch_id}"
            batch.limit(need).write.mode("overwrite").parquet(path)
            taken["rows"] += spark.read.schema(schema).parquet(path).count()

    query = (
        stream.writeStream.foreachBatch(run)
        .trigger(processingTime=window_size)
        .option("checkpointLocation", new_dir(spark, "sample-state"))
        .start()
    )
    deadline = time.monotonic() + polling_time_ms / 1000
    try:
        while taken["rows"] < record_polling_limit and (left := deadline - time.monotonic()) > 0:
            if query.awaitTermination(min(left, 0.2)):
                break
    finally:
        query.stop()
    if not taken["rows"]:
        return FlexFrame(spark.createDataFrame([], schema), "sample")
    sample = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(target)
    return FlexFrame(sample.limit(record_polling_limit), "sample")
