"""Step status rows, written when a step really starts and ends."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from seismark.schema import AUDIT_SCHEMA

RUN_ID = "pipeline_run_id"


def _utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


class Step:
    """A running step; ``info`` may be filled while it runs."""

    def __init__(self, info: str):
        self.info = info


class AuditLog:
    """Appends one row per status change.

    Each run writes below its own folder, so runs that overlap never share a commit folder.
    """

    def __init__(
        self, spark: SparkSession, path: str, pipeline: str, run_id: str | None = None,
        clock: Callable[[], dt.datetime] = _utc_now,
    ):
        self.spark, self.path, self.pipeline, self.clock = spark, path, pipeline, clock
        self.run_id = run_id or f"run_{clock():%Y%m%d%H%M%S}_{uuid.uuid4().hex[:8]}"

    def record(
        self, step: str, status: str, start: dt.datetime, end: dt.datetime | None = None,
        error: str = "", info: str = "",
    ) -> None:
        row = (self.run_id, self.pipeline, step, status, error, start, end, self.clock(), info)
        (
            self.spark.createDataFrame([row], AUDIT_SCHEMA)
            .drop(RUN_ID)
            .coalesce(1)
            .write.mode("append")
            .parquet(f"{self.path}/{RUN_ID}={self.run_id}")
        )

    @contextmanager
    def step(self, name: str, info: str = "") -> Iterator[Step]:
        """STARTED on entry, then SUCCESS, or FAILURE with the error; the error goes on."""
        step, start = Step(info), self.clock()
        self.record(name, "STARTED", start, info=step.info)
        try:
            yield step
        except Exception as error:
            self.record(name, "FAILURE", start, self.clock(), str(error), step.info)
            raise
        self.record(name, "SUCCESS", start, self.clock(), info=step.info)

    def read(self) -> DataFrame:
        return self.spark.read.schema(AUDIT_SCHEMA).parquet(self.path).select(*AUDIT_SCHEMA.names)
