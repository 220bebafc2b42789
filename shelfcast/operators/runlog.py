"""A log of runs that lasts: rows in and out of every stage, run after run.

Counts are observed while a stage is read and written, so they cost no scan. Each entry is
appended as a small table of its own; nothing written before is touched, and runs that end at
the same time do not disturb each other.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession

from shelfcast.operators.audit import counted

LOG = (
    "run string, stage string, rows_in bigint, rows_out bigint, rejects bigint, "
    "started timestamp, ended timestamp"
)


@dataclass
class Entry:
    """One stage of a run while it is under way; counts that are not set stay null."""

    stage: str
    rows_out: int | None = None
    rejects: int | None = None
    lines: int | None = None  # rows in, where they were counted already
    _seen: list[Observation] = field(default_factory=list)

    def reading(self, df: DataFrame) -> DataFrame:
        """``df`` with its rows counted as they are read: the stage's rows in.

        For a table that the stage reads once: rows of a scan that runs twice count twice.
        """
        watched, seen = counted(df)
        self._seen.append(seen)
        return watched

    @property
    def rows_in(self) -> int | None:
        return sum(seen.get["n_rows"] for seen in self._seen) if self._seen else self.lines


@dataclass(frozen=True)
class RunLog:
    """Appends to a folder of Parquet files; ``run`` names this run."""

    spark: SparkSession
    path: str
    run: str = field(default_factory=lambda: uuid.uuid4().hex)

    @contextmanager
    def stage(self, name: str) -> Iterator[Entry]:
        """Log a stage when its block ends well; a stage that fails leaves no entry."""
        entry, started = Entry(name), datetime.now(timezone.utc)
        yield entry
        ended = datetime.now(timezone.utc)
        times = pa.timestamp("us", tz="UTC")
        row = pa.table(
            {
                "run": [self.run],
                "stage": [name],
                "rows_in": pa.array([entry.rows_in], pa.int64()),
                "rows_out": pa.array([entry.rows_out], pa.int64()),
                "rejects": pa.array([entry.rejects], pa.int64()),
                "started": pa.array([started], times),
                "ended": pa.array([ended], times),
            }
        )
        table = self.spark.createDataFrame(row, LOG)
        table.coalesce(1).write.mode("append").parquet(self.path)

    def read(self) -> DataFrame:
        return self.spark.read.schema(LOG).parquet(self.path)
