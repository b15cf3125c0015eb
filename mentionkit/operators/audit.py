"""Run log: one row per step with source, layer, rows and outcome."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame

from mentionkit.schemas import AUDIT_SCHEMA
from mentionkit.sources.tables import Tables

AUDIT_TABLE = "pipeline_audit_log"
SUCCESS, FAILED = "success", "failed"


@dataclass
class Step:
    rows: int = 0


class AuditLog:
    def __init__(self, tables: Tables, table: str = AUDIT_TABLE) -> None:
        self.tables = tables
        self.table = table

    def ensure(self) -> None:
        self.tables.ensure(self.table, AUDIT_SCHEMA)

    def log(
        self,
        source: str,
        layer: str,
        rows: int,
        status: str = SUCCESS,
        error: str | None = None,
        at: datetime | None = None,
    ) -> None:
        row = (at or datetime.now(timezone.utc), source, layer, rows, status, error)
        self.tables.append(self.tables.spark.createDataFrame([row], AUDIT_SCHEMA), self.table)

    @contextmanager
    def step(self, source: str, layer: str) -> Iterator[Step]:
        """Log the rows set on the step, or the failure, which is raised again."""
        step = Step()
        try:
            yield step
        except Exception as e:
            self.log(source, layer, step.rows, FAILED, str(e))
            raise
        self.log(source, layer, step.rows)

    def read(self) -> DataFrame:
        self.ensure()
        return self.tables.read(self.table)
