"""Results of operators that need a least number of rows."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Guarded:
    """``frame`` always has the promised schema; without enough rows it is empty, there is
    no ``model``, and ``reason`` says what was missing."""

    frame: DataFrame
    model: Any = None
    reason: str | None = None

    @property
    def held(self) -> bool:
        return self.reason is None


def withheld(spark: SparkSession, schema, reason: str) -> Guarded:
    return Guarded(spark.createDataFrame([], schema), None, reason)


def at_least(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` has ``rows`` rows; reads no more than that."""
    return df.limit(rows).count() >= rows
