"""Run a numpy function over the texts of a table and carry other columns along."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from tidemark.llm.columnar import SLICE_BYTES, plain_text, slices

Work = Callable[[pa.RecordBatch, np.ndarray, np.ndarray], list]


def doc_key(id_col: str, text_col: str) -> list[Column]:
    """Two numbers that tell documents apart; rows equal in id and text share them."""
    return [F.xxhash64(F.col(id_col)).alias("k1"), F.xxhash64(plain_text(text_col)).alias("k2")]


def map_texts(
    docs: DataFrame,
    keep: list[str],
    text: Column,
    out: str,
    work: Work,
    extra: dict[str, Column] | None = None,
    limit: int = SLICE_BYTES,
) -> DataFrame:
    """Columns ``keep`` of ``docs`` and the columns ``out`` (DDL) that ``work`` makes of its texts.

    ``work(rows, bytes, offsets)`` sees slices of at most ``limit`` bytes of text
    and the ``extra`` columns under their names, and returns one Arrow array per
    output column.  Kept columns travel under internal names, so they cannot
    clash with anything; an output replaces a kept column of its name.
    """
    made = _parse_datatype_string(out)
    passed = [c for c in keep if c not in made.names]
    inside = [f"__c{i}" for i in range(len(passed))]
    rows = docs.select(
        *(F.col(f"`{c}`").alias(i) for c, i in zip(passed, inside, strict=True)),
        *(c.alias(name) for name, c in (extra or {}).items()),
        text.alias("__body"),
    )
    schema = StructType(
        [StructField(i, rows.schema[i].dataType) for i in inside]
        + [StructField(f"__o{i}", f.dataType) for i, f in enumerate(made.fields)]
    )
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in slices(batches, "__body", limit):
            arrays = [part.column(part.schema.get_field_index(c)) for c in inside]
            yield pa.RecordBatch.from_arrays(arrays + work(part, data, offsets), schema=arrow)

    return rows.mapInArrow(run, schema).toDF(*passed, *made.names)


def emit(
    docs: DataFrame, text: Column, out: str, work, extra: dict[str, Column] | None = None,
    limit: int = SLICE_BYTES,
) -> DataFrame:
    """Any number of rows per text: ``work`` returns whole columns of a new table."""
    made = _parse_datatype_string(out)
    arrow = to_arrow_schema(made)
    rows = docs.select(*(c.alias(n) for n, c in (extra or {}).items()), text.alias("__body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in slices(batches, "__body", limit):
            columns = [
                c if isinstance(c, pa.Array) else pa.array(c, f.type)
                for c, f in zip(work(part, data, offsets), arrow, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return rows.mapInArrow(run, made)


def numbers(part: pa.RecordBatch, name: str) -> np.ndarray:
    return part.column(part.schema.get_field_index(name)).to_numpy(zero_copy_only=False)
