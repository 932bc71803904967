"""Rows in and out of Arrow batches, arrays as numpy without per-element conversion."""

from __future__ import annotations

from collections.abc import Iterator
from types import SimpleNamespace

import pyarrow as pa
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def schema_of(ddl: str) -> pa.Schema:
    return to_arrow_schema(T.StructType.fromDDL(ddl))


def records(batch: pa.RecordBatch | pa.Table) -> Iterator[SimpleNamespace]:
    """One namespace per row; list values become numpy arrays."""
    names = batch.schema.names
    lists = [n for n in names if pa.types.is_list(batch.schema.field(n).type)]
    plain = {n: batch.column(n).to_pylist() for n in names if n not in lists}
    for i in range(batch.num_rows):
        row = {n: values[i] for n, values in plain.items()}
        row.update({n: batch.column(n)[i].values.to_numpy(zero_copy_only=False) for n in lists})
        yield SimpleNamespace(**row)


def batch_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(list(c), type=f.type) for c, f in zip(columns, schema)], schema=schema)
