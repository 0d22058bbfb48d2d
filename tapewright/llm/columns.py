"""Columns computed in Arrow batches inside tasks, and small helpers shared by the operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Largest Arrow batch sent to a Python worker; a single longer text still goes through whole.
BATCH_BYTES = 4 << 20
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def col(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Limit Arrow batches by bytes, so that long texts do not add up, unless the session does."""
    if int(spark.conf.get(_BATCH_CONF, "2147483647")) > BATCH_BYTES:
        spark.conf.set(_BATCH_CONF, str(BATCH_BYTES))


def give_back() -> None:
    """Return memory that Arrow and the allocator keep after use; an idle worker needs none of it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(run: Callable[..., Iterator[pa.RecordBatch]]) -> Callable[..., Iterator[pa.RecordBatch]]:
    """The work of a task, which gives its memory back when it is done."""

    def done(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return done


def add_columns(
    df: DataFrame,
    inputs: Iterable[str | Column],
    fields: str,
    start: Callable[[], Callable[..., list]],
    keep: Iterable[str] = (),
) -> DataFrame:
    """The columns of ``keep`` and new ones, computed from whole batches.

    ``start`` runs once in each task and returns a function from one Arrow array for each input to
    a list (or array) for each of the ``fields``. A kept column with the name of a new one is left
    out. No row is dropped or moved.
    """
    bounded_batches(df.sparkSession)
    inputs = list(inputs)
    added = T._parse_datatype_string(fields)
    names = {f.name.lower() for f in added}
    kept = [c for c in keep if c.lower() not in names]
    # a kept column that is an input too is sent to the worker once
    sent = [*inputs, *(c for c in kept if c not in [x for x in inputs if isinstance(x, str)])]
    source = df.select(
        *((col(x) if isinstance(x, str) else x).alias(f"c_{i}") for i, x in enumerate(sent))
    )
    n = len(inputs)
    names_sent = [x if isinstance(x, str) else None for x in sent]
    places = [names_sent.index(c) for c in kept]
    schema = T.StructType(
        [T.StructField(c, source.schema[i].dataType) for c, i in zip(kept, places, strict=True)]
        + list(added)
    )
    arrow_schema = to_arrow_schema(added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = start()
        for batch in batches:
            made = compute(*batch.columns[:n])
            arrays = [batch.column(i) for i in places] + [
                x if isinstance(x, pa.Array) else pa.array(x, f.type)
                for x, f in zip(made, arrow_schema, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(arrays, [*kept, *arrow_schema.names])

    return source.mapInArrow(tidy(run), schema)
