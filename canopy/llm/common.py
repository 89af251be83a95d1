"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from canopy.operators.util import materialize

__all__ = ["arrow_rows", "materialize", "read_table"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The whole table ``name`` of a data folder, through Spark's own reader."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arrow_rows(make: Callable[[], Callable[[pa.RecordBatch], dict]], schema: pa.Schema,
               rows: int = 2048):
    """A ``mapInArrow`` function from a per-batch one.

    ``make`` runs once per task and returns the function that turns a record
    batch into a column dict; batches are cut to ``rows`` rows first, so what
    Python objects a task holds is bounded by the rows, not by the partition.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                cols = work(batch.slice(at, rows))
                yield pa.RecordBatch.from_arrays(
                    [cols[f.name] if isinstance(cols[f.name], pa.Array) else pa.array(cols[f.name], f.type)
                     for f in schema], schema=schema)
        # workers live on: the next stage need not find this one's buffers held
        del work
        gc.collect()
        pa.default_memory_pool().release_unused()
    return run
