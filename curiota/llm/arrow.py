"""Arrow batch plumbing shared by the operators that run Python."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

#: Rows of a record batch that are Python objects at the same time.
SLICE_ROWS = 256
#: Bytes of their texts.
SLICE_BYTES = 4 << 20


def parse_schema(schema: str) -> StructType:
    return _parse_datatype_string(schema)


def slices(batch: pa.RecordBatch, rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of at most ``rows`` rows and ``SLICE_BYTES`` bytes of text, or of one row."""
    sizes = np.zeros(batch.num_rows, dtype=np.int64)
    for column in batch.columns:
        if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
            sizes += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    lo = 0
    while lo < batch.num_rows:
        before = int(ends[lo - 1]) if lo else 0
        hi = max(lo + 1, min(lo + rows, int(np.searchsorted(ends, before + SLICE_BYTES, side="right"))))
        yield batch.slice(lo, hi - lo)
        lo = hi


def release() -> None:
    """Give freed memory back to the machine."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # only the GNU library has it
        pass


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, after which its memory is released: a worker lives on beside other stages' heaps and workers."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return whole


def map_columns(df: DataFrame, columns: Sequence[str], make: Callable[[], Callable], schema: str, rows: int = SLICE_ROWS) -> DataFrame:
    """Run ``make()(*lists)`` over slices of the given columns.

    ``make`` runs once per task and returns a function from column lists to a
    list of output columns; a task holds one slice as Python objects at a time.
    """
    struct = parse_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(struct)
        work = make()
        for batch in batches:
            for part in slices(batch, rows):
                out = work(*(part.column(i).to_pylist() for i in range(part.num_columns)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=f.type) for c, f in zip(out, arrow, strict=True)], schema=arrow
                )

    quoted = [f"`{c}`" for c in columns]
    return df.select(*quoted).mapInArrow(released(run), struct)


def gather_columns(df: DataFrame, columns: Sequence[str], make: Callable, schema: str) -> DataFrame:
    """Gather slices of the given columns in one ``make()`` a task.

    Its ``add(*lists)`` returns output columns where it has gathered enough, else None; ``take()`` returns the rest.
    """
    struct = parse_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(struct)
        held = make()

        def record(out: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(out, arrow, strict=True)], schema=arrow)

        for batch in batches:
            for part in slices(batch):
                out = held.add(*(part.column(i).to_pylist() for i in range(part.num_columns)))
                if out is not None:
                    yield record(out)
        yield record(held.take())

    return df.select(*(f"`{c}`" for c in columns)).mapInArrow(released(run), struct)


def filter_rows(df: DataFrame, column: str, make: Callable[[], Callable]) -> DataFrame:
    """The rows for whose value of ``column`` the predicate holds; ``make()`` gives it for a list of values."""
    at = df.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = make()
        for batch in batches:
            for part in slices(batch):
                yield part.filter(pa.array(keep(part.column(at).to_pylist()), type=pa.bool_()))

    return df.mapInArrow(released(run), df.schema)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Keep the cluster's ``spark.checkpoint.dir``; in local mode without one, a folder of this machine."""
    if spark.sparkContext.getCheckpointDir() is None:
        where = spark.conf.get("spark.checkpoint.dir", None)
        if where is None:
            if not spark.sparkContext.master.split("[")[0] == "local":
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            import tempfile

            where = tempfile.mkdtemp(prefix="curiota-checkpoint-")
        spark.sparkContext.setCheckpointDir(where)
