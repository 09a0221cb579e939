"""Row-local plans over streams.

Selection and transformation operators are expressions on one row, so the same
plan runs on a stream.  Operators that compare rows are refused.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from curiota.operators.registry import REGISTRY
from curiota.plans.plan import CurationPlan, PlanError

#: Operators that join, aggregate or draw.
ACROSS_ROWS = {"isinworms", "clean_names"} | {n for n, o in REGISTRY.items() if o.kind == "postprocessing"}


def apply_stream(plan: CurationPlan, stream: DataFrame, resources: dict | None = None) -> DataFrame:
    if not stream.isStreaming:
        raise PlanError("not a stream")
    if across := [s.operator.name for s in [*plan.processing, *plan.postprocessing] if s.operator.name in ACROSS_ROWS]:
        raise PlanError(f"these operators compare rows and need a batch: {across}")
    return plan.apply(stream, resources)


def write_stream(df: DataFrame, path: str, checkpoint: str, trigger_once: bool = False) -> StreamingQuery:
    """Append a stream to Parquet, exactly once per checkpoint folder."""
    writer = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if trigger_once else writer).start()
