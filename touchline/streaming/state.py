"""Reading the metrics back from the stream's own state store.

The running aggregation keeps, for each metrics key, the partial results of
its aggregates: a sum, value and order of the latest stamina and coordinates,
and the counts. ``metrics_from_state`` turns a checkpoint's state into the
metrics of any epoch whose state is kept, without the history and without the
events: for audits of what the query would go on from, and for repairs of a
lost sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.operators.metrics import LAST_EVENT, METRIC_COLUMNS, with_efficiency
from touchline.schemas import CYCLE_SECONDS, METRIC_KEYS

_COUNTS = METRIC_COLUMNS[4:14]
# in the order of ``metric_aggregates``: the state's own names repeat
_VALUES = ["velocidad_suma", "estamina_actual", "_estamina_orden", "ultima_x", "_x_orden", "ultima_y", "_y_orden", *_COUNTS]


def read_state(spark: SparkSession, checkpoint: str, epoch: int | None = None) -> DataFrame:
    """One row per key of the aggregation's state after ``epoch`` (by default
    the last committed one): key columns, aggregate buffers by name, and the
    state partition that holds the row."""
    reader = spark.read.format("statestore")
    if epoch is not None:
        reader = reader.option("batchId", epoch)
    rows = reader.load(checkpoint)
    held = rows.schema["value"].dataType.fields
    names = _VALUES + [LAST_EVENT] * (len(held) - len(_VALUES))
    if len(names) != len(held) or [f.name for f in rows.schema["key"].dataType.fields] != METRIC_KEYS:
        raise ValueError("the checkpoint's state is not that of the metrics query")
    named = T.StructType([T.StructField(n, f.dataType) for n, f in zip(names, held)])
    return rows.select("key.*", F.col("value").cast(named).alias("v"), "partition_id").select(*METRIC_KEYS, "v.*", "partition_id")


def metrics_from_state(spark: SparkSession, checkpoint: str, epoch: int | None = None,
                       cycle_seconds: float = CYCLE_SECONDS) -> DataFrame:
    """The metrics rows that the state amounts to."""
    s = read_state(spark, checkpoint, epoch)
    rows = s.select(
        *METRIC_KEYS, F.round(F.col("velocidad_suma") * F.lit(float(cycle_seconds)), 1).alias("distancia_m"),
        F.round("estamina_actual", 1).alias("estamina_actual"), F.round("ultima_x", 2).alias("ultima_x"),
        F.round("ultima_y", 2).alias("ultima_y"), *_COUNTS)
    return with_efficiency(rows)
