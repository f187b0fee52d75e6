"""A roster that changes while the stream runs.

``publish`` writes a new version and commits it; ``join_roster`` joins every
epoch's metrics with the version that is current when the epoch first runs.
The epoch's version is recorded before the join, so an epoch that runs again
after a failure sees the same roster, and its sinks the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.operators.joins import ROSTER_ATTRS, roster_attributes
from touchline.streaming.files import Log


class RosterVersions:
    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")
        self.versions = Log(spark, f"{self.base}/_versions")

    def publish(self, roster: DataFrame) -> int:
        """Write ``roster`` as the next version; readers see it once complete."""
        number = max(self.versions.numbers(), default=-1) + 1
        roster.write.mode("overwrite").parquet(f"{self.base}/version={number}")
        self.versions.commit(number, {"version": number})
        return number

    def current(self) -> int | None:
        return max(self.versions.numbers(), default=None)

    def read(self, number: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.base}/version={number}")


def join_roster(versions_base: str, epochs_base: str, attrs: list[str] = ROSTER_ATTRS) -> Callable[[DataFrame, int], DataFrame]:
    """For ``MetricsBatchWriter(prepare=...)``: the metrics with the roster's
    attributes and ``version_plantilla``; null without a published roster."""
    def prepare(df: DataFrame, epoch: int) -> DataFrame:
        spark = df.sparkSession
        versions, epochs = RosterVersions(spark, versions_base), Log(spark, epochs_base)
        used = epochs.entry(epoch)
        if used is None:
            used = {"version": versions.current()}
            epochs.commit(epoch, used)
        number = used["version"]
        if number is None:
            return df.select("*", *[F.lit(None).cast("string").alias(a) for a in attrs], F.lit(None).cast("bigint").alias("version_plantilla"))
        joined = roster_attributes(df, versions.read(number), attrs)
        return joined.withColumn("version_plantilla", F.lit(number).cast("bigint"))
    return prepare
