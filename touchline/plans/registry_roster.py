"""Registered roster queries (batch ETL side) and roster joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.operators import roster as R
from touchline.operators.joins import metrics_with_roster, stamina_audit
from touchline.session import input_version, shared_dir
from touchline.sources.roster import (read_roster_checked, read_roster_csv, write_damaged_csv,
                                      write_roster_csvs, write_roster_parquet)

_CSV_CACHE: dict[tuple[str, str], tuple[str, str]] = {}


def roster_csv_paths(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """The adapter CSVs for ``sf_dir``, written once per Spark application."""
    key = (spark.sparkContext.applicationId, input_version(spark, sf_dir))
    if key not in _CSV_CACHE:
        _CSV_CACHE[key] = write_roster_csvs(spark, sf_dir)
    return _CSV_CACHE[key]


_RAW: dict[tuple, DataFrame] = {}


def raw_union(spark: SparkSession, sf_dir: str, infer_schema: bool = True) -> DataFrame:
    """Men ∪ women raw rosters. Opening a header CSV already runs a small
    job (and inference a full pass), so the built plan is kept per
    application; every action still reads the files."""
    key = (spark.sparkContext.applicationId, id(spark), input_version(spark, sf_dir), infer_schema)
    if key not in _RAW:
        men, women = roster_csv_paths(spark, sf_dir)
        _RAW[key] = R.union_rosters(read_roster_csv(spark, men, infer_schema),
                                    read_roster_csv(spark, women, infer_schema))
    return _RAW[key]


_CLEAN: dict[tuple, DataFrame] = {}


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean roster, read in one pass as text and parsed by
    ``clean_roster`` (no inference pass; same rows and types as the inferred
    read — see tests/test_jobs.py). ``roster_union`` keeps inference."""
    key = (spark.sparkContext.applicationId, id(spark), input_version(spark, sf_dir))
    if key not in _CLEAN:
        _CLEAN[key] = R.clean_roster(raw_union(spark, sf_dir, infer_schema=False))
    return _CLEAN[key]


def roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch job's sink: write the clean roster as Parquet and read it
    back. Each call writes its own folder, so a DataFrame returned earlier
    never reads files that a later call replaced."""
    path = shared_dir(spark, "players_parquet")
    write_roster_parquet(clean(spark, sf_dir), path)
    return spark.read.parquet(path)


def eligible(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.eligible_players(clean(spark, sf_dir))


def draft(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.squad_draft(eligible(spark, sf_dir))


def draft_disjoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.squad_draft(eligible(spark, sf_dir), disjoint=True)


def with_roster_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    from touchline.plans.registry import metrics
    return metrics_with_roster(metrics(spark, sf_dir), clean(spark, sf_dir))


def audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from touchline.plans.registry import match_events
    return stamina_audit(match_events(spark, sf_dir), R.play_attributes(raw_union(spark, sf_dir, False)))


def bad_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a damaged roster file that are no rows, and why."""
    path = shared_dir(spark, "roster-damaged")
    return read_roster_checked(spark, path, write_damaged_csv(spark, sf_dir, path), header=False)[1]


def whole_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean roster of the same file: damaged lines leave no trace in it."""
    path = shared_dir(spark, "roster-damaged")
    return R.clean_roster(read_roster_checked(spark, path, write_damaged_csv(spark, sf_dir, path), header=False)[0])


def write_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row count that the batch job reports, beside the rows it wrote."""
    path = shared_dir(spark, "players_parquet")
    reported = write_roster_parquet(clean(spark, sf_dir), path)
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("filas")).withColumn("informadas", F.lit(reported).cast("bigint"))


ROSTER_QUERIES = {
    "roster_union": raw_union,
    "roster_clean": clean,
    "roster_rejects": lambda spark, sf_dir: R.roster_rejects(raw_union(spark, sf_dir, False)),
    "roster_roundtrip": roundtrip,
    "position_groups": lambda spark, sf_dir: R.position_groups(clean(spark, sf_dir)),
    "eligible_players": eligible,
    "safe_int_stats": lambda spark, sf_dir: R.safe_int_stats(raw_union(spark, sf_dir, False)),
    "roster_bad_lines": bad_lines,
    "roster_whole_lines": whole_lines,
    "roster_report": write_report,
    "eligible_men": lambda spark, sf_dir: R.eligible_players(clean(spark, sf_dir), gender="M"),
    "squad_draft": draft,
    "squad_draft_disjoint": draft_disjoint,
    "formation_check": lambda spark, sf_dir: R.formation_check(spark, eligible(spark, sf_dir)),
    "squad_counts": lambda spark, sf_dir: R.squad_counts(draft(spark, sf_dir)),
    "metrics_with_roster": with_roster_metrics,
    "stamina_audit": audit,
}
