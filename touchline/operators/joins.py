"""Joins between match data and the roster.

The roster is a dimension table (one row per player). The joins are plain
equi-joins; with AQE on, Spark measures the roster side after its scan and
filter and switches to a broadcast hash join only when that measured size is
under ``spark.sql.adaptive.autoBroadcastJoinThreshold``; otherwise it keeps a
sort-merge join and splits skewed partitions of the large side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions.columns import time_order_key
from touchline.operators.windows import RANGE_ROWS, ranged_running_sum
from touchline.schemas import CYCLE_SECONDS, METRIC_KEYS, SAFE_INT_DEFAULT, TIEBREAK_FIELD

ROSTER_ATTRS = ["genero", "velocidad", "resistencia", "media"]


def _roster_side(roster: DataFrame, attrs: list[str]) -> DataFrame:
    """One row per player id, so a join never multiplies rows: of several, the
    one with the smallest attributes (``repeated_ids`` tells which those are)."""
    one = (roster.filter(F.col("id").isNotNull()).groupBy(F.col("id").cast("string").alias("_rid"))
           .agg(F.min(F.struct(*attrs)).alias("_a")))
    return one.select("_rid", "_a.*")


def repeated_ids(roster: DataFrame) -> DataFrame:
    """Player ids that several roster rows carry, and how many do."""
    return (roster.filter(F.col("id").isNotNull()).groupBy("id")
            .agg(F.count(F.lit(1)).alias("filas")).filter(F.col("filas") > 1))


def roster_attributes(metrics: DataFrame, roster: DataFrame, attrs: list[str] = ROSTER_ATTRS,
                      how: str = "left") -> DataFrame:
    """Every metrics column and the player's roster attributes."""
    r = _roster_side(roster, attrs)
    return metrics.join(r, metrics["player_id"] == r["_rid"], how).drop("_rid")


def metrics_with_roster(metrics: DataFrame, roster: DataFrame,
                        attrs: list[str] = ROSTER_ATTRS, how: str = "left") -> DataFrame:
    """Player metrics with the player's roster attributes."""
    j = roster_attributes(metrics, roster, attrs, how)
    return j.select(*METRIC_KEYS, "distancia_m", "estamina_actual", "goles", *attrs)


def stamina_audit(events: DataFrame, roster: DataFrame, cycle_seconds: float = CYCLE_SECONDS,
                  range_rows: int = RANGE_ROWS) -> DataFrame:
    """Rebuild each player's stamina from published speeds with the
    simulator's fatigue rule and compare it with the published stamina:
    loss = speed / max(PAC / 10, 0.01) * (1 - PHY / 200) * cycle * 0.5,
    stamina = max(0, 100 - running sum of loss), in micro-units. The running
    sum is a prefix scan over ranges of rows, so one long group never sits in
    one task. Every player with
    position events is audited; one who is missing from the roster counts with
    50 for both attributes and has ``en_plantilla`` false."""
    r = _roster_side(roster, ["velocidad", "resistencia"])
    pos = events.filter(F.col("tipo") == "posicion")
    j = pos.join(r, pos["player_id"] == r["_rid"], "left").withColumns({
        "en_plantilla": F.col("_rid").isNotNull(),
        **{c: F.coalesce(F.col(c).cast("double"), F.lit(float(SAFE_INT_DEFAULT)))
           for c in ("velocidad", "resistencia")}})
    loss = ((F.col("speed_jugador") / F.greatest(F.col("velocidad") / F.lit(10.0), F.lit(0.01)))
            * (F.lit(1.0) - F.col("resistencia") / F.lit(200.0))
            * F.lit(float(cycle_seconds)) * F.lit(0.5))
    keys = ["match_id", "player_id", "player_equipo", "en_plantilla"]
    tb = TIEBREAK_FIELD if TIEBREAK_FIELD in events.columns else None
    order = ["timestamp"] + ([tb] if tb else [])
    # Loss in exact integer micro-units: integer sums are associative, so the
    # divided running sum is exact and equal to any other summation order.
    loss_u = F.round(loss * F.lit(1e6)).cast("bigint")
    d = j.select(*keys, *order, "estamina", loss_u.alias("perdida_u"))
    run = ranged_running_sum(d, keys, "timestamp", tb, "perdida_u", "_gasto_u", range_rows)
    modelo = F.greatest(F.lit(0), F.lit(100_000_000) - F.col("_gasto_u")) / F.lit(1e6)
    run = run.withColumn("modelo", modelo)
    return run.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("eventos"),
        # the model only falls, so of rows at one time the lowest is the last
        F.max_by("modelo", time_order_key("timestamp", tb, -F.col("modelo"))).alias("estamina_modelo_final"),
        F.max(F.abs(F.col("modelo") - F.col("estamina"))).alias("max_desvio"),
    )
