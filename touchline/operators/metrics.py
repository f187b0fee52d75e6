"""Per-player match metrics: zone tagging and the grouped aggregate.

One ``groupBy`` on the five player keys. Every aggregate is declarative
(count/sum/max_by), so Spark plans a partial aggregate before the shuffle:
a key holding a third of all events is pre-reduced to one row per map task
and never lands in one task as raw rows. The same expressions run inside a
streaming aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions.columns import count_where, latest, pct, time_part, zone_of, zone_relative
from touchline.schemas import CYCLE_SECONDS, METRIC_KEYS, TIEBREAK_FIELD, ZONE_CUTS

#: Time of a row's latest event, kept where rows are merged into documents.
LAST_EVENT = "ultimo_evento"
_TIME = "_orden"  # the time's share of the latest values' order, once a row

METRIC_COLUMNS = [
    "distancia_m", "estamina_actual", "ultima_x", "ultima_y",
    "pases_intentados", "pases_acertados", "tiros", "goles", "paradas",
    "perdidas", "recuperaciones", "eventos_zona_defensa", "eventos_zona_medio",
    "eventos_zona_ataque", "eficiencia_pase", "eficiencia_tiro",
]


def with_zone(events: DataFrame, cuts=ZONE_CUTS, relative: bool = False) -> DataFrame:
    """Adds ``zona``. Default is the original absolute thirds; ``relative``
    mirrors team B so 'defensa' is always near the player's own goal."""
    z = zone_relative("x", "player_equipo", cuts) if relative else zone_of("x", cuts)
    return events.withColumn("zona", z)


def metric_aggregates(cycle_seconds: float = CYCLE_SECONDS,
                      tiebreak: str | None = TIEBREAK_FIELD) -> list:
    action = F.col("action")
    return [
        F.round(F.sum("speed_jugador") * F.lit(float(cycle_seconds)), 1).alias("distancia_m"),
        F.round(latest("estamina", "timestamp", tiebreak, F.col(_TIME)), 1).alias("estamina_actual"),
        F.round(latest("x", "timestamp", tiebreak, F.col(_TIME)), 2).alias("ultima_x"),
        F.round(latest("y", "timestamp", tiebreak, F.col(_TIME)), 2).alias("ultima_y"),
        count_where(action == "pase").alias("pases_intentados"),
        count_where((action == "pase") & (F.col("is_successful") == F.lit(True))).alias("pases_acertados"),
        count_where(action == "tiro").alias("tiros"),
        count_where(action == "gol").alias("goles"),
        count_where(action == "parada").alias("paradas"),
        count_where(action == "perdida").alias("perdidas"),
        count_where(action == "recuperacion").alias("recuperaciones"),
        count_where(F.col("zona") == "defensa").alias("eventos_zona_defensa"),
        count_where(F.col("zona") == "medio").alias("eventos_zona_medio"),
        count_where(F.col("zona") == "ataque").alias("eventos_zona_ataque"),
    ]


def with_efficiency(metrics: DataFrame, real_pass: bool = False) -> DataFrame:
    out = (metrics
           .withColumn("eficiencia_pase", pct("pases_acertados", "pases_intentados"))
           .withColumn("eficiencia_tiro", pct("goles", "tiros")))
    if real_pass:
        # Failed passes are published as 'perdida', so the faithful metric
        # is 0 or 100 on simulator data; this one counts them as attempts.
        out = out.withColumn("eficiencia_pase_real",
                             pct("pases_acertados", F.col("pases_intentados") + F.col("perdidas")))
    return out


def player_metrics(events: DataFrame, cycle_seconds: float = CYCLE_SECONDS,
                   cuts=ZONE_CUTS, relative_zones: bool = False,
                   real_pass: bool = False, last_event: bool = False) -> DataFrame:
    """Events -> one row per (match, player, name, team, position), with the
    time of its latest event if asked."""
    tiebreak = TIEBREAK_FIELD if TIEBREAK_FIELD in events.columns else None
    zoned = with_zone(events, cuts, relative_zones).withColumn(_TIME, time_part("timestamp"))
    more = [F.max("timestamp").alias(LAST_EVENT)] if last_event else []
    agg = zoned.groupBy(*METRIC_KEYS).agg(*metric_aggregates(cycle_seconds, tiebreak), *more)
    return with_efficiency(agg, real_pass)
