"""Event-level operators: zones, losses by zone, nearest player to the ball,
and the data-quality checks derived from the simulator's own rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions.columns import clamp, count_where, dist2
from touchline.operators.metrics import with_zone
from touchline.operators.windows import RANGE_ROWS, ranged_lag
from touchline.schemas import PITCH_X_BOUNDS, PITCH_Y_BOUNDS, TIEBREAK_FIELD, ZONE_CUTS


def event_zones(events: DataFrame, cuts=ZONE_CUTS, relative: bool = False) -> DataFrame:
    """Each event with its pitch third."""
    z = with_zone(events, cuts, relative)
    return z.select("match_id", TIEBREAK_FIELD, "player_id", "player_equipo", "x", "zona")


def losses_by_zone(events: DataFrame, cuts=ZONE_CUTS, relative: bool = False) -> DataFrame:
    """Ball losses per match, team and pitch third ("losing balls in midfield")."""
    z = with_zone(events.filter(F.col("action") == "perdida"), cuts, relative)
    return z.groupBy("match_id", "player_equipo", "zona").agg(F.count(F.lit(1)).alias("perdidas"))


def _cycle(cycle_seconds: float | None):
    ts = F.col("timestamp")
    if cycle_seconds is None:
        return ts
    return F.floor(ts / F.lit(float(cycle_seconds)))


def nearest_to_ball(events: DataFrame, cycle_seconds: float | None = 2.0,
                    exclude_goalkeepers: bool = False,
                    exclude_player: str | None = None) -> DataFrame:
    """Per match, cycle and team, the player closest to the ball (arg-min of
    squared distance; ties by player id). Position rows only. One grouped
    arg-min, so every cycle is answered at once and partially aggregated."""
    d = events.filter(F.col("tipo") == "posicion")
    if exclude_goalkeepers:
        d = d.filter(F.col("player_posicion") != "GK")
    if exclude_player is not None:
        d = d.filter(F.col("player_id") != exclude_player)
    d = d.withColumn("ciclo", _cycle(cycle_seconds)).withColumn("distancia2", dist2())
    d = d.filter(F.col("distancia2").isNotNull())
    pick = F.struct("player_id", "player_nombre", "distancia2")
    order = F.struct("distancia2", "player_id", "player_nombre")
    return (d.groupBy("match_id", "ciclo", "player_equipo")
             .agg(F.min_by(pick, order).alias("n"))
             .select("match_id", "ciclo", "player_equipo", "n.*"))


def event_bounds(events: DataFrame) -> DataFrame:
    """Bounds check per match: position rows off the pitch, stamina outside
    [0, 100], and the largest distance outside the x range."""
    pos = F.col("tipo") == "posicion"
    x, y, st = F.col("x"), F.col("y"), F.col("estamina")
    return events.groupBy("match_id").agg(
        F.count(F.lit(1)).alias("eventos"),
        count_where(pos & x.isNotNull() & ~x.between(*PITCH_X_BOUNDS)).alias("fuera_x"),
        count_where(pos & y.isNotNull() & ~y.between(*PITCH_Y_BOUNDS)).alias("fuera_y"),
        count_where(st.isNotNull() & ~st.between(0.0, 100.0)).alias("estamina_fuera"),
        F.max(F.when(pos, F.abs(x - clamp(x, *PITCH_X_BOUNDS)))).alias("exceso_max_x"),
    )


def event_pairing(events: DataFrame, cycle_seconds: float | None = None) -> DataFrame:
    """Cycles that break the simulator's pairing rules: a player with a goal
    but no shot in the cycle, or losses not matched by recoveries."""
    a = F.col("action")
    per_player = (events.withColumn("ciclo", _cycle(cycle_seconds))
                  .groupBy("match_id", "ciclo", "player_id").agg(
                      count_where(a == "gol").alias("g"),
                      count_where(a == "tiro").alias("t"),
                      count_where(a == "perdida").alias("p"),
                      count_where(a == "recuperacion").alias("r")))
    per_cycle = per_player.groupBy("match_id", "ciclo").agg(
        count_where(F.col("g") > F.col("t")).alias("goles_sin_tiro"),
        F.sum("p").alias("perdidas"),
        F.sum("r").alias("recuperaciones"))
    return per_cycle.filter((F.col("goles_sin_tiro") > 0)
                            | (F.col("perdidas") != F.col("recuperaciones")))


def stamina_monotone(events: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Rows where a player's published stamina rises against the previous
    non-null value of the same match and team."""
    keys = ["match_id", "player_id", "player_equipo"]
    tb = TIEBREAK_FIELD if TIEBREAK_FIELD in events.columns else None
    d = events.filter(F.col("estamina").isNotNull()).select(
        *keys, "timestamp", *([tb] if tb else []), "estamina")
    lagged = ranged_lag(d, keys, "timestamp", tb, "estamina", "estamina_previa", range_rows)
    return lagged.filter(F.col("estamina") > F.col("estamina_previa"))
