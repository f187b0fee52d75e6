"""Coaching-staff queries over the player-metrics table.

Each takes the metrics DataFrame (batch result, streaming sink read-back or
the latest-state table) and returns a DataFrame. Grouped totals are partial
aggregates; rankings use histogram ranks and top-k uses ``limit`` after
``orderBy`` (planned as TakeOrderedAndProject) or a ``row_number <= k``
filter (planned with a partial WindowGroupLimit before the shuffle).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.functions.columns import avg_tenths, pct, tenths
from touchline.operators.windows import rank_by_histogram
from touchline.schemas import METRIC_KEYS, ZONES

# Total order over metric rows, used after every business order key so that
# ties are broken the same way on every run and engine.
ROW_ORDER = ["match_id", "player_id", "player_equipo", "player_nombre", "player_posicion"]


def match_kpis(m: DataFrame) -> DataFrame:
    """Match summary panel: active players, shots, completed passes, losses,
    goals, recoveries and mean stamina."""
    return m.groupBy("match_id").agg(
        F.count(F.lit(1)).alias("jugadores_activos"),
        F.sum("tiros").alias("total_tiros"),
        F.sum("pases_acertados").alias("pases_acertados"),
        F.sum("perdidas").alias("perdidas"),
        F.sum("goles").alias("goles"),
        F.sum("recuperaciones").alias("recuperaciones"),
        avg_tenths("estamina_actual").alias("estamina_media"),
    )


def filtered_kpis(m: DataFrame, team: str | None = None, position: str | None = None,
                  player: str | None = None, match: str | None = None) -> DataFrame:
    """Dashboard filters; ``None`` is the "All" choice and adds no filter.
    On a stored table every filter reaches the Parquet scan."""
    for col, v in (("player_equipo", team), ("player_posicion", position),
                   ("player_nombre", player), ("match_id", match)):
        if v is not None:
            m = m.filter(F.col(col) == v)
    return match_kpis(m)


def kpi_cube(m: DataFrame) -> DataFrame:
    """Every filter combination at once: per match, by team × position,
    team, position and all (null = "All"; ``nivel`` is the grouping id)."""
    keys = ["match_id", "player_equipo", "player_posicion"]
    sets = [keys, ["match_id", "player_equipo"], ["match_id", "player_posicion"], ["match_id"]]
    return m.groupingSets(sets, *keys).agg(
        F.grouping_id().cast("bigint").alias("nivel"),
        F.count(F.lit(1)).alias("jugadores"),
        F.sum("tiros").alias("tiros"),
        F.sum("goles").alias("goles"),
        F.sum("pases_acertados").alias("pases_acertados"),
        F.sum("perdidas").alias("perdidas"),
        F.sum("recuperaciones").alias("recuperaciones"),
    )


def team_stamina(m: DataFrame, alert_below: float = 60.0) -> DataFrame:
    """Mean stamina per team, with the substitution alert."""
    out = m.groupBy("match_id", "player_equipo").agg(
        F.count("estamina_actual").alias("jugadores"),
        avg_tenths("estamina_actual").alias("estamina_media"),
    )
    return out.withColumn("alerta_fatiga", F.col("estamina_media") < F.lit(alert_below))


def most_tired(m: DataFrame) -> DataFrame:
    """Lowest current stamina per match (arg-min, ties by player keys).

    The minimum per match is a hash aggregate (one row per match); only the
    rows that reach it are joined back (AQE broadcasts the per-match side
    after measuring it) and the string-valued arg-min, which Spark can only
    sort-aggregate, runs over those few tied rows instead of every row."""
    known = m.filter(F.col("estamina_actual").isNotNull())
    lows = known.groupBy("match_id").agg(F.min("estamina_actual").alias("_low"))
    tied = known.join(lows, known["match_id"].eqNullSafe(lows["match_id"])
                      & (known["estamina_actual"] == lows["_low"]), "left_semi")
    pick = F.struct("player_id", "player_nombre", "player_equipo", "player_posicion", "estamina_actual")
    order = F.struct("player_id", "player_equipo", "player_nombre", "player_posicion")
    return (tied.groupBy("match_id").agg(F.min_by(pick, order).alias("t"))
                .select("match_id", "t.*"))


def _zone_sums(m: DataFrame) -> DataFrame:
    return m.groupBy("match_id", "player_equipo").agg(
        *[F.sum(f"eventos_zona_{z}").alias(z) for z in ZONES])


def zone_share(m: DataFrame) -> DataFrame:
    """Pie chart: events per pitch third and team, with percentages."""
    s = _zone_sums(m).withColumn("total", sum((F.col(z) for z in ZONES[1:]), F.col(ZONES[0])))
    return s.select("match_id", "player_equipo",
                    *[F.col(z).alias(f"eventos_{z}") for z in ZONES], "total",
                    *[pct(z, "total").alias(f"pct_{z}") for z in ZONES])


def zone_heatmap(m: DataFrame) -> DataFrame:
    """Heatmap: the same counts in long form (match, team, zone, events)."""
    return _zone_sums(m).unpivot(["match_id", "player_equipo"], ZONES, "zona", "eventos")


def goals_by_player(m: DataFrame) -> DataFrame:
    return m.groupBy("player_id", "player_nombre").agg(
        F.count(F.lit(1)).alias("partidos"),
        F.sum("goles").alias("goles"),
        F.sum("tiros").alias("tiros"),
    )


def pass_efficiency(m: DataFrame) -> DataFrame:
    """Pass efficiency per player; ``eficiencia_pase_real`` also counts
    failed passes (published as losses) as attempts."""
    s = m.groupBy("player_id", "player_nombre").agg(
        F.sum("pases_intentados").alias("pases_intentados"),
        F.sum("pases_acertados").alias("pases_acertados"),
        F.sum("perdidas").alias("perdidas"),
    )
    return s.select("*",
                    pct("pases_acertados", "pases_intentados").alias("eficiencia_pase"),
                    pct("pases_acertados", F.col("pases_intentados") + F.col("perdidas"))
                    .alias("eficiencia_pase_real"))


def pass_loss_ratio(m: DataFrame) -> DataFrame:
    """Completed passes against losses, per match and team."""
    s = m.groupBy("match_id", "player_equipo").agg(
        F.sum("pases_acertados").alias("pases_acertados"),
        F.sum("perdidas").alias("perdidas"),
    )
    return s.select("*",
                    F.when(F.col("perdidas") > 0, F.col("pases_acertados") / F.col("perdidas"))
                    .alias("ratio_pases_perdidas"),
                    pct("pases_acertados", F.col("pases_acertados") + F.col("perdidas"))
                    .alias("pct_posesion_conservada"))


def fatigue_efficiency(m: DataFrame) -> DataFrame:
    """Who runs more yet is less tired: metres per stamina point spent, and
    a flag for players above their team's mean distance *and* stamina."""
    team = m.groupBy("match_id", "player_equipo").agg(
        avg_tenths("distancia_m").alias("distancia_media_equipo"),
        avg_tenths("estamina_actual").alias("estamina_media_equipo"),
    )
    spent = F.lit(100.0) - F.col("estamina_actual")
    team = team.withColumnsRenamed({"match_id": "_match", "player_equipo": "_team"})
    j = m.join(team, m["match_id"].eqNullSafe(team["_match"]) & m["player_equipo"].eqNullSafe(team["_team"]))
    return j.select(
        *METRIC_KEYS, "distancia_m", "estamina_actual",
        F.when(spent > 0, F.col("distancia_m") / spent).alias("metros_por_punto"),
        "distancia_media_equipo", "estamina_media_equipo",
        ((F.col("distancia_m") > F.col("distancia_media_equipo"))
         & (F.col("estamina_actual") > F.col("estamina_media_equipo"))).alias("mejor_fisico"),
    )


def stamina_rank(m: DataFrame) -> DataFrame:
    """Rank by stamina within the match, most tired first (nulls last)."""
    base = m.select(*METRIC_KEYS, "estamina_actual")
    return rank_by_histogram(base, ["match_id"], "estamina_actual", True, "ranking_estamina")


def goals_ranking(m: DataFrame) -> DataFrame:
    """Goals ranking per match, players without goals included."""
    base = m.select("match_id", "player_id", "player_nombre", "player_equipo", "goles")
    return rank_by_histogram(base, ["match_id"], "goles", False, "ranking_goles")


def top_scorers(m: DataFrame, k: int = 5) -> DataFrame:
    """The search request: top k by goals with six fields."""
    return (m.orderBy(F.col("goles").desc(), *ROW_ORDER).limit(k)
             .select("player_nombre", "player_equipo", "goles", "tiros",
                     "eficiencia_tiro", "estamina_actual"))


def tired_players(m: DataFrame) -> DataFrame:
    """Substitution candidates: stamina ascending."""
    return (m.select("match_id", "player_id", "player_nombre", "player_equipo", "estamina_actual")
             .orderBy(F.col("estamina_actual").asc_nulls_last(), *ROW_ORDER[:3]))


def scorers(m: DataFrame) -> DataFrame:
    """Scorers table: goals > 0, descending."""
    return (m.filter(F.col("goles") > 0)
             .select("match_id", "player_id", "player_nombre", "player_equipo", "goles", "tiros")
             .orderBy(F.col("goles").desc(), *ROW_ORDER[:3]))


def stamina_top5_other(m: DataFrame, k: int = 5) -> DataFrame:
    """k most tired players per match plus an 'Other' bar with the mean of
    the rest. Only k rows per match are ever windowed (WindowGroupLimit);
    'Other' comes from match totals minus the top-k totals."""
    known = m.filter(F.col("estamina_actual").isNotNull())
    w = Window.partitionBy("match_id").orderBy("estamina_actual", *ROW_ORDER[1:])
    top = known.withColumn("puesto", F.row_number().over(w)).filter(F.col("puesto") <= k)
    totals = known.groupBy("match_id").agg(
        F.sum(tenths("estamina_actual")).alias("s"), F.count(F.lit(1)).alias("n"))
    top_tot = top.groupBy("match_id").agg(
        F.sum(tenths("estamina_actual")).alias("s_top"), F.count(F.lit(1)).alias("n_top"))
    rest_n = F.col("n") - F.col("n_top")
    top_tot = top_tot.withColumnRenamed("match_id", "_match")
    other = (totals.join(top_tot, totals["match_id"].eqNullSafe(top_tot["_match"])).filter(rest_n > 0)
             .select("match_id", F.lit(k + 1).cast("bigint").alias("puesto"),
                     F.lit("Other").alias("jugador"),
                     ((F.col("s") - F.col("s_top")) / (F.lit(10.0) * rest_n)).alias("estamina")))
    bars = top.select("match_id", F.col("puesto").cast("bigint").alias("puesto"),
                      F.col("player_nombre").alias("jugador"),
                      F.col("estamina_actual").alias("estamina"))
    return bars.unionByName(other)


def top_distance(m: DataFrame, k: int = 5) -> DataFrame:
    """Top k players by mean distance per match."""
    s = m.groupBy("player_id", "player_nombre").agg(
        avg_tenths("distancia_m").alias("distancia_media"))
    return s.orderBy(F.col("distancia_media").desc_nulls_last(), "player_id", "player_nombre").limit(k)
