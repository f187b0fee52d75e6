"""Properties of the metrics on the driver tables, and the quality checks on
clean, simulator-shaped cycles (which must report nothing)."""

from pyspark.sql import functions as F

from helpers import SF_SMALL
from helpers import events_df
from touchline.functions.columns import iso_utc
from touchline.operators import quality
from touchline.operators.metrics import player_metrics
from touchline.plans import dashboards as D
from touchline.sources.events import events_from_table


def test_metric_properties_on_driver_tables(spark):
    ev = events_from_table(spark, SF_SMALL)
    m = player_metrics(ev)
    per_player = ev.groupBy("match_id", "player_id", "player_equipo").agg(F.count(F.lit(1)).alias("n"))
    j = m.join(per_player, ["match_id", "player_id", "player_equipo"])
    zones = F.col("eventos_zona_defensa") + F.col("eventos_zona_medio") + F.col("eventos_zona_ataque")
    assert j.filter(zones != F.col("n")).count() == 0
    assert m.filter(F.col("pases_acertados") > F.col("pases_intentados")).count() == 0
    assert m.filter(~F.col("eficiencia_pase").between(0, 100)).count() == 0
    assert m.agg(F.sum("eventos_zona_defensa") + F.sum("eventos_zona_medio")
                 + F.sum("eventos_zona_ataque")).first()[0] == ev.count()


def _clean_match(spark):
    """Two cycles of a clean match: 4 players, position rows every cycle,
    then paired actions (pass; loss + recovery; shot + goal; shot + save)."""
    rows, eid = [], 0
    players = [("1", "A", "GK"), ("2", "A", "ST"), ("3", "B", "GK"), ("4", "B", "CB")]
    stamina = {p[0]: 100.0 for p in players}
    for cycle in (1, 2):
        t = 2.0 * cycle
        for pid, team, pos in players:
            stamina[pid] -= 0.5
            eid += 1
            rows.append({"event_id": eid, "timestamp": t, "player_id": pid, "player_equipo": team,
                         "player_posicion": pos, "x": 10.0 * int(pid), "y": 30.0,
                         "estamina": stamina[pid], "speed_jugador": 1.5})
        acts = ([("2", "A", "tiro", True), ("2", "A", "gol", True), ("4", "B", "perdida", False),
                 ("2", "A", "recuperacion", True)] if cycle == 1 else
                [("4", "B", "tiro", False), ("1", "A", "parada", True), ("2", "A", "pase", True)])
        for pid, team, act, ok in acts:
            eid += 1
            rows.append({"event_id": eid, "timestamp": t, "player_id": pid, "player_equipo": team,
                         "tipo": "accion", "action": act, "is_successful": ok,
                         "x": 10.0 * int(pid), "y": 30.0, "estamina": stamina[pid],
                         "speed_jugador": 0.0})
    return events_df(spark, rows)


def test_quality_checks_pass_on_clean_cycles(spark):
    ev = _clean_match(spark)
    assert quality.event_pairing(ev).count() == 0
    assert quality.stamina_monotone(ev).count() == 0
    b = quality.event_bounds(ev).first()
    assert (b.fuera_x, b.fuera_y, b.estamina_fuera, b.exceso_max_x) == (0, 0, 0, 0.0)
    m = player_metrics(ev)
    assert m.filter(F.col("goles") > F.col("tiros")).count() == 0
    assert m.filter(~F.col("eficiencia_tiro").between(0, 100)).count() == 0


def test_pairing_flags_violations(spark):
    ev = events_df(spark, [{"tipo": "accion", "action": "gol"},
                           {"tipo": "accion", "action": "perdida", "player_id": "9"}])
    r = quality.event_pairing(ev, cycle_seconds=2.0).first()
    assert (r.goles_sin_tiro, r.perdidas, r.recuperaciones) == (1, 1, 0)


def test_nearest_to_ball_and_exclusions(spark):
    rows = [{"player_id": "1", "x": 50.0, "y": 34.0, "player_posicion": "GK"},
            {"player_id": "2", "x": 60.0, "y": 34.0},
            {"player_id": "3", "x": 45.0, "y": 34.0}]  # ball at 52.5, 34
    ev = events_df(spark, rows)
    assert quality.nearest_to_ball(ev).first().player_id == "1"
    assert quality.nearest_to_ball(ev, exclude_goalkeepers=True).first().player_id == "2"
    assert quality.nearest_to_ball(ev, exclude_player="1").first().player_id == "2"


def test_top5_other_and_ranks(spark):
    rows = [{"player_id": str(i), "player_nombre": f"P{i}", "estamina": float(90 - i)}
            for i in range(7)]
    m = player_metrics(events_df(spark, rows))
    bars = D.stamina_top5_other(m).orderBy("puesto").collect()
    assert [b.jugador for b in bars] == ["P6", "P5", "P4", "P3", "P2", "Other"]
    assert bars[-1].estamina == 89.5
    few = player_metrics(events_df(spark, rows[:3]))
    assert D.stamina_top5_other(few).count() == 3  # no 'Other' bar when nobody is left
    ties = player_metrics(events_df(spark, [{"player_id": "a", "estamina": 50.0},
                                            {"player_id": "b", "estamina": 50.0},
                                            {"player_id": "c", "estamina": 40.0},
                                            {"player_id": "d", "estamina": None}]))
    r = {x.player_id: x.ranking_estamina for x in D.stamina_rank(ties).collect()}
    assert r == {"c": 1, "a": 2, "b": 2, "d": 4}


def test_team_stamina_alert_and_kpi_cube(spark):
    rows = [{"player_id": "1", "estamina": 50.0}, {"player_id": "2", "estamina": 65.0},
            {"player_id": "3", "estamina": 90.0, "player_equipo": "B"}]
    m = player_metrics(events_df(spark, rows))
    t = {r.player_equipo: (r.estamina_media, r.alerta_fatiga) for r in D.team_stamina(m).collect()}
    assert t == {"A": (57.5, True), "B": (90.0, False)}
    cube = D.kpi_cube(m)
    total = cube.filter(F.col("nivel") == 3).first()
    assert total.jugadores == 3 and total.player_equipo is None


def test_iso_utc_ignores_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        ts = F.to_timestamp(F.lit("2024-01-31 19:00:00"))  # 19:00 New York = 00:00 UTC next day
        got = spark.range(1).select(iso_utc(ts).alias("t")).first().t
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == "2024-02-01T00:00:00Z"


def test_filtered_kpis_match_and_player_filters(spark):
    rows = [{"match_id": "m1", "player_id": "1", "player_nombre": "A1", "tipo": "accion",
             "action": "gol"},
            {"match_id": "m2", "player_id": "2", "player_nombre": "B2", "tipo": "accion",
             "action": "tiro"}]
    m = player_metrics(events_df(spark, rows))
    one = D.filtered_kpis(m, match="m1").collect()
    assert [(r.match_id, r.goles, r.total_tiros) for r in one] == [("m1", 1, 0)]
    assert D.filtered_kpis(m, player="B2").first().total_tiros == 1
