"""Hand-written rows (FIXTURES.md §4) for zones, parsing and the metrics."""

import itertools
import json

from pyspark.sql import functions as F

from helpers import TEXT, by_key, events_df
from touchline.functions.columns import pct, safe_int, zone_of
from touchline.operators.metrics import player_metrics
from touchline.sources.events import parse_events, split_rejects


def test_zone_borders(spark):
    df = spark.createDataFrame([(35.0,), (35.01,), (70.0,), (70.01,), (None,)], "x double")
    got = [r.z for r in df.select(zone_of("x").alias("z")).collect()]
    assert got == ["defensa", "medio", "medio", "ataque", "ataque"]


def test_malformed_and_wrong_typed_messages(spark):
    raw = spark.createDataFrame([("not json",), ("{}",), (None,),
                                 ('{"timestamp":"bad","x":3}',)], TEXT)
    rows = parse_events(raw).collect()
    assert all(r.match_id is None for r in rows)
    assert all(v is None for v in rows[0].asDict().values())
    assert rows[3].timestamp is None and rows[3].x == 3.0
    good, rejects = split_rejects(parse_events(raw))
    assert good.count() == 0 and rejects.count() == 4


def test_faithful_mode_keeps_null_group(spark):
    raw = spark.createDataFrame([("not json",)], TEXT)
    m = player_metrics(parse_events(raw)).collect()
    assert len(m) == 1 and m[0].match_id is None and m[0].eventos_zona_ataque == 1


def test_zero_denominators_and_null_speed(spark):
    ev = events_df(spark, [{"speed_jugador": None}, {"speed_jugador": None, "timestamp": 4.0}])
    r = player_metrics(ev).collect()[0]
    assert r.eficiencia_pase == 0.0 and r.eficiencia_tiro == 0.0
    assert r.distancia_m is None


def test_latest_is_order_independent(spark):
    # stamina 90@t4, 95@t2, null@t6, then (a later batch) 93@t3 -> latest is 90
    rows = [{"timestamp": 4.0, "estamina": 90.0}, {"timestamp": 2.0, "estamina": 95.0},
            {"timestamp": 6.0, "estamina": None}, {"timestamp": 3.0, "estamina": 93.0}]
    for perm in (rows, rows[::-1], rows[1:] + rows[:1]):
        ev = events_df(spark, perm).repartition(3)
        assert player_metrics(ev).collect()[0].estamina_actual == 90.0


def test_tiebreak_at_same_timestamp(spark):
    rows = [{"timestamp": 4.0, "x": 10.0, "event_id": 2}, {"timestamp": 4.0, "x": 20.0, "event_id": 1}]
    assert player_metrics(events_df(spark, rows)).collect()[0].ultima_x == 10.0


def test_latest_within_one_millisecond_and_at_one_time(spark):
    # 10.0001 s and 10.0009 s fall into one millisecond; without event ids the
    # later one counts, and at exactly one time the largest value does
    near = [{"timestamp": 10.0001, "estamina": 1.0}, {"timestamp": 10.0009, "estamina": 2.0}]
    same = [{"timestamp": 10.0, "estamina": 3.0}, {"timestamp": 10.0, "estamina": 1.0}, {"timestamp": 10.0, "estamina": 2.0}]
    for rows, want in ((near, 2.0), (same, 3.0)):
        for perm in itertools.permutations(rows):
            ev = events_df(spark, list(perm)).coalesce(1)
            assert player_metrics(ev).collect()[0].estamina_actual == want
            assert player_metrics(ev.drop("event_id")).collect()[0].estamina_actual == want


def test_pass_counts(spark):
    rows = [{"tipo": "accion", "action": "pase", "is_successful": v} for v in (True, False, None)]
    r = player_metrics(events_df(spark, rows)).collect()[0]
    assert (r.pases_intentados, r.pases_acertados, r.eficiencia_pase) == (3, 1, 33.3)


def test_goal_and_shot_efficiency(spark):
    rows = [{"tipo": "accion", "action": a, "timestamp": float(i)}
            for i, a in enumerate(["tiro", "tiro", "gol", "tiro", "parada", "perdida", "recuperacion"])]
    r = player_metrics(events_df(spark, rows)).collect()[0]
    assert (r.tiros, r.goles, r.paradas, r.perdidas, r.recuperaciones) == (3, 1, 1, 1, 1)
    assert r.eficiencia_tiro == 33.3


def test_same_player_in_both_teams(spark):
    rows = [{"player_equipo": "A"}, {"player_equipo": "B"}]
    m = by_key(player_metrics(events_df(spark, rows)), "player_equipo")
    assert set(m) == {("A",), ("B",)}


def test_distance_and_zones(spark):
    rows = [{"speed_jugador": 1.25, "x": 10.0}, {"speed_jugador": 2.5, "x": 50.0, "timestamp": 4.0},
            {"speed_jugador": 0.0, "x": 90.0, "timestamp": 6.0}]
    r = player_metrics(events_df(spark, rows)).collect()[0]
    assert r.distancia_m == 7.5
    assert (r.eventos_zona_defensa, r.eventos_zona_medio, r.eventos_zona_ataque) == (1, 1, 1)
    assert (r.ultima_x, r.ultima_y) == (90.0, 30.0)


def test_safe_int_and_pct(spark):
    df = spark.createDataFrame([("85.0",), ("",), (" 85 ",), ("x",), (None,)], "v string")
    assert [r.s for r in df.select(safe_int("v").alias("s")).collect()] == [50, 50, 85, 50, 50]
    one = spark.range(1).select(pct(F.lit(1), F.lit(3)).alias("a"), pct(F.lit(1), F.lit(0)).alias("b"))
    assert one.collect()[0].asDict() == {"a": 33.3, "b": 0.0}


def test_unknown_and_missing_keys(spark):
    msg = json.dumps({"match_id": "m", "player_id": "1", "extra": 5, "x": 40})
    r = parse_events(spark.createDataFrame([(msg,)], TEXT)).collect()[0]
    assert r.x == 40.0 and r.y is None and "extra" not in r.asDict()


def test_extreme_timestamps_do_not_fail(spark):
    rows = [{"timestamp": 1e300, "estamina": 10.0, "event_id": 1},
            {"timestamp": -1e300, "estamina": 20.0, "event_id": 2},
            {"timestamp": float("nan"), "estamina": 30.0, "event_id": 3},
            {"timestamp": 5.0, "estamina": 40.0, "event_id": 4}]
    r = player_metrics(events_df(spark, rows)).collect()[0]
    assert r.estamina_actual == 10.0


def test_relative_zones_mirror_team_b(spark):
    rows = [{"player_equipo": "A", "x": 10.0}, {"player_equipo": "B", "x": 10.0, "player_id": "8"}]
    m = by_key(player_metrics(events_df(spark, rows), relative_zones=True), "player_equipo")
    assert m[("A",)]["eventos_zona_defensa"] == 1 and m[("B",)]["eventos_zona_ataque"] == 1
    faithful = by_key(player_metrics(events_df(spark, rows)), "player_equipo")
    assert faithful[("B",)]["eventos_zona_defensa"] == 1


def test_real_pass_efficiency_counts_losses(spark):
    rows = [{"tipo": "accion", "action": "pase", "is_successful": True, "timestamp": 2.0},
            {"tipo": "accion", "action": "perdida", "is_successful": False, "timestamp": 4.0}]
    r = player_metrics(events_df(spark, rows), real_pass=True).collect()[0]
    assert (r.eficiencia_pase, r.eficiencia_pase_real) == (100.0, 50.0)


def test_time_order_key_orders_like_the_pair(spark):
    import random

    from touchline.functions.columns import time_order_key
    rnd = random.Random(5)
    rows = [(rnd.choice([rnd.uniform(-1e6, 1e6), float(rnd.randint(0, 100)), 0.0]),
             rnd.choice([None, rnd.randint(-2 ** 63, 2 ** 63 - 1), rnd.randint(-5, 5)]))
            for _ in range(300)]
    df = spark.createDataFrame(rows, "ts double, tb long")
    got = [(r.ts, r.tb) for r in df.orderBy(time_order_key("ts", "tb"), "ts", "tb").collect()]

    def pair(r):
        return (r[0], -2 ** 63 if r[1] is None else r[1], r[1] is not None)
    assert [pair(r) for r in got] == sorted(pair(r) for r in got)


def test_messages_as_the_original_producer_writes_them(spark):
    # json.dumps(ev, ensure_ascii=False): spaced separators, int timestamp,
    # non-ASCII names, null action fields, no event_id
    base = {"match_id": "9f1c", "timestamp": 2, "tipo": "posicion", "player_id": "231747",
            "player_nombre": "Thomas Müller", "player_equipo": "A", "player_posicion": "CAM",
            "x": 48.21, "y": 30.5, "speed_jugador": 3.41, "estamina": 99.12, "ball_x": 52.5,
            "ball_y": 34.0, "ball_speed": 0.0, "action": None, "is_successful": None}
    later = {**base, "timestamp": 4, "x": 71.0, "estamina": 98.4}
    act = {**later, "tipo": "accion", "speed_jugador": 0.0, "action": "pase", "is_successful": True}
    msgs = [json.dumps(m, ensure_ascii=False) for m in (later, act, base)]  # out of order
    r = player_metrics(parse_events(spark.createDataFrame([(m,) for m in msgs], TEXT))).collect()[0]
    assert r.player_nombre == "Thomas Müller"
    assert (r.distancia_m, r.estamina_actual, r.ultima_x) == (13.6, 98.4, 71.0)
    assert (r.pases_intentados, r.pases_acertados, r.eficiencia_pase) == (1, 1, 100.0)
    assert (r.eventos_zona_medio, r.eventos_zona_ataque) == (1, 2)


def test_published_values_can_be_rounded(spark):
    from touchline.sources.events import encode_events
    ev = events_df(spark, [{"x": 48.2149, "estamina": 99.999, "speed_jugador": 1.005}])
    r = parse_events(encode_events(ev, round_digits=2)).collect()[0]
    assert (r.x, r.estamina, r.speed_jugador) == (48.21, 100.0, 1.0)
    assert parse_events(encode_events(ev)).collect()[0].x == 48.2149
