from pyspark.sql import types as T

from touchline.schemas import EVENT_SCHEMA

SF_SMALL = "/root/testdata/sf0.001"

BASE = {"match_id": "m1", "player_id": "7", "player_nombre": "P7", "player_equipo": "A",
        "player_posicion": "CM", "tipo": "posicion", "timestamp": 2.0, "x": 50.0, "y": 30.0,
        "speed_jugador": 1.0, "estamina": 99.0, "ball_x": 52.5, "ball_y": 34.0,
        "ball_speed": 0.0, "action": None, "is_successful": None, "event_id": None}


def events_df(spark, rows):
    """Event rows from dicts overriding BASE (EVENT_SCHEMA column order)."""
    full = [{**BASE, **r} for r in rows]
    names = [f.name for f in EVENT_SCHEMA.fields]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in full], EVENT_SCHEMA)


def by_key(df, *key):
    return {tuple(r[k] for k in key): r.asDict() for r in df.collect()}


TEXT = T.StructType([T.StructField("value", T.StringType())])
