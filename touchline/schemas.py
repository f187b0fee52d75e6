"""Schemas and domain constants."""

from pyspark.sql import types as T

# Fixed values that must equal the original job's for right results:
# event fields and types, pitch size, zone cuts, cycle length, formation,
# position groups, eligibility threshold, default for unparsable ints.
EVENT_FIELDS = [
    ("match_id", T.StringType()),
    ("timestamp", T.DoubleType()),
    ("tipo", T.StringType()),
    ("player_id", T.StringType()),
    ("player_nombre", T.StringType()),
    ("player_equipo", T.StringType()),
    ("player_posicion", T.StringType()),
    ("x", T.DoubleType()),
    ("y", T.DoubleType()),
    ("speed_jugador", T.DoubleType()),
    ("estamina", T.DoubleType()),
    ("ball_x", T.DoubleType()),
    ("ball_y", T.DoubleType()),
    ("ball_speed", T.DoubleType()),
    ("action", T.StringType()),
    ("is_successful", T.BooleanType()),
]
PITCH_LENGTH = 105.0
PITCH_WIDTH = 68.0
PITCH_X_BOUNDS = (0.5, 104.5)
PITCH_Y_BOUNDS = (0.5, 67.5)
ZONE_CUTS = (35.0, 70.0)
CYCLE_SECONDS = 2.0
OVR_MIN = 65
SAFE_INT_DEFAULT = 50
POSITION_GROUPS = {
    "GK": ["GK"],
    "DEF": ["CB", "RB", "LB", "RWB", "LWB"],
    "MID": ["CDM", "CM", "CAM", "RM", "LM"],
    "FWD": ["ST", "CF", "LW", "RW", "SS"],
}
FORMATION = [("GK", 1), ("DEF", 4), ("MID", 4), ("FWD", 2)]
ROSTER_COLUMNS = {
    "ID": "id",
    "Name": "nombre",
    "GENDER": "genero",
    "PAC": "velocidad",
    "PAS": "pase",
    "SHO": "tiro",
    "PHY": "resistencia",
    "DEF": "defensa",
    "Position": "posicion",
    "OVR": "media",
    "Team": "equipo",
}
ROSTER_REQUIRED = ["id", "nombre", "velocidad", "pase", "tiro", "resistencia", "defensa"]
ACTIONS = ["pase", "perdida", "recuperacion", "tiro", "gol", "parada"]
ZONES = ["defensa", "medio", "ataque"]
METRIC_KEYS = ["match_id", "player_id", "player_nombre", "player_equipo", "player_posicion"]

# Optional extension field: a per-event sequence number used only to break
# ties between events of one player at the same timestamp.
TIEBREAK_FIELD = "event_id"

EVENT_SCHEMA = T.StructType(
    [T.StructField(n, t, True) for n, t in EVENT_FIELDS]
    + [T.StructField(TIEBREAK_FIELD, T.LongType(), True)]
)
