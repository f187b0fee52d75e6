"""Oracle SQL (DuckDB dialect) for each registered query.

These strings are the correctness oracle: the same question asked of the
same parquet tables by a different engine. Column names match the Spark
results exactly. Shared CTEs below mirror the two test-data adapters.
"""

from __future__ import annotations

# --- adapters --------------------------------------------------------------

EV = """ev AS (
  SELECT
    'M' || CAST((day(ts) - 1) // 7 AS VARCHAR) AS match_id,
    CAST(((day(ts) - 1) % 7) * 86400 + hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS DOUBLE) AS timestamp,
    CASE WHEN event_type = 'view' THEN 'posicion' ELSE 'accion' END AS tipo,
    CAST(user_id AS VARCHAR) AS player_id,
    'Player ' || CAST(user_id AS VARCHAR) AS player_nombre,
    CASE WHEN user_id % 2 = 0 THEN 'A' ELSE 'B' END AS player_equipo,
    CASE WHEN user_id % 11 = 0 THEN 'GK' WHEN user_id % 11 <= 4 THEN 'CB'
         WHEN user_id % 11 <= 8 THEN 'CM' ELSE 'ST' END AS player_posicion,
    CASE WHEN event_id % 97 = 0 THEN NULL ELSE (event_id * 37 % 1051) / 10.0::DOUBLE END AS x,
    (event_id * 53 % 681) / 10.0::DOUBLE AS y,
    CASE WHEN event_type = 'view' THEN (event_id * 29 % 1000) / 100.0::DOUBLE ELSE 0.0::DOUBLE END AS speed_jugador,
    CASE WHEN event_id % 89 = 0 THEN NULL ELSE (10000 - event_id * 7919 % 10001) / 100.0::DOUBLE END AS estamina,
    (event_id * 41 % 1051) / 10.0::DOUBLE AS ball_x,
    (event_id * 59 % 681) / 10.0::DOUBLE AS ball_y,
    (event_id * 31 % 3500) / 100.0::DOUBLE AS ball_speed,
    CASE WHEN event_type = 'click' THEN 'pase'
         WHEN event_type = 'error' THEN CASE WHEN event_id % 2 = 0 THEN 'perdida' ELSE 'recuperacion' END
         WHEN event_type = 'signup' THEN 'tiro'
         WHEN event_type = 'purchase' THEN CASE WHEN event_id % 3 = 0 THEN 'parada' ELSE 'gol' END
    END AS action,
    CASE WHEN event_type = 'error' THEN event_id % 2 = 1
         WHEN event_type = 'purchase' THEN true
         WHEN event_type IN ('click', 'signup') THEN event_id % 4 <> 0
    END AS is_successful,
    event_id
  FROM events)"""

ZEV = """zev AS (
  SELECT *, CASE WHEN x <= 35 THEN 'defensa' WHEN x <= 70 THEN 'medio' ELSE 'ataque' END AS zona
  FROM ev)"""

M = """magg AS (
  SELECT match_id, player_id, player_nombre, player_equipo, player_posicion,
    round(sum(speed_jugador) * 2.0::DOUBLE, 1) AS distancia_m,
    round(arg_max(estamina, (timestamp, event_id)) FILTER (WHERE estamina IS NOT NULL), 1) AS estamina_actual,
    round(arg_max(x, (timestamp, event_id)) FILTER (WHERE x IS NOT NULL), 2) AS ultima_x,
    round(arg_max(y, (timestamp, event_id)) FILTER (WHERE y IS NOT NULL), 2) AS ultima_y,
    count(*) FILTER (WHERE action = 'pase') AS pases_intentados,
    count(*) FILTER (WHERE action = 'pase' AND is_successful = true) AS pases_acertados,
    count(*) FILTER (WHERE action = 'tiro') AS tiros,
    count(*) FILTER (WHERE action = 'gol') AS goles,
    count(*) FILTER (WHERE action = 'parada') AS paradas,
    count(*) FILTER (WHERE action = 'perdida') AS perdidas,
    count(*) FILTER (WHERE action = 'recuperacion') AS recuperaciones,
    count(*) FILTER (WHERE zona = 'defensa') AS eventos_zona_defensa,
    count(*) FILTER (WHERE zona = 'medio') AS eventos_zona_medio,
    count(*) FILTER (WHERE zona = 'ataque') AS eventos_zona_ataque
  FROM zev
  GROUP BY match_id, player_id, player_nombre, player_equipo, player_posicion),
m AS (
  SELECT *,
    round(CASE WHEN pases_intentados > 0 THEN pases_acertados::DOUBLE / pases_intentados * 100 ELSE 0.0 END, 1) AS eficiencia_pase,
    round(CASE WHEN tiros > 0 THEN goles::DOUBLE / tiros * 100 ELSE 0.0 END, 1) AS eficiencia_tiro
  FROM magg)"""


def with_metrics(body: str) -> str:
    return f"WITH {EV},\n{ZEV},\n{M}\n{body}"


def with_events(body: str) -> str:
    return f"WITH {EV},\n{ZEV}\n{body}"


METRIC_COLS = """match_id, player_id, player_nombre, player_equipo, player_posicion,
  distancia_m, estamina_actual, ultima_x, ultima_y, pases_intentados, pases_acertados,
  tiros, goles, paradas, perdidas, recuperaciones, eventos_zona_defensa,
  eventos_zona_medio, eventos_zona_ataque, eficiencia_pase, eficiencia_tiro"""


SQL: dict[str, str] = {}

SQL["player_metrics"] = with_metrics(f"SELECT {METRIC_COLS} FROM m")


def avg_t(c: str) -> str:
    return (f"CASE WHEN count({c}) > 0 THEN sum(round({c} * 10)::BIGINT) "
            f"/ (10.0::DOUBLE * count({c})) END")


def pct_sql(n: str, d: str) -> str:
    return f"round(CASE WHEN ({d}) > 0 THEN ({n})::DOUBLE / ({d}) * 100 ELSE 0.0 END, 1)"


KPIS = f"""SELECT match_id, count(*) AS jugadores_activos, sum(tiros)::BIGINT AS total_tiros,
  sum(pases_acertados)::BIGINT AS pases_acertados, sum(perdidas)::BIGINT AS perdidas,
  sum(goles)::BIGINT AS goles, sum(recuperaciones)::BIGINT AS recuperaciones,
  {avg_t('estamina_actual')} AS estamina_media
FROM m {{where}} GROUP BY match_id"""

SQL["match_kpis"] = with_metrics(KPIS.format(where=""))
SQL["filtered_kpis"] = with_metrics(
    KPIS.format(where="WHERE player_equipo = 'A' AND player_posicion = 'CM'"))

SQL["kpi_cube"] = with_metrics("""SELECT match_id, player_equipo, player_posicion,
  GROUPING(match_id, player_equipo, player_posicion)::BIGINT AS nivel,
  count(*) AS jugadores, sum(tiros)::BIGINT AS tiros, sum(goles)::BIGINT AS goles,
  sum(pases_acertados)::BIGINT AS pases_acertados, sum(perdidas)::BIGINT AS perdidas,
  sum(recuperaciones)::BIGINT AS recuperaciones
FROM m GROUP BY GROUPING SETS ((match_id, player_equipo, player_posicion),
  (match_id, player_equipo), (match_id, player_posicion), (match_id))""")

SQL["team_stamina"] = with_metrics(f"""SELECT match_id, player_equipo,
  count(estamina_actual) AS jugadores, {avg_t('estamina_actual')} AS estamina_media,
  ({avg_t('estamina_actual')}) < 60.0 AS alerta_fatiga
FROM m GROUP BY match_id, player_equipo""")

SQL["most_tired"] = with_metrics("""SELECT match_id, player_id, player_nombre, player_equipo,
  player_posicion, estamina_actual
FROM (SELECT *, row_number() OVER (PARTITION BY match_id ORDER BY estamina_actual,
        player_id, player_equipo, player_nombre, player_posicion) AS rn
      FROM m WHERE estamina_actual IS NOT NULL) WHERE rn = 1""")

ZS = """, zs AS (SELECT match_id, player_equipo, sum(eventos_zona_defensa)::BIGINT AS defensa,
  sum(eventos_zona_medio)::BIGINT AS medio, sum(eventos_zona_ataque)::BIGINT AS ataque
  FROM m GROUP BY match_id, player_equipo)"""

SQL["zone_share"] = with_metrics(ZS + f"""
SELECT match_id, player_equipo, defensa AS eventos_defensa, medio AS eventos_medio,
  ataque AS eventos_ataque, defensa + medio + ataque AS total,
  {pct_sql('defensa', 'defensa + medio + ataque')} AS pct_defensa,
  {pct_sql('medio', 'defensa + medio + ataque')} AS pct_medio,
  {pct_sql('ataque', 'defensa + medio + ataque')} AS pct_ataque
FROM zs""")

SQL["zone_heatmap"] = with_metrics(ZS + """
SELECT match_id, player_equipo, 'defensa' AS zona, defensa AS eventos FROM zs
UNION ALL SELECT match_id, player_equipo, 'medio', medio FROM zs
UNION ALL SELECT match_id, player_equipo, 'ataque', ataque FROM zs""")

SQL["goals_by_player"] = with_metrics("""SELECT player_id, player_nombre, count(*) AS partidos,
  sum(goles)::BIGINT AS goles, sum(tiros)::BIGINT AS tiros
FROM m GROUP BY player_id, player_nombre""")

SQL["pass_efficiency"] = with_metrics(f"""SELECT *,
  {pct_sql('pases_acertados', 'pases_intentados')} AS eficiencia_pase,
  {pct_sql('pases_acertados', 'pases_intentados + perdidas')} AS eficiencia_pase_real
FROM (SELECT player_id, player_nombre, sum(pases_intentados)::BIGINT AS pases_intentados,
        sum(pases_acertados)::BIGINT AS pases_acertados, sum(perdidas)::BIGINT AS perdidas
      FROM m GROUP BY player_id, player_nombre)""")

SQL["pass_loss_ratio"] = with_metrics(f"""SELECT *,
  CASE WHEN perdidas > 0 THEN pases_acertados::DOUBLE / perdidas END AS ratio_pases_perdidas,
  {pct_sql('pases_acertados', 'pases_acertados + perdidas')} AS pct_posesion_conservada
FROM (SELECT match_id, player_equipo, sum(pases_acertados)::BIGINT AS pases_acertados,
        sum(perdidas)::BIGINT AS perdidas FROM m GROUP BY match_id, player_equipo)""")

SQL["fatigue_efficiency"] = with_metrics(f""", t AS (SELECT match_id, player_equipo,
    {avg_t('distancia_m')} AS distancia_media_equipo,
    {avg_t('estamina_actual')} AS estamina_media_equipo
  FROM m GROUP BY match_id, player_equipo)
SELECT m.match_id, m.player_id, m.player_nombre, m.player_equipo, m.player_posicion,
  distancia_m, estamina_actual,
  CASE WHEN 100.0::DOUBLE - estamina_actual > 0
       THEN distancia_m / (100.0::DOUBLE - estamina_actual) END AS metros_por_punto,
  distancia_media_equipo, estamina_media_equipo,
  distancia_m > distancia_media_equipo AND estamina_actual > estamina_media_equipo AS mejor_fisico
FROM m JOIN t ON m.match_id IS NOT DISTINCT FROM t.match_id AND m.player_equipo IS NOT DISTINCT FROM t.player_equipo""")

SQL["stamina_rank"] = with_metrics("""SELECT match_id, player_id, player_nombre, player_equipo,
  player_posicion, estamina_actual,
  rank() OVER (PARTITION BY match_id ORDER BY estamina_actual ASC NULLS LAST) AS ranking_estamina
FROM m""")

SQL["goals_ranking"] = with_metrics("""SELECT match_id, player_id, player_nombre, player_equipo,
  goles, rank() OVER (PARTITION BY match_id ORDER BY goles DESC NULLS LAST) AS ranking_goles
FROM m""")

SQL["top_scorers"] = with_metrics("""SELECT player_nombre, player_equipo, goles, tiros,
  eficiencia_tiro, estamina_actual
FROM m ORDER BY goles DESC, match_id, player_id, player_equipo, player_nombre, player_posicion
LIMIT 5""")

SQL["tired_players"] = with_metrics("""SELECT match_id, player_id, player_nombre, player_equipo,
  estamina_actual FROM m ORDER BY estamina_actual ASC NULLS LAST, match_id, player_id, player_equipo""")

SQL["scorers"] = with_metrics("""SELECT match_id, player_id, player_nombre, player_equipo, goles,
  tiros FROM m WHERE goles > 0 ORDER BY goles DESC, match_id, player_id, player_equipo""")

SQL["stamina_top5_other"] = with_metrics(""", k AS (SELECT *, row_number() OVER (
    PARTITION BY match_id ORDER BY estamina_actual, player_id, player_equipo, player_nombre,
    player_posicion) AS puesto FROM m WHERE estamina_actual IS NOT NULL)
SELECT match_id, puesto, player_nombre AS jugador, estamina_actual AS estamina
FROM k WHERE puesto <= 5
UNION ALL
SELECT match_id, 6::BIGINT AS puesto, 'Other' AS jugador,
  sum(round(estamina_actual * 10)::BIGINT) / (10.0::DOUBLE * count(*)) AS estamina
FROM k WHERE puesto > 5 GROUP BY match_id""")

SQL["top_distance"] = with_metrics(f"""SELECT player_id, player_nombre,
  {avg_t('distancia_m')} AS distancia_media
FROM m GROUP BY player_id, player_nombre
ORDER BY distancia_media DESC NULLS LAST, player_id, player_nombre LIMIT 5""")

SQL["event_zones"] = with_events(
    "SELECT match_id, event_id, player_id, player_equipo, x, zona FROM zev")

SQL["losses_by_zone"] = with_events("""SELECT match_id, player_equipo, zona, count(*) AS perdidas
FROM zev WHERE action = 'perdida' GROUP BY match_id, player_equipo, zona""")

SQL["nearest_to_ball"] = with_events(""", p AS (SELECT match_id,
    floor(timestamp / 3600.0::DOUBLE)::BIGINT AS ciclo, player_equipo, player_id, player_nombre,
    (x - ball_x) * (x - ball_x) + (y - ball_y) * (y - ball_y) AS distancia2
  FROM ev WHERE tipo = 'posicion')
SELECT match_id, ciclo, player_equipo, player_id, player_nombre, distancia2
FROM (SELECT *, row_number() OVER (PARTITION BY match_id, ciclo, player_equipo
        ORDER BY distancia2, player_id, player_nombre) AS rn
      FROM p WHERE distancia2 IS NOT NULL) WHERE rn = 1""")

SQL["nearest_outfield"] = SQL["nearest_to_ball"].replace(
    "WHERE tipo = 'posicion')", "WHERE tipo = 'posicion' AND player_posicion <> 'GK' AND player_id <> '7')")

# zones as seen from a team's own goal: team B's x is mirrored
_OWN_ZONE = ("CASE WHEN CASE WHEN player_equipo = 'B' THEN 105.0::DOUBLE - x ELSE x END <= 35 THEN 'defensa' "
             "WHEN CASE WHEN player_equipo = 'B' THEN 105.0::DOUBLE - x ELSE x END <= 70 THEN 'medio' ELSE 'ataque' END")
_OWN = f"zev AS (SELECT *, {_OWN_ZONE} AS zona FROM ev)"
SQL["losses_by_own_zone"] = f"""WITH {EV},\n{_OWN}
SELECT match_id, player_equipo, zona, count(*) AS perdidas
FROM zev WHERE action = 'perdida' GROUP BY match_id, player_equipo, zona"""
SQL["real_pass_metrics"] = f"""WITH {EV},\n{_OWN},\n{M}
SELECT {METRIC_COLS}, {pct_sql('pases_acertados', 'pases_intentados + perdidas')} AS eficiencia_pase_real FROM m"""

SQL["event_bounds"] = with_events("""SELECT match_id, count(*) AS eventos,
  count(*) FILTER (WHERE tipo = 'posicion' AND x IS NOT NULL AND NOT (x BETWEEN 0.5 AND 104.5)) AS fuera_x,
  count(*) FILTER (WHERE tipo = 'posicion' AND y IS NOT NULL AND NOT (y BETWEEN 0.5 AND 67.5)) AS fuera_y,
  count(*) FILTER (WHERE estamina IS NOT NULL AND NOT (estamina BETWEEN 0.0 AND 100.0)) AS estamina_fuera,
  max(CASE WHEN tipo = 'posicion' THEN abs(x - least(greatest(x, 0.5::DOUBLE), 104.5::DOUBLE)) END) AS exceso_max_x
FROM ev GROUP BY match_id""")

SQL["event_pairing"] = with_events(""", pp AS (SELECT match_id, timestamp AS ciclo, player_id,
    count(*) FILTER (WHERE action = 'gol') AS g, count(*) FILTER (WHERE action = 'tiro') AS t,
    count(*) FILTER (WHERE action = 'perdida') AS p,
    count(*) FILTER (WHERE action = 'recuperacion') AS r
  FROM ev GROUP BY match_id, timestamp, player_id),
pc AS (SELECT match_id, ciclo, count(*) FILTER (WHERE g > t) AS goles_sin_tiro,
    sum(p)::BIGINT AS perdidas, sum(r)::BIGINT AS recuperaciones
  FROM pp GROUP BY match_id, ciclo)
SELECT * FROM pc WHERE goles_sin_tiro > 0 OR perdidas <> recuperaciones""")

SQL["stamina_monotone"] = with_events(""", s AS (SELECT match_id, player_id, player_equipo,
    timestamp, event_id, estamina,
    lag(estamina) OVER (PARTITION BY match_id, player_id, player_equipo
                        ORDER BY timestamp, event_id) AS estamina_previa
  FROM ev WHERE estamina IS NOT NULL)
SELECT * FROM s WHERE estamina > estamina_previa""")

# --- roster adapter --------------------------------------------------------

POS_LIST = "['GK', 'CB', 'RB', 'LB', 'RWB', 'LWB', 'CDM', 'CM', 'CAM', 'RM', 'LM', 'ST', 'CF', 'LW', 'RW', 'SS', 'XX']"


def _raw_side(k: str) -> str:
    return f"""(CASE WHEN {k} % 50 = 3 THEN NULL ELSE 40 + {k} * 7 % 60 END)::INTEGER AS "PAC",
    (40 + {k} * 11 % 60)::INTEGER AS "PAS", (40 + {k} * 13 % 60)::INTEGER AS "SHO",
    (CASE WHEN {k} % 70 = 5 THEN NULL ELSE 40 + {k} * 17 % 60 END)::INTEGER AS "PHY",
    (40 + {k} * 19 % 60)::INTEGER AS "DEF", {POS_LIST}[{k} % 17 + 1] AS "Position",
    (50 + {k} * 3 % 45)::INTEGER AS "OVR\""""


RAW = f"""raw AS (
  SELECT c_custkey::INTEGER AS "ID", c_name AS "Name", 'M' AS "GENDER", {_raw_side('c_custkey')},
    c_mktsegment AS "Team", 'u/' || CAST(c_custkey AS VARCHAR) AS "url"
  FROM customer
  UNION ALL
  SELECT (1000000 + s_suppkey)::INTEGER, s_name, 'F', {_raw_side('s_suppkey')},
    NULL::VARCHAR, NULL::VARCHAR
  FROM supplier)"""

GROUP_SQL = """CASE WHEN trim(posicion) IN ('GK') THEN 'GK'
    WHEN trim(posicion) IN ('CB', 'RB', 'LB', 'RWB', 'LWB') THEN 'DEF'
    WHEN trim(posicion) IN ('CDM', 'CM', 'CAM', 'RM', 'LM') THEN 'MID'
    WHEN trim(posicion) IN ('ST', 'CF', 'LW', 'RW', 'SS') THEN 'FWD' END"""

CLEAN = f"""clean AS (
  SELECT "ID"::VARCHAR AS id, "Name" AS nombre, "GENDER" AS genero, "PAC"::DOUBLE AS velocidad,
    "PAS"::DOUBLE AS pase, "SHO"::DOUBLE AS tiro, "PHY"::DOUBLE AS resistencia, "DEF"::DOUBLE AS defensa,
    "Position" AS posicion, "OVR"::VARCHAR AS media, "Team" AS equipo, 100.0::DOUBLE AS estamina
  FROM raw
  WHERE "ID" IS NOT NULL AND "Name" IS NOT NULL AND "PAC" IS NOT NULL AND "PAS" IS NOT NULL
    AND "SHO" IS NOT NULL AND "PHY" IS NOT NULL AND "DEF" IS NOT NULL),
grouped AS (SELECT *, {GROUP_SQL} AS grupo FROM clean),
eligible AS (SELECT * FROM grouped WHERE grupo IS NOT NULL
    AND CASE WHEN regexp_full_match(trim(media), '[+-]?[0-9]+') THEN trim(media)::BIGINT ELSE 50 END >= 65)"""

NEED_SQL = "CASE grupo WHEN 'GK' THEN 1 WHEN 'DEF' THEN 4 WHEN 'MID' THEN 4 WHEN 'FWD' THEN 2 END"


def draft_key_sql(team: str) -> str:
    return f"md5('42|' || {team} || '|' || CAST(id AS VARCHAR))"


DRAFT = f""", t AS (SELECT id, nombre, posicion, grupo, 'A' AS equipo FROM eligible
  UNION ALL SELECT id, nombre, posicion, grupo, 'B' AS equipo FROM eligible),
r AS (SELECT equipo, grupo, row_number() OVER (PARTITION BY equipo, grupo
        ORDER BY {draft_key_sql('equipo')}, id) AS orden, id, nombre, posicion FROM t),
draft AS (SELECT * FROM r WHERE orden <= {NEED_SQL})"""


def with_roster(body: str) -> str:
    return f"WITH {RAW},\n{CLEAN}\n{body}"


RAW_COLS = '"ID", "Name", "GENDER", "PAC", "PAS", "SHO", "PHY", "DEF", "Position", "OVR", "Team", "url"'
CLEAN_COLS = ("id, nombre, genero, velocidad, pase, tiro, resistencia, defensa, posicion, "
              "media, equipo, estamina")

SQL["roster_union"] = f"WITH {RAW}\nSELECT {RAW_COLS} FROM raw"
SQL["roster_clean"] = with_roster(f"SELECT {CLEAN_COLS} FROM clean")
SQL["roster_rejects"] = f"""WITH {RAW}, w AS (
  SELECT "ID"::VARCHAR AS id, "Name" AS nombre, "GENDER" AS genero, "PAC"::VARCHAR AS velocidad,
    "PAS"::VARCHAR AS pase, "SHO"::VARCHAR AS tiro, "PHY"::VARCHAR AS resistencia,
    "DEF"::VARCHAR AS defensa, "Position" AS posicion, "OVR"::VARCHAR AS media, "Team" AS equipo,
    concat_ws(',', CASE WHEN "ID" IS NULL THEN 'falta_id' END, CASE WHEN "Name" IS NULL THEN 'falta_nombre' END,
      CASE WHEN "PAC" IS NULL THEN 'falta_velocidad' END, CASE WHEN "PAS" IS NULL THEN 'falta_pase' END,
      CASE WHEN "SHO" IS NULL THEN 'falta_tiro' END, CASE WHEN "PHY" IS NULL THEN 'falta_resistencia' END,
      CASE WHEN "DEF" IS NULL THEN 'falta_defensa' END) AS motivos
  FROM raw)
SELECT * FROM w WHERE motivos <> ''"""
_MEN_CELLS = ["c_custkey", "CASE WHEN c_custkey % 40 = 3 THEN chr(34) ELSE '' END || c_name", "'M'", "CASE WHEN c_custkey % 50 = 3 THEN NULL ELSE 40 + c_custkey * 7 % 60 END",
              "40 + c_custkey * 11 % 60", "40 + c_custkey * 13 % 60", "CASE WHEN c_custkey % 70 = 5 THEN NULL ELSE 40 + c_custkey * 17 % 60 END",
              "40 + c_custkey * 19 % 60", f"{POS_LIST}[c_custkey % 17 + 1]", "50 + c_custkey * 3 % 45", "c_mktsegment"]
_LINE = " || ',' || ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in _MEN_CELLS)
SQL["roster_bad_lines"] = f"""SELECT CAST(c_custkey AS VARCHAR) AS id,
  {_LINE} || CASE c_custkey % 40 WHEN 1 THEN '' WHEN 2 THEN ',u/' || c_custkey || ',x' ELSE ',u/' || c_custkey END AS linea,
  CASE c_custkey % 40 WHEN 1 THEN 'faltan_celdas' WHEN 2 THEN 'sobran_celdas' ELSE 'comillas_abiertas' END AS motivo
FROM customer WHERE c_custkey % 40 IN (1, 2, 3)"""
SQL["roster_whole_lines"] = with_roster(f"SELECT {CLEAN_COLS} FROM clean WHERE genero = 'M' AND id::BIGINT % 40 NOT IN (1, 2, 3)")
SQL["roster_report"] = with_roster("SELECT count(*) AS filas, count(*) AS informadas FROM clean")
SQL["eligible_men"] = with_roster(f"SELECT {CLEAN_COLS}, grupo FROM eligible WHERE genero = 'M'")
SQL["roster_roundtrip"] = SQL["roster_clean"]
SQL["position_groups"] = with_roster(
    "SELECT genero, grupo, count(*) AS jugadores FROM grouped GROUP BY genero, grupo")
SQL["eligible_players"] = with_roster(f"SELECT {CLEAN_COLS}, grupo FROM eligible")
SQL["safe_int_stats"] = f"""WITH {RAW}
SELECT "GENDER" AS genero, count(*) AS jugadores,
  count(*) FILTER (WHERE "PAC" IS NULL) AS velocidad_por_defecto,
  sum(coalesce("PAC", 50))::DOUBLE / count(*) AS velocidad_media,
  count(*) FILTER (WHERE "PHY" IS NULL) AS resistencia_por_defecto,
  sum(coalesce("PHY", 50))::DOUBLE / count(*) AS resistencia_media,
  count(*) FILTER (WHERE "OVR" IS NULL) AS media_por_defecto,
  sum(coalesce("OVR", 50))::DOUBLE / count(*) AS media_media
FROM raw GROUP BY "GENDER\""""
SQL["squad_draft"] = with_roster(DRAFT + "\nSELECT equipo, grupo, orden, id, nombre, posicion FROM draft")
SQL["squad_draft_disjoint"] = with_roster(f""", r AS (SELECT grupo, {NEED_SQL} AS need,
    row_number() OVER (PARTITION BY grupo ORDER BY {draft_key_sql("'A'")}, id) AS rn,
    id, nombre, posicion FROM eligible)
SELECT CASE WHEN (rn - 1) // need = 0 THEN 'A' ELSE 'B' END AS equipo, grupo,
  (rn - ((rn - 1) // need) * need)::BIGINT AS orden, id, nombre, posicion
FROM r WHERE rn <= 2 * need""")
SQL["formation_check"] = with_roster(""", n AS (SELECT * FROM (VALUES ('GK', 1), ('DEF', 4), ('MID', 4), ('FWD', 2)) v(grupo, necesarios)),
h AS (SELECT grupo, count(*) AS disponibles FROM eligible GROUP BY grupo)
SELECT n.grupo, n.necesarios, coalesce(h.disponibles, 0)::BIGINT AS disponibles,
  coalesce(h.disponibles, 0) >= n.necesarios AS suficiente,
  coalesce(h.disponibles, 0) >= 2 * n.necesarios AS suficiente_disjuntos
FROM n LEFT JOIN h ON n.grupo = h.grupo""")
SQL["squad_counts"] = with_roster(DRAFT + """
SELECT equipo, count(*) AS jugadores, count(*) FILTER (WHERE trim(posicion) = 'GK') AS porteros
FROM draft GROUP BY equipo""")

SQL["metrics_with_roster"] = f"""WITH {EV},\n{ZEV},\n{M},\n{RAW},\n{CLEAN}
SELECT m.match_id, m.player_id, m.player_nombre, m.player_equipo, m.player_posicion,
  m.distancia_m, m.estamina_actual, m.goles, r.genero, r.velocidad, r.resistencia, r.media
FROM m LEFT JOIN clean r ON m.player_id = CAST(r.id AS VARCHAR)"""

SQL["stamina_audit"] = f"""WITH {EV},\n{RAW},
pr AS (SELECT "ID"::VARCHAR AS id, coalesce("PAC", 50)::DOUBLE AS velocidad, coalesce("PHY", 50)::DOUBLE AS resistencia
  FROM raw WHERE "ID" IS NOT NULL),
play AS (SELECT * FROM pr QUALIFY row_number() OVER (PARTITION BY id ORDER BY velocidad, resistencia) = 1),
a AS (SELECT ev.match_id, ev.player_id, ev.player_equipo, ev.timestamp, ev.event_id, ev.estamina,
    r.id IS NOT NULL AS en_plantilla,
    round((ev.speed_jugador / greatest(coalesce(r.velocidad, 50) / 10.0::DOUBLE, 0.01::DOUBLE))
      * (1.0::DOUBLE - coalesce(r.resistencia, 50) / 200.0::DOUBLE) * 2.0::DOUBLE * 0.5::DOUBLE * 1e6::DOUBLE)::BIGINT AS perdida_u
  FROM ev LEFT JOIN play r ON ev.player_id = r.id WHERE ev.tipo = 'posicion'),
s AS (SELECT *, greatest(0, 100000000 - sum(perdida_u) OVER (
    PARTITION BY match_id, player_id, player_equipo ORDER BY timestamp, event_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT / 1e6::DOUBLE AS modelo FROM a)
SELECT match_id, player_id, player_equipo, en_plantilla, count(*) AS eventos,
  arg_max(modelo, (timestamp, event_id)) AS estamina_modelo_final,
  max(abs(modelo - estamina)) AS max_desvio
FROM s GROUP BY match_id, player_id, player_equipo, en_plantilla"""

# --- publication, sinks, stream ---------------------------------------------

EVENT_JSON = """to_json(struct_pack(match_id := match_id, timestamp := timestamp, tipo := tipo,
  player_id := player_id, player_nombre := player_nombre, player_equipo := player_equipo,
  player_posicion := player_posicion, x := x, y := y, speed_jugador := speed_jugador,
  estamina := estamina, ball_x := ball_x, ball_y := ball_y, ball_speed := ball_speed,
  action := action, is_successful := is_successful, event_id := event_id))"""

SQL["encode_events"] = f"WITH {EV}\nSELECT match_id AS key, CAST({EVENT_JSON} AS VARCHAR) AS value FROM ev"

SQL["events_roundtrip"] = f"""WITH {EV}
SELECT match_id, timestamp, tipo, player_id, player_nombre, player_equipo, player_posicion,
  x, y, speed_jugador, estamina, ball_x, ball_y, ball_speed, action, is_successful, event_id
FROM ev"""

_BODY = ", ".join(f"{c} := {c}" for c in
                  [c.strip() for c in METRIC_COLS.replace("\n", " ").split(",")])

SQL["bulk_ndjson"] = with_metrics(f"""SELECT
  coalesce(match_id, 'None') || '_' || coalesce(player_id, 'None') || '_' || coalesce(player_equipo, 'None') AS doc_id,
  to_json({{'index': {{'_index': 'football_metrics',
    '_id': coalesce(match_id, 'None') || '_' || coalesce(player_id, 'None') || '_' || coalesce(player_equipo, 'None')}}}})
  || chr(10) || to_json(struct_pack({_BODY}, timestamp := '2024-02-01T00:00:00Z')) AS bulk
FROM m""")

SQL["stream_metrics"] = SQL["player_metrics"]
SQL["latest_snapshot"] = SQL["player_metrics"]
SQL["stream_metrics_complete"] = SQL["player_metrics"]
SQL["stream_state"] = SQL["player_metrics"]
SQL["latest_count"] = with_metrics(
    "SELECT count(*) AS documentos FROM (SELECT DISTINCT match_id, player_id, player_equipo FROM m)")
SQL["bulk_readback"] = SQL["player_metrics"]
_SOME = "zev AS (SELECT {cols}, CASE WHEN x <= 35 THEN 'defensa' WHEN x <= 70 THEN 'medio' ELSE 'ataque' END AS zona FROM ev{where})"
SQL["second_run"] = f"WITH {EV},\n{_SOME.format(cols='*', where=' WHERE event_id % 2 = 1')},\n{M}\nSELECT {METRIC_COLS} FROM m"
_ONE = "* REPLACE ('M-nuevo' AS match_id)"
SQL["replayed_match"] = f"WITH {EV},\n{_SOME.format(cols=_ONE, where='')},\n{M}\nSELECT {METRIC_COLS} FROM m"
SQL["event_clock"] = f"""WITH {EV}
SELECT match_id, event_id, strftime(TIMESTAMP '2024-02-01 00:00:00' + to_seconds(timestamp::BIGINT), '%Y-%m-%dT%H:%M:%SZ') AS reloj FROM ev"""
SQL["live_match_kpis"] = SQL["match_kpis"]
SQL["live_top_scorers"] = SQL["top_scorers"]
SQL["live_team_stamina"] = SQL["team_stamina"]

# Players of team A are forwards from the middle of the match on: two metrics
# rows each, of which the document is the one with the latest event.
_MOVED = ("zev AS (SELECT * REPLACE (CASE WHEN timestamp >= 302400 AND player_equipo = 'A' THEN 'ST' ELSE player_posicion END AS player_posicion),\n"
          "  CASE WHEN x <= 35 THEN 'defensa' WHEN x <= 70 THEN 'medio' ELSE 'ataque' END AS zona FROM ev)")
SQL["position_changes"] = f"""WITH {EV},\n{_MOVED},\n{M},
seen AS (SELECT match_id, player_id, player_nombre, player_equipo, player_posicion, max(timestamp) AS t
  FROM zev GROUP BY ALL)
SELECT {METRIC_COLS} FROM m JOIN seen USING (match_id, player_id, player_nombre, player_equipo, player_posicion)
QUALIFY row_number() OVER (PARTITION BY match_id, player_id, player_equipo ORDER BY t DESC, player_nombre DESC, player_posicion DESC) = 1"""

# Deterministic-epoch replay: slice i = event_id % 8 is epoch i; a key
# appears in epoch i when slice i has one of its events, with the metrics
# of all slices <= i.
_AGGS = M[M.index("    round(sum(speed_jugador)"):M.index("  FROM zev")]
_EPOCHS = f""", b AS (SELECT *, event_id % 8 AS bucket FROM zev),
ep AS (SELECT range AS batch_id FROM range(8)),
cum AS (SELECT ep.batch_id, b.* FROM ep JOIN b ON b.bucket <= ep.batch_id),
touched AS (SELECT DISTINCT bucket AS batch_id, match_id, player_id, player_nombre,
    player_equipo, player_posicion FROM b),
hist AS (SELECT batch_id, match_id, player_id, player_nombre, player_equipo, player_posicion,
{_AGGS}  FROM cum
  GROUP BY batch_id, match_id, player_id, player_nombre, player_equipo, player_posicion),
h AS (SELECT hist.* FROM hist JOIN touched USING (batch_id, match_id, player_id, player_nombre,
    player_equipo, player_posicion))"""
SQL["metric_evolution"] = with_events(_EPOCHS + """
SELECT match_id, player_id, player_nombre, player_equipo, player_posicion, batch_id, goles,
  distancia_m, estamina_actual,
  goles - coalesce(lag(goles) OVER w, 0) AS delta_goles,
  distancia_m - lag(distancia_m) OVER w AS delta_distancia,
  estamina_actual - lag(estamina_actual) OVER w AS delta_estamina
FROM h
WINDOW w AS (PARTITION BY match_id, player_id, player_nombre, player_equipo, player_posicion
             ORDER BY batch_id)""")

SQL["history_compacted"] = with_events(_EPOCHS + """
SELECT batch_id, count(*) AS filas, sum(goles)::BIGINT AS goles FROM h GROUP BY batch_id""")

SQL["roster_in_stream"] = f"""WITH {EV},\n{ZEV}{_EPOCHS},\n{RAW},\n{CLEAN}
SELECT match_id, player_id, player_nombre, player_equipo, player_posicion, batch_id, goles, distancia_m, r.genero,
  r.velocidad + CASE WHEN batch_id >= 4 THEN 1 ELSE 0 END AS velocidad, r.resistencia,
  CASE WHEN batch_id >= 4 THEN 1 ELSE 0 END::BIGINT AS version_plantilla
FROM h LEFT JOIN clean r ON h.player_id = r.id"""

SQL["event_rejects"] = f"""WITH {EV}, c AS (
  SELECT * REPLACE (CASE WHEN event_id % 110 = 0 THEN NULL ELSE match_id END AS match_id,
                    CASE WHEN event_id % 70 = 0 THEN NULL ELSE player_id END AS player_id) FROM ev),
w AS (SELECT CASE WHEN event_id % 50 = 0 THEN substr(CAST({EVENT_JSON} AS VARCHAR), 1, 40) ELSE CAST({EVENT_JSON} AS VARCHAR) END AS mensaje,
  CASE WHEN event_id % 50 = 0 OR match_id IS NULL AND player_id IS NULL THEN 'sin_datos'
       WHEN match_id IS NULL THEN 'sin_match_id' WHEN player_id IS NULL THEN 'sin_player_id' END AS motivo FROM c)
SELECT motivo, count(*) AS mensajes, sum(length(mensaje))::BIGINT AS caracteres FROM w WHERE motivo IS NOT NULL GROUP BY motivo"""

_CENT = ", ".join(f"sum(round({e} * 100)::BIGINT)::BIGINT AS {c}_centesimas" for c, e in (
    ("x", "x / 3"), ("y", "y / 3"), ("estamina", "estamina / 3"), ("ball_x", "ball_x"), ("speed_jugador", "speed_jugador")))
SQL["encoded_rounded"] = f"""WITH {EV}
SELECT match_id, tipo, count(*) AS eventos, {_CENT} FROM ev GROUP BY match_id, tipo"""
