"""Match-event sources.

* ``parse_events`` — raw message bytes/text -> typed event columns
  (``CAST(value AS STRING)`` -> ``from_json`` -> ``d.*``). PERMISSIVE: a
  wrong-typed field becomes null, a malformed message an all-null row.
* ``split_rejects`` — default-mode handling of rows with no match or player.
* ``events_from_table`` — the driver's generic ``events`` table re-shaped
  into match events (deterministic formulas, see FIXTURES.md §5).
* ``encode_events`` — events -> one JSON message per row (the publication
  side), for files or a Kafka sink.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.schemas import EVENT_FIELDS, EVENT_SCHEMA, TIEBREAK_FIELD


def event_columns(with_tiebreak: bool = True) -> list[str]:
    cols = [n for n, _ in EVENT_FIELDS]
    return cols + [TIEBREAK_FIELD] if with_tiebreak else cols


def parse_events(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """Kafka/text record -> typed events. Unknown keys are dropped, missing
    keys are null."""
    return (raw.select(F.col(value_col).cast("string").alias("js"))
               .select(F.from_json("js", EVENT_SCHEMA).alias("d"))
               .select("d.*"))


def split_rejects(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, rejects): rows without match_id or player_id cannot belong to
    any player's metrics; faithful mode keeps them instead."""
    ok = F.col("match_id").isNotNull() & F.col("player_id").isNotNull()
    return events.filter(ok), events.filter(~ok)


def rejected_messages(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """Raw messages that cannot be attributed to a match and player, kept as
    text with the reason, for a rejects output."""
    txt = F.col(value_col).cast("string")
    parsed = F.from_json(txt, EVENT_SCHEMA)
    return (raw.select(txt.alias("mensaje"), parsed.alias("d"))
               .filter(F.col("d.match_id").isNull() | F.col("d.player_id").isNull())
               .select("mensaje",
                       F.when(F.col("d").isNull() | F.col("d.match_id").isNull()
                              & F.col("d.player_id").isNull(), "sin_datos")
                        .when(F.col("d.match_id").isNull(), "sin_match_id")
                        .otherwise("sin_player_id").alias("motivo")))


def replay_as(events: DataFrame, match_id: str) -> DataFrame:
    """Replay a recorded event table as a new match (new identifier)."""
    return events.withColumn("match_id", F.lit(match_id))


ROUNDED_FIELDS = ["x", "y", "speed_jugador", "estamina", "ball_x", "ball_y", "ball_speed"]


def encode_events(events: DataFrame, include_tiebreak: bool = True,
                  round_digits: int | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """One JSON message per event in column ``value``; null fields are kept
    as JSON nulls like the producer's ``json.dumps``. A ``key`` column
    (match_id) is added so a Kafka sink keeps one match in one partition.
    ``round_digits=2`` rounds the published positions, speeds and stamina
    as the original producer does; ``bround`` is half-even like Python's
    ``round``, but on the decimal value rather than the binary one, so
    values such as 2.675 can round differently. ``keep`` carries extra
    columns next to the message (e.g. an output partition column)."""
    cols = [F.bround(F.col(c), round_digits).alias(c)
            if round_digits is not None and c in ROUNDED_FIELDS else F.col(c)
            for c in event_columns(include_tiebreak)]
    return events.select(
        F.col("match_id").alias("key"),
        F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).alias("value"),
        *keep,
    )


def write_event_files(events: DataFrame, path: str) -> None:
    """Publish events as JSON-lines text files (one message per line), the
    input of a file-source replay. Partitioning is kept as is: every task
    writes its own file."""
    encode_events(events).select("value").write.mode("overwrite").text(path)


def publish_to_kafka(events: DataFrame, servers: str, topic: str, **options: str) -> None:
    """Publish events to a Kafka topic, keyed by match so one match stays in
    one partition. Needs the spark-sql-kafka package (not available in this
    environment, so untested here)."""
    w = (encode_events(events).write.format("kafka")
         .option("kafka.bootstrap.servers", servers).option("topic", topic))
    for k, v in options.items():
        w = w.option(k, v)
    w.save()


def read_event_files(spark: SparkSession, path: str) -> DataFrame:
    """Batch read of JSON-lines event files through the same parser as the
    stream."""
    return parse_events(spark.read.text(path))


# Fixed values of the test-data adapter (FIXTURES.md §5): the driver's
# generic event table re-shaped into match events. Written as SQL text so the
# whole projection is parsed once on the JVM side.
ADAPTER_SQL = [
    "concat('M', CAST((dayofmonth(ts) - 1) div 7 AS STRING)) AS match_id",
    "CAST(pmod(dayofmonth(ts) - 1, 7) * 86400 + hour(ts) * 3600 + minute(ts) * 60"
    " + second(ts) AS DOUBLE) AS timestamp",
    "CASE WHEN event_type = 'view' THEN 'posicion' ELSE 'accion' END AS tipo",
    "CAST(user_id AS STRING) AS player_id",
    "concat('Player ', CAST(user_id AS STRING)) AS player_nombre",
    "CASE WHEN user_id % 2 = 0 THEN 'A' ELSE 'B' END AS player_equipo",
    "CASE WHEN user_id % 11 = 0 THEN 'GK' WHEN user_id % 11 <= 4 THEN 'CB'"
    " WHEN user_id % 11 <= 8 THEN 'CM' ELSE 'ST' END AS player_posicion",
    "CASE WHEN event_id % 97 = 0 THEN CAST(NULL AS DOUBLE)"
    " ELSE (event_id * 37 % 1051) / 10D END AS x",
    "(event_id * 53 % 681) / 10D AS y",
    "CASE WHEN event_type = 'view' THEN (event_id * 29 % 1000) / 100D ELSE 0D END AS speed_jugador",
    "CASE WHEN event_id % 89 = 0 THEN CAST(NULL AS DOUBLE)"
    " ELSE (10000 - event_id * 7919 % 10001) / 100D END AS estamina",
    "(event_id * 41 % 1051) / 10D AS ball_x",
    "(event_id * 59 % 681) / 10D AS ball_y",
    "(event_id * 31 % 3500) / 100D AS ball_speed",
    "CASE WHEN event_type = 'click' THEN 'pase'"
    " WHEN event_type = 'error' THEN CASE WHEN event_id % 2 = 0 THEN 'perdida' ELSE 'recuperacion' END"
    " WHEN event_type = 'signup' THEN 'tiro'"
    " WHEN event_type = 'purchase' THEN CASE WHEN event_id % 3 = 0 THEN 'parada' ELSE 'gol' END"
    " END AS action",
    "CASE WHEN event_type = 'error' THEN event_id % 2 = 1"
    " WHEN event_type = 'purchase' THEN true"
    " WHEN event_type IN ('click', 'signup') THEN event_id % 4 <> 0 END AS is_successful",
    f"event_id AS {TIEBREAK_FIELD}",
]


def table_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of the driver's ``events`` table that match events are made
    of; they are far shorter than the events' messages, so it is
    they that a shuffle should move."""
    return spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "user_id", "event_type")


def adapted(rows: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows of the ``events`` table -> match events, ``keep`` beside them."""
    return rows.selectExpr(*ADAPTER_SQL, *keep)


def events_from_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Driver ``events`` table -> match events. A pure projection: it stays
    in the scan's codegen stage and reads only four columns."""
    return adapted(spark.read.parquet(f"{sf_dir}/events.parquet"))
