"""Roster operators: union, cleaning, eligibility, position groups, the
seeded squad draft and its feasibility check, and squad counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.functions.columns import count_where, position_group, safe_int
from touchline.schemas import FORMATION, OVR_MIN, ROSTER_COLUMNS, ROSTER_REQUIRED

_NUMBER_COLUMNS = {"velocidad", "pase", "tiro", "resistencia", "defensa"}


def union_rosters(men: DataFrame, women: DataFrame) -> DataFrame:
    """Union by column name; a column missing on one side becomes null.
    Where the two inputs disagree on a column's type (e.g. inference found
    a text cell in one file), both sides are kept as text so the union
    cannot fail at run time; ``clean_roster`` parses them afterwards."""
    mt = dict(men.dtypes)
    wt = dict(women.dtypes)
    clash = {c for c in mt if c in wt and mt[c] != wt[c]}

    def align(df: DataFrame) -> DataFrame:
        return df.select(*[F.col(c).cast("string").alias(c) if c in clash else F.col(c)
                           for c in df.columns])
    return align(men).unionByName(align(women), allowMissingColumns=True)


def _cells(raw: DataFrame) -> DataFrame:
    """The 11 used columns under their new names, every cell as text."""
    return raw.select(*[(F.col(src) if src in raw.columns else F.lit(None)).cast("string").alias(dst)
                        for src, dst in ROSTER_COLUMNS.items()])


def _reasons() -> Column:
    """Why a row of cells has no place in the clean roster; empty if it has."""
    out = []
    for c in ROSTER_REQUIRED:
        out.append(F.when(F.col(c).isNull(), f"falta_{c}"))
        if c in _NUMBER_COLUMNS:
            number = F.col(c).try_cast("double")
            out.append(F.when(F.col(c).isNotNull() & (number.isNull() | F.isnan(number)),
                              f"no_numerico_{c}"))
    return F.concat_ws(",", *out)


def clean_roster(raw: DataFrame) -> DataFrame:
    """Select and rename the 11 used columns, add ``estamina`` = 100.0 and
    leave out players without id, name or a key statistic (``roster_rejects``
    has those, with the reason). Output types are fixed whatever the CSV
    inference produced: statistics are double, every other cell is kept as
    read, so ids such as 'P01' and '007' stay themselves and ``media`` keeps
    the text that eligibility parses."""
    kept = _cells(raw).filter(_reasons() == "")
    return kept.select(*[F.col(c).cast("double").alias(c) if c in _NUMBER_COLUMNS else F.col(c)
                         for c in kept.columns], F.lit(100.0).alias("estamina"))


def roster_rejects(raw: DataFrame) -> DataFrame:
    """The rows that ``clean_roster`` leaves out, cells as read, and why."""
    return _cells(raw).withColumn("motivos", _reasons()).filter(F.col("motivos") != "")


def play_attributes(raw: DataFrame) -> DataFrame:
    """Pace and strength as the match uses them: of every row with an id, a
    cell that is no integer counts as 50."""
    return (raw.select(F.col("ID").cast("string").alias("id"), safe_int("PAC").alias("velocidad"),
                       safe_int("PHY").alias("resistencia")).filter(F.col("id").isNotNull()))


def with_position_group(roster: DataFrame) -> DataFrame:
    return roster.withColumn("grupo", position_group("posicion"))


def eligible_players(roster: DataFrame, min_ovr: int = OVR_MIN,
                     gender: str | None = None) -> DataFrame:
    """Players good enough for a squad (OVR >= 65; the cell as read is parsed,
    and one that is no integer, '85.0' too, counts as 50) whose position belongs to a group."""
    r = with_position_group(roster)
    if gender is not None:
        r = r.filter(F.col("genero") == gender)
    return r.filter((safe_int("media") >= min_ovr) & F.col("grupo").isNotNull())


def position_groups(roster: DataFrame) -> DataFrame:
    """Players per gender and position group (null group = no group)."""
    return (with_position_group(roster)
            .groupBy("genero", "grupo").agg(F.count(F.lit(1)).alias("jugadores")))


def _needed(grp: Column) -> Column:
    expr = None
    for g, n in FORMATION:
        expr = F.when(grp == g, n) if expr is None else expr.when(grp == g, n)
    return expr


def draft_key(seed: int, team: Column, player_id: Column) -> Column:
    """Seeded pseudo-random order: md5 of seed, team and id as text, so every
    team and seed gets an order of its own and any kind of id will do."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), team, player_id.cast("string")))


def squad_draft(eligible: DataFrame, seed: int = 42, teams=("A", "B"),
                disjoint: bool = False) -> DataFrame:
    """Draft a 4-4-2 squad per team: n players per group, without
    replacement inside a team. Teams draw independently from the same pool
    (a player may appear in both, as in the original) unless ``disjoint``.

    Only ``row_number() <= max(n)`` feeds the filter, so Spark keeps at most
    that many rows per group in each task before the shuffle
    (WindowGroupLimit) — a huge position group is never gathered."""
    top = max(n for _, n in FORMATION)
    base = eligible.select("id", "nombre", "posicion", "grupo")
    if disjoint:
        w = Window.partitionBy("grupo").orderBy(draft_key(seed, F.lit("A"), F.col("id")), "id")
        ranked = (base.withColumn("_rn", F.row_number().over(w))
                  .filter(F.col("_rn") <= top * len(teams)))
        n = _needed(F.col("grupo"))
        team_idx = F.floor((F.col("_rn") - 1) / n).cast("int")
        out = (ranked.filter(team_idx < len(teams))
               .withColumn("equipo", F.element_at(F.array(*[F.lit(t) for t in teams]), team_idx + 1))
               .withColumn("orden", F.col("_rn") - team_idx * n))
    else:
        t = base.withColumn("equipo", F.explode(F.array(*[F.lit(x) for x in teams])))
        w = Window.partitionBy("equipo", "grupo").orderBy(
            draft_key(seed, F.col("equipo"), F.col("id")), "id")
        out = (t.withColumn("orden", F.row_number().over(w))
               .filter(F.col("orden") <= top))
    return (out.filter(F.col("orden") <= _needed(F.col("grupo")))
               .select("equipo", "grupo", F.col("orden").cast("bigint").alias("orden"),
                       "id", "nombre", "posicion"))


def formation_check(spark: SparkSession, eligible: DataFrame) -> DataFrame:
    """Eligible players per group against the formation's needs: enough for
    one squad, and enough for two disjoint squads."""
    needs = spark.createDataFrame(
        FORMATION, T.StructType([T.StructField("grupo", T.StringType()),
                                 T.StructField("necesarios", T.IntegerType())]))
    have = eligible.groupBy("grupo").agg(F.count(F.lit(1)).alias("disponibles"))
    j = needs.join(have, "grupo", "left").withColumn(
        "disponibles", F.coalesce(F.col("disponibles"), F.lit(0).cast("bigint")))
    return j.select("grupo", "necesarios", "disponibles",
                    (F.col("disponibles") >= F.col("necesarios")).alias("suficiente"),
                    (F.col("disponibles") >= 2 * F.col("necesarios")).alias("suficiente_disjuntos"))


def squad_counts(squads: DataFrame) -> DataFrame:
    """Squad size and goalkeepers per team (the start-up sanity print)."""
    return squads.groupBy("equipo").agg(
        F.count(F.lit(1)).alias("jugadores"),
        count_where(F.trim(F.col("posicion")) == "GK").alias("porteros"))


def safe_int_stats(raw_text: DataFrame) -> DataFrame:
    """Integer parsing with default 50 over a roster read as text, per gender:
    how many values fell back to the default and the resulting means."""
    g = F.col("GENDER") if "GENDER" in raw_text.columns else F.lit(None).cast("string")
    n = F.count(F.lit(1))
    out = []
    for src, name in (("PAC", "velocidad"), ("PHY", "resistencia"), ("OVR", "media")):
        parsed = F.trim(F.col(src)).try_cast("bigint")
        out.append(count_where(parsed.isNull()).alias(f"{name}_por_defecto"))
        out.append((F.sum(safe_int(src)) / n).alias(f"{name}_media"))
    return raw_text.groupBy(g.alias("genero")).agg(n.alias("jugadores"), *out)
