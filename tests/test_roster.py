"""Roster cleaning, union, eligibility and the squad draft."""

import pytest
from pyspark.sql import functions as F

from helpers import TEXT
from touchline.operators import roster as R
from touchline.sources.roster import read_roster_csv


def _write(spark, path, header, rows):
    lines = [",".join(header)] + [",".join("" if v is None else str(v) for v in r) for r in rows]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode(
        "overwrite").text(path)


MEN_H = ["ID", "Name", "GENDER", "PAC", "PAS", "SHO", "PHY", "DEF", "Position", "OVR", "Team", "url"]
WOMEN_H = ["Name", "ID", "PAC", "PAS", "SHO", "PHY", "DEF", "Position", "OVR", "GENDER"]


def test_union_by_name_and_conflicting_types(spark, tmp_out):
    _write(spark, f"{tmp_out}/m", MEN_H, [[1, "A", "M", 80.5, 70, 60, 75, 50, "ST", 80, "X", "u"],
                                          [2, "B", "M", 81.0, 70, 60, 75, 50, "GK", 70, "X", "u"]])
    _write(spark, f"{tmp_out}/w", WOMEN_H, [["C", 3, "fast", 70, 60, 75, 50, "CB", 90, "F"],
                                            ["D", 4, 77, 70, 60, None, 50, "CM", 66, "F"]])
    men = read_roster_csv(spark, f"{tmp_out}/m", infer_schema=True)
    women = read_roster_csv(spark, f"{tmp_out}/w", infer_schema=True)
    assert dict(men.dtypes)["PAC"] == "double" and dict(women.dtypes)["PAC"] == "string"
    u = R.union_rosters(men, women)
    assert u.count() == 4
    assert u.filter(F.col("ID") == 3).collect()[0]["Team"] is None
    clean = {r.id: r for r in R.clean_roster(u).collect()}
    # 'fast' is unparsable -> null -> dropped; missing PHY -> dropped
    assert set(clean) == {"1", "2"}
    assert clean["2"].velocidad == 81.0 and clean["1"].velocidad == 80.5 and clean["1"].estamina == 100.0
    assert clean["1"].equipo == "X"


def test_eligibility_and_groups(spark):
    df = spark.createDataFrame(
        [(1, "a", "GK", 70), (2, "b", "XX", 90), (3, "c", " CB ", 64), (4, "d", "ST", None)],
        "id long, nombre string, posicion string, media int").withColumn("genero", F.lit("M"))
    got = {r.id: r.grupo for r in R.eligible_players(df).collect()}
    assert got == {1: "GK"}  # XX has no group, 64 < 65, missing OVR counts as 50


def test_squad_draft_properties(spark):
    rows = []
    pos = ["GK", "CB", "CM", "ST"]
    for i in range(200):
        rows.append((i, f"p{i}", pos[i % 4], 80))
    df = (spark.createDataFrame(rows, "id long, nombre string, posicion string, media int")
          .withColumn("genero", F.lit("M")))
    el = R.eligible_players(df)
    for disjoint in (False, True):
        d = R.squad_draft(el, seed=7, disjoint=disjoint)
        counts = {r.equipo: (r.jugadores, r.porteros) for r in R.squad_counts(d).collect()}
        assert counts == {"A": (11, 1), "B": (11, 1)}
        per_team = d.groupBy("equipo").agg(F.countDistinct("id").alias("n")).collect()
        assert all(r.n == 11 for r in per_team)
        ids = [r.id for r in d.collect()]
        if disjoint:
            assert len(set(ids)) == 22
    again = R.squad_draft(el, seed=7).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, R.squad_draft(el, seed=7).collect()))


def test_formation_check(spark):
    df = (spark.createDataFrame([(1, "a", "GK", 80), (2, "b", "CB", 80)],
                                "id long, nombre string, posicion string, media int")
          .withColumn("genero", F.lit("M")))
    got = {r.grupo: (r.disponibles, r.suficiente) for r in
           R.formation_check(spark, R.eligible_players(df)).collect()}
    assert got == {"GK": (1, True), "DEF": (1, False), "MID": (0, False), "FWD": (0, False)}


def test_draft_teams_and_seeds_differ(spark):
    from touchline.operators.roster import squad_draft

    pool = spark.createDataFrame([(f"P{i:03d}", f"n{i}", "CM", g) for g in ("GK", "DEF", "MID", "FWD") for i in range(200)], "id string, nombre string, posicion string, grupo string")
    draw = lambda **kw: {(r["equipo"], r["grupo"], r["id"]) for r in squad_draft(pool, **kw).collect()}
    team = lambda s, t: {x[1:] for x in s if x[0] == t}
    one = draw(seed=42)
    assert team(one, "A") != team(one, "B") and one != draw(seed=43) and one == draw(seed=42)
    apart = draw(disjoint=True)
    assert not team(apart, "A") & team(apart, "B") and len(apart) == 22


def test_cells_are_kept_as_read_and_rejects_say_why(spark):
    rows = [("P01", "a", "80.7", "75", "85"), ("007", "b", "70", "75", "85.0"),
            ("3", "c", "fast", "75", "90"), ("4", "d", "70", None, "90"), (None, "e", "NaN", "1", "90"),
            ("5", "f", "5000000000", "75", " 85 ")]
    raw = (spark.createDataFrame(rows, "ID string, Name string, PAC string, PHY string, OVR string")
           .withColumns({"PAS": F.lit("1"), "SHO": F.lit("1"), "DEF": F.lit("1"), "Position": F.lit("GK")}))
    clean = {r.id: r for r in R.clean_roster(raw).collect()}
    assert set(clean) == {"P01", "007", "5"}
    assert clean["P01"].velocidad == 80.7 and clean["5"].velocidad == 5e9
    why = {r.nombre: r.motivos for r in R.roster_rejects(raw).collect()}
    assert why == {"c": "no_numerico_velocidad", "d": "falta_resistencia",
                   "e": "falta_id,no_numerico_velocidad"}
    # the text is parsed as it stands: '85.0' is no integer and counts as 50
    assert {r.id for r in R.eligible_players(R.clean_roster(raw)).collect()} == {"P01", "5"}
    play = {r.id: (r.velocidad, r.resistencia) for r in R.play_attributes(raw).collect()}
    assert play == {"P01": (50, 75), "007": (70, 75), "3": (50, 75), "4": (70, 50), "5": (5000000000, 75)}


def test_repeated_ids_do_not_multiply_and_missing_players_are_audited(spark):
    from touchline.operators.joins import metrics_with_roster, repeated_ids, stamina_audit
    roster = spark.createDataFrame([("1", "M", 80.0, 70.0, "85"), ("1", "M", 90.0, 70.0, "85")],
                                   "id string, genero string, velocidad double, resistencia double, media string")
    keys = "match_id string, player_id string, player_nombre string, player_equipo string, player_posicion string"
    m = spark.createDataFrame([("m", "1", "n", "A", "GK", 1.0, 1.0, 0), ("m", "2", "n", "A", "GK", 1.0, 1.0, 0)],
                              keys + ", distancia_m double, estamina_actual double, goles long")
    got = {r.player_id: r.velocidad for r in metrics_with_roster(m, roster).collect()}
    assert got == {"1": 80.0, "2": None}
    assert [tuple(r) for r in repeated_ids(roster).collect()] == [("1", 2)]
    ev = spark.createDataFrame([("m", p, "A", "posicion", 1.0, 1, 5.0, 99.0) for p in ("1", "2")],
                               "match_id string, player_id string, player_equipo string, tipo string,"
                               " timestamp double, event_id long, speed_jugador double, estamina double")
    audit = {r.player_id: r for r in stamina_audit(ev, roster).collect()}
    assert audit["1"].en_plantilla and audit["1"].eventos == 1
    assert not audit["2"].en_plantilla and audit["2"].estamina_modelo_final == 99.25


def test_damaged_lines_are_told_apart(spark, tmp_out):
    from touchline.sources.roster import read_roster_checked, read_roster_csv
    cols = ["ID", "Name", "PAC"]
    lines = ["1,Ana,70", "2,Eva", '3,"Li, Na",71', "4,Bo,72,9", '5,"Jo,73', '6,Ole "x,74,75', "7,,", "", '8,"a \\"b\\" c",76']
    spark.createDataFrame([(x,) for x in lines], TEXT).coalesce(1).write.text(f"{tmp_out}/c")
    good, bad = read_roster_checked(spark, f"{tmp_out}/c", cols, header=False)
    assert {tuple(r) for r in good.collect()} == {("1", "Ana", "70"), ("3", "Li, Na", "71"), ("7", None, None), ("8", 'a "b" c', "76")}
    assert {(r.id, r.linea, r.motivo) for r in bad.collect()} == {
        ("2", "2,Eva", "faltan_celdas"), ("4", "4,Bo,72,9", "sobran_celdas"), ("5", '5,"Jo,73', "comillas_abiertas"),
        ("6", '6,Ole "x,74,75', "comillas_abiertas")}
    assert good.select("PAC").count() == 4 and bad.count() == 4
    spark.createDataFrame([(x,) for x in ["ID,Name,PAC", *lines]], TEXT).coalesce(1).write.text(f"{tmp_out}/h")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_roster_csv(spark, f"{tmp_out}/h", mode="FAILFAST").collect()
    assert read_roster_csv(spark, f"{tmp_out}/h", mode="DROPMALFORMED").count() >= 3


def test_missing_roster_raises(spark, tmp_out):
    from pyspark.errors import AnalysisException
    from touchline.sources.roster import read_roster_csv
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_roster_csv(spark, f"{tmp_out}/nowhere.csv")
