"""Employee job (two CSV drops) and song pipeline goldens."""

import os

from pyspark.sql import functions as F

from strata.plans.employees import employee_job
from strata.plans.songs import SONG_RULES, songs_prepared, top_artists_by_year
from strata.operators.rules import rule_metrics

DROP1 = ("ID,FirstName,Country,Role\n1,Kristi,United States,Data Engineer\n"
         "2,Sophia,Germany,Data Analyst\n3,Peter,Canada,ML Engineer\n4,Zebi,India,Data Scientist\n")
DROP2 = "ID,FirstName,Country,Role\n5,Maria,Brazil,Data Engineer\n6,Aiden,Australia,Data Analyst\n"


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_employee_job_goldens(spark, tmp):
    land = f"{tmp}/landing"
    write(f"{land}/employees.csv", DROP1)
    write(f"{land}/employees2.csv", DROP2)
    out = employee_job(spark, land, f"{tmp}/job")
    assert out["rows_loaded"] == 6
    silver = out["silver"]
    assert silver.count() == 6
    assert silver.filter(F.col("Role") != F.upper("Role")).count() == 0
    assert dict(silver.dtypes)["processed_date"] == "date"
    gold = {r["Role"]: r["TotalEmployees"] for r in out["gold"].collect()}
    assert gold == {"DATA ENGINEER": 2, "DATA ANALYST": 2, "ML ENGINEER": 1, "DATA SCIENTIST": 1}
    assert dict(out["gold"].dtypes)["TotalEmployees"] == "int"
    again = employee_job(spark, land, f"{tmp}/job")          # re-run: nothing new
    assert again["rows_loaded"] == 0 and again["silver"].count() == 6


def test_song_rules_and_top_artists(spark):
    raw = spark.createDataFrame(
        [("A1", "Ann", 200.0, "r", 120.0, 4.0, "x", 2001),
         ("A1", "Ann", 180.0, "r", 120.0, 4.0, "y", 2001),
         ("A2", None, 0.0, "r", 120.0, 4.0, None, 2001),
         ("A3", "Bo", 100.0, "r", 120.0, 4.0, "z", 0)],
        "artist_id string, artist_name string, duration double, release string, tempo double, "
        "time_signature double, title string, year int")
    prepared = songs_prepared(raw)
    assert "song_title" in prepared.columns and prepared.count() == 4   # warn rules keep rows
    m = {r["rule"]: r["failed"] for r in rule_metrics(prepared, SONG_RULES, "songs").collect()}
    assert m == {"valid_artist_name": 1, "valid_title": 1, "valid_duration": 1}
    top = [tuple(r) for r in top_artists_by_year(prepared).collect()]
    assert top[0] == ("Ann", 2001, 2) and all(r[1] > 0 for r in top)
