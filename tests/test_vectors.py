"""Input/expected vectors of FIXTURES.md section 4 (rules re-typed from the reference)."""

import pytest
from pyspark.sql import functions as F

from offerlens.functions import experience as X
from offerlens.functions import geo as G
from offerlens.functions import salary as M
from offerlens.functions import text as T

NP = "Non précisé"


def one_col(spark, values, name="s"):
    return spark.createDataFrame([(v,) for v in values], f"{name} STRING")


CLEAN = [
    ("Développeur C# / .NET (H/F) - l'été",
     "développeur c     net  h f  - l été", "développeur c     net  h f  - l'été", "développeur c net h f - l'été"),
    ("  Chargé  d'études\n« Data »", "chargé d études   data", "chargé d'études   data", "chargé d'études data"),
]


@pytest.mark.parametrize("raw,v1,v2,v3", CLEAN)
def test_clean_text(spark, raw, v1, v2, v3):
    r = one_col(spark, [raw]).select(*[T.clean_text("s", v).alias(v) for v in ("v1", "v2", "v3")]).first()
    assert (r["v1"], r["v2"], r["v3"]) == (v1, v2, v3)


def test_clean_text_null_is_empty(spark):
    r = spark.createDataFrame([(None,)], "s STRING").select(T.clean_text("s", "v2").alias("c")).first()
    assert r["c"] == ""


SALARY = [
    ("30 000 - 40 000 € / an", (0, 30), (30000, 40000), (30000, 40000)),
    ("12,50 - 13,75 € / heure", (19740, 82250), (20562, 22619), (20562, 22619)),
    ("2 000 - 2 500 € / mois", (0, 24), (24000, 30000), (24000, 30000)),
    ("1500,50€/mois", (600, 18000), (600, 18000), (18006, 18006)),
    ("35-45k€", (35, 45), (35, 45), (35, 45)),
    ("Estimation 28 000 € → 32 000 €", (0, 28), (28000, 32000), (28000, 32000)),
    ("13 € /h", (21385, 21385), (13, 13), (13, 13)),
    ("2000 € - 2500 € / mois sur 13 mois", (24000, 30000), (24000, 30000), (156, 30000)),
    ("à négocier", (None, None), (None, None), (None, None)),
    (None, (None, None), (None, None), (None, None)),
    ("25000", (25000, 25000), (25000, 25000), (25000, 25000)),
]


@pytest.mark.parametrize("raw,v1,v2,v3", SALARY)
def test_parse_salary(spark, raw, v1, v2, v3):
    df = one_col(spark, [raw])
    for v, exp in (("v1", v1), ("v2", v2), ("v3", v3)):
        p = df.select(M.parse_salary("s", v).alias("p")).first()["p"]
        assert (p["salary_min"], p["salary_max"]) == exp, v
        if exp[0] is not None:
            assert p["salary_avg"] == (exp[0] + exp[1]) / 2


def test_salary_v2_estimated_and_unit(spark):
    df = one_col(spark, ["Estimation 28 000 € → 32 000 €", "12,50 - 13,75 € / heure", None])
    rows = df.select(M.parse_salary("s", "v2").alias("p")).collect()
    assert [r["p"]["salary_estimated"] for r in rows] == [True, False, False]
    assert [r["p"]["salary_unit"] for r in rows] == ["annual", "hourly", None]


EXPERIENCE = [
    ("Exp. 1 à 7 ans", (2, "1-7 ans"), 4.0, 4.0),
    ("1 à 7 ans", (3, "7 ans"), 4.0, 4.0),
    ("Exp. 0 à 1 an", (0, "0-1 ans"), 0.5, 0.5),
    ("5 ans d'expérience", (2, "5 ans"), 5.0, 5.0),
    ("Débutant accepté, 2 ans", (1, "2 ans"), 0.0, 2.0),
    ("Débutant accepté", (0, "débutant"), 0.0, None),
    ("Banque • Assurance", (-1, "Banque • Assurance"), None, None),
    ("Bac +2", (-1, "Bac +2"), None, None),
    ("Capacité", (-1, "Capacité"), None, None),
    ("Non précisé", (-1, "Non précisé"), None, None),
]


@pytest.mark.parametrize("raw,v2,v1y,v3y", EXPERIENCE)
def test_experience(spark, raw, v2, v1y, v3y):
    r = one_col(spark, [raw]).select(X.experience_v2("s").alias("x"), X.experience_years("s", "v1").alias("y1"),
                                     X.experience_years("s", "v3").alias("y3")).first()
    assert (r["x"]["experience_encoded"], r["x"]["experience_raw"]) == v2
    assert r["y1"] == v1y and r["y3"] == v3y


def test_experience_labels(spark):
    rows = one_col(spark, ["Banque • Assurance", "Bac +2", "Capacité", None]).select(
        X.experience_v2("s").alias("x")).collect()
    assert [r["x"]["experience_label"] for r in rows] == ["Secteur mentionné", "Niveau études", "Niveau études",
                                                           "Non précisé"]


LOCATION = [
    ("Paris - 75", ("Paris", "75")), ("75 - Paris", ("Paris", "75")), ("Paris (75)", ("Paris", "75")),
    ("Paris", ("Paris", NP)), ("Dunkerque - 59", (NP, NP)), ("Ajaccio - 2A", ("Ajaccio", "02")),
    ("Saint-Denis - 974", ("Saint-Denis", "97")), ("Lyon 3e - 69", ("E", "69")), ("Lyon 69", (NP, NP)),
    ("75001", (NP, NP)), ("30 000 € brut", (NP, NP)), (None, (NP, NP)), ("L'Isle - 1", ("Isle", "01")),
    ("Saint-Étienne - 42", ("Saint-Étienne", "42")), ("69 - Lyon", ("Lyon", "69")),
]


@pytest.mark.parametrize("raw,exp", LOCATION)
def test_location_v3(spark, raw, exp):
    r = one_col(spark, [raw]).select(G.location_v3("s").alias("l")).first()["l"]
    assert (r["city"], r["department"]) == exp


def test_location_v2(spark):
    rows = one_col(spark, ["Paris - 75 - x", "Paris", None]).select(G.location_v2("s").alias("l")).collect()
    assert [(r["l"]["ville"], r["l"]["departement"]) for r in rows] == [("Paris", "75"), ("Paris", "N/A"),
                                                                        ("Non précisé", "N/A")]


def test_title_case_matches_python(spark):
    words = ["saint-denis l'isle", "lyon 3e", "élodie-ève", "a"]
    rows = one_col(spark, words).select(G.title_case("s").alias("t")).collect()
    assert [r["t"] for r in rows] == [w.title() for w in words]


def test_department_num(spark):
    rows = one_col(spark, ["Non précisé", "75", "02", "2A", None, "97.5"]).select(
        G.department_num("s").alias("d")).collect()
    assert [r["d"] for r in rows] == [-1, 75, 2, -1, -1, 97]
