"""The reference's three ETL generations as single projections.

Each is one ``select`` of Catalyst expressions over the input (no shuffle),
except the v3 quantile classes, which add one global aggregate (a one-row
broadcast).  Column names follow the reference's outputs; ``offer_id`` is
kept as an explicit key (the reference relied on row position).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerlens.functions import dates as D
from offerlens.functions import experience as X
from offerlens.functions import geo as G
from offerlens.functions import salary as M
from offerlens.functions import skills as K
from offerlens.functions import text as T
from offerlens.operators import quality as Q
from offerlens.operators.salary import with_salary_class

# The exported columns and their order.
ML_COLUMNS = ["category", "title_clean", "description_clean", "company_clean", "contract_type", "city",
              "department", "remote", "experience_years", "salary_min", "salary_max", "salary_avg",
              "salary_unit", "salary_category"]

# Fixed value: v3 company default.
COMPANY_DEFAULT_V3 = "Entreprise non précisée"


def offers_ml_base(df: DataFrame, key: str = "offer_id", title: str = "title",
                   description: str = "description", keep: tuple[str, ...] = ()) -> DataFrame:
    """v3 without the quantile classes: text clean, salary v3, experience
    years, remote int, location v3.  One projection of one scan; reports that
    read no class start here."""
    sal = M.parse_salary("salary", "v3")
    loc = G.location_v3("location")
    return df.select(
        F.col(key), *keep, "category",
        T.clean_text(title, "v3").alias("title_clean"),
        T.clean_text(description, "v3").alias("description_clean"),
        T.clean_text(F.coalesce(F.col("company"), F.lit(COMPANY_DEFAULT_V3)), "v3").alias("company_clean"),
        "contract_type",
        loc["city"].alias("city"), loc["department"].alias("department"),
        F.col("remote").cast("int").alias("remote"),
        X.experience_years("experience", "v3").alias("experience_years"),
        sal["salary_min"].alias("salary_min"), sal["salary_max"].alias("salary_max"),
        sal["salary_avg"].alias("salary_avg"), sal["salary_unit"].alias("salary_unit"),
    )


def offers_ml(df: DataFrame, key: str = "offer_id", title: str = "title",
              description: str = "description", approx_quantiles: bool = False,
              keep: tuple[str, ...] = ()) -> DataFrame:
    """v3: ``offers_ml_base`` and the quantile salary classes; the 14 exported
    columns plus the key (and any ``keep`` columns passed through)."""
    base = offers_ml_base(df, key, title, description, keep)
    return with_salary_class(base, approx=approx_quantiles).select(key, *ML_COLUMNS, *keep)


# v2 raw-column defaults.
V2_DEFAULTS = {
    "title": "Poste non précisé",
    "company": "Entreprise confidentielle",
    "location": "France",
    "contract_type": "CDI",
    "education": "Non précisé",
    "experience": "Non précisé",
    "description": "Non renseignée",
    "published_date": "01/01/2025",
    "salary": "Pas de salaire renseigné",
}


def offers_enriched(df: DataFrame, as_of: str | dt.date, key: str = "offer_id",
                    keep: tuple[str, ...] = ()) -> DataFrame:
    """v2: null markers, defaults, clean, location v2, salary v2, experience
    v2, skills, dates, fixed salary bins, remote and urgent flags."""
    x = Q.fill_defaults(Q.null_markers(df), V2_DEFAULTS)
    x = x.select(
        "*",
        T.clean_text("title", "v2").alias("titre_clean"),
        T.clean_text("company", "v2").alias("entreprise_clean"),
        T.clean_text("description", "v2").alias("description_clean"),
    )
    loc = G.location_v2("location")
    sal = M.parse_salary("salary", "v2")
    exp = X.experience_v2("experience")
    x = K.with_skills(x, F.concat(F.col("titre_clean"), F.lit(" "), F.col("description_clean")))
    pub = D.parse_date("published_date")
    x = x.select(
        "*",
        loc["ville"].alias("ville"), loc["departement"].alias("departement"),
        exp["experience_encoded"].alias("experience_encoded"),
        exp["experience_label"].alias("experience_label"),
        exp["experience_raw"].alias("experience_raw"),
        sal["salary_min"].alias("salary_min"), sal["salary_max"].alias("salary_max"),
        sal["salary_avg"].alias("salary_avg"), sal["salary_estimated"].alias("salary_estimated"),
        sal["salary_unit"].alias("salary_unit"),
        pub.alias("date_publication"),
        T.remote_flag_v2("titre_clean", "description_clean").alias("remote_possible"),
        T.urgent_flag("titre_clean", "description_clean").alias("urgent"),
    )
    return x.select(
        key, "url", "title", "company", "location", "contract_type", "education", "experience",
        "published_date", "salary", "description",
        "titre_clean", "entreprise_clean", "description_clean", "ville", "departement",
        "experience_encoded", "experience_label", "experience_raw",
        "salary_min", "salary_max", "salary_avg", "salary_estimated", "salary_unit",
        M.fixed_bins("salary_avg").alias("salary_category"),
        K.skills_string("skills_list").alias("skills"), "skills_list",
        F.size("skills_list").alias("nb_skills"),
        "date_publication", D.days_since("date_publication", as_of).alias("days_since_publication"),
        "remote_possible", "urgent", *keep,
    )


def offers_structured(df: DataFrame, key: str = "offer_id") -> DataFrame:
    """v1 on the offers fixture: sparse-column drop, clean, salary v1, remote
    (with 'hybride'), experience years v1, final fills."""
    x = df.select(
        F.col(key),
        F.coalesce(F.col("title"), F.lit("")).alias("titre"),
        F.coalesce(F.col("description"), F.lit("")).alias("description"),
        F.coalesce(F.col("company"), F.lit("")).alias("company"),
        F.col("salary").alias("salaire"), "experience",
    )
    x = x.select("*", T.clean_text("titre", "v1").alias("titre_clean"),
                 T.clean_text("description", "v1").alias("description_clean"),
                 T.clean_text("company", "v1").alias("company_clean"))
    sal = M.parse_salary("salaire", "v1")
    return x.select(
        "*",
        sal["salary_min"].alias("salary_min"), sal["salary_max"].alias("salary_max"),
        sal["salary_avg"].alias("salary_avg"),
        T.remote_flag_v1("titre_clean", "description_clean").alias("remote"),
        X.experience_years("experience", "v1").alias("experience_years"),
    )
