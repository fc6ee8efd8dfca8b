"""Registered queries: one Spark callable ``(spark, sf_dir) -> DataFrame`` per
oracle text over the same driver tables.

Every query reads the driver tables (or the job-offer views Spark derives
from them, ``offerlens.sources.fixtures``) in full.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerlens.functions import salary as M
from offerlens.operators import reports as R
from offerlens.plans import duck as Dk
from offerlens.plans import etl
from offerlens.sources import fixtures as FX

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Reference date for ages: an argument, never the clock.
AS_OF = "2026-01-01"


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = FX.with_fixtures(sql)
        return fn
    return deco


# --------------------------------------------------------------------------
# Shared DuckDB CTEs (oracle side only)
# --------------------------------------------------------------------------

def ml_cte() -> str:
    """DuckDB twin of ``etl.offers_ml`` (+ cluster), as CTEs ending in ``ml``."""
    sal = Dk.parse_salary("salary", "v3")
    loc = Dk.location_v3("location")
    return f"""ml0 AS (
  SELECT offer_id, cluster, category,
    {Dk.clean_text('title', 'v3')} AS title_clean,
    {Dk.clean_text('description', 'v3')} AS description_clean,
    {Dk.clean_text("coalesce(company, 'Entreprise non précisée')", 'v3')} AS company_clean,
    contract_type, {loc} AS loc, CAST(remote AS INTEGER) AS remote,
    {Dk.experience_years('experience', 'v3')} AS experience_years,
    {sal} AS sal
  FROM offers),
ml1 AS (
  SELECT offer_id, cluster, category, title_clean, description_clean, company_clean, contract_type,
    loc.city AS city, loc.department AS department, remote, experience_years,
    sal.salary_min AS salary_min, sal.salary_max AS salary_max, sal.salary_avg AS salary_avg,
    sal.salary_unit AS salary_unit
  FROM ml0),
th AS (
  SELECT quantile_cont(salary_avg, 0.33) AS q33, quantile_cont(salary_avg, 0.66) AS q66
  FROM ml1 WHERE salary_avg IS NOT NULL),
ml AS (
  SELECT ml1.*, CASE WHEN salary_avg IS NULL THEN NULL WHEN salary_avg <= q33 THEN 'Bas'
    WHEN salary_avg <= q66 THEN 'Moyen' ELSE 'Haut' END AS salary_category
  FROM ml1, th)"""


def dash_cte() -> str:
    """Dashboard input: offers_ml with the load-time fills."""
    return ml_cte() + """,
dash AS (
  SELECT offer_id, coalesce(category, 'Inconnu') AS category,
    coalesce(contract_type, 'Inconnu') AS contract_type,
    coalesce(salary_category, 'Inconnu') AS salary_category,
    coalesce(cluster, -1) AS cluster, coalesce(remote, 0) AS remote, salary_avg
  FROM ml)"""


def _ml(spark: SparkSession, sf: str) -> DataFrame:
    return etl.offers_ml(FX.offers(spark, sf), keep=("cluster",))


def _base(spark: SparkSession, sf: str) -> DataFrame:
    """Parsed offers without the quantile class: one scan."""
    return etl.offers_ml_base(FX.offers(spark, sf), keep=("cluster",))


def _dash(spark: SparkSession, sf: str) -> DataFrame:
    return R.dashboard_fill(_ml(spark, sf))


def _dash_base(spark: SparkSession, sf: str) -> DataFrame:
    """Dashboard rows of the reports that read no salary class."""
    return R.dashboard_fill(_base(spark, sf))


# --------------------------------------------------------------------------
# Salary (M1-M8)
# --------------------------------------------------------------------------

def _salary_query(variant: str):
    def fn(spark: SparkSession, sf: str) -> DataFrame:
        o = FX.offers(spark, sf)
        s = M.parse_salary("salary", variant)
        fields = ["salary_min", "salary_max", "salary_avg"]
        fields += {"v1": [], "v2": ["salary_estimated", "salary_unit"], "v3": ["salary_unit"]}[variant]
        return o.select("offer_id", "salary", *[s[f].alias(f) for f in fields])
    return fn


def _salary_sql(variant: str) -> str:
    fields = ["salary_min", "salary_max", "salary_avg"]
    fields += {"v1": [], "v2": ["salary_estimated", "salary_unit"], "v3": ["salary_unit"]}[variant]
    return (f"SELECT offer_id, salary, {', '.join(f's.{f} AS {f}' for f in fields)} FROM "
            f"(SELECT offer_id, salary, {Dk.parse_salary('salary', variant)} AS s FROM offers)")


for _v in ("v1", "v2", "v3"):
    query(f"salary_{_v}", _salary_sql(_v))(_salary_query(_v))


@query("salary_bins_fixed", f"""
SELECT offer_id, s.salary_avg AS salary_avg, {Dk.fixed_bins('s.salary_avg')} AS salary_category
FROM (SELECT offer_id, {Dk.parse_salary('salary', 'v2')} AS s FROM offers)""")
def salary_bins_fixed(spark, sf):
    o = FX.offers(spark, sf)
    s = M.parse_salary("salary", "v2")
    return o.select("offer_id", s["salary_avg"].alias("salary_avg"),
                    M.fixed_bins(s["salary_avg"]).alias("salary_category"))


@query("salary_bins_quantile", f", {ml_cte()}\nSELECT offer_id, salary_avg, salary_category FROM ml")
def salary_bins_quantile(spark, sf):
    return _ml(spark, sf).select("offer_id", "salary_avg", "salary_category")


# --------------------------------------------------------------------------
# Dashboard reports
# --------------------------------------------------------------------------

@query("avg_salary_by_contract", f""", {dash_cte()}
SELECT contract_type, avg(salary_avg) AS salary_avg FROM dash
WHERE salary_avg IS NOT NULL GROUP BY contract_type""")
def avg_salary_by_contract(spark, sf):
    return R.avg_salary_by(_dash_base(spark, sf), "contract_type")


@query("avg_salary_by_cluster", f""", {dash_cte()}
SELECT cluster, avg(salary_avg) AS salary_avg FROM dash
WHERE salary_avg IS NOT NULL GROUP BY cluster""")
def avg_salary_by_cluster(spark, sf):
    return R.avg_salary_by(_dash_base(spark, sf), "cluster")


@query("count_by_contract", f""", {dash_cte()}
SELECT contract_type, count(*) AS nb FROM dash GROUP BY contract_type""")
def count_by_contract(spark, sf):
    return R.count_by(_dash_base(spark, sf), "contract_type")


@query("count_by_salary_class", f""", {dash_cte()}
SELECT salary_category, count(*) AS nb FROM dash GROUP BY salary_category""")
def count_by_salary_class(spark, sf):
    return R.count_by(_dash(spark, sf), "salary_category")


@query("count_by_cluster", f""", {dash_cte()}
SELECT cluster, count(*) AS nb FROM dash GROUP BY cluster""")
def count_by_cluster(spark, sf):
    return R.count_by(_dash_base(spark, sf), "cluster")


@query("kpis", f""", {dash_cte()}
SELECT count(*) AS n_offers, round_even(avg(salary_avg), 0) AS mean_salary,
  round_even(avg(CAST(remote AS DOUBLE)) * 100.0, 1) AS remote_pct FROM dash""")
def kpis(spark, sf):
    return R.kpis(_dash_base(spark, sf))


@query("filter_options", f""", {dash_cte()}
SELECT DISTINCT 'category' AS "column", category AS value FROM dash
UNION SELECT DISTINCT 'contract_type', contract_type FROM dash
UNION SELECT DISTINCT 'cluster', CAST(cluster AS VARCHAR) FROM dash
UNION SELECT DISTINCT 'salary_category', salary_category FROM dash""")
def filter_options(spark, sf):
    return R.filter_options(_dash(spark, sf))


# Dashboard selection used by the filtered report (the user's dropdown state).
FILTER_SELECTION = dict(categories=["BUILDING", "MACHINERY", "AUTOMOBILE"], contracts=["CDI", "Stage"],
                        clusters=[0, 1, 2, 3, 5, -1], salary_classes=["Bas", "Haut", "Inconnu"])


@query("filtered_offers", f""", {dash_cte()}
SELECT * FROM dash WHERE category IN ('BUILDING', 'MACHINERY', 'AUTOMOBILE')
  AND contract_type IN ('CDI', 'Stage') AND cluster IN (0, 1, 2, 3, 5, -1)
  AND salary_category IN ('Bas', 'Haut', 'Inconnu')""")
def filtered_offers(spark, sf):
    d = _dash(spark, sf).select("offer_id", "category", "contract_type", "salary_category", "cluster",
                                "remote", "salary_avg")
    return R.filtered_offers(d, **FILTER_SELECTION)


@query("filtered_kpis_empty_filters", f""", {dash_cte()}
SELECT count(*) AS n_offers, round_even(avg(salary_avg), 0) AS mean_salary,
  round_even(avg(CAST(remote AS DOUBLE)) * 100.0, 1) AS remote_pct FROM dash""")
def filtered_kpis_empty_filters(spark, sf):
    """Empty selections mean 'no filter' (the dashboard's initial state)."""
    return R.kpis(R.filtered_offers(_dash_base(spark, sf), categories=[], contracts=None, clusters=[],
                                    salary_classes=[]))


@query("dashboard_reports", f""", {dash_cte()}
SELECT 'contract_type' AS report, contract_type AS key, count(*) AS nb, avg(salary_avg) AS salary_avg
FROM dash GROUP BY contract_type
UNION ALL SELECT 'salary_category', salary_category, count(*), avg(salary_avg) FROM dash GROUP BY salary_category
UNION ALL SELECT 'cluster', CAST(cluster AS VARCHAR), count(*), avg(salary_avg) FROM dash GROUP BY cluster""")
def dashboard_reports(spark, sf):
    return R.dashboard_reports(_dash(spark, sf))


@query("class_distribution", f""", {ml_cte()}
SELECT salary_category, n, round_even(n * 100.0 / sum(n) OVER (), 1) AS pct
FROM (SELECT salary_category, count(*) AS n FROM ml GROUP BY salary_category)""")
def class_distribution(spark, sf):
    return R.class_distribution(_ml(spark, sf))


@query("target_guard", f""", {ml_cte()}
SELECT count(*) AS n_rows, count(salary_avg) AS n_salaried, count(salary_category) AS n_labeled,
  list_sort(list_distinct(list(salary_category))) AS classes,
  count(salary_avg) >= 50 AS enough_salaries,
  list_sort(list_distinct(list(salary_category))) = ['Bas', 'Haut', 'Moyen'] AS classes_ok
FROM ml""")
def target_guard(spark, sf):
    from offerlens.operators.salary import target_guard as tg
    return tg(_ml(spark, sf))


@query("salary_summary", f""", {ml_cte()}
SELECT count(*) AS n_rows, count(salary_avg) AS n_salaried, median(salary_avg) AS median_salary,
  count(salary_avg) / count(*) AS share_salaried FROM ml""")
def salary_summary(spark, sf):
    from offerlens.operators.salary import salary_summary as ss
    return ss(_base(spark, sf))


@query("labeled_only", f", {ml_cte()}\nSELECT offer_id, salary_category FROM ml WHERE salary_category IS NOT NULL")
def labeled_only(spark, sf):
    from offerlens.operators.quality import labeled_only as lo
    return lo(_ml(spark, sf)).select("offer_id", "salary_category")


@query("export_projection", f", {ml_cte()}\nSELECT offer_id, {', '.join(etl.ML_COLUMNS)} FROM ml")
def export_projection(spark, sf):
    return _ml(spark, sf).select("offer_id", *etl.ML_COLUMNS)


# --------------------------------------------------------------------------
# Location (L1-L4)
# --------------------------------------------------------------------------

@query("location_v2", f"""
SELECT offer_id, location, l.ville AS ville, l.departement AS departement
FROM (SELECT offer_id, location, {Dk.location_v2('location')} AS l FROM offers)""")
def location_v2(spark, sf):
    from offerlens.functions.geo import location_v2 as f
    l2 = f("location")
    return FX.offers(spark, sf).select("offer_id", "location", l2["ville"].alias("ville"),
                                       l2["departement"].alias("departement"))


@query("location_v3", f"""
SELECT offer_id, location, l.city AS city, l.department AS department
FROM (SELECT offer_id, location, {Dk.location_v3('location')} AS l FROM offers)""")
def location_v3(spark, sf):
    from offerlens.functions.geo import location_v3 as f
    l3 = f("location")
    return FX.offers(spark, sf).select("offer_id", "location", l3["city"].alias("city"),
                                       l3["department"].alias("department"))


@query("department_num", f""", {ml_cte()}
SELECT offer_id, department, {Dk.department_num('department')} AS department_num FROM ml""")
def department_num(spark, sf):
    from offerlens.functions.geo import department_num as f
    return _base(spark, sf).select("offer_id", "department", f("department").alias("department_num"))


# --------------------------------------------------------------------------
# Experience
# --------------------------------------------------------------------------

@query("experience_v2", f"""
SELECT offer_id, experience, x.experience_encoded AS experience_encoded,
  x.experience_label AS experience_label, x.experience_raw AS experience_raw
FROM (SELECT offer_id, experience, {Dk.experience_v2('experience')} AS x FROM offers)""")
def experience_v2(spark, sf):
    from offerlens.functions.experience import experience_v2 as f
    x = f("experience")
    return FX.offers(spark, sf).select("offer_id", "experience", *[x[c].alias(c) for c in
                                       ("experience_encoded", "experience_label", "experience_raw")])


for _v in ("v1", "v3"):
    def _exp_years(spark, sf, _v=_v):
        from offerlens.functions.experience import experience_years as f
        return FX.offers(spark, sf).select("offer_id", "experience",
                                           f("experience", _v).alias("experience_years"))
    query(f"experience_years_{_v}",
          f"SELECT offer_id, experience, {Dk.experience_years('experience', _v)} AS experience_years "
          f"FROM offers")(_exp_years)


# --------------------------------------------------------------------------
# Dates (D1-D3)
# --------------------------------------------------------------------------

@query("parse_date", f"SELECT offer_id, published_date, {Dk.parse_date('published_date')} AS date_publication FROM offers")
def parse_date(spark, sf):
    from offerlens.functions.dates import parse_date as f
    return FX.offers(spark, sf).select("offer_id", "published_date", f("published_date").alias("date_publication"))


@query("days_since", f"""SELECT offer_id, {Dk.days_since(Dk.parse_date('published_date'), AS_OF)} AS days_since_publication
FROM offers""")
def days_since(spark, sf):
    from offerlens.functions.dates import days_since as f, parse_date as p
    return FX.offers(spark, sf).select("offer_id", f(p("published_date"), AS_OF).alias("days_since_publication"))


@query("age_range", f"""SELECT min(d) AS min_days, max(d) AS max_days FROM
(SELECT {Dk.days_since(Dk.parse_date('published_date'), AS_OF)} AS d FROM offers)""")
def age_range(spark, sf):
    from offerlens.functions.dates import days_since as f, parse_date as p
    d = FX.offers(spark, sf).select(f(p("published_date"), AS_OF).alias("d"))
    return d.agg(F.min("d").alias("min_days"), F.max("d").alias("max_days"))


@query("published_date_extract", """SELECT offer_id,
  CASE WHEN regexp_matches(concat('Publiée le ', published_date, ' par ', category), 'Publiée le ([0-9]{2}/[0-9]{2}/[0-9]{4})')
  THEN regexp_extract(concat('Publiée le ', published_date, ' par ', category), 'Publiée le ([0-9]{2}/[0-9]{2}/[0-9]{4})', 1)
  ELSE 'N/A' END AS date_pub FROM offers""")
def published_date_extract(spark, sf):
    """Date block text of a listing ('Publiée le dd/MM/yyyy par ...')."""
    from offerlens.functions.dates import published_date_extract as f
    o = FX.offers(spark, sf)
    block = F.concat(F.lit("Publiée le "), F.col("published_date"), F.lit(" par "), F.col("category"))
    return o.select("offer_id", f(block).alias("date_pub"))


# --------------------------------------------------------------------------
# Cleaning and flags
# --------------------------------------------------------------------------

for _v in ("v1", "v2", "v3"):
    def _clean(spark, sf, _v=_v):
        from offerlens.functions.text import clean_text
        t = FX.offer_texts(spark, sf)
        return t.select("offer_id", clean_text("title", _v).alias("title_clean"),
                        clean_text("description", _v).alias("description_clean"))
    query(f"clean_text_{_v}",
          f"SELECT offer_id, {Dk.clean_text('title', _v)} AS title_clean, "
          f"{Dk.clean_text('description', _v)} AS description_clean FROM offer_texts")(_clean)


@query("clean_text_cluster", f"""SELECT offer_id, text_clean FROM (
SELECT offer_id, {Dk.clean_cluster_text(Dk.text_all(Dk.clean_text('title', 'v3'), Dk.clean_text('description', 'v3')))} AS text_clean
FROM offer_texts) WHERE length(text_clean) > 0""")
def clean_text_cluster(spark, sf):
    from offerlens.functions.text import clean_cluster_text, clean_text, text_all
    from offerlens.session import materialize
    t = FX.offer_texts(spark, sf)
    x = t.select("offer_id", clean_cluster_text(text_all(clean_text("title", "v3"),
                                                          clean_text("description", "v3"))).alias("text_clean"))
    # written first: Catalyst would evaluate the filter, with all the cleaning, below the scan's repartition
    return materialize(x, "cluster_texts").where(F.length("text_clean") > 0)


@query("text_all", f""", {ml_cte()}
SELECT offer_id, {Dk.text_all('title_clean', 'description_clean')} AS text_all FROM ml""")
def text_all(spark, sf):
    from offerlens.functions.text import text_all as f
    return _base(spark, sf).select("offer_id", f("title_clean", "description_clean").alias("text_all"))


@query("bad_text_report", f"""SELECT count_if(contains({Dk.clean_text('description', 'v2')}, 'ces traceurs sont nécessaires')) AS n_tracker_text,
  count(*) AS n_rows FROM offer_texts""")
def bad_text_report(spark, sf):
    from offerlens.functions.text import clean_text, has_tracker_text
    from offerlens.operators.quality import bad_text_report as f
    t = FX.offer_texts(spark, sf)
    return f(t.select(has_tracker_text(clean_text("description", "v2")).alias("has_tracker_text")))


@query("remote_flag", f"""SELECT offer_id,
  {Dk.flag(Dk.contains_any(Dk.clean_text('title', 'v2'), ['télétravail', 'remote', 'distanciel']) + ' OR ' + Dk.contains_any(Dk.clean_text('description', 'v2'), ['télétravail', 'remote', 'distanciel']))} AS remote_possible,
  {Dk.flag(Dk.contains_any("concat(' ', " + Dk.clean_text('title', 'v1') + ", ' ', " + Dk.clean_text('description', 'v1') + ")", ['télétravail', 'remote', 'distanciel', 'hybride']))} AS remote_v1,
  coalesce({Dk.contains_any("lower(concat_ws(' ', title, description))", ['télétravail', 'remote', 'home office', 'hybride'])}, false) AS remote_card
FROM offer_texts""")
def remote_flag(spark, sf):
    from offerlens.functions import text as T
    t = FX.offer_texts(spark, sf)
    return t.select("offer_id",
                    T.remote_flag_v2(T.clean_text("title", "v2"), T.clean_text("description", "v2")).alias("remote_possible"),
                    T.remote_flag_v1(T.clean_text("title", "v1"), T.clean_text("description", "v1")).alias("remote_v1"),
                    T.remote_flag_card(F.concat_ws(" ", "title", "description")).alias("remote_card"))


@query("urgent_flag", f"""SELECT offer_id,
  {Dk.flag(Dk.contains_any(Dk.clean_text('title', 'v2'), ['urgent', 'immédiat', 'rapidement']) + ' OR ' + Dk.contains_any(Dk.clean_text('description', 'v2'), ['urgent', 'immédiat', 'rapidement', 'dès que possible']))} AS urgent
FROM offer_texts""")
def urgent_flag(spark, sf):
    from offerlens.functions import text as T
    t = FX.offer_texts(spark, sf)
    return t.select("offer_id", T.urgent_flag(T.clean_text("title", "v2"), T.clean_text("description", "v2")).alias("urgent"))


_STR_COLS = ["category", "title", "company", "contract_type", "salary", "location", "experience",
             "education", "published_date", "description", "url"]


@query("null_markers", "SELECT offer_id, " + ", ".join(f"{Dk.null_marker(c)} AS {c}" for c in _STR_COLS)
       + " FROM offers")
def null_markers(spark, sf):
    from offerlens.operators.quality import null_markers as f
    return f(FX.offers(spark, sf).select("offer_id", *_STR_COLS))


@query("fill_defaults_cols", "SELECT offer_id, " + ", ".join(
    f"coalesce({Dk.null_marker(c)}, {Dk.q(etl.V2_DEFAULTS[c])}) AS {c}" if c in etl.V2_DEFAULTS
    else f"{Dk.null_marker(c)} AS {c}" for c in _STR_COLS) + " FROM offers")
def fill_defaults_cols(spark, sf):
    from offerlens.operators.quality import fill_defaults, null_markers as nm
    return fill_defaults(nm(FX.offers(spark, sf).select("offer_id", *_STR_COLS)), etl.V2_DEFAULTS)


@query("drop_sparse_columns", """SELECT offer_id, category, title, company, contract_type, salary, location,
  experience, education, published_date, description, remote, cluster, url, scraped_at, sparse_note
FROM (SELECT *, CASE WHEN offer_id % 3 = 0 THEN 'rare' END AS sparse_note,
  CASE WHEN offer_id % 10 = 0 THEN 'x' END AS "Source" FROM offers)""")
def drop_sparse_columns(spark, sf):
    """A listed column ('Source') and a mostly-null one are dropped; a column with
    a third of values survives (share < 0.7 is kept)."""
    from offerlens.operators.quality import drop_sparse_columns as f
    o = FX.offers(spark, sf).select(
        "*", F.when(F.col("offer_id") % 3 == 0, F.lit("rare")).alias("sparse_note"),
        F.when(F.col("offer_id") % 10 == 0, F.lit("x")).alias("Source"),
        F.when(F.col("offer_id") % 10 == 1, F.lit("y")).alias("mostly_empty"))
    return f(o)


# --------------------------------------------------------------------------
# v2 enriched table, skills, distributions
# --------------------------------------------------------------------------

_ENRICHED_OUT = ["offer_id", "url", "title", "company", "location", "contract_type", "education", "experience",
                 "published_date", "salary", "description", "titre_clean", "entreprise_clean",
                 "description_clean", "ville", "departement", "experience_encoded", "experience_label",
                 "experience_raw", "salary_min", "salary_max", "salary_avg", "salary_estimated", "salary_unit",
                 "salary_category", "skills", "skills_list", "nb_skills", "date_publication",
                 "days_since_publication", "remote_possible", "urgent"]


def enr_cte(source: str = "offers") -> str:
    cols = ", ".join(
        f"coalesce({Dk.null_marker(c)}, {Dk.q(etl.V2_DEFAULTS[c])}) AS {c}" if c in etl.V2_DEFAULTS
        else f"{Dk.null_marker(c)} AS {c}" for c in _STR_COLS)
    return f"""enr0 AS (SELECT offer_id, cluster, {cols} FROM {source}),
enr1 AS (SELECT *, {Dk.clean_text('title', 'v2')} AS titre_clean, {Dk.clean_text('company', 'v2')} AS entreprise_clean,
  {Dk.clean_text('description', 'v2')} AS description_clean FROM enr0),
enr2 AS (SELECT *, {Dk.location_v2('location')} AS loc, {Dk.parse_salary('salary', 'v2')} AS sal,
  {Dk.experience_v2('experience')} AS ex, {Dk.skills_list("concat(titre_clean, ' ', description_clean)")} AS skills_list,
  {Dk.parse_date('published_date')} AS date_publication,
  {Dk.flag(Dk.contains_any('titre_clean', ['télétravail', 'remote', 'distanciel']) + ' OR ' + Dk.contains_any('description_clean', ['télétravail', 'remote', 'distanciel']))} AS remote_possible,
  {Dk.flag(Dk.contains_any('titre_clean', ['urgent', 'immédiat', 'rapidement']) + ' OR ' + Dk.contains_any('description_clean', ['urgent', 'immédiat', 'rapidement', 'dès que possible']))} AS urgent
  FROM enr1),
enr AS (SELECT offer_id, cluster, url, title, company, location, contract_type, education, experience, published_date,
  salary, description, titre_clean, entreprise_clean, description_clean, loc.ville AS ville,
  loc.departement AS departement, ex.experience_encoded AS experience_encoded,
  ex.experience_label AS experience_label, ex.experience_raw AS experience_raw,
  sal.salary_min AS salary_min, sal.salary_max AS salary_max, sal.salary_avg AS salary_avg,
  sal.salary_estimated AS salary_estimated, sal.salary_unit AS salary_unit,
  {Dk.fixed_bins('sal.salary_avg')} AS salary_category,
  CASE WHEN len(skills_list) > 0 THEN array_to_string(skills_list, ', ') ELSE 'aucune' END AS skills,
  skills_list, CAST(len(skills_list) AS INTEGER) AS nb_skills, date_publication,
  {Dk.days_since('date_publication', AS_OF)} AS days_since_publication, remote_possible, urgent
  FROM enr2)"""


def _enr(spark: SparkSession, sf: str) -> DataFrame:
    return etl.offers_enriched(FX.offers(spark, sf), AS_OF, keep=("cluster",))


@query("offers_enriched", f", {enr_cte()}\nSELECT {', '.join(_ENRICHED_OUT)} FROM enr")
def offers_enriched(spark, sf):
    return _enr(spark, sf).select(*_ENRICHED_OUT)


@query("experience_distribution", f""", {enr_cte()}
SELECT experience_encoded, count(*) AS n, arg_min(experience_label, offer_id) AS experience_label
FROM enr GROUP BY experience_encoded""")
def experience_distribution(spark, sf):
    e = _enr(spark, sf)
    return (e.groupBy("experience_encoded")
            .agg(F.count(F.lit(1)).alias("n"), F.min_by("experience_label", "offer_id").alias("experience_label"))
            .orderBy("experience_encoded"))


@query("quality_report", f""", {enr_cte()}
SELECT count(*) AS n_rows, count(salary_avg) AS n_salary,
  round_even(count(salary_avg) * 100.0 / count(*), 1) AS pct_salary,
  count_if(nb_skills > 0) AS n_skills, round_even(count_if(nb_skills > 0) * 100.0 / count(*), 1) AS pct_skills,
  sum(remote_possible) AS n_remote, sum(urgent) AS n_urgent, count(DISTINCT ville) AS n_cities,
  count(DISTINCT entreprise_clean) AS n_companies, avg(nb_skills) AS mean_skills,
  count(experience_encoded) AS n_experience FROM enr""")
def quality_report(spark, sf):
    from offerlens.operators.quality import quality_report as f
    return f(_enr(spark, sf))


@query("geo_cardinality", f""", {enr_cte()}
SELECT count(DISTINCT ville) AS n_ville, count(DISTINCT departement) AS n_departement,
  count(DISTINCT entreprise_clean) AS n_entreprise_clean FROM enr""")
def geo_cardinality(spark, sf):
    from offerlens.operators.quality import geo_cardinality as f
    return f(_enr(spark, sf))


@query("value_counts", """SELECT experience, count(*) AS n FROM offers WHERE experience IS NOT NULL
GROUP BY experience ORDER BY n DESC, experience LIMIT 20""")
def value_counts(spark, sf):
    return R.value_counts(FX.offers(spark, sf), "experience", 20)


_PROFILE = ["salary_min", "salary_max", "nb_skills", "days_since_publication", "urgent", "remote_possible",
            "experience_encoded"]


@query("cluster_profile", f""", {enr_cte()}
SELECT cluster, {', '.join(f'avg({c}) AS {c}' for c in _PROFILE)} FROM enr
WHERE cluster IS NOT NULL GROUP BY cluster""")
def cluster_profile(spark, sf):
    return R.cluster_profile(_enr(spark, sf), _PROFILE)


def _texts_skills(spark, sf):
    from offerlens.functions.skills import with_skills
    from offerlens.functions.text import clean_text
    t = FX.offer_texts(spark, sf).select("offer_id", "title", "description")
    txt = F.concat(clean_text("title", "v2"), F.lit(" "), clean_text("description", "v2"))
    return with_skills(t, txt).select("offer_id", "skills_list")


_TXT = f"concat({Dk.clean_text('title', 'v2')}, ' ', {Dk.clean_text('description', 'v2')})"


@query("skills_extract", f"SELECT offer_id, {Dk.skills_list(_TXT)} AS skills_list FROM offer_texts")
def skills_extract(spark, sf):
    return _texts_skills(spark, sf)


@query("skills_summary", f"""SELECT offer_id, CAST(len(s) AS INTEGER) AS nb_skills,
  CASE WHEN len(s) > 0 THEN array_to_string(s, ', ') ELSE 'aucune' END AS skills
FROM (SELECT offer_id, {Dk.skills_list(_TXT)} AS s FROM offer_texts)""")
def skills_summary(spark, sf):
    from offerlens.functions.skills import skills_string
    s = _texts_skills(spark, sf)
    return s.select("offer_id", F.size("skills_list").alias("nb_skills"), skills_string("skills_list").alias("skills"))


@query("top_skills", f"""SELECT skill, count(*) AS n FROM
(SELECT unnest({Dk.skills_list(_TXT)}) AS skill FROM offer_texts)
GROUP BY skill ORDER BY n DESC, skill LIMIT 15""")
def top_skills(spark, sf):
    # explode_outer: a plain explode makes Catalyst infer size(skills_list) > 0
    # and push that filter, with the whole skill expression, into the scan.
    s = _texts_skills(spark, sf).select(F.explode_outer("skills_list").alias("skill"))
    return R.value_counts(s, "skill", 15)


# --------------------------------------------------------------------------
# Listing cards (H8-H20, H23), lines (H5, H6)
# --------------------------------------------------------------------------

def _cards(spark, sf):
    return FX.offer_cards(spark, sf)


_JOB_ID_SQL = "coalesce(nullif(regexp_extract(url, '/emplois/([0-9]+)\\.html', 1), ''), concat('unknown_', md5(url)))"


@query("job_id_from_url", f"SELECT offer_id, url, {_JOB_ID_SQL} AS job_id FROM offer_cards")
def job_id_from_url(spark, sf):
    from offerlens.operators.cards import job_id_from_url as f
    return _cards(spark, sf).select("offer_id", "url", f("url").alias("job_id"))


def _tc_sql(only_title: bool = False) -> str:
    s = lambda e: Dk.ustrip(e)
    has_title = "(title_p IS NOT NULL AND title_p <> '')"
    has_company = "(company_p IS NOT NULL AND company_p <> '')"
    attr_set = "(title_attr IS NOT NULL AND title_attr <> '')"
    dash = f"({attr_set} AND contains(title_attr, ' - '))"
    parts = "string_split(title_attr, ' - ')"
    title = (f"CASE WHEN {has_title} THEN title_p WHEN {dash} THEN {s(parts + '[1]')} "
             f"WHEN {attr_set} THEN title_attr ELSE title_p END AS title")
    if only_title:
        return title
    return (title + ", "
            f"CASE WHEN {has_title} THEN company_p WHEN {dash} THEN "
            f"(CASE WHEN NOT {has_company} AND len({parts}) >= 2 THEN {s(parts + '[2]')} ELSE company_p END) "
            f"ELSE company_p END AS company")


@query("title_company_split", f"SELECT offer_id, {_tc_sql()} FROM offer_cards")
def title_company_split(spark, sf):
    from offerlens.operators.cards import title_company
    tc = title_company("title_p", "company_p", "title_attr")
    return _cards(spark, sf).select("offer_id", tc["title"].alias("title"), tc["company"].alias("company"))


def _route_sql() -> str:
    from offerlens.operators.cards import CONTRACTS
    st = f"list_transform(tags, lambda x: {Dk.ustrip('x')})"
    cl = ", ".join(Dk.q(c) for c in CONTRACTS)
    return (f"list_filter({st}, lambda x: contains(x, ' - ') AND regexp_matches(x, '[0-9]'))[-1] AS location, "
            f"list_filter({st}, lambda x: x IN ({cl}))[-1] AS contract_type, "
            f"{Dk.ustrip(chr(40) + 'list_filter(bold, lambda x: contains(x, ' + Dk.q('€') + ') OR contains(lower(x), ' + Dk.q('k') + '))[1])')} AS salary, "
            f"coalesce(tags[1], 'N/A') AS tag0, coalesce(tags[2], 'N/A') AS tag1")


@query("tag_routing", f"SELECT offer_id, {_route_sql()} FROM offer_cards")
def tag_routing(spark, sf):
    from offerlens.operators.cards import route_tags
    r = route_tags("tags", "bold")
    return _cards(spark, sf).select("offer_id", *[r[c].alias(c) for c in
                                    ("location", "contract_type", "salary", "tag0", "tag1")])


@query("short_description", """SELECT offer_id, substr(card_text, 1, 300) AS short_description,
  coalesce(full_description, substr(card_text, 1, 300)) AS description FROM offer_cards""")
def short_description(spark, sf):
    from offerlens.operators.cards import short_description as f
    c = _cards(spark, sf)
    return c.select("offer_id", f("card_text").alias("short_description"),
                    F.coalesce("full_description", f("card_text")).alias("description"))


@query("experience_phrase", f"SELECT offer_id, {Dk.experience_phrase('card_text')} AS experience FROM offer_cards")
def experience_phrase(spark, sf):
    from offerlens.functions.text import experience_phrase as f
    return _cards(spark, sf).select("offer_id", f("card_text").alias("experience"))


@query("offer_dedup", f"""SELECT job_id, offer_id, title, scraped_at FROM (
  SELECT {_JOB_ID_SQL} AS job_id, offer_id, {_tc_sql(True)}, scraped_at FROM offer_cards
) WHERE title IS NOT NULL AND title <> ''
QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY scraped_at, offer_id) = 1""")
def offer_dedup(spark, sf):
    from offerlens.operators.cards import job_id_from_url as jid, offer_dedup as dd, title_company
    c = _cards(spark, sf)
    cards = c.select(jid("url").alias("job_id"), "offer_id",
                     title_company("title_p", "company_p", "title_attr")["title"].alias("title"), "scraped_at")
    return dd(cards)


# Wanted categories and defaults of the category step (user configuration).
WANTED = ["commerce", "distribution", "comptabilité", "ressources humaines"]
DEFAULT_CATEGORIES = [("Emploi Commerce", "/fr-fr/emploi/domaine_commerce.html"),
                      ("Emploi Distribution", "/fr-fr/emploi/domaine_distribution.html"),
                      ("Emploi Comptabilité", "/fr-fr/emploi/domaine_comptabilite.html"),
                      ("Emploi Ressources Humaines", "/fr-fr/emploi/domaine_ressources-humaines.html")]
CATEGORY_MARKER = "/domaine_"


def _planted(spark, sf, tags, columns, longer=None, frames=False):
    """The pages planted from orders, a row per page with its elements (``columns`` of them)."""
    from offerlens.sources.html import page_elements
    return page_elements(FX.offer_pages(spark, sf), columns, tags, longer, frames=frames)


def _category_links(spark, sf):
    from offerlens.operators.pages import category_links
    return category_links(_planted(spark, sf, {"a", "section", "div", "h4"}, ["pos", "tag", "cls", "href", "rendered", "ancestors"]))


# What the planted pages hold, written from the order key alone.
_KEYS_SQL = "k AS (SELECT o_orderkey AS k FROM orders)"
_PLANTED_LINKS_SQL = "links AS (" + " UNION ALL ".join(
    f"SELECT k AS page_id, 'Emploi {c}' AS name, concat('/fr-fr/emploi/domaine_{i}.html?p=', k) AS url FROM k WHERE k % 5 > {i}"
    for i, c in enumerate(["Commerce", "Distribution", "Comptabilité", "Ressources Humaines"])) + ")"


@query("page_links", f""", {_KEYS_SQL}
SELECT k AS page_id, concat('/fr-fr/emplois/', k, '.html') AS href FROM k
UNION ALL SELECT k, concat('/fr-fr/emplois/', k + 1, '.html') FROM k WHERE k % 2 = 0""")
def page_links(spark, sf):
    from offerlens.operators.pages import offer_links
    from offerlens.sources.html import page_blocks
    return offer_links(page_blocks(FX.offer_pages(spark, sf), {"a"}, ["page_id", "tag", "data_cy", "href"], attrs={"data-cy"}))


@query("category_match", f""", {_KEYS_SQL}, {_PLANTED_LINKS_SQL}
SELECT name AS text, arg_max(url, page_id) AS href FROM links GROUP BY name""")
def category_match(spark, sf):
    from offerlens.operators.cards import category_match as f
    return f(_category_links(spark, sf), WANTED, href_marker=CATEGORY_MARKER)


_DEFAULTS_SQL = "[" + ", ".join(f"{{'name': {Dk.q(n)}, 'url': {Dk.q(u)}}}" for n, u in DEFAULT_CATEGORIES) + "]"


@query("fill_defaults", f""", {_KEYS_SQL}, {_PLANTED_LINKS_SQL},
dflt AS (SELECT k AS page_id, unnest({_DEFAULTS_SQL}) AS d FROM k WHERE k % 5 < 4)
SELECT page_id, name, url, 'found' AS origin FROM links
UNION ALL SELECT page_id, d.name, d.url, 'default' FROM dflt
WHERE NOT EXISTS (SELECT 1 FROM links l WHERE l.page_id = dflt.page_id AND l.name = d.name)""")
def fill_defaults(spark, sf):
    """Per page: categories found among its links, name and address; when
    fewer than 4, the defaults not already found are added."""
    from offerlens.operators.cards import category_links_found, fill_defaults as f
    entry = lambda name, url, origin: F.struct(name.alias("name"), url.alias("url"), F.lit(origin).alias("origin"))
    found = category_links_found(_category_links(spark, sf), WANTED, CATEGORY_MARKER)
    found = found.withColumn("found", F.transform("found", lambda x: entry(x["name"], x["url"], "found")))
    dflt = F.array(*[entry(F.lit(n), F.lit(u), "default") for n, u in DEFAULT_CATEGORIES])
    return f(found, dflt, name="name", minimum=4, by="page_id").select("page_id", "name", "url", "origin")


@query("line_dedup", """, l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
    unnest(generate_series(1, len(string_split(text, chr(10))))) AS i FROM documents),
k AS (SELECT doc_id, line, i, """ + Dk.ustrip("line") + """ AS k FROM l),
f AS (SELECT *, min(i) OVER (PARTITION BY doc_id, k) AS first_i FROM k)
SELECT d.doc_id, coalesce((SELECT string_agg(line, chr(10) ORDER BY i) FROM f
  WHERE f.doc_id = d.doc_id AND k <> '' AND i = first_i), '') AS text_dedup FROM documents d""")
def line_dedup(spark, sf):
    from offerlens.operators.lines import dedup_lines
    from offerlens.sources.tables import spread, table
    d = spread(table(spark, sf, "documents"), "doc_id").select("doc_id", "text")
    return dedup_lines(d, "text", "text_dedup").select("doc_id", "text_dedup")


def _bp_sql(e: str) -> str:
    from offerlens.operators.lines import BOILERPLATE, NO_DESCRIPTION
    has = lambda x: "(" + " OR ".join(f"contains(lower({x}), {Dk.q(p)})" for p in BOILERPLATE) + ")"
    res = (f"array_to_string(list_filter(list_transform(string_split({e}, chr(10)), lambda l: {Dk.ustrip('l')}), "
           f"lambda l: length(l) > 0 AND NOT {has('l')}), chr(10))")
    return (f"coalesce(CASE WHEN {has(e)} AND length({e}) < 200 THEN NULL "
            f"WHEN length({e}) > 100 AND length({res}) > 100 THEN {res} END, {Dk.q(NO_DESCRIPTION)})")


@query("boilerplate_lines", f"SELECT offer_id, {_bp_sql('description')} AS description FROM offer_texts")
def boilerplate_lines(spark, sf):
    from offerlens.operators.lines import NO_DESCRIPTION, remove_boilerplate
    t = FX.offer_texts(spark, sf)
    return t.select("offer_id", F.coalesce(remove_boilerplate("description"), F.lit(NO_DESCRIPTION)).alias("description"))


# --------------------------------------------------------------------------
# Joins and set operations (J2, J6), sources and sinks
# --------------------------------------------------------------------------

@query("cluster_writeback", f""", {ml_cte()},
txt AS (SELECT offer_id, cluster, {Dk.clean_cluster_text(Dk.text_all('title_clean', 'description_clean'))} AS text_clean FROM ml),
labels AS (SELECT offer_id, cluster FROM txt WHERE length(text_clean) > 0)
SELECT m.offer_id, coalesce(l.cluster, -1) AS cluster FROM ml m LEFT JOIN labels l USING (offer_id)""")
def cluster_writeback(spark, sf):
    """Labels computed for rows with text (here the given cluster column
    stands in for the model output) are written back to every row; rows
    without text get -1.  A left join on the key: no row order is assumed."""
    from offerlens.functions.text import clean_cluster_text, text_all as ta
    from offerlens.operators.joins import write_back
    ml = _base(spark, sf)
    txt = ml.select("offer_id", "cluster", clean_cluster_text(ta("title_clean", "description_clean")).alias("t"))
    labels = txt.where(F.length("t") > 0).select("offer_id", "cluster")
    return write_back(ml.select("offer_id"), labels, "offer_id", "cluster", -1)


@query("append_batches", """SELECT offer_id, title, description, 'orders' AS origin FROM offers
UNION ALL SELECT offer_id, title, description, 'documents' AS origin FROM offer_texts""")
def append_batches(spark, sf):
    from offerlens.operators.joins import append
    a = FX.offers(spark, sf).select("offer_id", "title", "description", F.lit("orders").alias("origin"))
    b = FX.offer_texts(spark, sf).select("offer_id", "title", "description", F.lit("documents").alias("origin"))
    return append([a, b])


@query("scan_csv_roundtrip", "SELECT offer_id, title, description, lang, source FROM offer_texts")
def scan_csv_roundtrip(spark, sf):
    """Whole documents (multi-line, quotes, accents) written as CSV to the
    shared folder and scanned back with a declared schema."""
    from offerlens.session import scratch_path
    from offerlens.sources import io
    path = scratch_path(spark, "csv")
    io.write_csv(FX.offer_texts(spark, sf), path)
    return io.read_csv(spark, path, "offer_id BIGINT, title STRING, description STRING, lang STRING, source STRING")


_JSON_COLS = ["offer_id", "title", "skills_list", "salary_avg", "salary_estimated", "date_publication", "ville"]


@query("sink_json_roundtrip", f", {enr_cte()}\nSELECT {', '.join(_JSON_COLS)} FROM enr")
def sink_json_roundtrip(spark, sf):
    """Enriched offers (arrays, dates, booleans, accents) as JSON lines and back."""
    from offerlens.session import scratch_path
    from offerlens.sources import io
    path = scratch_path(spark, "json")
    io.write_json(_enr(spark, sf).select(*_JSON_COLS), path)
    return io.read_json(spark, path, "offer_id BIGINT, title STRING, skills_list ARRAY<STRING>, salary_avg DOUBLE, "
                                     "salary_estimated BOOLEAN, date_publication DATE, ville STRING")


# --------------------------------------------------------------------------
# Feature preparation
# --------------------------------------------------------------------------

def _clf_base(spark, sf):
    """Labeled offers with department_num, imputed experience and remote.

    The labeled rows are written once as a table in the shared folder: the
    median, the standardisation statistics, the one-hot value lists and the
    final projection each need a pass, and without the table every pass
    would re-run the offer join and all the parsing expressions."""
    from offerlens.functions.geo import department_num as dn
    from offerlens.operators.features import fill_zero, impute_median
    from offerlens.operators.quality import labeled_only as lo
    from offerlens.session import materialize
    x = materialize(lo(_ml(spark, sf)).withColumn("department_num", dn("department")), "clf_base")
    return fill_zero(impute_median(x, ["experience_years"]), ["remote"])


def clf_cte() -> str:
    return ml_cte() + f""",
clf0 AS (SELECT *, {Dk.department_num('department')} AS department_num FROM ml WHERE salary_category IS NOT NULL),
clf AS (SELECT * REPLACE (coalesce(experience_years, (SELECT median(experience_years) FROM clf0)) AS experience_years,
  coalesce(remote, 0) AS remote) FROM clf0)"""


@query("impute_median", f""", {clf_cte()}
SELECT offer_id, department_num, experience_years, remote FROM clf""")
def impute_median(spark, sf):
    return _clf_base(spark, sf).select("offer_id", "department_num", "experience_years", "remote")


_NUM = ["department_num", "experience_years", "remote"]


def _std_sql(c: str) -> str:
    z = (f"({c} - (SELECT avg({c}) FROM clf)) / nullif((SELECT stddev_pop({c}) FROM clf), 0)")
    return f"round_even(coalesce({z}, 0.0), 9) AS std_{c}"


@query("standardize", f", {clf_cte()}\nSELECT offer_id, {', '.join(_std_sql(c) for c in _NUM)} FROM clf")
def standardize(spark, sf):
    from offerlens.operators.features import standardize as st
    return st(_clf_base(spark, sf), _NUM, digits=9).select("offer_id", *[f"std_{c}" for c in _NUM])


# Value lists of the one-hot columns: the fixture's categories, contracts, units.
_ONE_HOT_SQL = {"category": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"],
                "contract_type": ["CDD", "CDI", "Stage"], "salary_unit": ["annual", "hourly", "monthly"]}


@query("one_hot", f", {clf_cte()}\nSELECT offer_id, " + ", ".join(
    f'coalesce(CAST({c} = {Dk.q(v)} AS INTEGER), 0) AS "{c}_{v}"' for c, vs in _ONE_HOT_SQL.items() for v in vs)
    + " FROM clf")
def one_hot(spark, sf):
    from offerlens.operators.features import one_hot as oh
    b = _clf_base(spark, sf)
    x = oh(b, _ONE_HOT_SQL)
    return x.select("offer_id", *[c for c in x.columns if c not in b.columns])


@query("classif_prepared", f""", {clf_cte()}
SELECT offer_id, category, contract_type, remote, experience_years, department, department_num, salary_unit,
  salary_category, {', '.join(_std_sql(c) for c in _NUM)}, """ + ", ".join(
    f'coalesce(CAST({c} = {Dk.q(v)} AS INTEGER), 0) AS "{c}_{v}"' for c, vs in _ONE_HOT_SQL.items() for v in vs)
    + " FROM clf")
def classif_prepared(spark, sf):
    """The prepared classification table: base columns, standardised numbers
    and one-hot columns side by side in ONE projection (the reference glued
    separate frames by row position)."""
    from offerlens.operators.features import one_hot as oh, standardize as st
    b = _clf_base(spark, sf)
    base = ["offer_id", "category", "contract_type", "remote", "experience_years", "department", "department_num",
            "salary_unit", "salary_category"]
    x = oh(st(b, _NUM, digits=9), _ONE_HOT_SQL)
    return x.select(*base, *[f"std_{c}" for c in _NUM], *[c for c in x.columns if c not in b.columns
                                                          and not c.startswith("std_")])


@query("stratified_split", f""", {clf_cte()}
SELECT salary_category, count(*) AS n, CAST(round(count(*) * 0.2) AS BIGINT) AS n_test FROM clf GROUP BY salary_category""")
def stratified_split(spark, sf):
    from offerlens.operators.features import split_counts, stratified_split as ss
    b = _clf_base(spark, sf).select("offer_id", "salary_category")
    return split_counts(ss(b, "salary_category", "offer_id", 0.2, 42), "salary_category")


# --------------------------------------------------------------------------
# Pages (H1-H4, H21, H22)
# --------------------------------------------------------------------------

def _pages(spark, sf):
    from offerlens.sources.tables import table
    return table(spark, sf, "pages").select("page_id")


def _blocks(spark, sf, tags=None):
    from offerlens.sources.html import page_blocks
    from offerlens.sources.tables import spread, table
    return page_blocks(spread(table(spark, sf, "pages"), "page_id"), tags)


@query("page_blocks")
def page_blocks(spark, sf):
    """One row per element of every page (stdlib parser in mapInPandas)."""
    return _blocks(spark, sf)


@query("page_main_text")
def page_main_text(spark, sf):
    from offerlens.operators.pages import MAIN_TEXT_TAGS, main_text
    return main_text(_blocks(spark, sf, MAIN_TEXT_TAGS), _pages(spark, sf))


# The planted line as a browser shows it, and its parts between inline tags.
_SHOWN = FX.LONG_LINE.replace("<b>", "").replace("</b>", "")
_PART_A, _PART_B = FX.LONG_LINE.split("<b>Python</b>")
_SECTION_SQL = f"concat('Profil recherché:', chr(10), {Dk.q(_SHOWN)}, ' ', k, '.')"
_MAIN_SQL = f"concat('En-tête utile', chr(10), {Dk.q(_SHOWN)}, '.', chr(10), {Dk.q(_SHOWN)}, ' ', k, '.')"


@query("page_sections", f", {_KEYS_SQL}\nSELECT k AS page_id, {_SECTION_SQL} AS part FROM k WHERE k % 3 = 1")
def page_sections(spark, sf):
    from offerlens.operators.pages import MIN_SECTION, sections
    return sections(_planted(spark, sf, {"h2", "h3"}, ["pos", "parent", "tag", "sibling", "rendered"], longer=MIN_SECTION)).select("page_id", "part")


@query("page_text_fallback", f""", {_KEYS_SQL}
SELECT k AS page_id, CASE WHEN k % 3 = 2 THEN {_MAIN_SQL} END AS main_text,
  concat(CASE WHEN k % 3 = 2 THEN concat({Dk.q(_PART_A.strip())}, chr(10), {Dk.q(_PART_B.strip())}, '.', chr(10)) ELSE '' END,
    {Dk.q(_PART_A.strip())}, chr(10), {Dk.q(_PART_B.strip())}, ' ', k, '.') AS body_text FROM k""")
def page_text_fallback(spark, sf):
    from offerlens.operators.pages import FALLBACK_TAGS, text_fallback
    return text_fallback(_planted(spark, sf, FALLBACK_TAGS, ["pos", "tag", "noise", "text", "rendered"], frames=True))


@query("page_description_collected", f""", {_KEYS_SQL}
SELECT k AS page_id, CASE k % 3 WHEN 0 THEN concat({Dk.q(_SHOWN)}, ' ', k, '.', chr(10), 'Encore Python ici.')
  WHEN 1 THEN {_SECTION_SQL} ELSE {_MAIN_SQL} END AS description FROM k""")
def page_description_collected(spark, sf):
    from offerlens.operators.pages import MIN_SECTION, collected_description
    return collected_description(_planted(spark, sf, {"h2", "h3", "main"}, ["pos", "parent", "tag", "cls", "data_testid", "sibling", "rendered"],
                                          longer=MIN_SECTION))


@query("page_cards", f""", {_KEYS_SQL}
SELECT k AS page_id, CAST(CASE k % 4 WHEN 0 THEN 1 WHEN 1 THEN 4 ELSE 0 END AS INTEGER) AS rule,
  CAST(CASE k % 4 WHEN 0 THEN 6 WHEN 1 THEN 6 WHEN 2 THEN 3 ELSE 1 END AS BIGINT) AS n_cards FROM k""")
def page_cards(spark, sf):
    """Cards per page and the rule that found them (0: outermost group or link)."""
    from offerlens.operators.pages import page_cards as pc
    cards = pc(_planted(spark, sf, {"div", "article", "a"}, ["pos", "tag", "cls", "data_testid", "href", "ancestors"]))
    # a page's cards have one rule
    count = F.when(F.size("_cards") > 0, F.struct(F.col("_cards")[0]["rule"].alias("rule"), F.size("_cards").cast("long").alias("n_cards")))
    return cards.select("page_id", F.explode_outer(F.array(count)).alias("c")).where(F.col("c").isNotNull()).select("page_id", "c.*")


@query("page_offers", f""", {_KEYS_SQL},
n AS (SELECT k * 10 + j AS n FROM k, range(6) AS r(j) WHERE k % 4 IN (0, 1) OR (k % 4 = 2 AND j = 0))
SELECT CAST(n AS VARCHAR) AS job_id, concat('Poste ', n) AS title, concat('Société ', n % 7) AS company, 'Lyon - 69' AS location,
  'CDI' AS contract_type, concat(1500 + n % 900, ' € / mois') AS salary, concat('il y a ', n % 9 + 1, ' jours') AS published,
  concat('Poste ', n, chr(10), 'Société ', n % 7, chr(10), 'Lyon - 69', chr(10), 'CDI', chr(10), 1500 + n % 900, ' € / mois', chr(10),
    'il y a ', n % 9 + 1, ' jours') AS short_description
FROM n""")
def page_offers(spark, sf):
    """Pages to offers: cards, their fields, routed tags, first seen per job id."""
    from offerlens.operators import cards as K1
    from offerlens.operators.pages import card_fields, page_cards as pc
    blocks = _planted(spark, sf, {"div", "article", "a", "h3", "p"}, ["pos", "tag", "cls", "data_testid", "href", "ancestors", "rendered"])
    f = card_fields(blocks, pc(blocks))
    none = F.lit(None).cast("string")
    tc, r = K1.title_company("title_p", "company_p", none), K1.route_tags("tags", F.array_compact(F.array("salary")))
    offers = f.select(K1.job_id_from_url("url").alias("job_id"), tc["title"].alias("title"), tc["company"].alias("company"),
                      r["location"].alias("location"), r["contract_type"].alias("contract_type"), r["salary"].alias("salary"),
                      "published", K1.short_description("card_text").alias("short_description"), "page_id", "pos")
    return K1.offer_dedup(offers, order=("page_id", "pos")).drop("page_id", "pos")


def _decode(e: str) -> str:
    for a, b in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&copy;", "©"),
                 ("&middot;", "·"), ("&nbsp;", " "), ("&amp;", "&")):
        e = f"replace({e}, {Dk.q(a)}, {Dk.q(b)})"
    return e


def _first_tag_sql(tag: str) -> str:
    rx = f"<{tag}>([^<]*)</{tag}>"
    return (f"CASE WHEN regexp_matches(html, {Dk.q(rx)}) THEN "
            f"{Dk.ustrip(_decode(f'regexp_extract(html, {Dk.q(rx)}, 1)'))} END")


@query("page_fields", f"""SELECT page_id, {_first_tag_sql('title')} AS page_title, {_first_tag_sql('h1')} AS h1,
  CAST(NULL AS VARCHAR) AS link_title FROM pages""")
def page_fields(spark, sf):
    from offerlens.operators.pages import FIELD_TAGS, page_fields as pf
    return pf(_blocks(spark, sf, FIELD_TAGS), _pages(spark, sf))


def _detail(spark, sf):
    from offerlens.operators.selectors import DETAIL_COLUMNS, DETAIL_SHOWN, DETAIL_TAGS, detail_offers
    from offerlens.sources.html import page_elements
    columns = [c for c in DETAIL_COLUMNS if c != "page_id"]
    return detail_offers(page_elements(FX.detail_pages(spark, sf), columns, DETAIL_TAGS, shown_of=DETAIL_SHOWN, carry="url"))


@query("page_detail_offers", f"\nSELECT * RENAME (offer_id AS page_id) FROM ({FX.detail_offers_sql()})")
def page_detail_offers(spark, sf):
    """The ten raw columns of every offer's own page."""
    return _detail(spark, sf)


@query("page_offers_enriched", f""", detail AS (SELECT *, CAST(NULL AS INTEGER) AS cluster, CAST(NULL AS VARCHAR) AS category FROM ({FX.detail_offers_sql()})),
{enr_cte("detail")}\nSELECT {', '.join(_ENRICHED_OUT)} FROM enr""")
def page_offers_enriched(spark, sf):
    """Pages to the enriched table: raw columns of each offer's page, then the v2 ETL."""
    from offerlens.session import materialize
    raw = materialize(_detail(spark, sf).withColumnRenamed("page_id", "offer_id"), "page-offers")
    return etl.offers_enriched(raw, AS_OF).select(*_ENRICHED_OUT)


# --------------------------------------------------------------------------
# Text features and clustering (C1-C7, A11 on embeddings)
# --------------------------------------------------------------------------

def _cluster_texts(spark, sf):
    """Documents as cluster text (v3 clean of title + description, digits
    removed), non-empty only.  The cleaned texts are written once as a table:
    a filter on the cleaned column would otherwise be pushed (with the whole
    cleaning expression) below the scan's repartition and evaluated twice."""
    from offerlens.functions.text import clean_cluster_text, clean_text, text_all as ta
    from offerlens.session import materialize
    t = FX.offer_texts(spark, sf)
    x = t.select("offer_id", "lang", clean_cluster_text(ta(clean_text("title", "v3"), clean_text("description", "v3")))
                 .alias("text_clean"))
    return materialize(x, "cluster_texts").where(F.length("text_clean") > 0)


_CT_SQL = (f"(SELECT offer_id, lang, text_clean FROM (SELECT offer_id, lang, "
           f"{Dk.clean_cluster_text(Dk.text_all(Dk.clean_text('title', 'v3'), Dk.clean_text('description', 'v3')))} AS text_clean "
           f"FROM offer_texts) WHERE length(text_clean) > 0)")
_TOKEN_SQL = "'[\\p{L}\\p{N}_]{2,}'"


def _tfidf_sql(max_features: int) -> str:
    return f""", ct AS {_CT_SQL},
toks AS (SELECT offer_id, regexp_extract_all(lower(text_clean), {_TOKEN_SQL}, 0) AS t FROM ct),
grams AS (SELECT offer_id, list_concat(t, list_transform(generate_series(1, len(t) - 1),
  lambda i: concat(t[i], ' ', t[i + 1]))) AS g FROM toks),
tf AS (SELECT offer_id, term, count(*) AS tf FROM (SELECT offer_id, unnest(g) AS term FROM grams) GROUP BY offer_id, term),
nd AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM ct),
voc AS (SELECT term, ln((1.0 + n) / (1.0 + df)) + 1.0 AS idf FROM
  (SELECT term, count(*) AS df, sum(tf) AS cf FROM tf GROUP BY term HAVING count(*) >= 2
   ORDER BY cf DESC, term LIMIT {max_features}), nd),
w AS (SELECT offer_id, term, tf * idf AS raw FROM tf JOIN voc USING (term)),
wn AS (SELECT offer_id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY offer_id)) AS tfidf FROM w)"""


@query("tfidf", _tfidf_sql(30000) + "\nSELECT offer_id, term, round_even(tfidf, 9) AS tfidf FROM wn")
def tfidf(spark, sf):
    """Long-format TF-IDF of the document texts (1-2-grams, min_df 2, 30,000 terms)."""
    from offerlens.models.tfidf import tfidf_long
    w, _ = tfidf_long(_cluster_texts(spark, sf), "offer_id", "text_clean", 2, 30000)
    return w.select("offer_id", "term", F.bround("tfidf", 9).alias("tfidf"))


@query("cluster_top_terms", _tfidf_sql(30000) + """,
sizes AS (SELECT lang, count(*) AS n FROM ct GROUP BY lang),
m AS (SELECT lang, term, sum(tfidf) / any_value(n) AS mean_tfidf FROM wn JOIN ct USING (offer_id) JOIN sizes USING (lang)
  GROUP BY lang, term)
SELECT lang, term, round_even(mean_tfidf, 9) AS mean_tfidf, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY mean_tfidf DESC, term) AS rank FROM m) WHERE rank <= 15""")
def cluster_top_terms(spark, sf):
    """Top 15 terms per cluster by mean TF-IDF (the reference's intent; its
    code indexed the vocabulary with SVD positions).  Labels given: language."""
    from offerlens.models.tfidf import mean_terms_by_cluster, tfidf_long
    ct = _cluster_texts(spark, sf)
    w, _ = tfidf_long(ct, "offer_id", "text_clean", 2, 30000, carry=("lang",))
    top = mean_terms_by_cluster(w, ct.select("offer_id", "lang"), "offer_id", "lang", 15)
    return top.select("lang", "term", F.bround("mean_tfidf", 9).alias("mean_tfidf"), "rank")


def _emb(spark, sf):
    from offerlens.sources.tables import table
    return table(spark, sf, "embeddings")


@query("silhouette_sq", """, e AS (SELECT vec_id, label, embedding FROM embeddings),
d AS (SELECT a.vec_id, a.label AS ca, b.label AS cb,
  list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda z: (CAST(z[1] AS DOUBLE) - CAST(z[2] AS DOUBLE)) ^ 2)) AS dd
  FROM e a, e b WHERE a.vec_id <> b.vec_id),
sizes AS (SELECT label, count(*) AS n FROM e GROUP BY label),
m AS (SELECT vec_id, ca, cb, sum(dd) AS s FROM d GROUP BY vec_id, ca, cb),
ab AS (SELECT m.vec_id, max(CASE WHEN ca = cb THEN s / (sz.n - 1) END) AS a,
  min(CASE WHEN ca <> cb THEN s / sz.n END) AS b, max(CASE WHEN ca = cb THEN 1 ELSE 0 END) AS has_own
  FROM m JOIN sizes sz ON sz.label = m.cb GROUP BY m.vec_id)
SELECT round_even(avg(CASE WHEN has_own = 0 OR b IS NULL THEN 0.0 ELSE (b - a) / greatest(a, b) END), 9) AS silhouette,
  count(*) AS n FROM (SELECT e.vec_id, a, b, coalesce(has_own, 0) AS has_own FROM e LEFT JOIN ab USING (vec_id))""")
def silhouette_sq_labels(spark, sf):
    """Mean silhouette (squared Euclidean) of the embeddings under their labels."""
    from offerlens.models.clusters import silhouette_sq
    return silhouette_sq(_emb(spark, sf), "embedding", "label", 9)


@query("embedding_profile", """SELECT label, count(*) AS n,
  round_even(avg(list_sum(list_transform(embedding, lambda v: CAST(v AS DOUBLE) * v))), 9) AS mean_sq_norm
FROM embeddings GROUP BY label""")
def embedding_profile(spark, sf):
    """Per-cluster profile of the embeddings (size, mean squared norm)."""
    e = _emb(spark, sf).select("label", F.aggregate(F.col("embedding").cast("array<double>"), F.lit(0.0),
                                                     lambda acc, v: acc + v * v).alias("sq"))
    return e.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.bround(F.avg("sq"), 9).alias("mean_sq_norm"))


# --------------------------------------------------------------------------
# Models: classification (C8-C14, F5, F6) and clustering
# --------------------------------------------------------------------------

def _clf_split(spark, sf):
    from offerlens.functions.text import text_all as ta
    from offerlens.operators.features import stratified_split as ss
    b = _clf_base(spark, sf).withColumn("text_all", ta("title_clean", "description_clean"))
    s = ss(b, "salary_category", "offer_id", 0.2, 42)
    return s.where(~F.col("is_test")), s.where(F.col("is_test"))


def _clf_query(model: str):
    def fn(spark, sf):
        from offerlens.models.classify import classification_report, fit_predict
        train, test = _clf_split(spark, sf)
        return classification_report(fit_predict(train, test, model))
    return fn


for _k, _m in (("clf_logreg", "LogisticRegression"), ("clf_forest", "RandomForest"), ("clf_svm", "LinearSVC"),
               ("clf_gbt", "GradientBoosting")):
    query(_k)(_clf_query(_m))


@query("model_comparison")
def model_comparison(spark, sf):
    from offerlens.models.classify import compare_models
    train, test = _clf_split(spark, sf)
    return compare_models(spark, train, test)


def _report_sql(src: str) -> str:
    return f""", p AS ({src}),
conf AS (SELECT y, p, count(*) AS n FROM p GROUP BY y, p),
sup AS (SELECT y AS cls, sum(n) AS support FROM conf GROUP BY y),
prd AS (SELECT p AS cls, sum(n) AS predicted FROM conf GROUP BY p),
tp AS (SELECT y AS cls, n AS tp FROM conf WHERE y = p),
per AS (SELECT cls AS "row", coalesce(coalesce(tp, 0) / nullif(coalesce(predicted, 0), 0), 0.0) AS precision,
  coalesce(coalesce(tp, 0) / nullif(support, 0), 0.0) AS recall, support
  FROM sup FULL JOIN prd USING (cls) LEFT JOIN tp USING (cls) WHERE support > 0),
per2 AS (SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0.0) AS f1_score FROM per),
tot AS (SELECT sum(support) AS total, avg(precision) AS mp, avg(recall) AS mr, avg(f1_score) AS mf,
  sum(precision * support) / sum(support) AS wp, sum(recall * support) / sum(support) AS wr,
  sum(f1_score * support) / sum(support) AS wf FROM per2)
SELECT "row", round_even(precision, 9) AS precision, round_even(recall, 9) AS recall,
  round_even(f1_score, 9) AS f1_score, support FROM per2
UNION ALL SELECT 'accuracy', NULL, NULL, round_even((SELECT sum(tp) FROM tp) / total, 9), total FROM tot
UNION ALL SELECT 'macro avg', round_even(mp, 9), round_even(mr, 9), round_even(mf, 9), total FROM tot
UNION ALL SELECT 'weighted avg', round_even(wp, 9), round_even(wr, 9), round_even(wf, 9), total FROM tot"""


_BASELINE_SQL = ("CASE salary_unit WHEN 'hourly' THEN 'Bas' WHEN 'monthly' THEN 'Moyen' "
                 "WHEN 'annual' THEN 'Haut' END")


@query("classification_report", f", {ml_cte()}" + _report_sql(
    f"SELECT salary_category AS y, {_BASELINE_SQL} AS p FROM ml WHERE salary_category IS NOT NULL"))
def classification_report(spark, sf):
    """Report of a salary-unit baseline rule against the quantile classes
    (predictions given, so SQL can check the report arithmetic)."""
    from offerlens.models.classify import classification_report as cr
    ml = _ml(spark, sf).where(F.col("salary_category").isNotNull())
    pred = ml.select("salary_category", F.expr(_BASELINE_SQL).alias("prediction"))
    r = cr(pred)
    return r.select("row", *[F.bround(c, 9).alias(c) for c in ("precision", "recall", "f1_score")], "support")


def _offer_cluster_texts(spark, sf):
    """Cluster text of every offer text (one per document): v3 clean of title
    and description, joined, digits removed."""
    from offerlens.functions.text import clean_cluster_text, clean_text, text_all as ta
    o = FX.offer_texts(spark, sf)
    return o.select("offer_id", clean_cluster_text(ta(clean_text("title", "v3"), clean_text("description", "v3")))
                    .alias("text_clean"))


@query("svd_scores")
def svd_scores(spark, sf):
    """TF-IDF (30,000 terms) of the offer texts reduced to 200 SVD scores."""
    from offerlens.models.clusters import svd_scores as sv
    from offerlens.models.tfidf import tfidf_vectors
    from offerlens.session import materialize
    t = materialize(_offer_cluster_texts(spark, sf), "offer_texts_clean").where(F.length("text_clean") > 0)
    m = tfidf_vectors(t, "text_clean", out="tfidf", max_features=30000)
    return sv(m.transform(t).select("offer_id", "tfidf"), "offer_id", "tfidf", k=200)


@query("kmeans_text")
def kmeans_text(spark, sf):
    """Offer texts -> TF-IDF -> SVD(200) -> k-means k=8 (best of 10 seeds);
    clusters written back to every offer, -1 without text."""
    from offerlens.models.clusters import assign, kmeans_best, svd_scores as sv
    from offerlens.models.tfidf import tfidf_vectors
    from offerlens.operators.joins import write_back
    from offerlens.session import materialize
    # cleaned texts written once: the non-empty filter then reads a stored column
    allx = materialize(_offer_cluster_texts(spark, sf), "offer_texts_clean")
    t = allx.where(F.length("text_clean") > 0)
    m = tfidf_vectors(t, "text_clean", out="tfidf", max_features=30000)
    scores = sv(m.transform(t).select("offer_id", "tfidf"), "offer_id", "tfidf", k=200)
    feats = materialize(scores, "svd")      # read by every pass of the starts
    best = kmeans_best(feats, "svd", k=8, seed=42, n_init=10, key="offer_id")
    labels = assign(feats, "offer_id", "svd", best["centres"])
    return write_back(allx.select("offer_id"), labels, "offer_id", "cluster", -1)


_EVAL = ["salary_min", "salary_max", "nb_skills", "days_since_publication", "urgent", "remote_possible",
         "experience_encoded"]


def _eval_features(spark, sf):
    from offerlens.operators.features import impute_median as im, standardize as st
    from offerlens.models.clusters import assemble
    from offerlens.session import materialize
    e = _enr(spark, sf).select("offer_id", "cluster", *[F.col(c).cast("double").alias(c) for c in _EVAL])
    # written first: the medians, the statistics and the features would each parse and enrich all offers again
    x = st(im(materialize(e, "eval-offers"), _EVAL), _EVAL)
    return assemble(x, [f"std_{c}" for c in _EVAL])


@query("elbow")
def elbow(spark, sf):
    """Inertia for k = 2..11 on the standardised offer features."""
    from offerlens.models.clusters import elbow as eb
    return eb(spark, _eval_features(spark, sf), "features", range(2, 12), 42, key="offer_id")


@query("pca2")
def pca2(spark, sf):
    from offerlens.models.clusters import pca2 as p2
    return p2(_eval_features(spark, sf), "features", "offer_id", 2)


@query("silhouette_offers")
def silhouette_offers(spark, sf):
    """Silhouette (squared Euclidean) of the standardised offer features under
    the offers' cluster labels (the evaluation script's setting)."""
    from pyspark.ml.functions import vector_to_array
    from offerlens.models.clusters import silhouette_sq
    f = _eval_features(spark, sf).select("cluster", vector_to_array("features").alias("x"))
    return silhouette_sq(f, "x", "cluster", 9)


# --------------------------------------------------------------------------
# Streaming ingest
# --------------------------------------------------------------------------

_CARD_STREAM_SCHEMA = "job_id STRING, offer_id BIGINT, title STRING, scraped_at TIMESTAMP, arrival INT"


def _stage_arrivals(spark, sf):
    """Cards of every offer, staged once in the shared folder, partitioned by
    arrival (the year they were collected)."""
    from offerlens.operators.cards import job_id_from_url as jid, title_company
    from offerlens.session import scratch_path
    c = FX.offer_cards(spark, sf)
    cards = c.select(jid("url").alias("job_id"), "offer_id",
                     title_company("title_p", "company_p", "title_attr")["title"].alias("title"), "scraped_at",
                     F.year("scraped_at").alias("arrival"))
    base = scratch_path(spark, "stream")
    cards.write.partitionBy("arrival").parquet(f"{base}/staged")
    arrivals = sorted(r[0] for r in spark.read.parquet(f"{base}/staged").select("arrival").distinct().collect())
    return base, arrivals  # arrivals: calendar years, a short list


def _arrive(spark, base, arrival):
    """New files land in the source folder (one write per arrival)."""
    from pyspark.sql.types import _parse_datatype_string
    schema = _parse_datatype_string(_CARD_STREAM_SCHEMA)
    (spark.read.schema(schema).parquet(f"{base}/staged").where(F.col("arrival") == arrival)
     .write.mode("append").parquet(f"{base}/source"))
    return schema


@query("stream_offer_ingest", f"""SELECT job_id, offer_id, title, scraped_at FROM (
  SELECT {_JOB_ID_SQL} AS job_id, offer_id, {_tc_sql(True)}, scraped_at FROM offer_cards
) WHERE title IS NOT NULL AND title <> ''
QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY scraped_at, offer_id) = 1""")
def stream_offer_ingest(spark, sf):
    """Cards arrive year by year; after each arrival the streaming query
    processes the new files (availableNow) and appends first-seen offers.
    The final sink equals the batch first-seen dedup."""
    from offerlens.streaming.ingest import ingest_first_seen
    base, arrivals = _stage_arrivals(spark, sf)
    schema = None
    for a in arrivals:
        schema = _arrive(spark, base, a)
        ingest_first_seen(spark, f"{base}/source", schema, f"{base}/sink", f"{base}/ckpt", buckets=8)
    return spark.read.parquet(f"{base}/sink").select("job_id", "offer_id", "title", "scraped_at")


@query("stream_dedup", f"""SELECT job_id, min(year(scraped_at)) AS arrival FROM
  (SELECT {_JOB_ID_SQL} AS job_id, scraped_at FROM offer_cards) GROUP BY job_id""")
def stream_dedup(spark, sf):
    """Built-in stateful dropDuplicates over the same arrivals; the arrival
    of the kept row is the first one in which the id was seen."""
    from offerlens.streaming.ingest import stream_dedup as sd
    base, arrivals = _stage_arrivals(spark, sf)
    for a in arrivals:
        schema = _arrive(spark, base, a)
        sd(spark, f"{base}/source", schema, f"{base}/sink", f"{base}/ckpt", "job_id")
    return spark.read.parquet(f"{base}/sink").select("job_id", "arrival")


#: Span of the watermark query; arrivals are years, so an id is forgotten after the batch two years on.
_WATERMARK = ("seen", "300 days")


@query("stream_dedup_watermark", f"""SELECT job_id, unnest(list_reduce(list_transform(years, lambda y: [y]),
    lambda kept, y: CASE WHEN y[1] - kept[-1] >= 3 THEN list_concat(kept, y) ELSE kept END)) AS arrival FROM (
  SELECT job_id, list_sort(list(DISTINCT year(scraped_at))) AS years
  FROM (SELECT {_JOB_ID_SQL} AS job_id, scraped_at FROM offer_cards) GROUP BY job_id)""")
def stream_dedup_watermark(spark, sf):
    """Dedup on event time (the start of the arrival's year): duplicates within the span are dropped, ids whose
    state has expired come again, and rows planted four years late never come."""
    from pyspark.sql.types import _parse_datatype_string
    from offerlens.streaming.ingest import stream_dedup as sd
    base, arrivals = _stage_arrivals(spark, sf)
    schema = _parse_datatype_string("job_id STRING, seen TIMESTAMP, arrival INT")
    staged = spark.read.schema(_parse_datatype_string(_CARD_STREAM_SCHEMA)).parquet(f"{base}/staged")
    on_time = staged.select("job_id", F.make_timestamp("arrival", *[F.lit(x) for x in (1, 1, 0, 0, 0)]).alias("seen"), "arrival")
    late = (on_time.where((F.col("arrival") > arrivals[0] + 1) & (F.pmod(F.xxhash64("job_id"), F.lit(10)) == 3))
            .withColumns({"job_id": F.concat(F.lit("late_"), "job_id"), "seen": F.col("seen") - F.expr("INTERVAL 4 YEARS")}))
    for a in arrivals:
        on_time.unionByName(late).where(F.col("arrival") == a).write.mode("append").parquet(f"{base}/source")
        sd(spark, f"{base}/source", schema, f"{base}/sink", f"{base}/ckpt", "job_id", _WATERMARK)
    return spark.read.parquet(f"{base}/sink").select("job_id", "arrival")


@query("ingest_report", f"""SELECT count(*) AS n_rows, count(DISTINCT job_id) AS n_ids,
  count(description) AS n_descriptions, avg(length(description)) AS mean_description_length
FROM (SELECT {_JOB_ID_SQL} AS job_id, coalesce(full_description, substr(card_text, 1, 300)) AS description
  FROM offer_cards)""")
def ingest_report(spark, sf):
    """Collection summary: cards, distinct ids, descriptions and their mean length."""
    from offerlens.operators.cards import job_id_from_url as jid, short_description as sd
    c = _cards(spark, sf).select(jid("url").alias("job_id"),
                                 F.coalesce("full_description", sd("card_text")).alias("description"))
    return R.ingest_report(c)


# --------------------------------------------------------------------------
# v1 ETL (P1, P2, P5, M2, K4, X2, A10)
# --------------------------------------------------------------------------

def v1_cte() -> str:
    sal = Dk.parse_salary("salaire", "v1")
    return f""", s0 AS (SELECT offer_id, coalesce(title, '') AS titre, coalesce(description, '') AS description,
  coalesce(company, '') AS company, salary AS salaire, experience FROM offers),
s1 AS (SELECT *, {Dk.clean_text('titre', 'v1')} AS titre_clean, {Dk.clean_text('description', 'v1')} AS description_clean,
  {Dk.clean_text('company', 'v1')} AS company_clean, {sal} AS sal FROM s0),
v1 AS (SELECT offer_id, titre, description, company, salaire, experience, titre_clean, description_clean, company_clean,
  sal.salary_min AS salary_min, sal.salary_max AS salary_max, sal.salary_avg AS salary_avg,
  {Dk.flag(Dk.contains_any("concat(' ', titre_clean, ' ', description_clean)", ['télétravail', 'remote', 'distanciel', 'hybride']))} AS remote,
  {Dk.experience_years('experience', 'v1')} AS experience_years FROM s1)"""


@query("offers_structured_v1", v1_cte() + "\nSELECT * FROM v1")
def offers_structured_v1(spark, sf):
    """The v1 ETL: clean (v1), salary v1, remote with 'hybride', experience years v1."""
    return etl.offers_structured(FX.offers(spark, sf))


@query("v1_nonnull_counts", v1_cte() + """
SELECT count(salary_avg) AS n_salary, sum(remote) AS n_remote, count(experience_years) AS n_experience,
  count(*) AS n_rows FROM v1""")
def v1_nonnull_counts(spark, sf):
    """Counts reported after each v1 step (salaries, remote, experience)."""
    v = etl.offers_structured(FX.offers(spark, sf))
    return v.agg(F.count("salary_avg").alias("n_salary"), F.sum("remote").alias("n_remote"),
                 F.count("experience_years").alias("n_experience"), F.count(F.lit(1)).alias("n_rows"))
