"""Job-offer shaped tables derived from the driver tables.

The reference ships no data.  These views give its operators realistic,
messy input that grows with the driver tables:

* ``offers``      - one offer per order (``orders`` joined to ``customer``):
  salary, location, experience, contract and date strings in the formats
  the reference parses, with planted nulls, null markers and NBSP.
* ``offer_texts`` - one offer per document: the whole document text is the
  description (plus a planted sentence), its first sentence is the title.

Each column is a SQL expression over the source columns, shared verbatim by
the Spark builder (``selectExpr``) and the DuckDB oracle, so both engines see
identical rows.  The only dialect difference is the date formatter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerlens.sources.tables import gather, spread, table

SPARK_DATE = "date_format(o_orderdate, 'dd/MM/yyyy')"
DUCK_DATE = "strftime(o_orderdate, '%d/%m/%Y')"

# (name, SQL expression); ``{DATE}`` is the engine's dd/MM/yyyy formatter.
OFFER_COLUMNS: list[tuple[str, str]] = [
    ("offer_id", "o_orderkey"),
    ("category", "c_mktsegment"),
    ("title", "CASE o_orderkey % 7 WHEN 0 THEN 'Data Analyst (H/F)' "
              "WHEN 1 THEN 'Comptable Urgent - CDI' WHEN 2 THEN 'Développeur Python / SQL' "
              "WHEN 3 THEN NULL WHEN 4 THEN 'N/A' "
              "WHEN 5 THEN concat('Assistant ', lower(c_mktsegment)) "
              "ELSE concat('Chargé d''études ', o_orderpriority) END"),
    ("company", "CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE c_name END"),
    ("contract_type", "CASE o_orderkey % 4 WHEN 0 THEN 'CDI' WHEN 1 THEN 'CDD' "
                      "WHEN 2 THEN 'Stage' ELSE NULL END"),
    ("salary",
     "CASE o_orderkey % 11 WHEN 0 THEN NULL WHEN 1 THEN 'N/A' WHEN 2 THEN 'Pas de salaire renseigné' "
     "WHEN 3 THEN concat(CAST(20 + o_custkey % 30 AS STRING), ' 000 - ', "
     "CAST(45 + o_custkey % 40 AS STRING), ' 000 € / an') "
     "WHEN 4 THEN concat(CAST(11 + o_custkey % 9 AS STRING), ',50 - ', "
     "CAST(21 + o_custkey % 5 AS STRING), ',75 € / heure') "
     "WHEN 5 THEN concat('1 ', CAST(500 + o_custkey % 400 AS STRING), ' - 2 ', "
     "CAST(100 + o_custkey % 800 AS STRING), ' € / mois') "
     "WHEN 6 THEN '35-45k€' WHEN 7 THEN 'Estimation 28 000 € → 32 000 €' "
     "WHEN 8 THEN concat(CAST(1500 + o_custkey % 900 AS STRING), ',50€/mois') "
     "WHEN 9 THEN concat(CAST(25 + o_custkey % 50 AS STRING), chr(160), '000 €') "
     "ELSE 'à négocier' END"),
    ("location",
     "CASE o_orderkey % 9 WHEN 0 THEN NULL WHEN 1 THEN 'Paris - 75' WHEN 2 THEN '69 - Lyon' "
     "WHEN 3 THEN 'Nantes (44)' WHEN 4 THEN 'Saint-Étienne' WHEN 5 THEN 'Dunkerque - 59' "
     "WHEN 6 THEN 'Ajaccio - 2A' WHEN 7 THEN '30 000 € brut' ELSE 'L''Isle - 1' END"),
    ("experience",
     "CASE o_orderkey % 13 WHEN 0 THEN NULL WHEN 1 THEN 'Exp. 1 à 7 ans' WHEN 2 THEN '1 à 7 ans' "
     "WHEN 3 THEN 'Exp. 0 à 1 an' WHEN 4 THEN '5 ans d''expérience' "
     "WHEN 5 THEN 'Débutant accepté, 2 ans' WHEN 6 THEN 'Débutant accepté' "
     "WHEN 7 THEN 'Banque • Assurance' WHEN 8 THEN 'Bac +2' WHEN 9 THEN 'Capacité' "
     "WHEN 10 THEN 'Non précisé' WHEN 11 THEN 'Profil senior' "
     "ELSE concat('Exp. ', CAST(o_custkey % 12 AS STRING), ' à ', "
     "CAST(o_custkey % 12 + o_orderkey % 5 AS STRING), ' ans') END"),
    ("education", "CASE o_custkey % 5 WHEN 0 THEN 'Bac +2' WHEN 1 THEN 'Bac +5' "
                  "WHEN 2 THEN NULL WHEN 3 THEN 'n/a' ELSE 'Non précisé' END"),
    ("published_date", "CASE WHEN o_orderkey % 13 = 0 THEN '99/99/2025' "
                       "WHEN o_orderkey % 19 = 0 THEN NULL ELSE {DATE} END"),
    ("description",
     "CASE o_orderkey % 8 WHEN 0 THEN 'Poste en télétravail partiel, équipe agile.' "
     "WHEN 1 THEN 'Recrutement urgent : prise de poste dès que possible.' "
     "WHEN 2 THEN 'Ces traceurs sont nécessaires au bon fonctionnement de nos services.' "
     "WHEN 3 THEN NULL WHEN 4 THEN ' ' "
     "WHEN 5 THEN concat('Mission ', lower(o_orderstatus), ' en distanciel, Excel et SAP.') "
     "WHEN 6 THEN 'Démarrage rapidement, mode hybride.' "
     "ELSE concat('Client ', c_name, ' : ', o_orderpriority) END"),
    ("remote", "o_custkey % 3 = 0"),
    ("cluster", "CASE WHEN o_orderkey % 17 = 0 THEN -1 ELSE CAST(o_custkey % 8 AS INT) END"),
    ("url", "CASE WHEN o_orderkey % 23 = 0 "
            "THEN concat('https://jobs.example.fr/offre?ref=', CAST(o_orderkey AS STRING)) "
            "ELSE concat('https://jobs.example.fr/fr-fr/emplois/', CAST(o_custkey AS STRING), '.html') END"),
    ("scraped_at", "o_orderdate"),
]

# Planted sentence appended to each document (by doc_id % 8).
TEXT_SUFFIX = (
    "CASE doc_id % 8 WHEN 0 THEN ' Python et SQL, télétravail possible.' "
    "WHEN 1 THEN ' JavaScript / Node.js, poste urgent.' "
    "WHEN 2 THEN ' Tableau de bord Excel.' WHEN 3 THEN ' Tableau, Power BI, anglais.' "
    "WHEN 4 THEN ' C# / .NET, dès que possible.' "
    "WHEN 5 THEN ' Ces traceurs sont nécessaires au bon fonctionnement de nos services.' "
    "WHEN 6 THEN ' Comptabilité, Sage, mode hybride.' ELSE '' END")

# Title = first sentence of the document (up to . ! ? or a line break).
TITLE_PATTERN = r"^[^.!?\n]*"


def offers(spark: SparkSession, sf_dir: str, gathered: bool = False) -> DataFrame:
    """``gathered``: the rows of an offer_id lie next to each other in one partition."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    # customer is ~10x smaller than orders; AQE picks broadcast only when its
    # runtime size is under the threshold, otherwise a shuffle join on the key.
    if gathered:
        j = gather(o.join(c, o.o_custkey == c.c_custkey), "o_orderkey", o.count())
    else:
        o = spread(o, "o_orderkey")
        j = o.join(c, o.o_custkey == c.c_custkey)
    return j.selectExpr(*[f"{expr.replace('{DATE}', SPARK_DATE)} AS {name}"
                          for name, expr in OFFER_COLUMNS])


# Pages planted from orders: category links, offer links, cards, headings, inline tags, attributes in other orders
# and quotes, noise marks that only look like noise. What they hold follows from the order key alone.
_CATEGORIES = ["Commerce", "Distribution", "Comptabilité", "Ressources Humaines"]
LONG_LINE = "Nous recherchons une personne motivée qui maîtrise <b>Python</b> et SQL, aime le travail en équipe et parle anglais"


def _category_sql(i: int, name: str) -> str:
    return (f"CASE WHEN o_orderkey % 5 > {i} THEN concat('<a class=\"tw-link\" href=\"/fr-fr/emploi/domaine_{i}.html?p=', "
            f"o_orderkey, '\">Emploi <b>{name}</b></a> ') ELSE '' END")


def _card_sql(n: str, cls: str) -> str:
    return (f"concat('<div class=\"{cls}\"><a href=', chr(39), '/fr-fr/emplois/', {n}, '.html', chr(39), '><h3><p>Poste <b>', {n}, "
            f"'</b></p><p>Société ', {n} % 7, '</p></h3></a><div class=\"tw-readonly tw-tag-secondary-s\">Lyon - 69</div>"
            f"<div class=\"tw-tag-secondary-s tw-readonly\">CDI</div><div class=\"x tw-typo-s-bold\">', 1500 + {n} % 900, "
            f"' € / mois</div><div class=\"tw-text-grey-500\">il y a ', {n} % 9 + 1, ' jours</div></div>')")


_GROUP = "tw-group tw-h-full tw-overflow-hidden tw-bg-white tw-rounded-sm"
OFFER_PAGE = (
    "concat('<html><head><title>Offre ', o_orderkey, '</title></head><body>"
    "<header id=\"banner-offre\">Entête</header><nav><a href=\"/accueil\">Emploi Commerce</a></nav>"
    "<section class=\"liens\"><h4>On a classé tous nos jobs !</h4>', "
    + ", ".join(_category_sql(i, c) for i, c in enumerate(_CATEGORIES)) +
    ", '<a href=\"/aide\">Emploi Commerce aide</a></section>', "
    "'<a class=\"t\" data-cy=\"offerTitle\" href=', chr(39), '/fr-fr/emplois/', o_orderkey, '.html', chr(39), '>Poste <i>A</i></a>', "
    "CASE WHEN o_orderkey % 2 = 0 THEN concat('<a href=\"/fr-fr/emplois/', o_orderkey + 1, '.html\" data-cy=\"offerTitle\">Poste B</a>') ELSE '' END, "
    "CASE o_orderkey % 3 "
    f"WHEN 0 THEN concat('<div id=\"banner-x\" class=\"Cookie-Chef tw-prose\"><p>{LONG_LINE} ', o_orderkey, '.</p><p>Encore <b>Python</b> ici.</p></div>') "
    f"WHEN 1 THEN concat('<div><div><h2>Profil <b>recherché</b></h2></div><p>Court.</p><p>{LONG_LINE} ', o_orderkey, '.</p><p>Autre.</p></div>') "
    f"ELSE concat('<main><header>En-tête utile</header><p>{LONG_LINE}.</p><p>{LONG_LINE} ', o_orderkey, '.</p></main>') END, "
    "CASE o_orderkey % 4 "
    "WHEN 0 THEN concat(" + ", ".join(_card_sql(f"(o_orderkey * 10 + {j})", _GROUP) for j in range(6)) + ") "
    "WHEN 1 THEN concat(" + ", ".join(
        f"'<article data-testid=\"x-job-{j}\">', {_card_sql(f'(o_orderkey * 10 + {j})', 'card')}, '</article>'" for j in range(6)) + ") "
    "WHEN 2 THEN concat('<div class=\"tw-group a\"><div class=\"tw-group b\">', " + _card_sql("(o_orderkey * 10)", "card") + ", '</div></div>') "
    "ELSE '' END, '</body></html>')")


def offer_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Planted pages, one per order; those of an order key lie next to each other in one partition."""
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    o = gather(o, "o_orderkey", o.count())
    return o.select(F.col("o_orderkey").alias("page_id"), F.expr(OFFER_PAGE).alias("html"))


# Offer pages (one per offer): the offer's fields where its own page shows them, lookalikes that no selector may
# take, and the description under one of the extractor's selectors, or nowhere.
INTRO = "Au sein de notre équipe, vous participez aux projets de la direction et travaillez avec les autres services du groupe "
INTRO += "afin de suivre les résultats et de proposer des améliorations à la direction générale"


def _esc(c: str) -> str:
    return f"replace(replace(replace({c}, '&', '&amp;'), '<', '&lt;'), '\"', '&quot;')"


def _shown(c: str, before: str, after: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN '' ELSE concat('{before}', {_esc(c)}, '{after}') END"


_DETAIL_TEXT = f"concat('<p>{INTRO}</p><div class=\"cookie-info\">Accepter</div><p>', coalesce({_esc('description')}, ''), '</p>')"
DETAIL_PAGE = (
    "concat('<html><head><title>Offre</title></head><body><nav><span data-cy=\"jobTitles\">Menu</span></nav>', "
    + _shown("title", '<h1 class="t"><span class="a" data-cy="jobTitle"> ', " </span></h1>") + ", "
    "CASE WHEN offer_id % 2 = 0 THEN '<a class=\"tw-link-underlined\" title=\"Leurre\">Voir</a>' ELSE '' END, "
    + _shown("company", '<a href="/e" class="x tw-link-underline" title="', '">Voir</a>') + ", "
    "'<ul><li class=\"tw-tag-grey-s\">Leurre</li>', "
    + _shown("location", '<li class="tw-readonly  tw-tag-grey-s"><b>', "</b></li>") + ", "
    + _shown("contract_type", '<li class="tw-tag-grey-s tw-readonly">', "</li>") + ", '</ul><ul>', "
    + _shown("education", '<li class="tw-block tw-tag-secondary-s tw-border-0 tw-readonly">', "</li>") + ", "
    + _shown("experience", '<li class="tw-readonly tw-border-0 tw-tag-secondary-s tw-block z">', "</li>") + ", '</ul>', "
    + _shown("published_date", '<span class="tw-block tw-typo-xs tw-text-grey-500 tw-break-words">Publiée le ', " - Réf. 12</span>") + ", "
    + _shown("salary", '<button type="button" data-cy="salary-tag-button"> ', " </button>") + ", "
    "CASE offer_id % 4 "
    f"WHEN 0 THEN concat('<div data-cy=\"jobDescription\">', {_DETAIL_TEXT}, '</div>') "
    f"WHEN 1 THEN concat('<article class=\"job-detail\">', {_DETAIL_TEXT}, '</article>') "
    f"WHEN 2 THEN concat('<section><p>Court</p></section><main><section>', {_DETAIL_TEXT}, '</section></main>') "
    "ELSE '' END, '</body></html>')")


def detail_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_id, url, html): an own page for every offer; those of an offer lie next to each other in one partition."""
    return offers(spark, sf_dir, gathered=True).select(F.col("offer_id").alias("page_id"), "url", F.expr(DETAIL_PAGE).alias("html"))


def detail_offers_sql() -> str:
    """What these pages hold, from the offers' columns alone."""
    line = "CASE WHEN trim(coalesce(description, '')) = '' OR description LIKE 'Ces traceurs%' THEN '' ELSE concat(chr(10), trim(description)) END"
    return f"""SELECT offer_id, coalesce(title, 'N/A') AS title, coalesce(company, 'N/A') AS company,
  coalesce(location, contract_type, 'N/A') AS location,
  CASE WHEN location IS NULL THEN 'N/A' ELSE coalesce(contract_type, 'N/A') END AS contract_type,
  coalesce(education, experience, 'N/A') AS education,
  CASE WHEN education IS NULL THEN 'N/A' ELSE coalesce(experience, 'N/A') END AS experience,
  coalesce(published_date, 'N/A') AS published_date, coalesce(salary, 'N/A') AS salary, url,
  CASE WHEN offer_id % 4 = 3 THEN 'Non renseignée' ELSE concat('{INTRO}', {line}) END AS description FROM offers"""


def offer_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = spread(table(spark, sf_dir, "documents"), "doc_id")
    return d.select(
        F.col("doc_id").alias("offer_id"),
        F.regexp_extract("text", TITLE_PATTERN, 0).alias("title"),
        F.concat(F.col("text"), F.expr(TEXT_SUFFIX)).alias("description"),
        "lang", "source",
    )


def offers_sql() -> str:
    cols = ",\n  ".join(f"{expr.replace('{DATE}', DUCK_DATE)} AS {name}"
                        for name, expr in OFFER_COLUMNS)
    return f"SELECT\n  {cols}\nFROM orders JOIN customer ON o_custkey = c_custkey"


def offer_texts_sql() -> str:
    return ("SELECT doc_id AS offer_id, regexp_extract(text, '^[^.!?\n]*', 0) AS title, "
            f"concat(text, {TEXT_SUFFIX}) AS description, lang, source FROM documents")


def with_fixtures(sql: str) -> str:
    """Prefix an oracle query with the fixture CTEs it may reference."""
    return (f"WITH offers AS ({offers_sql()}),\n"
            f"offer_texts AS ({offer_texts_sql()}),\n"
            f"offer_cards AS ({offer_cards_sql()})\n{sql}")


# Listing cards: one per offer, with the fields a listing page exposes.
# ``{ARR}`` is the engine's array constructor, ``{COMPACT}`` drops nulls.
CARD_COLUMNS: list[tuple[str, str]] = [
    ("offer_id", "offer_id"),
    ("url", "url"),
    ("title_p", "CASE offer_id % 3 WHEN 0 THEN NULL WHEN 1 THEN title ELSE '' END"),
    ("company_p", "CASE WHEN offer_id % 5 < 2 THEN company END"),
    ("title_attr", "CASE offer_id % 4 WHEN 0 THEN NULL WHEN 1 THEN title "
                   "ELSE concat(coalesce(title, 'Poste'), ' - ', coalesce(company, 'Entreprise'), "
                   "CASE WHEN offer_id % 8 = 2 THEN ' - Paris' ELSE '' END) END"),
    ("tags", "{COMPACT}({ARR}(CASE WHEN offer_id % 6 = 0 THEN ' Lyon 3e - 69 ' END, location, contract_type, "
             "CASE WHEN offer_id % 5 = 0 THEN 'Temps plein' END, education))"),
    ("bold", "{COMPACT}({ARR}(category, CASE WHEN offer_id % 4 = 0 THEN 'Télétravail partiel' END, salary, "
             "CASE WHEN offer_id % 7 = 0 THEN ' 40k€ ' END))"),
    ("card_text", "concat_ws(' ', title, company, location, contract_type, salary, experience, description)"),
    ("full_description", "CASE WHEN offer_id % 4 = 3 THEN NULL ELSE description END"),
    ("scraped_at", "scraped_at"),
]


def _card_sql(dialect: str) -> list[str]:
    out = []
    for n, e in CARD_COLUMNS:
        if dialect == "spark":
            e = e.replace("{ARR}", "array").replace("{COMPACT}", "array_compact")
        elif e.startswith("{COMPACT}("):
            e = e.replace("{ARR}", "list_value").replace("{COMPACT}", "list_filter")
            e = e[:-1] + ", lambda v: v IS NOT NULL)"
        out.append(f"{e} AS {n}")
    return out


def offer_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return offers(spark, sf_dir).selectExpr(*_card_sql("spark"))


def offer_cards_sql() -> str:
    return f"SELECT {', '.join(_card_sql('duck'))} FROM offers"
