"""DuckDB SQL builders mirroring the Spark expressions (used only by the oracle).

Each helper returns a SQL expression string over a SQL expression argument.
They use the same engine-neutral regex classes as the Spark side.
"""

from __future__ import annotations

from offerlens.functions import experience as X
from offerlens.functions import geo as G
from offerlens.functions import salary as M
from offerlens.functions import text as T
from offerlens.functions.regex import DIGIT, WORD, WS, S, strip_pattern


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def ustrip(e: str) -> str:
    return f"regexp_replace({e}, {q(strip_pattern())}, '', 'g')"


def collapse_ws(e: str) -> str:
    return f"regexp_replace({e}, {q(S + '+')}, ' ', 'g')"


def contains_any(e: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains({e}, {q(w)})" for w in words) + ")"


def clean_text(e: str, variant: str = "v2") -> str:
    other = f"[^{WORD}{WS}{T._KEEP[variant]}]"
    x = f"lower(coalesce({e}, ''))"
    if variant == "v3":
        x = collapse_ws(f"regexp_replace({x}, {q(other)}, ' ', 'g')")
    else:
        x = f"regexp_replace({collapse_ws(x)}, {q(other)}, ' ', 'g')"
    return ustrip(x)


def clean_cluster_text(e: str) -> str:
    return ustrip(collapse_ws(f"regexp_replace(lower({e}), '\\p{{Nd}}+', ' ', 'g')"))


def text_all(t: str, d: str) -> str:
    return ustrip(f"concat_ws(' ', coalesce({t}, ''), coalesce({d}, ''))")


def flag(cond: str) -> str:
    return f"CAST(coalesce({cond}, false) AS INTEGER)"


def numbers(e: str) -> str:
    return f"list_transform(regexp_extract_all({e}, {q(M.NUMBER)}, 1), lambda x: CAST(x AS DOUBLE))"


def round_long(e: str) -> str:
    return f"CAST(round_even({e}, 0) AS BIGINT)"


def salary_struct(lo: str, hi: str, factor: str, extra: dict[str, str] | None = None) -> str:
    smin, smax = round_long(f"({lo}) * ({factor})"), round_long(f"({hi}) * ({factor})")
    fields = [f"salary_min := {smin}", f"salary_max := {smax}",
              f"salary_avg := ({smin} + {smax}) / 2.0"]
    for k, v in (extra or {}).items():
        fields.append(f"{k} := {v}")
    return "struct_pack(" + ", ".join(fields) + ")"


def parse_salary(e: str, variant: str) -> str:
    """Returns a struct expression with the same fields as the Spark side."""
    hours, months = float(M.HOURS_PER_YEAR), float(M.MONTHS_PER_YEAR)
    if variant == "v1":
        s = f"lower({e})"
        n = numbers(s)
        lo = f"least({n}[1], coalesce({n}[2], {n}[1]))"
        hi = f"greatest({n}[1], coalesce({n}[2], {n}[1]))"
        factor = (f"CASE WHEN {contains_any(s, ['heure', '/h'])} THEN {hours} "
                  f"WHEN contains({s}, 'mois') THEN {months} ELSE 1.0 END")
        return (f"CASE WHEN len({n}) > 0 THEN {salary_struct(lo, hi, factor)} "
                f"ELSE {salary_struct('NULL', 'NULL', factor)} END")
    if variant == "v2":
        s = f"lower({ustrip(e)})"
        hourly = f"contains({s}, 'heure')"
        monthly = f"contains({s}, 'mois')"
        absent = f"({e} IS NULL OR contains({s}, 'pas de salaire') OR {s} = '')"
        est = contains_any(s, ["estimation", "→"])
        fixed = (f"CASE WHEN {hourly} THEN regexp_replace({s}, "
                 f"{q(f'([{DIGIT}]+),([{DIGIT}]{{1,2}})([^{DIGIT}]|$)')}, '\\1.\\2\\3', 'g') ELSE {s} END")
        sq = f"regexp_replace({fixed}, {q(f'[{WS}]+')}, '', 'g')"
        n = numbers(sq)
        lo = f"least({n}[1], coalesce({n}[2], {n}[1]))"
        hi = f"greatest({n}[1], coalesce({n}[2], {n}[1]))"
        factor = f"CASE WHEN {hourly} THEN {hours} WHEN {monthly} THEN {months} ELSE 1.0 END"
        unit = f"CASE WHEN {hourly} THEN 'hourly' WHEN {monthly} THEN 'monthly' ELSE 'annual' END"
        some = salary_struct(lo, hi, factor, {"salary_estimated": est, "salary_unit": unit})
        none_est = salary_struct("NULL", "NULL", factor,
                                 {"salary_estimated": est, "salary_unit": "CAST(NULL AS VARCHAR)"})
        none_all = salary_struct("NULL", "NULL", factor,
                                 {"salary_estimated": "false", "salary_unit": "CAST(NULL AS VARCHAR)"})
        return f"CASE WHEN {absent} THEN {none_all} WHEN len({n}) = 0 THEN {none_est} ELSE {some} END"
    if variant == "v3":
        s = f"lower({e})"
        hourly = f"contains({s}, 'heure')"
        monthly = f"contains({s}, 'mois')"
        fixed = f"regexp_replace({s}, {q(f'([{DIGIT}]+),([{DIGIT}]+)')}, '\\1.\\2', 'g')"
        sq = f"regexp_replace({fixed}, {q(f'[{WS}]')}, '', 'g')"
        n = numbers(sq)
        factor = f"CASE WHEN {hourly} THEN {hours} WHEN {monthly} THEN {months} ELSE 1.0 END"
        unit = f"CASE WHEN {hourly} THEN 'hourly' WHEN {monthly} THEN 'monthly' ELSE 'annual' END"
        some = salary_struct(f"list_min({n})", f"list_max({n})", factor, {"salary_unit": unit})
        none = salary_struct("NULL", "NULL", factor, {"salary_unit": "CAST(NULL AS VARCHAR)"})
        return f"CASE WHEN {e} IS NULL OR len({n}) = 0 THEN {none} ELSE {some} END"
    raise ValueError(variant)


def fixed_bins(e: str) -> str:
    parts = [f"WHEN {e} IS NULL THEN {q(M.FIXED_NULL)}"]
    parts += [f"WHEN {e} < {b} THEN {q(lab)}" for b, lab in M.FIXED_BINS]
    return "CASE " + " ".join(parts) + f" ELSE {q(M.FIXED_TOP)} END"


def title_case(e: str) -> str:
    return (f"array_to_string(list_transform(regexp_extract_all({e}, '(\\p{{L}}+|[^\\p{{L}}]+)', 1), "
            f"lambda w: concat(upper(substr(w, 1, 1)), lower(substr(w, 2)))), '')")


def location_v2(e: str) -> str:
    s = ustrip(e)
    parts = f"string_split({s}, ' - ')"
    return (f"CASE WHEN {e} IS NULL THEN struct_pack(ville := {q(G.NOT_GIVEN)}, departement := {q(G.NA)}) "
            f"WHEN contains({s}, ' - ') THEN struct_pack(ville := {ustrip(parts + '[1]')}, "
            f"departement := {ustrip(parts + '[2]')}) "
            f"ELSE struct_pack(ville := {s}, departement := {q(G.NA)}) END")


def location_v3(e: str) -> str:
    s = f"lower({ustrip(e)})"
    pa = f"([{DIGIT}]{{1,2}})[{WS}]*{G.DASH}[{WS}]*({G.CITY}+)"
    pb = f"({G.CITY}+)[{WS}]*{G.DASH}[{WS}]*([{DIGIT}]{{1,2}})"
    pc = f"({G.CITY}+)[{WS}]*\\(([{DIGIT}]{{1,2}})\\)"
    pd = f"^{G.CITY}+$"

    def city(x):
        return ustrip(title_case(x))

    def mk(ci, de):
        return f"struct_pack(city := {ci}, department := {de})"

    unk = mk(q(G.NOT_GIVEN), q(G.NOT_GIVEN))
    return (f"CASE WHEN {e} IS NULL THEN {unk} "
            f"WHEN regexp_matches({s}, {q(G.SALARY_MARKERS)}) THEN {unk} "
            f"WHEN regexp_matches({s}, {q(pa)}) THEN {mk(city(f'regexp_extract({s}, {q(pa)}, 2)'), f'lpad(regexp_extract({s}, {q(pa)}, 1), 2, {q(chr(48))})')} "
            f"WHEN regexp_matches({s}, {q(pb)}) THEN {mk(city(f'regexp_extract({s}, {q(pb)}, 1)'), f'lpad(regexp_extract({s}, {q(pb)}, 2), 2, {q(chr(48))})')} "
            f"WHEN regexp_matches({s}, {q(pc)}) THEN {mk(city(f'regexp_extract({s}, {q(pc)}, 1)'), f'lpad(regexp_extract({s}, {q(pc)}, 2), 2, {q(chr(48))})')} "
            f"WHEN regexp_matches({s}, {q(pd)}) THEN {mk(city(s), q(G.NOT_GIVEN))} "
            f"ELSE {unk} END")


def department_num(e: str) -> str:
    s = ustrip(f"CAST({e} AS VARCHAR)")
    return (f"CASE WHEN lower({s}) = {q(G.NOT_GIVEN.lower())} THEN -1 "
            f"ELSE coalesce(TRY_CAST(trunc(TRY_CAST({s} AS DOUBLE)) AS INTEGER), -1) END")


def _level(v: str, bounds, what: str) -> str:
    parts = []
    for (op, b), (lv, lab) in zip(bounds, X.LEVELS):
        val = lv if what == "code" else q(lab)
        parts.append(f"WHEN {v} {'=' if op == '==' else '<='} {b} THEN {val}")
    last = X.LEVELS[-1][0] if what == "code" else q(X.LEVELS[-1][1])
    return "CASE " + " ".join(parts) + f" ELSE {last} END"


def experience_v2(e: str) -> str:
    s = f"lower({ustrip(e)})"
    a = f"TRY_CAST(regexp_extract({s}, {q(X.RANGE_EXP)}, 1) AS BIGINT)"
    b = f"TRY_CAST(regexp_extract({s}, {q(X.RANGE_EXP)}, 2) AS BIGINT)"
    avg = f"(({a} + {b}) / 2.0)"
    rb = [("<=", 1), ("<=", 3), ("<=", 6), ("<=", 10)]
    y = f"TRY_CAST(regexp_extract({s}, {q(X.SINGLE_V2)}, 1) AS BIGINT)"
    yb = [("==", 0), ("<=", 2), ("<=", 5), ("<=", 10)]

    def mk(code, label, raw):
        return (f"struct_pack(experience_encoded := CAST({code} AS INTEGER), "
                f"experience_label := {label}, experience_raw := {raw})")

    parts = [f"WHEN {e} IS NULL THEN {mk(-1, q(X.NOT_GIVEN), q(X.NOT_GIVEN))}",
             f"WHEN regexp_matches({s}, {q(X.RANGE_EXP)}) THEN "
             f"{mk(_level(avg, rb, 'code'), _level(avg, rb, 'label'), f'concat(CAST({a} AS VARCHAR), {q(chr(45))}, CAST({b} AS VARCHAR), {q(chr(32) + 'ans')})')}",
             f"WHEN regexp_matches({s}, {q(X.SINGLE_V2)}) THEN "
             f"{mk(_level(y, yb, 'code'), _level(y, yb, 'label'), f'concat(CAST({y} AS VARCHAR), {q(chr(32) + 'ans')})')}"]
    for kw, lv, lab in X.KEYWORDS:
        parts.append(f"WHEN contains({s}, {q(kw)}) THEN {mk(lv, q(lab), q(kw))}")
    parts.append(f"WHEN contains({e}, '•') OR contains({s}, 'secteur') THEN {mk(-1, q(X.SECTOR), e)}")
    parts.append(f"WHEN {contains_any(s, X.STUDY_WORDS)} THEN {mk(-1, q(X.STUDIES), e)}")
    return "CASE " + " ".join(parts) + f" ELSE {mk(-1, q(X.NOT_GIVEN), e)} END"


def experience_years(e: str, variant: str) -> str:
    s = f"lower({e})"
    a = f"TRY_CAST(regexp_extract({s}, {q(X.RANGE)}, 1) AS BIGINT)"
    b = f"TRY_CAST(regexp_extract({s}, {q(X.RANGE)}, 2) AS BIGINT)"
    single = f"CAST(TRY_CAST(regexp_extract({s}, {q(X.SINGLE)}, 1) AS BIGINT) AS DOUBLE)"
    parts = [f"WHEN {e} IS NULL THEN CAST(NULL AS DOUBLE)"]
    if variant == "v1":
        parts.append(f"WHEN contains({s}, 'débutant') THEN 0.0")
    parts.append(f"WHEN regexp_matches({s}, {q(X.RANGE)}) THEN ({a} + {b}) / 2.0")
    parts.append(f"WHEN regexp_matches({s}, {q(X.SINGLE)}) THEN {single}")
    return "CASE " + " ".join(parts) + " ELSE CAST(NULL AS DOUBLE) END"


def parse_date(e: str) -> str:
    return (f"CASE WHEN regexp_matches({e}, '^[{DIGIT}]{{1,2}}/[{DIGIT}]{{1,2}}/[{DIGIT}]{{4}}$') "
            f"THEN CAST(try_strptime({e}, '%d/%m/%Y') AS DATE) END")


def experience_phrase(e: str) -> str:
    p = f"(?i)[{DIGIT}]+[{WS}]*(?:ans?|années?)[{WS}]*(?:d'expérience|expérience|exp)"
    return f"nullif(regexp_extract({e}, {q(p)}, 0), '')"


def null_marker(e: str) -> str:
    from offerlens.operators.quality import NULL_MARKERS
    return f"CASE WHEN {e} IN ({', '.join(q(m) for m in NULL_MARKERS)}) THEN NULL ELSE {e} END"


def _skill_alt(patterns: list[str]) -> tuple[str, bool]:
    """Engine-neutral alternation for one skill; True when it needs the
    'tableau de' masked text (the one real lookahead of the dictionary)."""
    from offerlens.functions.regex import boundary_free
    masked = False
    alts = []
    for p in patterns:
        p = p.replace("(?!script)", "")  # vacuous after \b
        if "(?!" in p:
            p = p.split("(?!")[0]
            masked = True
        p = boundary_free(p).replace(r"\s", f"[{WS}]")
        alts.append(f"(?:{p})")
    return "|".join(alts), masked


def skills_list(e: str) -> str:
    from offerlens.functions.skills import SKILLS
    from offerlens.functions.skills import FOLD_FROM, FOLD_TO
    t = f"concat(' ', translate(lower({e}), {q(FOLD_FROM)}, {q(FOLD_TO)}), ' ')"
    tm = f"regexp_replace({t}, {q(f'tableau[{WS}]+de')}, ' ', 'g')"
    items = []
    for skill, pats in SKILLS.items():
        alt, masked = _skill_alt(pats)
        items.append(f"CASE WHEN regexp_matches({tm if masked else t}, {q(alt)}) THEN {q(skill)} END")
    return f"list_filter([{', '.join(items)}], lambda x: x IS NOT NULL)"


def days_since(e: str, as_of: str) -> str:
    return f"CAST(DATE '{as_of}' - {e} AS INTEGER)"
