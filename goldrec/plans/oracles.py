"""DuckDB SQL that re-states the derivations of :mod:`goldrec.plans.derive`.

Used only by the correctness check (``oracle_sql``); never on the Spark path.
"""

from __future__ import annotations

from goldrec.functions.patterns import WS_CLASS
from goldrec.plans.derive import PLACES
from goldrec.sources.dims import SKILLS, SOURCE_CONSTANTS


def q(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def lst(values) -> str:
    return "[" + ", ".join(q(v) for v in values) + "]"


def strip(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^{WS_CLASS}+', ''), '{WS_CLASS}+$', '')"


def distinct_ordered(x: str) -> str:
    """Order-preserving de-duplication of a list expression."""
    return f"list_filter({x}, lambda v, i: list_position({x}, v) = i)"


SKILLS_L = lst(SKILLS)
PLACES_L = lst(PLACES)
CERT = {s: c for s, _, c in SOURCE_CONSTANTS}
WEIGHT = {s: w for s, w, _ in SOURCE_CONSTANTS}
RANK = {s: i for i, (s, _, _) in enumerate(sorted(SOURCE_CONSTANTS, key=lambda r: -r[1]), start=1)}


def _skill(idx: str) -> str:
    return f"{SKILLS_L}[({idx}) % {len(SKILLS)} + 1]"


def customer_records_sql(orphans: bool = False) -> str:
    """Flat records: record_id, source, cert, scalar fields, emails, phones, skills_raw, education_text."""
    k = "c_custkey"
    email = f"('customer' || {k} || '@example.com')"
    tail = f"lpad(CAST({k} % 10000 AS VARCHAR), 4, '0')"
    cols = ["full_name", "headline", "current_company", "years_experience", "linkedin", "github",
            "portfolio", "summary", "location_raw", "city", "region", "country", "emails", "phones",
            "skills_raw", "education_text", "has_exp", "has_edu"]
    types = {"has_exp": "BOOLEAN", "has_edu": "BOOLEAN", "years_experience": "DOUBLE", "emails": "VARCHAR[]", "phones": "VARCHAR[]", "skills_raw": "VARCHAR[]"}

    def rec(source, where, **f):
        sel = [f"'{source}-' || {k} AS record_id", f"'{source}' AS source", f"CAST({CERT[source]} AS DOUBLE) AS cert"]
        for c in cols:
            sel.append(f"CAST({f.get(c, 'NULL')} AS {types.get(c, 'VARCHAR')}) AS {c}")
        return f"SELECT {', '.join(sel)} FROM customer WHERE {where}"

    parts = [
        rec("csv", "TRUE", full_name="c_name", emails=f"[{email}]", phones=f"['+1 415 555 ' || {tail}]",
            headline="c_mktsegment", current_company=f"'Company ' || ({k} % 97)",
            location_raw=f"{PLACES_L}[c_nationkey % {len(PLACES)} + 1]",
            years_experience=f"{k} % 25", linkedin=f"'https://linkedin.com/in/customer-' || {k}",
            skills_raw=f"[{_skill(k)}, {_skill(k + ' * 7')}]", education_text=f"'B.Tech ' || (2000 + {k} % 20)",
            portfolio=f"CASE WHEN {k} % 10 = 0 THEN 'https://p' || {k} || '.example.org' END"),
        rec("ats", f"{k} % 2 = 0",
            full_name=f"CASE WHEN {k} % 4 = 0 THEN c_name ELSE upper(c_name) END",
            emails=f"[upper({email})]", phones=f"['+1-415-555-' || {tail}]",
            headline="c_mktsegment || ' Lead'", years_experience=f"{k} % 25 + 1",
            city="'City' || c_nationkey", github=f"'https://github.com/cust' || {k}",
            skills_raw=f"[lower({_skill(k)}), {_skill(k + ' + 3')}]",
            country=f"CASE WHEN {k} % 8 = 0 THEN 'usa' END", has_exp="TRUE", has_edu=f"{k} % 4 = 0"),
        rec("resume", f"{k} % 3 = 0", full_name="c_name",
            emails=f"[{email}, 'c' || {k} || '@mail.example.org']",
            headline=f"'Engineer at Company ' || ({k} % 97)",
            years_experience=f"CASE WHEN {k} % 6 = 0 THEN {k} % 25 + 2 END",
            summary="'Account balance ' || CAST(c_acctbal AS VARCHAR)",
            skills_raw=f"[upper({_skill(k + ' * 7')}), {_skill(k + ' + 5')} || 's']", has_exp="TRUE", has_edu="TRUE"),
        rec("notes", f"{k} % 5 = 0", full_name="lower(c_name)",
            emails=f"['  Customer' || {k} || '@Example.com ']",
            current_company=f"'Company ' || (({k} + 1) % 97)",
            skills_raw=f"[{_skill(k + ' + 11')}]", region="'Region ' || c_nationkey"),
    ]
    if orphans:
        phone = f"CASE WHEN {k} % 2 = 0 THEN '(415) 555-' || {tail} ELSE '(212) 555-' || {tail} END"
        o = rec("notes", f"{k} % 7 = 0", full_name="regexp_replace(c_name, '^Customer', 'Custmer')", phones=f"[{phone}]")
        parts.append(o.replace("'notes-' ||", "'notes2-' ||"))
    return "\nUNION ALL\n".join(parts)


_MODE = {"e6": False}


def scored_sql(recs: str) -> str:
    if _MODE["e6"]:
        return _scored_e6_sql()
    w = " ".join(f"WHEN '{s}' THEN CAST({v} AS DOUBLE)" for s, v in WEIGHT.items())
    r = " ".join(f"WHEN '{s}' THEN {v}" for s, v in RANK.items())
    key = f"lower({strip('emails[1]')})"
    return (
        f"SELECT *, (CASE source {w} ELSE 0.5 END) * cert AS score, (CASE source {r} ELSE {len(RANK) + 1} END) AS source_rank, "
        f"COALESCE({key}, 'record:' || record_id) AS entity_key FROM ({recs})"
    )


CLAIM_FIELDS = ["full_name", "headline", "current_company", "years_experience", "linkedin", "github",
                "portfolio", "summary", "location_raw", "city", "region", "country"]


def claims_sql(keyed: str = "keyed") -> str:
    return "\nUNION ALL\n".join(
        f"SELECT entity_key, '{f}' AS field, CAST({f} AS VARCHAR) AS value, source, score, source_rank, record_id "
        f"FROM {keyed} WHERE {f} IS NOT NULL"
        for f in CLAIM_FIELDS
    )


def winners_cte() -> str:
    return f"""
keyed AS ({scored_sql(customer_records_sql(_MODE["e6"]))}),
claims AS ({claims_sql()}),
pv AS (
  SELECT *, count(*) OVER (PARTITION BY entity_key, field, value) AS agree,
         row_number() OVER (PARTITION BY entity_key, field, value ORDER BY score DESC, source_rank, record_id) AS rn
  FROM claims),
best AS (SELECT * FROM pv WHERE rn = 1),
winners AS (
  SELECT entity_key, field, value, source, score, agree, record_id FROM (
    SELECT *, row_number() OVER (PARTITION BY entity_key, field ORDER BY score DESC, agree DESC, source_rank, record_id) AS wr
    FROM best) WHERE wr = 1)"""


# --- shared SQL builders ---------------------------------------------------

from goldrec.functions import dates as _D  # noqa: E402
from goldrec.functions import patterns as _P  # noqa: E402
from goldrec.functions import text as _X  # noqa: E402
from goldrec.functions.locations import PART_SPLIT, country_sql  # noqa: E402
from goldrec.functions.phones import phone_sql  # noqa: E402
from goldrec.functions.similarity import token_sort_ratio_sql, token_sort_sql  # noqa: E402
from goldrec.sources.dims import FIELD_IMPORTANCE, MONTHS, QUARTERS, US_STATES  # noqa: E402


def date_sql(x: str) -> str:
    """D1 cascade over expression ``x``."""
    s = strip(f"CAST({x} AS VARCHAR)")
    mm = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in MONTHS)
    qq = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in QUARTERS)
    iso_y, iso_m = f"regexp_extract({s}, {q(_D.ISO_RX)}, 1)", f"regexp_extract({s}, {q(_D.ISO_RX)}, 2)"
    qz = f"lower(regexp_extract({s}, {q(_D.QUARTER_RX)}, 1))"
    qy = f"regexp_extract({s}, {q(_D.QUARTER_RX)}, 2)"
    mon = f"lower(regexp_extract({s}, {q(_D.MONTH_YEAR_RX)}, 1) || regexp_extract({s}, {q(_D.MONTH_YEAR_RX)}, 4))"
    mon_y = f"(regexp_extract({s}, {q(_D.MONTH_YEAR_RX)}, 2) || regexp_extract({s}, {q(_D.MONTH_YEAR_RX)}, 3))"
    mon_mm = f"(CASE {mon} {mm} END)"
    num_m = f"(regexp_extract({s}, {q(_D.NUMERIC_RX)}, 1) || regexp_extract({s}, {q(_D.NUMERIC_RX)}, 4))"
    num_y = f"(regexp_extract({s}, {q(_D.NUMERIC_RX)}, 2) || regexp_extract({s}, {q(_D.NUMERIC_RX)}, 3))"
    year = f"regexp_extract({s}, {q(_D.YEAR_RX)}, 1)"
    return f"""(CASE
      WHEN {s} IS NULL OR {s} = '' THEN NULL
      WHEN {iso_y} <> '' AND TRY_CAST({iso_m} AS INTEGER) BETWEEN 1 AND 12 THEN {iso_y} || '-' || {iso_m}
      WHEN {qy} <> '' THEN {qy} || '-' || (CASE {qz} {qq} END)
      WHEN {mon_y} <> '' AND {mon_mm} IS NOT NULL THEN {mon_y} || '-' || {mon_mm}
      WHEN {num_y} <> '' AND TRY_CAST({num_m} AS INTEGER) BETWEEN 1 AND 12 THEN {num_y} || '-' || lpad({num_m}, 2, '0')
      WHEN {year} <> '' THEN {year} || '-01'
    END)"""


def year_sql(x: str) -> str:
    return f"TRY_CAST(nullif(regexp_extract(CAST({x} AS VARCHAR), {q(_D.YEAR_RX)}, 1), '') AS INTEGER)"


def location_sql(raw: str) -> dict[str, str]:
    parts = (
        f"list_filter(list_transform(regexp_split_to_array({strip(raw)}, {q(PART_SPLIT)}), lambda x: {strip('x')}), "
        f"lambda x: x <> '')"
    )
    n = f"(CASE WHEN {raw} IS NULL THEN 0 ELSE len({parts}) END)"
    p0, p1, last = f"({parts})[1]", f"({parts})[2]", f"({parts})[-1]"
    c0, c1 = country_sql(p0), country_sql(p1)
    state = f"(upper({p1}) IN ({', '.join(q(s) for s in US_STATES)}))"
    city = f"(CASE WHEN {n} = 1 THEN (CASE WHEN {c0} IS NULL THEN {p0} END) WHEN {n} >= 2 THEN {p0} END)"
    region = (
        f"(CASE WHEN {n} = 2 AND {c1} IS NULL THEN (CASE WHEN {state} THEN upper({p1}) ELSE {p1} END) "
        f"WHEN {n} >= 3 THEN {p1} END)"
    )
    country = (
        f"(CASE WHEN {n} = 1 THEN {c0} WHEN {n} = 2 THEN COALESCE({c1}, CASE WHEN {state} THEN 'US' END) "
        f"WHEN {n} >= 3 THEN {country_sql(last)} END)"
    )
    return {"city": city, "region": region, "country": country}


def _plain(rx: str) -> str:
    """Drop Java-only inline flags (u = Unicode case, d = Unix lines) for RE2."""
    if rx.startswith("(?"):
        end = rx.index(")")
        flags = "".join(ch for ch in rx[2:end] if ch not in "ud")
        return (f"(?{flags})" if flags else "") + rx[end + 1 :]
    return rx


def rx(pattern: str) -> str:
    return q(_plain(pattern))


# --- oracles -----------------------------------------------------------------


def oracle_field_winners() -> str:
    return f"WITH {winners_cte()}\nSELECT entity_key, field, value, source, round(score, 6) AS score, agree, record_id FROM winners"


def oracle_field_alternatives() -> str:
    return f"""WITH {winners_cte()},
dc AS (SELECT DISTINCT entity_key, field, value, source, score, source_rank FROM claims),
alts AS (SELECT DISTINCT dc.entity_key, dc.field, dc.source, dc.score, dc.source_rank FROM dc
         JOIN winners w ON dc.entity_key = w.entity_key AND dc.field = w.field WHERE dc.value <> w.value)
SELECT entity_key, field || '[alt]' AS field, source, printf('priority_score=%.3f', score) AS method FROM alts"""


def _list_items(field: str, value_expr: str) -> str:
    return f"""SELECT entity_key, v, min_by(source_rank, o) AS source_rank, min_by(record_id, o) AS record_id, min_by(pos, o) AS pos FROM (
  SELECT entity_key, source_rank, record_id, pos, {value_expr} AS v, (source_rank, record_id, pos) AS o FROM (
    SELECT entity_key, source_rank, record_id, unnest({field}) AS raw, unnest(generate_series(0, len({field}) - 1)) AS pos
    FROM keyed WHERE {field} IS NOT NULL)
  WHERE raw IS NOT NULL AND raw <> '')
WHERE v IS NOT NULL AND v <> '' GROUP BY entity_key, v"""


def _keyed_cte(orphans: bool = False) -> str:
    return f"keyed AS ({scored_sql(customer_records_sql(orphans or _MODE['e6']))})"


def oracle_union_lists() -> str:
    return f"""WITH {_keyed_cte()},
e AS ({_list_items('emails', f"lower({strip('raw')})")}),
p AS ({_list_items('phones', phone_sql('raw'))}),
ea AS (SELECT entity_key, string_agg(v, '|' ORDER BY source_rank, record_id, pos) AS emails FROM e GROUP BY entity_key),
pa AS (SELECT entity_key, string_agg(v, '|' ORDER BY source_rank, record_id, pos) AS phones FROM p GROUP BY entity_key)
SELECT entity_key, emails, phones FROM ea FULL OUTER JOIN pa USING (entity_key)"""


def oracle_entity_ids() -> str:
    return f"""WITH {_keyed_cte()},
e AS ({_list_items('emails', f"lower({strip('raw')})")}),
f AS (SELECT entity_key, arg_min(v, (source_rank, record_id, pos)) AS first_email FROM e GROUP BY entity_key)
SELECT entity_key, 'cand_' || substr(sha256(lower({strip('first_email')})), 1, 12) AS candidate_id FROM f"""


def oracle_golden_confidence() -> str:
    contrib = {
        "full_name": "full_name IS NOT NULL AND full_name <> ''",
        "emails": "len(emails) > 0",
        "phones": "len(phones) > 0",
        "headline": "headline IS NOT NULL AND headline <> ''",
        "location": "(location_raw <> '') OR (city <> '') OR (country <> '')",
        "years_experience": "years_experience IS NOT NULL AND years_experience <> 0",
        "skills": "len(skills_raw) > 0",
        "experience": "has_exp",
        "education": "has_edu OR (education_text IS NOT NULL AND education_text <> '')",
        "links": "(linkedin <> '') OR (github <> '') OR (portfolio <> '')",
    }
    valid_phones = f"len(list_filter(list_transform(phones, lambda p: {phone_sql('p')}), lambda x: x IS NOT NULL)) > 0"
    pop = {
        "full_name": "bool_or(full_name IS NOT NULL)",
        "emails": f"bool_or(len(list_filter(emails, lambda e: {strip('e')} <> '')) > 0)",
        "phones": f"bool_or(COALESCE({valid_phones}, FALSE))",
        "headline": "bool_or(headline IS NOT NULL)",
        "location": "bool_or(location_raw IS NOT NULL OR city IS NOT NULL OR country IS NOT NULL)",
        "years_experience": "bool_or(years_experience IS NOT NULL)",
        "skills": f"bool_or(len(list_filter(skills_raw, lambda s: s IS NOT NULL AND s <> '')) > 0)",
        "experience": "bool_or(has_exp)",
        "education": "bool_or(has_edu)",
        "links": "TRUE",
    }
    aggs = ["count(*) AS n_records"]
    for f, _ in FIELD_IMPORTANCE:
        aggs.append(f"max(CASE WHEN COALESCE({contrib[f]}, FALSE) THEN score END) AS best_{f}")
        aggs.append(f"count_if(COALESCE({contrib[f]}, FALSE)) AS n_{f}")
        aggs.append(f"COALESCE({pop[f]}, FALSE) AS pop_{f}")
    scores = []
    for f, _ in FIELD_IMPORTANCE:
        truthy = f"pop_{f}" if f != "years_experience" else "(pop_years_experience AND wy.yv <> 0)"
        best = f"(CASE WHEN COALESCE(best_{f}, 0.0) = 0.0 AND {truthy} THEN 0.5 ELSE COALESCE(best_{f}, 0.0) END)"
        bonus = f"least(0.15, 0.05 * greatest(0, n_{f} - 1))"
        scores.append((f, f"(CASE WHEN NOT pop_{f} THEN 0.0 ELSE least(1.0, round({best} + {bonus}, 4)) END)"))
    total_w = sum(w for _, w in FIELD_IMPORTANCE)
    weighted = None
    for (f, s), (_, w) in zip(scores, FIELD_IMPORTANCE):
        term = f"conf_{f} * CAST({w!r} AS DOUBLE)"
        weighted = term if weighted is None else f"({weighted} + {term})"
    return f"""WITH {winners_cte()},
wy AS (SELECT entity_key, CAST(value AS DOUBLE) AS yv FROM winners WHERE field = 'years_experience'),
st AS (SELECT entity_key, {', '.join(aggs)} FROM keyed GROUP BY entity_key),
sc AS (SELECT st.entity_key, n_records, {', '.join(f'{s} AS conf_{f}' for f, s in scores)}
       FROM st LEFT JOIN wy ON st.entity_key = wy.entity_key)
SELECT entity_key, {', '.join(f'conf_{f}' for f, _ in FIELD_IMPORTANCE)},
  round(least(1.0, CASE WHEN n_records = 1 THEN {weighted} / CAST({total_w!r} AS DOUBLE) * 0.9
                        WHEN n_records = 0 THEN 0.0 ELSE {weighted} / CAST({total_w!r} AS DOUBLE) END), 4) AS overall_confidence
FROM sc"""


def fallback_sql(recs: str, cutoff: int = 80) -> str:
    """E5/E6 of ``recs`` (record_id, full_name, emails, phones): record_id, entity_key."""
    ts = token_sort_sql

    def close(a: str, b: str) -> str:
        return f"least(length({ts(a)}), length({ts(b)})) * 200 >= (length({ts(a)}) + length({ts(b)})) * {cutoff}"

    return f"""WITH RECURSIVE recs AS ({recs}),
base AS MATERIALIZED (SELECT record_id, lower({strip('emails[1]')}) AS ekey, nullif(lower({strip('full_name')}), '') AS nm,
         {distinct_ordered(f"list_filter(list_transform(phones, lambda p: {phone_sql('p')}), lambda x: x IS NOT NULL)")} AS ph FROM recs),
known AS (SELECT DISTINCT entity_key, nm, phone FROM (SELECT ekey AS entity_key, nm, unnest(ph) AS phone FROM base
          WHERE ekey IS NOT NULL AND nm IS NOT NULL)),
unk AS (SELECT * FROM base WHERE ekey IS NULL),
probes AS (SELECT DISTINCT probe_name, phone FROM (SELECT nm AS probe_name, unnest(ph) AS phone FROM unk WHERE nm IS NOT NULL)),
pairs AS (SELECT p.probe_name, p.phone, k.entity_key, {token_sort_ratio_sql('p.probe_name', 'k.nm')} AS ratio
          FROM probes p JOIN known k ON p.phone = k.phone AND {close('p.probe_name', 'k.nm')}),
best AS (SELECT probe_name, phone, entity_key AS match_key, ratio FROM (
          SELECT *, row_number() OVER (PARTITION BY probe_name, phone ORDER BY ratio DESC, entity_key) AS rn FROM pairs WHERE ratio >= {cutoff})
         WHERE rn = 1),
rp AS (SELECT record_id, nm, unnest(CASE WHEN len(ph) = 0 OR ph IS NULL THEN [NULL] ELSE ph END) AS phone,
              unnest(CASE WHEN len(ph) = 0 OR ph IS NULL THEN [0] ELSE generate_series(0, len(ph) - 1) END) AS pos FROM unk),
m AS MATERIALIZED (SELECT rp.record_id, arg_min(b.match_key, (-b.ratio, b.match_key)) AS match_key,
             arg_min(rp.phone, rp.pos) AS first_phone, first(rp.nm) AS nm
      FROM rp LEFT JOIN best b ON rp.nm = b.probe_name AND rp.phone = b.phone GROUP BY rp.record_id),
own AS MATERIALIZED (SELECT record_id, match_key, CASE WHEN first_phone IS NOT NULL AND nm IS NOT NULL THEN 'phone:' || first_phone || '|' || nm END AS own_key FROM m),
spot AS MATERIALIZED (SELECT DISTINCT own_key, rp.phone, rp.nm FROM own JOIN rp USING (record_id) WHERE match_key IS NULL AND own_key IS NOT NULL AND phone IS NOT NULL),
link AS MATERIALIZED (SELECT DISTINCT a.own_key AS a, b.own_key AS b FROM spot a JOIN spot b ON a.phone = b.phone AND a.own_key <> b.own_key AND {close('a.nm', 'b.nm')}
         WHERE {token_sort_ratio_sql('a.nm', 'b.nm')} >= {cutoff}),
reach AS (SELECT DISTINCT a AS k, a AS r FROM link UNION SELECT reach.k, link.b FROM reach JOIN link ON reach.r = link.a),
joint AS (SELECT k, min(r) AS joint_key FROM reach GROUP BY k)
SELECT record_id, ekey AS entity_key FROM base WHERE ekey IS NOT NULL
UNION ALL
SELECT record_id, COALESCE(match_key, joint_key, own_key, 'record:' || record_id) AS entity_key FROM own LEFT JOIN joint ON own_key = k"""


def oracle_match_fallback() -> str:
    return fallback_sql(customer_records_sql(orphans=True))


def oracle_dates_normalized() -> str:
    d = "o_orderdate"
    raw = f"""(CASE o_orderkey % 8
      WHEN 0 THEN strftime({d}, '%Y-%m-%d') WHEN 1 THEN strftime({d}, '%b %Y') WHEN 2 THEN strftime({d}, '%B %Y')
      WHEN 3 THEN strftime({d}, '%m/%Y') WHEN 4 THEN strftime({d}, '%Y/%m')
      WHEN 5 THEN 'Q' || quarter({d}) || ' ' || year({d}) WHEN 6 THEN strftime({d}, '%Y')
      ELSE CASE WHEN o_orderkey % 16 = 7 THEN 'TBD' ELSE strftime({d}, '%Y %b') END END)"""
    return f"""SELECT o_orderkey, raw, {date_sql('raw')} AS month, {year_sql('raw')} AS year
FROM (SELECT o_orderkey, {raw} AS raw FROM orders)"""


def oracle_locations() -> str:
    from goldrec.plans.queries import LOCATION_EXTRAS

    place = f"{PLACES_L}[c_nationkey % {len(PLACES)} + 1]"
    extra = f"{lst(LOCATION_EXTRAS)}[c_custkey % {len(LOCATION_EXTRAS)} + 1]"
    raw = f"(CASE c_custkey % 4 WHEN 0 THEN {place} WHEN 1 THEN upper({place}) WHEN 2 THEN {extra} END)"
    loc = location_sql("raw")
    return f"""SELECT c_custkey, raw, {loc['city']} AS city, {loc['region']} AS region, {loc['country']} AS country
FROM (SELECT c_custkey, {raw} AS raw FROM customer)"""


def oracle_skills_normalized() -> str:
    s = f"{SKILLS_L}[p_partkey % {len(SKILLS)} + 1]"
    raw = f"""(CASE p_partkey % 7 WHEN 0 THEN {s} WHEN 1 THEN lower({s}) WHEN 2 THEN {s} || 's'
      WHEN 3 THEN substr({s}, 2) WHEN 4 THEN upper({s}) || ' ' WHEN 5 THEN p_name
      ELSE array_to_string(list_reverse(string_split({s}, ' ')), ' ') END)"""
    dict_rows = ", ".join(f"({i}, {q(n)})" for i, n in enumerate(SKILLS))
    ts = token_sort_sql
    return f"""WITH p AS (SELECT p_partkey, {raw} AS raw FROM part),
dict AS (SELECT * FROM (VALUES {dict_rows}) t(pos, name)),
d AS (SELECT DISTINCT raw, {strip('raw')} AS stripped FROM p WHERE raw IS NOT NULL),
ex AS (SELECT d.raw, d.stripped, dict.name AS exact_name FROM d LEFT JOIN dict ON lower(d.stripped) = lower(dict.name)),
cand AS (SELECT ex.raw, dict.pos, dict.name, {token_sort_ratio_sql('ex.stripped', 'dict.name')} AS ratio
         FROM ex JOIN dict ON least(length({ts('ex.stripped')}), length({ts('dict.name')})) * 200
                              >= (length({ts('ex.stripped')}) + length({ts('dict.name')})) * 80
         WHERE ex.exact_name IS NULL AND ex.stripped <> ''),
best AS (SELECT raw, name AS fname, ratio FROM (
         SELECT *, row_number() OVER (PARTITION BY raw ORDER BY ratio DESC, pos) AS rn FROM cand WHERE ratio >= 80) WHERE rn = 1),
norm AS (SELECT ex.raw,
   CASE WHEN ex.stripped = '' THEN ex.raw ELSE COALESCE(ex.exact_name, best.fname, ex.stripped) END AS name,
   CASE WHEN ex.stripped = '' THEN 0.0 WHEN ex.exact_name IS NOT NULL THEN 1.0
        WHEN best.fname IS NOT NULL THEN round(0.5 + (best.ratio - 80) / 20 * 0.49, 4) ELSE 0.5 END AS confidence
   FROM ex LEFT JOIN best ON ex.raw = best.raw)
SELECT p.p_partkey, p.raw, norm.name, norm.confidence FROM p JOIN norm ON p.raw = norm.raw"""


def _contacts_sql(col: str) -> dict[str, str]:
    spans = distinct_ordered(f"list_transform(regexp_extract_all({col}, {rx(_X.PHONE_RX)}, 0), lambda s: {strip('s')})")
    phones = distinct_ordered(f"list_filter(list_transform({spans}, lambda p: {phone_sql('p')}), lambda x: x IS NOT NULL)")
    return {
        "emails": f"array_to_string({distinct_ordered(f'regexp_extract_all({col}, {rx(_X.EMAIL_RX)}, 0)')}, '|')",
        "phone_spans": f"array_to_string({spans}, '|')",
        "phones": f"array_to_string({phones}, '|')",
        "linkedin": f"nullif(regexp_replace(regexp_extract({col}, {rx(_X.LINKEDIN_RX)}, 0), '/+$', ''), '')",
        "github": f"nullif(regexp_replace(regexp_extract({col}, {rx(_X.GITHUB_RX)}, 0), '/+$', ''), '')",
    }


def oracle_doc_contacts() -> str:
    c = _contacts_sql("text")
    return f"SELECT doc_id, {', '.join(f'{v} AS {k}' for k, v in c.items())} FROM documents"


def oracle_page_links() -> str:
    c = _contacts_sql("html")
    return f"SELECT page_id, {c['emails']} AS emails, {c['linkedin']} AS linkedin, {c['github']} AS github FROM pages"


def oracle_notes_extract() -> str:
    items = (
        f"list_filter(flatten(list_transform(regexp_extract_all(text, {rx(_X.SKILLS_LABEL_RX)}, 1), "
        f"lambda ln: list_transform(regexp_split_to_array(ln, {q(_P.NOTES_SKILL_SPLIT)}), lambda x: {strip('x')}))), lambda x: x <> '')"
    )
    return f"""SELECT conv_id, turn,
  nullif({strip(f"regexp_extract(text, {rx(_X.NAME_LABEL_RX)}, 1)")}, '') AS full_name,
  CASE WHEN len({items}) > 0 THEN array_to_string({items}, '|') END AS skills,
  TRY_CAST(nullif(regexp_extract(text, {rx(_X.YEARS_STATED_RX)}, 1), '') AS DOUBLE) AS years_experience,
  nullif({strip(f"regexp_extract(text, {rx(_X.COMPANY_RX)}, 1)")}, '') AS current_company,
  length(substr(text, 1, 500)) AS notes_len
FROM conversations"""


def _lines(col: str) -> str:
    return f"list_filter(list_transform(regexp_split_to_array({col}, {q(_X.LINE_BREAK)}), lambda l: {strip('l')}), lambda l: l <> '')"


def _words(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, {q(WS_CLASS + '+')}), lambda w: w <> '')"


def _looks_like_name(x: str) -> str:
    return (
        f"(len({_words(x)}) BETWEEN 2 AND 4 AND NOT regexp_matches({x}, '\\p{{Nd}}') "
        f"AND len(list_filter({_words(x)}, lambda w: regexp_matches(w, '^\\p{{Ll}}'))) = 0)"
    )


def oracle_resume_extract(as_of_year: int = 2026) -> str:
    lines = _lines("text")
    name = f"list_filter(list_slice({lines}, 1, 5), lambda ln: {_looks_like_name('ln')})[1]"
    head = (
        f"list_filter(list_slice({lines}, 2, 6), lambda ln: NOT regexp_matches(ln, {rx(_X.EMAIL_RX)}) "
        f"AND NOT regexp_matches(ln, {rx(_X.PHONE_RX)}) AND NOT regexp_matches(ln, {rx(_X.LINKEDIN_RX)}) "
        f"AND len({_words('ln')}) >= 3 AND NOT {_looks_like_name('ln')})[1]"
    )
    sec = rx(_X.SKILLS_SECTION_RX.replace(r"\Z", r"\z"))
    body = f"regexp_replace(regexp_extract(text, {sec}, 1), '\\([^)]*\\)', '', 'g')"
    items = f"list_filter(list_transform(regexp_split_to_array({body}, {q(_P.SKILL_SPLIT)}), lambda x: {strip('x')}), lambda x: length(x) > 1)"
    yr = rx(_X.YEAR_RANGE_RX)
    s_arr, e_arr = f"regexp_extract_all(text, {yr}, 1)", f"regexp_extract_all(text, {yr}, 2)"
    span = (
        f"list_transform(range(1, len({s_arr}) + 1), lambda i: CASE WHEN TRY_CAST({s_arr}[i] AS INTEGER) IS NOT NULL "
        f"AND (CASE WHEN lower({e_arr}[i]) IN ('present', 'current') THEN {as_of_year} ELSE TRY_CAST({e_arr}[i] AS INTEGER) END) IS NOT NULL "
        f"AND TRY_CAST({s_arr}[i] AS INTEGER) >= 1980 AND TRY_CAST({s_arr}[i] AS INTEGER) <= {as_of_year} "
        f"AND TRY_CAST({s_arr}[i] AS INTEGER) <= (CASE WHEN lower({e_arr}[i]) IN ('present', 'current') THEN {as_of_year} ELSE TRY_CAST({e_arr}[i] AS INTEGER) END) "
        f"THEN CAST((CASE WHEN lower({e_arr}[i]) IN ('present', 'current') THEN {as_of_year} ELSE TRY_CAST({e_arr}[i] AS INTEGER) END) - TRY_CAST({s_arr}[i] AS INTEGER) AS DOUBLE) ELSE 0.0 END)"
    )
    total = f"round(COALESCE(list_sum({span}), 0.0), 1)"
    return f"""SELECT doc_id, name AS full_name, CASE WHEN name IS NOT NULL THEN {head} END AS headline,
  CASE WHEN regexp_matches(text, {sec}) THEN array_to_string({items}, '|') END AS skills,
  CASE WHEN {total} > 0 THEN {total} END AS years_experience
FROM (SELECT doc_id, text, {name} AS name FROM documents)"""


def _history_items_sql() -> str:
    src = "CASE WHEN l_linenumber % 2 = 0 THEN 'ats' ELSE 'resume' END"
    r = " ".join(f"WHEN '{s}' THEN {v}" for s, v in RANK.items())
    return f"""SELECT 'customer' || o_custkey || '@example.com' AS entity_key, {src} AS source,
  (CASE {src} {r} ELSE {len(RANK) + 1} END) AS source_rank, {src} || '-' || o_custkey AS record_id,
  o_orderkey * 100 + l_linenumber AS pos,
  'Supplier ' || (l_suppkey % 20) AS company, 'Line ' || l_linenumber AS title,
  strftime(o_orderdate, '%b %Y') AS start_raw, strftime(l_shipdate, '%Y-%m') AS end_raw,
  'University ' || (l_suppkey % 13) AS institution, o_orderpriority AS degree, o_orderstatus AS field,
  CAST(year(o_orderdate) AS VARCHAR) AS end_year_raw
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""


def oracle_history_dedup() -> str:
    comp = strip("COALESCE(company, '')")
    return f"""WITH it AS ({_history_items_sql()}),
n AS (SELECT entity_key, source_rank, record_id, pos, nullif({comp}, '') AS company, lower({comp}) AS k1,
      nullif({strip("COALESCE(title, '')")}, '') AS title, {date_sql('start_raw')} AS start, {date_sql('end_raw')} AS "end" FROM it)
SELECT entity_key, company, title, start, "end" FROM (
  SELECT *, row_number() OVER (PARTITION BY entity_key, k1, start ORDER BY source_rank, record_id, pos,
    company NULLS FIRST, title NULLS FIRST, start NULLS FIRST, "end" NULLS FIRST) AS rn FROM n) WHERE rn = 1"""


def oracle_education_dedup() -> str:
    inst, deg = strip("COALESCE(institution, '')"), strip("COALESCE(degree, '')")
    return f"""WITH it AS ({_history_items_sql()}),
n AS (SELECT entity_key, source_rank, record_id, pos, nullif({inst}, '') AS institution, nullif({deg}, '') AS degree,
      lower({inst}) AS k1, lower({deg}) AS k2, nullif({strip("COALESCE(field, '')")}, '') AS field,
      COALESCE({year_sql('end_year_raw')}, TRY_CAST({strip('end_year_raw')} AS INTEGER)) AS end_year FROM it)
SELECT entity_key, institution, degree, field, end_year FROM (
  SELECT *, row_number() OVER (PARTITION BY entity_key, k1, k2 ORDER BY source_rank, record_id, pos,
    institution NULLS FIRST, degree NULLS FIRST, field NULLS FIRST, end_year NULLS FIRST) AS rn FROM n) WHERE rn = 1"""


ORACLES = {
    "field_winners": oracle_field_winners,
    "field_alternatives": oracle_field_alternatives,
    "union_lists": oracle_union_lists,
    "entity_ids": oracle_entity_ids,
    "golden_confidence": oracle_golden_confidence,
    "match_fallback": oracle_match_fallback,
    "dates_normalized": oracle_dates_normalized,
    "locations": oracle_locations,
    "skills_normalized": oracle_skills_normalized,
    "doc_contacts": oracle_doc_contacts,
    "page_links": oracle_page_links,
    "notes_extract": oracle_notes_extract,
    "resume_extract": oracle_resume_extract,
    "history_dedup": oracle_history_dedup,
    "education_dedup": oracle_education_dedup,
}


def oracle_projected_contact() -> str:
    loc = location_sql("lr")
    return f"""WITH {winners_cte()},
e AS ({_list_items('emails', f"lower({strip('raw')})")}),
p AS ({_list_items('phones', phone_sql('raw'))}),
fe AS (SELECT entity_key, arg_min(v, (source_rank, record_id, pos)) AS primary_email FROM e GROUP BY entity_key),
fp AS (SELECT entity_key, arg_min(v, (source_rank, record_id, pos)) AS phone FROM p GROUP BY entity_key),
w AS (SELECT entity_key,
        max(CASE WHEN field = 'full_name' THEN value END) AS full_name,
        max(CASE WHEN field = 'headline' THEN value END) AS headline,
        max(CASE WHEN field = 'years_experience' THEN value END) AS yv,
        max(CASE WHEN field = 'location_raw' THEN value END) AS lr,
        max(CASE WHEN field = 'city' THEN value END) AS cw,
        max(CASE WHEN field = 'country' THEN value END) AS kw
      FROM winners GROUP BY entity_key),
ents AS (SELECT DISTINCT entity_key FROM keyed)
SELECT ents.entity_key, w.full_name AS person, fe.primary_email AS mail, {phone_sql('fp.phone')} AS phone_e164, fp.phone IS NOT NULL AS reachable,
  w.headline AS job, TRY_CAST(w.yv AS DOUBLE) AS years,
  CASE WHEN w.lr IS NOT NULL AND w.lr <> '' THEN (CASE WHEN w.kw IS NOT NULL AND w.kw <> '' THEN {country_sql('w.kw')} ELSE {loc['country']} END)
       WHEN (w.cw IS NOT NULL AND w.cw <> '') OR (w.kw IS NOT NULL AND w.kw <> '') THEN (CASE WHEN w.kw <> '' THEN {country_sql('w.kw')} END)
  END AS location_country
FROM ents LEFT JOIN w USING (entity_key) LEFT JOIN fe USING (entity_key) LEFT JOIN fp USING (entity_key)"""


def oracle_violations_report() -> str:
    key = "'customer' || c_custkey || '@example.com'"
    none = "None is not of type ''{t}''"
    return f"""SELECT {key} AS entity_key, 'overall_confidence' AS path, '1.5 is greater than the maximum of 1' AS message FROM customer WHERE c_custkey % 11 = 0
UNION ALL SELECT {key}, 'candidate_id', '{none.format(t="string")}' FROM customer WHERE c_custkey % 13 = 0
UNION ALL SELECT {key}, 'emails.0', '{none.format(t="string")}' FROM customer WHERE c_custkey % 17 = 0
UNION ALL SELECT {key}, 'provenance.0.field', '{none.format(t="string")}' FROM customer WHERE c_custkey % 19 = 0"""


ORACLES.update({
    "projected_contact": oracle_projected_contact,
    "violations_report": oracle_violations_report,
})


def oracle_events_winner() -> str:
    return """WITH claims AS (
  SELECT 'user' || user_id AS entity_key, json_extract_string(props, '$.k') AS value, event_type AS source,
         CAST(0.5 AS DOUBLE) * CAST(0.5 AS DOUBLE) AS score, 5 AS source_rank, 'ev-' || event_id AS record_id
  FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL),
pv AS (SELECT *, count(*) OVER (PARTITION BY entity_key, value) AS agree,
              row_number() OVER (PARTITION BY entity_key, value ORDER BY score DESC, source_rank, record_id) AS rn FROM claims),
best AS (SELECT * FROM pv WHERE rn = 1)
SELECT entity_key, value AS k, source, agree, record_id FROM (
  SELECT *, row_number() OVER (PARTITION BY entity_key ORDER BY score DESC, agree DESC, source_rank, record_id) AS wr FROM best)
WHERE wr = 1"""


ORACLES["events_winner"] = oracle_events_winner


def oracle_csv_mapping() -> str:
    k = "c_custkey"
    name = f"(CASE WHEN {k} % 5 = 0 THEN 'Alt ' || c_name WHEN {k} % 9 = 0 THEN NULL ELSE c_name END)"
    emails = f"(CASE WHEN {k} % 9 = 0 AND {k} % 2 = 0 THEN NULL ELSE 'c' || {k} || '@x.com|d' || {k} || '@y.org' END)"
    years = f"(CASE WHEN {k} % 4 = 0 THEN NULL ELSE CAST({k} % 30 AS DOUBLE) END)"
    return f"""SELECT * FROM (
  SELECT {k} AS row_key, {name} AS full_name, {emails} AS emails,
         '+1 415 555 ' || lpad(CAST({k} % 10000 AS VARCHAR), 4, '0') || '|junk' AS phones,
         c_mktsegment AS headline, 'Python|SQL|Go' AS skills, {years} AS years_experience,
         {PLACES_L}[c_nationkey % {len(PLACES)} + 1] AS location_raw
  FROM customer) WHERE full_name IS NOT NULL OR emails IS NOT NULL"""


def oracle_json_mapping() -> str:
    k = "c_custkey"
    email = f"('customer' || {k} || '@example.com')"
    phone = f"('+1 415 555 ' || lpad(CAST({k} % 10000 AS VARCHAR), 4, '0'))"
    return f"""SELECT {k} || '#0' AS record_id, c_name AS full_name, {email} AS emails, {phone} AS phones,
       'Python|SQL' AS skills, CAST({k} % 30 AS DOUBLE) AS years_experience, CAST(NULL AS VARCHAR) AS headline, 1 AS n_experience
FROM customer WHERE {k} % 4 = 0
UNION ALL
SELECT {k} || '#0', split_part(c_name, '#', 1) || ' ' || split_part(c_name, '#', 2), {email} || '|' || upper({email}), {phone},
       'Python|SQL|Go', CAST({k} % 30 AS DOUBLE), NULL, NULL
FROM customer WHERE {k} % 4 = 1
UNION ALL
SELECT {k} || '#0', c_name, {email}, NULL, NULL, NULL, NULL, NULL FROM customer WHERE {k} % 4 = 2
UNION ALL
SELECT {k} || '#1', 'Second ' || {k}, NULL, NULL, NULL, NULL, c_mktsegment, NULL FROM customer WHERE {k} % 4 = 2"""


ORACLES.update({"csv_mapping": oracle_csv_mapping, "json_mapping": oracle_json_mapping})


def _skill_norm_sql(raws: str) -> str:
    """(raw, name, confidence) for the distinct values of the ``raw`` column of ``raws``."""
    dict_rows = ", ".join(f"({i}, {q(n)})" for i, n in enumerate(SKILLS))
    ts = token_sort_sql
    return f"""(WITH dict AS (SELECT * FROM (VALUES {dict_rows}) t(pos, name)),
d AS (SELECT DISTINCT raw, {strip('raw')} AS stripped FROM {raws} WHERE raw IS NOT NULL),
ex AS (SELECT d.raw, d.stripped, dict.name AS exact_name FROM d LEFT JOIN dict ON lower(d.stripped) = lower(dict.name)),
cand AS (SELECT ex.raw, dict.pos, dict.name, {token_sort_ratio_sql('ex.stripped', 'dict.name')} AS ratio
         FROM ex JOIN dict ON least(length({ts('ex.stripped')}), length({ts('dict.name')})) * 200
                              >= (length({ts('ex.stripped')}) + length({ts('dict.name')})) * 80
         WHERE ex.exact_name IS NULL AND ex.stripped <> ''),
best AS (SELECT raw, name AS fname, ratio FROM (
         SELECT *, row_number() OVER (PARTITION BY raw ORDER BY ratio DESC, pos) AS rn FROM cand WHERE ratio >= 80) WHERE rn = 1)
SELECT ex.raw,
   CASE WHEN ex.stripped = '' THEN ex.raw ELSE COALESCE(ex.exact_name, best.fname, ex.stripped) END AS name,
   CASE WHEN ex.stripped = '' THEN 0.0 WHEN ex.exact_name IS NOT NULL THEN 1.0
        WHEN best.fname IS NOT NULL THEN round(0.5 + (best.ratio - 80) / 20 * 0.49, 4) ELSE 0.5 END AS confidence
FROM ex LEFT JOIN best ON ex.raw = best.raw)"""


def oracle_skills_merged() -> str:
    return f"""WITH {_keyed_cte()},
items AS (SELECT * FROM (
  SELECT entity_key, source, source_rank, record_id, unnest(skills_raw) AS raw, unnest(generate_series(0, len(skills_raw) - 1)) AS pos
  FROM keyed WHERE skills_raw IS NOT NULL) WHERE raw IS NOT NULL AND raw <> ''),
norm AS {_skill_norm_sql('items')},
it AS (SELECT items.*, norm.name, norm.confidence FROM items JOIN norm ON items.raw = norm.raw),
merged AS (SELECT entity_key, lower(name) AS key,
                  arg_min(name, (-confidence, source_rank, record_id, pos)) AS bname,
                  arg_min(confidence, (-confidence, source_rank, record_id, pos)) AS bconf,
                  min((source_rank, record_id, pos)) AS first
           FROM it GROUP BY entity_key, lower(name)),
raw_src AS (SELECT DISTINCT entity_key, lower({strip('raw')}) AS raw_key, source FROM it),
hits AS (SELECT m.entity_key, m.key, list_sort(list(DISTINCT r.source)) AS srcs
         FROM merged m JOIN raw_src r ON m.entity_key = r.entity_key
         WHERE r.raw_key = m.key OR {token_sort_ratio_sql('r.raw_key', 'm.key')} >= 75
         GROUP BY m.entity_key, m.key),
sk AS (SELECT m.*, COALESCE(h.srcs, ['merged']) AS sources FROM merged m LEFT JOIN hits h ON m.entity_key = h.entity_key AND m.key = h.key)
SELECT entity_key, CAST(row_number() OVER (PARTITION BY entity_key ORDER BY first) AS INTEGER) AS ord, bname AS name,
       round(least(1.0, bconf + least(0.1, 0.05 * greatest(0, len(sources) - 1))), 4) AS confidence,
       array_to_string(sources, '+') AS sources
FROM sk"""


ORACLES["skills_merged"] = oracle_skills_merged


def oracle_golden_provenance() -> str:
    from goldrec.operators.claims import LOCATION_FIELDS, PROVENANCE_ORDER, WINNER_FIELDS

    ordv = " ".join(f"WHEN '{f}' THEN {i}" for i, f in enumerate(PROVENANCE_ORDER))
    loc = location_sql("lr")
    return f"""WITH {winners_cte()},
dc AS (SELECT DISTINCT entity_key, field, value, source, score, source_rank FROM claims),
alts AS (SELECT DISTINCT dc.entity_key, dc.field, dc.source, dc.score, dc.source_rank FROM dc
         JOIN winners w ON dc.entity_key = w.entity_key AND dc.field = w.field WHERE dc.value <> w.value),
w AS (SELECT entity_key,
        max(CASE WHEN field = 'location_raw' THEN value END) AS lr,
        max(CASE WHEN field = 'city' THEN value END) AS cw,
        max(CASE WHEN field = 'region' THEN value END) AS rw,
        max(CASE WHEN field = 'country' THEN value END) AS kw
      FROM winners GROUP BY entity_key),
locset AS (SELECT entity_key FROM w WHERE
      (lr IS NOT NULL AND lr <> '' AND (COALESCE(nullif(cw, ''), {loc['city']}) IS NOT NULL
                                        OR COALESCE(nullif(rw, ''), {loc['region']}) IS NOT NULL
                                        OR (CASE WHEN kw <> '' THEN {country_sql('kw')} ELSE {loc['country']} END) IS NOT NULL))
      OR ((lr IS NULL OR lr = '') AND ((cw <> '') OR (kw <> ''))
          AND ((cw <> '') OR (rw <> '') OR (kw <> '' AND {country_sql('kw')} IS NOT NULL)))),
locsrc AS (SELECT entity_key, arg_min(source, (source_rank, record_id)) AS src FROM keyed
           WHERE location_raw IS NOT NULL AND location_raw <> '' GROUP BY entity_key),
raw_e AS (SELECT DISTINCT entity_key FROM keyed WHERE len(list_filter(emails, lambda x: x IS NOT NULL AND x <> '')) > 0),
raw_p AS (SELECT DISTINCT entity_key FROM keyed WHERE len(list_filter(phones, lambda x: x IS NOT NULL AND x <> '')) > 0),
sk AS (SELECT DISTINCT entity_key FROM keyed WHERE len(list_filter(skills_raw, lambda x: x IS NOT NULL AND x <> '')) > 0),
entries AS (
  SELECT entity_key, (CASE field {ordv} END) AS f, 0 AS alt, -score AS s, 0 AS r, source AS src,
         field AS pfield, source, printf('priority_score=%.3f', score) AS method FROM winners
  UNION ALL
  SELECT entity_key, (CASE field {ordv} END), 1, -score, source_rank, source,
         field || '[alt]', source, printf('priority_score=%.3f', score) FROM alts
  UNION ALL SELECT entity_key, {PROVENANCE_ORDER.index('emails')}, 0, 0.0, 0, '', 'emails', 'merged', 'union' FROM raw_e
  UNION ALL SELECT entity_key, {PROVENANCE_ORDER.index('phones')}, 0, 0.0, 0, '', 'phones', 'merged', 'union' FROM raw_p
  UNION ALL SELECT l.entity_key, {PROVENANCE_ORDER.index('location')}, 0, 0.0, 0, '', 'location', COALESCE(ls.src, 'merged'),
         'location_normalizer' FROM locset l LEFT JOIN locsrc ls ON l.entity_key = ls.entity_key
  UNION ALL SELECT entity_key, {PROVENANCE_ORDER.index('skills')}, 0, 0.0, 0, '', 'skills', 'merged', 'skill_normalizer+fuzzy' FROM sk
  UNION ALL SELECT DISTINCT entity_key, {PROVENANCE_ORDER.index('experience')}, 0, 0.0, 0, '', 'experience', 'merged', 'union+dedup' FROM keyed WHERE has_exp
  UNION ALL SELECT DISTINCT entity_key, {PROVENANCE_ORDER.index('education')}, 0, 0.0, 0, '', 'education', 'merged', 'union+dedup' FROM keyed WHERE has_edu)
SELECT entity_key, CAST(count(*) AS INTEGER) AS n,
       string_agg(pfield || ':' || source || ':' || method, '|' ORDER BY f, alt, s, r, src) AS provenance
FROM entries GROUP BY entity_key"""


ORACLES["golden_provenance"] = oracle_golden_provenance


def oracle_projected_custom() -> str:
    """Composed from the part oracles: contact fields, canonical skill names, confidence, provenance size."""
    return f"""SELECT pc.entity_key, pc.person, coalesce(ul.emails, '') AS mails, sk.skills AS tools, gc.overall_confidence, pc.location_country AS country,
       gp.n AS n_provenance, (pc.person IS NOT NULL)::INTEGER + (pc.location_country IS NOT NULL)::INTEGER AS n_fields
FROM ({oracle_projected_contact()}) pc
LEFT JOIN ({oracle_union_lists()}) ul ON pc.entity_key = ul.entity_key
LEFT JOIN (SELECT entity_key, string_agg(name, '|' ORDER BY ord) AS skills FROM ({oracle_skills_merged()}) GROUP BY entity_key) sk
  ON pc.entity_key = sk.entity_key
LEFT JOIN ({oracle_golden_confidence()}) gc ON pc.entity_key = gc.entity_key
LEFT JOIN ({oracle_golden_provenance()}) gp ON pc.entity_key = gp.entity_key"""


ORACLES["projected_custom"] = oracle_projected_custom



def _scored_e6_sql() -> str:
    """Keyed records with orphans, entity keys from the E6 oracle."""
    w = " ".join(f"WHEN '{s}' THEN CAST({v} AS DOUBLE)" for s, v in WEIGHT.items())
    r = " ".join(f"WHEN '{s}' THEN {v}" for s, v in RANK.items())
    _MODE["e6"] = False
    try:
        mf = oracle_match_fallback()
        recs = customer_records_sql(orphans=True)
    finally:
        _MODE["e6"] = True
    return (
        f"SELECT r.*, (CASE r.source {w} ELSE 0.5 END) * r.cert AS score, "
        f"(CASE r.source {r} ELSE {len(RANK) + 1} END) AS source_rank, mf.entity_key "
        f"FROM ({recs}) r JOIN ({mf}) mf ON r.record_id = mf.record_id"
    )


def _expected_histories() -> str:
    """Histories as the rules of ``customer_records`` imply them: first spelling by source order, repeats dropped."""
    k = "c_custkey"
    firm, school = f"('Company ' || ({k} % 97))", f"('Univ ' || ({k} % 13))"
    return f"""SELECT 'customer' || {k} || '@example.com' AS entity_key,
  concat_ws('|', CASE WHEN {k} % 2 = 0 THEN {firm} || ';' || c_mktsegment || ';2015-01;2018-06' WHEN {k} % 3 = 0 THEN lower({firm}) || ';Copy;2015-01;2018-01' END,
    CASE WHEN {k} % 3 = 0 THEN 'Startup;CTO;2019-01;' END) AS experience,
  concat_ws('|', CASE WHEN {k} % 4 = 0 THEN {school} || ';B.Tech;Physics;2010' WHEN {k} % 3 = 0 THEN upper({school}) || ';b.tech;;2011' END,
    CASE WHEN {k} % 3 = 0 THEN 'Open School;;Law;' END) AS education
FROM customer"""


def oracle_golden_records() -> str:
    """The flagship, composed from the part oracles over E6-keyed records."""
    _MODE["e6"] = True
    try:
        lists = oracle_union_lists()
        conf = oracle_golden_confidence()
        prov = oracle_golden_provenance()
        skills = oracle_skills_merged()
        wcte = winners_cte()
    finally:
        _MODE["e6"] = False
    loc = location_sql("w.lr")
    nz = lambda x: f"nullif({x}, '')"
    has_raw = "w.lr IS NOT NULL AND w.lr <> ''"
    explicit = "(w.cw <> '') OR (w.kw <> '')"
    city = f"CASE WHEN {has_raw} THEN COALESCE({nz('w.cw')}, {loc['city']}) WHEN {explicit} THEN {nz('w.cw')} END"
    region = f"CASE WHEN {has_raw} THEN COALESCE({nz('w.rw')}, {loc['region']}) WHEN {explicit} THEN {nz('w.rw')} END"
    country = (f"CASE WHEN {has_raw} THEN (CASE WHEN w.kw <> '' THEN {country_sql('w.kw')} ELSE {loc['country']} END) "
               f"WHEN {explicit} THEN (CASE WHEN w.kw <> '' THEN {country_sql('w.kw')} END) END")
    seed = "lower(" + strip("COALESCE(split_part(l.emails, '|', 1), w.full_name, e.entity_key)") + ")"
    return f"""WITH {wcte},
wide AS (SELECT entity_key,
        max(CASE WHEN field = 'full_name' THEN value END) AS full_name,
        max(CASE WHEN field = 'headline' THEN value END) AS headline,
        max(CASE WHEN field = 'years_experience' THEN value END) AS yv,
        max(CASE WHEN field = 'linkedin' THEN value END) AS linkedin,
        max(CASE WHEN field = 'github' THEN value END) AS github,
        max(CASE WHEN field = 'portfolio' THEN value END) AS portfolio,
        max(CASE WHEN field = 'location_raw' THEN value END) AS lr,
        max(CASE WHEN field = 'city' THEN value END) AS cw,
        max(CASE WHEN field = 'region' THEN value END) AS rw,
        max(CASE WHEN field = 'country' THEN value END) AS kw
      FROM winners GROUP BY entity_key),
ents AS (SELECT DISTINCT entity_key FROM keyed)
SELECT e.entity_key,
  'cand_' || substr(sha256({seed}), 1, 12) AS candidate_id,
  w.full_name, COALESCE(l.emails, '') AS emails, COALESCE(l.phones, '') AS phones,
  {city} AS city,
  {region} AS region,
  {country} AS country,
  w.linkedin, w.github, w.portfolio, w.headline, TRY_CAST(w.yv AS DOUBLE) AS years_experience,
  COALESCE(sk.skills, '') AS skills, COALESCE(h.experience, '') AS experience, COALESCE(h.education, '') AS education, gp.provenance, gc.overall_confidence
FROM ents e
LEFT JOIN ({_expected_histories()}) h ON e.entity_key = h.entity_key
LEFT JOIN wide w ON e.entity_key = w.entity_key
LEFT JOIN ({lists}) l ON e.entity_key = l.entity_key
LEFT JOIN (SELECT entity_key, string_agg(name || ':' || CAST(confidence AS VARCHAR) || ':' || sources, '|' ORDER BY ord) AS skills
           FROM ({skills}) GROUP BY entity_key) sk ON e.entity_key = sk.entity_key
LEFT JOIN ({conf}) gc ON e.entity_key = gc.entity_key
LEFT JOIN ({prov}) gp ON e.entity_key = gp.entity_key"""


ORACLES["golden_records"] = oracle_golden_records

from goldrec.plans.exports import ORACLES as _EXPORTS  # noqa: E402
from goldrec.plans.jobs import ORACLES as _JOBS  # noqa: E402
from goldrec.plans.people import ORACLES as _PEOPLE  # noqa: E402
from goldrec.plans.texts import oracle_notes_fields, oracle_resume_fields  # noqa: E402

ORACLES.update({"resume_fields": oracle_resume_fields, "notes_fields": oracle_notes_fields, **_EXPORTS, **_PEOPLE, **_JOBS})
