"""DuckDB SQL for the registered queries.

Written from the semantics, not from the Spark plans: the latest run is an
aggregate joined back, fields are unpivoted and joined to the cell list, lines
are folded as text.  Shared parts are CTEs, assembled per query.
"""

import re

from quartermill.operators import errors
from quartermill.plans.registry import (
    SKIPPED_SITE,
    AS_OF, CATALOG_VERSIONS, DAMAGE, FAILED_SITE, FEDERAL_CODES, GROUP_CODES, LOST_SITE, NON_REPORTING, REPEATED_QUARTER, REPORTING, RULE_ROWS, RUN_TIME, RUNS,
    UNQUEUED_SITE,
)
from quartermill.sources import sample_views
from quartermill.specs import fixed_values as fixed
from quartermill.operators.taxes import default_row_fields
from quartermill.specs.compile import default_specs

SPECS = default_specs()


def lit(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, (int, float)):
        return str(value)
    return "'" + str(value).replace("'", "''") + "'"


def values(name: str, columns: str, rows) -> str:
    body = ", ".join("(" + ", ".join(lit(v) for v in row) + ")" for row in rows)
    return f"{name}({columns}) AS (VALUES {body})"


CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, needs: str, sql: str, columns: str = "") -> None:
    head = f"{name}({columns})" if columns else name
    CTES[name] = (tuple(needs.split()), f"{head} AS MATERIALIZED ({sql})")


def build(needs: str, select: str) -> str:
    """Full statement: sample views, the CTEs needed (in order), then ``select``."""
    views: list[str] = []
    parts: list[str] = []
    seen: set[str] = set()

    def add(name: str) -> None:
        if name in seen:
            return
        seen.add(name)
        if name in sample_views.VIEWS:
            views.append(name)
            return
        required, text = CTES[name]
        for other in required:
            add(other)
        parts.append(text)

    for name in needs.split():
        add(name)
    head = sample_views.with_clause(*views) if views else "WITH none AS (SELECT 1)"
    return ", ".join([head, *parts]) + " " + select


# --- shared parts -----------------------------------------------------------------

PROFILE_COLUMNS = """
upper(w.family_name) AS family_name, upper(w.given_name) AS given_name, upper(left(w.middle_name, 1)) AS middle_name,
w.ssn, w.birth_date, w.hire_date, w.termination_date, w.gender, w.department_code, w.employee_id, w.pay_rate_amount, w.job_title"""


def _yn(condition: str, yes="Y", no="N") -> str:
    return f"CASE WHEN {condition} THEN '{yes}' ELSE '{no}' END"


FLAG_COLUMNS = f"""
{_yn('w.retirement_plan_indicator')} AS retirement_plan_indicator,
{_yn('w.third_party_sick_pay_indicator')} AS third_party_sick_pay_indicator,
{_yn('w.replacement_worker')} AS replacement_worker,
{_yn('w.corporate_officer_indicator')} AS corporate_officer_indicator,
{_yn('w.w2_special_handle_indicator', 'P', 'M')} AS pull_indicator,
{_yn('w.medical_coverage_indicator', '3', '1')} AS medical_coverage_indicator,
{_yn('w.suppress_w2_print_indicator', 'P', 'N')} AS print_suppress_flag,
{_yn("w.worker_type = 'Contractor'")} AS independent_contractor,
{_yn("w.worker_type = 'Seasonal'")} AS seasonal_employee,
{_yn("w.worker_type = 'Seasonal'")} AS seasonal_employee_local,
{_yn('w.work_from_home_flag')} AS wfh_indicator,
{_yn('w.post_w2_indicator')} AS ee_post_indicator,
{_yn('w.statutory_flag')} AS statutory_flag,
CASE WHEN w.remuneration_basis = 'Hourly' THEN 'H' WHEN w.remuneration_basis = 'Salaried' THEN 'S' END AS remuneration_basis,
{_yn('w.ownership_percent > 50')} AS family_status"""

ADDRESS_COLUMNS = ", ".join(
    f"max(CASE WHEN type = '{kind}' THEN {'upper(' + c + ')' if c in ('line_one', 'city_name') else c} END) AS {kind.lower()}_{c}"
    for kind in ("Work", "Home")
    for c in ("line_one", "city_name", "state_code", "postal_code")
)
cte("addr", "fx_address", f"SELECT worker_sk, {ADDRESS_COLUMNS} FROM fx_address WHERE type IN ('Work', 'Home') GROUP BY worker_sk")
cte(
    "profiled",
    "fx_worker addr",
    f"SELECT w.worker_sk, w.branch_code, w.company_code, {PROFILE_COLUMNS}, {FLAG_COLUMNS}, addr.* EXCLUDE (worker_sk) "
    "FROM fx_worker w LEFT JOIN addr USING (worker_sk)",
)


def _field_sql(row) -> str:
    _, source, code, kind, width, decimals, _, pattern, _ = row
    if kind == "date":
        return f"'{code}' || strftime({source}, '{'%Y%m%d' if pattern == 'yyyyMMdd' else '%m%d%Y'}')"
    if kind == "decimal":
        return f"'{code}' || lpad(CAST(CAST(trunc({source} * {10**decimals}) AS BIGINT) AS VARCHAR), {width}, '0')"
    v = f"trim(CAST({source} AS VARCHAR))"
    if code == "DD":
        d = f"regexp_replace({v}, '[^0-9]', '', 'g')"
        return f"'{code}' || CASE WHEN length({d}) = 9 THEN {d}[1:3] || '-' || {d}[4:5] || '-' || {d}[6:9] ELSE {v} END"
    if code in ("CS", "CU"):
        mark, head = ("A1", 12) if code == "CS" else ("A2", 14)
        long = f"{v}[1:{head}] || '{mark}' || rpad({v}[{head + 1}:20], {20 - head}, ' ')"
        return f"'{code}' || CASE WHEN length({v}) <= {width} THEN rpad({v}, {width}, ' ') ELSE {long} END"
    return f"'{code}' || rpad({v}, {width}, ' ')"


cte(
    "wfields",
    "profiled",
    " UNION ALL ".join(
        f"SELECT worker_sk, branch_code, company_code, {r[0]} AS ord, '{r[8]}' AS level, '{r[2]}' AS code, {_field_sql(r)} AS text FROM profiled"
        for r in SPECS.fields
    ),
)
cte("workers_f", "wfields", "SELECT * FROM wfields WHERE text IS NOT NULL")

RUN = "worker_sk, organization_unit_sk, state_code, local_code, tax_type, is_employer_tax, year, quarter"
cte("newest", "fx_snapshot", f"SELECT {RUN}, max(payroll_run_sk) AS top_run FROM fx_snapshot GROUP BY {RUN}")
cte(
    "latest",
    "newest fx_snapshot",
    """SELECT s.* FROM fx_snapshot s JOIN newest n ON s.worker_sk = n.worker_sk AND s.payroll_run_sk = n.top_run
       AND s.organization_unit_sk = n.organization_unit_sk AND coalesce(s.state_code, '') = coalesce(n.state_code, '')
       AND coalesce(s.local_code, '') = coalesce(n.local_code, '') AND s.tax_type = n.tax_type
       AND s.is_employer_tax = n.is_employer_tax AND s.year = n.year AND s.quarter = n.quarter""",
)
ZERO = (
    "qtd_amount qtd_taxable_amount qtd_subject_amount qtd_gross_wages qtd_overtime_amount ytd_amount "
    "ytd_taxable_amount ytd_subject_amount ytd_gross_wages ytd_overtime_amount"
).split()
_zero = ", ".join(f"coalesce({c}, 0)::DECIMAL(18,2) AS {c}" for c in ZERO)
_oos = ", ".join(
    f"coalesce(TRY_CAST(json_extract_string(out_of_state, '$.{k}') AS DECIMAL(18,2)), 0)::DECIMAL(18,2) AS {c}"
    for c, k in fixed.OUT_OF_STATE_KEYS.items()
)
cte(
    "amounts",
    "latest",
    f"""SELECT worker_sk, organization_unit_sk, branch_code, company_code, payroll_run_sk, year, quarter, state_code, local_code,
        tax_type, is_employer_tax, tax_rate, hours_worked, lived_in_code, {_zero}, {_oos},
        CASE WHEN coalesce(qtd_amount, 0) <> 0 THEN 1 END AS qtd_amount_count,
        CASE WHEN coalesce(ytd_amount, 0) <> 0 THEN 1 END AS ytd_amount_count,
        CASE WHEN state_code IS NULL THEN 'F' WHEN local_code IS NULL THEN state_code ELSE state_code || right(local_code, 4) END AS jurisdiction
        FROM latest""",
)
cte(
    "trows",
    "amounts fx_profile",
    """SELECT a.*, CASE p.filing_status WHEN 'MarriedFilingJointly' THEN 'M' WHEN 'HeadOfHousehold' THEN 'H' ELSE 'S' END AS filing_status,
       p.number_of_allowances, p.sui_exempt_flag, p.sdi_exempt_flag
       FROM amounts a LEFT JOIN fx_profile p ON p.worker_sk = a.worker_sk AND coalesce(p.state_code, '') = coalesce(a.state_code, '')
       AND coalesce(p.local_code, '') = coalesce(a.local_code, '') AND p.branch_code = a.branch_code AND p.company_code = a.company_code""",
)


def _canon(source: str) -> str:
    whens = " ".join(f"WHEN tax_type = '{b}' THEN CASE WHEN is_employer_tax THEN '{r}' ELSE '{e}' END" for b, e, r in SPECS.pairs)
    return f"SELECT row_number() OVER () AS rid, * REPLACE (CASE {whens} ELSE tax_type END AS tax_type) FROM {source}"


cte("canon", "trows", _canon("trows"))
cte("qrows", "fx_snapshot", _canon("fx_snapshot"))
CTES["cells"] = ((), values("cells", "measure, tax_type, code, width, decimals, signed, mandatory", SPECS.tax))
_slots = [(i, *s) for i, s in enumerate(fixed.table(fixed.TAX_SLOTS))]
_entries = ", ".join(
    f"{{'ord': {i}, 'measure': '{m}', 'kind': '{k}', 'dec': {d}, 'dflt': {w}, "
    f"'num': {f'CAST({m} AS DECIMAL(22,4))' if k in ('amount', 'count') else 'NULL::DECIMAL(22,4)'}, "
    f"'txt': {m if k in ('text', 'place') else 'NULL'}}}"
    for i, m, k, w, d in _slots
)
_digits = "CAST(CAST(trunc(abs(u.num) * power(10, u.dec)::BIGINT) AS BIGINT) AS VARCHAR)"
_width = "CAST(coalesce(c.width, u.dflt) - 1 AS INTEGER)"
cte(
    "unpivoted",
    "canon",
    f"SELECT rid, branch_code, company_code, worker_sk, year, quarter, jurisdiction, tax_type, is_employer_tax, payroll_run_sk, unnest([{_entries}]) AS u FROM canon",
)
cte(
    "tcoded",
    "unpivoted cells",
    f"""SELECT x.* EXCLUDE (u), CAST(u.ord AS INTEGER) AS ord, u.measure AS measure, CASE WHEN u.kind = 'place' THEN 'X1' ELSE coalesce(c.code, '') END AS code,
        CASE u.kind
          WHEN 'place' THEN CASE WHEN trim(u.txt) <> '' THEN 'X1' || lpad(trim(u.txt), 6, '0') END
          WHEN 'text' THEN c.code || rpad(trim(u.txt), 1, ' ')
          WHEN 'count' THEN c.code || lpad(CAST(CAST(trunc(u.num) AS BIGINT) AS VARCHAR), 2, '0')
          ELSE CASE WHEN u.num <> 0 OR c.mandatory THEN c.code || CASE WHEN u.num >= 0 THEN '+' ELSE '-' END || lpad({_digits}, {_width}, '0') END END AS text,
        coalesce(u.kind = 'amount' AND length({_digits}) > {_width}, false) AS overflow
        FROM unpivoted x LEFT JOIN cells c ON c.measure = u.measure AND c.tax_type = x.tax_type""",
)
cte("tfields", "tcoded", "SELECT * FROM tcoded WHERE text IS NOT NULL")
TROW = "worker_sk, year, quarter, jurisdiction, tax_type, is_employer_tax, payroll_run_sk"
cte(
    "rowtext",
    "canon tfields",
    f"""SELECT c.rid, c.branch_code, c.company_code, {', '.join('c.' + k for k in TROW.split(', '))},
        coalesce(string_agg(t.text, '' ORDER BY t.ord), '') AS row_text, list(t.text ORDER BY t.ord) FILTER (t.text IS NOT NULL) AS fields
        FROM canon c LEFT JOIN tfields t ON t.rid = c.rid GROUP BY ALL""",
)
cte("wperiods", "fx_snapshot fx_worker", """SELECT DISTINCT w.worker_sk, w.branch_code, w.company_code, s.year, s.quarter
    FROM fx_snapshot s JOIN fx_worker w ON w.worker_sk = s.worker_sk""")
MANDATORY = [(code, *mt) for code, mt in SPECS.mandatory().items()]
CTES["mand"] = ((), values("mand", "code, measure, tax_type", MANDATORY))
cte(
    "absent",
    "wperiods mand canon",
    """SELECT p.*, m.code, m.tax_type FROM wperiods p CROSS JOIN mand m
       WHERE NOT EXISTS (SELECT 1 FROM canon c WHERE c.worker_sk = p.worker_sk AND c.year = p.year AND c.quarter = p.quarter
       AND c.tax_type = m.tax_type AND (m.measure = 'qtd_amount' OR c.ytd_amount IS NOT NULL))""",
)
cte("queued", "fx_queue", "SELECT * FROM fx_queue WHERE status = 'QUEUED' AND file_type = 'QUARTER'")
cte("speriods", "queued", "SELECT DISTINCT site_id, year, quarter FROM queued")
cte("site_workers", "fx_worker fx_org", """SELECT DISTINCT w.worker_sk, w.branch_code, w.company_code, o.site_id
    FROM fx_worker w JOIN fx_org o ON o.branch_code = w.branch_code AND o.company_code = w.company_code""")
cte("qperiods", "wperiods site_workers speriods", """SELECT p.worker_sk, p.branch_code, p.company_code, p.year, p.quarter, s.site_id
    FROM wperiods p JOIN site_workers s USING (worker_sk) JOIN speriods q ON q.site_id = s.site_id AND q.year = p.year AND q.quarter = p.quarter""")


def fold(fields: str, prefix: str) -> str:
    """Greedy packing by folding the fields into text with line feeds."""
    last = "string_split(a, chr(10))[-1]"
    return (
        f"string_split(list_reduce(list_prepend({prefix}, {fields}), lambda a, x: CASE WHEN length({last}) > 12 "
        f"AND length({last}) + length(x) > 160 THEN a || chr(10) || {prefix} || x ELSE a || x END), chr(10))"
    )


# Line sets; ``kept_*`` are replaced by filtered versions when skips apply.
def line_ctes(tag: str, periods: str, fields: str, level: str, rows: str, absent: str) -> None:
    """CTEs for employee lines, tax lines and the numbered file over given inputs."""
    cte(f"own{tag}", f"{periods} {fields}", f"""SELECT p.worker_sk, p.year, p.quarter, p.site_id, p.branch_code, p.company_code,
        list(f.text ORDER BY f.ord) FILTER (f.text IS NOT NULL) AS fields FROM {periods} p
        LEFT JOIN {fields} f ON f.worker_sk = p.worker_sk AND f.level = 'EE' GROUP BY ALL""")
    cte(f"own_lines{tag}", f"own{tag}", f"""SELECT worker_sk, year, quarter, site_id, branch_code, company_code,
        CASE WHEN len(fields) > 0 THEN {fold('fields', "'******      '")} ELSE ['******      '] END AS lines FROM own{tag}""")
    defaults = " UNION ALL ".join(
        f"SELECT 0, 'F', '{t}', false, 0, '{''.join(fs)}', {i}, '{f}', '{t}'"
        for t, fs in default_row_fields(SPECS).items()
        for i, f in enumerate(fs)
    )
    cte(f"defaults{tag}", absent, f"""SELECT DISTINCT a.worker_sk, a.year, a.quarter, d.* FROM {absent} a
        JOIN ({defaults}) d(juris_ord, jurisdiction, tax_type, is_employer_tax, payroll_run_sk, row_text, ord, text, dt) ON d.dt = a.tax_type""")
    cte(f"jrows{tag}", f"{rows} defaults{tag}", f"""SELECT DISTINCT worker_sk, year, quarter, jurisdiction FROM {rows}
        UNION SELECT worker_sk, year, quarter, jurisdiction FROM defaults{tag}""")
    cte(f"level_items{tag}", f"jrows{tag} {level}", f"""SELECT j.worker_sk, j.year, j.quarter, j.jurisdiction, f.ord, f.text FROM jrows{tag} j
        JOIN {level} f ON f.worker_sk = j.worker_sk AND f.level = CASE WHEN j.jurisdiction = 'F' THEN 'F' WHEN length(trim(j.jurisdiction)) <= 2 THEN 'S' ELSE 'L' END
        AND (f.only_jurisdiction IS NULL OR f.only_jurisdiction = j.jurisdiction)""")
    cte(f"items{tag}", f"level_items{tag} {rows} defaults{tag}", f"""
        SELECT worker_sk, year, quarter, jurisdiction, '' AS tax_type, false AS emp, -1 AS run, '' AS row_text, 0 AS rid, ord, text FROM level_items{tag}
        UNION ALL SELECT worker_sk, year, quarter, jurisdiction, tax_type, is_employer_tax, payroll_run_sk, row_text, rid, i, fields[i]
          FROM (SELECT *, unnest(range(1, len(fields) + 1)) AS i FROM {rows})
        UNION ALL SELECT worker_sk, year, quarter, jurisdiction, tax_type, is_employer_tax, payroll_run_sk, row_text, -1, ord, text FROM defaults{tag}""")
    cte(f"jlines{tag}", f"items{tag}", f"""SELECT worker_sk, year, quarter, jurisdiction, {fold("fields", "('******' || rpad(jurisdiction, 6, ' '))")} AS lines
        FROM (SELECT worker_sk, year, quarter, jurisdiction, list(text ORDER BY tax_type, emp, run, row_text, rid, ord) AS fields
              FROM items{tag} WHERE text <> '' GROUP BY ALL)""")
    cte(f"tax_lines{tag}", f"jlines{tag}", f"""SELECT worker_sk, year, quarter,
        flatten(list(lines ORDER BY CASE WHEN jurisdiction = 'F' THEN 0 ELSE 1 END, jurisdiction)) AS lines FROM jlines{tag} GROUP BY ALL""")
    cte(f"body{tag}", f"own_lines{tag} tax_lines{tag}", f"""
        SELECT site_id, year, quarter, branch_code, company_code, worker_sk, 0 AS kind, unnest(range(len(lines))) AS pos, unnest(lines) AS value FROM own_lines{tag}
        UNION ALL SELECT o.site_id, o.year, o.quarter, o.branch_code, o.company_code, o.worker_sk, 1, unnest(range(len(t.lines))), unnest(t.lines)
          FROM own_lines{tag} o JOIN tax_lines{tag} t ON t.worker_sk = o.worker_sk AND t.year = o.year AND t.quarter = o.quarter""")
    cte(f"file{tag}", f"body{tag}", f"""
        SELECT site_id, year, quarter, 1 + row_number() OVER (PARTITION BY site_id, year, quarter ORDER BY branch_code, company_code, worker_sk, kind, pos) AS line_no, value
        FROM (SELECT * FROM body{tag} UNION ALL SELECT DISTINCT site_id, year, quarter, branch_code, company_code, -1, 0, 0,
              '      ' || branch_code || company_code || '{fixed.COMPANY_SUFFIX}' FROM body{tag})""")
    stamp = f"TIMESTAMP '{RUN_TIME}'"
    cte(f"whole{tag}", f"file{tag}", f"""
        SELECT * FROM file{tag}
        UNION ALL SELECT site_id, year, quarter, 1, repeat(' ', 12) || strftime({stamp}, '%y%m%d%H%M%S') || 'QTRFILINGS' || right(CAST(year AS VARCHAR), 2) || CAST(quarter AS VARCHAR)
          || repeat(' ', 11) || 'Q' || repeat(' ', 111) FROM (SELECT DISTINCT site_id, year, quarter FROM file{tag})
        UNION ALL SELECT site_id, year, quarter, max(line_no) + 1, '999999999999' || lpad(CAST(max(line_no) + 1 AS VARCHAR), 7, '0') FROM file{tag} GROUP BY ALL""")


cte("workers_l", "workers_f", "SELECT *, NULL::VARCHAR AS only_jurisdiction FROM workers_f")
line_ctes("", "qperiods", "workers_l", "workers_l", "rowtext", "absent")

# --- decisions ----------------------------------------------------------------------

CTES["catalog"] = ((), values("catalog", "error_code, legacy, error_type, category, impacts_deposit, impacts_filing", errors.catalog_rows()))
for _source in ("CODE", "CATEGORY", "TYPE"):
    CTES[f"map_{_source.lower()}"] = (
        (), values(f"map_{_source.lower()}", "k, result", [(k, c) for s, k, c in errors.DEFAULT_MAPPINGS if s == _source])
    )


def norm(value: str) -> str:
    key = f"trim(regexp_replace(replace(upper(trim({value})), '&', ' AND '), '[^A-Z0-9]+', '_', 'g'), '_')"
    return f"coalesce(nullif({key}, ''), 'UNKNOWN')"


cte("active", "fx_error catalog", """SELECT e.company_error_sk, e.organization_unit_sk, e.error_code, e.state_code, e.local_code, e.tax_type, e.worker_sk,
    c.error_type, c.category, c.impacts_deposit, c.impacts_filing, c.error_code IS NOT NULL AS in_catalog
    FROM fx_error e LEFT JOIN catalog c ON c.error_code = e.error_code WHERE e.resolution_status = 'Open' AND e.write_status = 'PENDING'""")
cte("resolved", "active map_code map_category map_type", f"""SELECT a.*,
    coalesce(mc.result, mg.result, mt.result, CASE WHEN NOT in_catalog THEN 'UNKNOWN' WHEN impacts_deposit OR impacts_filing THEN 'IMPACT_ERROR' ELSE 'NO_IMPACT_ERROR' END) AS resolved_category,
    CASE WHEN mc.result IS NOT NULL THEN 'RULE' WHEN mg.result IS NOT NULL THEN 'CATEGORY' WHEN mt.result IS NOT NULL THEN 'TYPE' WHEN in_catalog THEN 'IMPACT' ELSE 'NONE' END AS resolved_by
    FROM active a LEFT JOIN map_code mc ON mc.k = a.error_code LEFT JOIN map_category mg ON mg.k = {norm('a.category')} LEFT JOIN map_type mt ON mt.k = a.error_type""")


def decision_ctes(tag: str, scope: dict | None = None) -> None:
    rules = [(i, c, (scope or {}).get(c, s), ",".join(codes), b, e) for i, c, s, codes, b, e in errors.DEFAULT_RULES]
    CTES[f"rules{tag}"] = ((), values(f"rules{tag}", "rule_id, cat, scope, codes, active_from, active_to", rules))
    ranks = " ".join(f"WHEN '{s}' THEN {i}" for i, s in enumerate(fixed.SKIP_SCOPES, 1))
    cte(f"decisions{tag}", f"resolved rules{tag} fx_org", f"""SELECT m.company_error_sk, m.error_code, m.resolved_category, CAST(r.rule_id AS INTEGER) AS rule_id,
        coalesce(r.scope, 'NO_SKIP') AS scope, r.rule_id IS NULL AS unmapped, CAST(CASE coalesce(r.scope, 'NO_SKIP') {ranks} END AS INTEGER) AS scope_rank,
        o.branch_code, o.company_code, m.worker_sk,
        CASE WHEN r.scope = 'SKIP_TAX_JURISDICTION' OR m.state_code IS NOT NULL THEN
          CASE WHEN m.state_code IS NULL THEN 'F' WHEN m.local_code IS NULL THEN m.state_code ELSE m.state_code || right(m.local_code, 4) END END AS jurisdiction,
        m.tax_type, coalesce(r.codes, '') AS codes
        FROM (SELECT * REPLACE (CASE WHEN in_catalog AND NOT impacts_deposit AND NOT impacts_filing AND resolved_by <> 'RULE' THEN 'NO_IMPACT_ERROR' ELSE resolved_category END AS resolved_category) FROM resolved) m
        LEFT JOIN (SELECT * FROM rules{tag} WHERE coalesce(CAST(active_from AS DATE), DATE '1000-01-01') <= DATE '{AS_OF}' AND coalesce(CAST(active_to AS DATE), DATE '9999-01-01') >= DATE '{AS_OF}') r
          ON r.cat = m.resolved_category
        LEFT JOIN fx_org o ON o.organization_unit_sk = m.organization_unit_sk""")
    groups = [(c, "SKIP_REPORTING_CODES") for c in REPORTING] + [(c, "SKIP_NON_REPORTING_CODES") for c in NON_REPORTING]
    CTES["groups"] = ((), values("groups", "code, scope", groups))
    cte(f"targets{tag}", f"decisions{tag} groups", f"""
        SELECT d.company_error_sk, d.rule_id, d.scope, d.branch_code, d.company_code, d.worker_sk, d.jurisdiction, unnest(string_split(d.codes, ',')) AS code FROM decisions{tag} d WHERE d.scope = 'SKIP_CODE'
        UNION ALL SELECT d.company_error_sk, d.rule_id, d.scope, d.branch_code, d.company_code, d.worker_sk, d.jurisdiction, g.code FROM decisions{tag} d JOIN groups g ON g.scope = d.scope""")


decision_ctes("")
decision_ctes("_g", {"WAGE_PLAN_ERROR": "SKIP_NON_REPORTING_CODES", "COMPANY_TAX_ID_ERROR": "SKIP_REPORTING_CODES"})
decision_ctes("_wt", {"EMPLOYEE_PROFILE_ERROR": "SKIP_ALL_TAX_FOR_EMPLOYEE"})
decision_ctes("_co", {"COMPANY_TAX_ID_ERROR": "SKIP_COMPANY_OUTPUT"})

SAME_ENTITY = "CASE WHEN d.worker_sk IS NULL THEN d.branch_code = t.branch_code AND d.company_code = t.company_code ELSE d.worker_sk = t.worker_sk END"
JURIS_HIT = f"d.scope = 'SKIP_TAX_JURISDICTION' AND {SAME_ENTITY} AND d.jurisdiction = t.jurisdiction AND coalesce(d.tax_type = t.tax_type, true)"


# The same over deduplicated keys, so that the correlated part stays small.
CTES["twins"] = ((), values("twins", "base, tax_type", [(b, t) for b, e, r in SPECS.pairs for t in (e, r)]))
cte("jkeys", "decisions twins", """SELECT DISTINCT d.branch_code, d.company_code, d.worker_sk, d.jurisdiction, coalesce(w.tax_type, d.tax_type) AS tax_type, d.scope
    FROM decisions d LEFT JOIN twins w ON w.base = d.tax_type WHERE d.scope = 'SKIP_TAX_JURISDICTION'""")
for _t in ("", "_g"):
    cte(f"ckeys{_t}", f"targets{_t}", f"SELECT DISTINCT CASE WHEN worker_sk IS NULL THEN branch_code END AS branch_code, CASE WHEN worker_sk IS NULL THEN company_code END AS company_code, worker_sk, jurisdiction, code FROM targets{_t}")
    cte(f"hit_fields{_t}", f"tfields ckeys{_t}", f"""SELECT DISTINCT t.rid, t.ord FROM tfields t JOIN ckeys{_t} d ON d.code = t.code
        WHERE {SAME_ENTITY} AND coalesce(d.jurisdiction = t.jurisdiction, true)""")
cte("hit_rows", "canon jkeys", f"SELECT DISTINCT t.rid FROM canon t JOIN jkeys d ON d.jurisdiction = t.jurisdiction WHERE {JURIS_HIT}")

# Inputs of the file with skips.
cte("qperiods_s", "qperiods decisions", """SELECT * FROM qperiods p WHERE
    NOT EXISTS (SELECT 1 FROM decisions d WHERE d.scope = 'SKIP_ENTIRE_EMPLOYEE' AND d.worker_sk = p.worker_sk)
    AND NOT EXISTS (SELECT 1 FROM decisions d WHERE d.scope = 'SKIP_COMPANY_OUTPUT' AND d.branch_code = p.branch_code AND d.company_code = p.company_code)""")
cte("no_tax", "site_workers decisions", """SELECT DISTINCT w.worker_sk FROM site_workers w JOIN decisions d
    ON (d.scope = 'SKIP_COMPANY_TAX_OUTPUT' AND d.branch_code = w.branch_code AND d.company_code = w.company_code)
    OR (d.scope = 'SKIP_ALL_TAX_FOR_EMPLOYEE' AND d.worker_sk = w.worker_sk)""")
cte("fields_s", "workers_f ckeys", f"""SELECT t.*, NULL::VARCHAR AS only_jurisdiction FROM workers_f t
    WHERE t.level <> 'EE' OR NOT EXISTS (SELECT 1 FROM ckeys d WHERE d.code = t.code AND d.jurisdiction IS NULL AND {SAME_ENTITY})""")
cte("level_s", "fields_s ckeys", f"""SELECT t.* FROM fields_s t
    WHERE NOT EXISTS (SELECT 1 FROM ckeys d WHERE d.code = t.code AND d.jurisdiction IS NULL AND {SAME_ENTITY})""")
cte("rows_s", "rowtext hit_rows hit_fields no_tax", """SELECT r.* REPLACE (list_filter(r.fields, lambda x: NOT list_contains(coalesce(h.codes, []), left(x, 2))) AS fields)
    FROM rowtext r LEFT JOIN (SELECT f.rid, list(DISTINCT f.code) AS codes FROM (SELECT t.rid, t.code FROM tfields t JOIN hit_fields k ON k.rid = t.rid AND k.ord = t.ord) f GROUP BY f.rid) h ON h.rid = r.rid
    WHERE r.rid NOT IN (SELECT rid FROM hit_rows) AND r.worker_sk NOT IN (SELECT worker_sk FROM no_tax)""")
CTES["rows_s"] = ((*CTES["rows_s"][0], "tfields"), CTES["rows_s"][1])
cte("absent_s", "wperiods mand canon hit_rows no_tax jkeys", """SELECT t.*, m.code, m.tax_type FROM wperiods t CROSS JOIN mand m
    WHERE t.worker_sk NOT IN (SELECT worker_sk FROM no_tax)
    AND NOT EXISTS (SELECT 1 FROM canon c WHERE c.worker_sk = t.worker_sk AND c.year = t.year AND c.quarter = t.quarter AND c.tax_type = m.tax_type AND c.rid NOT IN (SELECT rid FROM hit_rows))
    AND NOT EXISTS (SELECT 1 FROM jkeys d WHERE d.jurisdiction = 'F' AND coalesce(d.tax_type = m.tax_type, true) AND d.worker_sk IS NULL AND d.branch_code = t.branch_code AND d.company_code = t.company_code)
    AND NOT EXISTS (SELECT 1 FROM jkeys d WHERE d.jurisdiction = 'F' AND coalesce(d.tax_type = m.tax_type, true) AND d.worker_sk = t.worker_sk)""")
line_ctes("_s", "qperiods_s", "fields_s", "level_s", "rows_s", "absent_s")

# The same with a rule table: sides, groups, dates of the errors.
_grouped = [
    (*r[:2], r[2] or "BOTH", "SKIP_CODE" if r[6] else r[3], r[4], ",".join(sorted({*r[5], *(c for g, c in GROUP_CODES if g == r[6])})), *r[7:]) for r in RULE_ROWS
]
CTES["rule_table"] = ((), values("rule_table", "rule_id, cat, side, scope, target, codes, needs_place, active, since, until", _grouped))
_ranks_r = " ".join(f"WHEN '{s}' THEN {i}" for i, s in enumerate(fixed.SKIP_SCOPES, 1))
cte("decisions_r", "resolved rule_table fx_org fx_error", f"""SELECT m.company_error_sk, m.error_code, m.resolved_category, CAST(r.rule_id AS INTEGER) AS rule_id,
    coalesce(r.scope, 'NO_SKIP') AS scope, r.rule_id IS NULL AS unmapped, CAST(CASE coalesce(r.scope, 'NO_SKIP') {_ranks_r} END AS INTEGER) AS scope_rank,
    o.branch_code, o.company_code, m.worker_sk,
    CASE WHEN r.scope = 'SKIP_TAX_JURISDICTION' OR m.state_code IS NOT NULL THEN
      CASE WHEN m.state_code IS NULL THEN 'F' WHEN m.local_code IS NULL THEN m.state_code ELSE m.state_code || right(m.local_code, 4) END END AS jurisdiction,
    m.tax_type, coalesce(r.codes, '') AS codes, coalesce(r.side, 'BOTH') AS side, r.target
    FROM (SELECT * REPLACE (CASE WHEN in_catalog AND NOT impacts_deposit AND NOT impacts_filing AND resolved_by <> 'RULE' THEN 'NO_IMPACT_ERROR' ELSE resolved_category END AS resolved_category) FROM resolved) m
    JOIN fx_error e ON e.company_error_sk = m.company_error_sk
    LEFT JOIN rule_table r ON r.cat = m.resolved_category AND r.active IS DISTINCT FROM false AND (r.needs_place IS DISTINCT FROM true OR m.state_code IS NOT NULL)
      AND (r.since IS NULL OR CAST(r.since AS DATE) <= CAST(e.created_date_time AS DATE)) AND (r.until IS NULL OR CAST(r.until AS DATE) >= CAST(e.created_date_time AS DATE))
    LEFT JOIN fx_org o ON o.organization_unit_sk = m.organization_unit_sk""")
for _side, _other in (("t", "WORKER"), ("w", "TAX")):
    cte(f"ckeys_{_side}", "decisions_r", f"""SELECT DISTINCT CASE WHEN worker_sk IS NULL THEN branch_code END AS branch_code, CASE WHEN worker_sk IS NULL THEN company_code END AS company_code,
        worker_sk, jurisdiction, unnest(string_split(codes, ',')) AS code FROM decisions_r WHERE scope = 'SKIP_CODE' AND side <> '{_other}'""")
_again = {"decisions": "decisions_r", "jkeys": "jkeys_r", "hit_rows": "hit_rows_r", "hit_fields": "hit_fields_r", "no_tax": "no_tax_r", "qperiods_s": "qperiods_r",
          "fields_s": "fields_r", "level_s": "level_r", "rows_s": "rows_r", "absent_s": "absent_r"}
for _name in list(_again)[1:]:
    _swap = _again | {"ckeys": "ckeys_t" if _name == "hit_fields" else "ckeys_w"}
    _needs, _text = CTES[_name]
    CTES[_again[_name]] = (tuple(_swap.get(n, n) for n in _needs), re.sub(r"\b(" + "|".join(_swap) + r")\b", lambda m: _swap[m.group()], _text))
line_ctes("_r", "qperiods_r", "fields_r", "level_r", "rows_r", "absent_r")
CTES["all_defaults_r"] = (CTES["defaults_r"][0], CTES["defaults_r"][1].replace("defaults_r AS", "all_defaults_r AS", 1))
cte("defaults_r", "all_defaults_r fx_worker ckeys_t", f"""SELECT a.* FROM all_defaults_r a JOIN fx_worker t ON t.worker_sk = a.worker_sk
    WHERE NOT EXISTS (SELECT 1 FROM ckeys_t d WHERE d.code = left(a.text, 2) AND {SAME_ENTITY} AND coalesce(d.jurisdiction = a.jurisdiction, true))""")

# --- queries -----------------------------------------------------------------------------

ORACLES: dict[str, str] = {}


def oracle(name: str, needs: str, select: str) -> None:
    ORACLES[name] = build(needs, select)


oracle("scan_worker", "fx_worker", "SELECT worker_sk, branch_code, company_code, family_name, given_name, ssn, hire_date FROM fx_worker")
_counted = ("fx_worker", "fx_address", "fx_snapshot", "fx_profile", "fx_queue", "fx_error")
oracle("table_count", " ".join(_counted), " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in _counted))
oracle("queued_work", "queued", "SELECT batch_id, site_id, year, quarter, window_start, window_end FROM queued")
oracle("site_companies", "fx_org queued", "SELECT DISTINCT site_id, branch_code, company_code FROM fx_org WHERE site_id IN (SELECT site_id FROM queued)")
oracle("org_lookup", "fx_org", "SELECT branch_code, company_code FROM fx_org WHERE company_code = 'C007' ORDER BY branch_code LIMIT 1")
_known = ", ".join(f"'{s}'" for s in fixed.FILE_STATUSES)
oracle("status_normalize", "fx_queue", f"""SELECT batch_id, CASE WHEN upper(raw_status) IN ({_known}) THEN upper(raw_status) END AS status,
    coalesce(upper(raw_status) IN ({_known}), false) AS is_valid FROM fx_queue""")
_name = f"'QTR_' || site_id || '_Q' || CAST(quarter AS VARCHAR) || '_' || CAST(year AS VARCHAR) || '_' || strftime(TIMESTAMP '{RUN_TIME}', '%Y%m%d_%H%M%S') || '.txt'"
oracle("output_names", "speriods", f"SELECT site_id, year, quarter, {_name} AS outbound_file_name, 'worker-detail/' || {_name} AS object_key FROM speriods")

# specifications
_codes = [(r[2], r[1]) for r in SPECS.fields]
CTES["sources"] = ((), values("sources", "code, source_column", _codes))
oracle("field_spec_scan", "fx_field_raw", "SELECT DISTINCT field_code, field_length, data_type, decimal_places, signed, category_1, category_2 FROM fx_field_raw")
cte("levels", "fx_level_raw sources", "SELECT DISTINCT field_code, record_code FROM fx_level_raw WHERE file_code = 'Q' AND field_code IN (SELECT code FROM sources)")
oracle("field_level_scan", "levels", "SELECT * FROM levels")
cte("compiled", "fx_field_raw levels sources", """SELECT f.field_code AS code, s.source_column,
    CASE WHEN data_type = 'N' THEN 'decimal' WHEN data_type = 'X' AND category_1 = 'DATE' THEN 'date' WHEN data_type = 'X' THEN 'text' END AS format,
    CAST(CASE WHEN data_type = 'X' AND category_1 = 'DATE' THEN 8 WHEN data_type IN ('N', 'X') THEN field_length END AS INTEGER) AS width,
    CAST(CASE WHEN data_type = 'N' THEN coalesce(decimal_places, 0) END AS INTEGER) AS decimals,
    CASE WHEN data_type = 'N' THEN signed = 'Y' END AS signed,
    CASE WHEN data_type = 'X' AND category_1 = 'DATE' THEN CASE WHEN f.field_code = 'SY' THEN 'yyyyMMdd' ELSE 'MMddyyyy' END END AS date_pattern,
    coalesce(l.level, 'EE') AS level
    FROM (SELECT *, row_number() OVER (PARTITION BY field_code ORDER BY field_length DESC NULLS LAST, data_type DESC NULLS LAST, decimal_places DESC NULLS LAST,
        signed DESC NULLS LAST, category_1 DESC NULLS LAST, category_2 DESC NULLS LAST) AS place FROM fx_field_raw) f LEFT JOIN sources s ON s.code = f.field_code
    LEFT JOIN (SELECT field_code, CASE min(record_code) WHEN 'EEF' THEN 'F' WHEN 'EES' THEN 'S' WHEN 'EEL' THEN 'L' ELSE 'EE' END AS level FROM levels GROUP BY 1) l ON l.field_code = f.field_code WHERE f.place = 1""")
oracle("compile_field_spec", "compiled", "SELECT * FROM compiled")
oracle("default_values", "compiled", "SELECT code, CASE WHEN signed THEN '+' || repeat('0', width - 1) ELSE repeat('0', width) END AS default_value FROM compiled WHERE format = 'decimal'")
cte("feed", "fx_feed_json", "SELECT seq, json_extract_string(value, '$.taxCode.code') AS tax_code, json_extract_string(value, '$.fieldCode.code') AS field_code, json_extract_string(value, '$.token.code') AS token FROM fx_feed_json")
CTES["tokens"] = ((), values("tokens", "token, measure", fixed.table(fixed.TOKENS)))
oracle("tax_spec_from_feed", "feed tokens compiled", """SELECT measure, tax_code AS tax_type, field_code AS code, width, CAST(coalesce(decimals, 2) AS INTEGER) AS decimals,
    coalesce(signed, true) AS signed, field_code IN ('7H', '5E') AS mandatory
    FROM (SELECT t.measure, f.tax_code, f.field_code, c.width, c.decimals, c.signed, row_number() OVER (PARTITION BY t.measure, f.tax_code ORDER BY f.seq DESC) AS rn
          FROM feed f JOIN tokens t ON t.token = f.token JOIN compiled c ON c.code = f.field_code AND c.format IS NOT NULL WHERE f.tax_code <> '' AND f.field_code <> '') WHERE rn = 1""")
_code_of = "json_extract_string(CASE WHEN json_valid(value) THEN value END, '$.{}.code')"
cte("feed_checked", "fx_feed_damaged", f"""SELECT *, CASE WHEN trim(coalesce(value, '')) = '' THEN 'empty' WHEN NOT json_valid(value) THEN 'malformed'
    WHEN coalesce(tax_code, '') = '' THEN 'no taxCode' WHEN coalesce(field_code, '') = '' THEN 'no fieldCode' WHEN coalesce(token, '') = '' THEN 'no token' END AS reason
    FROM (SELECT seq, value, {_code_of.format("taxCode")} AS tax_code, {_code_of.format("fieldCode")} AS field_code, {_code_of.format("token")} AS token FROM fx_feed_damaged)""")
oracle("feed_rejects", "feed_checked", "SELECT seq, value, reason FROM feed_checked WHERE reason IS NOT NULL")
oracle("feed_accepted", "feed_checked", "SELECT seq, tax_code, field_code, token FROM feed_checked WHERE reason IS NULL")
oracle("tax_pairs", "feed", """SELECT DISTINCT a.tax_code[:-3] AS base_type, a.tax_code AS employee_type, b.tax_code AS employer_type FROM feed a JOIN feed b
    ON b.tax_code = a.tax_code[:-3] || 'ER' WHERE a.tax_code LIKE '%EE'""")
CTES["field_list"] = ((), values("field_list", "ord, source_column, code, format, width, decimals, signed, date_pattern, level", SPECS.fields))
oracle("default_specs", "field_list workers_f", """SELECT CAST(l.ord AS INTEGER) AS ord, l.source_column, l.code, l.format, CAST(l.width AS INTEGER) AS width, l.level,
    coalesce(n.n, 0) AS workers FROM field_list l LEFT JOIN (SELECT ord, count(*) AS n FROM workers_f GROUP BY 1) n ON n.ord = l.ord""")

# workers
oracle("address_pivot", "addr", "SELECT * FROM addr")
_flags = [x for x in (
    "retirement_plan_indicator third_party_sick_pay_indicator replacement_worker corporate_officer_indicator pull_indicator "
    "medical_coverage_indicator print_suppress_flag independent_contractor seasonal_employee seasonal_employee_local wfh_indicator "
    "ee_post_indicator statutory_flag remuneration_basis family_status").split()]
oracle("worker_flags", "profiled", f"SELECT worker_sk, {', '.join(_flags)} FROM profiled")
oracle("worker_profile", "profiled", f"SELECT * EXCLUDE ({', '.join(_flags)}) FROM profiled")
oracle("workers_in_period", "wperiods", "SELECT * FROM wperiods")
oracle("worker_counts", "wperiods", "SELECT branch_code, company_code, year, quarter, count(*) AS worker_count FROM wperiods GROUP BY ALL")
oracle("worker_fields", "workers_f", "SELECT * REPLACE (CAST(ord AS INTEGER) AS ord) FROM workers_f")
oracle("level_fields", "workers_f", "SELECT worker_sk, level, CAST(row_number() OVER (PARTITION BY worker_sk, level ORDER BY ord) - 1 AS INTEGER) AS seq, text FROM workers_f WHERE level <> 'EE'")
oracle("fmt_text", "fx_worker", "SELECT worker_sk, 'Z3' || rpad(trim(job_title), 12, ' ') AS cut_right, 'V9' || lpad(trim(employee_id), 8, ' ') AS padded_left, 'CU' || trim(family_name) AS unbounded FROM fx_worker")
oracle("fmt_ssn", "fx_worker", f"SELECT worker_sk, {_field_sql(SPECS.fields[2])} AS text FROM fx_worker")
oracle("fmt_overflow", "fx_worker", f"SELECT worker_sk, {_field_sql(SPECS.fields[0]).replace('given_name', 'upper(given_name)')} AS given, {_field_sql(SPECS.fields[1]).replace('family_name', 'upper(family_name)')} AS family FROM fx_worker")
oracle("fmt_number", "fx_worker", "SELECT worker_sk, 'N1' || CASE WHEN worker_sk - 700 >= 0 THEN '+' ELSE '-' END || lpad(CAST(abs(worker_sk - 700) AS VARCHAR), 7, '0') AS signed_text, 'N2' || lpad(CAST(worker_sk AS VARCHAR), 6, '0') AS unsigned_text FROM fx_worker")
oracle("fmt_decimal", "fx_snapshot", """SELECT worker_sk, payroll_run_sk, qtd_amount, 'EJ' || CASE WHEN qtd_amount >= 0 THEN '+' ELSE '-' END || lpad(CAST(CAST(trunc(abs(qtd_amount) * 100) AS BIGINT) AS VARCHAR), 11, '0') AS signed_text,
    'A7' || lpad(CAST(CAST(trunc(tax_rate * 10000) AS BIGINT) AS VARCHAR), 10, '0') AS unsigned_text FROM fx_snapshot""")
oracle("fmt_date", "fx_worker", "SELECT worker_sk, 'SY' || strftime(birth_date, '%Y%m%d') AS birth, 'PF' || strftime(termination_date, '%m%d%Y') AS ended FROM fx_worker")

# taxes
oracle("tax_latest", "amounts", f"SELECT {TROW}, organization_unit_sk, {', '.join(ZERO)}, qtd_amount_count, ytd_amount_count FROM amounts")
oracle("jurisdiction", "amounts", """SELECT worker_sk, payroll_run_sk, state_code, local_code, jurisdiction, rpad(jurisdiction, 6, ' ') AS juris_key,
    CAST(CASE WHEN jurisdiction = 'F' THEN 0 ELSE 1 END AS INTEGER) AS juris_ord, CASE WHEN jurisdiction = 'F' THEN 'F' WHEN length(jurisdiction) <= 2 THEN 'S' ELSE 'L' END AS juris_class FROM amounts""")
oracle("oos_amounts", "amounts", f"SELECT {TROW}, {', '.join(fixed.OUT_OF_STATE_KEYS)} FROM amounts")
oracle("tax_profile_join", "trows", f"SELECT {TROW}, state_code, local_code, filing_status, number_of_allowances, sui_exempt_flag, sdi_exempt_flag FROM trows")
oracle("canonical_tax_type", "canon", f"SELECT {TROW} FROM canon")
oracle("tax_code_lookup", "tcoded", "SELECT tax_type, measure, code, count(*) AS row_count FROM tcoded WHERE measure <> 'lived_in_code' GROUP BY ALL")
_kind = {k: ", ".join(f"'{m}'" for _, m, kk, _, _ in _slots if kk in k) for k in (("amount",), ("text", "count"), ("place",))}
oracle("tax_amount_fields", "tfields", f"SELECT {TROW}, ord, measure, code, text, overflow FROM tfields WHERE measure IN ({_kind[('amount',)]})")
oracle("tax_text_fields", "tfields", f"SELECT {TROW}, ord, measure, code, text FROM tfields WHERE measure IN ({_kind[('text', 'count')]})")
oracle("lived_in_field", "tfields", f"SELECT {TROW}, ord, measure, code, text FROM tfields WHERE measure IN ({_kind[('place',)]})")
_bad = " OR ".join(
    f"(json_extract_string(out_of_state, '$.{k}') IS NOT NULL AND TRY_CAST(json_extract_string(out_of_state, '$.{k}') AS DECIMAL(18,2)) IS NULL)"
    for k in fixed.OUT_OF_STATE_KEYS.values()
)
oracle("value_report", "tfields fx_snapshot", f"""SELECT s.year, s.quarter, coalesce(t.n, 0) AS overflow_count, s.n AS unreadable_count
    FROM (SELECT year, quarter, count(*) FILTER ({_bad}) AS n FROM fx_snapshot GROUP BY ALL) s
    LEFT JOIN (SELECT year, quarter, count(*) FILTER (overflow) AS n FROM tfields GROUP BY ALL) t ON t.year = s.year AND t.quarter = s.quarter""")
oracle("tax_row_fields", "tfields", f"SELECT {TROW}, CAST(row_number() OVER (PARTITION BY rid ORDER BY ord) - 1 AS INTEGER) AS seq, text FROM tfields")
cte("grouped", "rowtext tfields", """SELECT t.worker_sk, t.year, t.quarter, t.jurisdiction, t.text,
    row_number() OVER (PARTITION BY t.worker_sk, t.year, t.quarter, t.jurisdiction ORDER BY t.tax_type, t.is_employer_tax, t.payroll_run_sk, r.row_text, t.rid, t.ord) - 1 AS seq
    FROM tfields t JOIN rowtext r ON r.rid = t.rid""")
oracle("tax_groups", "grouped", "SELECT worker_sk, year, quarter, rpad(jurisdiction, 6, ' ') AS juris, CAST(seq AS BIGINT) AS seq, text FROM grouped")
oracle("level_merge", "grouped rowtext workers_f", """SELECT worker_sk, year, quarter, jurisdiction, juris_class, CAST(row_number() OVER (PARTITION BY worker_sk, year, quarter, jurisdiction ORDER BY part, seq) - 1 AS BIGINT) AS seq, text
    FROM (SELECT *, CASE WHEN jurisdiction = 'F' THEN 'F' WHEN length(jurisdiction) <= 2 THEN 'S' ELSE 'L' END AS juris_class FROM (
        SELECT worker_sk, year, quarter, jurisdiction, 1 AS part, seq, text FROM grouped
        UNION ALL SELECT g.worker_sk, g.year, g.quarter, g.jurisdiction, 0, f.ord, f.text FROM (SELECT DISTINCT worker_sk, year, quarter, jurisdiction FROM rowtext) g
          JOIN workers_f f ON f.worker_sk = g.worker_sk AND f.level = CASE WHEN g.jurisdiction = 'F' THEN 'F' WHEN length(g.jurisdiction) <= 2 THEN 'S' ELSE 'L' END))""")

# mandatory fields
oracle("mandatory_missing", "absent", "SELECT worker_sk, year, quarter, code, tax_type FROM absent")
oracle("mandatory_coverage", "wperiods mand absent", """SELECT p.branch_code, p.company_code, p.year, p.quarter, m.code, m.tax_type, count(*) AS total_workers,
    count(*) - count(a.code) AS workers_with, count(a.code) AS workers_missing, count(a.code) = 0 AS passed
    FROM wperiods p CROSS JOIN mand m LEFT JOIN absent a ON a.worker_sk = p.worker_sk AND a.year = p.year AND a.quarter = p.quarter AND a.code = m.code GROUP BY 1, 2, 3, 4, 5, 6""")
oracle("mandatory_summary", "wperiods absent", """SELECT branch_code, company_code, year, quarter, count(*) AS total_workers, count(*) FILTER (missing) AS incomplete_workers,
    CASE WHEN count(*) FILTER (missing) = 0 THEN 'COMPLETE' ELSE 'INCOMPLETE' END AS status
    FROM (SELECT p.*, EXISTS (SELECT 1 FROM absent a WHERE a.worker_sk = p.worker_sk AND a.year = p.year AND a.quarter = p.quarter) AS missing FROM wperiods p) GROUP BY 1, 2, 3, 4""")
oracle("mandatory_backfill", "canon absent", """SELECT year, quarter, jurisdiction, tax_type, is_employer_tax, count(*) AS row_count, count(payroll_run_sk) AS real_rows,
    CAST(sum(qtd_amount) AS DECIMAL(28,2)) AS qtd_total, CAST(sum(ytd_amount) AS DECIMAL(28,2)) AS ytd_total
    FROM (SELECT worker_sk, year, quarter, jurisdiction, tax_type, is_employer_tax, payroll_run_sk, qtd_amount, ytd_amount FROM canon
          UNION ALL SELECT DISTINCT worker_sk, year, quarter, 'F', tax_type, false, NULL::BIGINT, 0::DECIMAL(18,2), 0::DECIMAL(18,2) FROM absent) GROUP BY ALL""")

# lines and files
oracle("employee_lines", "own_lines", "SELECT site_id, year, quarter, worker_sk, CAST(unnest(range(len(lines))) AS BIGINT) AS seq, unnest(lines) AS value FROM own_lines")
oracle("tax_lines", "own_lines tax_lines", """SELECT o.site_id, o.year, o.quarter, o.worker_sk, CAST(unnest(range(len(t.lines))) AS BIGINT) AS seq, unnest(t.lines) AS value
    FROM own_lines o JOIN tax_lines t ON t.worker_sk = o.worker_sk AND t.year = o.year AND t.quarter = o.quarter""")
_hit = "regexp_matches(substr({0}, CAST(i AS BIGINT) + 1, 2), '^([A-Z][A-Z0-9]|[0-9][A-Z])$')"
_cut = "coalesce(list_max(list_filter(range(1, {1}), lambda i: " + _hit + ")), {2})"
oracle("rewrap_lines", "workers_f", f"""SELECT worker_sk, CAST(seq AS INTEGER) AS seq, value FROM (
    WITH RECURSIVE long AS (SELECT worker_sk, '******      ' || string_agg(text, '' ORDER BY ord) AS line FROM workers_f GROUP BY 1),
    step AS (
      SELECT worker_sk, 0 AS seq, substr(line, 1, cut) AS value, substr(line, cut + 1) AS rest FROM (
        SELECT *, CASE WHEN length(line) <= 160 THEN 160 ELSE {_cut.format('line', 159, 160)} END AS cut FROM long)
      UNION ALL
      SELECT worker_sk, seq + 1, '******      ' || substr(rest, 1, cut), substr(rest, cut + 1) FROM (
        SELECT *, CASE WHEN length(rest) <= 148 THEN 148 ELSE {_cut.format('rest', 147, 148)} END AS cut FROM step WHERE rest <> ''))
    SELECT * FROM step)""")
oracle("file_header", "speriods", f"""SELECT site_id, year, quarter, repeat(' ', 12) || strftime(TIMESTAMP '{RUN_TIME}', '%y%m%d%H%M%S') || 'QTRFILINGS' || right(CAST(year AS VARCHAR), 2) || CAST(quarter AS VARCHAR)
    || repeat(' ', 11) || 'Q' || repeat(' ', 111) AS value FROM speriods""")
_head = f"'      ' || branch_code || company_code || '{fixed.COMPANY_SUFFIX}'"
oracle("company_header", "wperiods", f"SELECT DISTINCT branch_code, company_code, year, quarter, {_head} AS value FROM wperiods")
oracle("company_header_160", "wperiods", f"""SELECT DISTINCT branch_code, company_code, year, quarter,
    rpad('      ' || rpad(branch_code, 2, ' ') || rpad(company_code, 4, ' ') || '{fixed.COMPANY_SUFFIX}', 160, ' ') AS value FROM wperiods""")
oracle("site_file", "whole", "SELECT * FROM whole")
oracle("write_site_files", "whole", "SELECT * FROM whole")
oracle("output_manifest", "whole", f"SELECT site_id, year, quarter, {_name} AS outbound_file_name, count(*) AS line_count, true AS gapless FROM whole GROUP BY ALL")
cte("changes", "fx_queue fx_org whole", f"""SELECT q.batch_id, q.site_id, q.year, q.quarter, q.file_type,
    CASE WHEN q.hot THEN CASE WHEN n.n IS NOT NULL THEN 'GENERATED' ELSE 'FAILED' END ELSE q.status END AS status,
    CASE WHEN q.hot THEN n.n END AS record_count,
    CASE WHEN q.hot AND n.n IS NOT NULL THEN {_name.replace('site_id', 'q.site_id').replace('(quarter', '(q.quarter').replace('(year', '(q.year')} END AS outbound_file_name,
    CASE WHEN q.hot AND n.n IS NOT NULL THEN 'worker-detail/' || {_name.replace('site_id', 'q.site_id').replace('(quarter', '(q.quarter').replace('(year', '(q.year')} END AS object_key,
    CASE WHEN q.hot AND n.n IS NULL THEN CASE WHEN q.site_id NOT IN (SELECT site_id FROM fx_org) THEN 'No companies found for site_id: ' ELSE 'No worker data found for site: ' END || q.site_id END AS error_message
    FROM (SELECT *, status = 'QUEUED' AND file_type = 'QUARTER' AS hot FROM fx_queue) q
    LEFT JOIN (SELECT site_id, year, quarter, count(*) AS n FROM whole GROUP BY ALL) n ON n.site_id = q.site_id AND n.year = q.year AND n.quarter = q.quarter""")
oracle("status_update", "changes", "SELECT * FROM changes")
_gone = f"site_id = '{SKIPPED_SITE}' AND record_count IS NOT NULL"
oracle("status_update_with_skips", "changes", f"""SELECT * REPLACE (CASE WHEN {_gone} THEN 'SKIPPED' ELSE status END AS status, CASE WHEN NOT ({_gone}) THEN record_count END AS record_count,
    CASE WHEN NOT ({_gone}) THEN outbound_file_name END AS outbound_file_name, CASE WHEN NOT ({_gone}) THEN object_key END AS object_key) FROM changes""")

# unreadable input
_at = {"fx_address": "NULL, NULL"}
_rejects = " UNION ALL ".join(
    f"SELECT '{v.removeprefix('fx_')}' AS input, {_at.get(v, 'branch_code, company_code')}, "
    f"{repr(bad) if c == 'worker_sk' else 'CAST(worker_sk AS VARCHAR)'} AS worker_sk, '{c}' AS column_name, '{bad}' AS value, 'UNREADABLE' AS reason FROM {v} WHERE {rows}"
    for v, c, bad, rows in DAMAGE
)
cte("rejects", "fx_snapshot fx_worker fx_address", _rejects, "input, branch_code, company_code, worker_sk, column_name, value, reason")
oracle("quarantine", "rejects", "SELECT * FROM rejects")
cte("bad_companies", "rejects", "SELECT DISTINCT branch_code, company_code FROM rejects WHERE company_code IS NOT NULL")
cte("qperiods_q", "qperiods bad_companies", "SELECT q.* FROM qperiods q ANTI JOIN bad_companies b ON b.branch_code = q.branch_code AND b.company_code = q.company_code")
line_ctes("_q", "qperiods_q", "workers_l", "workers_l", "rowtext", "absent")
CTES["changes_q"] = (tuple(n.replace("whole", "whole_q") for n in CTES["changes"][0]), CTES["changes"][1].replace("changes AS", "changes_q AS", 1).replace("FROM whole ", "FROM whole_q "))
cte("lacking", "fx_org bad_companies", "SELECT o.site_id, count(*) AS n, min(o.branch_code || '/' || o.company_code) AS first FROM (SELECT DISTINCT site_id, branch_code, company_code FROM fx_org) o JOIN bad_companies b USING (branch_code, company_code) GROUP BY 1")
oracle("status_update_with_quarantine", "changes_q lacking queued", """SELECT c.* REPLACE (CASE WHEN l.n IS NOT NULL AND c.batch_id IN (SELECT batch_id FROM queued)
    THEN concat_ws('; ', c.error_message, CAST(l.n AS VARCHAR) || ' companies left out for unreadable input, first: ' || l.first) ELSE c.error_message END AS error_message)
    FROM changes_q c LEFT JOIN lacking l USING (site_id)""")
_lost = f"(hot AND (c.status = 'FAILED' OR site_id = '{LOST_SITE}'))"
_open = f"(hot AND c.status = 'GENERATED' AND site_id = '{LOST_SITE}' AND quarter = {REPEATED_QUARTER})"
_stamps = [r[1].replace("-", "").replace(":", "").replace(" ", "_") for r in RUNS]
_renamed = f"CASE WHEN site_id = '{LOST_SITE}' THEN replace({{0}}, '{_stamps[0]}', '{_stamps[1]}') ELSE {{0}} END AS {{0}}"
oracle("status_history", "changes queued fx_org", f"""SELECT batch_id, site_id, year, quarter, file_type, CASE WHEN {_open} THEN 'GENERATING' ELSE c.status END AS status, record_count,
    {_renamed.format('outbound_file_name')}, {_renamed.format('object_key')},
    CASE WHEN {_lost} THEN CASE WHEN site_id IN (SELECT site_id FROM fx_org) THEN 'No worker data found for site: ' ELSE 'No companies found for site_id: ' END || site_id END AS error_message,
    CAST(CAST(hot AS INT) + CAST({_lost} AS INT) + CAST({_open} AS INT) AS BIGINT) AS attempts, CASE WHEN hot THEN '{RUNS[0][1]}' END AS created_at,
    CASE WHEN {_open} THEN '{RUNS[2][1]}' WHEN {_lost} THEN '{RUNS[1][2]}' WHEN hot THEN '{RUNS[0][2]}' END AS updated_at
    FROM (SELECT *, batch_id IN (SELECT batch_id FROM queued) AS hot FROM changes) c""")
oracle("batch_summary", "changes", "SELECT status, count(*) AS files, CAST(sum(record_count) AS BIGINT) AS records FROM changes WHERE file_type = 'QUARTER' GROUP BY 1")

# errors
oracle("normalize_category", "fx_error", f"SELECT company_error_sk, {norm('raw_category')} AS category FROM fx_error")
CTES["classes"] = ((), values("classes", "k, area, scope, why", fixed.CATEGORY_CLASSES))
oracle("classify_errors", "fx_error classes", f"""SELECT e.company_error_sk, e.raw_category, e.n AS normalized_category, coalesce(c.area, 'UNKNOWN') AS processing_area,
    coalesce(c.scope, 'UNKNOWN') AS presentation_scope, coalesce(c.why, '{fixed.UNCLASSIFIED_RATIONALE}') AS rationale
    FROM (SELECT *, {norm('raw_category')} AS n FROM fx_error) e LEFT JOIN classes c ON c.k = e.n""")
oracle("impact_flags", "fx_error", "SELECT company_error_sk, coalesce(lower(trim(raw_flag)) IN ('true', 't', '1', 'y', 'yes'), false) AS impacts FROM fx_error")
oracle("catalog_profile", "fx_error catalog", """SELECT c.category, count(*) AS row_count, count(DISTINCT e.error_code) AS code_count, count(*) - count(DISTINCT e.error_code) AS repeat_count
    FROM fx_error e JOIN catalog c ON c.error_code = e.error_code GROUP BY 1""")
oracle("active_errors", "active", "SELECT * FROM active")
oracle("resolve_category", "resolved", "SELECT company_error_sk, error_code, resolved_category, resolved_by FROM resolved")
oracle("resolve_scopes", "decisions", "SELECT * FROM decisions")
_R = f"branch_code, company_code, {TROW}"
# Fields without row numbers, and a plain equality anti-join for each kind of target.
for _plain, _of in (("pcanon", "canon"), ("punpivoted", "unpivoted"), ("pcoded", "tcoded")):
    _needs, _text = CTES[_of]
    for _from, _to in (("row_number() OVER () AS rid, ", ""), ("SELECT rid, ", "SELECT "), ("FROM canon)", "FROM pcanon)"), ("FROM unpivoted x", "FROM punpivoted x")):
        _text = _text.replace(_from, _to)
    CTES[_plain] = (tuple({"canon": "pcanon", "unpivoted": "punpivoted"}.get(n, n) for n in _needs), _text.replace(f"{_of} AS MATERIALIZED", f"{_plain} AS NOT MATERIALIZED", 1))
_targeted = " ".join(
    f"ANTI JOIN (SELECT DISTINCT {who}, code{juris} FROM {{0}} WHERE worker_sk IS {'NOT ' if who == 'worker_sk' else ''}NULL AND jurisdiction IS {'NOT ' if juris else ''}NULL) k{i} USING ({who}, code{juris})"
    for i, (who, juris) in enumerate((w, j) for w in ("worker_sk", "branch_code, company_code") for j in (", jurisdiction", ""))
)
for _name_, _keys in (("skip_code", "targets"), ("skip_group", "targets_g")):
    oracle(_name_, f"pcoded {_keys}", f"SELECT {TROW}, code, text FROM (SELECT * FROM pcoded WHERE text IS NOT NULL) {_targeted.format(_keys)}")
oracle("skip_jurisdiction", "canon hit_rows", f"SELECT {_R} FROM canon WHERE rid NOT IN (SELECT rid FROM hit_rows)")
oracle("skip_worker_tax", "canon decisions_wt", f"SELECT {_R} FROM canon c WHERE NOT EXISTS (SELECT 1 FROM decisions_wt d WHERE d.scope IN ('SKIP_ENTIRE_EMPLOYEE', 'SKIP_ALL_TAX_FOR_EMPLOYEE') AND d.worker_sk = c.worker_sk)")
_scan = "worker_sk, branch_code, company_code, family_name, given_name, ssn, hire_date"
oracle("skip_worker", "fx_worker decisions", f"SELECT {_scan} FROM fx_worker w WHERE NOT EXISTS (SELECT 1 FROM decisions d WHERE d.scope = 'SKIP_ENTIRE_EMPLOYEE' AND d.worker_sk = w.worker_sk)")
_same_co = "d.branch_code = w.branch_code AND d.company_code = w.company_code"
oracle("skip_company_tax", "canon decisions", f"SELECT {_R} FROM canon w WHERE NOT EXISTS (SELECT 1 FROM decisions d WHERE d.scope IN ('SKIP_COMPANY_OUTPUT', 'SKIP_COMPANY_TAX_OUTPUT') AND {_same_co})")
oracle("skip_company", "fx_worker decisions_co", f"SELECT {_scan} FROM fx_worker w WHERE NOT EXISTS (SELECT 1 FROM decisions_co d WHERE d.scope = 'SKIP_COMPANY_OUTPUT' AND {_same_co})")
_tax_only = "(d.scope_rank IN (4, 5) OR d.scope_rank BETWEEN 6 AND 8 AND d.jurisdiction IS NOT NULL)"
_co = "b.branch_code = d.branch_code AND b.company_code = d.company_code"
# The broader decision of each entity, one lookup for each row of the dominance table.
_broader = {
    1: (f"b.scope_rank = 1 AND {_co}", "true"),
    2: (f"b.scope_rank = 2 AND {_co}", _tax_only),
    3: ("b.scope_rank = 3 AND b.worker_sk = d.worker_sk", "true"),
    4: ("b.scope_rank = 4 AND b.worker_sk = d.worker_sk", _tax_only),
    5: (f"b.scope_rank = 5 AND b.tax_type IS NULL AND b.jurisdiction = d.jurisdiction AND (b.worker_sk = d.worker_sk OR b.worker_sk IS NULL AND {_co})", "d.scope_rank BETWEEN 6 AND 8"),
}
_ranks = ", ".join(
    f"CASE WHEN {applies} AND EXISTS (SELECT 1 FROM wide b WHERE {hit}) THEN {rank} END" for rank, (hit, applies) in _broader.items()
)
cte("wide", "decisions", "SELECT DISTINCT scope_rank, branch_code, company_code, worker_sk, jurisdiction, tax_type FROM decisions WHERE scope_rank <= 5")
oracle("skip_merge", "decisions wide", f"""SELECT * EXCLUDE (n), n AS effective_rank, n < scope_rank AS dominated FROM (
    SELECT d.company_error_sk, d.rule_id, d.scope, d.branch_code, d.company_code, d.worker_sk, d.scope_rank,
      CAST(CASE WHEN d.scope = 'NO_SKIP' THEN d.scope_rank ELSE least(d.scope_rank, {_ranks}) END AS INTEGER) AS n FROM decisions d)""")
# What goes when a decision is applied alone, counted by kind of item.
cte("n_company", "canon", "SELECT branch_code, company_code, count(*) AS n FROM canon GROUP BY ALL")
cte("n_worker", "canon", "SELECT worker_sk, count(*) AS n FROM canon GROUP BY ALL")
cte("n_juris", "canon", "SELECT branch_code, company_code, worker_sk, jurisdiction, tax_type, count(*) AS n FROM canon GROUP BY ALL")
cte("n_people", "fx_worker", "SELECT branch_code, company_code, count(*) AS n FROM fx_worker GROUP BY ALL")
cte("n_code", "tfields workers_f", """SELECT branch_code, company_code, worker_sk, jurisdiction, code, count(*) AS n FROM tfields GROUP BY ALL
    UNION ALL SELECT branch_code, company_code, worker_sk, NULL, code, count(*) FROM workers_f GROUP BY ALL""")
_item = "CASE WHEN d.worker_sk IS NULL THEN k.branch_code = d.branch_code AND k.company_code = d.company_code ELSE k.worker_sk = d.worker_sk END"
_who = "CASE WHEN d.worker_sk IS NULL THEN 'C|' || d.branch_code || '|' || d.company_code ELSE 'W|' || CAST(d.worker_sk AS VARCHAR) END"
_dk = "d.company_error_sk, d.rule_id, d.scope, d.branch_code, d.company_code, d.worker_sk"
_same = "k.branch_code = d.branch_code AND k.company_code = d.company_code"
cte("audit", "decisions targets twins n_company n_worker n_juris n_code n_people fx_worker", f"""
    SELECT x.* EXCLUDE (tax, lines) REPLACE (target AS target), CAST(x.tax + x.lines AS BIGINT) AS removed, coalesce(c.n, 0) AS rows_before,
      CAST(coalesce(c.n, 0) - CASE WHEN x.scope = 'SKIP_CODE' THEN 0 ELSE x.tax END AS BIGINT) AS rows_after FROM (
      SELECT {_dk}, 'C|' || d.branch_code || '|' || d.company_code AS target,
        coalesce((SELECT n FROM n_company k WHERE {_same}), 0) AS tax,
        CASE WHEN d.scope_rank = 1 THEN coalesce((SELECT n FROM n_people k WHERE {_same}), 0) ELSE 0 END AS lines FROM decisions d WHERE d.scope_rank <= 2
      UNION ALL SELECT {_dk}, 'W|' || CAST(d.worker_sk AS VARCHAR), coalesce((SELECT n FROM n_worker k WHERE k.worker_sk = d.worker_sk), 0),
        CASE WHEN d.scope_rank = 3 THEN (SELECT count(*) FROM fx_worker k WHERE k.worker_sk = d.worker_sk) ELSE 0 END FROM decisions d WHERE d.scope_rank IN (3, 4)
      UNION ALL SELECT {_dk}, {_who} || '|J|' || d.jurisdiction || coalesce('|' || d.tax_type, ''),
        coalesce((SELECT sum(n) FROM n_juris k WHERE {_item} AND k.jurisdiction = d.jurisdiction
          AND coalesce(k.tax_type = d.tax_type OR (d.tax_type || ':' || k.tax_type) IN (SELECT base || ':' || tax_type FROM twins), true)), 0), 0 FROM decisions d WHERE d.scope_rank = 5
      UNION ALL SELECT {_dk}, {_who} || '|K|' || d.code || coalesce('|' || d.jurisdiction, ''),
        coalesce((SELECT sum(n) FROM n_code k WHERE {_item} AND k.code = d.code AND coalesce(k.jurisdiction = d.jurisdiction, d.jurisdiction IS NULL)), 0), 0 FROM targets d) x
    LEFT JOIN n_company c ON c.branch_code = x.branch_code AND c.company_code = x.company_code""")
oracle("skip_audit", "audit", "SELECT * FROM audit")
oracle("error_write_status", "fx_error audit", """SELECT e.company_error_sk, e.error_code, e.write_status AS old_status,
    CASE WHEN NOT (e.resolution_status = 'Open' AND e.write_status = 'PENDING') THEN e.write_status WHEN coalesce(a.removed, 0) > 0 THEN 'SKIPPED' ELSE 'WRITTEN' END AS write_status
    FROM fx_error e LEFT JOIN (SELECT company_error_sk, sum(removed) AS removed FROM audit GROUP BY 1) a ON a.company_error_sk = e.company_error_sk""")
# Each narrow effect packs the lines of its workers again, under worker numbers of its own.
_VID = 1_000_000_000
_narrow = "branch_code, company_code, worker_sk, scope, jurisdiction, tax_type, codes"
cte("narrow", "decisions", f"""SELECT company_error_sk, rule_id, CASE WHEN worker_sk IS NULL THEN branch_code END AS branch_code, CASE WHEN worker_sk IS NULL THEN company_code END AS company_code,
    worker_sk, scope, jurisdiction, tax_type, codes FROM decisions WHERE scope IN ('SKIP_TAX_JURISDICTION', 'SKIP_CODE')""")
cte("effects", "narrow twins", f"""SELECT row_number() OVER () AS eid, *, CASE WHEN tax_type IS NOT NULL THEN coalesce((SELECT list(w.tax_type) FROM twins w WHERE w.base = n.tax_type), [tax_type]) END AS types,
    CASE WHEN scope = 'SKIP_CODE' THEN string_split(codes, ',') ELSE [] END AS code_list FROM (SELECT DISTINCT {_narrow} FROM narrow) n""")
cte("vw", "effects site_workers", f"""SELECT e.eid, e.eid * {_VID} + w.worker_sk AS vid, w.worker_sk, e.scope, e.jurisdiction, e.types, e.code_list FROM effects e JOIN site_workers w
    ON CASE WHEN e.worker_sk IS NULL THEN w.branch_code = e.branch_code AND w.company_code = e.company_code ELSE w.worker_sk = e.worker_sk END""")
_gone_code = "(list_contains(v.code_list, {0}) AND coalesce(v.jurisdiction = {1}, v.jurisdiction IS NULL))"
_gone_row = "(v.scope = 'SKIP_TAX_JURISDICTION' AND v.jurisdiction = {0}.jurisdiction AND (v.types IS NULL OR list_contains(v.types, {0}.tax_type)))"
cte("qperiods_v", "qperiods vw", "SELECT v.vid AS worker_sk, q.branch_code, q.company_code, q.year, q.quarter, q.site_id FROM qperiods q JOIN vw v ON v.worker_sk = q.worker_sk")
cte("fields_v", "workers_f vw", f"""SELECT v.vid AS worker_sk, t.ord, t.level, t.code, t.text, NULL::VARCHAR AS only_jurisdiction FROM workers_f t JOIN vw v ON v.worker_sk = t.worker_sk
    WHERE NOT {_gone_code.format('t.code', 'NULL')}""")
cte("rows_v", "rowtext vw", f"""SELECT r.* REPLACE (v.vid AS worker_sk, list_filter(r.fields, lambda x: NOT {_gone_code.format('left(x, 2)', 'r.jurisdiction')}) AS fields)
    FROM rowtext r JOIN vw v ON v.worker_sk = r.worker_sk WHERE NOT coalesce({_gone_row.format('r')}, false)""")
cte("absent_v", "wperiods mand rows_v vw", f"""SELECT v.vid AS worker_sk, t.branch_code, t.company_code, t.year, t.quarter, m.code, m.tax_type FROM wperiods t JOIN vw v ON v.worker_sk = t.worker_sk CROSS JOIN mand m
    WHERE NOT EXISTS (SELECT 1 FROM rows_v r WHERE r.worker_sk = v.vid AND r.year = t.year AND r.quarter = t.quarter AND r.tax_type = m.tax_type)
    AND NOT coalesce(v.scope = 'SKIP_TAX_JURISDICTION' AND v.jurisdiction = 'F' AND (v.types IS NULL OR list_contains(v.types, m.tax_type)), false)""")
line_ctes("_v", "qperiods_v", "fields_v", "fields_v", "rows_v", "absent_v")
CTES["all_defaults_v"] = (CTES["defaults_v"][0], CTES["defaults_v"][1].replace("defaults_v AS", "all_defaults_v AS", 1))
cte("defaults_v", "all_defaults_v vw", f"SELECT d.* FROM all_defaults_v d JOIN vw v ON v.vid = d.worker_sk WHERE NOT {_gone_code.format('left(d.text, 2)', 'd.jurisdiction')}")
_file = "site_id, year, quarter, branch_code, company_code"
for _t in ("", "_v"):
    cte(f"sized{_t}", f"own_lines{_t} tax_lines{_t}", f"""SELECT o.worker_sk // {_VID} AS eid, o.worker_sk % {_VID} AS worker_sk, o.site_id, o.year, o.quarter, o.branch_code, o.company_code,
        len(o.lines) AS own, coalesce(len(t.lines), 0) AS tax FROM own_lines{_t} o LEFT JOIN tax_lines{_t} t ON t.worker_sk = o.worker_sk AND t.year = o.year AND t.quarter = o.quarter""")
cte("file_sums", "sized", f"SELECT {_file}, sum(own) AS own, sum(tax) AS tax FROM sized GROUP BY ALL")
cte("less", "sized sized_v", f"SELECT v.eid, {', '.join('b.' + c for c in _file.split(', '))}, sum(b.own - v.own) AS own, sum(b.tax - v.tax) AS tax FROM sized_v v JOIN sized b USING (worker_sk, site_id, year, quarter) GROUP BY ALL")
_of_company = "(d.worker_sk IS NULL OR d.scope IN ('SKIP_COMPANY_OUTPUT', 'SKIP_COMPANY_TAX_OUTPUT'))"
cte("reached", "decisions file_sums sized", f"""SELECT d.company_error_sk, d.rule_id, d.scope, {', '.join('k.' + c for c in _file.split(', '))}, k.own, k.tax FROM decisions d JOIN file_sums k ON {_of_company} AND {_same} AND d.scope NOT IN ('SKIP_ENTIRE_EMPLOYEE', 'SKIP_ALL_TAX_FOR_EMPLOYEE')
    UNION ALL SELECT d.company_error_sk, d.rule_id, d.scope, {', '.join('k.' + c for c in _file.split(', '))}, k.own, k.tax FROM decisions d JOIN sized k ON NOT {_of_company} AND k.worker_sk = d.worker_sk""")
_n = "CAST(coalesce({0}, 0) AS BIGINT)"
oracle("skip_audit_lines", "decisions active narrow effects reached file_sums less", f"""SELECT d.company_error_sk, d.rule_id, d.error_code, a.category, d.resolved_category, a.impacts_deposit, a.impacts_filing, d.scope, d.worker_sk, d.jurisdiction, d.tax_type,
    r.site_id, r.year, r.quarter, coalesce(r.branch_code, d.branch_code) AS branch_code, coalesce(r.company_code, d.company_code) AS company_code,
    {_n.format('f.own')} AS worker_lines_before, {_n.format("f.own - CASE WHEN d.scope IN ('SKIP_COMPANY_OUTPUT', 'SKIP_ENTIRE_EMPLOYEE') THEN r.own ELSE coalesce(l.own, 0) END")} AS worker_lines_after,
    {_n.format('f.tax')} AS tax_lines_before, {_n.format("f.tax - CASE WHEN d.scope IN ('SKIP_COMPANY_OUTPUT', 'SKIP_ENTIRE_EMPLOYEE', 'SKIP_COMPANY_TAX_OUTPUT', 'SKIP_ALL_TAX_FOR_EMPLOYEE') THEN r.tax ELSE coalesce(l.tax, 0) END")} AS tax_lines_after
    FROM decisions d JOIN active a ON a.company_error_sk = d.company_error_sk
    LEFT JOIN reached r ON r.company_error_sk = d.company_error_sk AND r.rule_id IS NOT DISTINCT FROM d.rule_id
    LEFT JOIN file_sums f ON {' AND '.join(f'f.{c} = r.{c}' for c in _file.split(', '))}
    LEFT JOIN narrow n ON n.company_error_sk = d.company_error_sk AND n.rule_id IS NOT DISTINCT FROM d.rule_id
    LEFT JOIN effects e ON {' AND '.join(f'e.{c} IS NOT DISTINCT FROM n.{c}' for c in _narrow.split(', '))}
    LEFT JOIN less l ON l.eid = e.eid AND {' AND '.join(f'l.{c} = r.{c}' for c in _file.split(', '))}
    WHERE d.scope <> 'NO_SKIP'""")
# With skips, a file with workers ends GENERATED or SKIPPED.
oracle("error_write_status_after_run", "fx_error fx_org audit qperiods", f"""SELECT company_error_sk, error_code, old_status, seen,
    CASE WHEN NOT seen OR NOT (resolution_status = 'Open' AND old_status = 'PENDING') THEN old_status WHEN removed > 0 THEN 'SKIPPED' ELSE 'WRITTEN' END AS write_status
    FROM (SELECT e.company_error_sk, e.error_code, e.resolution_status, e.write_status AS old_status, coalesce(a.removed, 0) AS removed,
      e.organization_unit_sk IN (SELECT organization_unit_sk FROM fx_org WHERE site_id IN (SELECT site_id FROM qperiods WHERE site_id NOT IN ('{FAILED_SITE}', '{UNQUEUED_SITE}'))) AS seen
      FROM fx_error e LEFT JOIN (SELECT company_error_sk, sum(removed) AS removed FROM audit GROUP BY 1) a USING (company_error_sk))""")
CTES["versions"] = ((), values("versions", "error_code, legacy, error_type, category, impacts_deposit, impacts_filing, since",
    [(*r, "0001-01-01 00:00:00") for r in errors.catalog_rows()] + [(*r, t) for r, t in CATALOG_VERSIONS]))
oracle("active_errors_as_of", "fx_error versions", """SELECT e.company_error_sk, e.organization_unit_sk, e.error_code, e.state_code, e.local_code, e.tax_type, e.worker_sk,
    c.error_type, c.category, c.impacts_deposit, c.impacts_filing, c.error_code IS NOT NULL AS in_catalog, CASE WHEN c.since > TIMESTAMP '0001-01-01' THEN strftime(c.since, '%Y-%m-%d %H:%M:%S') END AS effective_from
    FROM (SELECT * FROM fx_error WHERE resolution_status = 'Open' AND write_status = 'PENDING') e
    ASOF LEFT JOIN (SELECT error_code, CAST(since AS TIMESTAMP) AS since, error_type, category, impacts_deposit, impacts_filing FROM versions
      QUALIFY row_number() OVER (PARTITION BY error_code, since ORDER BY error_type DESC, category DESC, impacts_deposit DESC, impacts_filing DESC) = 1) c
    ON c.error_code = e.error_code AND e.created_date_time >= c.since""")
oracle("resolve_scopes_by_table", "decisions_r", "SELECT * FROM decisions_r")
oracle("site_file_with_rule_table", "whole_r", "SELECT * FROM whole_r")
oracle("site_file_with_skips", "whole_s", "SELECT * FROM whole_s")

# quality
_d = "regexp_replace(ssn, '[^0-9]', '', 'g')"
_ssn = {
    "SSN_NON_NUM": "regexp_matches(ssn, '[^0-9-]')", "SSN_F3_0": f"regexp_matches({_d}, '^000[0-9]{{6}}$')",
    "SSN_F3_6": f"regexp_matches({_d}, '^666[0-9]{{6}}$')", "SSN_M2_0": f"regexp_matches({_d}, '^[0-9]{{3}}00[0-9]{{4}}$')",
    "SSN_L4_0": f"regexp_matches({_d}, '^[0-9]{{5}}0000$')",
    "SSN_EQ_NUM": f"{_d} IN ({', '.join(repr(str(i) * 9) for i in range(10))})",
    "SSN_REV_SEQ": f"{_d} IN ('987654321', '876543210')", "SSN_SEQ": f"{_d} IN ('123456789', '012345678')",
    "SSN_F1_9": f"regexp_matches({_d}, '^9[0-9]{{8}}$')", "E002": f"{_d} = '000000000'",
}
oracle("dq_ssn", "fx_worker", " UNION ALL ".join(f"SELECT worker_sk, '{r}' AS rule_code FROM fx_worker WHERE {p}" for r, p in _ssn.items()))
oracle("dq_missing", "fx_org fx_worker", """SELECT branch_code, company_code, NULL::BIGINT AS worker_sk, 'FEIN_IS_MISSING' AS rule_code FROM fx_org WHERE tax_id IS NULL OR trim(tax_id) = ''
    UNION ALL SELECT branch_code, company_code, NULL, 'PAY_FREQ_MIS' FROM fx_org WHERE pay_frequency IS NULL OR trim(pay_frequency) = ''
    UNION ALL SELECT branch_code, company_code, worker_sk, 'BIRTH_DT_MIS' FROM fx_worker WHERE birth_date IS NULL""")
_Q = "worker_sk, year, quarter, payroll_run_sk, tax_type"


ROW_RULES: dict[str, str] = {}


def rules(name: str, checks: dict) -> None:
    ROW_RULES.update(checks)
    oracle(name, "qrows", " UNION ALL ".join(f"SELECT {_Q}, '{r}' AS rule_code FROM qrows WHERE {p}" for r, p in checks.items()))


_nw = "tax_type = '{0}' AND {1}_amount <> 0 AND ({1}_taxable_amount IS NULL OR {1}_taxable_amount = 0)"
rules("dq_tax_no_wage", {
    "YD_FIT_TAX_MIS": _nw.format("FIT", "ytd"), "YD_FIT_WG_MIS": _nw.format("FIT", "ytd"), "YD_SIT_WG_MIS": _nw.format("SIT", "ytd"),
    "QD_FIT_WG_MIS": _nw.format("FIT", "qtd"), "YD_SSAE_WG_MIS": _nw.format("SSEE", "ytd"), "SSAE_WG_MIS": _nw.format("SSEE", "ytd")})
rules("dq_wage_order", {
    "SUI_SUBWG_LT_TAXWG": "tax_type LIKE 'SUIE%' AND qtd_subject_amount < qtd_taxable_amount",
    "SUI_TAXWG_LT_SUBWG": "tax_type LIKE 'SUIE%' AND qtd_subject_amount > qtd_taxable_amount"})
rules("dq_negative", {
    "QD_MED_TAX_WG_NE": "tax_type = 'MEDEE' AND qtd_taxable_amount < 0", "YD_MED_TAX_WG_NE": "tax_type = 'MEDEE' AND ytd_taxable_amount < 0",
    "QD_EMP_MED_TAX_NEG": "tax_type = 'MEDEE' AND qtd_amount < 0", "YD_EMP_MED_TAX_NG": "tax_type = 'MEDEE' AND ytd_amount < 0",
    "YD_COBRA_MED_NEG": "tax_type = 'COBRA-CR' AND ytd_amount < 0"})
_sui = "tax_type LIKE 'SUIE%' AND qtd_gross_wages > 0"
rules("dq_wage_no_hours", {
    "DE_PFML_WG_HRS_MIS": "state_code = 'DE' AND tax_type = 'FLI' AND qtd_taxable_amount > 0 AND hours_worked IS NULL",
    "DE_PFML_WG_WKS_MIS": "state_code = 'DE' AND tax_type = 'FLI' AND qtd_taxable_amount > 0 AND qtd_weeks_worked IS NULL",
    "SUIER_TX_RT_MIS": "tax_type = 'SUIER' AND qtd_taxable_amount > 0 AND (tax_rate IS NULL OR tax_rate = 0)",
    "WG_GT_0_HRS_0_NO_RSN": f"state_code = 'WA' AND {_sui} AND (hours_worked IS NULL OR hours_worked = 0)",
    "SC_SUI_WG_GT_0_HRS_LE_0": f"state_code = 'SC' AND {_sui} AND hours_worked <= 0",
    "SC_SUI_WG_GT_0_HRS_MIS": f"state_code = 'SC' AND {_sui} AND hours_worked IS NULL"})
_bounds = [
    ("DE_PFML_QTD_WKS_GT_14", "DE", "qtd_weeks_worked", "> 14"), ("DE_PFML_YTD_WKS_GT_53", "DE", "ytd_weeks_worked", "> 53"),
    ("DE_PFML_HRS_GT_2200", "DE", "hours_worked", "> 2200"), ("DE_PFML_ER_CNTRB_PCT_OOR", "DE", "contribution_percent", "NOT BETWEEN 50 AND 100"),
    ("MA_FLI_EE_PCT_OOR", "MA", "contribution_percent", "> 100"), ("MA_PML_EE_PCT_OOR", "MA", "contribution_percent", "> 100"),
    ("MA_MLI_EE_PCT_OOR", "MA", "contribution_percent", "> 40")]
oracle("dq_bounds", "qrows", " UNION ALL ".join(
    f"SELECT worker_sk, year, quarter, payroll_run_sk, '{r}' AS rule_code, CAST({m} AS DECIMAL(18,2)) AS value FROM qrows WHERE state_code = '{s}' AND {m} {p}" for r, s, m, p in _bounds))
rules("dq_all", ROW_RULES | {r: f"state_code = '{s}' AND {m} {p}" for r, s, m, p in _bounds}
      | {"NY_SIT_TAX_GT_WAGE": "state_code = 'NY' AND tax_type = 'SIT' AND qtd_amount > qtd_taxable_amount AND qtd_amount >= 100.5"})
_sum = "sum({1}) FILTER (tax_type IN ({0}){2})"
cte("sums", "qrows", f"""SELECT worker_sk, year, quarter, {_sum.format("'SIT', 'CIT'", 'qtd_amount', " AND state_code = 'NY'")} AS withheld, {_sum.format("'FIT'", 'qtd_taxable_amount', '')} AS fit_wage,
    {_sum.format("'SDIEE'", 'qtd_taxable_amount', '')} AS sdi_ee, {_sum.format("'SDIER'", 'qtd_taxable_amount', '')} AS sdi_er, {_sum.format("'SUIER'", 'qtd_taxable_amount', '')} AS sui_er,
    {_sum.format("'MEDEE'", 'ytd_taxable_amount', '')} AS med_ytd, {_sum.format("'SSEE'", 'ytd_taxable_amount', '')} AS ss_ytd,
    {_sum.format("'FLI'", 'qtd_subject_amount', " AND state_code = 'NJ'")} AS fli_qtd, {_sum.format("'FLI'", 'ytd_subject_amount', " AND state_code = 'NJ'")} AS fli_ytd
    FROM qrows GROUP BY ALL""")
oracle("dq_cross_type", "sums", " UNION ALL ".join(f"SELECT worker_sk, year, quarter, '{r}' AS rule_code FROM sums WHERE {p}" for r, p in {
    "SIT_CIT_TXWH_GT_FIT_TX_WG": "withheld > fit_wage", "QD_SDIE_LT_SUI_TXWG": "sdi_ee < sui_er", "SDIR_TX_WG_NE_SDIE": "sdi_er <> sdi_ee",
    "YD_MED_WG_LT_SSAE_OR_TIPS": "med_ytd < ss_ytd", "NJ_FLI_QD_SUBJ_GT_YD": "fli_qtd > fli_ytd"}.items()))
_wv = "worker_sk IN (SELECT worker_sk FROM fx_snapshot WHERE state_code = 'WV')"
oracle("dq_text", "fx_worker fx_snapshot", f"""SELECT worker_sk, 'WV_SUI_JOB_TTL_SOC_MIS' AS rule_code FROM fx_worker WHERE (job_title IS NULL OR trim(job_title) = '') AND {_wv}
    UNION ALL SELECT worker_sk, 'WV_SUI_JOB_TTL_SPCL_CHR' FROM fx_worker WHERE regexp_matches(job_title, '[^A-Za-z0-9 ]') AND {_wv}
    UNION ALL SELECT DISTINCT worker_sk, 'LIV_PSD_MIS' FROM fx_snapshot WHERE state_code = 'DE' AND (lived_in_code IS NULL OR trim(lived_in_code) = '')""")
_codes_sql = " UNION ALL ".join(f"SELECT worker_sk, year, quarter, '{c}' AS code, {m} AS amount FROM qrows WHERE tax_type = '{t}'" for t, m, c in FEDERAL_CODES)
cte("federal", "qrows", f"""SELECT worker_sk, year, quarter, coalesce(sum(amount) FILTER (code IN ('FP', '6B')), 0) AS socsec, coalesce(sum(amount) FILTER (code = 'IC'), 0) AS medicare,
    coalesce(sum(amount) FILTER (code = 'EJ'), 0) AS fit, coalesce(sum(amount) FILTER (code IN ('IA', '7A', 'FL', '5Y')), 0) AS third_party,
    coalesce(sum(amount) FILTER (code = 'ZE'), 0) AS ze, coalesce(sum(amount) FILTER (code = 'ZF'), 0) AS zf, coalesce(sum(amount) FILTER (code = 'EL'), 0) AS el FROM ({_codes_sql}) GROUP BY ALL""")
oracle("dq_federal", "federal fx_worker", """SELECT worker_sk, year, quarter, CAST(socsec AS DECIMAL(28,2)) AS socsec, CAST(medicare AS DECIMAL(28,2)) AS medicare, CAST(fit AS DECIMAL(28,2)) AS fit, CAST(third_party AS DECIMAL(28,2)) AS third_party
    FROM federal WHERE fit < 0 OR socsec < 0 OR medicare < 0 OR ze < 0 OR zf < 0 OR el > 0 OR medicare < socsec
    OR (third_party < 0 AND worker_sk IN (SELECT worker_sk FROM fx_worker WHERE third_party_sick_pay_indicator))""")
