"""Data-quality rules; each result row names the broken rule."""

from decimal import Decimal

from pyspark.sql import DataFrame, functions as F

from quartermill.session import values_frame
import pyarrow as pa

ROW_KEYS = ("worker_sk", "year", "quarter")


def broken(df: DataFrame, rules: dict[str, str], keys) -> DataFrame:
    """One row per key and rule whose predicate (SQL text) holds."""
    checks = ", ".join(f"CASE WHEN {predicate} THEN '{rule}' END" for rule, predicate in rules.items())
    return df.selectExpr(*keys, f"explode(array_compact(array({checks}))) AS rule_code")


# --- Fixed values: identity number rules over the nine digits -----------------
SSN_RULES = {
    "SSN_NON_NUM": "ssn RLIKE '[^0-9-]'",
    "SSN_F3_0": "length(digits) = 9 AND left(digits, 3) = '000'",
    "SSN_F3_6": "length(digits) = 9 AND left(digits, 3) = '666'",
    "SSN_M2_0": "length(digits) = 9 AND substring(digits, 4, 2) = '00'",
    "SSN_L4_0": "length(digits) = 9 AND right(digits, 4) = '0000'",
    "SSN_EQ_NUM": "length(digits) = 9 AND replace(digits, left(digits, 1), '') = ''",
    "SSN_REV_SEQ": "digits IN ('987654321', '876543210')",
    "SSN_SEQ": "digits IN ('123456789', '012345678')",
    "SSN_F1_9": "length(digits) = 9 AND left(digits, 1) = '9'",
    "E002": "digits = '000000000'",
}


def ssn_rules(worker: DataFrame) -> DataFrame:
    digits = worker.selectExpr("worker_sk", "ssn", "regexp_replace(ssn, '[^0-9]', '') AS digits")
    return broken(digits, SSN_RULES, ["worker_sk"])


def missing_rules(worker: DataFrame, organization: DataFrame) -> DataFrame:
    """Missing company tax id, pay frequency (if the input has it) and birth date."""
    company = {"tax_id": "FEIN_IS_MISSING", "pay_frequency": "PAY_FREQ_MIS"}
    rules = {
        rule: f"coalesce(trim({column}), '') = ''" for column, rule in company.items() if column in organization.columns
    }
    keys = ["branch_code", "company_code"]
    by_company = broken(organization, rules, [*keys, "CAST(NULL AS BIGINT) AS worker_sk"])
    by_worker = broken(worker, {"BIRTH_DT_MIS": "birth_date IS NULL"}, [*keys, "worker_sk"])
    return by_company.unionByName(by_worker)


def _no_wage(tax_type: str, tax: str, wage: str) -> str:
    return f"tax_type = '{tax_type}' AND {tax} <> 0 AND coalesce({wage}, 0) = 0"


# --- Fixed values: row rules over canonical tax rows ---------------------------
TAX_NO_WAGE = {
    "YD_FIT_TAX_MIS": _no_wage("FIT", "ytd_amount", "ytd_taxable_amount"),
    "YD_FIT_WG_MIS": _no_wage("FIT", "ytd_amount", "ytd_taxable_amount"),
    "YD_SIT_WG_MIS": _no_wage("SIT", "ytd_amount", "ytd_taxable_amount"),
    "QD_FIT_WG_MIS": _no_wage("FIT", "qtd_amount", "qtd_taxable_amount"),
    "YD_SSAE_WG_MIS": _no_wage("SSEE", "ytd_amount", "ytd_taxable_amount"),
    "SSAE_WG_MIS": _no_wage("SSEE", "ytd_amount", "ytd_taxable_amount"),
}
WAGE_ORDER = {
    "SUI_SUBWG_LT_TAXWG": "tax_type IN ('SUIEE', 'SUIER') AND qtd_subject_amount < qtd_taxable_amount",
    "SUI_TAXWG_LT_SUBWG": "tax_type IN ('SUIEE', 'SUIER') AND qtd_taxable_amount < qtd_subject_amount",
}
NEGATIVE = {
    "QD_MED_TAX_WG_NE": "tax_type = 'MEDEE' AND qtd_taxable_amount < 0",
    "YD_MED_TAX_WG_NE": "tax_type = 'MEDEE' AND ytd_taxable_amount < 0",
    "QD_EMP_MED_TAX_NEG": "tax_type = 'MEDEE' AND qtd_amount < 0",
    "YD_EMP_MED_TAX_NG": "tax_type = 'MEDEE' AND ytd_amount < 0",
    "YD_COBRA_MED_NEG": "tax_type = 'COBRA-CR' AND ytd_amount < 0",
}
WAGE_NO_HOURS = {
    "DE_PFML_WG_HRS_MIS": "state_code = 'DE' AND tax_type = 'FLI' AND qtd_taxable_amount > 0 AND hours_worked IS NULL",
    "DE_PFML_WG_WKS_MIS": "state_code = 'DE' AND tax_type = 'FLI' AND qtd_taxable_amount > 0 AND qtd_weeks_worked IS NULL",
    "SUIER_TX_RT_MIS": "tax_type = 'SUIER' AND qtd_taxable_amount > 0 AND coalesce(tax_rate, 0) = 0",
    "WG_GT_0_HRS_0_NO_RSN": "state_code = 'WA' AND tax_type IN ('SUIEE', 'SUIER') AND qtd_gross_wages > 0 AND coalesce(hours_worked, 0) = 0",
    "SC_SUI_WG_GT_0_HRS_LE_0": "state_code = 'SC' AND tax_type IN ('SUIEE', 'SUIER') AND qtd_gross_wages > 0 AND hours_worked <= 0",
    "SC_SUI_WG_GT_0_HRS_MIS": "state_code = 'SC' AND tax_type IN ('SUIEE', 'SUIER') AND qtd_gross_wages > 0 AND hours_worked IS NULL",
}
TEXT_RULES = {
    "WV_SUI_JOB_TTL_SOC_MIS": "coalesce(trim(job_title), '') = ''",
    "WV_SUI_JOB_TTL_SPCL_CHR": "job_title RLIKE '[^A-Za-z0-9 ]'",
}

# --- Fixed values: bounds (rule | state | measure | low | high) ----------------
BOUNDS = (
    ("DE_PFML_QTD_WKS_GT_14", "DE", "qtd_weeks_worked", None, 14),
    ("DE_PFML_YTD_WKS_GT_53", "DE", "ytd_weeks_worked", None, 53),
    ("DE_PFML_HRS_GT_2200", "DE", "hours_worked", None, 2200),
    ("DE_PFML_ER_CNTRB_PCT_OOR", "DE", "contribution_percent", 50, 100),
    ("MA_FLI_EE_PCT_OOR", "MA", "contribution_percent", None, 100),
    ("MA_PML_EE_PCT_OOR", "MA", "contribution_percent", None, 100),
    ("MA_MLI_EE_PCT_OOR", "MA", "contribution_percent", None, 40),
)


def row_rules(rows: DataFrame, rules: dict[str, str]) -> DataFrame:
    return broken(rows, rules, [*ROW_KEYS, "payroll_run_sk", "tax_type"])


def bounds_rules(rows: DataFrame, bounds=BOUNDS) -> DataFrame:
    """Measures outside their bounds; a bound table joined on state and measure."""
    schema = pa.schema(
        [("rule_code", pa.string()), ("state_code", pa.string()), ("measure", pa.string()), ("low", pa.float64()), ("high", pa.float64())]
    )
    measures = sorted({b[2] for b in bounds if b[2] in rows.columns})
    limits = values_frame(
        rows.sparkSession, schema,
        [(r, s, m, None if lo is None else float(lo), None if hi is None else float(hi)) for r, s, m, lo, hi in bounds],
    )
    entries = ", ".join(f"named_struct('measure', '{m}', 'value', CAST({m} AS DECIMAL(18,2)))" for m in measures)
    long = rows.selectExpr(*ROW_KEYS, "payroll_run_sk", "state_code", f"inline(array({entries}))")
    return long.join(limits, ["state_code", "measure"]).filter("value < low OR value > high").select(
        *ROW_KEYS, "payroll_run_sk", "rule_code", "value"
    )


def wv_text_rules(worker: DataFrame, tax_rows: DataFrame, place_states: tuple[str, ...] = ("PA",)) -> DataFrame:
    """Job title rules for workers with West Virginia rows, and missing lived-in places.

    Only rows of ``place_states`` must name a place; NULL and blank both miss.
    """
    in_state = tax_rows.filter("state_code = 'WV'").select("worker_sk").distinct()
    titles = broken(worker.join(in_state, "worker_sk", "left_semi"), TEXT_RULES, ["worker_sk"])
    needs_place = F.col("state_code").isin(*place_states)
    places = tax_rows.filter(needs_place).filter("coalesce(trim(lived_in_code), '') = ''").select("worker_sk").distinct()
    return titles.unionByName(places.withColumn("rule_code", F.lit("LIV_PSD_MIS")))


def cross_type_rules(rows: DataFrame, state: str = "NY") -> DataFrame:
    """Rules over several tax types of one worker: conditional sums, then predicates."""
    def total(name: str, types: str, measure: str, where: str = "true") -> F.Column:
        return F.expr(f"sum(CASE WHEN tax_type IN ({types}) AND {where} THEN {measure} END) AS {name}")

    in_state = f"state_code = '{state}'"
    sums = rows.groupBy(*ROW_KEYS).agg(
        total("withheld", "'SIT', 'CIT'", "qtd_amount", in_state),
        total("fit_wage", "'FIT'", "qtd_taxable_amount"),
        total("sdi_ee", "'SDIEE'", "qtd_taxable_amount"),
        total("sdi_er", "'SDIER'", "qtd_taxable_amount"),
        total("sui_er", "'SUIER'", "qtd_taxable_amount"),
        total("med_ytd", "'MEDEE'", "ytd_taxable_amount"),
        total("ss_ytd", "'SSEE'", "ytd_taxable_amount"),
        total("fli_qtd", "'FLI'", "qtd_subject_amount", "state_code = 'NJ'"),
        total("fli_ytd", "'FLI'", "ytd_subject_amount", "state_code = 'NJ'"),
    )
    return broken(
        sums,
        {
            "SIT_CIT_TXWH_GT_FIT_TX_WG": "withheld > fit_wage",
            "QD_SDIE_LT_SUI_TXWG": "sdi_ee < sui_er",
            "SDIR_TX_WG_NE_SDIE": "sdi_er <> sdi_ee",
            "YD_MED_WG_LT_SSAE_OR_TIPS": "med_ytd < ss_ytd",
            "NJ_FLI_QD_SUBJ_GT_YD": "fli_qtd > fli_ytd",
        },
        ROW_KEYS,
    )


def federal_rule(code_amounts: DataFrame, flagged_workers: DataFrame) -> DataFrame:
    """Workers that break the composite federal rule.

    ``code_amounts``: worker, period, code, amount.  ``flagged_workers``: the
    workers for whom third-party sick pay counts.
    """
    def total(name: str, *codes: str) -> F.Column:
        listed = ", ".join(f"'{c}'" for c in codes)
        return F.expr(f"coalesce(sum(CASE WHEN code IN ({listed}) THEN amount END), 0) AS {name}")

    sums = code_amounts.groupBy(*ROW_KEYS).agg(
        total("socsec", "FP", "6B"), total("medicare", "IC"), total("fit", "EJ"),
        total("third_party", "IA", "7A", "FL", "5Y"), total("extra_wage", "ZE"), total("extra_tax", "ZF"),
        total("credit", "EL"),
    )
    flags = flagged_workers.select("worker_sk").distinct().withColumn("flagged", F.lit(True))
    return (
        sums.join(flags, "worker_sk", "left")
        .filter(
            "fit < 0 OR socsec < 0 OR medicare < 0 OR extra_wage < 0 OR extra_tax < 0 OR credit > 0 "
            "OR (coalesce(flagged, false) AND third_party < 0) OR medicare < socsec"
        )
        .select(*ROW_KEYS, "socsec", "medicare", "fit", "third_party")
    )


# --- Row rules as a table -------------------------------------------------------
CHECK_SCHEMA = pa.schema([(name, pa.string()) for name in ("rule_code", "state_code", "tax_types", "measure", "operator", "operand")])
MAX_CHECKS = 10_000


def _no_wage_checks(*rules):
    return [
        check
        for rule, tax_type, span in rules
        for check in ((rule, None, tax_type, f"{span}_amount", "<>", "0"), (rule, None, tax_type, f"{span}_taxable_amount", "none", None))
    ]


def _no_hours_checks(*rules):
    return [
        check
        for rule, state, types, wage, measure, operator, operand in rules
        for check in ((rule, state, types, wage, ">", "0"), (rule, state, types, measure, operator, operand))
    ]


#: Conditions of the row rules; those of one rule must all hold.  ``tax_types``:
#: a comma-separated list; state and types None mean any.  ``operand``: a number or
#: a column.  Operators besides the comparisons: ``missing`` (NULL), ``none`` (NULL
#: or zero), ``outside`` (``low..high``, either side may be empty).
ROW_CHECKS = (
    *_no_wage_checks(
        ("YD_FIT_TAX_MIS", "FIT", "ytd"), ("YD_FIT_WG_MIS", "FIT", "ytd"), ("YD_SIT_WG_MIS", "SIT", "ytd"),
        ("QD_FIT_WG_MIS", "FIT", "qtd"), ("YD_SSAE_WG_MIS", "SSEE", "ytd"), ("SSAE_WG_MIS", "SSEE", "ytd"),
    ),
    ("SUI_SUBWG_LT_TAXWG", None, "SUIEE,SUIER", "qtd_subject_amount", "<", "qtd_taxable_amount"),
    ("SUI_TAXWG_LT_SUBWG", None, "SUIEE,SUIER", "qtd_taxable_amount", "<", "qtd_subject_amount"),
    ("QD_MED_TAX_WG_NE", None, "MEDEE", "qtd_taxable_amount", "<", "0"),
    ("YD_MED_TAX_WG_NE", None, "MEDEE", "ytd_taxable_amount", "<", "0"),
    ("QD_EMP_MED_TAX_NEG", None, "MEDEE", "qtd_amount", "<", "0"),
    ("YD_EMP_MED_TAX_NG", None, "MEDEE", "ytd_amount", "<", "0"),
    ("YD_COBRA_MED_NEG", None, "COBRA-CR", "ytd_amount", "<", "0"),
    *_no_hours_checks(
        ("DE_PFML_WG_HRS_MIS", "DE", "FLI", "qtd_taxable_amount", "hours_worked", "missing", None),
        ("DE_PFML_WG_WKS_MIS", "DE", "FLI", "qtd_taxable_amount", "qtd_weeks_worked", "missing", None),
        ("SUIER_TX_RT_MIS", None, "SUIER", "qtd_taxable_amount", "tax_rate", "none", None),
        ("WG_GT_0_HRS_0_NO_RSN", "WA", "SUIEE,SUIER", "qtd_gross_wages", "hours_worked", "none", None),
        ("SC_SUI_WG_GT_0_HRS_LE_0", "SC", "SUIEE,SUIER", "qtd_gross_wages", "hours_worked", "<=", "0"),
        ("SC_SUI_WG_GT_0_HRS_MIS", "SC", "SUIEE,SUIER", "qtd_gross_wages", "hours_worked", "missing", None),
    ),
    *((rule, state, None, measure, "outside", f"{'' if low is None else low}..{high}") for rule, state, measure, low, high in BOUNDS),
)


def check_table(spark, rows=ROW_CHECKS) -> DataFrame:
    return values_frame(spark, CHECK_SCHEMA, rows)


def _condition(check, columns) -> F.Column:
    """One row of a check table as a condition; its NULL counts as not broken."""
    def operand(text: str) -> F.Column:
        return F.col(text) if text in columns else F.lit(Decimal(text))

    if check.measure not in columns:
        raise ValueError(f"rule {check.rule_code}: no column {check.measure}")
    measure = F.col(check.measure)
    compare = {"<": "__lt__", "<=": "__le__", ">": "__gt__", ">=": "__ge__", "=": "__eq__", "<>": "__ne__"}
    try:
        if check.operator in compare:
            out = getattr(measure, compare[check.operator])(operand(check.operand))
        elif check.operator == "missing":
            out = measure.isNull()
        elif check.operator == "none":
            out = F.coalesce(measure, F.lit(0)) == 0
        elif check.operator == "outside":
            low, high = check.operand.split("..")
            out = (measure < operand(low) if low else F.lit(False)) | (measure > operand(high) if high else F.lit(False))
        else:
            raise ValueError(f"operator {check.operator}")
    except (ArithmeticError, AttributeError, TypeError, ValueError) as problem:
        raise ValueError(f"rule {check.rule_code}: can't read {check.operator} {check.operand}") from problem
    if check.state_code is not None:
        out &= F.col("state_code") == check.state_code
    if check.tax_types is not None:
        out &= F.col("tax_type").isin(*(t.strip() for t in check.tax_types.split(",")))
    return out


def table_rules(rows: DataFrame, checks: DataFrame) -> DataFrame:
    """One row per tax row and rule of the table ``checks`` whose conditions all hold.

    The rules become one projection, so all of them together cost one scan and
    no shuffle.  A table of more than MAX_CHECKS conditions, an unknown column,
    operator or operand is refused; no conditions: no rows.
    """
    found = checks.select(*CHECK_SCHEMA.names).limit(MAX_CHECKS + 1).collect()
    if len(found) > MAX_CHECKS:
        raise ValueError(f"more than {MAX_CHECKS} conditions")
    rules: dict[str, F.Column] = {}
    for check in found:
        condition = _condition(check, rows.columns)
        rules[check.rule_code] = rules[check.rule_code] & condition if check.rule_code in rules else condition
    marks = F.array(*(F.when(condition, F.lit(rule)) for rule, condition in rules.items())) if rules else F.array().cast("array<string>")
    return rows.select(*ROW_KEYS, "payroll_run_sk", "tax_type", F.explode(F.array_compact(marks)).alias("rule_code"))
