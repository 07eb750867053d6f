"""Input contracts: declared types, and the check every loader runs."""

from pyspark.sql import DataFrame, types as T


_TYPES = {
    "BIGINT": T.LongType(), "INT": T.IntegerType(), "STRING": T.StringType(), "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(), "TIMESTAMP": T.TimestampType(), "RATE": T.DecimalType(8, 4),
    "AMOUNT": T.DecimalType(18, 2), "WIDE_AMOUNT": T.DecimalType(18, 4),
}


def _schema(text: str) -> T.StructType:
    """``name TYPE, ..`` as a struct, without needing a session."""
    pairs = (entry.split() for entry in text.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


WORKER = _schema(
    """worker_sk BIGINT, branch_code STRING, company_code STRING, family_name STRING,
    given_name STRING, middle_name STRING, ssn STRING, birth_date DATE, hire_date DATE,
    termination_date DATE, gender STRING, department_code STRING, worker_type STRING,
    remuneration_basis STRING, ownership_percent WIDE_AMOUNT, employee_id STRING,
    pay_rate_amount WIDE_AMOUNT, job_title STRING, retirement_plan_indicator BOOLEAN,
    third_party_sick_pay_indicator BOOLEAN, replacement_worker BOOLEAN,
    corporate_officer_indicator BOOLEAN, w2_special_handle_indicator BOOLEAN,
    medical_coverage_indicator BOOLEAN, suppress_w2_print_indicator BOOLEAN,
    work_from_home_flag BOOLEAN, post_w2_indicator BOOLEAN, statutory_flag BOOLEAN"""
)
ADDRESS = _schema(
    """worker_sk BIGINT, type STRING, line_one STRING, city_name STRING, state_code STRING,
    postal_code STRING"""
)
SNAPSHOT = _schema(
    """worker_sk BIGINT, organization_unit_sk BIGINT, branch_code STRING, company_code STRING,
    payroll_run_sk BIGINT, state_code STRING, local_code STRING, tax_type STRING,
    is_employer_tax BOOLEAN, year INT, quarter INT, tax_rate RATE,
    hours_worked AMOUNT, qtd_amount AMOUNT, qtd_taxable_amount AMOUNT,
    qtd_subject_amount AMOUNT, qtd_gross_wages AMOUNT, ytd_amount AMOUNT,
    ytd_taxable_amount AMOUNT, ytd_subject_amount AMOUNT,
    ytd_gross_wages AMOUNT, qtd_overtime_amount AMOUNT,
    ytd_overtime_amount AMOUNT, lived_in_code STRING, out_of_state STRING"""
)
PROFILE = _schema(
    """worker_sk BIGINT, branch_code STRING, company_code STRING, state_code STRING,
    local_code STRING, filing_status STRING, number_of_allowances INT, sui_exempt_flag STRING,
    sdi_exempt_flag STRING"""
)
ORGANIZATION = _schema(
    "organization_unit_sk BIGINT, branch_code STRING, company_code STRING, site_id STRING"
)
QUEUE = _schema(
    """batch_id STRING, site_id STRING, year INT, quarter INT, window_start DATE,
    window_end DATE, status STRING, file_type STRING"""
)
ERRORS = _schema(
    """company_error_sk BIGINT, organization_unit_sk BIGINT, error_code STRING,
    resolution_status STRING, write_status STRING, state_code STRING, local_code STRING,
    tax_type STRING, worker_sk BIGINT, created_date_time TIMESTAMP"""
)

# Empty jurisdiction codes mean the same as NULL, in keys and in joins.
_BLANK_AS_NULL = {"state_code", "local_code"}


def require_columns(df: DataFrame, columns, context: str) -> DataFrame:
    missing = [name for name in columns if name not in df.columns]
    if missing:
        raise ValueError(f"{context} misses columns: {missing}")
    return df


def conform(df: DataFrame, schema: T.StructType, context: str, blank_as_null: bool = True) -> DataFrame:
    """Select and cast the declared columns; columns beyond them are kept as they are."""
    require_columns(df, schema.names, context)
    types = dict(df.dtypes)
    columns = []
    for field in schema:
        column, declared = field.name, field.dataType.simpleString()
        if types[column] != declared:
            column = f"CAST({column} AS {declared})"
        if blank_as_null and field.name in _BLANK_AS_NULL:
            column = f"nullif({column}, '')"
        columns.append(f"{column} AS {field.name}")
    return df.selectExpr(*columns, *(name for name in types if name not in schema.names))
