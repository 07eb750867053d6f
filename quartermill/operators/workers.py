"""Worker side: address pivot, profile, period membership, coded fields."""

from pyspark.sql import DataFrame, functions as F

from quartermill.functions.formats import quote
from quartermill.functions.packing import NO_LINES
from quartermill.functions.text import yes_no
from quartermill.specs.compile import Specs, field_text

ADDRESS_COLUMNS = ("line_one", "city_name", "state_code", "postal_code")
UPPER_ADDRESS_COLUMNS = ("line_one", "city_name")
PLAIN_COLUMNS = (
    "ssn", "birth_date", "hire_date", "termination_date", "gender", "department_code",
    "employee_id", "pay_rate_amount", "job_title",
)

# Code values derived from worker attributes; NULL indicators count as false.
FLAGS = {
    "retirement_plan_indicator": yes_no("retirement_plan_indicator"),
    "third_party_sick_pay_indicator": yes_no("third_party_sick_pay_indicator"),
    "replacement_worker": yes_no("replacement_worker"),
    "corporate_officer_indicator": yes_no("corporate_officer_indicator"),
    "pull_indicator": yes_no("w2_special_handle_indicator", "P", "M"),
    "medical_coverage_indicator": yes_no("medical_coverage_indicator", "3", "1"),
    "print_suppress_flag": yes_no("suppress_w2_print_indicator", "P", "N"),
    "independent_contractor": yes_no("worker_type = 'Contractor'"),
    "seasonal_employee": yes_no("worker_type = 'Seasonal'"),
    "seasonal_employee_local": yes_no("worker_type = 'Seasonal'"),
    "wfh_indicator": yes_no("work_from_home_flag"),
    "ee_post_indicator": yes_no("post_w2_indicator"),
    "statutory_flag": yes_no("statutory_flag"),
    "remuneration_basis": "CASE remuneration_basis WHEN 'Hourly' THEN 'H' WHEN 'Salaried' THEN 'S' END",
    "family_status": yes_no("ownership_percent > 50"),
}


def address_pivot(address: DataFrame) -> DataFrame:
    """One row per worker: work and home address side by side."""
    columns = []
    for kind in ("Work", "Home"):
        for name in ADDRESS_COLUMNS:
            value = f"upper({name})" if name in UPPER_ADDRESS_COLUMNS else name
            columns.append(
                F.expr(f"max(CASE WHEN type = '{kind}' THEN {value} END) AS {kind.lower()}_{name}")
            )
    return address.filter("type IN ('Work', 'Home')").groupBy("worker_sk").agg(*columns)


def worker_profile(worker: DataFrame, address: DataFrame) -> DataFrame:
    """Worker attributes in output form, with both addresses."""
    keys = [k for k in ("worker_sk", "branch_code", "company_code", "site_id") if k in worker.columns]
    attributes = worker.selectExpr(
        *keys,
        "upper(family_name) AS family_name",
        "upper(given_name) AS given_name",
        "upper(left(middle_name, 1)) AS middle_name",
        *PLAIN_COLUMNS,
        *(f"{expression} AS {name}" for name, expression in FLAGS.items()),
    )
    return attributes.join(address_pivot(address), "worker_sk", "left")


def workers_in_period(worker: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Workers with any snapshot row, per period."""
    periods = snapshot.select("worker_sk", "year", "quarter").distinct()
    return worker.select("worker_sk", "branch_code", "company_code").join(periods, "worker_sk")


def worker_counts(worker: DataFrame, snapshot: DataFrame) -> DataFrame:
    return (
        workers_in_period(worker, snapshot)
        .groupBy("branch_code", "company_code", "year", "quarter")
        .agg(F.count("*").alias("worker_count"))
    )


def worker_fields(profile: DataFrame, specs: Specs) -> DataFrame:
    """Long form: one row per worker and coded field."""
    coded = [
        f"named_struct('ord', {row[0]}, 'level', {quote(row[8])}, 'code', {quote(row[2])}, 'text', {field_text(row)})"
        for row in specs.fields
        if row[1] in profile.columns
    ]
    return profile.selectExpr(
        "worker_sk", "branch_code", "company_code", f"inline(array({', '.join(coded)}))"
    ).filter("text IS NOT NULL")


def level_arrays(profile: DataFrame, specs: Specs, keys) -> DataFrame:
    """One row per worker with the coded fields of each level as an array."""
    arrays = []
    for level in ("EE", "F", "S", "L"):
        texts = [field_text(row) for row in specs.fields if row[8] == level and row[1] in profile.columns]
        array = f"array_compact(array({', '.join(texts)}))" if texts else NO_LINES
        arrays.append(f"{array} AS {level.lower()}_fields")
    return profile.selectExpr(*keys, *arrays)
