"""Filing inputs derived from the test tables.

The test tables hold no payroll data.  These views map them onto the input
schemas; the SQL runs unchanged on Spark and on DuckDB, so both sides of a
check start from the same rows.  Table names in braces are the given tables.
"""

import hashlib

from pyspark.sql import DataFrame, SparkSession

from quartermill import schemas
from quartermill.plans.worker_lines import Inputs

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

_BASE36 = "'0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ'"


def _code(key: str) -> str:
    """Two-character code from a key: every code turns up as the table grows."""
    return (
        f"substr({_BASE36}, CAST(floor(({key} % 1296) / 36) AS INT) + 1, 1) || "
        f"substr({_BASE36}, CAST({key} % 36 AS INT) + 1, 1)"
    )


VIEWS = {
    "fx_org": """
SELECT CAST(n_nationkey AS BIGINT) AS organization_unit_sk,
  lpad(CAST(n_regionkey AS STRING), 2, '0') AS branch_code,
  'C' || lpad(CAST(n_nationkey AS STRING), 3, '0') AS company_code,
  'S' || lpad(CAST(n_regionkey AS STRING), 3, '0') AS site_id,
  CASE WHEN n_nationkey % 6 = 0 THEN NULL WHEN n_nationkey % 7 = 0 THEN ' '
       ELSE lpad(CAST(n_nationkey * 1234567 AS STRING), 9, '0') END AS tax_id,
  CASE WHEN n_nationkey % 5 = 1 THEN NULL ELSE 'WEEKLY' END AS pay_frequency
FROM {nation}""",
    "fx_worker": """
SELECT c.c_custkey AS worker_sk, u.organization_unit_sk, u.branch_code, u.company_code,
  CASE WHEN c.c_custkey % 11 = 0 THEN 'Featherstonehaugh-' || CAST(c.c_custkey AS STRING) ELSE 'Fam' || CAST(c.c_custkey AS STRING) END AS family_name,
  CASE WHEN c.c_custkey % 13 = 0 THEN 'Maximiliana-' || CAST(c.c_custkey AS STRING) ELSE 'Giv' || CAST(c.c_custkey AS STRING) END AS given_name,
  CASE WHEN c.c_custkey % 4 = 0 THEN NULL ELSE 'quentin' END AS middle_name,
  CASE WHEN c.c_custkey % 17 = 0 THEN '12A45B789' WHEN c.c_custkey % 19 = 0 THEN NULL
       WHEN c.c_custkey % 101 = 0 THEN '000123456' WHEN c.c_custkey % 103 = 0 THEN '666123456'
       WHEN c.c_custkey % 107 = 0 THEN '123004567' WHEN c.c_custkey % 109 = 0 THEN '123450000'
       WHEN c.c_custkey % 113 = 0 THEN '111111111' WHEN c.c_custkey % 127 = 0 THEN '987654321'
       WHEN c.c_custkey % 131 = 0 THEN '123456789' WHEN c.c_custkey % 137 = 0 THEN '912345678'
       WHEN c.c_custkey % 139 = 0 THEN '000000000'
       ELSE lpad(CAST((c.c_custkey * 7919 + 100000007) % 900000000 AS STRING), 9, '0') END AS ssn,
  CASE WHEN c.c_custkey % 53 = 0 THEN NULL ELSE DATE '1950-01-01' + CAST(c.c_custkey % 18000 AS INT) END AS birth_date,
  DATE '1990-01-01' + CAST(c.c_custkey % 2400 AS INT) AS hire_date,
  CASE WHEN c.c_custkey % 6 = 0 THEN DATE '1996-11-30' END AS termination_date,
  CASE WHEN c.c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
  'D' || CAST(c.c_custkey % 50 AS STRING) AS department_code,
  CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN 'Seasonal' WHEN 'MACHINERY' THEN 'Contractor' ELSE 'Regular' END AS worker_type,
  CASE c.c_custkey % 3 WHEN 0 THEN 'Hourly' WHEN 1 THEN 'Salaried' ELSE 'Daily' END AS remuneration_basis,
  CAST(c.c_custkey % 101 AS DECIMAL(18,4)) AS ownership_percent,
  'E' || CAST(c.c_custkey AS STRING) AS employee_id,
  CASE WHEN c.c_custkey % 59 = 0 THEN ' ' WHEN c.c_custkey % 61 = 0 THEN 'chef & host' WHEN c.c_custkey % 67 = 0 THEN NULL
       ELSE lower(c.c_mktsegment) || ' specialist' END AS job_title,
  CAST(abs(c.c_acctbal) AS DECIMAL(18,4)) AS pay_rate_amount,
  c.c_custkey % 5 = 0 AS retirement_plan_indicator,
  c.c_custkey % 23 = 0 AS third_party_sick_pay_indicator,
  CASE WHEN c.c_custkey % 29 = 0 THEN NULL ELSE c.c_custkey % 14 = 0 END AS replacement_worker,
  c.c_custkey % 31 = 0 AS corporate_officer_indicator,
  c.c_custkey % 37 = 0 AS w2_special_handle_indicator,
  c.c_custkey % 3 = 0 AS medical_coverage_indicator,
  c.c_custkey % 41 = 0 AS suppress_w2_print_indicator,
  c.c_custkey % 7 = 0 AS work_from_home_flag,
  c.c_custkey % 43 = 0 AS post_w2_indicator,
  c.c_custkey % 47 = 0 AS statutory_flag
FROM {customer} c JOIN fx_org u ON u.organization_unit_sk = c.c_nationkey""",
    "fx_address": """
SELECT worker_sk, 'Work' AS type, CAST(worker_sk AS STRING) || ' Main St' AS line_one, 'Springfield' AS city_name, 'NJ' AS state_code, '07068' AS postal_code
FROM fx_worker WHERE worker_sk % 9 <> 0
UNION ALL
SELECT worker_sk, 'Home', CAST(worker_sk AS STRING) || ' Oak Ave', 'Newark', 'NY', '10001' FROM fx_worker WHERE worker_sk % 8 <> 0
UNION ALL
SELECT worker_sk, 'Mail', 'Box ' || CAST(worker_sk AS STRING), 'Trenton', 'NJ', '08601' FROM fx_worker WHERE worker_sk % 10 = 0""",
    "fx_snapshot": """
SELECT o.o_custkey AS worker_sk, w.organization_unit_sk, w.branch_code, w.company_code,
  o.o_orderkey AS payroll_run_sk, CAST(year(l.l_shipdate) AS INT) AS year, CAST(quarter(l.l_shipdate) AS INT) AS quarter,
  CASE WHEN l.l_linenumber % 3 = 0 THEN NULL ELSE
    CASE l.l_suppkey % 7 WHEN 0 THEN 'CA' WHEN 1 THEN 'NJ' WHEN 2 THEN 'NY' WHEN 3 THEN 'DE' WHEN 4 THEN 'WV' WHEN 5 THEN 'SC' ELSE 'MA' END END AS state_code,
  CASE WHEN l.l_linenumber % 3 = 2 THEN lpad(CAST(l.l_partkey % 4 AS STRING), 6, '0') END AS local_code,
  CASE WHEN l.l_linenumber % 3 = 0 THEN CASE l.l_suppkey % 4 WHEN 0 THEN 'FIT' WHEN 1 THEN 'SocialSecurity' WHEN 2 THEN 'MEDICARE' ELSE 'COBRA-CR' END
       WHEN l.l_linenumber % 3 = 1 THEN CASE l.l_suppkey % 4 WHEN 0 THEN 'SIT' WHEN 1 THEN 'SUI' WHEN 2 THEN 'SDI' ELSE 'FLI' END
       ELSE 'CIT' END AS tax_type,
  l.l_linestatus = 'F' AS is_employer_tax,
  CAST(CASE WHEN l.l_partkey % 23 = 0 THEN 0 ELSE l.l_discount END AS DECIMAL(8,4)) AS tax_rate,
  CAST(CASE WHEN l.l_partkey % 43 = 0 THEN NULL WHEN l.l_partkey % 41 = 0 THEN 0 ELSE l.l_quantity * 50 END AS DECIMAL(18,2)) AS hours_worked,
  CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * CAST(l.l_tax AS DECIMAL(4,2)) * (CASE WHEN l.l_returnflag = 'R' THEN -1 ELSE 1 END) AS DECIMAL(18,2)) AS qtd_amount,
  CASE WHEN l.l_partkey % 13 = 0 THEN NULL WHEN l.l_partkey % 29 = 0 THEN CAST(0 AS DECIMAL(18,2))
       ELSE CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * (CASE WHEN l.l_partkey % 37 = 0 THEN -1 ELSE 1 END) AS DECIMAL(18,2)) END AS qtd_taxable_amount,
  CAST(CASE WHEN l.l_partkey % 17 = 0 THEN l.l_extendedprice - 10 ELSE l.l_extendedprice + 5 END AS DECIMAL(18,2)) AS qtd_subject_amount,
  CAST(l.l_extendedprice AS DECIMAL(18,2)) AS qtd_gross_wages,
  CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * CAST(l.l_tax AS DECIMAL(4,2)) * (CASE WHEN l.l_partkey % 31 = 0 THEN -3 ELSE 3 END) AS DECIMAL(18,2)) AS ytd_amount,
  CASE WHEN l.l_partkey % 19 = 0 THEN NULL ELSE CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * (CASE WHEN l.l_partkey % 37 = 0 THEN -3 ELSE 3 END) AS DECIMAL(18,2)) END AS ytd_taxable_amount,
  CASE WHEN l.l_partkey % 47 = 0 THEN CAST(1 AS DECIMAL(18,2)) ELSE CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * 3 AS DECIMAL(18,2)) END AS ytd_subject_amount,
  CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * 3 AS DECIMAL(18,2)) AS ytd_gross_wages,
  CAST(CASE WHEN l.l_partkey % 3 = 0 THEN l.l_quantity ELSE NULL END AS DECIMAL(18,2)) AS qtd_overtime_amount,
  CAST(CASE WHEN l.l_partkey % 3 = 0 THEN l.l_quantity * 2 ELSE NULL END AS DECIMAL(18,2)) AS ytd_overtime_amount,
  CASE WHEN l.l_partkey % 10 = 0 THEN CAST(l.l_partkey AS STRING) WHEN l.l_partkey % 11 = 0 THEN ' ' END AS lived_in_code,
  CASE WHEN l.l_partkey % 6 = 0 THEN '{"qtdGrossWages": "' || CAST(CAST(l.l_quantity AS INT) AS STRING) || '", "ytdGrossWages": ' || CAST(CAST(l.l_quantity AS INT) * 4 AS STRING) || '}'
       WHEN l.l_partkey % 6 = 1 THEN '{"qtdTaxableAmount": "n/a", "ytdTaxableAmount": "12.345"}' END AS out_of_state,
  CAST(l.l_quantity AS INT) % 18 AS qtd_weeks_worked,
  CASE WHEN l.l_partkey % 53 = 0 THEN NULL ELSE CAST(l.l_quantity AS INT) + 10 END AS ytd_weeks_worked,
  CAST(l.l_discount * 1200 AS DECIMAL(8,2)) AS contribution_percent
FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey JOIN fx_worker w ON w.worker_sk = o.o_custkey""",
    "fx_profile": """
SELECT worker_sk, branch_code, company_code,
  CASE WHEN worker_sk % 5 = 0 THEN 'CA' WHEN worker_sk % 2 = 0 THEN NULL ELSE 'NJ' END AS state_code,
  CASE WHEN worker_sk % 5 = 0 THEN '000001' END AS local_code,
  CASE worker_sk % 3 WHEN 0 THEN 'MarriedFilingJointly' WHEN 1 THEN 'HeadOfHousehold' ELSE 'Single' END AS filing_status,
  CAST(worker_sk % 12 AS INT) AS number_of_allowances, 'Y' AS sui_exempt_flag, 'N' AS sdi_exempt_flag
FROM fx_worker WHERE worker_sk % 4 <> 0""",
    "fx_queue": """
SELECT 'B' || lpad(CAST(event_id AS STRING), 9, '0') AS batch_id,
  'S' || lpad(CAST(user_id % 6 AS STRING), 3, '0') AS site_id,
  CAST(1995 + floor((event_id % 28) / 4) AS INT) AS year,
  CAST(event_id % 4 AS INT) + 1 AS quarter,
  CAST(ts AS DATE) AS window_start, CAST(ts AS DATE) + 1 AS window_end,
  CASE event_type WHEN 'purchase' THEN 'GENERATED' WHEN 'error' THEN 'FAILED' ELSE 'QUEUED' END AS status,
  CASE WHEN event_id % 10 = 0 THEN 'PERIODIC' ELSE 'QUARTER' END AS file_type,
  CASE event_type WHEN 'purchase' THEN 'generated' WHEN 'click' THEN 'Failed_Generation' WHEN 'signup' THEN 'done'
    WHEN 'view' THEN 'SKIPPED' END AS raw_status
FROM {events}""",
    "fx_error": """
SELECT event_id AS company_error_sk,
  CASE event_id % 7 WHEN 0 THEN 'FEIN_IS_MISSING' WHEN 1 THEN 'FEIN_NOT_CORRECT' WHEN 2 THEN 'CA_WAGE_PLAN_MISSING'
    WHEN 3 THEN 'SSN_NON_NUM' WHEN 4 THEN 'FIT_QTD_INVALID' WHEN 5 THEN 'E002' ELSE 'NOT_IN_CATALOG' END AS error_code,
  CASE event_id % 7 WHEN 0 THEN user_id % 2 WHEN 1 THEN user_id % 25 WHEN 2 THEN 3 + user_id % 5 ELSE user_id % 25 END AS organization_unit_sk,
  CASE WHEN event_type <> 'error' OR event_id % 3 = 0 THEN 'Resolved' ELSE 'Open' END AS resolution_status,
  CASE WHEN event_type = 'purchase' THEN 'SKIPPED' WHEN event_id % 8 = 0 THEN 'WRITTEN' ELSE 'PENDING' END AS write_status,
  CASE WHEN event_id % 7 = 2 AND event_id % 5 <> 0 THEN 'CA' END AS state_code, CAST(NULL AS STRING) AS local_code,
  CASE WHEN event_id % 7 <> 2 THEN NULL WHEN event_id % 5 = 0 THEN 'SocialSecurity' WHEN event_id % 4 = 0 THEN 'SUI' WHEN event_id % 2 = 0 THEN 'SIT' END AS tax_type,
  CASE WHEN event_id % 7 IN (3, 4, 5) THEN user_id END AS worker_sk, ts AS created_date_time,
  CASE event_id % 8 WHEN 0 THEN ' payroll  &   tax ' WHEN 1 THEN 'Worker Profile' WHEN 2 THEN NULL WHEN 3 THEN ''
    WHEN 4 THEN 'WagePlan' WHEN 5 THEN '--company--' WHEN 6 THEN '&&' ELSE 'PAYROLL' END AS raw_category,
  CASE event_id % 9 WHEN 0 THEN 'true' WHEN 1 THEN 'Y' WHEN 2 THEN ' 1 ' WHEN 3 THEN 'False' WHEN 4 THEN NULL
    WHEN 5 THEN 'yes' WHEN 6 THEN 'N' WHEN 7 THEN 't' ELSE '' END AS raw_flag
FROM {events}""",
    "fx_field_raw": f"""
SELECT {_code('p_partkey')} AS field_code,
  CAST(1 + p_partkey % 1296 % 20 AS INT) AS field_length,
  CASE WHEN p_partkey % 1296 % 11 = 0 THEN 'Z' WHEN p_partkey % 1296 % 3 = 0 THEN 'N' ELSE 'X' END AS data_type,
  CASE WHEN p_partkey % 1296 % 5 = 0 THEN NULL ELSE CAST(p_partkey % 1296 % 5 AS INT) END AS decimal_places,
  CASE WHEN p_partkey % 1296 % 2 = 0 THEN 'Y' ELSE 'N' END AS signed,
  CASE WHEN p_partkey % 1296 % 7 = 0 THEN 'DATE' END AS category_1,
  CASE WHEN p_partkey % 1296 % 4 = 0 THEN 'AMT' END AS category_2
FROM {{part}}
UNION ALL
SELECT {_code('p_partkey')}, CAST(1 + (p_partkey % 1296 + p_partkey % 3) % 20 AS INT), 'X', NULL, 'N', NULL, 'ALT'
FROM {{part}} WHERE p_partkey % 9 = 0""",
    "fx_level_raw": f"""
SELECT {_code('p_partkey')} AS field_code,
  CASE p_size % 4 WHEN 0 THEN 'EEF' WHEN 1 THEN 'EES' WHEN 2 THEN 'EEL' ELSE 'EEX' END AS record_code,
  CASE WHEN p_size % 5 = 0 THEN 'A' ELSE 'Q' END AS file_code
FROM {{part}}""",
    "fx_feed_json": f"""
SELECT p_partkey AS seq,
  '{{"taxCode": {{"code": "' || CASE p_partkey % 13 WHEN 0 THEN 'FIT' WHEN 1 THEN 'SIT' WHEN 2 THEN 'CIT' WHEN 3 THEN 'SSEE' WHEN 4 THEN 'SSER'
    WHEN 5 THEN 'MEDEE' WHEN 6 THEN 'MEDER' WHEN 7 THEN 'SUIEE' WHEN 8 THEN 'SUIER' WHEN 9 THEN 'SDIEE' WHEN 10 THEN 'EE' WHEN 11 THEN 'ER' ELSE '' END
  || '"}}, "fieldCode": {{"code": "' || {_code('p_partkey * 7')} || '"}}, "token": {{"code": "' ||
    CASE p_partkey % 8 WHEN 0 THEN 'QTDT' WHEN 1 THEN 'YTDT' WHEN 2 THEN 'QTDTAXW' WHEN 3 THEN 'QTDW' WHEN 4 THEN 'QTD-HOUR-WORK'
      WHEN 5 THEN 'YTD-HOUR-WORK' WHEN 6 THEN 'CD-MARITAL-STS' ELSE 'NOT-A-TOKEN' END || '"}}}}' AS value
FROM {{part}}""",
    # The feed with lines that are cut, empty, no JSON, or lack a key.
    "fx_feed_damaged": """
SELECT seq, CASE seq % 31 WHEN 0 THEN left(value, length(value) - 3) WHEN 1 THEN '' WHEN 2 THEN '  ' WHEN 3 THEN NULL WHEN 4 THEN 'not a row'
  WHEN 5 THEN replace(value, '"fieldCode"', '"field"') WHEN 6 THEN replace(value, '"token"', '"tok"') WHEN 7 THEN replace(value, '"taxCode": {"code"', '"taxCode": {"name"')
  ELSE value END AS value
FROM fx_feed_json""",
}

# The joins of fx_snapshot, and the same inner joins with orders and workers first: the lines move once, but lie by order.
_JOINS = (
    "{lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey JOIN fx_worker w ON w.worker_sk = o.o_custkey",
    "{lineitem} l JOIN ({orders} o JOIN fx_worker w ON w.worker_sk = o.o_custkey) ON l.l_orderkey = o.o_orderkey",
)

DEPENDS = {
    "fx_feed_damaged": ("fx_feed_json",),
    "fx_worker": ("fx_org",),
    "fx_address": ("fx_worker",),
    "fx_snapshot": ("fx_worker",),
    "fx_profile": ("fx_worker",),
}


def _fill(sql: str, tables: dict[str, str]) -> str:
    for table, name in tables.items():
        sql = sql.replace("{%s}" % table, name)
    return sql


def with_clause(*names: str, tables: dict[str, str] | None = None) -> str:
    """``WITH`` clause that defines the views and what they read."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in DEPENDS.get(name, ()):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    tables = tables or {t: t for t in TABLES}
    return "WITH " + ", ".join(f"{n} AS ({_fill(VIEWS[n], tables)})" for n in ordered)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str, lines_once: bool = False) -> DataFrame:
    """A view as a DataFrame over the parquet tables of ``sf_dir``.

    ``lines_once`` is for jobs that read tax rows one by one: ``fx_snapshot``
    then shuffles its rows by order only, not by worker as well.
    """
    tag = hashlib.md5(sf_dir.encode()).hexdigest()[:8]
    tables = {t: f"quartermill_{t}_{tag}" for t in TABLES}
    sql = with_clause(name, tables=tables) + f" SELECT * FROM {name}"
    if lines_once:
        sql = sql.replace(*(_fill(joins, tables) for joins in _JOINS))
    for given, registered in tables.items():
        if registered in sql and not spark.catalog.tableExists(registered):
            table(spark, sf_dir, given).createOrReplaceTempView(registered)
    return spark.sql(sql)


#: View of each input of the filing job.
INPUT_VIEWS = {
    "worker": "fx_worker", "address": "fx_address", "snapshot": "fx_snapshot", "profile": "fx_profile",
    "organization": "fx_org", "queue": "fx_queue",
}


def inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    load = {
        "worker": ("fx_worker", schemas.WORKER),
        "address": ("fx_address", schemas.ADDRESS),
        "snapshot": ("fx_snapshot", schemas.SNAPSHOT),
        "profile": ("fx_profile", schemas.PROFILE),
        "organization": ("fx_org", schemas.ORGANIZATION),
        "queue": ("fx_queue", schemas.QUEUE),
    }
    return Inputs(
        **{
            key: schemas.conform(view(spark, sf_dir, name), schema, key, blank_as_null=key != "address")
            for key, (name, schema) in load.items()
        }
    )
