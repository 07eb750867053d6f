"""Unreadable input values: rejected with a reason, their companies left out, all other files unchanged."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F, types as T

from quartermill import schemas
from quartermill.functions.formats import quote
from quartermill.operators.queue import failure_message, queued
from quartermill.session import stage

COMPANY = ("branch_code", "company_code")
UNREADABLE = "UNREADABLE"
MISSING_KEY = "MISSING_KEY"


def _reason(column: str, declared: str, given: str, key: bool) -> str:
    """SQL: why a value can't be used, null if it can."""
    checks = []
    if key:
        checks.append(f"WHEN {column} IS NULL THEN {quote(MISSING_KEY)}")
    if given != declared:
        checks.append(f"WHEN {column} IS NOT NULL AND try_cast({column} AS {declared}) IS NULL THEN {quote(UNREADABLE)}")
    return f"CASE {' '.join(checks)} END" if checks else "CAST(NULL AS STRING)"


def split(df: DataFrame, schema: T.StructType, name: str, keys: tuple[str, ...] = (), blank_as_null: bool = True) -> tuple[DataFrame, DataFrame]:
    """(rows that can be read, as ``schemas.conform`` gives them; rejected values of the others).

    A value is rejected if it is there but not of its declared type, or if a
    column of ``keys`` is null. Rejects hold input, branch_code, company_code
    and worker_sk as far as the input has them (as text, as given), column_name,
    value and reason; a row of several bad values has one for each. Nothing is
    cast before it is checked, so a bad value never fails the job.
    """
    schemas.require_columns(df, schema.names, name)
    types = dict(df.dtypes)
    reasons = {f.name: _reason(f.name, f.dataType.simpleString(), types[f.name], f.name in keys) for f in schema}
    checked = {c: r for c, r in reasons.items() if r.startswith("CASE")}
    if not checked:
        checked = {schema.names[0]: "CAST(NULL AS STRING)"}
    found = ", ".join(
        f"CASE WHEN {r} IS NOT NULL THEN named_struct('column_name', '{c}', 'value', CAST({c} AS STRING), 'reason', {r}) END" for c, r in checked.items()
    )
    marked = df.withColumn("_bad", F.expr(f"array_compact(array({found}))"))
    place = [F.col(c).cast("string").alias(c) if c in types else F.lit(None).cast("string").alias(c) for c in (*COMPANY, "worker_sk")]
    rejects = marked.where("size(_bad) > 0").select(F.lit(name).alias("input"), *place, F.explode("_bad").alias("bad"))
    columns = []
    for field in schema:
        declared = field.dataType.simpleString()
        value = field.name if types[field.name] == declared else f"try_cast({field.name} AS {declared})"
        columns.append(f"{value} AS {field.name}")
    good = marked.where("size(_bad) = 0").selectExpr(*columns, *(c for c in types if c not in schema.names))
    return schemas.conform(good, schema, name, blank_as_null), rejects.select("input", *COMPANY, "worker_sk", "bad.*")


@dataclass(frozen=True)
class Checked:
    """Readable inputs, all rejected values, and the companies they belong to."""

    inputs: dict[str, DataFrame]
    rejects: DataFrame
    companies: DataFrame


#: Inputs of the filing job: schema, and columns without which a row belongs nowhere.
CONTRACTS = {
    "worker": (schemas.WORKER, ("worker_sk", *COMPANY)),
    "address": (schemas.ADDRESS, ("worker_sk",)),
    "snapshot": (schemas.SNAPSHOT, ("worker_sk",)),
    "profile": (schemas.PROFILE, ("worker_sk",)),
    "organization": (schemas.ORGANIZATION, ()),
    "queue": (schemas.QUEUE, ()),
}


def check(raw: dict[str, DataFrame], leave_out: bool = True) -> Checked:
    """Splits every input and finds the companies of the rejected values.

    A reject without a company of its own takes its worker's; one of neither
    is kept in ``rejects`` only. With ``leave_out`` the workers of those
    companies go from the worker table, and with them their lines; without it
    only the bad rows are missing. Rejects and companies are written once.
    """
    parts = {name: split(df, *CONTRACTS[name][:1], name, CONTRACTS[name][1], blank_as_null=name != "address") for name, df in raw.items()}
    inputs = {name: good for name, (good, _) in parts.items()}
    rejects = None
    for _, found in parts.values():
        rejects = found if rejects is None else rejects.unionByName(found)
    rejects = stage(rejects, "quarantine")
    own = rejects.where("branch_code IS NOT NULL AND company_code IS NOT NULL").select(*COMPANY)
    lost = rejects.where("branch_code IS NULL OR company_code IS NULL").selectExpr("try_cast(worker_sk AS BIGINT) AS worker_sk").distinct()
    through = inputs["worker"].select("worker_sk", *COMPANY).join(lost, "worker_sk", "left_semi").select(*COMPANY)
    companies = stage(own.unionByName(through).distinct(), "quarantined-companies")
    if leave_out:
        inputs["worker"] = inputs["worker"].join(companies, list(COMPANY), "left_anti").select(*inputs["worker"].columns)
    return Checked(inputs, rejects, companies)


def mark_status(
    changes: DataFrame, queue: DataFrame, companies: DataFrame, organization: DataFrame, partial: str = "GENERATED"
) -> DataFrame:
    """Queue rows after a run (``queue.status_changes``) with what was left out.

    A file that was written without some companies of its site gets the status
    ``partial`` (GENERATED or FAILED) and says how many are missing; one that
    failed because they were all it had says so. Other rows are unchanged.
    """
    sites = organization.select("site_id", *COMPANY).distinct().join(companies, list(COMPANY), "left_semi")
    first = F.min(F.concat_ws("/", *COMPANY))
    lacking = sites.groupBy("site_id").agg(F.count(F.lit(1)).alias("left_out"), first.alias("first_left_out"))
    run = queued(queue).select("batch_id").distinct().withColumn("in_run", F.lit(True))
    note = F.concat(
        F.col("left_out").cast("string"), F.lit(" companies left out for unreadable input, first: "), F.col("first_left_out")
    )
    hit = F.col("in_run") & F.col("left_out").isNotNull() & F.col("status").isin("GENERATED", "FAILED")
    rows = changes.join(run, "batch_id", "left").join(lacking, "site_id", "left")
    rows = rows.withColumn("hit", F.coalesce(hit, F.lit(False))).withColumn("was", F.col("status"))
    rows = rows.withColumn("status", F.when(F.col("hit") & (F.col("was") == "GENERATED"), F.lit(partial)).otherwise(F.col("status")))
    text = F.when(F.col("hit"), failure_message(F.concat_ws("; ", "error_message", note))).otherwise(F.col("error_message"))
    return rows.withColumn("error_message", text).select(*changes.columns)
