"""Work queue: queued files, site companies, status changes."""

from pyspark.sql import Column, DataFrame, functions as F

from quartermill.specs import fixed_values as fixed

PERIOD = ("site_id", "year", "quarter")
MESSAGE_WIDTH = 2000


def queued(queue: DataFrame) -> DataFrame:
    return queue.filter(
        (F.col("status") == "QUEUED") & (F.col("file_type") == fixed.QUEUE_FILE_TYPE)
    ).select("batch_id", *PERIOD, "window_start", "window_end")


def site_periods(queue: DataFrame) -> DataFrame:
    """Distinct (site, year, quarter) of the queued files."""
    return queued(queue).select(*PERIOD).distinct()


def site_companies(organization: DataFrame, queue: DataFrame) -> DataFrame:
    """Companies of the queued sites."""
    sites = queued(queue).select("site_id").distinct()
    return (
        organization.select("branch_code", "company_code", "site_id")
        .distinct()
        .join(sites, "site_id", "left_semi")
    )


def lookup_company(organization: DataFrame, company_code: str) -> DataFrame:
    """First branch of a company code, in branch order."""
    return (
        organization.filter(F.col("company_code") == company_code)
        .select("branch_code", "company_code")
        .orderBy("branch_code")
        .limit(1)
    )


def normalize_status(df: DataFrame, column: str = "status") -> DataFrame:
    """Upper-case status; values outside the known seven are flagged as rejects."""
    upper = F.upper(F.trim(column))
    return df.withColumn("is_valid", F.coalesce(upper.isin(*fixed.FILE_STATUSES), F.lit(False))).withColumn(
        column, F.when(F.col("is_valid"), upper)
    )


def file_name(site_id: Column, year: Column, quarter: Column, run_time: Column, prefix: str = "QTR") -> Column:
    stamp = F.date_format(run_time, "yyyyMMdd_HHmmss")
    return F.concat(
        F.lit(f"{prefix}_"), site_id, F.lit("_Q"), quarter.cast("string"), F.lit("_"), year.cast("string"),
        F.lit("_"), stamp, F.lit(".txt"),
    )


def output_names(periods: DataFrame, run_time: str, prefix: str = "QTR", folder: str = "worker-detail") -> DataFrame:
    """File name and object key of every queued file."""
    name = file_name(
        F.col("site_id"), F.col("year"), F.col("quarter"), F.lit(run_time).cast("timestamp"), prefix
    )
    return periods.select(
        *PERIOD, name.alias("outbound_file_name"), F.concat(F.lit(f"{folder}/"), name).alias("object_key")
    )


def failure_message(text: Column) -> Column:
    return F.left(text, F.lit(MESSAGE_WIDTH))


def status_changes(
    queue: DataFrame, results: DataFrame, organization: DataFrame, run_time: str, prefix: str = "QTR"
) -> DataFrame:
    """The queue with the outcome of a run.

    ``results`` holds ``site_id, year, quarter, record_count, skipped``: files
    with a record count are GENERATED, files emptied by skip rules SKIPPED, and
    a queued file with no result FAILED.  Rows that were not queued keep their
    values.
    """
    is_queued = (F.col("status") == "QUEUED") & (F.col("file_type") == fixed.QUEUE_FILE_TYPE)
    known = organization.select("site_id").distinct().withColumn("has_company", F.lit(True))
    names = output_names(results.filter("record_count IS NOT NULL"), run_time, prefix)
    outcome = results.join(names, list(PERIOD), "left")
    message = F.when(
        F.col("has_company").isNull(),
        F.concat(F.lit("No companies found for site_id: "), F.col("site_id")),
    ).otherwise(F.concat(F.lit("No worker data found for site: "), F.col("site_id")))
    new_status = (
        F.when(F.col("record_count").isNotNull(), "GENERATED").when(F.col("skipped"), "SKIPPED").otherwise("FAILED")
    )
    return (
        # The queue may be long and has few distinct files: do not shuffle it by file.
        queue.join(outcome, list(PERIOD), "left")
        .join(known, "site_id", "left")
        .select(
            "batch_id",
            *PERIOD,
            "file_type",
            F.when(is_queued, new_status).otherwise(F.col("status")).alias("status"),
            *(F.when(is_queued, F.col(n)).alias(n) for n in ("record_count", "outbound_file_name", "object_key")),
            F.when(is_queued & (new_status == "FAILED"), failure_message(message)).alias("error_message"),
        )
    )


def batch_summary(changes: DataFrame) -> DataFrame:
    return changes.filter(F.col("file_type") == fixed.QUEUE_FILE_TYPE).groupBy("status").agg(
        F.count("*").alias("files"), F.sum("record_count").alias("records")
    )
